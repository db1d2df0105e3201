"""The queries op1 to op13: each operator over its whole table, with the production parameters, and SQL where it can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, fingerprints, html_extract, jaccard_join, language_id, license_scan, packing, sharding, spelling, substring_dedup, suffix_dedup, token_counts, whitening
from .storage import shared_folder, stored


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return decontamination.contaminated(found).select(F.col("doc_id").cast("long").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_read(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), *token_counts.tokenizer_paths())


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_read(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_classes(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(sharding.records(_read(spark, sf_dir, "documents")), "records")
    slot_map = sharding.store_map(sharding.place(sharding.slot_bytes(rows, 8), 8), f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}")
    out = sharding.assign(rows, slot_map)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), *token_counts.tokenizer_paths())


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_read(spark, sf_dir, "pages"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_read(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_read(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_suffixes(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_benchmark_decontamination, op2_document_fingerprints, op3_token_counts, op4_substring_dedup, op5_ngram_jaccard_join, op6_sharding, op7_best_fit_packing, op8_language_id, op9_html_extraction, op10_license_scan, op11_spelling_variants, op12_embedding_whitening, op13_suffix_dedup)
    return {f.__name__: f for f in every}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(0))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_BLANK = "regexp_extract_all(coalesce(text, ' '), '[^\\x20\\x09-\\x0D]+')"

_SQL = {
    "op1_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, x.n AS n, item_id FROM grams x JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op4_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_BLANK} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
first AS (SELECT g, min({{'d': doc_id, 'i': i}}) AS f FROM g GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM g JOIN first USING (g) WHERE f.d <> doc_id OR f.i <> i),
flat AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM flat ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, ' ')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)

SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id FROM d JOIN r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY ALL""",
    "op11_spelling_variants": f"""
WITH RECURSIVE crc AS (SELECT list(list_reduce([k] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS t FROM (SELECT unnest(range(256)) AS k)),
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, ' ')")}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM r GROUP BY doc_id, w),
h AS (SELECT w, n, xor(list_reduce([4294967295] || list_transform(range(1, len(x), 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT)), lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) AS h FROM c, crc),
v AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word, n FROM h),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM v WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
s AS (SELECT word, i, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word AS word, y.word AS other FROM s x JOIN s y USING (i, a, b) WHERE x.word <> y.word
  UNION SELECT s.word, w.word FROM s JOIN words w ON w.word = a || b
  UNION SELECT w.word, s.word FROM s JOIN words w ON w.word = a || b),
best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, {{'n': -o.n, 'w': encode(other)}}) AS other, max(o.n) AS m
  FROM near JOIN words o ON o.word = other GROUP BY near.word),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
roots AS (SELECT word, word AS tip FROM forms UNION ALL SELECT roots.word, form FROM roots JOIN forms ON forms.word = tip WHERE form IS NOT NULL)
SELECT f.word, f.form, tip AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN roots ON roots.word = f.word JOIN forms e ON e.word = tip AND e.form IS NULL""",
    "op13_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, i, md5(b[i:i + 199]) AS g FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d WHERE octet_length(b) >= 200)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
cut AS (SELECT doc_id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, true) AS fresh FROM dup)),
spans AS (SELECT doc_id, k, min(i) AS s, max(i) + 199 AS e FROM cut GROUP BY doc_id, k),
gaps AS (
  SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) + 1 AS f, s - 1 AS t FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(e), 0) + 1, octet_length(any_value(b)) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, string_agg(hex(b[f:t]), '' ORDER BY f) AS x FROM gaps JOIN d USING (doc_id) WHERE f <= t GROUP BY doc_id),
n AS (SELECT doc_id, sum(e - s + 1) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(x, ''))) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
