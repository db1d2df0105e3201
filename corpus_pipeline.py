"""A corpus pipeline: documents go through five stages, each written as Parquet and read again as the next one's input.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of ``documents``.

Defined cases, in every stage: rows are judged by their own texts, whatever ids they share or lack; a null or empty text has
no language and goes in the first stage; of rows with equal or near-equal texts the smallest id stays, null ids last, and of
rows that repeat id and text one; an empty table stays empty; other columns keep their values, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm import decontamination, jaccard_join, language_id, packing, substring_dedup, token_counts
from gridspark.llm.storage import stored, unused

#: Least score of a language; texts below it have none and go.
LEAST_SCORE = 0.3
#: Word shingles and similarity of near copies.
SHINGLE, SIMILARITY = 5, "0.8"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what has no language: null texts, texts without a letter, and texts that no language scores high for."""
    lang, score = unused(docs.columns, "lang_found"), unused(docs.columns, "lang_score")
    found = language_id.identify(docs, language_id.fit(docs), keep=True, lang_out=lang, score_out=score)
    return found.filter((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the smallest id of each group of near copies, null ids last; each row is judged by its own text."""
    return jaccard_join.first_of_groups(docs, SHINGLE, SIMILARITY)


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 20 words and more that also start earlier; a document that is nothing else goes."""
    kept = substring_dedup.dedup_substrings(docs, keep_text=True)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows of which a twentieth or more stands in windows of 13 words of a benchmark item.

    A row is known by its id and text, so a clean row stays whatever rows share its id or have none.
    """
    key = F.concat(F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n")), F.lit(":"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("n")))
    row = unused(docs.columns, "row")
    keyed = docs.withColumn(row, key)
    found = decontamination.contaminated(decontamination.find_contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row))
    gone = stored(found.filter("contaminated").select(F.col("doc_id").alias(row)).distinct(), "contaminated")
    few = gone.count() <= jaccard_join.BROADCAST_ROWS
    return keyed.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2048 tokens; returns the pieces and their places."""
    return packing.pack_documents(docs, *token_counts.tokenizer_paths())


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("substring_dedup", repeated_passage_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: Language scores and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
