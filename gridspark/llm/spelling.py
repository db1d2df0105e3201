"""Spelling variants: words of a corpus grouped by edit distance one, with a dictionary of trie-node pairs.

The nodes of the trie of all words, and of the trie of all words read backwards, are numbered. A word that is cut in two is
then a pair of whole numbers, (node of what stands before the cut, node of what stands after it), and so is a word with one
place skipped. Two words differ by a replaced code point if they have the same pair with a place skipped, and by an inserted
or deleted one if the pair of one with a place skipped is a pair of the other with none. Equal numbers mean equal strings, so
what meets in the dictionary is exact and is not compared again. As words with one and the same place skipped differ in a
single letter, a pair holds no more words than the alphabet has letters, and one more.

The tries are never held in one place. Words are sorted in ranges; in sorted order a word brings as many new nodes as it is
longer than what it shares with the word before it, so every range numbers its own, and only what the first word of a range
shares with the range before it is settled between ranges (a row for each range).

Defined cases: a null or empty text has no words; a null id counts as the empty string in the hash that picks a code point to
delete; repeated rows count again; words may be of any length; columns other than the named ones are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import light_batches, stored
from .text import release, slices

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWERED = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Characters of different words counted in a task before they are handed on, and of words in a range of the sorted words.
_HELD, RANGE = 8 << 20, 4 << 20


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 199) -> DataFrame:
    """Rows (word, n) over all runs of letters, A-Z lower-cased.

    A run whose hash h = crc32("<id>:<run>") is divisible by ``damage`` loses its code point h % length (0: none does), as a
    corpus of clean texts has no misspellings to find.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = Counter(), 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for part in slices(batches, "text", 4 << 20):
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(_RUN.findall(text.translate(_LOWERED))).items():
                    if damage:
                        h = zlib.crc32(word.encode(), start)
                        if h % damage == 0:
                            h %= len(word)
                            word = word[:h] + word[h + 1 :]
                    if word not in held:
                        chars += len(word) + 50
                    held[word] += n
            if chars > _HELD:
                yield out()
                held, chars = Counter(), 0
        yield out()

    rows = light_batches(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _shared(a: str, b: str) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most  # the first `low` agree, not the first `high`
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def trie_nodes(words: DataFrame, ranges: int, word_col: str, nodes_col: str, rank_col: str | None = None) -> DataFrame:
    """``words`` with an array of the numbers of their prefixes' nodes (the root, 0, first), equal where prefixes are equal.

    ``word_col`` holds different words. With ``rank_col`` also their places in code-point order, from 0.
    """
    name = "range_"
    ordered = words.repartitionByRange(ranges, word_col).sortWithinPartitions(word_col)
    others = [f.name for f in words.schema if f.name != word_col]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes, made, rank = "", np.zeros(1, np.int64), 0, 0
        for batch in batches:
            arrays = []
            for word in batch.column(word_col).to_pylist():
                same = _shared(last, word)
                new = np.arange(made + 1, made + 1 + len(word) - same)
                nodes, made, last = np.concatenate((nodes[: same + 1], new)), made + len(new), word
                arrays.append(nodes)
            offsets = np.cumsum([0, *map(len, arrays)])
            flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
            own = np.arange(rank, rank + len(arrays))
            rank += len(arrays)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)), pa.array(own)], [*batch.schema.names, "nodes_", "rank_"])

    local = stored(ordered.mapInArrow(number, f"{kept}, nodes_ array<long>, rank_ long").withColumn(name, F.spark_partition_id()), "trie")
    ends = local.groupBy(name).agg(F.min(word_col).alias("first"), F.max_by(F.struct(word_col, "nodes_"), "rank_").alias("last"), F.max(F.array_max("nodes_")).alias("made"), F.count("*").alias("n"))
    fixed: dict[int, tuple[int, list[int], int]] = {}  # range: what its numbers go up by, the nodes it shares with those before, words before it
    before, path, made, rank = "", [0], 0, 0
    for r in sorted(ends.collect(), key=lambda r: r[name]):  # a row for each range
        same = _shared(before, r["first"])
        shared = path[: same + 1]  # the first word's nodes in its own range are numbered 0, 1, 2, ...
        fixed[r[name]] = (made, shared, rank)
        before, path = r["last"][word_col], [shared[k] if k < len(shared) else k + made for k in r["last"]["nodes_"]]
        made, rank = made + r["made"], rank + r["n"]

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("nodes_")
            flat, of = nodes.flatten().to_numpy(), np.repeat(batch.column(name).to_numpy(), np.diff(nodes.offsets.to_numpy()))
            out, ranks = flat.copy(), batch.column("rank_").to_numpy().copy()
            for k in np.unique(of).tolist():
                up, shared, first = fixed[k]
                own = of == k
                out[own] = np.where(flat[own] < len(shared), np.asarray(shared)[np.minimum(flat[own], len(shared) - 1)], flat[own] + up)
                ranks[batch.column(name).to_numpy() == k] += first
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*others, word_col)), pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(([0], np.diff(nodes.offsets.to_numpy())))), pa.int32()), pa.array(out)), *([pa.array(ranks)] if rank_col else [])], [*others, word_col, nodes_col, *([rank_col] if rank_col else [])])

    fields = {f.name: f.dataType.simpleString() for f in words.schema}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in (*others, word_col)), f"`{nodes_col}` array<long>", *([f"`{rank_col}` long"] if rank_col else [])])
    return local.mapInArrow(settle, schema)


def _ranges(words: DataFrame) -> int:
    return max(1, words.agg(F.coalesce(F.sum(F.octet_length("word") + 8), F.lit(0)).alias("b")).first()["b"] // RANGE)


def near_words(words: DataFrame) -> DataFrame:
    """Rows (rank, word, n, n_near, best): how many other words are one edit away, and the (n, -rank) of the most frequent.

    ``words`` has different words in ``word`` and their counts in ``n``; ranks number them in code-point order.
    """
    ranges = _ranges(words)
    forward = stored(trie_nodes(words.select("word", "n"), ranges, "word", "fore", "rank"), "fore")
    backward = trie_nodes(forward.select("rank", F.reverse("word").alias("drow")), ranges, "drow", "back").select("rank", "back")
    length, letter = F.size("fore") - 1, lambda i: F.substring("word", i + 1, F.lit(1))
    own = stored(forward.join(backward, "rank").select("rank", "n", "fore", "back", F.split("word", "").alias("letters"), length.alias("len")), "nodes")
    # kind 0: a cut. 1, 2: a place skipped; 2 where the letter before is another, so that a deletion is met once
    cuts = F.transform(F.sequence(F.lit(0), F.col("len")), lambda i: F.struct(F.get("fore", i).alias("fore"), F.get("back", F.col("len") - i).alias("back"), F.lit(0).alias("kind")))
    skips = F.transform(
        F.sequence(F.lit(0), F.col("len") - 1),
        lambda i: F.struct(F.get("fore", i).alias("fore"), F.get("back", F.col("len") - 1 - i).alias("back"), F.when((i > 0) & (F.get("letters", i) == F.get("letters", i - 1)), 1).otherwise(2).alias("kind")),
    )
    pairs = own.filter("len > 0").select(F.struct("n", (-F.col("rank")).alias("minus")).alias("word"), F.explode(F.concat(cuts, skips)).alias("p")).select("p.fore", "p.back", "p.kind", "word")
    met = pairs.groupBy("fore", "back").agg(F.array_sort(F.collect_list(F.struct("word", "kind"))).alias("all")).filter(F.size("all") > 1)  # an alphabet's size at most

    def others(x: F.Column) -> F.Column:
        cut, skip, first = (x["kind"] == 0), (x["kind"] > 0), (x["kind"] == 2)
        return F.filter("all", lambda y: (y["word"] != x["word"]) & ((skip & (y["kind"] > 0)) | (cut & (y["kind"] == 2)) | (first & (y["kind"] == 0))))

    each = met.select(F.explode(F.transform("all", lambda x: F.struct(x["word"].alias("word"), F.size(others(x)).alias("n_near"), F.element_at(F.concat(F.array(F.lit(None).cast("struct<n:bigint,minus:bigint>")), F.transform(others(x), lambda y: y["word"])), -1).alias("best")))).alias("x")).select("x.*")
    near = each.groupBy((-F.col("word.minus")).alias("rank")).agg(F.sum("n_near").cast("long").alias("n_near"), F.max("best").alias("best"))
    return forward.select("rank", "word", "n").join(near, "rank", "left").select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best")


def spelling_forms(words: DataFrame, times: int = 5) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n) for different words with their counts.

    A word's form is the most frequent word one edit away (ties: the first in code-point order), if it occurs at least
    ``times`` as often. The root is where the forms lead to; their counts rise, so they end.
    """
    near = stored(near_words(words), "near")
    named = near.select("rank", "word", "n", "n_near", F.when(F.col("best.n") >= times * F.col("n"), -F.col("best.minus")).alias("form"))
    # roots by doubling: of words that have a form, what it leads to
    links = stored(named.filter("form is not null").select("rank", F.col("form").alias("to")), "links")
    while True:
        on = links.select(F.col("rank").alias("to"), F.col("to").alias("further"))
        then = stored(links.join(on, "to", "left").select("rank", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "links")
        links = then.select("rank", "to")
        if not then.filter("moved").limit(1).count():
            break
    word_of = near.select(F.col("rank").alias("at"), F.col("word").alias("said"), F.col("n").alias("said_n"))
    ends = links.join(word_of, F.col("to") == F.col("at")).select("rank", F.col("said").alias("root"))
    forms = named.filter("form is not null").join(word_of, F.col("form") == F.col("at")).select("rank", F.col("said").alias("form"), F.col("said_n").alias("form_n"))
    return named.drop("form").join(forms, "rank", "left").join(ends, "rank", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_n: int = 5, times: int = 5, damage: int = 199) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one for each word of at least so many code points and occurrences."""
    counted = word_counts(docs, id_col, text_col, damage)
    words = stored(counted.filter((F.char_length("word") >= least_length) & (F.col("n") >= least_n)), "words")
    return spelling_forms(words, times)
