"""Benchmark decontamination over a distributed positional inverted index.

The training table is indexed by shards: a shard is a run of whole documents of bounded text, and its row stores each
term's sorted token positions. A phrase is found by taking its terms from the rarest posting list in the shard upwards,
shifting each list by the term's place in the phrase and intersecting by binary search. Nothing is shuffled: the test
phrases, a query set in blocks of bounded size, go to the shards. With a single block the index holds that block's terms
only and flows straight on to the search; with several the whole index is stored and searched by each. ``near`` searches
the same index for terms that stand close together.

Defined cases: a null or empty text has no words and no hits; an item without words has no phrase; a document longer
than a shard is a shard by itself; repeated rows are judged one by one; equal items are reported under each id; columns
other than the named ones are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import light_batches, stored
from .text import ALNUM, slices, utf8, words

#: Bytes of text in a shard, and of test texts in a block of queries (what is broadcast at once).
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
_INDEX = "shard long, doc_ids array<string>, n_words array<int>, terms array<binary>, lengths array<int>, postings binary"
_FOUND = "shard long, place int, doc_id string, n_words long, starts array<int>, ends array<int>, items array<string>"
_CANDIDATES = 1 << 20


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: list[bytes] | None = None) -> DataFrame:
    """Postings of the table, one row per shard; with ``vocabulary``, only those terms' (no other can be in a query)."""
    known = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        table = {} if known is None else {w: i for i, w in enumerate(known.value)}
        for part in slices(batches, "text", SHARD_BYTES):
            found, counts = [], []
            for text in utf8(part, "text"):
                own = words(text, ALNUM)
                counts.append(len(own))
                found += own
            if known is None:
                table = {w: i for i, w in enumerate(dict.fromkeys(found))}
            ids = np.fromiter(map(table.get, found, repeat(-1)), np.int64, len(found))
            # one place stays free between documents, so that no phrase runs across them
            at = np.arange(len(found)) + np.repeat(np.arange(len(counts)), counts)
            at, ids = at[ids >= 0], ids[ids >= 0]
            order = np.argsort(ids, kind="stable")
            terms, lengths = np.unique(ids, return_counts=True)
            names = list(table) if known is None else known.value
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int64()),
                    pa.array([part.column("id").to_pylist()], pa.list_(pa.string())),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([[names[t] for t in terms]], pa.list_(pa.binary())),
                    pa.array([lengths.tolist()], pa.list_(pa.int32())),
                    pa.array([at[order].astype(np.uint32).tobytes()], pa.binary()),
                ],
                ["shard", "doc_ids", "n_words", "terms", "lengths", "postings"],
            )
            shard += 1

    return light_batches(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _INDEX)


def _loaded(row: dict, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and length of each query term's list, and the lists as sorted keys term << 32 | position)."""
    terms = np.fromiter((vocabulary.get(t, -1) for t in row["terms"]), np.int64, len(row["terms"]))
    lengths = np.asarray(row["lengths"], np.int64)
    keys = (np.repeat(terms, lengths) << 32) + np.frombuffer(row["postings"], np.uint32).astype(np.int64)
    keys = keys[keys >= 0]
    if len(keys) > 1 and (keys[1:] < keys[:-1]).any():
        keys.sort()
    bounds = np.searchsorted(keys, np.arange(len(vocabulary) + 1, dtype=np.int64) << 32)
    return bounds[:-1], np.diff(bounds), keys


def _holds(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return keys[at] == wanted


def _intersect(first: np.ndarray, length: np.ndarray, keys: np.ndarray, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the phrases (rows of term numbers) and the phrase of each."""
    sizes = length[phrases]
    rows = np.flatnonzero(sizes.min(axis=1) > 0) if len(keys) else np.zeros(0, np.int64)
    order = np.argsort(sizes[rows], axis=1, kind="stable")
    least = sizes[rows, order[:, 0]] if len(rows) else np.zeros(0, np.int64)
    starts, which, done = [], [], 0
    cuts = np.searchsorted(np.cumsum(least), np.arange(_CANDIDATES, least.sum() + _CANDIDATES, _CANDIDATES)) + 1
    for cut in np.minimum(cuts, len(rows)):
        part, own, n = rows[done:cut], order[done:cut], least[done:cut]
        if not len(part):
            continue
        done = cut
        of = np.repeat(np.arange(len(part)), n)
        rank = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        rarest = phrases[part, own[:, 0]]
        start = (keys[first[rarest][of] + rank] & 0xFFFFFFFF) - own[of, 0]
        for k in range(1, phrases.shape[1]):  # the next rarest list, shifted by its term's place
            column = own[of, k]
            keep = _holds(keys, (phrases[part[of], column] << 32) + start + column)
            of, start = of[keep], start[keep]
            if not len(of):
                break
        starts.append(start)
        which.append(part[of])
    return (np.concatenate(starts), np.concatenate(which)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]


def _search(index: DataFrame, phrases: dict[tuple[bytes, ...], list[str]]) -> DataFrame:
    """Of every document the merged spans of phrases in it (word places), and the items that they belong to."""
    names = sorted({w for p in phrases for w in p})
    sent = index.sparkSession.sparkContext.broadcast((names, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = {w: i for i, w in enumerate(sent.value[0])}
        by_length = defaultdict(list)
        for phrase in sent.value[1]:
            by_length[len(phrase)].append(phrase)
        tables = [(n, of, np.asarray([[vocabulary[w] for w in p] for p in of], np.int64)) for n, of in by_length.items()]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
                first, length, keys = _loaded(row, vocabulary)
                counts = np.asarray(row["n_words"], np.int64)
                base = np.cumsum(counts) - counts + np.arange(len(counts))
                spans, items = defaultdict(list), defaultdict(set)
                for n, of, table in tables:
                    start, which = _intersect(first, length, keys, table)
                    place = np.searchsorted(base, start, "right") - 1
                    for d, s, p in zip(place.tolist(), (start - base[place]).tolist(), which.tolist(), strict=True):
                        spans[d].append((s, s + n))
                        items[d].update(sent.value[1][of[p]])
                begin, end = [[] for _ in counts], [[] for _ in counts]
                for d, own in spans.items():
                    a, b = _merged(*np.asarray(own, np.int64).T)
                    begin[d], end[d] = a.tolist(), b.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(counts), pa.int64()),
                        pa.array(range(len(counts)), pa.int32()),
                        pa.array(row["doc_ids"], pa.string()),
                        pa.array(counts, pa.int64()),
                        pa.array(begin, pa.list_(pa.int32())),
                        pa.array(end, pa.list_(pa.int32())),
                        pa.array([sorted(items[d]) if d in items else [] for d in range(len(counts))], pa.list_(pa.string())),
                    ],
                    ["shard", "place", "doc_id", "n_words", "starts", "ends", "items"],
                )

    return index.mapInArrow(run, _FOUND)


def _united(found: DataFrame) -> DataFrame:
    """One row per document from its rows of several blocks of queries."""
    grouped = found.groupBy("shard", "place", "doc_id", "n_words").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                if r["starts"]:
                    a, b = _merged(np.asarray(r["starts"], np.int64), np.asarray(r["ends"], np.int64))
                    r |= {"starts": a.tolist(), "ends": b.tolist()}
                r["items"] = sorted(set(r["items"]))
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return grouped.mapInArrow(run, _FOUND)


def phrases_of(text: bytes | None, n: int) -> list[tuple[bytes, ...]]:
    own = words(text, ALNUM)
    return [tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))] if own else []


def find_contamination(docs: DataFrame, items: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (shard, place, doc_id, n_words, starts, ends, items), one per document: spans of words inside windows of ``n`` item words."""
    queries = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text")).filter("text is not null")
    size = queries.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    blocks = -(-size // block_bytes) or 1
    index, parts = None, []
    for block in range(blocks):
        phrases: dict[tuple[bytes, ...], list[str]] = defaultdict(list)
        for row in queries.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).toLocalIterator():
            for phrase in dict.fromkeys(phrases_of(row["text"].encode(), n)):
                phrases[phrase].append(row["item"])
        if blocks == 1:  # the index of this one block flows on to its search
            return _search(build_index(docs, id_col, text_col, sorted({w for p in phrases for w in p})), dict(phrases))
        index = stored(build_index(docs, id_col, text_col), "postings") if index is None else index
        parts.append(_search(index, dict(phrases)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return _united(found)


def near(docs: DataFrame, terms: list[str], within: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Proximity search: documents in which all ``terms`` stand in some run of ``within`` words, and the first such run's start."""
    wanted = sorted({w for t in terms for w in words(t.encode(), ALNUM)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = {w: i for i, w in enumerate(wanted)}
        for batch in batches:
            for row in batch.to_pylist():
                first, length, keys = _loaded(row, vocabulary)
                if not wanted or length.min(initial=1) == 0:
                    continue
                counts = np.asarray(row["n_words"], np.int64)
                base = np.cumsum(counts) - counts + np.arange(len(counts))
                rarest = int(np.argmin(length))
                at = keys[first[rarest] : first[rarest] + length[rarest]] & 0xFFFFFFFF
                doc = np.searchsorted(base, at, "right") - 1
                run_start = (at[:, None] - np.arange(within)[::-1]).ravel()  # runs that hold the rarest term
                doc = np.repeat(doc, within)
                keep = run_start >= base[doc]
                for term in range(len(wanted)):
                    low = np.searchsorted(keys, (term << 32) + run_start)
                    low[low == len(keys)] = 0
                    place = keys[low] - (term << 32) - run_start
                    keep &= (place >= 0) & (place < within) & (run_start + place < base[doc] + counts[doc])
                hit, at_first = np.unique(doc[keep], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_ids"][d] for d in hit], pa.string()), pa.array(run_start[keep][at_first] - base[hit], pa.int64())], ["doc_id", "start"])

    return build_index(docs, id_col, text_col, wanted).mapInArrow(run, "doc_id string, start long")


def contaminated(found: DataFrame, share: int = 20) -> DataFrame:
    """The judgement: hit words are at least 1/``share`` of the document's words."""
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return (
        found.withColumn("n_hit", n_hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )
