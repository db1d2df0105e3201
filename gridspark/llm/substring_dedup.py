"""Exact substring dedup by difference-cover anchors.

Windows of ``n`` words are compared over the whole table. Short anchor windows are hashed only at positions whose remainder
modulo a period lies in a difference cover, so two equal windows of ``n`` words hold an anchor at the same place in both,
however they are aligned. Anchors that occur once are dropped; around the others the match is extended to every window of
``n`` words that holds one, and of those the first by (doc_id, start) is kept.

Both steps shuffle packed arrays, cut into buckets of bounded expected size by hash. Each task first settles what it can
see itself, so a hash reaches its bucket once a task, however often it occurs: a passage that a third of all rows hold is
not a hot key. What is found goes back to the documents in packed arrays too.

Defined cases: a null text has no words; a text shorter than a window has none; rows that share an id are one document, and
equal starts in them are not earlier than each other; a null id comes first; columns other than the named ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import light_batches
from .text import BLANK, gram_hashes, joined, release, slices

#: Period and difference cover: every difference modulo 13 is one of two of these places. An anchor has n - 12 words.
PERIOD, COVER = 13, (0, 1, 3, 9)
_PART_BYTES = 3 << 20
#: Bytes of text for a bucket of hashes and for a group of documents.
BUCKET_BYTES, GROUP_BYTES = 8 << 20, 4 << 20
_RECORDS = "bucket int, kind int, doc binary, tag binary, at binary, size binary, hash binary, check binary"
_MARKS = "part int, doc binary, tag binary, at binary, size binary"
_NULL_ID = -(1 << 63)  # before every other id
_SEED = 0x9E6C63D0876A9A47


def _doc_part(doc: np.ndarray, tag: np.ndarray, parts: int) -> np.ndarray:
    """Where a document's texts and marks meet; rows without an id are spread by their text's tag."""
    doc = np.where(doc == _NULL_ID, tag.astype(np.int64), doc)
    return ((doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts


def _packed(bucket: np.ndarray, kind: int, doc: np.ndarray, tag: np.ndarray, at: np.ndarray, size: np.ndarray | None, hash_: np.ndarray | None, check: np.ndarray | None) -> list[tuple]:
    """A row for each bucket, with its records in the given order."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    columns = [(doc, np.int64), (tag, np.uint16), (at, np.uint32), (size, np.uint32), (hash_, np.uint64), (check, np.uint32)]
    sorted_ = [None if c is None else c[order].astype(t) for c, t in columns]
    ends = np.append(first[1:], len(order))
    return [(int(b), kind, *(None if c is None else c[i:j].tobytes() for c in sorted_)) for b, i, j in zip(names, first, ends, strict=True)]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if t == "binary" else pa.int32()) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _runs(doc: np.ndarray, tag: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Successive places of one document as (doc, tag, first place, number of places)."""
    if not len(at):
        return doc, tag, at, at
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(new)
    return doc[first], tag[first], at[first], np.diff(np.append(first, len(at)))


def _released(run: Callable) -> Callable:
    """``run`` for one table, handing freed memory back afterwards."""

    def then(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release()

    return then


def _both_released(run: Callable) -> Callable:
    def then(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            release()

    return then


def _texts(table: pa.Table | pa.RecordBatch) -> list[bytes | None]:
    return table.column("text").cast(pa.binary()).to_pylist()


def _layout(counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, place in it) of each word where a run of ``n`` words of one document starts."""
    of = np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))
    own = np.maximum(counts - n + 1, 0)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(own) - own, own)


def _anchors(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    width = n - PERIOD + 1
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", _PART_BYTES):
            hashes, counts = joined(_texts(part), BLANK)
            of, at = _layout(counts, width)
            keep = cover[at % PERIOD]
            of, at = of[keep], at[keep]
            grams = gram_hashes(hashes, width)[(np.cumsum(counts) - counts)[of] + at]
            doc, tag = part.column("doc_id").to_numpy()[of], part.column("tag").to_numpy()[of]
            bucket = ((grams >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(grams, kind="stable")
            same = np.zeros(len(grams) + 1, bool)
            same[1:-1] = grams[order][1:] == grams[order][:-1]
            first, repeated = order[~same[:-1]], order[same[:-1] | same[1:]]
            seen_twice = np.zeros(len(grams), bool)
            seen_twice[repeated] = True
            # one record for each hash: `check` tells that the task itself has it more than once; those are marked here
            first.sort()
            rows = _packed(bucket[first], 0, doc[first], tag[first], at[first], None, grams[first], seen_twice[first])
            repeated.sort()
            rows += _packed(_doc_part(doc[repeated], tag[repeated], buckets), 1, doc[repeated], tag[repeated], at[repeated], None, None, None)
            yield _batch(rows, _RECORDS)

    return docs.mapInArrow(run, _RECORDS)


def _column(table: pa.Table, name: str, kind: type, keep: np.ndarray) -> np.ndarray:
    rows = table.column(name).filter(pa.array(keep)).to_pylist()
    return np.frombuffer(b"".join(x for x in rows if x), kind)


def _sent_back(parts: int, doc: np.ndarray, tag: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[tuple]:
    return [(r[0], *r[2:6]) for r in _packed(_doc_part(doc, tag, parts), 0, doc, tag, at, size, None, None)]


def _passed_on(table: pa.Table, parts: int) -> list[tuple]:
    keep = table.column("kind").to_numpy() == 1
    doc, tag, at, size = (_column(table, c, t, keep) for c, t in (("doc", np.int64), ("tag", np.uint16), ("at", np.uint32), ("size", np.uint32)))
    return _sent_back(parts, doc, tag, at, size if len(size) else np.ones(len(at)))


def _repeated(records: DataFrame, parts: int) -> DataFrame:
    """Anchors that occur more than once in the table."""

    def run(table: pa.Table) -> pa.Table:
        keep = table.column("kind").to_numpy() == 0
        doc, tag, at, grams, twice = (_column(table, c, t, keep) for c, t in (("doc", np.int64), ("tag", np.uint16), ("at", np.uint32), ("hash", np.uint64), ("check", np.uint32)))
        order = np.argsort(grams, kind="stable")
        same = np.zeros(len(grams) + 1, bool)
        same[1:-1] = grams[order][1:] == grams[order][:-1]
        hit = order[(same[:-1] | same[1:]) & (twice[order] == 0)]
        hit.sort()
        rows = _sent_back(parts, doc[hit], tag[hit], at[hit], np.ones(len(hit)))
        return pa.Table.from_batches([_batch(rows + _passed_on(table, parts), _MARKS)])

    return records.groupBy("bucket").applyInArrow(_released(run), _MARKS)


def _marked(texts: pa.Table, marks: pa.Table, counts: np.ndarray, before: int, after: int) -> np.ndarray:
    """Per word of all texts whether some mark (doc, tag, at, size) covers it, from ``before`` places earlier to ``after`` later."""
    base = np.cumsum(counts) - counts
    steps = np.zeros(int(counts.sum()) + 1, np.int64)
    keep = np.ones(marks.num_rows, bool)
    doc, tag, at, size = (_column(marks, c, t, keep) for c, t in (("doc", np.int64), ("tag", np.uint16), ("at", np.uint32), ("size", np.uint32)))
    own_doc, own_tag = texts.column("doc_id").to_numpy(), texts.column("tag").to_numpy().astype(np.uint16)
    order = np.lexsort((own_tag, own_doc))
    key = np.empty(len(doc), [("d", np.int64), ("t", np.uint16)])
    key["d"], key["t"] = doc, tag
    own = np.empty(len(own_doc), key.dtype)
    own["d"], own["t"] = own_doc[order], own_tag[order]
    low, high = np.searchsorted(own, key, "left"), np.searchsorted(own, key, "right")
    for shift in range(int((high - low).max(initial=0))):  # rows that repeat an id and text share their marks
        has = low + shift < high
        row = order[(low + shift)[has]]
        start = np.maximum(at[has].astype(np.int64) - before, 0)
        end = np.minimum(at[has].astype(np.int64) + size[has] + after, counts[row])
        ok = start < end
        np.add.at(steps, (base[row] + start)[ok], 1)
        np.add.at(steps, (base[row] + end)[ok], -1)
    return np.cumsum(steps[:-1]) > 0


def _windows(docs: DataFrame, anchors: DataFrame, n: int, buckets: int) -> DataFrame:
    """Windows around repeated anchors: the first of each in the group as a record, the others as runs that are no first."""

    def run(texts: pa.Table, marks: pa.Table) -> pa.Table:
        if not texts.num_rows or not marks.num_rows:
            return pa.Table.from_batches([_batch([], _RECORDS)])
        hashes, counts = joined(_texts(texts), BLANK)
        near = _marked(texts, marks, counts, PERIOD - 1, 0)
        of, at = _layout(counts, n)
        word = (np.cumsum(counts) - counts)[of] + at
        keep = near[word]
        of, at, word = of[keep], at[keep], word[keep]
        grams, check = gram_hashes(hashes, n)[word], (gram_hashes(hashes, n, _SEED)[word] >> np.uint64(32)).astype(np.uint32)
        doc, tag = texts.column("doc_id").to_numpy()[of], texts.column("tag").to_numpy()[of]
        order = np.lexsort((at, doc, check, grams))
        same = np.concatenate(([False], (grams[order][1:] == grams[order][:-1]) & (check[order][1:] == check[order][:-1]))) if len(order) else np.zeros(0, bool)
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))  # the group's first, by order
        later = same & ((doc[order] != doc[order][lead]) | (at[order] != at[order][lead]))
        first, rest = np.sort(order[~later]), order[later]
        rest = rest[np.lexsort((at[rest], of[rest]))]
        bucket = ((grams >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        rows = _packed(bucket[first], 0, doc[first], tag[first], at[first], None, grams[first], check[first])
        d, t, a, size = _runs(doc[rest], tag[rest], at[rest])
        rows += _packed(_doc_part(d, t, buckets), 1, d, t, a, size, None, None)
        return pa.Table.from_batches([_batch(rows, _RECORDS)])

    return docs.groupBy("part").cogroup(anchors.groupBy("part")).applyInArrow(_both_released(run), _RECORDS)


def _later(records: DataFrame, parts: int) -> DataFrame:
    """Windows whose words also start earlier."""

    def run(table: pa.Table) -> pa.Table:
        keep = table.column("kind").to_numpy() == 0
        doc, tag, at, grams, check = (_column(table, c, t, keep) for c, t in (("doc", np.int64), ("tag", np.uint16), ("at", np.uint32), ("hash", np.uint64), ("check", np.uint32)))
        order = np.lexsort((at, doc, check, grams))
        same = np.concatenate(([False], (grams[order][1:] == grams[order][:-1]) & (check[order][1:] == check[order][:-1]))) if len(order) else np.zeros(0, bool)
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        hit = order[same & ((doc[order] != doc[order][lead]) | (at[order] != at[order][lead]))]
        hit = hit[np.lexsort((at[hit], tag[hit], doc[hit]))]
        rows = _sent_back(parts, *_runs(doc[hit], tag[hit], at[hit].astype(np.int64)))
        return pa.Table.from_batches([_batch(rows + _passed_on(table, parts), _MARKS)])

    return records.groupBy("bucket").applyInArrow(_released(run), _MARKS)


def dedup_substrings(docs: DataFrame, n: int = 20, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), one per row of ``docs``; with ``keep_text`` its columns instead, the text cut to the kept words.

    ``n`` must be over the period; words in windows whose sequence starts earlier too are removed.
    """
    if n < PERIOD + 1:
        raise ValueError(f"n must be at least {PERIOD + 1}")
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("b")).first()["b"]
    buckets, parts = max(1, size // BUCKET_BYTES), max(1, size // GROUP_BYTES)
    others = [c for c in docs.columns if c not in (id_col, text_col)] if keep_text else []
    doc_id = F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("doc_id")
    base = light_batches(docs).select(doc_id, F.col(text_col).alias("text"), F.pmod(F.xxhash64(F.col(text_col)), F.lit(1 << 16)).cast("int").alias("tag"), F.col(id_col).alias("id_"), *(F.struct(*others).alias("others_") for _ in others[:1]))

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = _doc_part(batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy(zero_copy_only=False), parts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], [*batch.schema.names, "part"])

    texts = base.mapInArrow(parted, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", part int")
    anchors = _repeated(_anchors(base.select("doc_id", "text", "tag"), n, buckets), parts)
    later = _later(_windows(texts, anchors, n, buckets), parts)
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`id_` {id_type}", "`text` string", *(f"`others_` {base.schema['others_'].dataType.simpleString()}" for _ in others[:1]), "n_words long", "n_removed long"]) if keep_text else f"id_ {id_type}, n_words long, n_removed long, kept_sha256 string"

    def cut(own: pa.Table, marks: pa.Table) -> pa.Table:
        raw = _texts(own)
        words = [t.translate(BLANK).split() if t else [] for t in raw]
        counts = np.asarray([len(w) for w in words], np.int64)
        gone = _marked(own, marks, counts, 0, n - 1) if own.num_rows and marks.num_rows else np.zeros(int(counts.sum()), bool)
        ends = np.cumsum(counts)
        removed, kept = [], []
        for text, w, end in zip(raw, words, ends.tolist(), strict=True):
            flags = gone[end - len(w) : end]
            k = int(flags.sum())
            removed.append(k)
            if keep_text and not k:
                kept.append(text)
                continue
            kept.append(b" ".join(w if not k else [x for x, f in zip(w, flags.tolist(), strict=True) if not f]))
        tail = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        if keep_text:
            head = [own.column("id_"), pa.array(kept, pa.binary()).cast(pa.string()), *([own.column("others_")] if others else [])]
            return pa.Table.from_arrays([*head, *tail], ["id_", "text", *(["others_"] if others else []), "n_words", "n_removed"])
        return pa.Table.from_arrays([own.column("id_"), *tail, pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], ["id_", "n_words", "n_removed", "kept_sha256"])

    out = texts.groupBy("part").cogroup(later.groupBy("part")).applyInArrow(_both_released(cut), schema)
    if not keep_text:
        return out.select(F.col("id_").cast("long").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
    columns = {id_col: F.col("id_"), text_col: F.col("text")} | {c: F.col("others_").getField(c) for c in others}
    return out.filter("n_words = 0 or n_removed < n_words").select(*(columns[c].alias(c) for c in docs.columns))
