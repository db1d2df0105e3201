"""Exact n-gram Jaccard self-join by T-occurrence search over inverted lists.

Two sets of sizes a and b reach a Jaccard similarity t only if they share T = ceil(t / (1 + t) * (a + b)) shingles. All
lists of a document's shingles are ordered alike in the whole table, frequent ones last (the long lists). A partner must
occur in at least one of a document's a - ceil(t * a) + 1 shortest lists, so only those are shuffled to find who has to be
searched for whom; a meeting in a list also tells how many shingles the two can still share from there on, and those that
cannot reach T by that never become a pair. Nor do those whose parity bits (each shingle flips one of a number of bits)
differ in more places than two sets that share T could: first a fixed number of bits, then about two for each shingle.

The documents that a document has to be searched in then meet in one place, in parts of bounded size, and DivideSkip runs
there: the T - 1 longest of the query's lists over these documents are set aside, the short ones are heap-merged with
counts, and what can still reach T is looked up in the long lists by binary search. That gives the exact overlap.

A group of near copies never yields all its pairs: first every list is searched for two of its documents only (the first
id and the one with the least share of rarer shingles), the links found are closed to components, and then only documents of
different components are searched for each other, which a list that lies in one component has none of. Exact copies are
one class from the start.

Rows are the vertices: ids serve as their names where none is null or occurs twice, and else rows are numbered first.

Defined cases: a null text and a text without words have an empty set and are linked with nothing; a text of fewer words
than a shingle has its whole sequence as its one shingle; rows that share an id or have none are judged each by its own text,
so they link nothing but what their texts do; a component's id is the smallest id in it that is not null, null if it has
none; columns other than the named ones are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import light_batches, stored, unused
from .text import BLANK, BLANK_LOWER, gram_hashes, joined, slices

_PART_BYTES = 2 << 20
#: Bytes of text for a bucket of postings.
BUCKET_BYTES = 8 << 20
#: A shingle counts as frequent from so many documents in one task and in all, and so many frequent ones are ordered by count.
TASK_COUNT, TOTAL_COUNT, FREQUENT = 8, 48, 200_000
#: Rows of 16 bytes up to which a table of ids is broadcast to the texts; beyond, the texts are shuffled to it.
BROADCAST_ROWS = 500_000
#: Parity bits of a set, and the most of its finer ones.
PARITY_BITS, MOST_BITS = 2048, 1 << 17


def shingle_sets(texts: list[bytes | None], n: int, table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted in each document; number of each document's)."""
    hashes, counts = joined(texts, table)
    base = np.cumsum(counts) - counts
    own = np.where(counts >= n, counts - n + 1, 0)
    of = np.repeat(np.arange(len(counts)), own)
    grams = gram_hashes(hashes, n)[base[of] + np.arange(len(of)) - np.repeat(np.cumsum(own) - own, own)] if len(of) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = [gram_hashes(hashes[base[d] : base[d] + counts[d]], int(counts[d]), 0xA0761D6478BD642F + 2 * int(counts[d]))[0] for d in short]
        of, grams = np.concatenate((of, short)), np.concatenate((grams, np.asarray(whole, np.uint64)))
    order = np.lexsort((grams, of))
    of, grams = of[order], grams[order]
    keep = np.ones(len(of), bool)
    keep[1:] = (of[1:] != of[:-1]) | (grams[1:] != grams[:-1])
    return grams[keep], np.bincount(of[keep], minlength=len(counts))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return light_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _digest(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums of each set's shingles, mixed in two ways."""
    ends = np.cumsum(sizes)
    out = []
    for k in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9):
        x = grams ^ np.uint64(k)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(k)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x ^ (x >> np.uint64(32)), dtype=np.uint64)))
        out.append((sums[ends] - sums[ends - sizes]).view(np.int64))
    return out[0], out[1]


def _parity(grams: np.ndarray, sizes: np.ndarray, widths: np.ndarray) -> pa.ListArray:
    """Each set's parity bits, 64 in a number: sets differ in at least as many shingles as their bits differ.

    A set has ``widths`` bits, a power of two from 64; its halves folded by exclusive or are its bits at half the width.
    """
    start = np.cumsum(widths) - widths
    place = (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    bit = start.repeat(sizes) + (place.astype(np.int64) & (widths.repeat(sizes) - 1))
    flips = np.zeros(int(widths.sum()), np.uint8)
    found, times = np.unique(bit, return_counts=True)
    flips[found] = times & 1
    return pa.ListArray.from_arrays(np.append(start, len(flips)).astype(np.int32) // 64, np.packbits(flips).view(np.int64))


def _widths(sizes: np.ndarray) -> np.ndarray:
    """Two to four bits for each shingle."""
    return np.minimum(1 << np.ceil(np.log2(np.maximum(2 * sizes, 64))).astype(np.int64), MOST_BITS)


def _summaries(rows: DataFrame, n: int, table: bytes) -> DataFrame:
    """kind 0: (doc_id, size, digest, parity bits) of each row; kind 1: (shingle, count) of what is frequent in a task, copies counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, total, seen = ["kind", "key", "n", "s1", "s2", "bits", "fine"], Counter(), set()
        for part in slices(batches, "text", _PART_BYTES):
            grams, sizes = shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), n, table)
            s1, s2 = _digest(grams, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sizes), np.int32)), part.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(s1), pa.array(s2), _parity(grams, sizes, np.full(len(sizes), PARITY_BITS)), _parity(grams, sizes, _widths(sizes))], names)
            new = np.asarray([x not in seen and not seen.add(x) for x in s1.tolist()], bool)
            found, times = np.unique(grams[np.repeat(new, sizes)], return_counts=True)
            total.update(dict(zip(found[times > 1].tolist(), times[times > 1].tolist(), strict=True)))
        often = [(g, c) for g, c in total.items() if c >= TASK_COUNT]
        zero = pa.array(np.zeros(len(often), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(often), np.int32)), pa.array(np.asarray([g for g, _ in often], np.uint64).view(np.int64)), pa.array(np.asarray([c for _, c in often], np.int64)), zero, zero, *[pa.nulls(len(often), pa.list_(pa.int64()))] * 2], names)

    return rows.mapInArrow(run, "kind int, key long, n long, s1 long, s2 long, bits array<long>, fine array<long>")


def _prefix(a: np.ndarray, t: Fraction) -> np.ndarray:
    return a - (a * t.numerator + t.denominator - 1) // t.denominator + 1


def _postings(rows: DataFrame, n: int, table: bytes, t: Fraction, frequent: np.ndarray, buckets: int) -> DataFrame:
    """Packed (place in the common order, document, size, position in the document's order) of each document's shortest lists, by bucket."""
    sent = rows.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.sort(sent.value)
        rank = np.argsort(sent.value, kind="stable")
        for part in slices(batches, "text", _PART_BYTES):
            grams, sizes = shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), n, table)
            place = grams >> np.uint64(1)
            if len(known) and len(grams):
                at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
                hit = known[at] == grams
                place[hit] = np.uint64(1 << 63) + rank[at[hit]].astype(np.uint64)
            of = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((place, of))
            position = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            first = position < np.repeat(_prefix(sizes, t), sizes)
            of, place, position = of[first], place[order][first], position[first].astype(np.uint32)
            bucket = ((place * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            names, starts = np.unique(bucket[order], return_index=True)
            doc, size = part.column("doc_id").to_numpy()[of], sizes[of].astype(np.uint32)
            ends = np.append(starts[1:], len(order)) if len(order) else starts
            packed = [(int(b), *(c[order[i:j]].tobytes() for c in (place, doc, size, position))) for b, i, j in zip(names, starts, ends, strict=True)]
            columns = list(zip(*packed, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["bucket", "place", "doc", "size", "at"])

    return rows.mapInArrow(run, "bucket int, place binary, doc binary, size binary, at binary")


def _lists(postings: DataFrame, t: Fraction) -> DataFrame:
    """kind 0: (place, doc_id, n, i, hub) of the lists that hold more than one document; i: the document's shingles before this one.

    kind 1: pairs (place, doc_id) of a list's first or hub document and each other one that it can reach ``t`` with from here on.
    """

    def run(table: pa.Table) -> pa.Table:
        place, doc, size, at = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("place", np.uint64), ("doc", np.int64), ("size", np.uint32), ("at", np.uint32)))
        order = np.argsort(place, kind="stable")
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = place[order][1:] == place[order][:-1]
        keep = order[same[:-1] | same[1:]]
        place, doc, size, at = place[keep], doc[keep], size[keep].astype(np.int64), at[keep].astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(place))))
        heads = [np.lexsort((doc, place))[first][of], np.lexsort((doc, at / size, place))[first][of]]
        x, y = np.concatenate(heads), np.tile(np.arange(len(place)), 2)
        need = -(-t.numerator * (size[x] + size[y]) // (t.numerator + t.denominator))
        ok = (doc[x] != doc[y]) & (np.minimum(size[x] - at[x], size[y] - at[y]) >= need)
        pairs = np.unique(np.stack((doc[x][ok], doc[y][ok])), axis=1) if ok.any() else np.zeros((2, 0), np.int64)
        zero = np.zeros(pairs.shape[1], np.int64)
        both = lambda own, other: pa.array(np.concatenate((own, other)))
        kind = np.repeat(np.asarray([0, 1], np.int32), [len(place), len(zero)])
        return pa.table([pa.array(kind), both(place.view(np.int64), pairs[0]), both(doc, pairs[1]), both(size, zero), both(at, zero), both(doc[heads[1]], zero)], ["kind", "place", "doc_id", "n", "i", "hub"])

    return postings.groupBy("bucket").applyInArrow(run, "kind int, place long, doc_id long, n long, i long, hub long")


def _need(t: Fraction):
    """T of two sets of these sizes."""
    return F.ceil((F.col("n_x") + F.col("n_y")) * t.numerator / (t.numerator + t.denominator) - 1e-9)


def divide_skip(query: np.ndarray, sets: list[np.ndarray], t: Fraction) -> np.ndarray:
    """Which of ``sets`` reach similarity ``t`` with ``query`` (sorted, distinct): T-occurrence search over their lists."""
    sizes = np.asarray([len(own) for own in sets], np.int64)
    need = -(-t.numerator * (len(query) + sizes) // (t.numerator + t.denominator))
    of, keys = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(keys, kind="stable")
    of, keys = of[order], keys[order]  # list after list, each in the order of its documents
    start, end = np.searchsorted(keys, query), np.searchsorted(keys, query, "right")
    n_long = min(len(query), int(need.min()) - 1)
    by_length = np.argsort(end - start, kind="stable")
    short, long = by_length[: len(query) - n_long], by_length[len(query) - n_long :]
    count = np.zeros(len(sets), np.int64)
    for document, times in groupby(heapq.merge(*(of[start[k] : end[k]].tolist() for k in short if start[k] < end[k]))):
        count[document] = sum(1 for _ in times)
    found = np.flatnonzero((count > 0) & (count + n_long >= need))
    if len(found) and n_long:
        lengths = (end - start)[long]
        place = np.arange(lengths.sum()) + np.repeat(start[long] - np.cumsum(lengths) + lengths, lengths)
        entries = np.repeat(np.arange(n_long), lengths) * len(sets) + of[place]  # ascending within and across the long lists
        probes = (np.arange(n_long)[:, None] * len(sets) + found).ravel()
        at = np.searchsorted(entries, probes)
        hit = (at < len(entries)) & (entries[np.minimum(at, len(entries) - 1)] == probes) if len(entries) else np.zeros(len(probes), bool)
        count[found] += hit.reshape(n_long, len(found)).sum(axis=0)
    return found[count[found] >= need[found]]


def _texts_of(rows: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    """The rows whose id is listed, with the listed columns: the ids go to the texts while they are few, else both are shuffled."""
    return rows.join(F.broadcast(ids) if n_ids <= BROADCAST_ROWS else ids, "doc_id")


def _verified(rows: DataFrame, pairs: DataFrame, n: int, table: bytes, t: Fraction) -> DataFrame:
    """The pairs (x, y) whose exact similarity reaches ``t``. A document that is in many pairs is compared in several parts."""
    pairs = stored(pairs.select("x", "y"), "pairs")
    n_pairs = pairs.count()
    per_x = pairs.groupBy("x").agg(F.count("*").alias("m"))
    parts_of = (F.col("m") / 64).cast("int") + 1  # salts of x, the same for members and leaders
    salt = lambda c: F.pmod(F.xxhash64(c), parts_of).cast("int")
    spread = pairs.join(F.broadcast(per_x) if n_pairs <= BROADCAST_ROWS else per_x, "x")
    members = spread.select(F.col("y").alias("doc_id"), "x", salt("y").alias("salt"), F.lit(1).alias("side"))
    leaders = per_x.select(F.col("x").alias("doc_id"), "x", F.explode(F.sequence(F.lit(0), parts_of - 1)).alias("salt"), F.lit(0).alias("side"))
    wanted = members.unionByName(leaders)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    meeting = _texts_of(rows, wanted, 2 * n_pairs).repartition(parts, "x", "salt").sortWithinPartitions("x", "salt", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, queries = None, []
        for part in slices(batches, "text", _PART_BYTES):
            grams, sizes = shingle_sets(part.column("text").cast(pa.binary()).to_pylist(), n, table)
            own = np.split(grams, np.cumsum(sizes)[:-1])
            ids, found = part.column("doc_id").to_pylist(), []
            met = zip(part.column("x").to_pylist(), part.column("salt").to_pylist(), part.column("side").to_pylist(), range(len(ids)), strict=True)
            for key, rows_ in groupby(met, key=lambda r: r[:2]):
                if key != now:
                    now, queries = key, []
                sides = [(side, k) for _, _, side, k in rows_ if sizes[k]]
                queries += [own[k].copy() for side, k in sides if side == 0]  # one, but for repeated rows
                members = [k for side, k in sides if side == 1]
                if members:
                    linked = {members[m] for query in queries for m in divide_skip(query, [own[k] for k in members], t).tolist()}
                    found += [(key[0], ids[k]) for k in sorted(linked)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["x", "y"])

    return stored(meeting.select("doc_id", "text", "x", "salt", "side").mapInArrow(run, "x long, y long").distinct(), "links")


def components(edges: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """(doc_id, component) of all ends of edges: alternating large-star and small-star steps until nothing changes.

    The number of steps grows with the logarithm of the number of edges, so it needs no limit of its own.
    """
    edges = edges.select(F.col(x).alias("u"), F.col(y).alias("v")).filter("u != v").distinct()
    state, was = None, ()
    while state != was:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("a"), "u", "m")
        small = small.select(F.col("a").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = stored(small, "stars")
        was, state = state, edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("doc_id"), F.col("v").alias("component"))).distinct()


def _across(lists: DataFrame, found: DataFrame, t: Fraction) -> DataFrame:
    """Pairs (x, y) of different components that can reach ``t`` going by the list that they meet in first.

    A document that has i shingles before the list's can only reach sets of at most ``far`` shingles from there. So the larger
    set's size lies between the smaller one's and its ``far``, which bands of sizes find without looking at other pairs; the
    component of the list's hub is not joined to itself.
    """
    few = found.count() <= BROADCAST_ROWS
    of = lambda key, name: F.broadcast(found.select(F.col("doc_id").alias(key), F.col("component").alias(name))) if few else found.select(F.col("doc_id").alias(key), F.col("component").alias(name))
    far = F.floor(((F.col("n") - F.col("i")) * (t.numerator + t.denominator) - F.col("n") * t.numerator) / t.numerator)
    band = lambda size: F.floor(F.log(size) * 4).cast("int")  # noqa: E731  about a quarter wide
    placed = lists.join(of("doc_id", "own"), "doc_id", "left").join(of("hub", "hubs"), "hub", "left")
    is_major = F.coalesce(F.col("own") == F.col("hubs"), F.lit(False))  # of the hub's component, if it has one
    placed = placed.select("place", "doc_id", "n", F.col("own").alias("c"), is_major.alias("is_major"), F.col("hubs").isNotNull().alias("has_major"), far.alias("far"))
    asks = placed.filter("far >= n").select("place", F.explode(F.sequence(band(F.col("n")), band(F.col("far")))).alias("band"), F.col("is_major").alias("for_major"), F.col("doc_id").alias("x"), F.col("n").alias("n_x"), F.col("c").alias("c_x"), F.col("far").alias("far_x"))
    sought = F.when(F.col("has_major") & ~F.col("is_major"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    holds = placed.select("place", band(F.col("n")).alias("band"), F.explode(sought).alias("for_major"), F.col("doc_id").alias("y"), F.col("n").alias("n_y"), F.col("c").alias("c_y"), F.col("far").alias("far_y"))
    met = asks.join(holds, ["place", "band", "for_major"]).filter("coalesce(c_x != c_y, true) and x != y and n_y between n_x and far_x and n_x <= far_y and (n_x < n_y or x < y)")
    return met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _close(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """The pairs whose parity bits allow for the overlap they need, by few bits and then by more."""
    half = lambda c, k: F.slice(c, (F.size(c) / 2 * k + 1).cast("int"), (F.size(c) / 2).cast("int"))
    fold = lambda c, other: F.when(F.size(c) > F.size(other), F.zip_with(half(c, 0), half(c, 1), lambda a, b: a.bitwiseXOR(b))).otherwise(F.col(c))
    for bits in ("bits", "fine"):
        pairs = stored(pairs, "met")
        few = pairs.count() <= BROADCAST_ROWS
        own = lambda v: sets.select(F.col("doc_id").alias(v), F.col("n").alias(f"n_{v}"), F.col(bits).alias(f"bits_{v}")).join(F.broadcast(pairs) if few else pairs, v)  # noqa: B023, E731
        both = own("x").join(own("y"), ["x", "y"])  # widths differ by one fold at most, as sizes differ by less than half
        differ = F.aggregate(F.zip_with(fold("bits_x", "bits_y"), fold("bits_y", "bits_x"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, k: total + k)
        pairs = both.filter(F.col("n_x") + F.col("n_y") - differ >= 2 * _need(t)).select("x", "y").distinct()
    return pairs


def _named(docs: DataFrame, id_col: str) -> bool:
    """Whether every row has an id of its own."""
    ids = docs.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.count("*").alias("n"))
    return ids.filter("id is null or n > 1").isEmpty()


def similarity_classes(docs: DataFrame, n: int = 4, similarity: str = "0.85", id_col: str = "doc_id", text_col: str = "text", lower: bool = True) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, n_links), one per row of ``docs``; n_links counts the links of its class that were looked at, as the closure needs them."""
    if _named(docs, id_col):
        return _classes(docs, n, similarity, id_col, text_col, lower)
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(own, "numbered")
    found = stored(_classes(rows, n, similarity, "row", "text", lower).withColumnRenamed("doc_id", "row").join(rows.select("row", "id"), "row"), "classes")
    least = found.groupBy("component_id").agg(F.min("id").alias("least"), F.count("*").alias("m")).filter("m > 1 or least is not null").select("component_id", "least")
    return found.join(least, "component_id", "left").select(F.col("id").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"), "n_links")


def _classes(docs: DataFrame, n: int, similarity: str, id_col: str, text_col: str, lower: bool = True) -> DataFrame:
    """``similarity_classes`` for rows with ids of their own."""
    t, table = Fraction(similarity), BLANK_LOWER if lower else BLANK
    rows = _rows(docs, id_col, text_col)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("b")).first()["b"]
    summaries = stored(_summaries(rows, n, table), "sets")
    sets = summaries.filter("kind = 0").select(F.col("key").alias("doc_id"), "n", "s1", "s2", "bits", "fine")
    top = summaries.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("c")).filter(F.col("c") >= TOTAL_COUNT).orderBy(F.desc("c"), "key").limit(FREQUENT)
    frequent = np.asarray([r["key"] for r in top.collect()][::-1], np.int64).view(np.uint64)  # at most FREQUENT numbers

    # one document stands for each set
    classes = stored(sets.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    chosen = _texts_of(rows, reps, classes.count())
    buckets = max(1, size // BUCKET_BYTES)
    met = stored(_lists(_postings(chosen, n, table, t, frequent, buckets), t), "lists")
    shown, known = met.filter("kind = 0").drop("kind"), sets.filter("n > 0")

    # first round: each list against two of its documents
    stars = met.filter("kind = 1").select(F.col("place").alias("x"), F.col("doc_id").alias("y")).distinct()
    links = _verified(rows, _close(stars, known, t), n, table, t)
    found = stored(components(links), "components")

    # second round: documents of different components that meet in a list
    across = _close(_across(shown, found, t), known, t)
    more = _verified(rows, across, n, table, t)
    every = links.unionByName(more).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    grown = found.select(F.col("component").alias("x"), F.col("doc_id").alias("y")).unionByName(more)  # the first closure stands for its links
    final = found if more.isEmpty() else components(grown)
    degree = every.select(F.explode(F.array("x", "y")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))

    label = classes.join(final.withColumnRenamed("doc_id", "rep"), "rep", "left").join(degree, "rep", "left")
    label = label.select("n", "s1", "s2", F.coalesce("component", "rep").alias("component"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    member = sets.drop("bits", "fine").join(label, ["n", "s1", "s2"], "left")
    return member.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def first_of_groups(docs: DataFrame, n: int = 4, similarity: str = "0.85", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of the smallest id of each group of near copies, null ids last; rows without words stay, repeated ones once.

    Rows are told apart by a number of their own, so ids may be null or shared by several texts.
    """
    row = unused(docs.columns, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = _classes(rows.select(row, F.col(text_col).alias("text")), n, similarity, row, "text").select(F.col("doc_id").alias("row_"), "n_shingles", "component_id")
    known = rows.select(F.col(row).alias("row_"), F.col(id_col).alias("id_"), F.md5(F.col(text_col).cast("binary")).alias("text_"))
    of = F.when(F.col("n_shingles") > 0, F.struct(F.col("component_id").alias("c"), F.lit(None).cast(docs.schema[id_col].dataType).alias("id"), F.lit(None).cast("string").alias("t")))
    of = of.otherwise(F.struct(F.lit(None).cast("long").alias("c"), F.col("id_").alias("id"), F.col("text_").alias("t")))
    grouped = stored(known.join(classes, "row_").select(F.to_json(of).alias("group_"), F.struct(F.col("id_").isNull().alias("last"), "id_", "row_").alias("place_")), "grouped")
    many = stored(grouped.groupBy("group_").agg(F.min("place_").alias("first_"), F.count("*").alias("m_")).filter("m_ > 1").select("group_", "first_.row_"), "many")
    few = lambda df: F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    gone = stored(grouped.select("group_", F.col("place_.row_").alias("own_")).join(few(many), "group_").filter("own_ != row_").select(F.col("own_").alias(row)), "gone")
    return rows.join(few(gone), row, "left_anti").select(*docs.columns)


def keep_first(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that another row of their component, of a smaller id, stands for; repeated rows once.

    For ids that name one text each and are not null, as ``classes`` knows rows by id only; ``first_of_groups`` takes any.
    """
    classes = stored(classes.select("doc_id", "component_id"), "kept")
    gone = classes.filter("component_id != doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    left = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, id_col, "left_anti").select(*docs.columns)
    twice = classes.groupBy(F.col("doc_id").alias(id_col)).count().filter("count > 1").select(id_col)
    if twice.isEmpty():
        return left
    once = left.join(twice, id_col, "left_semi").dropDuplicates([id_col, text_col])
    return left.join(twice, id_col, "left_anti").unionByName(once)
