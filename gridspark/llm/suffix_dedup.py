"""Removal of all repeated byte strings of ``n`` bytes, by sorting suffixes that are compared through hashes.

Prefix hashes (polynomial, modulo 2**64) give the hash of any piece of a text in constant time, so the common extension of two
suffixes is found by binary search, and a comparison costs a logarithm of its length. A mergesort with such comparisons brings
suffixes with a common extension of ``n`` bytes next to each other. What the hashes call equal is then compared byte by byte,
and a part of the table where that fails is done again with plain byte strings.

Only suffixes that can have a partner are sorted, and only with those that can be it. Of each window of ``n`` bytes the shorter
gram of least hash, the leftmost of equal ones, is its anchor: equal windows have equal anchors in equal places. Successive
windows with one anchor are a run. Grams that are an anchor once in the whole table are dropped; runs around the others go to
the bucket of their gram, with the bytes that they cover, and their windows are sorted there.

Texts meet first: of equal texts all are removed whole, and one stands for them in the search. A part of the table sends equal
runs once. A gram that anchors more than ``HOT`` runs is no key of a bucket: its windows are spread by digests of 128 bits of
their own bytes. Every shuffle but that of the texts moves packed arrays.

Defined cases: a null text is empty; a text shorter than ``n`` is kept; every row is a document of its own, so rows that repeat
an id and text remove each other like other copies; null ids are spread over the parts; columns other than the named ones are
ignored. Texts are equal if their SHA-256 is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import light_batches
from .text import mix, power, release

#: Bytes of text for a group of documents and for a bucket of hashes, and for a sort.
GROUP_BYTES, BUCKET_BYTES, SORT_BYTES = 4 << 20, 16 << 20, 1 << 19
#: Runs around a gram beyond which its windows are spread by their own digests.
HOT = 4096
_PLACE = 20  # bits of a place in a piece of a part
_PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_ANCHORS = "bucket int, part int, a binary, n binary"
_REPLIES = "part int, kind int, a binary, copy string, home int"
_RUNS = "bucket int, part int, kind int, a binary, b binary, doc binary, at binary, size binary, twice binary, text binary"
_MARKS = "part int, doc binary, at binary, size binary, copy string"


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of data[i:j] is (h[j] - h[i]) * power(_INVERSE)[i]."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power(_BASE, len(data)), out=out[1:])
    return out


def common_extension(hashes: np.ndarray, inverse: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """The length, up to ``most``, of what the suffixes at ``i`` and ``j`` have in common, by binary search."""
    low, high = np.zeros(len(i), np.int64), np.full(len(i), most + 1)  # low agree, high don't
    hi, hj, pi, pj = hashes[i], hashes[j], inverse[i], inverse[j]
    for _ in range(int(most + 1).bit_length()):
        middle = (low + high) >> 1
        same = (hashes[i + middle] - hi) * pi == (hashes[j + middle] - hj) * pj
        low, high = np.where(same, middle, low), np.where(same, high, middle)
    return low


def sorted_suffixes(data: np.ndarray, hashes: np.ndarray, start: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """An order of the suffixes at ``start`` that sorts those of each group by their first ``n`` bytes.

    ``of`` numbers the groups and is sorted; all suffixes have ``n`` bytes. A mergesort from the bottom up, all groups at once:
    each suffix finds its rank in the block that its own is merged with.
    """
    inverse = power(_INVERSE, len(hashes))
    whole = (hashes[start + n] - hashes[start]) * inverse[start]
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(of)))
    begin, total = np.repeat(first, size), np.repeat(size, size)
    order, width = np.arange(len(start)), 1
    while width < size.max(initial=0):
        at = np.flatnonzero(total > width)  # places in groups that are not sorted yet
        local = at - begin[at]
        block = local // width
        low = begin[at] + np.minimum((block ^ 1) * width, total[at])
        high = begin[at] + np.minimum(((block ^ 1) + 1) * width, total[at])
        rank_from, left, mine = low.copy(), block % 2 == 0, order[at]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            a, b = mine[open_], order[middle]
            before = np.zeros(len(open_), bool)  # the other one stands before this one
            equal = whole[a] == whole[b]
            before[equal] = ~left[open_][equal]
            differ = np.flatnonzero(~equal)
            i, j = start[a[differ]], start[b[differ]]
            common = np.minimum(common_extension(hashes, inverse, i, j, n - 1), n - 1)
            before[differ] = data[j + common] < data[i + common]
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        place = begin[at] + (block // 2) * 2 * width + (local - block * width) + (low - rank_from)
        order[place] = mine
        width *= 2
    return order


def _equal_by_bytes(text: bytes, start: np.ndarray, n: int, pairs: np.ndarray) -> bool:
    """Whether all pairs of suffixes agree in ``n`` bytes; successive ones are compared as one piece."""
    i, j = start[pairs[:, 0]], start[pairs[:, 1]]
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    new = np.flatnonzero(np.concatenate(([True], ((j - i)[1:] != (j - i)[:-1]) | (i[1:] > i[:-1] + 1)))) if len(i) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(i)) - 1
    return all(text[a:b] == text[c:d] for a, b, c, d in zip(i[new].tolist(), (i[last] + n).tolist(), j[new].tolist(), (j[last] + n).tolist(), strict=True))


def repeated_windows(text: bytes, start: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Of the ``n`` bytes at each ``start`` whether a group (``of``, sorted) has them twice."""
    data = np.frombuffer(text, np.uint8)
    hashes = prefix_hashes(data)
    order = sorted_suffixes(data, hashes, start, of, n)
    whole = ((hashes[start + n] - hashes[start]) * power(_INVERSE, len(hashes))[start])[order]
    same = (whole[1:] == whole[:-1]) & (of[1:] == of[:-1])
    found = np.zeros(len(start), bool)
    pairs = np.stack((order[:-1][same], order[1:][same]), axis=1)
    if _equal_by_bytes(text, start, n, pairs):
        found[pairs.ravel()] = True
        return found
    seen: dict[tuple[int, bytes], int] = {}  # hashes collided
    for k, (g, i) in enumerate(zip(of.tolist(), start.tolist(), strict=True)):
        first = seen.setdefault((g, text[i : i + n]), k)
        if first != k:
            found[first] = found[k] = True
    return found


class Part:
    """The different texts of a group of rows, in an order that does not depend on the rows'."""

    def __init__(self, rows: pa.Table):
        self.sha = [s.hex() for s in rows.column("sha").to_pylist()]
        number = {s: k for k, s in enumerate(sorted(set(self.sha)))}
        self.of = [number[s] for s in self.sha]
        texts = rows.column("text").cast(pa.binary())
        self.texts: list[bytes] = [b""] * len(number)
        for row, k in enumerate(self.of):
            if not self.texts[k]:
                self.texts[k] = texts[row].as_py()
        self.number = number


def _pieces(texts: list[tuple[int, bytes]], n: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Texts of a part side by side, long ones in overlapping pieces: (bytes, [(text, place in it, length)])."""
    held, of, size = [], [], 0
    for doc, text in texts:
        for at in range(0, max(1, len(text) - n + 1), _PIECE):
            piece = text[at : at + _PIECE + n - 1]
            if size and size + len(piece) >= 1 << _PLACE:
                yield b"".join(held), of
                held, of, size = [], [], 0
            held.append(piece)
            of.append((doc, at, len(piece)))
            size += len(piece)
    if size:
        yield b"".join(held), of


def _runs(data: bytes, of: list[tuple[int, int, int]], n: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (hash of its gram, text, place of the first window in it and in ``data``, windows, place of the anchor after the first window)."""
    gram = max(1, n // 3)
    sizes = np.asarray([x[2] for x in of], np.int64)
    ends = np.cumsum(sizes)
    hashes = prefix_hashes(np.frombuffer(data, np.uint8))
    grams = mix((hashes[gram:] - hashes[:-gram]) * power(_INVERSE, len(hashes) - gram))
    least = (grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    width, want = 1, n - gram + 1
    while 2 * width <= want:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < want:
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    counts = np.maximum(sizes - n + 1, 0)
    piece = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) + (ends - sizes)[piece]
    anchor = (least[start] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else np.zeros(0, np.int64)
    first, count = start[new], np.diff(np.append(new, len(anchor)))
    doc, base = np.asarray([x[0] for x in of], np.int64), np.asarray([x[1] for x in of], np.int64)
    owner = piece[new]
    return grams[anchor[new]], doc[owner], first - (ends - sizes)[owner] + base[owner], first, count, anchor[new] - first


def _array(rows: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in rows.column(name).to_pylist() if x), kind)


def _kinds(rows: pa.Table, kind: int) -> pa.Table:
    return rows.filter(pa.array(rows.column("kind").to_numpy() == kind)) if rows.num_rows else rows


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    types = {"int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.Table.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    for name, i, j in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(order)][: len(names)], strict=True):
        yield name, order[i:j]


def _marked(part: int, doc: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[tuple]:
    """A row of marks, successive places of a text as one."""
    if not len(doc):
        return []
    order = np.lexsort((at, doc))
    doc, at, end = doc[order].astype(np.int64), at[order].astype(np.int64), (at + size)[order].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (at[1:] > end[:-1]))))
    return [(part, doc[new].astype(np.uint32).tobytes(), at[new].astype(np.uint32).tobytes(), (np.maximum.reduceat(end, new) - at[new]).astype(np.uint32).tobytes(), None)]


def _own(texts: pa.Table, copies: pa.Table) -> tuple[int, Part, list[tuple[int, bytes]]]:
    """(number of the part, its texts, those that it has to search: all but copies of another part's)."""
    part = Part(texts)
    number = texts.column("part")[0].as_py()
    away = {r["copy"] for r in copies.select(["copy", "home"]).to_pylist() if r["home"] != number} if copies.num_rows else set()
    return number, part, [(k, part.texts[k]) for s, k in part.number.items() if s not in away]


def _anchors(texts: DataFrame, copies: DataFrame, n: int, buckets: int) -> DataFrame:
    """How many runs of each gram a part has, by the gram's bucket."""

    def run(rows: pa.Table, away: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            number, _, own = _own(rows, away)
            found = [_runs(data, of, n)[0] for data, of in _pieces(own, n)]
            grams, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            counts = np.minimum(counts, 65535).astype(np.uint16)
            out = [(b, number, grams[k].tobytes(), counts[k].tobytes()) for b, k in _dealt((grams >> np.uint64(_PLACE)) % np.uint64(buckets))]
        release()
        return _table(out, _ANCHORS)

    return texts.groupBy("part").cogroup(copies.groupBy("part")).applyInArrow(run, _ANCHORS)


def _repeated(anchors: DataFrame, hot: int) -> DataFrame:
    """To each part those of its grams that anchor runs elsewhere too (kind 0), or more than ``hot`` (kind 1)."""

    def run(rows: pa.Table) -> pa.Table:
        grams, counts = _array(rows, "a", np.uint64), _array(rows, "n", np.uint16).astype(np.int64)
        part = np.repeat(rows.column("part").to_numpy(), [len(x) // 8 for x in rows.column("a").to_pylist()])
        _, of = np.unique(grams, return_inverse=True)
        total = np.bincount(of, counts).astype(np.int64)[of] if len(of) else counts
        out = []
        for kind, keep in ((0, (total > 1) & (total <= hot)), (1, total > hot)):
            own = grams[keep]
            out += [(p, kind, own[k].tobytes(), None, None) for p, k in _dealt(part[keep])]
        release()
        return _table(out, _REPLIES)

    return anchors.groupBy("bucket").applyInArrow(run, _REPLIES)


def _candidates(texts: DataFrame, replies: DataFrame, n: int, buckets: int) -> DataFrame:
    """Runs around repeated grams with the bytes they cover (kind 0), windows around hot ones (kind 2), marks settled in the part (kind 1)."""

    def run(rows: pa.Table, got: pa.Table) -> pa.Table:
        if not rows.num_rows or not got.num_rows:
            return _table([], _RUNS)
        number, part, own = _own(rows, _kinds(got, 2))
        wanted, hot = (np.unique(_array(_kinds(got, k), "a", np.uint64)) for k in (0, 1))
        runs: dict[tuple[int, int, bytes], list[tuple[int, int]]] = {}
        windows: dict[bytes, list[tuple[int, int]]] = {}
        for data, of in _pieces(own, n):
            grams, doc, at, first, count, anchor = _runs(data, of, n)
            keep = np.flatnonzero(np.isin(grams, wanted))
            for g, d, a, i, c, m in zip(*(x[keep].tolist() for x in (grams, doc, at, first, count, anchor)), strict=True):
                runs.setdefault((g, m, data[i : i + c + n - 1]), []).append((d, a))
            keep = np.flatnonzero(np.isin(grams, hot))
            for d, a, i, c in zip(*(x[keep].tolist() for x in (doc, at, first, count)), strict=True):
                for t in range(c):
                    windows.setdefault(hashlib.blake2b(data[i + t : i + t + n], digest_size=16).digest(), []).append((d, a + t))
        out = []
        keys, places = list(runs), list(runs.values())
        if keys:
            a, b, length = np.asarray([k[0] for k in keys], np.uint64), np.asarray([k[1] for k in keys], np.uint16), np.asarray([len(k[2]) for k in keys], np.uint32)
            doc, at = (np.asarray([p[0][k] for p in places], np.uint32) for k in (0, 1))
            twice = np.asarray([len(p) > 1 for p in places], np.uint8)
            for bucket, k in _dealt((a >> np.uint64(_PLACE)) % np.uint64(buckets)):
                out.append((bucket, number, 0, a[k].tobytes(), b[k].tobytes(), doc[k].tobytes(), at[k].tobytes(), length[k].tobytes(), twice[k].tobytes(), b"".join(keys[x][2] for x in k.tolist())))
        if windows:
            digest = np.frombuffer(b"".join(windows), np.uint64).reshape(-1, 2)
            doc, at = (np.asarray([p[0][k] for p in windows.values()], np.uint32) for k in (0, 1))
            twice = np.asarray([len(p) > 1 for p in windows.values()], np.uint8)
            for bucket, k in _dealt(digest[:, 0] % np.uint64(buckets)):
                out.append((bucket, number, 2, digest[k, 0].tobytes(), digest[k, 1].tobytes(), doc[k].tobytes(), at[k].tobytes(), None, twice[k].tobytes(), None))
        settled = [(d, a, len(k[2]) - n + 1) for k, p in runs.items() if len(p) > 1 for d, a in p] + [(d, a, 1) for p in windows.values() if len(p) > 1 for d, a in p]
        if settled:
            for _, doc, at, size, _ in _marked(number, *(np.asarray(x, np.int64) for x in zip(*settled, strict=True))):
                out.append((number % buckets, number, 1, None, None, doc, at, size, None, None))
        del runs, windows
        release()
        return _table(out, _RUNS)

    return texts.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(run, _RUNS)


def _sorted_runs(rows: pa.Table, n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Marks (part, text, place, windows) for the runs of a bucket."""
    grams, anchor, twice = _array(rows, "a", np.uint64), _array(rows, "b", np.uint16).astype(np.int64), _array(rows, "twice", np.uint8)
    doc, at, length = (_array(rows, c, np.uint32).astype(np.int64) for c in ("doc", "at", "size"))
    part = np.repeat(rows.column("part").to_numpy(), [len(x) // 8 for x in rows.column("a").to_pylist()])
    text = b"".join(rows.column("text").to_pylist())
    ends = np.cumsum(length)
    order = np.argsort(grams, kind="stable")
    bounds = [0, *(np.flatnonzero(grams[order][1:] != grams[order][:-1]) + 1).tolist(), len(order)]
    marks: list[tuple[int, int, int]] = []  # (run, first window, windows)
    held: list[list[tuple[bytes, int, list[int], bool]]] = []  # of each gram: (bytes, anchor, runs, settled)
    size = 0

    def sort() -> None:
        every = [(k, *x) for k, gram in enumerate(held) for x in gram]
        whole = b"".join(x[1] for x in every)
        lengths = np.asarray([len(x[1]) for x in every], np.int64)
        counts = lengths - n + 1
        run = np.repeat(np.arange(len(every)), counts)
        window = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = (np.cumsum(lengths) - lengths)[run] + window
        key = np.asarray([x[0] for x in every])[run] * (2 * n) + np.asarray([x[2] for x in every])[run] - window + n  # gram, and where its anchor stands in the window
        by = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], key[by][1:] != key[by][:-1])))
        many = np.repeat(np.diff(np.append(first, len(by))) > 1, np.diff(np.append(first, len(by))))
        by = by[many]
        found = np.zeros(len(run), bool)
        found[by] = repeated_windows(whole, start[by], key[by], n)
        found |= np.asarray([x[4] for x in every])[run]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], found.astype(np.int8), [0]))))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            while i < j:  # a stretch of windows may go over several runs
                r = run[i]
                stop = min(j, int(np.searchsorted(run, r, "right")))
                marks.extend((k, int(window[i]), stop - i) for k in every[r][3])
                i = stop

    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        same: dict[tuple[int, bytes], list[int]] = {}
        for k in order[low:high].tolist():
            same.setdefault((int(anchor[k]), text[ends[k] - length[k] : ends[k]]), []).append(k)
        gram = [(t, m, ks, len(ks) > 1 or bool(twice[ks[0]])) for (m, t), ks in same.items()]
        if len(gram) == 1 or all(x[3] for x in gram):
            marks.extend((k, 0, len(t) - n + 1) for t, _, ks, settled in gram if settled for k in ks)
            continue
        held.append(gram)
        size += sum(len(x[0]) for x in gram)
        if size > SORT_BYTES:
            sort()
            held, size = [], 0
    if held:
        sort()
    if marks:
        run, first, count = (np.asarray(x, np.int64) for x in zip(*marks, strict=True))
        yield part[run], doc[run], at[run] + first, count


def _windows_met(rows: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
    a, b, twice = _array(rows, "a", np.uint64), _array(rows, "b", np.uint64), _array(rows, "twice", np.uint8)
    doc, at = (_array(rows, c, np.uint32).astype(np.int64) for c in ("doc", "at"))
    part = np.repeat(rows.column("part").to_numpy(), [len(x) // 8 for x in rows.column("a").to_pylist()])
    order = np.lexsort((b, a))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    hit = order[same[:-1] | same[1:] | (twice[order] > 0)]
    yield part[hit], doc[hit], at[hit], np.ones(len(hit), np.int64)


def _met(runs: DataFrame, n: int) -> DataFrame:
    """Marks of repeated windows, sent back to the parts."""

    def run(rows: pa.Table) -> pa.Table:
        out = [(r["part"], r["doc"], r["at"], r["size"], None) for r in _kinds(rows, 1).select(["part", "doc", "at", "size"]).to_pylist()]
        for kind, search in ((0, lambda x: _sorted_runs(x, n)), (2, _windows_met)):
            own = _kinds(rows, kind)
            for part, doc, at, size in search(own) if own.num_rows else ():
                for p, k in _dealt(part):
                    out += _marked(p, doc[k], at[k], size[k])
        release()
        return _table(out, _MARKS)

    return runs.groupBy("bucket").applyInArrow(run, _MARKS)


def dedup_suffixes(docs: DataFrame, n: int = 200, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False, hot: int = HOT) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one for each row; with ``keep_bytes`` also what is kept, as ``kept``.

    Each byte that a string of ``n`` bytes covers which starts anywhere else in ``docs`` too is removed.
    """
    if n < 8:
        raise ValueError("n must be at least 8")
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("b")).first()["b"]
    buckets, parts = max(1, total // BUCKET_BYTES), max(1, total // GROUP_BYTES)
    text, doc = F.coalesce(F.col(text_col), F.lit("")), F.col(id_col)
    base = light_batches(docs).select(doc.alias("id_"), text.alias("text"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"))
    spread = F.when(F.col("id_").isNull(), F.xxhash64(F.lit(None).cast("long"), "sha", F.spark_partition_id())).otherwise(F.xxhash64("id_", "sha"))
    texts = base.filter(F.octet_length("text") >= n).withColumn("part", F.pmod(spread, F.lit(parts)).cast("int"))
    same = Window.partitionBy("sha")
    held = texts.groupBy("sha", "part").agg(F.count("*").alias("own"))
    copies = held.withColumn("all", F.sum("own").over(same)).withColumn("home", F.min("part").over(same)).filter("all > 1").select("part", F.lit(2).alias("kind"), F.lit(None).cast("binary").alias("a"), F.lower(F.hex("sha")).alias("copy"), "home")
    replies = _repeated(_anchors(texts, copies, n, buckets), hot).unionByName(copies)
    marks = _met(_candidates(texts, replies, n, buckets), n)
    empty = F.lit(None).cast("binary")
    marks = marks.unionByName(copies.select("part", empty.alias("doc"), empty.alias("at"), empty.alias("size"), "copy"))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id_ {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes

    def cut(rows: pa.Table, got: pa.Table) -> pa.Table:
        part = Part(rows)
        sizes = np.asarray([len(t) for t in part.texts], np.int64)
        base_ = np.cumsum(sizes) - sizes
        steps = np.zeros(int(sizes.sum()) + 1, np.int32)
        if got.num_rows:
            d, at, size = (_array(got, c, np.uint32).astype(np.int64) for c in ("doc", "at", "size"))
            whole = np.asarray([part.number[s] for s in got.column("copy").to_pylist() if s], np.int64)
            np.add.at(steps, np.concatenate((base_[d] + at, base_[whole])), 1)
            np.add.at(steps, np.concatenate((base_[d] + at + size + n - 1, (base_ + sizes)[whole])), -1)
        gone = np.cumsum(steps[:-1]) > 0
        found = []
        for k, text_ in enumerate(part.texts):
            own = gone[base_[k] : base_[k] + sizes[k]]
            removed = int(own.sum())
            spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if removed else 0
            kept = np.frombuffer(text_, np.uint8)[~own].tobytes() if removed else text_
            found.append((removed, spans, hashlib.sha256(kept).hexdigest() if removed else None, kept if keep_bytes else None))
        each = [found[k] for k in part.of]
        columns = [rows.column("id_"), pa.array(sizes[part.of]), pa.array([x[0] for x in each], pa.int64()), pa.array([x[1] for x in each], pa.int64()), pa.array([x[2] or s for x, s in zip(each, part.sha, strict=True)], pa.string())]
        release()
        return pa.Table.from_arrays(columns + ([pa.array([x[3] for x in each], pa.binary())] if keep_bytes else []), [f.split()[0] for f in schema.split(", ")])

    cut_ = texts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(cut, schema)
    short = base.filter(F.octet_length("text") < n).select("id_", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.lower(F.hex("sha")).alias("kept_sha256"), *([F.col("text").cast("binary").alias("kept")] if keep_bytes else []))
    return cut_.unionByName(short).withColumnRenamed("id_", "doc_id")
