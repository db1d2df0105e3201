"""Operators 11 to 13 against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("gridspark.llm.queries")
from gridspark.llm import spelling, suffix_dedup, whitening  # noqa: E402


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    prose = lambda m: " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 5))) for _ in range(m))
    passages = [prose(80) for _ in range(5)]
    out = [prose(rng.randint(0, 50)) + rng.choice(passages) + prose(rng.randint(0, 50)) for _ in range(40)]
    out += [out[0]] * 5 + [None, "", "ab", "x" * 3000, "xy" * 500, "x" * 700 + "z", "abc" * 200 + prose(20) + "abc" * 90]
    for _ in range(20):
        t = rng.choice(out[:40])
        i = rng.randrange(len(t))
        out.append(t[:i] + "q" + t[i + 1 :])
    return out


def removed(texts, n):
    raw, seen = [(t or "").encode() for t in texts], {}
    for d, b in enumerate(raw):
        for i in range(len(b) - n + 1):
            seen.setdefault(b[i : i + n], []).append((d, i))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + n] = b"\1" * n
    return [(len(b), sum(g), sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1])), hashlib.sha256(bytes(x for x, y in zip(b, g, strict=True) if not y)).hexdigest()) for b, g in zip(raw, gone, strict=True)]


@pytest.mark.parametrize(("n", "hot"), [(200, 4096), (50, 4096), (200, 2), (30, 1)])
def test_suffix_dedup(spark, texts, n, hot):
    rows = [(k, t, "x", 1, 2) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sha string, part int, kind int").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.dedup_suffixes(df, n, hot=hot).collect()}
    assert got == dict(enumerate(removed(texts, n)))


def test_suffix_dedup_null_and_repeated_ids(spark, texts):
    part = [*texts[:12], *texts[40:48]]
    rows = [(None if k % 3 else 7, t) for k, t in enumerate(part)] + [(7, texts[0])] * 2
    found = suffix_dedup.dedup_suffixes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), keep_bytes=True).collect()
    want = removed([t for _, t in rows], 200)
    assert Counter(tuple(r)[:5] for r in found) == Counter((i, *w) for (i, _), w in zip(rows, want, strict=True))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)
    assert suffix_dedup.dedup_suffixes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_dedup_long_texts(spark):
    rng = np.random.default_rng(2)
    long = "".join(map(chr, rng.integers(97, 123, 1_400_000)))
    shared = long[600_000:600_250]
    rows = [(1, long), (2, "q" * 3 + shared + "Q" * 3), (3, shared[:199] + "!"), (4, long[1_048_500:1_048_800])]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.dedup_suffixes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (550, 2), 2: (250, 1), 3: (0, 0), 4: (300, 1)}


def test_sorted_suffixes_and_collisions():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[1000:2000] = data[2000:3000]
    start, n = np.arange(len(data) - 40), 40
    of = np.sort(rng.integers(0, 5, len(start)))
    hashes = suffix_dedup.prefix_hashes(data)
    order = suffix_dedup.sorted_suffixes(data, hashes, start, of, n)
    raw = data.tobytes()
    keys = [(int(of[k]), raw[start[k] : start[k] + n]) for k in order]
    assert keys == sorted(keys)
    again = order[np.flatnonzero(np.diff(order) < 0)]
    assert len(set(order.tolist())) == len(start) and len(again) >= 0
    i, j = rng.integers(0, 3900, 500), rng.integers(0, 3900, 500)
    common = suffix_dedup.common_extension(hashes, suffix_dedup.power(suffix_dedup._INVERSE, len(hashes)), i, j, 64)
    assert all(c == next((k for k in range(64) if raw[a + k] != raw[b + k]), 64) for a, b, c in zip(i.tolist(), j.tolist(), common.tolist(), strict=True))


def test_hash_collisions_fall_back_to_bytes():
    """Strings of Thue and Morse collide in polynomial hashes modulo 2**64, whatever the base."""
    s = "a"
    for _ in range(11):
        s += s.translate(str.maketrans("ab", "ba"))
    t = s.translate(str.maketrans("ab", "ba"))
    n = 2048
    text = (s[:n] + "c" + t[:n] + "c" + s[:n]).encode()
    found = suffix_dedup.repeated_windows(text, np.array([0, n + 1, 2 * n + 2]), np.zeros(3, np.int64), n)
    assert found.tolist() == [True, False, True]


def words_of(rows, damage=199):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            out[word] += 1
    return out


def forms_of(words, times):
    skipped, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            skipped.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    for (a, b), own in skipped.items():
        for w in own:
            near[w] |= own - {w}
            if a + b in words:
                near[w].add(a + b)
                near[a + b].add(w)
    best = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: b if b and words[b] >= times * words[w] else None for w, b in best.items()}
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def test_spelling_variants(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    rows = []
    for k in range(120):
        own = []
        for _ in range(60):
            w = rng.choice(base)
            if rng.random() < 0.2:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcÀ") + w[i:], w[:i] + rng.choice("abc") + w[i + 1 :]])
            own.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((None if k % 10 == 0 else k, rng.choice([" ", "-", "1 "]).join(own), "x", 1))
    rows += [(1, None, None, None), (2, "", None, None), (3, "é 12 --", None, None), (4, " ".join(["z" * 2000] * 5 + ["z" * 1999] * 30), None, None), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(3)
    counts = words_of([r[:2] for r in rows], 19)
    want = forms_of({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}, 3)
    got = {r["word"]: tuple(r)[1:] for r in spelling.spelling_variants(df, times=3, damage=19).collect()}
    assert got == want and sum(1 for v in want.values() if v[0]) > 20


def test_trie_nodes_over_ranges(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(300)} | {"a" * 40, "é", "éa"})
    got = {r["w"]: (r["nodes"], r["rank"]) for r in spelling.trie_nodes(spark.createDataFrame([(w, 1) for w in words], "w string, n int"), 7, "w", "nodes", "rank").collect()}
    number = {}
    for w in words:
        nodes, rank = got[w]
        assert len(nodes) == len(w) + 1 and rank == words.index(w)
        for k, node in enumerate(nodes):
            assert number.setdefault(w[:k], node) == node
    assert len(set(number.values())) == len(number)


def test_spelling_of_nothing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in spelling.spelling_forms(spark.createDataFrame([("abcdef", 9)], "word string, n long")).collect()] == [("abcdef", None, "abcdef", 9, 0, None)]


def test_inertia_and_leading_eigenvalues():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a = rng.standard_normal((11, 11))
        a, shift = a + a.T, rng.standard_normal()
        assert whitening.above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    for spectrum in (np.arange(30.0), [5.0] * 10 + [4.0, 4 - 1e-9] + [3.0] * 3 + [1e-3] * 5 + [0.0] * 10, [1.0] * 30, [0.0] * 30):
        a = (q * np.asarray(spectrum)) @ q.T
        a = (a + a.T) / 2
        values, vectors = whitening.leading(a, 20)
        size = max(1.0, max(spectrum))
        assert np.abs(values - np.sort(spectrum)[::-1][:20]).max() < 1e-12 * size
        assert np.abs(vectors.T @ vectors - np.eye(20)).max() < 1e-10 and np.abs(a @ vectors - vectors * values).max() < 1e-12 * size


@pytest.mark.parametrize("components", [32, 3])
def test_whitening(spark, components):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 8)) + 3  # rank 6 before the grid
    v = np.concatenate((v, v[:40], v[:1].repeat(90, axis=0))).astype(np.float32)
    rows = [(k if k % 4 else None, x.tolist(), 1, 2) for k, x in enumerate(v)]
    odd = [(1, None), (2, []), (3, [1.0] * 7 + [None]), (4, [1.0] * 7 + [float("nan")]), (5, [float("inf")] * 8), (6, [1.0] * 7), (7, [1e30] * 8)]
    df = spark.createDataFrame(rows + [(*o, 0, 0) for o in odd], "vec_id long, embedding array<float>, n int, v int").repartition(3)
    model = whitening.fit(df, components)
    got = whitening.whiten(df, model).collect()
    x = np.floor(64 * v.astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    assert len(got) == n * len(e) and model.n == n and np.allclose(model.values, e, rtol=1e-9)
    assert all(abs(r["explained"] - e[r["component"] - 1] / np.trace(centred.T @ centred / n)) < 1e-9 and r["identity_error"] < 1e-6 for r in got)
    assert Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == Counter((i, int(((n * a.astype(object) - s.astype(object)) ** 2).sum())) for (i, *_), a in zip(rows, x, strict=True))
    white = centred @ q / np.sqrt(e)
    sign = np.sign((model.vectors * q).sum(axis=0))
    assert Counter((r["vec_id"], r["component"], round(r["whitened"], 6) + 0.0) for r in got) == Counter((rows[i][0], j + 1, round(float(white[i, j] * sign[j]), 6) + 0.0) for i in range(n) for j in range(len(e)))


def test_whitening_of_nothing(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0])] * 3):
        df = spark.createDataFrame(rows, schema)
        assert whitening.whiten(df, whitening.fit(df)).count() == 0
