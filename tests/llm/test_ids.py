"""Rows with null or shared ids link nothing but what their own texts do."""

import random
from collections import Counter

import pytest

pytest.importorskip("gridspark.llm.queries")
from gridspark.llm import jaccard_join  # noqa: E402


def components_of(rows, n=4):
    """(id, shingles, least id of the component) of each row, by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    label = list(range(len(rows)))
    for a, x in enumerate(sets):
        for b in range(a):
            y = sets[b]
            if x and y and 100 * len(x & y) >= 85 * len(x | y) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if k == old else k for k in label]
    least = {}
    for (i, _), k in zip(rows, label, strict=True):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    return Counter((i, len(s), least.get(k)) for (i, _), s, k in zip(rows, sets, label, strict=True))


def test_null_and_shared_ids_do_not_join_documents(spark):
    rng = random.Random(2)
    fresh = lambda m=60: [f"w{rng.randrange(10**6)}" for _ in range(m)]
    near = lambda w: [*w[:7], "changed", *w[8:]]
    a, b, c, d = fresh(), fresh(), fresh(), fresh()
    rows = [(1, a), (2, b), (None, near(a)), (None, near(b)), (3, c), (4, d), (9, near(c)), (9, near(d))]
    for k in range(60):
        base = fresh()
        rows += [(rng.choice([None, 100 + k, 500 + k % 7]), near(base) if rng.random() < 0.5 else base) for _ in range(rng.randint(1, 4))]
    rows += [(None, None), (None, []), (9, []), (None, ["two", "words"]), (None, ["two", "words"])]
    rows = [(i, None if w is None else " ".join(w)) for i, w in rows]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, component_id int").repartition(3)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.similarity_classes(frame).collect())
    assert got == components_of(rows)
    assert got[(1, 57, 1)] and got[(2, 57, 2)] and got[(3, 57, 3)] and got[(4, 57, 4)]


def test_rows_without_ids_stand_in_several_ranges(spark):
    """Next texts by descending id, then by descending hash of the text, whatever the ranges are."""
    from pyspark.sql import functions as F

    from gridspark.llm import fingerprints

    rows = [(k if k % 3 else None, f"text number {k}" if k % 10 else "the same text") for k in range(300)] + [(5, None), (None, ""), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marked = frame.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("mark", F.xxhash64("text")).collect()
    order = sorted(marked, key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), -r["mark"]))
    want = Counter((r["doc_id"], r["text"], order[(k + 1) % len(order)]["text"]) for k, r in enumerate(order))
    for size in (4000, 20):
        found = fingerprints.with_next(frame, bucket_rows=size)
        assert Counter((r["doc_id"], r["text"], r["next_text"]) for r in found.collect()) == want
        if size == 20:
            held = found.filter("doc_id is null").groupBy(F.floor(F.col("key") / (1 << 40))).count()
            assert held.count() >= 4
