"""Labels of the licence scan on notices with changed words, and on words of licences that are no notice; nothing of the scan's own measures is used."""

import random
import re

import pytest

pytest.importorskip("gridspark.llm.queries")
from gridspark.llm import license_scan  # noqa: E402


def notices():
    return [(label, re.findall("[a-z0-9]+", t.lower())) for label, (texts, _) in license_scan.TEMPLATES.items() for t in texts]


def labels(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in license_scan.scan_licenses(df).collect()}


def test_recall_of_changed_notices(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    texts, planted = [], []
    for share in (0.0, 0.05, 0.1):
        for label, own in notices():
            for _ in range(20):
                changed = [word() if rng.random() < share else w for w in own]
                texts.append(" ".join([*(word() for _ in range(rng.randint(0, 40))), *changed, *(word() for _ in range(rng.randint(0, 40)))]))
                planted.append((share, label, own))
    found = labels(spark, texts)
    for share, least in ((0.0, 1.0), (0.05, 0.95), (0.1, 0.9)):
        hits = [label in found[k] for k, (s, label, _) in enumerate(planted) if s == share]
        assert sum(hits) / len(hits) >= least
    base = {b for b in license_scan.BASE.values()}
    other = [found[k] - {label} - base for k, (_, label, _) in enumerate(planted)]
    assert sum(map(bool, other)) <= len(other) // 100


def test_no_label_in_words_of_licences(spark):
    rng = random.Random(6)
    every = [w for _, own in notices() for w in own]
    texts = [" ".join(rng.choice(every) for _ in range(200)) for _ in range(1000)]
    texts += ["released under the bsd license", "under the terms of the lesser general public license", "permission is granted to any person", "licensed under the terms of the contract version 2 0"]
    found = labels(spark, texts)
    words = [t.split() for t in texts]
    based = {k for k, w in enumerate(words) for p in license_scan.BASE if p in " ".join(w)}
    assert [k for k, own in found.items() if own and k not in based] == []


def test_long_file_of_many_notices(spark):
    rng = random.Random(7)
    own = notices()
    text = " ".join(" ".join(rng.choice(own)[1]) + " filler words" for _ in range(5000))
    assert labels(spark, [text, text])[0] == {label for label, _ in own}
