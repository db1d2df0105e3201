"""License scans with a positional index of the licence templates' words.

For each template that a file has enough words of, the file's words of highest IDF (over the whole table) are looked up in
the template's postings, as many as it takes for one of them to be in its place wherever the template stands in the file.
Postings that agree on the relative position (place in the file minus place in the template) align the two, the aligned
words are compared, a word or two out of step, and a label counts only if one of the label's mandatory key phrases stands
in the aligned part. A phrase of three words and more may have one other word in it, but neither in place of a word that names a licence
nor one that names another. Base phrases are found by the same numbers of words.

Defined cases: a null or empty text has no words, no label and score 0; ties in IDF go to the word that sorts first;
repeated rows are judged one by one; columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import light_batches
from .text import ALNUM, slices, utf8, words

#: The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices of common licences. A label's mandatory key phrases follow its notices.
TEMPLATES = {
    "apache": (
        [
            "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
            "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
            "Licensed under the Apache License, Version 2.0.",
        ],
        ["apache license version 2 0", "licensed under the apache license", "in compliance with the license you may obtain", "distributed on an as is basis", "without warranties or conditions of any kind"],
    ),
    "mit": (
        [
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
            "Released under the MIT License.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "This project is licensed under the terms of the MIT license.",
        ],
        ["permission is hereby granted free of charge", "any person obtaining a copy", "to deal in the software without restriction", "under the mit license", "terms of the mit license", "included in all copies or substantial portions"],
    ),
    "gpl": (
        [
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "under the terms of the GNU General Public License",
            "This work is licensed under the GNU General Public License, version 3.",
        ],
        ["gnu general public license", "terms of the gnu general public license", "gnu general public license as published", "either version 3 of the license"],
    ),
    "lgpl": (["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"], ["gnu lesser general public license", "lesser general public license as", "this library is free software"]),
    "agpl": (["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"], ["gnu affero general public license", "affero general public license as", "terms of the gnu affero general"]),
    "bsd": (
        [
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        ],
        ["redistribution and use in source and binary forms", "with or without modification are permitted provided", "source code must retain the above copyright notice", "this list of conditions and the following disclaimer", "in binary form must reproduce the above", "documentation and or other materials provided", "endorse or promote products derived from this software", "without specific prior written permission"],
    ),
    "isc": (["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."], ["with or without fee is hereby granted", "use copy modify and or distribute this software", "appear in all copies"]),
    "zlib": (["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."], ["without any express or implied warranty", "in no event will the authors be held liable", "arising from the use of this software"]),
    "boost": (["Distributed under the Boost Software License, Version 1.0."], ["boost software license"]),
    "mpl": (["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"], ["mozilla public license", "if a copy of the mpl was not distributed", "the terms of the mozilla public"]),
    "epl": (["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"], ["eclipse public license"]),
    "unlicense": (["This is free and unencumbered software released into the public domain."], ["free and unencumbered software", "software released into the public domain"]),
    "cc-by": (["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0."], ["attribution 4 0 international license", "creative commons attribution 4 0", "under cc by 4 0", "cc by 4 0"]),
    "cc-by-sa": (["This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "Licensed under CC BY-SA 4.0."], ["creative commons attribution sharealike", "attribution sharealike 4 0 international", "under cc by sa 4", "by sa 4 0"]),
    "cc-by-nc": (["This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "Licensed under CC BY-NC 4.0."], ["creative commons attribution noncommercial", "attribution noncommercial 4 0 international", "under cc by nc 4", "by nc 4 0"]),
    "cc-by-nd": (["This work is licensed under a Creative Commons Attribution NoDerivatives 4.0 International License", "Licensed under CC BY-ND 4.0."], ["creative commons attribution noderivatives", "attribution noderivatives 4 0 international", "under cc by nd 4", "by nd 4 0"]),
    "cc0": (["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "Released under CC0 1.0 Universal."], ["waived all copyright and related", "related or neighboring rights to this work", "released under cc0", "cc0 1 0 universal"]),
    "eupl": (["Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission subsequent versions of the EUPL"], ["under the eupl version", "approved by the european commission"]),
    "ofl": (["This Font Software is licensed under the SIL Open Font License, Version 1.1."], ["sil open font license", "this font software is licensed"]),
    "artistic": (["You may distribute this under the terms of the Artistic License 2.0"], ["artistic license 2 0", "terms of the artistic license"]),
}
#: Words that name a licence by themselves, which a key phrase must have, and more that take another word's place in none.
NAMING = frozenset("library apache mit lesser affero boost mozilla eclipse sa nc nd sharealike noncommercial noderivatives cc0 eupl sil artistic".split())
TELLING = NAMING | frozenset("gnu cc by mpl".split())
#: The share of a notice's words that must agree, and how many words out of step they may be.
AGREE, DRIFT = 0.65, 2
#: Places of a notice in a file that are compared at once.
_AT_ONCE = 2048
_PART_BYTES = 4 << 20
_FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def word_counts(docs: DataFrame, vocabulary: list[bytes], text_col: str = "text") -> DataFrame:
    """(word, documents that hold it) over the whole table, for words of a fixed list, and (null, rows); added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, rows = frozenset(vocabulary), Counter(), 0
        for part in slices(batches, "text", _PART_BYTES):
            rows += len(part)
            for text in utf8(part, "text"):
                total.update(known.intersection(words(text, ALNUM)))
        yield pa.RecordBatch.from_arrays([pa.array([*(w.decode() for w in total), None], pa.string()), pa.array([*total.values(), rows], pa.int64())], ["word", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """The templates' notices as numbers of words, and each notice's postings, its words of highest IDF first."""

    def __init__(self, templates: dict, base: dict[str, str], counts: dict[bytes, int], n_docs: int, agree: float = AGREE):
        self.agree = agree
        self.phrases = [(words(p.encode(), ALNUM), label) for p, label in base.items()]
        notices = [(label, words(t.encode(), ALNUM), [words(k.encode(), ALNUM) for k in keys]) for label, (texts, keys) in templates.items() for t in texts]
        self.number = {w: k for k, w in enumerate(sorted({w for _, own, keys in notices for part in (own, *keys) for w in part} | {w for p, _ in self.phrases for w in p}))}
        self.telling = np.asarray([w.decode() in TELLING for w in sorted(self.number, key=self.number.get)] + [False])  # the last for words of no notice, -1
        idf = lambda w: log((1 + n_docs) / (1 + counts.get(w, 0)))
        self.labels = [label for label, _, _ in notices]
        self.own = [np.asarray([self.number[w] for w in own]) for _, own, _ in notices]
        self.keys = [[(np.asarray([self.number[w] for w in k]), np.asarray([w.decode() in NAMING for w in k])) for k in keys] for _, _, keys in notices]
        self.postings = [[(self.number[w], [k for k, x in enumerate(own) if x == w]) for w in sorted(set(own), key=lambda w: (-idf(w), w))] for _, own, _ in notices]
        self.weights = np.zeros((len(self.number), len(notices)), np.int32)  # places of a word in a notice
        for t, own in enumerate(self.own):
            np.add.at(self.weights[:, t], own, 1)
        self.need = np.asarray([ceil(agree * len(own) - 1e-9) for own in self.own], np.int64)

    def shares(self, ids: np.ndarray, t: int, shifts: np.ndarray) -> float:
        """The best share of notice ``t``'s words that stand at one of ``shifts`` or a few words off it, where a key phrase stands too; 0 below ``agree``."""
        own, best = self.own[t], 0.0
        wide = len(own) + 2 * DRIFT
        padded = np.concatenate((np.full(wide, -1), ids, np.full(wide, -1)))
        for k in range(0, len(shifts), _AT_ONCE):
            windows = padded[shifts[k : k + _AT_ONCE, None] + np.arange(wide - DRIFT, 2 * wide - DRIFT)]
            hit = np.zeros((len(windows), len(own)), bool)
            for d in range(2 * DRIFT + 1):
                hit |= windows[:, d : d + len(own)] == own
            share = hit.sum(axis=1) / len(own)
            enough = np.flatnonzero((hit.sum(axis=1) >= self.need[t]) & (share > best))
            if len(enough):
                stands = self._stands(windows[enough], t)
                best = max(best, share[enough][stands].max(initial=0.0))
        return float(best)

    def _stands(self, windows: np.ndarray, t: int) -> np.ndarray:
        """In which windows a key phrase of the notice's label stands."""
        found = np.zeros(len(windows), bool)
        for key, telling in self.keys[t]:
            if len(key) <= windows.shape[1]:
                held = np.lib.stride_tricks.sliding_window_view(windows, len(key), axis=1)
                same, there = held == key, self.telling[held]
                miss = len(key) - same.sum(axis=2)
                near = (miss == 1) & (len(key) >= 3) & same[:, :, telling].all(axis=2) & ~(there & ~same).any(axis=2)
                found |= ((miss == 0) | near).any(axis=1)
        return found

    def labels_of(self, ids: np.ndarray) -> dict[str, float]:
        """Best share of each label that reaches the least one; ``ids``: the file's words, -1 for words of no notice."""
        have = np.zeros(len(self.number), bool)
        have[ids[ids >= 0]] = True
        best: dict[str, float] = {}
        for t in np.flatnonzero(have @ self.weights >= self.need).tolist():
            # of the words that may be out of place, some are not in the file; one of any more must be in its place
            spare, shifts = len(self.own[t]) - self.need[t] - sum(len(at) for w, at in self.postings[t] if not have[w]), set()
            for w, at in self.postings[t]:
                if have[w] and spare >= 0:
                    spare -= len(at)
                    places = np.flatnonzero(ids == w)
                    shifts.update(np.unique(places[:, None] - np.asarray(at)).tolist())
            inside = np.asarray(sorted(x for x in shifts if -len(self.own[t]) < x < len(ids)), np.int64)
            share = self.shares(ids, t, inside)
            if share > 0:
                best[self.labels[t]] = max(best.get(self.labels[t], 0.0), share)
        return best


def scan_licenses(docs: DataFrame, templates: dict | None = None, base: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", agree: float = AGREE) -> DataFrame:
    """One row per document: base places, base labels, all labels and the best agreement."""
    templates, base = TEMPLATES if templates is None else templates, BASE if base is None else base
    vocabulary = sorted({w for texts, _ in templates.values() for t in texts for w in words(t.encode(), ALNUM)})
    rows = light_batches(docs)
    found = {r["word"]: r["n"] for r in word_counts(rows, vocabulary, text_col).collect()}  # a row per template word at most
    n_docs = found.pop(None, 0)
    index = Index(templates, base, {w.encode(): n for w, n in found.items()}, n_docs, agree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", _PART_BYTES):
            docs_words = [words(t, ALNUM) for t in utf8(part, "text")]
            sizes = np.asarray([len(w) for w in docs_words], np.int64)
            starts = np.cumsum(sizes) - sizes
            flat = [w for own in docs_words for w in own]
            ids = np.fromiter(map(index.number.get, flat, repeat(-1)), np.int64, len(flat))
            of = np.repeat(np.arange(len(sizes)), sizes)
            hits = defaultdict(list)
            for phrase, label in index.phrases:
                n, numbers = len(phrase), [index.number[w] for w in phrase]
                at = np.flatnonzero(ids[: len(ids) - n + 1] == numbers[0]) if len(ids) >= n else np.zeros(0, np.int64)
                for k in range(1, n):
                    at = at[ids[at + k] == numbers[k]]
                at = at[of[at] == of[at + n - 1]] if len(at) else at
                for d, p in zip(of[at].tolist(), at.tolist(), strict=True):
                    hits[d].append((p - int(starts[d]), label))
            out = []
            for d, doc_id in enumerate(part.column("id").to_pylist()):
                own, method = hits.get(d, []), index.labels_of(ids[starts[d] : starts[d] + sizes[d]])
                base_labels = {label for _, label in own}
                at = [p for p, _ in own]
                score = max([0.0, *method.values(), *([1.0] if own else [])])
                out.append((doc_id, len(docs_words[d]), len(own), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | set(method))), score))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()], strict=True)], [c.split()[0] for c in _FOUND.split(", ")])

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _FOUND)
