"""Language identification by a byte convolutional network.

Fixed-length windows of UTF-8 bytes go through filters of several widths, each filter's maximum over the window feeds a
softmax over the languages, and a text's languages are the softmax of its windows' mean scores, so whole texts count. The
network is trained with numpy on a bounded sample of labelled rows; applied, a filter bank of width w is a sum of table
rows picked by byte pairs.

Defined cases: a null text and a text without a letter are ``und`` with score 1; the last window of a text is filled up
with spaces; languages with few rows are learned from what there is; without labelled rows everything is ``und``; repeated
rows are predicted one by one; columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import light_batches, unused
from .text import slices, utf8

WINDOW, WIDTHS, FILTERS = 128, (2, 3, 4), 16
#: Bounds of the training sample: expected rows of a language and of all languages, and windows taken from a row.
SAMPLE_PER_LANG, SAMPLE_ROWS, SAMPLE_WINDOWS = 700, 8000, 3
STEPS, BATCH, SEED = 700, 96, 7
_PART_BYTES = 1 << 19


def held_out(id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def training_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int = SAMPLE_PER_LANG) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, windows of bytes, language number of each) of the sample, which a hash of the id picks."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~held_out(id_col))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}  # a row for each language
    langs = sorted(counts)
    if not langs:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    per_lang = min(per_lang, SAMPLE_ROWS / len(langs))
    share = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(min(1.0, per_lang / counts[k])))))
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.filter(draw < share[F.col(lang_col)])
    n = F.char_length(text_col)
    cut = lambda k: F.substring(F.col(text_col), (1 + F.pmod(F.xxhash64(F.col(id_col), F.lit(k)), F.greatest(n - WINDOW, F.lit(1)))).cast("int"), F.lit(WINDOW))
    windows = picked.select(F.col(lang_col).alias("lang"), F.explode(F.array(*(cut(k) for k in range(SAMPLE_WINDOWS)))).alias("w"))
    found = [(langs.index(r["lang"]), r["w"].encode()[:WINDOW].ljust(WINDOW)) for r in windows.toLocalIterator()]
    found.sort(key=lambda x: (x[1], x[0]))
    return langs, np.frombuffer(b"".join(w for _, w in found), np.uint8).reshape(-1, WINDOW), np.asarray([k for k, _ in found], np.int64)


class Network:
    def __init__(self, langs: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.langs = langs
        self.filters = {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), max(1, len(langs)))).astype(np.float32)
        self.out_bias = np.zeros(max(1, len(langs)), np.float32)

    def params(self) -> list[np.ndarray]:
        return [*self.filters.values(), *self.bias.values(), self.out, self.out_bias]

    def loss_and_gradient(self, b: np.ndarray, t: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy of windows ``b`` of languages ``t``, and its gradient by each of ``params``."""
        pooled, places = [], []
        for w in WIDTHS:
            n = b.shape[1] - w + 1
            z = sum(self.filters[w][k][b[:, k : k + n]] for k in range(w))
            at = z.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(z, at[:, None], axis=1)[:, 0] + self.bias[w])
        hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
        p = _softmax(hidden @ self.out + self.out_bias)
        loss = float(-np.log(p[np.arange(len(t)), t]).mean())
        p[np.arange(len(t)), t] -= 1
        p /= len(t)
        back = (p @ self.out.T) * (hidden > 0)
        grads = []
        for i, w in enumerate(WIDTHS):
            own, g = back[:, i * FILTERS : (i + 1) * FILTERS], np.zeros_like(self.filters[w])
            for k in range(w):
                np.add.at(g[k], (np.take_along_axis(b, places[i] + k, axis=1), np.arange(FILTERS)[None]), own)
            grads.append(g)
        grads += [back[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0) for i in range(len(WIDTHS))]
        return loss, [*grads, hidden.T @ p, p.sum(axis=0)]

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Network:
        """Adam on the cross entropy, each batch drawn evenly from the languages; only a filter's maximum is followed back."""
        rng = np.random.default_rng(SEED)
        params = self.params()
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        of = [np.flatnonzero(y == k) for k in range(len(self.langs))]
        of = [o for o in of if len(o)]
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(o, max(1, BATCH // len(of))) for o in of])
            _, grads = self.loss_and_gradient(x[rows].astype(np.int64), y[rows])
            for q, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def tables(self) -> dict[int, list[np.ndarray]]:
        """Each filter bank as tables of byte pairs, with a last one of single bytes for odd widths."""
        out = {}
        for w, f in self.filters.items():
            out[w] = [(f[k][:, None] + f[k + 1][None]).reshape(65536, FILTERS) for k in range(0, w - 1, 2)] + ([f[w - 1]] if w % 2 else [])
        return out

    def scores(self, x: np.ndarray, tables: dict) -> np.ndarray:
        """Scores of the languages for windows of bytes."""
        pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        pooled = []
        for w in WIDTHS:
            n = WINDOW - w + 1
            z = None
            for i, table in enumerate(tables[w]):
                at = pairs[:, 2 * i : 2 * i + n] if len(table) == 65536 else x[:, 2 * i : 2 * i + n]
                z = table.take(at, axis=0) if z is None else np.add(z, table.take(at, axis=0), out=z)
            pooled.append(z.max(axis=1) + self.bias[w])
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.out + self.out_bias


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    langs, x, y = training_windows(docs, id_col, text_col, lang_col)
    return Network(langs).train(x, y) if langs else Network([])


def identify(docs: DataFrame, network: Network, text_col: str = "text", keep: bool = False, id_col: str = "doc_id", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score); with ``keep`` all of the table's columns and the last two, in place of any so named."""
    sent = docs.sparkSession.sparkContext.broadcast(network)
    columns = [F.col(c) for c in docs.columns if c not in (lang_out, score_out)] if keep else [F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")]
    text, flag = text_col if keep else "text", unused(docs.columns, "has_letter")
    rows = light_batches(docs).select(*columns, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias(flag))
    names = [c for c in rows.columns if c != flag and (keep or c != "text")]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) + f", `{lang_out}` string, `{score_out}` double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        tables = net.tables()
        for part in slices(batches, text, _PART_BYTES):
            texts = [t if ok else None for t, ok in zip(utf8(part, text), part.column(flag).to_pylist(), strict=True)]
            counts = np.asarray([-(-len(t) // WINDOW) if t and net.langs else 0 for t in texts], np.int64)
            data = b"".join(t.ljust(n * WINDOW) for t, n in zip(texts, counts.tolist(), strict=True) if n)
            x = np.frombuffer(data, np.uint8).reshape(-1, WINDOW)
            z = np.concatenate([net.scores(x[i : i + 512], tables) for i in range(0, len(x), 512)]) if len(x) else np.zeros((0, max(1, len(net.langs))))
            has = np.flatnonzero(counts)
            mean = np.add.reduceat(z, (np.cumsum(counts) - counts)[has], axis=0) / counts[has, None] if len(has) else z
            p = _softmax(mean) if len(has) else mean
            lang, score = ["und"] * len(texts), np.ones(len(texts))
            for row, k in zip(has.tolist(), p.argmax(axis=1).tolist() if len(has) else [], strict=True):
                lang[row] = net.langs[k]
            score[has] = p.max(axis=1) if len(has) else 1
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*names, lang_out, score_out])

    return rows.mapInArrow(run, schema)
