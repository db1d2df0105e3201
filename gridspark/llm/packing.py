"""Vector best-fit packing of token sequences.

A bin is a training sequence with three capacities: tokens, documents and attention cost (the sum of squared lengths).
Pieces go in by decreasing length; among the bins that hold a piece under every constraint, the one is taken whose
residual vector after placing has the least weighted norm ("norm", tightest fit) or whose residual has the largest weighted
dot product with the piece's demand ("dot"). Pieces are dealt to groups of bounded expected size by a hash and each group
is packed by itself, so packing scales out; a group leaves a few open bins at its end.

Defined cases: a null text is empty and is the end token alone; a document longer than the capacity is cut, the first piece
taking what is left over; equal lengths go by (doc_id, piece); repeated rows are pieces of their own; an empty table has no
pieces; columns other than the named ones are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import light_batches
from .bpe import as_bytes, token_ids

CAPACITY = 2048
#: Documents expected in a group that is packed by itself.
GROUP_ROWS = 12_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, sequence_id long, offset long"


def token_pieces(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens; with ``keep_ids`` their ids too, as little-endian unsigned 32-bit numbers."""
    schema = _PIECES + (", ids binary" if keep_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                ids = as_bytes([*token_ids(text.as_py() or "", path, ranks), end_id])
                total, start, piece = len(ids) // 4, 0, 0
                length = total % capacity or capacity
                while start < total:
                    part = ids[4 * start : 4 * (start + length)]
                    for column, value in zip(out, (doc_id, piece, start, length, zlib.crc32(part), part), strict=False):
                        column.append(value)
                    start, piece, length = start + length, piece + 1, capacity
            yield pa.RecordBatch.from_pydict(dict(zip(names, out, strict=True)), pa.schema([pa.field(n, {"piece": pa.int32(), "ids": pa.binary()}.get(n, pa.int64())) for n in names]))

    return light_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str = "norm") -> np.ndarray:
    """The bin of each piece; ``lengths`` must not increase. Bins too full for the shortest piece left are put away."""
    cap, w = np.asarray(capacity, np.float64), np.asarray(weights, np.float64)
    residual, ids = np.empty((1024, 3)), np.empty(1024, np.int64)
    n_open, n_bins = 0, 0
    out = np.empty(len(lengths), np.int64)
    least = lengths[-1] if len(lengths) else 0
    for i, length in enumerate(lengths.tolist()):
        demand = np.array([length, 1.0, float(length) * length])
        open_ = residual[:n_open]
        fits = np.flatnonzero((open_[:, 0] >= length) & (open_[:, 1] >= 1) & (open_[:, 2] >= demand[2]))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin((((open_[fits] - demand) / cap) ** 2) @ w)]
            else:
                at = fits[np.argmax((open_[fits] / cap) @ (w * demand / cap))]
        else:
            if n_open == len(residual):
                residual, ids = np.concatenate((residual, np.empty_like(residual))), np.concatenate((ids, np.empty_like(ids)))
            at, n_open = n_open, n_open + 1
            residual[at], ids[at] = cap, n_bins
            n_bins += 1
        residual[at] -= demand
        out[i] = ids[at]
        if residual[at, 0] < least or residual[at, 1] < 1 or residual[at, 2] < least * least:
            n_open -= 1
            residual[at], ids[at] = residual[n_open], ids[n_open]
    return out


def pack(pieces: DataFrame, groups: int, capacity: int = CAPACITY, most_docs: int | None = None, most_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm") -> DataFrame:
    """Add ``sequence_id`` and ``offset``.

    Limits on documents and attention cost cost sequences, so they are the caller's to set; without them both are bounded by
    what the tokens allow, and the residual norm goes by the tokens.
    """
    limits = (capacity, most_docs or capacity, most_cost or capacity * capacity)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins = best_fit(rows["length"].to_numpy(), limits, weights, rule)
        rows["sequence_id"] = (int(key[0]) << 40) + bins
        rows["offset"] = rows.groupby("sequence_id")["length"].cumsum() - rows["length"]
        return rows.drop(columns="part")

    schema = f"{_PIECES}, ids binary, sequence_id long, offset long" if "ids" in pieces.columns else _PACKED
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))  # the row's place, as rows may repeat
    return parted.groupBy("part").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, keep_ids: bool = False, **how) -> DataFrame:
    groups = max(1, docs.count() // group_rows)
    return pack(token_pieces(docs, path, ranks, capacity, keep_ids=keep_ids), groups, capacity, **how)
