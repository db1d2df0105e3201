"""Token counts by a map-side two-tier lookup.

Every text is cut into the tokenizer's pre-tokens. Tier one is a compact table of the frequent ones' token lengths, broadcast
once: all pre-tokens in one string, with their lengths in characters and tokens, at most ``table_size`` whatever the input.
Tier two is each worker's own cache of what it has encoded, bounded in bytes and started anew when full. No pre-token is ever
shuffled; what the table holds changes speed, never counts.

Defined cases: a null text is empty and has 0 tokens; strings of special tokens count as the library's default has it;
repeated rows are counted one by one; columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections import Counter as Tally
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import light_batches
from .bpe import Counter, encoded, parts, pre_tokens

#: Bounds of the frequent table: rows of the sample it is taken from, and entries. They are the cache's warm start only.
SAMPLE_ROWS, TABLE_SIZE = 2000, 20_000


def tokenizer_paths(name: str = "byte_bpe_50k") -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def frequent_lengths(docs: DataFrame, path: str, ranks: str, text_col: str = "text", rows: int = SAMPLE_ROWS, table_size: int = TABLE_SIZE) -> tuple[str, bytes, bytes]:
    """(pre-tokens joined, characters of each, tokens of each, a byte a number) of the most frequent ones in a sample of rows."""
    tally: Tally = Tally()
    for row in docs.select(F.substring(F.col(text_col), 1, 4000).alias("t")).filter("t is not null").take(rows):
        for part in parts(row["t"], path)[::2]:
            tally.update(pre_tokens(part, path))
    often = sorted((x for x in tally.items() if len(x[0]) < 256), key=lambda x: (-x[1], x[0]))[:table_size]
    lengths = [(x, n) for x, n in ((x, len(encoded(x, path, ranks))) for x, _ in often) if n < 256]
    return "".join(x for x, _ in lengths), bytes(len(x) for x, _ in lengths), bytes(n for _, n in lengths)


def _table(names: str, sizes: bytes, lengths: bytes) -> dict[str, int]:
    ends = list(accumulate(sizes))
    return {names[end - size : end]: n for end, size, n in zip(ends, sizes, lengths, strict=True)}


def count_tokens(docs: DataFrame, path: str, ranks: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one per document; the files' paths must be there on every executor."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, ranks, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, ranks, _table(*table.value))
        for batch in batches:
            n = [counter.count(t.as_py()) if t.is_valid and len(t.as_py()) else 0 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(np.asarray(n, np.int64))], ["doc_id", "n_bytes", "n_tokens"])

    text = F.col(text_col)
    rows = light_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
