"""Words, word hashes and batches of texts, for tasks that work on Arrow batches.

The words of the contracts are separated by ASCII bytes only, so they can be cut in UTF-8 bytes without decoding.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ALL = bytes(range(256))
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_SPACE = b"\x09\x0a\x0b\x0c\x0d\x20"
_LOWERED = _ALL.translate(bytes.maketrans(_UPPER, _LOWER))

#: Lower case A-Z, words of digits, a-z and everything beyond ASCII: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in _LOWERED)
#: Words ``[^\x20\x09-\x0D]+``, unchanged, and the same after lower-casing A-Z.
BLANK = bytes(0x20 if b in _SPACE else b for b in _ALL)
BLANK_LOWER = bytes(0x20 if b in _SPACE else b for b in _LOWERED)


def words(text: bytes | None, table: bytes) -> list[bytes]:
    return text.translate(table).split() if text else []


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a part holds at most ``most`` bytes of ``column``, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)
    release()


def release() -> None:
    """Hand freed memory back to the system: idle workers are kept, and would keep the most that they ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


# Hashes of words and of word sequences, for a whole batch at once in numpy. All arithmetic is modulo 2**64.

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 1 << 18
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, _SEGMENT + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of ``text``, whose words are separated by single or several spaces (0x20)."""
    out, at = [], 0
    inverse = pow(int(_BASE), -1, 1 << 64)
    while at < len(text):
        end = len(text) if len(text) - at <= _SEGMENT else text.rfind(b" ", at, at + _SEGMENT)
        if end <= at:  # one word longer than a segment
            end = text.find(b" ", at + _SEGMENT)
            end = len(text) if end < 0 else end
        data = np.frombuffer(text, np.uint8, end - at, at)
        inside = np.empty(len(data) + 2, np.int8)
        inside[0] = inside[-1] = 0
        inside[1:-1] = data != 0x20
        step = np.diff(inside)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power(int(_BASE), len(data)), out=sums[1:])
        out.append(mix((sums[last] - sums[first]) * power(inverse, len(data) + 1)[first] + (last - first).astype(np.uint64)))
        at = end + 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def gram_hashes(hashes: np.ndarray, n: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """The hash of each run of ``n`` successive words; ``base`` (odd) picks one of several independent hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    have, width, done, grams = mix(hashes ^ np.uint64(base)), 1, 0, None
    c = lambda k: np.uint64(pow(base, k, 1 << 64))
    while done < n:
        if n & width:
            piece = have[done : len(have)] if done else have
            if grams is None:
                grams = piece.copy()
            else:
                m = min(len(grams), len(piece))
                grams = grams[:m] + piece[:m] * c(done)
            done += width
        if done < n:
            have = have[:-width] + have[width:] * c(width)
            width *= 2
    return mix(grams[: len(hashes) - n + 1])


def joined(texts: list[bytes | None], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts one after another, number of words of each text)."""
    parts = [t.translate(table) if t else b"" for t in texts]
    hashes = word_hashes(b" ".join(parts))
    data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts]) if parts else np.zeros(0, np.int64)
    gap = data == 0x20
    first = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    return hashes, np.diff(np.searchsorted(first, ends), prepend=0)
