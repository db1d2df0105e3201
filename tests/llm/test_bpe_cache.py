"""The cache of token lengths is bounded by its bytes, and changes no count."""

import sys

import pytest

pytest.importorskip("gridspark.llm.queries")
pytest.importorskip("public_tokenizers")
from gridspark.llm import bpe, token_counts  # noqa: E402


def test_cache_is_bounded_by_bytes(monkeypatch):
    path, ranks = token_counts.tokenizer_paths()
    texts = [" ".join(f"word{k * j}x" for j in range(300)) for k in range(20)] + ["a" * 5000 + f" tail{k}" for k in range(5)] + ["\u00e9" * 3000]
    want = [len(bpe.token_ids(t, path, ranks)) for t in texts]
    monkeypatch.setattr(bpe, "CACHE_BYTES", 20_000)
    counter = bpe.Counter(path, ranks)
    for text, n in zip(texts, want, strict=True):
        assert counter.count(text) == n
        assert counter.held == sum(sys.getsizeof(x) + bpe.ENTRY_BYTES for x in counter.cache) <= 20_000
        assert all(len(x) < 5000 for x in counter.cache)
