"""Token counts by a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# Splits text before the merges; fixed by the rank files' format.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LOADED: dict = {}


def encoding(path: str):
    """The tokenizer of a rank file, loaded once per process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding(os.path.basename(path), pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def _count(path: str, names: list[str], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path).encode_ordinary
        for b in batches:
            n = [0 if t is None else len(enc(t)) for t in b.column(at).to_pylist()]
            cols = [c for k, c in enumerate(b.columns) if k != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int32())], names=[*names, "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens in place of the text column; a null text has 0 tokens."""
    if "n_tokens" in docs.columns:
        raise ValueError("the input already has a column n_tokens")
    rest = [c for c in docs.columns if c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text)
    return docs.select(*rest, text).mapInArrow(_count(vocabulary, rest, len(rest)), f"{schema}, n_tokens int")
