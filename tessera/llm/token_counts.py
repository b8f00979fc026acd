"""Token counts by rank-synchronous merging of batched pre-tokens.

Texts are taken whole. A null text counts as empty; an empty text has no token.
Repeated rows are counted each for itself; an empty table gives no row. Only the
id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm import bpe
from tessera.llm.common import only
from tessera.llm.ragged import slices, spread


@functools.lru_cache(2)
def stepwise_cache(path: str) -> bpe.WordCache:
    """One per worker: words by rank-synchronous merging."""
    vocab = bpe.Vocabulary.from_json(path)
    return bpe.WordCache(lambda data, off: bpe.merge_in_step(vocab, data, off))


def encode_slice(path: str, data: np.ndarray, off: np.ndarray) -> tuple[bpe.WordCache, np.ndarray, np.ndarray, np.ndarray]:
    """(cache, word numbers, first word of each piece, text and special flag of each piece)."""
    vocab, cache = bpe.Vocabulary.from_json(path), stepwise_cache(path)
    if len(vocab.special) > 1:
        raise ValueError("at most one special string is handled")
    special = next(iter(vocab.special), None)
    data, piece_off, text, after = bpe.cut_special(data, off, special.encode()) if special else (data, off, np.arange(len(off) - 1), np.zeros(len(off) - 1, bool))
    start = bpe.pre_tokens(data, piece_off)
    words = cache.find(data, start) if len(start) else np.zeros(0, np.int32)
    return cache, words, np.searchsorted(start, piece_off), np.stack([text, after.astype(np.int64)])


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text, as the library counts them by default."""
    src = only(docs, id_col, text_col)
    id_type = src.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, text_col):
            cache, words, first, piece = encode_slice(vocab_path, data, off)
            per_piece = np.diff(spread(cache.sizes(words))[first]) + piece[1]
            n = np.bincount(piece[0], weights=per_piece, minlength=rows.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
