"""Byte-level BPE encoding and decoding by a two-tier lookup.

First tier: a minimal perfect hash over the vocabulary finds the id of a pre-token
that is a token itself (its bytes are compared). Second tier: any other pre-token
is merged by a heap over linked bytes. Decoding gathers the bytes of the ids.

Null texts are empty; an empty text has no id and decodes to no byte. Repeated rows
are encoded each for itself, an empty table gives no row, and only the id and text
columns are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm import bpe
from tessera.llm.common import only
from tessera.llm.ragged import prefix_hash, slices, span_hash, spread, take_ragged


class TwoTier:
    """Encodes words by a vocabulary of ranks."""

    def __init__(self, vocab: bpe.Vocabulary) -> None:
        self.vocab = vocab
        self.known = np.flatnonzero(np.diff(vocab.blob_off) > 0)
        self.table = bpe.MinimalPerfectHash(span_hash(prefix_hash(vocab.blob), vocab.blob_off[self.known], vocab.blob_off[self.known + 1]))

    def whole(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The id of each word that is a token; -1 for others."""
        item = self.table.lookup(span_hash(prefix_hash(data), off[:-1], off[1:]))
        ids = np.where(item >= 0, self.known[item], -1)
        hit = np.flatnonzero(ids >= 0)
        if len(hit):
            begin, length = self.vocab.blob_off[ids[hit]], np.diff(self.vocab.blob_off)[ids[hit]]
            differ = length != np.diff(off)[hit]
            ids[hit[differ]] = -1
            hit, begin, length = hit[~differ], begin[~differ], length[~differ]
        if len(hit):
            theirs, run = take_ragged(self.vocab.blob, begin, length)
            ours, _ = take_ragged(data, off[hit], length)
            ids[hit[~np.logical_and.reduceat(theirs == ours, run[:-1])]] = -1
        return ids

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = self.whole(data, off)
        raw, ranks = data.tobytes(), self.vocab.ranks
        miss = np.flatnonzero(ids < 0)
        merged = [bpe.merge_by_heap(ranks, raw[off[i] : off[i + 1]]) for i in miss.tolist()]
        size = np.ones(len(ids), np.int64)
        size[miss] = [len(m) for m in merged]
        out_off = spread(size)
        out = np.zeros(out_off[-1], np.int32)
        out[out_off[:-1]] = ids
        if merged:
            at, _ = take_ragged(np.arange(len(out), dtype=np.int64), out_off[miss], size[miss])
            out[at] = np.concatenate([np.array(m, np.int32) for m in merged])
        return out, out_off


@functools.lru_cache(2)
def two_tier_cache(path: str) -> bpe.WordCache:
    return bpe.WordCache(TwoTier(bpe.Vocabulary.from_ranks(path)).encode)


def encode_slice(cache: bpe.WordCache, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each pre-token's word, and the first pre-token of each text."""
    start = bpe.pre_tokens(data, off)
    words = cache.find(data, start) if len(start) else np.zeros(0, np.int32)
    return words, np.searchsorted(start, off)


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text."""
    src = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = two_tier_cache(vocab_path)
        for rows, data, off in slices(batches, text_col):
            words, first = encode_slice(cache, data, off)
            sizes = cache.sizes(words)
            ids, _ = take_ragged(cache.ids, cache.off[words], sizes)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(pa.array(spread(sizes)[first].astype(np.int32)), pa.array(ids))], names=[id_col, "ids"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes) from ids; a null list gives no byte."""
    src = only(encoded, id_col, ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = bpe.Vocabulary.from_ranks(vocab_path)
        for rows in batches:
            lists = rows.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            first = spread(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            data, run_off = take_ragged(vocab.blob, vocab.blob_off[flat], np.diff(vocab.blob_off)[flat])
            raw, cut = data.tobytes(), run_off[first]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([raw[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=[id_col, "bytes"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, bytes binary")


def round_trip_digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    The ids are encoded and decoded as by ``encode`` and ``decode``; only their
    digests leave the worker.
    """
    src = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, vocab = two_tier_cache(vocab_path), bpe.Vocabulary.from_ranks(vocab_path)
        shown: list[bytes] = []
        generation = -1
        token_bytes = np.diff(vocab.blob_off)
        for rows, data, off in slices(batches, text_col):
            words, first = encode_slice(cache, data, off)
            if generation != cache.generation:
                shown, generation = [], cache.generation
            if len(shown) < cache.words:
                cut = cache.off[len(shown) : cache.words + 1]
                digits = list(map(str, cache.ids[cut[0] : cut[-1]].tolist()))
                cut = (cut - cut[0]).tolist()
                shown += [",".join(digits[a:b]).encode() for a, b in zip(cut[:-1], cut[1:])]
            sizes = cache.sizes(words)
            ids, _ = take_ragged(cache.ids, cache.off[words], sizes)
            by_text = spread(sizes)[first]
            decoded, token_off = take_ragged(vocab.blob, vocab.blob_off[ids], token_bytes[ids])
            raw, cut, word_list, word_cut = memoryview(decoded), token_off[by_text].tolist(), words.tolist(), first.tolist()
            ids_sha = [hashlib.sha256(b",".join(map(shown.__getitem__, word_list[a:b]))).hexdigest() for a, b in zip(word_cut[:-1], word_cut[1:])]
            text_sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(by_text)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
