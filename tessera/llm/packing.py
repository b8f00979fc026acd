"""Packing by concatenate and cut.

The first pass tokenises every text and writes, partition by partition, its ids and
the tokens before it in its partition. Prefix sums over the partitions' token totals
(one number for each partition reach the driver) then give every text its place in
one endless row of tokens. The second pass cuts that row at multiples of the
sequence length; a text that crosses cuts leaves a boundary record on either side.
Only the last sequence can need padding.

Null texts are empty: they hold the end token alone. Repeated rows are packed each
for itself. An empty table gives no row. Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, through_table
from tessera.llm.ragged import slices, spread, take_ragged
from tessera.llm.token_counts import encode_slice


def tokenise(docs: DataFrame, vocab_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, before, n, ids): little-endian ids with the end token; before: tokens of earlier rows in the partition."""
    src = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for rows, data, off in slices(batches, text_col):
            cache, words, first, (text, special) = encode_slice(vocab_path, data, off)
            own = next(iter(_special_ids(vocab_path)), end_id)
            sizes = cache.sizes(words)
            ids, _ = take_ragged(cache.ids, cache.off[words], sizes)
            last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
            # After each piece stands the special token that cut it off, or the end token.
            ids = np.insert(ids, spread(sizes)[first[1:]], np.where(last, end_id, own)[: len(text)])
            n = np.bincount(text, weights=np.diff(spread(sizes)[first]) + 1, minlength=rows.num_rows).astype(np.int64)
            at = spread(n)
            raw = ids.astype("<u4" if ids.size and ids.max() > 0xFFFF else "<u2")
            cut = (at * raw.itemsize).astype(np.int64)
            packed = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer(cut), pa.py_buffer(raw.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.full(rows.num_rows, part, np.int32)), pa.array(total + at[:-1]), pa.array(n), packed], names=[id_col, "part", "before", "n", "ids"])
            total += int(at[-1])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, part int, before bigint, n bigint, ids binary")


def _special_ids(vocab_path: str) -> list[int]:
    from tessera.llm.bpe import Vocabulary

    return list(Vocabulary.from_json(vocab_path).special.values())


def pack(docs: DataFrame, vocab_path: str, length: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    ``start`` counts the text's tokens before the piece, ``offset`` those of the
    sequence. ids: little-endian 32-bit.
    """
    tokens = through_table(tokenise(docs, vocab_path, end_id, id_col, text_col), "tokens")
    totals = sorted((r[0], r[1]) for r in tokens.groupBy("part").agg(F.max(F.col("before") + F.col("n"))).collect())
    base, total = {}, 0
    for part, n in totals:
        base[part], total = total, total + n
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            part, before, n = (rows.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            at = before + np.array([base[p] for p in part.tolist()], np.int64)
            pieces = (at + n - 1) // length - at // length + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            seq = at[doc] // length + np.arange(len(doc)) - np.repeat(spread(pieces)[:-1], pieces)
            begin = np.maximum(seq * length, at[doc]) - at[doc]
            end = np.minimum((seq + 1) * length - at[doc], n[doc])
            crc, cut, held = [], [], (-1, None)
            for d, a, b in zip(doc.tolist(), begin.tolist(), end.tolist()):
                if held[0] != d:
                    raw = rows.column(4)[d].as_buffer()
                    held = (d, np.frombuffer(raw, "<u4" if len(raw) == 4 * n[d] else "<u2").astype("<u4"))
                crc.append(zlib.crc32(held[1][a:b]))
                if with_ids:
                    cut.append(held[1][a:b].tobytes())
            columns = [rows.column(0).take(pa.array(doc)), pa.array(begin), pa.array(end - begin), pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(seq), pa.array(at[doc] + begin - seq * length)]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(cut, pa.binary())] * with_ids, names=names + ["ids"] * with_ids)

    return tokens.mapInArrow(run, f"`{id_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids binary" * with_ids)


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces of ``pack(with_ids=True)`` put together and padded.

    A sequence whose token count is a power of two stays as it is.
    """
    joined = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    pad = F.when(F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0, 0).otherwise(length - F.col("n_tokens"))
    filler = F.unhex(F.expr(f"repeat('{pad_id.to_bytes(4, 'little').hex()}', cast(pad as int))"))
    return joined.withColumn("pad", pad).select("sequence_id", "n_tokens", F.concat(F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])), filler).alias("ids"))
