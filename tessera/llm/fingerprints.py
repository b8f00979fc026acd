"""Document fingerprints by content-defined chunking.

A gear hash over the last ``WINDOW`` bytes marks places that may end a chunk; it is
normalised: before the usual size a place must pass a stricter mask, after it a looser
one. A boundary depends on the bytes before it alone, so an insertion moves chunks
without changing those far from it. A fingerprint is the set of a text's chunk
digests with their lengths; likeness is containment, weighted by length.

The fingerprint string has, for each different chunk in text order, twelve hexadecimal
digits of digest and four of length; an empty text's is empty. Null texts are empty.
Two empty fingerprints are alike (1), an empty one is unlike any other (0). Repeated
rows are fingerprinted each for itself; an empty table gives no row. Only the id and
text columns are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only
from tessera.llm.ragged import U64, mix, prefix_hash, slices, span_hash, spread

WINDOW = 32
#: Ids for each range of ids from which the ranges' bounds are taken.
BOUND_SAMPLE = 16
LEAST, USUAL, MOST = 16, 32, 160
#: The top bits that must be zero before and after the usual size.
STRICT, LOOSE = np.uint32(0b111111 << 26), np.uint32(0b1111 << 28)


@functools.lru_cache(1)
def _gear() -> np.ndarray:
    return (mix(np.arange(1, 257, dtype=U64)) >> U64(32)).astype(np.uint32)


def chunks(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of every chunk, first chunk of each text); a chunk ends where the next one or its text ends."""
    n = len(off) - 1
    lengths = np.diff(off)
    # Between two texts stand bytes that add nothing, so no window sees another text.
    gap = WINDOW * np.arange(n)
    h = np.zeros(len(data) + WINDOW * n, np.uint32)
    h[np.arange(len(data)) + np.repeat(gap, lengths)] = _gear()[data]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    strict, loose = np.flatnonzero((h & STRICT) == 0), np.flatnonzero((h & LOOSE) == 0)
    far = len(h) + MOST + 1
    strict, loose = np.append(strict, far), np.append(loose, far)
    live = np.flatnonzero(lengths)
    at, end = off[live] + gap[live], off[live + 1] + gap[live]
    found, owner = [], []
    while len(live):
        found.append(at - gap[live])
        owner.append(live)
        cut = strict[np.searchsorted(strict, at + LEAST - 1)] + 1
        late = cut > at + USUAL
        if late.any():
            cut[late] = loose[np.searchsorted(loose, at[late] + USUAL - 1)] + 1
        at = np.minimum(np.minimum(cut, at + MOST), end)
        more = at < end
        live, at, end = live[more], at[more], end[more]
    if not found:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    start = np.sort(np.concatenate(found))
    return start, np.searchsorted(start, off)


def chunk_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct chunks of each text in order, first chunk of each text); 48 bits of digest, 16 of length."""
    start, first = chunks(data, off)
    bounds = np.append(start, len(data))
    size = np.minimum(bounds[1:], off[1:][np.searchsorted(off, start, "right") - 1]) - start if len(start) else start
    code = (span_hash(prefix_hash(data), start, start + size) & ~U64(0xFFFF)) | size.astype(U64)
    text = np.repeat(np.arange(len(off) - 1), np.diff(first))
    _, earliest = np.unique(mix(code + mix(text.astype(U64) + U64(1))), return_index=True)
    keep = np.sort(earliest)
    return code[keep], spread(np.bincount(text[keep], minlength=len(off) - 1))


def render(code: np.ndarray, first: np.ndarray) -> list[str]:
    shown = code.astype(">u8").tobytes().hex()
    cut = (first * 16).tolist()
    return [shown[a:b] for a, b in zip(cut[:-1], cut[1:])]


def containment(code: np.ndarray, first: np.ndarray, other: np.ndarray, other_first: np.ndarray) -> np.ndarray:
    """How much of the first fingerprint's length is in the second one, pair by pair."""
    n = len(first) - 1
    salt = mix(np.arange(1, n + 1, dtype=U64))
    text = np.repeat(np.arange(n), np.diff(first))
    ours = mix(code + salt[text])
    theirs = mix(other + np.repeat(salt, np.diff(other_first)))
    length = (code & U64(0xFFFF)).astype(np.float64)
    whole = np.bincount(text, weights=length, minlength=n)
    shared = np.bincount(text, weights=length * np.isin(ours, theirs), minlength=n)
    both_empty = (whole == 0) & (np.diff(other_first) == 0)
    return np.where(whole > 0, shared / np.maximum(whole, 1), both_empty.astype(float))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every whole text."""
    src = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, off in slices(batches, text_col):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(render(*chunk_sets(data, off)), pa.string())], names=[id_col, "fingerprint"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, fingerprint string")


def with_successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts dealt to ranges of ids, each range followed by the text that comes after its last one.

    Ids descend; after the smallest comes the largest. Columns: id, text, guest. One
    row for each range is sent twice; the bounds and those rows' ids are all that the
    driver sees. Equal ids follow each other by their texts' hashes; null ids are last.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The bounds only balance the ranges: those of the ids with the smallest hashes, so many a range.
    some = src.select("id").filter("id is not null").orderBy(F.xxhash64("id"), "id").limit(BOUND_SAMPLE * ranges).collect()
    some = sorted(r[0] for r in some)
    bounds = sorted({some[len(some) * i // ranges] for i in range(1, ranges)}) if some else []

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        held = ids.is_valid().to_numpy(zero_copy_only=False)
        out = np.where(held, 0, -1).astype(np.int32)
        if bounds:
            edges = pa.array(bounds, ids.type).to_numpy(zero_copy_only=False)
            out[held] = np.searchsorted(edges, ids.drop_null().to_numpy(zero_copy_only=False), "right")
        return pa.array(out)

    src = src.withColumn("bucket", range_of("id"))
    tops = {r[0]: r[1] for r in src.groupBy("bucket").agg(F.max("id")).collect()}
    order = sorted(tops, reverse=True)
    guests = [(tops[b], a) for a, b in zip(order[:-1], order[1:])] + ([(tops[order[0]], order[-1])] if order else [])
    hosts = F.broadcast(spark.createDataFrame(guests, f"top {docs.schema[id_col].dataType.simpleString()}, host int"))
    visiting = src.join(hosts, F.col("id").eqNullSafe(F.col("top"))).select("id", "text", F.col("host").alias("bucket"), F.lit(True).alias("guest"))
    every = src.select("id", "text", "bucket", F.lit(False).alias("guest")).unionByName(visiting)
    return every.repartition(ranges // 4, "bucket").sortWithinPartitions("bucket", "guest", F.col("id").desc_nulls_last(), F.xxhash64("text")).select("id", "text", "bucket", "guest")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every text.

    In the edited text the last floor(n_chars / 2) code points have given way to the
    first as many of the next text.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for rows, _, _ in slices(batches, "text", 1 << 20):
            both = rows if held is None else pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
            held = both.slice(both.num_rows - 1)
            guest, bucket = both.column(3).to_numpy(zero_copy_only=False), both.column(2).to_numpy(zero_copy_only=False)
            # A row is answered when its successor is there; guests are successors alone.
            own = np.flatnonzero(~guest[:-1] & (bucket[:-1] == bucket[1:]))
            if not len(own):
                continue
            texts = both.column(1).to_pylist()
            used = np.unique(np.concatenate([own, own + 1]))
            raw = [texts[i].encode() for i in used.tolist()]
            code, first = chunk_sets(np.frombuffer(b"".join(raw), np.uint8), spread(np.array([len(r) for r in raw], np.int64)))
            edited, n_chars = [], []
            for i in own.tolist():
                t = texts[i]
                half = len(t) // 2
                n_chars.append(len(t))
                edited.append((t[: len(t) - half] + texts[i + 1][:half]).encode())
            new, new_first = chunk_sets(np.frombuffer(b"".join(edited), np.uint8), spread(np.array([len(r) for r in edited], np.int64)))
            a, b = np.searchsorted(used, own), np.searchsorted(used, own + 1)
            mine, mine_first = _take(code, first, a)
            yield pa.RecordBatch.from_arrays(
                [both.column(0).take(pa.array(own)), pa.array(n_chars, pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()), pa.array(render(mine, mine_first), pa.string()), pa.array(render(new, new_first), pa.string()), pa.array(containment(mine, mine_first, new, new_first)), pa.array(containment(mine, mine_first, *_take(code, first, b)))],
                names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return with_successors(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _take(code: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    from tessera.llm.ragged import take_ragged

    return take_ragged(code, first[which], np.diff(first)[which])
