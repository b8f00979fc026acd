"""Importance resampling towards a target: hashed n-grams of words, counted through suffix arrays.

Words of a slice of texts become ids. The slice's suffix array, sorted as deep as the longest
n-gram, brings equal n-grams together: a run of suffixes whose common prefix (LCP) holds k
words or more is one distinct k-gram. Each run is hashed once, from the CRCs of its words,
and its bucket is scattered back to all places of the run. Texts are read twice: to count
the buckets of the whole corpus, and to score. Between the passes only one number a bucket
is held on the driver. The draw is a total order by score, whose ranks come from a range
sort and the counts of its partitions.

Null texts have no word; an empty text has no feature and the weight 0. Repeated rows count and
are scored each for itself. A null id is named by the empty string in the draw and is the
largest among ties. An empty table gives no row; with an empty target all its counts are 0.
Only the id and text columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import only, through_table
from tessera.llm.ragged import numbered, per_run, prefix_hash, slices

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words, once in lower case: digits, letters, and all beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in lower case, start and end of each word, first word of each text)."""
    low = LOWER[data]
    inside = WORD[low]
    heads = off[:-1][np.diff(off) > 0]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[heads] = inside[heads]
    stop = np.append(~inside, True)
    stop[heads] = True
    start = np.flatnonzero(begin)
    edge = np.flatnonzero(stop)
    end = edge[np.searchsorted(edge, start + 1)] if len(start) else start
    return low, start, end, np.searchsorted(start, off)


def suffix_array(ids: np.ndarray, left: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): suffixes of word ids, sorted by their first ``depth`` words; words that neighbours share.

    left: how many words of its text stand at or after each place; a suffix ends there.
    """
    n = len(ids)
    base = int(ids.max(initial=0)) + 2
    key, span = ids + 1, base
    at = np.arange(n)
    for k in range(1, depth):
        if span > (1 << 62) // base:
            _, key = np.unique(key, return_inverse=True)
            span = int(key.max(initial=0)) + 1
        key = key * base + np.where(left > k, ids[np.minimum(at + k, n - 1)] + 1, 0)
        span *= base
    order = np.argsort(key, kind="stable")
    lcp, same = np.zeros(n, np.int64), np.ones(max(n - 1, 0), bool)
    a, b = order[:-1], order[1:]
    for k in range(depth):
        same = same & (left[a] > k) & (left[b] > k)
        same[same] = ids[a[same] + k] == ids[b[same] + k]
        lcp[1:] += same
    return order, lcp


def _advance(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    return tables[0][c & 255] ^ tables[1][(c >> 8) & 255] ^ tables[2][(c >> 16) & 255] ^ tables[3][c >> 24]


class Crc:
    """CRC-32 of joined strings from those of their parts: zero bytes act linearly on a register."""

    def __init__(self) -> None:
        one = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
        lanes = [np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)]
        step = np.stack([(x >> np.uint32(8)) ^ one[x & 255] for x in lanes])
        #: By 2**k bytes.
        self.steps = [step]

    def shifted(self, c: np.ndarray, by: np.ndarray) -> np.ndarray:
        c, k = c.copy(), 0
        while (1 << k) <= int(by.max(initial=0)):
            if k == len(self.steps):
                self.steps.append(np.stack([_advance(self.steps[-1], t) for t in self.steps[-1]]))
            some = np.flatnonzero((by >> k) & 1)
            c[some] = _advance(self.steps[k], c[some])
            k += 1
        return c

    def joined(self, c: np.ndarray, more: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of a string, a space, and a string of this CRC and length."""
        spaced = _advance(self.steps[0], c) ^ np.uint32(zlib.crc32(b" "))
        return self.shifted(spaced, length) ^ more


def feature_buckets(data: np.ndarray, off: np.ndarray, depth: int, buckets: int, crc: Crc) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(first word of each text, for each length the bucket at every place or -1, buckets of distinct n-grams with their counts (2, x))."""
    low, start, end, first = words_of(data, off)
    n = len(start)
    if not n:
        return first, [np.zeros(0, np.int64)] * depth, np.zeros((2, 0), np.int64)
    ids = numbered(low, start, end, prefix_hash(low))
    _, one = np.unique(ids, return_index=True)
    raw = low.tobytes()
    known = np.zeros(int(ids.max()) + 1, np.uint32)
    known[ids[one]] = [zlib.crc32(raw[a:b]) for a, b in zip(start[one].tolist(), end[one].tolist())]
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    order, lcp = suffix_array(ids, left, depth)
    length, found, runs = end - start, [], []
    for k in range(1, depth + 1):
        whole = left[order] >= k
        fresh = np.flatnonzero(whole & (lcp < k))
        rep = order[fresh]
        h = known[ids[rep]]
        for j in range(1, k):
            h = crc.joined(h, known[ids[rep + j]], length[rep + j])
        bucket = h.astype(np.int64) % buckets
        # Suffixes that end before k words stand outside of all runs.
        run = np.cumsum(whole & (lcp < k)) - 1
        place = np.full(n, -1, np.int64)
        place[order[whole]] = bucket[run[whole]]
        found.append(place)
        runs.append(np.stack([bucket, np.bincount(run[whole], minlength=len(fresh))]))
    return first, found, np.concatenate(runs, axis=1)


def bucket_counts(docs: DataFrame, depth: int = 2, buckets: int = 10_000, text_col: str = "text") -> np.ndarray:
    """How many features of all texts lie in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = Crc(), np.zeros(buckets, np.int64)
        for _, data, off in slices(batches, text_col):
            bucket, times = feature_buckets(data, off, depth, buckets, crc)[2]
            total += np.bincount(bucket, weights=times, minlength=buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    # As many rows as buckets.
    for bucket, n in only(docs, text_col).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(own: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """A thousand times the log-ratio of smoothed shares, in whole numbers."""
    n, all_own, all_wanted = len(own), int(own.sum()), int(wanted.sum())
    ratio = lambda s, t: float(t + 1) * float(all_own + n) / (float(s + 1) * float(all_wanted + n))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(own.tolist(), wanted.tolist())], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, depth: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean of the gains of each text's features."""
    src = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = Crc()
        for rows, data, off in slices(batches, text_col):
            first, found, _ = feature_buckets(data, off, depth, len(gains), crc)
            total, n = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
            for bucket in found:
                total += per_run(np.where(bucket < 0, 0, gains[bucket]), first)
                n += per_run(bucket >= 0, first)
            mean = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first)), pa.array(n), pa.array(mean)], names=["id", "n_words", "n_features", "weight"])

    return src.mapInArrow(run, f"id {src.schema[id_col].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, depth: int = 2, buckets: int = 10_000, percent: int = 25, least_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank): of the texts with ``least_words``, ``percent`` of a hundred are drawn.

    The draw is by Gumbel noise, a function of seed and id: the highest scores, ties to the
    smaller id. The rank of what isn't drawn is null.
    """
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(docs, depth, buckets, text_col), bucket_counts(target, depth, buckets, text_col))
    held = through_table(weights(docs, gains, depth, id_col, text_col), "weights")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = held.select("id", "n_features", "weight", (F.col("weight") + noise).cast("long").alias("score"), (F.col("n_words") >= least_words).alias("fit"))
    # A row's number in its partition of the order, and the partition's own number, are the two parts of this id.
    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last("id")]
    ranked = through_table(scored.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(ranked.groupBy(part).agg(F.count_if("fit")).collect())
    before = np.cumsum([0, *[n for _, n in counts]]).tolist()
    # One row a partition.
    offsets = F.broadcast(spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "part bigint, before bigint"))
    rank = F.col("before") + place + 1
    drawn = F.col("fit") & (rank <= F.lit(percent * before[-1] // 100))
    return ranked.withColumn("part", part).join(offsets, "part").select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(drawn, rank).alias("rank"))
