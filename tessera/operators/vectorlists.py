"""Inverted lists of vectors around centres: exact search by the triangle inequality, or by a number of probes.

Vectors are taken at unit length, where the nearest by distance are the nearest by cosine. Each lies
in the list of its nearest centre; a list is in order of the distance r to the centre and cut
into blocks. A query at distance D from a centre is no nearer than |D - r| to a vector of its
list, so once k vectors are known, blocks beyond the k-th distance are left unread and
no nearer vector is lost. With ``probes`` only so many lists of a query are read.

Centres are fitted on at most ``SAMPLE`` vectors; all vectors are indexed. A vector without a length has
the cosine 0 to all. Queries go to tasks in packs by list, so that neither all queries nor a whole list
is ever held at one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.scratch import written

#: Vectors that centres are fitted on, at most; rounds of fitting; vectors in a block and queries in a pack.
SAMPLE, ROUNDS, BLOCK, PACK = 20_000, 10, 512, 256
#: Lists that a query reads before its bounds are known.
FIRST = 2
#: What sums in another order may differ by.
SLACK = 1e-9


def unit(rows: pa.Array) -> np.ndarray:
    """Rows of a list column at unit length; those without length stay."""
    width = len(rows[0]) if len(rows) else 0
    x = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), width)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def centres_of(items: DataFrame, lists: int, vector: str = "embedding", id_col: str = "id", seed: int = 7) -> np.ndarray:
    """Unit centres by spherical k-means, of a sample by a hash of the ids."""
    every = max(1, -(-items.count() // SAMPLE))
    sample = items.filter(F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(every)) == 0).orderBy(id_col).limit(SAMPLE).select(vector).toArrow()
    x = unit(sample.column(0).combine_chunks())
    if not len(x):
        return np.zeros((0, 0))
    c = x[np.random.default_rng(seed).permutation(len(x))[:lists]]
    for _ in range(ROUNDS):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.maximum(size, 1e-300), c)
    return c


def _apart(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of rows of x to rows of c."""
    return np.sqrt(np.maximum((x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1)[None] - 2 * x @ c.T, 0))


class Lists:
    """An index: (list, r_lo, r_hi, ids, rs, vectors), a block a row."""

    def __init__(self, centres: np.ndarray, blocks: DataFrame, id_type: str) -> None:
        self.centres, self.blocks, self.id_type = centres, blocks, id_type

    @staticmethod
    def build(items: DataFrame, lists: int = 64, vector: str = "embedding", id_col: str = "id") -> Lists:
        """Of items (id, vector), ids being whole numbers."""
        centres = centres_of(items, lists, vector, id_col)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = unit(batch.column(1))
                near = np.zeros(len(x), np.int64)
                r = np.zeros(len(x))
                for lo in range(0, len(x), 4096):
                    d = _apart(x[lo : lo + 4096], centres)
                    near[lo : lo + 4096], r[lo : lo + 4096] = np.argmin(d, axis=1), d.min(axis=1)
                raw = [v.tobytes() for v in x.astype("<f8")]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near.astype(np.int32)), pa.array(r), pa.array(raw, pa.binary())], names=["id", "list", "r", "v"])

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple] = []

            def block() -> pa.RecordBatch:
                ids, of, r, v = zip(*held)
                held.clear()
                cells = [of[0], r[0], r[-1], np.array(ids, "<i8").tobytes(), np.array(r, "<f8").tobytes(), b"".join(v)]
                kinds = [pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
                return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=["list", "r_lo", "r_hi", "ids", "rs", "vectors"])

            for batch in batches:
                for row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                    if held and (len(held) == BLOCK or held[0][1] != row[1]):
                        yield block()
                    held.append(row)
            if held:
                yield block()

        rows = items.select(F.col(id_col).cast("bigint").alias("id"), vector).mapInArrow(place, "id bigint, list int, r double, v binary")
        # A list of very many vectors spans as many ranges as it needs.
        placed = written(rows, "placed").repartitionByRange("list", "r", "id").sortWithinPartitions("list", "r", "id")
        blocks = placed.mapInArrow(pack, "list int, r_lo double, r_hi double, ids binary, rs binary, vectors binary")
        return Lists(centres, written(blocks, "lists"), "bigint")

    def _packs(self, asked: DataFrame, near: int | None) -> DataFrame:
        """(list, pack, queries, d, tau, vectors) of queries (query_id, query, tau): the lists to read of each.

        near: the so many nearest lists, else those whose vectors may lie within tau, but for the first ones.
        """
        centres = self.centres
        # How far a list reaches: as many rows as centres.
        reach = np.zeros((len(centres), 2))
        for of, lo, hi in self.blocks.groupBy("list").agg(F.min("r_lo"), F.max("r_hi")).collect():
            reach[of] = lo, hi
        first = min(FIRST, len(centres))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows or not len(centres):
                    continue
                q = unit(batch.column(1))
                tau = batch.column(2).to_numpy(zero_copy_only=False)
                d = _apart(q, centres)
                order = np.argsort(d, axis=1, kind="stable")
                if near is not None:
                    want = np.zeros(d.shape, bool)
                    np.put_along_axis(want, order[:, :near], True, axis=1)
                else:
                    want = (d - tau[:, None] <= reach[:, 1]) & (d + tau[:, None] >= reach[:, 0])
                    np.put_along_axis(want, order[:, :first], False, axis=1)
                i, of = np.nonzero(want)
                raw = [v.tobytes() for v in q.astype("<f8")]
                for lo in range(0, len(i), 1 << 14):
                    a, b = i[lo : lo + (1 << 14)], of[lo : lo + (1 << 14)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(a)), pa.array(b.astype(np.int32)), pa.array(d[a, b]), pa.array(tau[a]), pa.array([raw[k] for k in a.tolist()], pa.binary())], names=["query_id", "list", "d", "tau", "v"])

        rows = asked.select(F.col("query_id").cast("bigint"), "query", "tau").mapInArrow(deal, "query_id bigint, list int, d double, tau double, v binary")
        # Queries of a list in packs; a popular list has many.
        spread = rows.withColumn("pack", F.pmod(F.xxhash64("query_id"), F.lit(max(1, -(-asked.count() // PACK)))))
        return spread.groupBy("list", "pack").agg(F.collect_list(F.struct("query_id", "d", "tau", "v")).alias("q"), F.max(F.col("d") + F.col("tau")).alias("most"), F.min(F.col("d") - F.col("tau")).alias("least"))

    def _scored(self, packs: DataFrame, k: int) -> DataFrame:
        """(query_id, id, cosine): of each block and query, at most k nearest and the ties of the last, within the query's bound."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for asked, ids, rs, vectors in zip(*[batch.column(i) for i in range(4)]):
                    ids, rs = np.frombuffer(ids.as_buffer(), "<i8"), np.frombuffer(rs.as_buffer(), "<f8")
                    x = np.frombuffer(vectors.as_buffer(), "<f8").reshape(len(ids), -1)
                    asked = asked.as_py()
                    name, d, tau = (np.array([a[c] for a in asked]) for c in ("query_id", "d", "tau"))
                    # Queries that may have a vector of this block within their bound.
                    some = np.flatnonzero((d - tau <= rs[-1]) & (d + tau >= rs[0]))
                    if not len(some):
                        continue
                    q = np.frombuffer(b"".join(asked[i]["v"] for i in some.tolist()), "<f8").reshape(len(some), -1)
                    score = x @ q.T
                    edge = np.partition(score, -k, axis=0)[-k] if len(x) > k else np.full(len(some), -np.inf)
                    edge = np.maximum(edge, 1 - tau[some] ** 2 / 2 - SLACK)
                    row, col = np.nonzero(score >= edge)
                    yield pa.RecordBatch.from_arrays([pa.array(name[some][col]), pa.array(ids[row]), pa.array(score[row, col])], names=["query_id", "id", "cosine"])

        reach = (F.col("p.list") == F.col("b.list")) & (F.col("p.least") <= F.col("b.r_hi")) & (F.col("p.most") >= F.col("b.r_lo"))
        met = self.blocks.alias("b").join(packs.alias("p"), reach).select("p.q", "b.ids", "b.rs", "b.vectors")
        return met.mapInArrow(run, "query_id bigint, id bigint, cosine double")

    def nearest(self, queries: DataFrame, k: int, probes: int | None = None) -> DataFrame:
        """(query_id, id, cosine, rank): the k nearest vectors of queries (query_id, query); exact unless a number of probes is given."""
        order = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "id")
        ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        asked = queries.select("query_id", "query", F.lit(2.0).alias("tau"))
        soon = self._scored(self._packs(asked, probes or FIRST), k)
        if probes:
            return ranked(soon)
        found = written(ranked(soon), "first")
        # The k-th distance so far; the widest where there are fewer.
        bound = found.groupBy("query_id").agg(F.min("cosine").alias("c"), F.count("*").alias("n")).select("query_id", F.when(F.col("n") < k, 2.0).otherwise(F.least(F.lit(2.0), F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("c"))) + SLACK)).alias("tau"))
        asked = written(queries.select(F.col("query_id").cast("bigint"), "query").join(bound, "query_id", "left").withColumn("tau", F.coalesce("tau", F.lit(2.0))), "bounds")
        return ranked(found.drop("rank").unionByName(self._scored(self._packs(asked, None), k)))

    def read_share(self, queries: DataFrame, k: int) -> tuple[int, int]:
        """(vectors that exact search compares, all pairs of queries and vectors)."""
        found = self.nearest(queries, k)
        bound = found.groupBy("query_id").agg(F.min("cosine").alias("c")).select("query_id", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("c"))).alias("tau"))
        asked = queries.select(F.col("query_id").cast("bigint"), "query").join(bound, "query_id")
        size = self.blocks.select("list", "r_lo", "r_hi", (F.octet_length("ids") / 8).cast("long").alias("n"))
        one = self._packs(asked, len(self.centres)).select("list", F.explode("q").alias("q")).select("list", "q.d", "q.tau")
        reach = (F.col("d") - F.col("tau") <= F.col("r_hi")) & (F.col("d") + F.col("tau") >= F.col("r_lo"))
        read = one.join(size, "list").filter(reach).agg(F.sum("n")).first()[0] or 0
        return read, asked.count() * (size.agg(F.sum("n")).first()[0] or 0)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact answers (query_id, id) that were found."""
    return exact.join(found, ["query_id", "id"], "left_semi").count() / max(1, exact.count())
