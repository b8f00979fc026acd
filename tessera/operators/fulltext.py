"""A written full-text index: postings bucketed by token, with positions, block maxima and segments.

A segment is one batch of documents: ``docs`` has each document's length, ``postings`` blocks
of at most ``BLOCK`` documents of a token, in order of their ids. A block holds ids and
positions as differences, and the largest count and the smallest length of its documents,
which bound every score in it. Folders are split by the token's bucket and files are in order
of tokens, so a query opens the files of its tokens only; no query reads a text.

A document that comes again, or goes, is written to a new segment; older postings of its
id count no more. ``merge`` makes one segment of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import fold
from tessera.scratch import written

BLOCK, BUCKETS = 128, 16
K1, B = 1.2, 0.75
_LISTED = "token string, id bigint, n_tokens int, tf int, steps array<int>"
_BLOCKS = "bucket int, token string, first_id bigint, last_id bigint, n int, max_tf int, min_tokens int, ids array<bigint>, lengths array<int>, tfs array<int>, steps array<int>"


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, id, n_tokens, tf, steps) for each token of each document (id, w): where it stands, as differences."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        words = batch.column(1)
        words = words.fill_null([]) if words.null_count else words
        length = np.diff(words.offsets.to_numpy())
        flat = words.flatten().dictionary_encode()
        code = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), length)
        pos = np.arange(len(code)) - np.repeat(np.cumsum(length) - length, length)
        key = doc * (len(flat.dictionary) + 1) + code
        order = np.argsort(key, kind="stable")
        head = np.flatnonzero(np.diff(key[order], prepend=-1))
        step = np.diff(pos[order], prepend=0)
        step[head] = pos[order][head]
        at = order[head]
        cut = np.append(head, len(order)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [flat.dictionary.take(pa.array(code[at])), pa.array(ids[doc[at]]), pa.array(length[doc[at]].astype(np.int32)), pa.array(np.diff(cut)), pa.ListArray.from_arrays(pa.array(cut), pa.array(step.astype(np.int32)))],
            names=["token", "id", "n_tokens", "tf", "steps"],
        )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of postings that come in order of bucket, token and id."""
    held: list[dict] = []

    def block() -> dict:
        ids = [r["id"] for r in held]
        out = {"bucket": held[0]["bucket"], "token": held[0]["token"], "first_id": ids[0], "last_id": ids[-1], "n": len(ids), "max_tf": max(r["tf"] for r in held), "min_tokens": min(r["n_tokens"] for r in held)}
        return out | {"ids": [ids[0], *np.diff(ids).tolist()], "lengths": [r["n_tokens"] for r in held], "tfs": [r["tf"] for r in held], "steps": [s for r in held for s in r["steps"]]}

    kinds = pa.schema([("bucket", pa.int32()), ("token", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n", pa.int32()), ("max_tf", pa.int32()), ("min_tokens", pa.int32()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())), ("steps", pa.list_(pa.int32()))])
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if held and (len(held) == BLOCK or row["token"] != held[0]["token"]):
                done.append(block())
                held = []
            held.append(row)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=kinds)
    if held:
        yield pa.RecordBatch.from_pylist([block()], schema=kinds)


def _running(steps: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Running sums that start anew with each run."""
    total = np.cumsum(steps)
    start = np.cumsum(length) - length
    full = length > 0
    return total - np.repeat((total[start[full]] - steps[start[full]]), length[full])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each posting of blocks (segment, token, ids, lengths, tfs[, steps])."""
    for batch in batches:
        n = np.diff(batch.column(2).offsets.to_numpy())
        flat = lambda i: batch.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64)  # noqa: B023, E731
        owner, tf = pa.array(np.repeat(np.arange(len(n)), n)), flat(4)
        out = [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(_running(flat(2), n)), pa.array(flat(3).astype(np.int32)), pa.array(tf.astype(np.int32))]
        if batch.num_columns > 5:
            out.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(tf)).astype(np.int32)), pa.array(_running(flat(5), tf).astype(np.int32))))
        yield pa.RecordBatch.from_arrays(out, names=["segment", "token", "id", "n_tokens", "tf", "pos"][: len(out)])


class Index:
    """The index in a folder. Documents have whole numbers as ids."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # Writing.

    def add(self, docs: DataFrame, id_col: str = "id", text: str = "text") -> Index:
        """A segment of documents, new or again; a null text has no token. An id may stand once in ``docs``."""
        words = docs.select(F.col(id_col).cast("bigint").alias("id"), F.split(fold(F.col(text)), " ").alias("w"))
        words = words.select("id", F.filter("w", lambda w: w != "").alias("w"))
        # Folding happens once: what comes out of the Arrow pass is written before it is sorted.
        return self._segment(written(words, "words"))

    def remove(self, ids: DataFrame) -> Index:
        """Documents (id) that go."""
        return self._segment(ids.select(F.col("id").cast("bigint").alias("id"), F.lit(None).cast("array<string>").alias("w")))

    def _segment(self, words: DataFrame) -> Index:
        to = f"{self.path}/segment={self._segments()}"
        words.select("id", F.when(F.col("w").isNotNull(), F.size("w")).alias("n_tokens")).write.parquet(f"{to}/docs")
        self._sorted(words.filter("w is not null").mapInArrow(_per_document, _LISTED), f"{to}/postings")
        return self

    def _sorted(self, postings: DataFrame, to: str) -> None:
        bucket = F.pmod(F.xxhash64("token"), F.lit(self.buckets)).cast("int").alias("bucket")
        # A token of all documents spans as many ranges as it needs.
        order = ["bucket", "token", "id"]
        rows = postings.select(bucket, "*").repartitionByRange(*order).sortWithinPartitions(*order)
        rows.mapInArrow(_blocks, _BLOCKS).write.partitionBy("bucket").parquet(to)

    def merge(self, path: str) -> Index:
        """The live documents as one segment of a new folder."""
        new = Index(self.spark, path, self.buckets)
        self.documents().select("id", "n_tokens").write.parquet(f"{new.path}/segment=0/docs")
        steps = F.zip_with("pos", F.concat(F.array(F.lit(0)), F.slice("pos", F.lit(1), F.size("pos") - 1)), lambda a, b: a - b)
        new._sorted(self._live(self._table("postings"), True).select("token", "id", "n_tokens", "tf", steps.alias("steps")), f"{new.path}/segment=0/postings")
        return new

    # Reading.

    def _files(self):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop, hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _segments(self) -> int:
        folder, fs = self._files()
        return len(fs.listStatus(folder)) if fs.exists(folder) else 0

    def _table(self, kind: str) -> DataFrame:
        extra = "id bigint, n_tokens int" if kind == "docs" else _BLOCKS
        parts = [self.spark.read.schema(extra).parquet(f"{self.path}/segment={i}/{kind}").withColumn("segment", F.lit(i)) for i in range(self._segments())]
        return reduce(DataFrame.unionByName, parts)

    def documents(self) -> DataFrame:
        """(id, n_tokens, segment) of the documents that count: the last row of each id, unless it says that it goes."""
        every = self._table("docs")
        if self._segments() > 1:
            every = every.groupBy("id").agg(F.max_by(F.struct("n_tokens", "segment"), "segment").alias("w")).select("id", "w.*")
        return every.filter("n_tokens is not null")

    def corpus(self) -> tuple[int, float]:
        """(documents with a token, their mean length)."""
        n, mean = self.documents().filter("n_tokens > 0").agg(F.count("*"), F.avg("n_tokens")).first()
        return n, mean or 1.0

    def blocks(self, tokens: list[str]) -> DataFrame:
        """The blocks of these tokens; only their buckets are opened."""
        buckets = self.spark.createDataFrame([(t,) for t in tokens], "token string").select(F.pmod(F.xxhash64("token"), F.lit(self.buckets)).cast("int")).collect()
        return self._table("postings").filter(F.col("bucket").isin(sorted({r[0] for r in buckets})) & F.col("token").isin(tokens))

    def _live(self, blocks: DataFrame, positions: bool = False) -> DataFrame:
        """(token, id, n_tokens, tf) of the blocks' postings that count, and ``pos``, the places."""
        columns = ["segment", "token", "ids", "lengths", "tfs"] + ["steps"] * positions
        rows = blocks.select(*columns).mapInArrow(_opened, "segment int, token string, id bigint, n_tokens int, tf int" + ", pos array<int>" * positions)
        if self._segments() > 1:
            rows = rows.join(self.documents().select("id", "segment"), ["id", "segment"], "left_semi")
        return rows.drop("segment")

    def postings(self, tokens: list[str]) -> DataFrame:
        """(token, id, n_tokens, tf, pos): postings of the tokens, with positions."""
        return self._live(self.blocks(tokens), True)

    # Queries.

    def _frequencies(self, tokens: list[str]) -> dict[str, int]:
        found = self.blocks(tokens)
        counted = found.groupBy("token").agg(F.sum("n").alias("df")) if self._segments() == 1 else self._live(found).groupBy("token").agg(F.count("*").alias("df"))
        return {r["token"]: r["df"] for r in counted.collect()}

    def _gain(self, df: dict[str, int], n_docs: int, mean: float, tf: str, length: str) -> Column:
        """A posting's part of the score, by BM25."""
        idf = F.lit(0.0)
        for token, d in df.items():
            idf = F.when(F.col("token") == token, F.log(F.lit(1 + (n_docs - d + 0.5) / (d + 0.5)))).otherwise(idf)
        return idf * F.col(tf) * (K1 + 1) / (F.col(tf) + K1 * (1 - B + B * F.col(length) / F.lit(mean)))

    def scores(self, tokens: list[str]) -> DataFrame:
        """(id, score) of all documents with any of the tokens."""
        tokens = list(dict.fromkeys(tokens))
        (n, mean), df = self.corpus(), self._frequencies(tokens)
        return self._live(self.blocks(tokens)).groupBy("id").agg(F.sum(self._gain(df, n, mean, "tf", "n_tokens")).alias("score"))

    def best(self, tokens: list[str], k: int) -> DataFrame:
        """(id, score): the k best of ``scores``, ties by id, from the blocks that can hold them.

        The blocks of the highest bounds are scored first; the k-th best of those sums is a floor,
        as sums only grow. A block goes if its bound and the largest bounds of the other tokens stay
        below the floor: no document of it can reach the k best, and a document that does has
        all its blocks.
        """
        tokens = list(dict.fromkeys(tokens))
        (n, mean), df = self.corpus(), self._frequencies(tokens)
        bounded = self.blocks(tokens).withColumn("bound", self._gain(df, n, mean, "max_tf", "min_tokens"))
        return self._sum(self._kept(bounded, df, n, mean, k), df, n, mean).orderBy(F.desc("score"), "id").limit(k)

    def _sum(self, blocks: DataFrame, df: dict[str, int], n: int, mean: float) -> DataFrame:
        return self._live(blocks).groupBy("id").agg(F.sum(self._gain(df, n, mean, "tf", "n_tokens")).alias("score"))

    def _kept(self, bounded: DataFrame, df: dict[str, int], n: int, mean: float, k: int) -> DataFrame:
        most = {r["token"]: r["m"] for r in bounded.groupBy("token").agg(F.max("bound").alias("m")).collect()}
        first = bounded.orderBy(F.desc("bound"), "token", "first_id", "segment").limit(max(2, 2 * -(-k // BLOCK)))
        reached = self._sum(first, df, n, mean).orderBy(F.desc("score")).limit(k).collect()
        if len(reached) < k:
            return bounded
        others = F.lit(0.0)
        for token, m in most.items():
            others = F.when(F.col("token") == token, F.lit(sum(most.values()) - m)).otherwise(others)
        # A floor a little lower: sums in another order may differ in their last digits.
        return bounded.filter(F.col("bound") + others >= F.lit(reached[-1]["score"] * (1 - 1e-9)))

    def blocks_read(self, tokens: list[str], k: int) -> tuple[int, int]:
        """(blocks that ``best`` scores, blocks of the tokens)."""
        tokens = list(dict.fromkeys(tokens))
        (n, mean), df = self.corpus(), self._frequencies(tokens)
        bounded = self.blocks(tokens).withColumn("bound", self._gain(df, n, mean, "max_tf", "min_tokens"))
        return self._kept(bounded, df, n, mean, k).count(), bounded.count()

    def phrase(self, words: list[str]) -> DataFrame:
        """(id, n): documents and the places where the words follow each other. Postings of each word meet by id."""
        found = self.postings(list(dict.fromkeys(words)))
        out = None
        for i, word in enumerate(words):
            start = F.transform("pos", lambda p: p - i)  # noqa: B023
            one = found.filter(F.col("token") == word).select("id", start.alias(f"p{i}"))
            out = one if out is None else out.join(one, "id").withColumn("p0", F.array_intersect("p0", f"p{i}")).filter(F.size("p0") > 0).select("id", "p0")
        return out.select("id", F.size("p0").cast("long").alias("n"))

    def phrase_against_words(self, words: list[str]) -> DataFrame:
        """(n_phrase, n_any): documents with the phrase, and with any of its words."""
        any_ = self._live(self.blocks(list(dict.fromkeys(words)))).select("id").distinct().agg(F.count("*").alias("n_any"))
        return self.phrase(words).agg(F.count("*").alias("n_phrase")).crossJoin(F.broadcast(any_))

    def similar(self, word: str, most: int = 2) -> DataFrame:
        """(token, distance): tokens within an edit distance; each is compared once, postings aren't read."""
        rows = self._table("postings")
        near = lambda t: t.select("token").distinct().withColumn("distance", F.levenshtein("token", F.lit(word), most)).filter("distance >= 0")
        if self._segments() == 1:
            return near(rows)
        # Of the few tokens that are near, those that a document still has.
        return self._live(rows.join(F.broadcast(near(rows).select("token")), "token", "left_semi")).select("token").distinct().transform(near)


_built: dict[tuple[str, str], Index] = {}


def index_of(docs: DataFrame, name: str, id_col: str, text: str) -> Index:
    """The index of a table's text, built at its first use in an application."""
    from tessera.scratch import shared_dir

    spark = docs.sparkSession
    key = (spark.sparkContext.applicationId, name)
    if key not in _built:
        _built[key] = Index(spark, shared_dir(spark, "index")).add(docs, id_col, text)
    return _built[key]
