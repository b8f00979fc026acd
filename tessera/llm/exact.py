"""Exact duplicates by a content sort: equal normalised texts become neighbours and are compared whole.

Spark samples splitters of (first bytes, hash) and range-partitions the rows by them; an
external sort inside each partition places equal texts next to each other, and the
window over the whole normalised text compares each row with its neighbour. Splitters
hold no whole text, so what is sampled stays small however long the texts are; the hash
orders texts that begin alike, so a common beginning is no hot range.

A text with very many copies would land in one range. Hashes are counted first; a hot one
(more rows than a quarter of a partition's share) is cut into cells of that size by a salt
of the id. Each cell sends on its first row alone, and those, at most a few for each
partition in all, are sorted and compared once more. There is no hash that is trusted:
only texts that were compared whole are equal, but for the last join of hot rows to their
group, which goes by SHA-256.

Null texts count as empty, and empty texts equal each other. Repeated rows are copies of
each other: one of them stays, and ties between equal ids are broken arbitrarily. A null id is the
largest. An empty table gives no row. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import only, text_of, through_table

#: What texts are compared without.
SPACES = r"[\x20\x09-\x0D]"
#: Characters of a text's beginning that splitters hold.
HEAD = 32
#: A hash is hot beyond this share of a partition's rows; smaller groups are never cut.
SHARE, LEAST = 4, 16


def _sorted(rows: DataFrame, *salt: str) -> tuple[DataFrame, list[str]]:
    """(rows in content order, what equal neighbours agree on)."""
    return rows.repartitionByRange("head", "h", *salt), ["head", "h", *salt, "norm"]


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row.

    Of equal texts the row with the most code points stays, then the smallest id.
    """
    spark = docs.sparkSession
    src = only(docs, id_col, text_col).select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    norm = F.regexp_replace("text", SPACES, "")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(LEAST, docs.count() // (SHARE * parts))
    # At most SHARE hashes a partition can be as frequent as that.
    hot = src.groupBy(F.xxhash64(norm).alias("h")).agg(F.count("*").alias("c")).filter(F.col("c") > limit)
    hot = F.broadcast(hot.select("h", F.ceil(F.col("c") / limit).alias("cells")))

    rows = src.select("id", F.length("text").alias("n"), norm.alias("norm"), F.xxhash64(norm).alias("h"), F.substring(norm, 1, HEAD).alias("head")).join(hot, "h", "left")
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), "cells"), F.lit(0)))
    rows, same = _sorted(rows, "salt")
    first = Window.partitionBy(*same).orderBy(F.desc("n"), F.asc_nulls_last("id"))
    cell = rows.select("*", F.row_number().over(first).alias("place"), F.first("id").over(first).alias("keep"), F.count("*").over(Window.partitionBy(*same)).alias("size"))
    sends = F.col("cells").isNotNull() & (F.col("place") == 1)
    cell = through_table(cell.select("id", "n", "h", "salt", "place", "keep", "size", F.sha2("norm", 256).alias("digest"), F.when(sends, F.col("norm")).alias("norm"), sends.alias("sends")), "cells")

    heads = cell.filter("sends").select("h", "norm", "digest", "n", "keep", "size", "salt", F.substring("norm", 1, HEAD).alias("head"))
    heads, same = _sorted(heads)
    first = Window.partitionBy(*same).orderBy(F.desc("n"), F.asc_nulls_last("keep"))
    whole = heads.select("h", "digest", F.row_number().over(first).alias("place"), F.col("keep").alias("best"), F.col("salt").alias("at"), F.sum("size").over(Window.partitionBy(*same)).alias("all"))
    # One row a hot text.
    whole = F.broadcast(whole.filter("place = 1").drop("place"))
    found = cell.drop("norm").join(whole, ["h", "digest"], "left")
    cut = F.col("all").isNotNull()
    return found.select(
        F.col("id").alias(id_col),
        F.when(cut, F.col("best")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("all", "size").cast("long").alias("group_size"),
        ((F.col("place") == 1) & (~cut | (F.col("salt") == F.col("at")))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def oracle() -> str:
    """The same rows in SQL."""
    return r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)"""
