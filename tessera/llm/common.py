"""What the operators share on the Spark side: inputs and shared scratch tables."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, so that no other column's name can clash with ours."""
    return df.select(*[F.col(c) for c in columns])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; it goes when the application ends.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Where that is
    unset, as in tests on one machine, a folder of this application's warehouse is set; elsewhere it raises.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{sc.applicationId}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


_scopes: list[list[str]] = []


@contextlib.contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables written inside go at its end, but for those that are made with the function it gives (``through_table``)."""
    _scopes.append([])
    kept: list[str] = []

    def last(df: DataFrame, name: str) -> DataFrame:
        out = through_table(df, name)
        kept.append(_scopes[-1][-1])
        return out

    try:
        yield last
    finally:
        for path in _scopes.pop():
            if path not in kept:
                hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Whether shuffle files go when the query that wrote them ends. Else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def through_table(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again: lineage ends here, and the shuffle files behind it go."""
    spark = df.sparkSession
    path, before = scratch_dir(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))
