"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; it goes when the application ends.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset the session must run
    on one machine, and a folder of its warehouse serves.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    path = f"{base.rstrip('/')}/{sc.applicationId}/{name}-{uuid.uuid4().hex}"
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


#: Whether shuffle files go when the query that wrote them ends. Else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written and read again: a lost executor costs no earlier step, and the shuffle files behind it go."""
    spark = df.sparkSession
    path, before = shared_dir(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: str, name: str = "n") -> DataFrame:
    """The rows with numbers from 0, without a gap, in order: places in range partitions, and one count a partition."""
    held = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)
    counts = sorted(held.groupBy(part.alias("p")).count().collect())
    before, total = [], 0
    for p, n in counts:
        before.append((p, total))
        total += n
    # One row a partition.
    offsets = F.broadcast(df.sparkSession.createDataFrame(before, "_part bigint, _before bigint"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn("_part", part).join(offsets, "_part").withColumn(name, F.col("_before") + place).drop("_part", "_at", "_before")
