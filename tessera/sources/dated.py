"""Scans of an API by ranges of days that adapt to a cap of rows a query, with waits and finished ranges kept.

The API is two functions of a first and a last day: how many rows a range has, and those rows. A
range with more rows than the cap is halved until a query holds it; all ranges of a round are asked in
parallel. Finished ranges are written as folders with a list of them beside, so a scan that
was stopped reads only what is missing.
"""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.scratch import written

Day = datetime.date
_RANGE = "first date, last date, n bigint"
#: Tries of a request at most, and seconds that one wait may last.
TRIES, LONGEST = 8, 300.0


class RetryLater(Exception):
    """What a function raises when the API asks to wait so many seconds."""

    def __init__(self, seconds: float = 1.0) -> None:
        super().__init__(seconds)
        self.seconds = seconds


def patient(ask: Callable, *args: object) -> object:
    """The function's answer, after the waits that it asks for; without a time of its own they double."""
    for i in range(TRIES):
        try:
            return ask(*args)
        except RetryLater as e:
            if i == TRIES - 1:
                raise
            time.sleep(min(LONGEST, max(0.0, e.seconds) or 0.1 * 2**i))
    raise AssertionError


def plan(spark: SparkSession, count: Callable[[Day, Day], int], first: Day, last: Day, cap: int, days: int = 366) -> DataFrame:
    """(first, last, n): ranges that together hold all rows, none of more than ``cap``; empty ones are left out.

    A single day beyond the cap can't be halved: it raises, as its rows could not all be had.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"first": f["first"], "last": f["last"], "n": [int(patient(count, a, b)) for a, b in zip(f["first"], f["last"])]})

    total = (last - first).days + 1
    ranges = spark.range(0, max(0, total), days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("first"))
    ranges = ranges.withColumn("last", F.least(F.date_add("first", days - 1), F.lit(last)))
    out = None
    while True:
        asked = written(ranges.repartition("first").mapInPandas(ask, _RANGE), "ranges")
        fit, wide = asked.filter(F.col("n").between(1, cap)), asked.filter(F.col("n") > cap)
        out = fit if out is None else out.unionByName(fit)
        if wide.isEmpty():
            return out
        if alone := wide.filter("first = last").first():
            raise ValueError(f"{alone['first']} has {alone['n']} rows, more than a query's {cap}")
        middle = F.date_add("first", F.floor(F.datediff("last", "first") / 2).cast("int"))
        halves = F.explode(F.array(F.struct(F.col("first").alias("a"), middle.alias("b")), F.struct(F.date_add(middle, 1).alias("a"), F.col("last").alias("b"))))
        ranges = wide.select(halves.alias("h")).select(F.col("h.a").alias("first"), F.col("h.b").alias("last"))


def _finished(spark: SparkSession, path: str) -> DataFrame | None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/finished")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.schema("range string").parquet(f"{path}/finished")


def scan(spark: SparkSession, count: Callable[[Day, Day], int], rows: Callable[[Day, Day], Iterable[dict]], first: Day, last: Day, cap: int, path: str, at_once: int = 64) -> DataFrame:
    """(range, body): all rows of the days, as JSON, in a table at ``path``; what an earlier scan finished isn't read again.

    Ranges are read ``at_once`` at a time, and are finished when their batch is written. A range that gives another
    number of rows than it counted raises: something came or went meanwhile, and the scan goes on when it is called again.
    """
    name = F.concat_ws("_", "first", "last")
    ranges = written(plan(spark, count, first, last, cap).withColumn("range", name), "plan")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                found = [json.dumps(x) for x in patient(lambda a, b: list(rows(a, b)), r.first, r.last)]
                if len(found) != r.n:
                    raise ValueError(f"{r.range} counted {r.n} rows and gave {len(found)}")
                yield pd.DataFrame({"range": r.range, "body": found})

    while True:
        done = _finished(spark, path)
        left = ranges if done is None else ranges.join(done, "range", "left_anti")
        batch = written(left.orderBy("first").limit(at_once), "batch")
        if batch.isEmpty():
            break
        # A batch that was stopped half way is written over.
        batch.repartition("range").mapInPandas(read, "range string, body string").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("range").parquet(f"{path}/rows")
        batch.select("range").coalesce(1).write.mode("append").parquet(f"{path}/finished")
    done = _finished(spark, path)
    if done is None:
        return spark.createDataFrame([], "range string, body string")
    return spark.read.schema("body string, range string").parquet(f"{path}/rows").select("range", "body").join(ranges.select("range"), "range", "left_semi")
