"""Publishing runs: staged, verified, guarded, and made live by one pointer."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.incremental import complete_enough, verify
from tessera.sources.spreadsheets import opened


#: Bytes of a file that is hashed as one value.
WHOLE = 256 << 20


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path, size, sha256) of files (path, length), a piece at a time."""
    for f in frames:
        for path, size in f.itertuples(index=False):
            digest = hashlib.sha256()
            with opened(path) as file:
                while piece := file.read(8 << 20):
                    digest.update(piece)
            yield pd.DataFrame({"path": [path], "size": [size], "sha256": [digest.hexdigest()]})


class Publisher:
    """Runs of tables below a root: ``_runs/<id>/<table>``, and ``_LATEST.json`` that names the live run."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        sc = spark.sparkContext
        self._path = sc._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(sc._jsc.hadoopConfiguration())

    def _read(self, path: str) -> str | None:
        if not self._fs.exists(self._path(path)):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def live(self) -> str | None:
        # A commit that was cut off between taking the old pointer away and naming the new one left the new one beside.
        text = self._read(f"{self.root}/_LATEST.json") or self._read(f"{self.root}/_LATEST.tmp")
        return json.loads(text)["run_id"] if text else None

    def stage(self, run_id: str, tables: dict[str, DataFrame]) -> DataFrame:
        """Writes a run; its manifest (path, size, sha256), where an empty file is an error."""
        run_id = re.sub(r"[^A-Za-z0-9._-]", "-", run_id)
        for name, t in tables.items():
            t.write.mode("errorifexists").parquet(f"{self.root}/_runs/{run_id}/{name}")
        return self.manifest(run_id)

    def manifest(self, run_id: str) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.root}/_runs/{run_id}")
        name = F.regexp_extract("path", rf"/_runs/{re.escape(run_id)}/(.*)$", 1).alias("path")
        small = files.filter(F.col("length") <= WHOLE).select(name, F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
        # A file that no cell can hold is hashed as a stream.
        large = files.filter(F.col("length") > WHOLE).select("path", "length").mapInPandas(_digests, "path string, size bigint, sha256 string")
        return small.unionByName(large.withColumn("path", name))

    def commit(self, run_id: str, expected: DataFrame, mirror: bool = True, keep: int = 3) -> None:
        """Verifies the run, refuses one that lost too much, and turns the pointer last."""
        here = self.manifest(run_id)
        if not verify(expected, here, "path", "size").isEmpty():
            raise ValueError(f"run {run_id} is not what was staged")
        before = self.live()
        if mirror and before and not complete_enough(here, self.manifest(before), "size"):
            raise ValueError(f"run {run_id} holds less than half of {before}")
        temp, final = self._path(f"{self.root}/_LATEST.tmp"), self._path(f"{self.root}/_LATEST.json")
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps({"run_id": run_id, "previous": before}).encode()))
        out.close()
        self._fs.delete(final, False)
        self._fs.rename(temp, final)
        self.prune(keep)

    def rollback(self, run_id: str) -> None:
        """Drops a staged run that is not live."""
        if run_id != self.live():
            self._fs.delete(self._path(f"{self.root}/_runs/{run_id}"), True)

    def prune(self, keep: int) -> None:
        runs = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/_runs")))
        for r in runs[: max(0, len(runs) - keep)] if keep else runs:
            if r != self.live():
                self._fs.delete(self._path(f"{self.root}/_runs/{r}"), True)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/_runs/{self.live()}/{name}")
