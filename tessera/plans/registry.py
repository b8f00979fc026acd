"""How a plan module names its queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Plans:
    """Queries by name, each with the SQL that gives the same rows, if SQL can."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Registers ``f(read)``, where ``read(name)`` gives a table and ``read.path(name)`` its path, under the function's name."""

        def register(f):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                def read(name: str) -> DataFrame:
                    return spark.read.parquet(read.path(name))

                read.path = lambda name: f"{sf_dir}/{name}.parquet"
                return f(read)

            run.__name__, run.__doc__ = f.__name__, f.__doc__
            self.queries[f.__name__] = run
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register
