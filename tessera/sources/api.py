"""Paged sources as a Python data source: the fetcher is a parameter, pages are partitions.

``spark.read.format("paged").option("fetcher", "module:function").option("pages", n)``;
the function takes a page number and gives dictionaries. Cursors that only the page
before tells are one partition.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator, Sequence

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def _fetcher(self):
        module, _, name = self.options["fetcher"].partition(":")
        return getattr(importlib.import_module(module), name)

    def partitions(self) -> Sequence[InputPartition]:
        if self.options.get("mode", "offset") == "cursor":
            return [InputPartition(None)]
        return [InputPartition(i) for i in range(int(self.options["pages"]))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fetch = self._fetcher()
        if partition.value is not None:
            for row in fetch(partition.value):
                yield partition.value, json.dumps(row)
            return
        cursor, n = "*", 0
        while cursor:
            rows, cursor = fetch(cursor)
            for row in rows:
                yield n, json.dumps(row)
            n += 1


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "page int, body string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))
