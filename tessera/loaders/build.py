"""The build: loaders run in order, their writers keep that order, and tables are made once.

A lake is a mapping from a file's short name to its rows (all cells text). A loader is
a function of the build; it reads what it needs, resolves, and adds writers. The order
of loaders is precedence: the first writer of a key wins.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import schema
from tessera.functions import text
from tessera.operators import emit, resolve
from tessera.scratch import written
from tessera.sources.tabular import or_empty


class Build:
    def __init__(self, lake: Mapping[str, DataFrame], run_id: str = "run") -> None:
        self.lake, self.run_id = lake, run_id
        self.writers: dict[str, list[DataFrame]] = {}
        self.dictionaries: dict[str, DataFrame] = {}
        self.names: list[DataFrame] = []
        self.aliases: list[DataFrame] = []
        #: Proposed links of the hierarchy of diseases, and titles that MeSH doesn't name.
        self.links: list[tuple[DataFrame, str, str]] = []
        self.foreign: list[DataFrame] = []
        self.used: list[str] = []
        self._resolver: tuple[tuple[int, int], DataFrame] | None = None

    def has(self, name: str) -> bool:
        return name in self.lake

    def rows(self, name: str, *columns: str) -> DataFrame:
        """Trimmed cells of a file; a column that lacks is empty."""
        self.used.append(name)
        raw = or_empty(self.lake[name], *columns)
        return raw.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in columns])

    def add(self, kind: str, rows: DataFrame, source: str, **columns: str | Column) -> None:
        """A writer of a label or type; text values name columns, others are expressions."""
        cells = {k: F.col(v) if isinstance(v, str) else v for k, v in columns.items()}
        out = rows.select(*[c.alias(k) for k, c in cells.items()], F.lit(source).alias("source"), F.lit(self.run_id).alias("run_id"))
        self.writers.setdefault(kind, []).append(out)

    def identify(self, rows: DataFrame, source: str, key: str, scheme: str, value: str) -> None:
        node, edge = emit.identifiers(rows, key, F.lit(scheme), value)
        self.add("Identifier", node, source, key="key", scheme="scheme", value="value")
        self.add("HAS_IDENTIFIER", edge, source, src="src", dst="dst", match_method="match_method")

    def propose(self, rows: DataFrame, source: str, method: str = "structured") -> None:
        """Links (child, parent) of diseases; a later vocabulary may add to the hierarchy, not contradict it."""
        self.links.append((rows.select("child", "parent"), source, method))

    def substances(self) -> DataFrame:
        """The resolver's dictionary of what has been loaded so far; kept until more names come.

        It is written to the shared folder, so that no table builds it anew.
        """
        state = (len(self.names), len(self.aliases))
        if self._resolver and self._resolver[0] == state:
            return self._resolver[1]
        names = aliases = None
        for rank, n in enumerate(self.names):
            one = n.select("name", "id", F.lit(rank).alias("ord"))
            names = one if names is None else names.unionByName(one)
        for rank, a in enumerate(self.aliases):
            one = a.select("name", "id", "method", F.lit(rank).alias("ord"))
            aliases = one if aliases is None else aliases.unionByName(one)
        self._resolver = (state, written(resolve.dictionary(names, aliases), "substances"))
        return self._resolver[1]

    def keep(self, name: str, rows: DataFrame) -> None:
        """A dictionary that several loaders read, written to the shared folder."""
        self.dictionaries[name] = written(rows, name)

    def resolve(self, rows: DataFrame, name: str, provisional: bool = False) -> DataFrame:
        """Rows with ``substance`` and ``match_method``; unknown names go, or stand for themselves."""
        out = resolve.resolve(rows, self.substances(), name, "substance", "match_method")
        return out.filter("substance <> ''" + ("" if provisional else " and match_method <> 'provisional'"))

    def diseases(self) -> list[DataFrame]:
        return [self.dictionaries[k] for k in ("mesh", "vocab_alias", "disease_alias") if k in self.dictionaries]

    def table(self, kind: str) -> DataFrame:
        made = self.writers.get(kind)
        if not made:
            raise KeyError(f"no loader wrote {kind}")
        return (emit.nodes if kind in schema.NODES else emit.edges)(made, kind)

    def tables(self) -> dict[str, DataFrame]:
        return {kind: self.table(kind) for kind in [*schema.NODES, *schema.EDGES] if kind in self.writers}


def run(lake: Mapping[str, DataFrame], loaders: list[Callable[[Build], None]], run_id: str = "run") -> Build:
    build = Build(lake, run_id)
    for load in loaders:
        load(build)
    return build


def joined(prefix: str, *columns: str) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("-", *columns))


def folded_key(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), text.fold(F.col(column)))
