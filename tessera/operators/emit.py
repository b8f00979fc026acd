"""Writing linked data: first writer wins, cleaned cells, provenance, typed staging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import schema
from tessera.functions.text import clean_cell


def first_writer(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key: the first in the order. Rows with an empty key go.

    A partial aggregate, so a hot key sends one row a task.
    """
    filled = rows.filter(" and ".join(f"coalesce(cast(`{k}` as string), '') <> ''" for k in keys))
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    won = filled.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), rank).alias("w"))
    return won.select(*keys, *[F.col("w")[c].alias(c) for c in rest]).select(rows.columns)


def conform(rows: DataFrame, kind: str) -> DataFrame:
    """Exactly the declared columns, cleaned; what is missing is empty, what is more goes."""
    return rows.select(*[(clean_cell(F.col(c).cast("string")) if c in rows.columns else F.lit("")).alias(c) for c in schema.columns(kind)])


def nodes(writers: Sequence[DataFrame], label: str) -> DataFrame:
    """A node table from writers in order of precedence; each may have ``ord`` for its own order."""
    return _written(writers, label, ["key"])


def edges(writers: Sequence[DataFrame], kind: str) -> DataFrame:
    return _written(writers, kind, ["src", "dst"])


def _written(writers: Sequence[DataFrame], kind: str, keys: list[str]) -> DataFrame:
    ranked = [conform(w.drop("ord"), kind).withColumn("ord", F.lit(0)) if "ord" not in w.columns else w.select(*[(clean_cell(F.col(c).cast("string")) if c in w.columns else F.lit("")).alias(c) for c in schema.columns(kind)], F.col("ord").cast("long").alias("ord")) for w in writers]
    every = None
    for i, w in enumerate(ranked):
        w = w.withColumn("load_rank", F.lit(i)).withColumn("ord", F.col("ord").cast("long"))
        every = w if every is None else every.unionByName(w)
    return first_writer(every, keys, ["load_rank", "ord", *schema.columns(kind)]).drop("load_rank", "ord")


def identifiers(entities: DataFrame, entity: str, scheme: Column, value: str) -> tuple[DataFrame, DataFrame]:
    """(Identifier nodes, HAS_IDENTIFIER edges) of entities' values in a scheme."""
    named = entities.filter(F.coalesce(F.col(value), F.lit("")) != "").withColumn("_id", F.concat(F.lit("ID:"), scheme, F.lit(":"), F.col(value)))
    node = named.select(F.col("_id").alias("key"), scheme.alias("scheme"), F.col(value).alias("value"))
    return node, named.select(F.col(entity).alias("src"), F.col("_id").alias("dst"), F.lit("structured").alias("match_method"))


def source_ids(rows: DataFrame, source: str, order: str) -> DataFrame:
    """(source, first, sid): short ids by first use. One row a source reaches the numbering task."""
    first = rows.groupBy(source).agg(F.min(order).alias("first"))
    ranked = first.select(F.col(source), "first", F.expr(f"row_number() over (order by first, {source})").alias("_n"))
    return ranked.select(source, "first", F.format_string("s%02d", F.col("_n") - 1).alias("sid"))


def coerce(c: Column, kind: str) -> Column:
    """A cell as its type; null if it does not conform."""
    if kind in ("int", "bigint"):
        return F.trim(c).try_cast("double").try_cast("bigint")
    return F.trim(c).try_cast(kind)


def stage(table: DataFrame, kind: str) -> DataFrame:
    """The typed table: cells on one line, blanks as null, non-conforming cells null."""
    own = schema.struct(kind, typed=True)
    line = lambda c: F.nullif(F.trim(F.regexp_replace(F.col(c), r"[\r\n]+", " ")), F.lit(""))
    return table.select(*[(line(f.name) if f.dataType.simpleString() == "string" else coerce(line(f.name), f.dataType.simpleString()).cast(f.dataType)).alias(f.name) for f in own])


def rejected(table: DataFrame, kind: str) -> DataFrame:
    """(column, n_rejected): filled cells that their type refuses."""
    typed = [f for f in schema.struct(kind, typed=True) if f.dataType.simpleString() != "string"]
    counts = table.agg(*[F.sum(F.when((F.trim(f.name) != "") & coerce(F.col(f.name), f.dataType.simpleString()).isNull(), 1).otherwise(0)).alias(f.name) for f in typed])
    return counts.unpivot([], [f.name for f in typed], "column", "n_rejected")


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_rows) of several tables in one job."""
    out = None
    for name, t in tables.items():
        one = t.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        out = one if out is None else out.unionAll(one)
    return out


def table_ddl(kind: str, typed: bool = True) -> str:
    """A CREATE TABLE statement of the declared table, clustered by its key."""
    own = schema.struct(kind, typed)
    by = "key" if kind in schema.NODES else "src"
    return f"CREATE TABLE IF NOT EXISTS {kind} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in own)}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO 64 BUCKETS"
