"""Scans of delimited, JSON and key-value files that are not quite regular."""

from __future__ import annotations

import csv
import io
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes read to find a file's header.
PROBE = 16 << 10


def listing(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, modified) of non-empty files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).filter("length > 0")


def level(files: DataFrame, prefix: str) -> DataFrame:
    """(name, is_folder): one level of a listing below a prefix."""
    rest = files.filter(F.col("path").startswith(prefix)).select(F.substring("path", len(prefix) + 1, 4096).alias("rest"))
    return rest.select(F.split_part("rest", F.lit("/"), F.lit(1)).alias("name"), F.col("rest").contains("/").alias("is_folder")).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop))


def preflight(spark: SparkSession, paths: list[str]) -> list[str]:
    """Paths that are not there."""
    return [p for p in paths if not exists(spark, p)]


def is_title_row(cells: list[str]) -> bool:
    """A title over the table: at most one filled cell, or placeholders for at least half of the names."""
    filled = [c for c in cells if c.strip()]
    return len(filled) <= 1 < len(cells) or sum(c.strip().lower().startswith("unnamed:") for c in cells) >= max(2, len(cells) / 2)


def sniff(spark: SparkSession, path: str, sep: str = ",") -> tuple[list[str], int]:
    """(names, rows before the data) from the first bytes of the first file."""
    one = spark.read.format("binaryFile").load(path).orderBy("path").select(F.expr(f"substring(content, 1, {PROBE})")).first()
    text = bytes(one[0]).decode("utf-8-sig", "replace") if one else ""
    for i, cells in enumerate(csv.reader(io.StringIO(text), delimiter=sep)):
        if i == 4 or not is_title_row(cells):
            return [c.strip() for c in cells], i + 1
    return [], 0


def read_csv(spark: SparkSession, path: str, sep: str = ",", limit: int | None = None, header: bool = True, names: list[str] | None = None) -> DataFrame:
    """All cells as text: quoted line ends, doubled quotes, byte order marks, titles over the header, undecodable bytes replaced.

    Without a header the columns are c0, c1, ... or the given names.
    """
    found, skip = sniff(spark, path, sep) if header else (names or [], 0)
    reader = spark.read.option("sep", sep).option("multiLine", "true").option("escape", '"').option("mode", "PERMISSIVE").option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", "false")
    if not header and not names:
        rows = reader.csv(path)
        rows = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    else:
        unique, seen = [], {}
        for n in found:
            seen[n] = seen.get(n, 0) + 1
            unique.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
        rows = reader.schema(", ".join(f"`{(n or f'c{i}').replace('`', '')}` string" for i, n in enumerate(unique))).csv(path)
        if skip:
            # Every file's own header and titles go: rows equal to the header, and rows over it.
            head = F.lit(True)
            for c, n in zip(rows.columns, found):
                head &= F.trim(F.regexp_replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), "^﻿", "")) == n
            titled = F.lit(False)
            if skip > 1:
                filled = sum((F.when(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))) != "", 1).otherwise(0) for c in rows.columns[1:]), F.lit(0))
                titled = (filled == 0) | F.lower(F.coalesce(F.col(f"`{rows.columns[-1]}`"), F.lit(""))).startswith("unnamed:")
            rows = rows.filter(~head & ~titled)
    return rows.limit(limit) if limit else rows


def read_tsv(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, sep="\t", **options)


def read_tilde(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv(spark, path, sep="~", **options)


def read_commented_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return spark.read.option("sep", "\t").option("comment", "#").schema(", ".join(f"`{n}` string" for n in names)).csv(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, key, value) of text files with "Key: value" lines and blank lines between records."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"\r?\n[ \t]*\r?\n")).alias("record", "body"))
    lines = text.select("path", "record", F.explode(F.split("body", r"\r?\n")).alias("line")).filter(F.col("line").contains(":"))
    return lines.select("path", "record", F.trim(F.substring_index("line", ":", 1)).alias("key"), F.trim(F.expr("substring(line, instr(line, ':') + 1)")).alias("value"))


def read_sqlite(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """Wanted columns of a table of a SQLite file that the driver can read; those that lack are left out."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        there = [r[1] for r in db.execute(f'PRAGMA table_info("{table}")')]
        kept = [c for c in columns if c in there]
        rows = [tuple(None if x is None else str(x) for x in r) for r in db.execute("SELECT {} FROM \"{}\"".format(", ".join(f'"{c}"' for c in kept), table))]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in kept))


def or_empty(rows: DataFrame, *names: str) -> DataFrame:
    """The named columns as text; one that lacks, or a null, is empty."""
    have = {c.lower(): c for c in rows.columns}
    return rows.select(*[(F.coalesce(F.col(f"`{have[n.lower()]}`").cast("string"), F.lit("")) if n.lower() in have else F.lit("")).alias(n) for n in names])


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.limit(n)


def estimated_rows(rows: DataFrame, total_bytes: int, sample: int = 1000) -> float:
    """Rows of a file from its size and the mean row of a sample."""
    mean = rows.limit(sample).agg(F.avg(F.length(F.to_csv(F.struct(*rows.columns))) + 1)).first()[0]
    return total_bytes / mean if mean else 0.0


def linked_columns(spark: SparkSession, paths: list[str], sep: str = ",") -> dict[str, list[str]]:
    """Columns of each file whose names look as if they held links; other files need no scan."""
    out = {}
    for p in paths:
        names, _ = sniff(spark, p, sep)
        if found := [n for n in names if any(w in n.lower() for w in ("url", "link", "href", "document", "pdf", "file"))]:
            out[posixpath.normpath(p)] = found
    return out
