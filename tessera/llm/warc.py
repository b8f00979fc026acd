"""WARC archives: a writer on Spark's text sink and a Python data source to read them.

Writing. Each page becomes one record of a WARC/1.1 file. Of records with equal
payloads of at least ``least`` bytes, that with the smallest page id is a response and
the others revisit it. The text sink's line separator is the end of a record, so the
files take part in Spark's commit protocol on any file system, and a lost task leaves
no half archive.

Reading (format ``warc``). Files are dealt to partitions by size; record-type and
header predicates are pushed down; headers are parsed first, and the block of an
unwanted record is stepped over, not decoded. Columns are ``COLUMNS``; with option
``payload`` = ``false`` no block is decoded at all. Files that end in ``.gz`` are
read member by member, as archives have one for each record.

Null payloads are empty; a null URL has no header; line ends in a URL are
percent-encoded. Repeated rows of the smallest page id are all responses. Of an empty
table an empty folder is written and no row is read. Other columns are not read.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from tessera.llm.common import scratch_dir

SLOTS = 1 << 20
END = "\r\n\r\n"
PARTITION_BYTES = 32 << 20
#: Columns and the headers that they show; the last two come from the block.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
    "content_type": "content-type",
    "block_bytes": "content-length",
}
COLUMNS = ", ".join(f"{c} {'bigint' if c == 'block_bytes' else 'string'}" for c in HEADERS) + ", payload_bytes bigint, payload binary"


def _uri(page_id):
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame, least: int = 100, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(record string) of every page, without the record's end."""
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    raw = F.encode("payload", "UTF-8")
    src = src.select("*", F.octet_length("payload").cast("long").alias("n"), F.sha2(raw, 256).alias("digest"))
    src = src.withColumn("key", F.xxhash64("id", "digest")).withColumn("slot", F.pmod("key", F.lit(SLOTS)).cast("int"))
    small = src.filter(F.col("n") >= least).select("id", "digest", "key", "slot")
    firsts = small.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("c")).filter("c > 1").select("digest", "first")
    # Small rows only: adaptive execution splits a digest that a third of the pages share.
    again = small.join(firsts, "digest").filter(~F.col("id").eqNullSafe(F.col("first"))).select("key", "digest", "first", "slot").distinct()
    slots = F.broadcast(again.select("slot").distinct())
    fresh = src.join(slots, "slot", "left_anti").select("id", "url", "payload", "n", "digest", F.lit(None).cast(pages.schema[id_col].dataType).alias("first"))
    some = src.join(slots, "slot", "left_semi").join(again.drop("slot"), ["key", "digest"], "left").select("id", "url", "payload", "n", "digest", "first")
    every = fresh.unionByName(some)
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        _uri(F.col("id")),
        F.lit("\r\nWARC-Date: 2024-01-01T00:00:00Z"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit("\r\nWARC-Payload-Length: "),
        F.col("n").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _uri(F.col("first")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))).cast("long").cast("string"),
        F.lit(END),
    )
    return every.select(F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("record"))


def write(pages: DataFrame, path: str, least: int = 100, per_file: int = 20_000, **columns: str) -> None:
    records(pages, least, **columns).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


class _Files(InputPartition):
    def __init__(self, files: list[tuple[str, int]]) -> None:
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, schema, options: dict[str, str]) -> None:
        self.options, self.wanted = options, []
        self.columns = schema.fieldNames()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and membership of header columns are ours; the rest goes back to Spark."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and HEADERS.get(f.attribute[0]) and f.attribute[0] != "block_bytes":
                self.wanted.append((HEADERS[f.attribute[0]], frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        fs, root = _open_root(self.options["path"])
        import pyarrow.fs as pafs

        found = sorted((x.path, x.size) for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.is_file and x.size and not x.base_name.startswith(("_", ".")))
        parts: list[list[tuple[str, int]]] = []
        held = PARTITION_BYTES
        for path, size in found:
            if held + size > PARTITION_BYTES:
                parts.append([])
                held = 0
            parts[-1].append((path, size))
            held += size
        return [_Files(p) for p in parts or [[]]]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        fs, _ = _open_root(self.options["path"])
        decode = self.options.get("payload", "true").lower() != "false"
        rows, held = [], 0
        for path, _size in partition.files:
            with fs.open_input_file(path) as raw:
                plain = io.BufferedReader(raw, 1 << 20)
                for row in parse(gzip.GzipFile(fileobj=plain) if path.endswith(".gz") else plain, self.wanted, decode):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if held > 4 << 20 or len(rows) >= 2_000:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``"""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, dict(self.options))


#: Schemes of Hadoop's connectors, and what the reader's library calls the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasb": "abfs", "wasbs": "abfss"}


def readable(spark: SparkSession, path: str) -> str:
    """The path as tasks can open it: mounts that only Hadoop's configuration knows are resolved, connectors' schemes renamed."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = fs.resolvePath(hadoop).toString() if fs.exists(hadoop) else path
    scheme, mark, rest = whole.partition(":")
    return f"{SCHEMES.get(scheme, scheme)}{mark}{rest}"


def _open_root(path: str):
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64() if c == "block_bytes" else pa.string() for c in HEADERS] + [pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[*HEADERS, "payload_bytes", "payload"])


def _headers(f) -> dict[str, str]:
    out = {}
    while (line := f.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse(f, wanted: list[tuple[str, frozenset]] = (), decode: bool = True) -> Iterator[tuple]:
    """Rows of the records of a seekable file whose headers have one of the wanted values."""
    while version := f.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one must begin: {version[:40]!r}")
        head = _headers(f)
        size = int(head["content-length"])
        if any(head.get(name) not in values for name, values in wanted):
            f.seek(size, 1)
            continue
        n, payload = int(head["warc-payload-length"]) if "warc-payload-length" in head else None, None
        if not decode:
            f.seek(size, 1)
        else:
            block = f.read(size)
            if len(block) < size:
                raise ValueError("the last record is cut short")
            if head.get("content-type", "").startswith("application/http"):
                top, _, payload = block.partition(b"\r\n\r\n")
                n = next((int(x.split(b":")[1]) for x in top.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
            else:
                n, payload = len(block), block
        yield (*(size if c == "block_bytes" else head.get(h) for c, h in HEADERS.items()), n, payload)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The archives' records. Turns the session's push-down to Python sources on, without which Spark itself filters."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(readable(spark, path))


def round_trip(pages: DataFrame, least: int = 100, id_col: str = "page_id") -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to), read back from archives of the pages.

    Responses are read with their payloads, and their size and digest are the
    payload's. Revisits are read by their headers alone: a full payload's size and
    digest stand there. Each read pushes its record type down.
    """
    path = scratch_dir(pages.sparkSession, "warc")
    write(pages, path, least, id_col=id_col)
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(pages.schema[id_col].dataType)
    full = read(pages.sparkSession, path).filter("record_type = 'response'")
    full = full.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to")
    bare = read(pages.sparkSession, path, payload=False).filter("record_type = 'revisit'")
    bare = bare.select("record_id", "payload_bytes", F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", "refers_to")
    return full.unionByName(bare).select(page("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
