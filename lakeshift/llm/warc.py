"""WARC archives: written by Spark's text writer, read by a Python data source.

A record is a line of the text writer whose line separator is the blank line that ends a WARC record;
so the writer's commit protocol holds, on any file system that Spark knows, and a lost executor leaves
no half-written archive behind. The reader plans groups of files, takes each record's headers first,
checks the predicates that Spark has pushed down on them, and reads on over the payload of a record
that is not wanted without decoding it.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith

from lakeshift.llm.common import REGISTRY, table
from lakeshift.sources.scratch import scratch_dir, stored

CRLF = "\r\n"
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Bytes of archive that one read task plans for, and of payload in one batch that it returns.
TASK_BYTES, BATCH_BYTES = 64 << 20, 4 << 20

#: Column of the source -> field of the record's header.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "record_date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
    "payload_length": "WARC-X-Payload-Length",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", headers map<string,string>, payload binary"


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _system(path: str) -> tuple[pafs.FileSystem, str]:
    path = re.sub(r"^file:/+", "/", path)
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


class WarcReader(DataSourceReader):
    """Reads records whose headers pass the pushed predicates; ``payload=false`` leaves all payloads undecoded."""

    def __init__(self, options):
        self.path = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() != "false"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", frozenset([f.value])))
            elif isinstance(f, In):
                self.tests.append((column, "in", frozenset(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "there", None))
            else:
                yield f

    def partitions(self):
        system, path = _system(self.path)
        found = system.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        files = [x for x in found if x.is_file and x.size and not x.base_name.startswith(("_", "."))]
        plan, size = [], TASK_BYTES
        for x in sorted(files, key=lambda x: x.path):
            if size + x.size > TASK_BYTES:
                plan.append(Files([]))
                size = 0
            plan[-1].paths.append(x.path)
            size += x.size
        return plan or [Files([])]

    def wanted(self, headers: dict[str, str]) -> bool:
        for column, kind, value in self.tests:
            have = headers.get(HEADERS[column].lower())
            if have is None or kind == "in" and have not in value or kind == "starts" and not have.startswith(value):
                return False
        return True

    def records(self, stream):
        """(headers, payload or None) of each wanted record."""
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a WARC record: {line[:60]!r}")
            headers = {}
            while (line := stream.readline().rstrip(b"\r\n")) != b"":
                name, _, value = line.decode("utf-8").partition(":")
                headers[name.strip().lower()] = value.strip()
            length = int(headers["content-length"])
            if not self.wanted(headers):
                stream.seek(length, 1)
                continue
            if not self.payloads:
                stream.seek(length, 1)
                yield headers, None
                continue
            block = stream.read(length)
            if len(block) < length:
                raise EOFError("a WARC record ends before its length")
            if headers.get("content-type", "").startswith("application/http"):
                block = block.partition(b"\r\n\r\n")[2]
            yield headers, block

    def read(self, partition):
        system, _ = _system(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                import io

                for headers, payload in self.records(io.BufferedReader(raw, 1 << 18)):
                    rows.append((headers, payload))
                    size += 1000 + len(payload or b"")
                    if size >= BATCH_BYTES:
                        yield self.batch(rows)
                        rows, size = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows):
        columns = [pa.array([h.get(name.lower()) for h, _ in rows], pa.string()) for name in HEADERS.values()]
        columns.append(pa.array([list(h.items()) for h, _ in rows], pa.map_(pa.string(), pa.string())))
        columns.append(pa.array([p for _, p in rows], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, [*HEADERS, "headers", "payload"])


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives under a path. Filters on header columns are pushed into the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value. Line breaks are percent-encoded, so that no value can start a header of its own."""
    safe = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def revisits(pages: DataFrame, key: str, payload: str, least: int) -> DataFrame:
    """sha, keep: payloads of at least ``least`` bytes that several rows have, and the greatest key among these."""
    data = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.sha2(data, 256).alias("sha"), F.octet_length(data).alias("n"))
    return rows.where(F.col("n") >= least).groupBy("sha").agg(F.max("key").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def write_warc(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", least: int = REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row: a response, or a revisit that refers to the response of an equal payload.

    Nulls: a null payload is empty; a null uri leaves its header out; a null key gives the record id
    ``<urn:page:>`` and is less than any other key. Rows that repeat the key of a response are responses
    too. An empty table gives an archive without records. Other columns are not looked at. Payloads are
    not moved between tasks unless the table of repeated payloads is too large to be broadcast.
    """
    twice = stored(revisits(pages, key, payload, least), "warc-revisits")
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(uri).cast("string").alias("uri"), text.alias("text"))
    rows = rows.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256)).join(twice, "sha", "left")
    n = F.octet_length("text")
    refers = F.when(F.col("keep").isNotNull() & ~F.col("key").eqNullSafe(F.col("keep").cast("string")), F.col("keep").cast("string"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), n.cast("string"), F.lit(CRLF * 2))
    block = F.when(refers.isNull(), F.concat(http, F.col("text"))).otherwise(F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.when(refers.isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce("key", F.lit("")), F.lit(">"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("uri")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("text").cast("binary")))),
        _field("WARC-X-Payload-Length", n.cast("string")),
        _field("WARC-Profile", F.when(refers.isNotNull(), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers, F.lit(">"))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
    )
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", CRLF * 2).text(path)


_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS keep, count(*) AS n FROM p GROUP BY h),
r AS (SELECT page_id, p.h, CASE WHEN n > 1 AND strlen(p.h) >= 1000 AND page_id IS DISTINCT FROM keep THEN keep END AS refers_to FROM p JOIN g ON p.h = g.h)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r
"""


@REGISTRY.query("op6_warc_round_trip", _SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path).where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    whole = F.col("record_type") == "response"
    return records.select(
        number("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length").cast("int")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        F.when(~whole, number("refers_to")).alias("refers_to"),
    )
