"""WARC archives: writing, reading, and revisit resolution.

Records are laid out by DataFrame functions and written by Spark's text sink, whose line separator is the
blank line pair that ends a WARC record; so archives go through any file system that Spark reaches, and a lost
task's output is never committed. Archives are gzip files as a whole. They are read as text between those same line pairs, so
a file passes a task as a stream, whatever its size, and cut by Content-Length in Arrow batches: a task holds one record and the batch it gives.

Resolution shuffles headers only: the smallest page of each payload digest is found by a grouped minimum (a
task sends one row for each digest), joined back to the headers, and the decision is joined to the records by
record id when the deduplicated archive is written with fresh headers. Both sides of the join by digest are stored
tables, so AQE can split a payload that a third of all pages share.

Defined results: NULL html is an empty payload, a NULL url writes no target URI, a NULL page id no page id; it loses
against every id. Of repeated rows one is the response. Payloads under `least_bytes` are always responses. Line breaks in
a url are written as spaces. An empty table writes empty archives and gives an empty result. A cut-off archive raises.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrisk.llm.common import stored, table
from windrisk.session import work_path

# The layout of WARC 1.1.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEAST_BYTES = 100
FILE_RECORDS = 5000
SCHEMA = ("record_type string, record_id string, page_id long, url string, refers_to string, refers_to_page long, "
          "declared_digest string, declared_bytes long, payload binary")


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.translate(value.cast("string"), "\r\n", "  "), F.lit("\r\n")), F.lit(""))


def write_archive(records: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", file_records: int = FILE_RECORDS) -> None:
    """Write `record_type, record_id, page_id, url, refers_to, refers_to_page, refers_to_url, digest, payload_bytes,
    payload` (string) as an archive; revisits carry the headers of the response only."""
    revisit = F.col("record_type") == "revisit"
    payload = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    value = F.concat(
        F.lit(f"{VERSION}\r\n"), _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")), _field("WARC-Page-ID", F.col("page_id")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _field("WARC-Payload-Length", F.col("payload_bytes")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to"), F.lit(">"))),
        _field("WARC-Refers-To-Target-URI", F.col("refers_to_url")), _field("WARC-Refers-To-Page-ID", F.col("refers_to_page")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.lit(len(HTTP)) + F.octet_length(payload)), F.lit("\r\n"), F.lit(HTTP), payload)
    (records.select(value.alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", file_records).text(path))


def page_records(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One response record per page."""
    source = pages.select(F.col(page_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                          F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    name = F.sha2(F.concat_ws("|", F.col("page_id").cast("string"), F.monotonically_increasing_id().cast("string")), 256)
    none = F.lit(None).cast("string")
    return source.select(
        F.lit("response").alias("record_type"), F.concat(F.lit("urn:windrisk:"), F.substring(name, 1, 32)).alias("record_id"),
        "page_id", "url", none.alias("refers_to"), F.lit(None).cast("long").alias("refers_to_page"), none.alias("refers_to_url"),
        F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("payload_bytes"), "payload")


class _Cutter:
    """Cuts the text of one archive file, given piece by piece without the separators, into records."""

    def __init__(self):
        self.buffer, self.fields, self.start = bytearray(), None, 0

    def add(self, piece: bytes) -> Iterator[tuple]:
        """The records that end with this piece."""
        self.buffer += piece
        self.buffer += END.encode()
        while self._headers():
            end = self.start + int(self.fields["Content-Length"])
            if len(self.buffer) < end + len(END):
                return
            block = bytes(self.buffer[self.start:end])
            del self.buffer[:end + len(END)]
            fields, self.fields = self.fields, None
            yield _record(fields, block)

    def _headers(self) -> bool:
        """True if the next record's headers are there."""
        if self.fields is None:
            # A record never begins with a line break; one is left if the last payload of a file ends with it.
            while self.buffer.startswith(b"\r\n"):
                del self.buffer[:2]
            split = self.buffer.find(END.encode())
            if split < 0:
                return False
            lines = self.buffer[:split].decode().split("\r\n")
            if lines[0] != VERSION:
                raise ValueError("a record does not begin with the version line")
            self.fields, self.start = dict(line.split(": ", 1) for line in lines[1:]), split + len(END)
        return True

    def close(self) -> None:
        if self.fields is not None or self.buffer.strip():
            raise ValueError("an archive ends within a record")


def _record(fields: dict[str, str], block: bytes) -> tuple:
    page, other = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
    return (kind, fields["WARC-Record-ID"][1:-1], None if page is None else int(page), fields.get("WARC-Target-URI"),
            refers and refers[1:-1], None if other is None else int(other),
            fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"]),
            None if kind == "revisit" else block[block.index(END.encode()) + len(END):])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive; the payload of a revisit is NULL."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = [part.split()[0] for part in SCHEMA.split(",")]
        cutter, file, rows, size = _Cutter(), None, [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for own, piece in zip(batch.column(0).to_pylist(), batch.column(1)):
                if own != file:
                    cutter.close()
                    cutter, file = _Cutter(), own
                for record in cutter.add(piece.as_py()):
                    rows.append(record)
                    size += len(record[-1] or b"")
                    if size > 1 << 22:
                        yield batch_of(rows)
                        rows, size = [], 0
        cutter.close()
        if rows:
            yield batch_of(rows)

    # A gzip file is one split, so its pieces come to one task in their order.
    pieces = spark.read.option("lineSep", END).text(path).select(F.col("_metadata.file_path"), F.col("value").cast("binary"))
    return pieces.mapInArrow(parse, SCHEMA)


def resolve(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Decision per response record: record_type, refers_to (record), refers_to_page, refers_to_url, digest, payload_bytes."""
    heads = stored(records.select("record_id", "page_id", "url", F.sha2("payload", 256).alias("digest"),
                                  F.octet_length("payload").cast("long").alias("payload_bytes")), "warc-heads")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url"))
    originals = stored(heads.where(F.col("payload_bytes") >= least_bytes).groupBy(F.col("digest").alias("o_digest"))
                       .agg(first.alias("original"), F.count("*").alias("n")).where("n > 1").drop("n"), "warc-originals")
    joined = heads.join(originals, (F.col("digest") == F.col("o_digest")) & (F.col("payload_bytes") >= least_bytes), "left")
    again = F.col("original").isNotNull() & (F.col("original.record_id") != F.col("record_id"))
    return joined.select(
        "record_id", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("original.record_id")).alias("refers_to"), F.when(again, F.col("original.page_id")).alias("refers_to_page"),
        F.when(again, F.col("original.url")).alias("refers_to_url"), "digest", "payload_bytes")


def deduplicate(spark: SparkSession, path: str, to: str, least_bytes: int = LEAST_BYTES) -> None:
    """Read the archive at `path`, write it to `to` with revisits in place of repeated payloads."""
    records = read_archive(spark, path)
    decisions = stored(resolve(records, least_bytes), "warc-decisions").withColumnRenamed("record_id", "d_id")
    kept = records.select(F.col("record_id"), "page_id", "url", F.col("payload").cast("string").alias("payload"))
    write_archive(kept.join(decisions, F.col("record_id") == F.col("d_id")), to)


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """Records of a deduplicated archive with the digest and length of the full payload.

    For responses both come from the payload itself; a revisit takes them from the response that it refers to.
    """
    full = F.col("payload").isNotNull()
    heads = stored(read_archive(spark, path).select(
        "record_type", "record_id", "page_id", "url", "refers_to", "refers_to_page",
        F.when(full, F.sha2("payload", 256)).alias("digest"), F.when(full, F.octet_length("payload").cast("long")).alias("payload_bytes")),
        "warc-resolved")
    original = F.col("digest").isNotNull()
    originals = heads.where(original).select(
        F.col("record_id").alias("o_id"), F.col("digest").alias("o_digest"), F.col("payload_bytes").alias("o_bytes"))
    revisits = heads.where(~original).drop("digest", "payload_bytes").join(originals, F.col("refers_to") == F.col("o_id"))
    return heads.where(original).unionByName(
        revisits.withColumnsRenamed({"o_digest": "digest", "o_bytes": "payload_bytes"}).drop("o_id"))


def op5_revisits(spark, sf_dir):
    first, second = work_path(spark, "warc"), work_path(spark, "warc-dedup")
    write_archive(page_records(table(spark, sf_dir, "pages")), first)
    deduplicate(spark, first, second)
    return resolved(spark, second).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to_page").alias("refers_to"))


OP5_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM m
"""
