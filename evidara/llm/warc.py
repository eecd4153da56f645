"""WARC archives as a chunked record table.

A payload of more than ``chunk`` bytes becomes several rows, one for each record identifier and
chunk number: a first record and ``continuation`` records (the format's own segmentation).
Writing and reading move rows of bounded size; a digest over several chunks is carried from
chunk to chunk.  Payloads that were stored before become ``revisit`` records without payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidara.llm.common import BROADCAST_IDS
from evidara.session import shared_dir

CHUNK = 1 << 16
VERSION = "WARC/1.1"
_GAP = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ALPHABETS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of bytes in base 32: eight digits for each five bytes."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), *_ALPHABETS)


def record_types(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, payload) with ``n`` bytes, ``digest``, and ``head``: for a page whose payload of at
    least ``least`` bytes also belongs to a larger page_id, the largest such page_id; else null."""
    rows = pages.withColumn("n", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1(F.col("payload")))
    heads = rows.where(F.col("n") >= least).groupBy(F.col("digest").alias("__d"), F.col("n").alias("__n")).agg(
        F.max("page_id").alias("__head"), F.count("*").alias("__copies")).where("__copies > 1").drop("__copies")
    if heads.limit(BROADCAST_IDS // 4 + 1).count() <= BROADCAST_IDS // 4:
        heads = F.broadcast(heads)
    got = rows.join(heads, (F.col("digest") == F.col("__d")) & (F.col("n") == F.col("__n")), "left")
    later = F.col("__head").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("__head")))
    return got.withColumn("head", F.when(later, F.col("__head"))).drop("__d", "__n", "__head")


def chunk_table(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for each record and chunk: ``record``, ``number`` (1 for the first, then rising), ``whole`` (it is the
    only one), ``data`` and the columns of :func:`record_types` but the payload.  Revisits have one empty chunk.

    Chunks also end inside every version line that occurs in a payload, so that the text between
    two records never occurs inside one.
    """
    rows = rows.withColumn("record", F.expr("uuid()"))
    text = F.when(F.col("head").isNull(), F.col("payload").cast("string")).otherwise(F.lit(""))
    pieces = rows.withColumn("payload", F.split(text, r"(?<=WARC)(?=/1\.1\r\n)"))
    names = [c for c in rows.columns if c != "payload"]
    pieces = pieces.select(*names, F.size("payload").alias("__pieces"), F.posexplode("payload").alias("__piece", "__text"))
    size = F.octet_length("__text")
    spans = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((size - 1) / chunk).cast("int")))
    parts = pieces.select(*names, "__pieces", "__piece", "__text", F.explode(spans).alias("__part"))
    data = F.substring(F.col("__text").cast("binary"), F.col("__part") * chunk + 1, F.lit(chunk))
    whole = (F.col("__pieces") == 1) & (size <= chunk)
    number = F.col("__piece").cast("long") * (1 << 31) + F.col("__part") + 1
    return parts.select(*names, number.alias("number"), whole.alias("whole"), data.alias("data"))


def _header(first: Column) -> Column:
    """Header lines of a chunk's record; ``first``: whether it opens the record."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def given(condition: Column, *lines: Column) -> Column:
        return F.when(condition, F.concat(*lines)).otherwise(F.lit(""))

    urn = F.concat(F.lit("<urn:uuid:"), F.col("record"), F.lit(">"))
    later = F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))
    kind = F.when(~first, "continuation").when(F.col("head").isNotNull(), "revisit").otherwise("response")
    return F.concat(
        F.lit(f"{VERSION}\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", F.when(first, urn).otherwise(later)),
        given(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", ""))),
        line("WARC-Date", F.lit("2000-01-01T00:00:00Z")),
        given(F.col("page_id").isNotNull(), line("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), line("X-Payload-Length", F.col("n").cast("string")),
        given(F.col("head").isNotNull(), line("WARC-Profile", F.lit(_PROFILE)), line("X-Refers-To-Page-ID", F.coalesce(F.col("head").cast("string"), F.lit("")))),
        given(~F.col("whole"), line("WARC-Segment-Number", F.col("number").cast("string")), line("WARC-Segment-Origin-ID", urn),
              line("WARC-Segment-Total-Length", F.col("n").cast("string"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.octet_length("data").cast("string")))


def write_archive(pages: DataFrame, path: str, chunk: int = CHUNK, least: int = 0) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) under ``path``, one archive file (gzip) for each task.

    The payload is the html in UTF-8 (null: empty).  Of the pages with equal payloads of at least
    ``least`` bytes the one with the largest page_id is the response (all rows of that id, if it is
    repeated) and the others are revisits; smaller payloads are all responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    chunks = chunk_table(record_types(rows, least), chunk)
    record = F.concat(_header(F.col("number") == 1).cast("binary"), F.lit("\r\n").cast("binary"), F.col("data"))
    chunks.select(record.cast("string").alias("value")).write.option("lineSep", _GAP).option("compression", "gzip").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives under ``path``: record, number (null for a whole record), type, page_id,
    refers_to, declared digest and length, total (of a segmented record), data."""
    raw = spark.read.option("lineSep", f"{_GAP}{VERSION}\r\n").text(path)
    head = F.substring_index("value", _GAP, 1)
    rows = raw.select(head.alias("head"), F.col("value").cast("binary").alias("value"))

    def field(name: str, pattern: str = r"([^\r\n]*)") -> Column:
        found = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*{pattern}", 1)
        return F.when(found != "", found)

    size = F.coalesce(field("Content-Length", r"(\d+)").cast("int"), F.lit(0))
    data = F.substring(F.col("value"), F.octet_length("head") + len(_GAP) + 1, size)
    return rows.where(field("WARC-Type").isNotNull()).select(
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("record"),
        field("WARC-Segment-Number", r"(\d+)").cast("long").alias("number"), field("WARC-Type").alias("type"),
        field("X-Page-ID", r"(-?\d+)").cast("long").alias("page_id"), field("X-Refers-To-Page-ID", r"(-?\d+)").cast("long").alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("declared"),
        field("X-Payload-Length", r"(\d+)").cast("long").alias("length"), data.alias("data"))


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each record from its chunks, which lie together and in order: the digest and the
    byte count go from chunk to chunk."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    record, digest, size, about = None, hashlib.sha1(), 0, None

    def row() -> tuple:
        return about[0], size, base64.b32encode(digest.digest()).decode(), about[1], about[2]

    for batch in batches:
        out = []
        for key, page, kind, refers, data in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("record", "page_id", "type", "refers_to", "data"))):
            if key.as_py() != record:
                if record is not None:
                    out.append(row())
                record, digest, size, about = key.as_py(), hashlib.sha1(), 0, (page.as_py(), kind.as_py(), refers.as_py())
            digest.update(data.as_buffer())
            size += len(data.as_buffer())
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 5, kinds)], names=names)
    if record is not None:
        yield pa.record_batch([pa.array([v], t) for v, t in zip(row(), kinds)], names=names)


def read_records(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from a chunk table: length and digest
    of responses from their payload, of revisits as declared."""
    whole = chunks.where(F.col("number").isNull())
    revisit = F.col("type") == "revisit"
    single = whole.select(
        "page_id", F.when(revisit, F.col("length")).otherwise(F.octet_length("data").cast("long")).alias("payload_bytes"),
        F.when(revisit, F.col("declared")).otherwise(base32_sha1(F.col("data"))).alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    several = chunks.where(F.col("number").isNotNull()).repartition("record").sortWithinPartitions("record", "number")
    joined = several.mapInArrow(_carry, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return single.union(joined)


def archive_round_trip(pages: DataFrame, chunk: int = CHUNK, least: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), one row per row of ``pages`` (page_id, url, html):
    written to archives in the shared folder and read back from them.

    Null html is the empty payload; equal empty payloads revisit like any other.  Rows without
    page_id are revisits of a page with the same payload that has one, else responses.  Repeated
    rows give a record each.  Further columns are ignored; an empty table gives no rows.  The
    archives go when the driver's JVM ends.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, chunk, least)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return read_records(read_chunks(spark, path))
