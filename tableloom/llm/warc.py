"""WARC archives of captures: writing them from pages, and assembling each capture from its records.

A capture is three records: the request, the response (or the revisit of an earlier equal payload), and metadata. The
request and the metadata name the response in ``WARC-Concurrent-To``; ``assemble`` joins them by it into one nested row.
"""

from __future__ import annotations

import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm.common import let_workers_import
from tableloom.session import scratch_path

#: Payloads below this size are always stored whole.
REVISIT_BYTES = 100

#: Rows of one archive file at most, so that a reader's task holds few files' worth of pages.
FILE_CAPTURES = 2_000

_END = "\r\n"


def _id(kind: str, page: Column) -> Column:
    """A record's URN, made from what tells its capture apart."""
    digest = F.md5(F.concat(F.lit(kind + ":"), page))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(text: Column) -> Column:
    """A header value in one line: control characters, the percent sign and spaces are percent-encoded."""
    return F.regexp_replace(F.url_encode(F.coalesce(text, F.lit(""))), r"\+", "%20")


def _record(kind: Column | str, headers: list[tuple[str, Column | str]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1" + _END + "WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind, F.lit(_END)]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(name + ": "), value, F.lit(_END))))
    size = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), size, F.lit(_END + _END), block)


def plan_records(pages: DataFrame, key: str, url: str, body: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Rows to be archived: key, url, payload, its size and digest, and the key of the response it revisits (null: none).

    Of equal payloads of at least ``least`` bytes the smallest key is the response. Only digests are grouped, folded on
    the map side; a digest met twice is joined back, so a payload shared by very many rows is one row of that join's small side.
    """
    rows = pages.select(
        F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{body}`"), F.lit("")).alias("payload")
    ).withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    firsts = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("first_digest"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return rows.join(firsts, F.col("payload_digest") == F.col("first_digest"), "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", refers.alias("refers_to")
    )


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write planned records as gzipped WARC files, with Spark's text writer.

    A revisit holds no payload: it names the first response and the payload's digest. Null keys and urls are written
    as empty; repeated rows give captures that are told apart by a running number of their equal keys' records.
    """
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    nth = F.concat(page, F.lit("/"), F.monotonically_increasing_id().cast("string"))
    rows = records.withColumn("capture", nth)
    main, digest = _id("main", F.col("capture")), F.concat(F.lit("sha256:"), F.col("payload_digest"))
    common = [("WARC-Date", date), ("WARC-Target-URI", _field(F.col("url")))]
    revisit = F.col("refers_to").isNotNull()
    request = _record(
        "request", [("WARC-Record-ID", _id("request", F.col("capture"))), ("WARC-Concurrent-To", main), *common, ("Content-Type", "application/http;msgtype=request")],
        F.lit("GET / HTTP/1.1" + _END + _END),
    )
    response = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        [
            ("WARC-Record-ID", main), *common, ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))),
            ("Content-Type", "application/http;msgtype=response"),
        ],
        F.concat(
            F.lit("HTTP/1.1 200 OK" + _END + "Content-Type: text/html; charset=utf-8" + _END + _END),
            F.when(revisit, F.lit("")).otherwise(F.col("payload")),
        ),
    )
    fields = F.concat(
        F.lit("page: "), page, F.lit(_END + "payload-bytes: "), F.col("payload_bytes").cast("string"),
        F.lit(_END + "has-url: "), F.col("url").isNotNull().cast("string"), F.lit(_END),
    )
    metadata = _record(
        "metadata", [("WARC-Record-ID", _id("metadata", F.col("capture"))), ("WARC-Concurrent-To", main), *common, ("Content-Type", "application/warc-fields")], fields
    )
    (
        rows.select(F.concat_ws(_END + _END, request, response, metadata).alias("value"))
        .write.option("lineSep", _END + _END).option("compression", "gzip").option("maxRecordsPerFile", FILE_CAPTURES).text(path)
    )


RECORD = "record_id string, kind string, concurrent_to string, uri string, refers_to string, digest string, payload binary, payload_bytes long, payload_sha256 string"


def _records(stream: io.BufferedIOBase):
    """Records one after another: headers as a dictionary with lower-case names, and the block of exactly the stated length."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record ends before its stated length")
        yield headers, block


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives in a folder, one row each; without ``payloads`` only their sizes and digests are kept."""
    let_workers_import(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    for headers, block in _records(stream):
                        kind = headers["warc-type"]
                        if kind in ("response", "revisit", "request"):
                            block = block[block.index(b"\r\n\r\n") + 4:]
                        keep = payloads or kind == "metadata"
                        rows.append((
                            headers["warc-record-id"], kind, headers.get("warc-concurrent-to"), headers.get("warc-target-uri"), headers.get("warc-refers-to"),
                            headers.get("warc-payload-digest"), block if keep else None, len(block), hashlib.sha256(block).hexdigest(),
                        ))
                        held += len(block) if keep else 0
                        if held > 8 << 20 or len(rows) > 4000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 6 + [pa.binary(), pa.int64(), pa.string()]
    names = [part.split(" ")[0] for part in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` with the ``request`` and ``metadata`` records concurrent to it (null: none).

    Record ids are unique, so each join's keys are; records concurrent to nothing found belong to no capture.
    """
    whole = F.struct(*(F.col(f"`{c}`") for c in records.columns))
    of = lambda kind: records.where(F.col("kind") == kind).select(F.col("concurrent_to").alias("at"), whole.alias(kind))
    main = records.where(F.col("kind").isin("response", "revisit")).select(F.col("record_id").alias("at"), whole.alias("response"))
    return main.join(of("request"), "at", "left").join(of("metadata"), "at", "left").select(F.col("at").alias("capture_id"), "request", "response", "metadata")


def capture_columns(captures: DataFrame) -> DataFrame:
    """The page, url, payload size and digest, type and reference of assembled captures; a stored payload that does
    not have the digest or size stated for it stops the job."""
    fields = F.str_to_map(F.decode(F.col("metadata.payload"), "utf-8"), F.lit("\r\n"), F.lit(": "))
    revisit = F.col("response.kind") == "revisit"
    stated = F.substring_index(F.col("response.digest"), ":", -1)
    size = fields["payload-bytes"].cast("long")
    checked = F.when(
        revisit | ((stated == F.col("response.payload_sha256")) & (size == F.col("response.payload_bytes"))), stated
    ).otherwise(F.raise_error(F.lit("a stored payload does not match its record")))
    return captures.select(
        F.when(fields["page"] != "", fields["page"]).alias("page_id"),
        F.when(fields["has-url"] == "true", F.url_decode(F.col("response.uri"))).alias("url"),
        size.alias("payload_bytes"), checked.alias("payload_digest"), F.col("response.kind").alias("record_type"),
        F.regexp_extract(F.col("response.refers_to"), "^<urn:page:(.*)>$", 1).alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Write pages to archives in the shared folder, read them back and assemble their captures.

    Null or empty payloads are empty responses; null keys come back as null (a null key is never a revisit's first
    response); repeated rows of one key with equal payloads all are responses. An empty table gives no captures.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(plan_records(pages, key, url, body, least), path)
    captures = assemble(read_archives(spark, path, payloads=False))
    kind = pages.schema[key].dataType
    out = capture_columns(captures)
    return out.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.when(F.col("record_type") == "revisit", F.col("refers_to")).cast(kind)})
