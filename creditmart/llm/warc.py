"""WARC archives: writing transactions, reading records, and assembling captures.

A capture is written as a request, a response (or a revisit of a record with the same payload) and
a metadata record. The reader takes archives as they are, record by record, and joins the three
back through WARC-Concurrent-To into one nested row per capture.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditmart.llm.tables import Scratch, ready_workers, text_of, with_size
from creditmart.operators.lookup import DEFAULT_LIMITS, JoinLimits, attach, key_counts

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF, BLANK = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"    # fixed value
CAPTURES_PER_FILE = 2000
FILE_BYTES = 64 << 20           # most that the captures of an archive take together, unless it is one
COPIES = 1000                   # repeated rows that a task numbers at a time
RECORD_SCHEMA = ("record_id string, kind string, target_uri string, concurrent_to string, "
                 "refers_to string, stated_digest string, fields map<string,string>, "
                 "payload_bytes long, payload_digest string, payload binary")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of a binary column in upper-case base32: five hex digits are four characters."""
    hexed = F.sha1(payload)
    groups = [F.conv(F.substring(hexed, 1 + 5 * g, 5), 16, 10).cast("int") for g in range(8)]
    return F.concat(*[
        F.substr(F.lit(BASE32), F.shiftright(group, 15 - 5 * i).bitwiseAND(31) + 1, F.lit(1))
        for group in groups for i in range(4)])


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\x1f", *parts))
    at = lambda start, n: F.substring(h, start, n)
    return F.concat_ws("-", at(1, 8), at(9, 4), at(13, 4), at(17, 4), at(21, 12))


def _record(kind: str, record_id: Column, block: Column, date: str, *headers: Column) -> Column:
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Date: {date}{CRLF}"
              "WARC-Record-ID: <urn:uuid:"), record_id, F.lit(f">{CRLF}"), *headers,
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(BLANK), block)


def _header(name: str, value: Column, opens: str = "", closes: str = "") -> Column:
    """A header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: {opens}"), value, F.lit(f"{closes}{CRLF}")), F.lit(""))


def write_archives(pages: DataFrame, path: str, date: str = "2025-01-01T00:00:00Z") -> None:
    """Write every row of ``page_id, url, html`` as a transaction of WARC records under ``path``.

    Of equal payloads the one with the largest page_id is the response and the others revisit it.
    A null html is an empty payload; empty payloads are equal too. A null url has no target header;
    line breaks in a url are written as ``%0D`` and ``%0A``. Rows with a null page_id revisit a
    numbered one, or are all responses where no equal payload has a number. Rows alike in all three
    columns are captures of their own, told apart by a number in their ids. Other columns are ignored.
    Archives are bounded by captures and bytes; a capture beyond the bytes has one to itself.
    """
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(F.col("page_id").cast("string").alias("page"), "page_id", url.alias("url"),
                        text_of("html").alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    rows = rows.withColumn("uid", _uuid(F.coalesce("page", F.lit("")),
                                        F.coalesce("url", F.lit("\x00")), F.col("digest")))
    latest = F.max(F.struct("page_id", "uid", "url"))
    weight = F.octet_length("html") + 4 * F.coalesce(F.octet_length("url"), F.lit(0)) + 4096
    scratch, seen = Scratch(pages.sparkSession), Observation()
    groups = (rows.observe(seen, F.max(weight).alias("largest")).groupBy("digest")
              .agg(latest.alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "first"))
    saved = scratch.save(groups, "groups")
    groups, largest = with_size(saved, row_bytes=400), seen.get["largest"] or 0
    repeated = scratch.save(rows.join(groups, "digest", "left_semi").groupBy("uid")
                            .agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "repeated")
    if repeated.rows:
        rows = _number_copies(rows.join(with_size(repeated, row_bytes=150), "uid", "left"))
    rows = rows.join(groups, "digest", "left")
    revisits = F.coalesce(F.col("first.page_id").isNotNull()
                          & ~F.col("page_id").eqNullSafe(F.col("first.page_id")), F.lit(False))
    target = _header("WARC-Target-URI", F.col("url"))
    digest = _header("WARC-Payload-Digest", F.col("digest"), "sha1:")
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                          "Content-Length: "), size, F.lit(BLANK))
    kind = _header("Content-Type", F.lit("application/http"))
    response = _record("response", F.col("uid"), F.concat(http, F.col("html")), date, target, kind,
                       digest)
    revisit = _record("revisit", F.col("uid"), http, date, target, kind, digest,
                      _header("WARC-Profile", F.lit(PROFILE)),
                      _header("WARC-Refers-To", F.col("first.uid"), "<urn:uuid:", ">"),
                      _header("WARC-Refers-To-Target-URI", F.col("first.url")))
    tied = _header("WARC-Concurrent-To", F.col("uid"), "<urn:uuid:", ">")
    request = _record("request", _uuid(F.lit("request"), F.col("uid")),
                      F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")),
                               F.lit(f" HTTP/1.1{BLANK}")), date, target, tied, kind)
    metadata = _record("metadata", _uuid(F.lit("metadata"), F.col("uid")),
                       F.coalesce(F.concat(F.lit("page-id: "), F.col("page"), F.lit(CRLF)),
                                  F.lit("")), date, tied,
                       _header("Content-Type", F.lit("application/warc-fields")))
    capture = F.concat_ws(BLANK, request, F.when(revisits, revisit).otherwise(response), metadata)

    def write(part: DataFrame, captures: int) -> None:
        # The writer ends a row with the blank line that ends a record.
        (part.select(capture.alias("value")).write.mode("append").option("lineSep", BLANK)
         .option("maxRecordsPerFile", captures).text(path))

    large = weight > FILE_BYTES // CAPTURES_PER_FILE
    many = largest > FILE_BYTES // CAPTURES_PER_FILE
    write(rows.where(~large) if many else rows, CAPTURES_PER_FILE)
    if many:
        write(rows.where(large), max(1, FILE_BYTES // largest))


def _number_copies(rows: DataFrame) -> DataFrame:
    """The rows with a ``uid`` of their own each; ``copies`` counts those that share one, if any do.

    The first keeps it. One row of a kind is moved for each block of numbers, so that no task writes
    all copies of a row.
    """
    kinds = rows.where("copies is not null").dropDuplicates(["uid"])
    number = F.explode(F.expr("sequence(_from, least(_from + %d, copies))" % (COPIES - 1)))
    copies = (kinds.withColumn("_from", F.explode(F.expr(f"sequence(1L, copies, {COPIES}L)")))
              .repartition("uid", "_from").withColumn("_number", number)
              .withColumn("uid", F.when(F.col("_number") == 1, F.col("uid"))
                          .otherwise(_uuid(F.col("uid"), F.col("_number").cast("string")))))
    alone = rows.where("copies is null")
    return alone.unionByName(copies.select(*alone.columns))


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split(CRLF))
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def parse(archive: bytes) -> Iterator[dict]:
    """The records of one uncompressed archive, cut by their stated lengths."""
    at, blank = 0, BLANK.encode()
    while (at := archive.find(b"WARC/", at)) >= 0:
        end = archive.find(blank, at)
        if end < 0:
            raise ValueError(f"record header at byte {at} does not end")
        headers = _fields(archive[archive.index(b"\n", at) + 1:end])
        block = archive[end + 4:end + 4 + int(headers["content-length"])]
        if len(block) < int(headers["content-length"]):
            raise ValueError(f"record at byte {at} is cut short")
        at = end + 4 + len(block)
        kind, fields, payload = headers.get("warc-type"), {}, None
        if headers.get("content-type", "").startswith("application/http"):
            head, _, body = block.partition(blank)
            fields = _fields(head.partition(CRLF.encode())[2])
            payload = body if kind == "response" else None
        elif kind == "metadata":
            fields = _fields(block)
        elif kind in ("resource", "conversion"):
            payload = block
        urn = lambda name: headers.get(name, "").strip("<>") or None
        yield {"record_id": urn("warc-record-id"), "kind": kind,
               "target_uri": headers.get("warc-target-uri"),
               "concurrent_to": urn("warc-concurrent-to"), "refers_to": urn("warc-refers-to"),
               "stated_digest": headers.get("warc-payload-digest"), "fields": list(fields.items()),
               "payload_bytes": None if payload is None else len(payload),
               "payload_digest": None if payload is None else
               base64.b32encode(hashlib.sha1(payload).digest()).decode(), "payload": payload}


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of all archives under ``path``; an empty archive has none.

    Sizes and digests are computed from the payloads, which are left out on request. A record that
    is cut short fails the read.
    """
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    kinds = {"fields": pa.map_(pa.string(), pa.string()), "payload_bytes": pa.int64(),
             "payload": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(parse(content.as_py()))
                if not with_payload:
                    for r in rows:
                        r["payload"] = None
                yield pa.record_batch([pa.array([r[n] for r in rows], kinds.get(n, pa.string()))
                                       for n in names], names)

    ready_workers(spark)
    archives = spark.read.format("binaryFile").load(path).select("content")
    return archives.mapInArrow(work, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (or revisit), ``request``, ``metadata``.

    Requests and metadata are joined to the response they name in WARC-Concurrent-To; a capture
    without one has null or an empty list there, and a request that names no known response is
    left out. Of several requests the one with the smallest record id counts; metadata records are
    listed by record id. Records that repeat a record id are the same record and count once.
    """
    records = records.dropDuplicates(["record_id"])
    captured = records.where(F.col("kind").isin("response", "revisit"))
    short = F.struct("record_id", "target_uri")
    others = (records.where(F.col("kind").isin("request", "metadata"))
              .groupBy(F.col("concurrent_to").alias("_to"))
              .agg(F.min(F.when(F.col("kind") == "request", short)).alias("request"),
                   F.array_sort(F.collect_list(F.when(F.col("kind") == "metadata", F.struct(
                       "record_id", F.to_json("fields").alias("fields"))))).alias("metadata")))
    response = F.struct("record_id", "kind", "target_uri", "refers_to", "stated_digest",
                        "payload_bytes", "payload_digest", "payload")
    return (captured.select(response.alias("response"))
            .join(others, F.col("response.record_id") == F.col("_to"), "left")
            .select("response", "request", F.coalesce("metadata", F.array()).alias("metadata")))


def page_table(captures: DataFrame, limits: JoinLimits = DEFAULT_LIMITS) -> DataFrame:
    """Per page of archives that ``write_archives`` wrote: its full payload's size and digest.

    A revisit's payload is that of the record it refers to; unknown, and null, where there is none.
    Responses need no other record and are not moved: only revisits meet the responses that they name.
    Reads ``captures`` four times, so hand in a stored table.
    """
    page = F.get_json_object(F.col("metadata")[0]["fields"], "$.page-id").cast("long")
    rows = captures.select(page.alias("page_id"), "response.*").drop("payload")
    refers = (F.col("kind") == "revisit") & F.col("refers_to").isNotNull()
    revisits = rows.where(refers)
    names = revisits.select(F.col("refers_to").alias("record_id")).distinct()
    named = Scratch(captures.sparkSession).save(
        rows.where("kind = 'response'").join(names, "record_id", "left_semi").select(
            F.col("record_id").alias("refers_to"), F.col("page_id").alias("_page"),
            F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")), "named")
    found = attach(revisits, named.df, ["refers_to"], right_bytes=named.rows * 300,
                   counts=key_counts(revisits, ["refers_to"]), salt_by=["record_id"], limits=limits)
    alone = rows.where(~refers).withColumns({"_page": F.lit(None).cast("long"),
                                             "_bytes": F.lit(None).cast("long"),
                                             "_digest": F.lit(None).cast("string")})
    return alone.unionByName(found).select(
        "page_id", F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "_digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), F.col("_page").alias("refers_to"))
