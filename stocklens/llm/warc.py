"""Web archives: write pages as WARC records, read archives back, assemble transactions.

Writing is plain DataFrame work. A page gives three records: a request, a response (or a revisit of an
equal payload) and a metadata record; request and metadata name the response in WARC-Concurrent-To.
Every record ends in a blank line, which is the line separator of Spark's text writer, so each
output file is a WARC file, compressed by gzip as archives usually are, written through Spark to any store.

Of pages with equal payloads of at least ``revisit_bytes`` bytes the one with the largest page_id is a
response; the others revisit it. The equal payloads meet in a left join on the digest, which adaptive
execution can split when one payload has a large part of all rows.

Reading streams each file record by record, by Content-Length, and holds one record at a time
beside the compressed file. A file holds at most ``file_records`` records and no more than one write
task's rows. Assembly brings the records of a capture together by the response's identifier, payload
included: one exchange, one nested row per capture; length and digest are taken of the payload there.

Nulls and ties: a null html is an empty payload, a null url becomes ``urn:page:<page_id>``; a null
page_id never revisits; rows equal in page_id, url and html are captures of their own, told apart by
an occurrence number in their identifiers. Pages equal in payload that share the largest page_id are
all responses. Records whose partner is missing still give a capture with null members. A very
long payload is one record, of up to 2 GB as any string in Spark. Other columns are left out.
"""

from __future__ import annotations

import gzip
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.common import new_folder, staged, table, utf8

REVISIT_BYTES, FILE_RECORDS = 1000, 12_000
BATCH_BYTES = 8_000_000
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in
                                                            ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _fields(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a field with a null value is left out."""
    return F.array_join(F.array_compact(F.array(*[F.concat(F.lit(k + ": "), v, F.lit(CRLF)) for k, v in pairs])), "")


def _record(kind: Column, record_id: Column, block: Column, content_type: str, *more: tuple[str, Column]) -> Column:
    head = _fields(("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(DATE)),
                   ("Content-Type", F.lit(content_type)), *more, ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit("WARC/1.1" + CRLF), head, F.lit(CRLF), block)


def archive_rows(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """One row per record, its text without the closing blank line: column ``value``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"digest": F.sha1(utf8(F.col("html"))), "bytes": F.octet_length("html").cast("long")})
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null"))))
    rows = rows.withColumns({"uri": uri, "key": F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
                                                           F.coalesce(F.col("url"), F.lit("")), F.col("url").isNull().cast("string"), "digest")})
    same = rows.groupBy("page_id", "bytes", "digest", "key").agg(F.count(F.lit(1)).alias("_same"))
    may = (F.col("bytes") >= revisit_bytes) & F.col("page_id").isNotNull()
    # What a payload's pages need of each other: the response that others revisit, and whether rows are repeated.
    met = staged(same.groupBy(F.col("digest").alias("_digest")).agg(
        F.sum(F.when(may, F.col("_same"))).alias("_n"), F.max(F.when(may, F.struct("page_id", "key"))).alias("_best"),
        (F.max("_same") > 1).alias("_repeated")).where("_n > 1 or _repeated").select(
        "_digest", "_repeated", F.col("_best.page_id").alias("_page"), F.concat("_best.key", F.lit("|1")).alias("_key")), "warc-equal")
    once = rows.join(met, F.col("digest") == F.col("_digest"), "left").where(~F.coalesce("_repeated", F.lit(False))).withColumn("_i", F.lit(1))
    # Equal rows are brought to one, which carries their number, before it is written as often.
    again = rows.join(met.where("_repeated"), F.col("digest") == F.col("_digest"))
    again = again.groupBy([c for c in again.columns if c != "html"]).agg(F.first("html").alias("html"), F.count(F.lit(1)).cast("int").alias("_times"))
    again = again.select(*[c for c in again.columns if c != "_times"], F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_i"))
    rows = once.unionByName(again).withColumn("key", F.concat_ws("|", "key", "_i"))
    revisits = F.coalesce((F.col("page_id") < F.col("_page")) & (F.col("bytes") >= revisit_bytes), F.lit(False))
    response_id = record_uuid(F.col("key"), F.lit("response"))
    size = F.col("bytes").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + "Content-Length: "),
                    size, F.lit(CRLF + CRLF))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    target = ("WARC-Target-URI", F.col("uri"))
    together = ("WARC-Concurrent-To", response_id)
    host = F.coalesce(F.nullif(F.regexp_extract("uri", r"^[a-z]+://([^/?#]*)", 1), F.lit("")), F.lit("-"))
    path = F.regexp_replace("uri", r"^[a-z]+://[^/?#]*", "")
    request = F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(" HTTP/1.1" + CRLF + "Host: "), host, F.lit(CRLF + CRLF))
    note = _fields(("page-id", F.col("page_id").cast("string")), ("payload-bytes", size))
    records = F.array(
        _record(F.lit("request"), record_uuid(F.col("key"), F.lit("request")), request, "application/http; msgtype=request", target, together),
        _record(F.when(revisits, "revisit").otherwise("response"), response_id,
                F.when(revisits, http).otherwise(F.concat(http, "html")), "application/http; msgtype=response", target,
                ("WARC-Payload-Digest", digest), ("WARC-Profile", F.when(revisits, PROFILE)),
                ("WARC-Refers-To", F.when(revisits, record_uuid(F.col("_key"), F.lit("response")))),
                ("WARC-Refers-To-Page", F.when(revisits, F.col("_page").cast("string")))),
        _record(F.lit("metadata"), record_uuid(F.col("key"), F.lit("metadata")), note, "application/warc-fields", target, together))
    return rows.select(F.explode(records).alias("value"))


def write_archives(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, file_records: int = FILE_RECORDS) -> None:
    (archive_rows(pages, revisit_bytes).write.option("lineSep", CRLF + CRLF)
     .option("maxRecordsPerFile", file_records).option("compression", "gzip").text(path))


def opened(data: bytes):
    """An archive's bytes as a stream without gzip, whether it is one member, a member per record or not compressed."""
    stream = io.BytesIO(data)
    return io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20) if data.startswith(b"\x1f\x8b") else stream


def parse(stream):
    """Records of one archive, one after the other: (headers, block)."""
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {first[:40]!r}")
        head = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        length = int(head["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"record {head.get('warc-record-id')} ends after {len(block)} of {length} bytes")
        yield head, block
        stream.read(4)


RECORDS = ("record_id string, type string, concurrent_to string, uri string, date string, refers_to string, "
           "refers_to_page long, digest string, page_id long, http string, payload binary, payload_bytes long")


def read_archives(spark, path: str) -> DataFrame:
    """One row per record. ``payload_bytes`` and ``digest`` are as the headers state them; a revisit has no payload."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORDS.split(", ")])

    def rows(batches):
        for batch in batches:
            for content in batch.column(0):
                out, held = {n: [] for n in names}, 0
                for head, block in parse(opened(content.as_buffer().to_pybytes())):
                    kind, http, payload, size, digest, page = head["warc-type"], None, None, None, None, None
                    if kind in ("response", "revisit"):
                        top, _, body = block.partition(b"\r\n\r\n")
                        http = top.decode("utf-8")
                        payload = body if kind == "response" else None
                        size = next((int(x.split(":")[1]) for x in http.split("\r\n") if x.lower().startswith("content-length:")), None)
                        digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    elif kind == "request":
                        http = block.decode("utf-8").rstrip("\r\n")
                    elif kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in block.decode("utf-8").split("\r\n") if ": " in x)
                        page = int(fields["page-id"]) if "page-id" in fields else None
                    refers = head.get("warc-refers-to-page")
                    for n, v in zip(names, (head.get("warc-record-id"), kind, head.get("warc-concurrent-to"), head.get("warc-target-uri"),
                                            head.get("warc-date"), head.get("warc-refers-to"), int(refers) if refers else None,
                                            digest, page, http, payload, size)):
                        out[n].append(v)
                    held += len(block) + 200
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pydict(out, schema=schema)
                        out, held = {n: [] for n in names}, 0
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response (or revisit) and metadata.

    Length and digest of a response are those of its payload; ``intact`` tells if they are as its
    headers state. A revisit has no payload and keeps what its headers state of it.
    """
    answers = F.col("type").isin("response", "revisit")
    rows = records.withColumn("capture_id", F.when(answers, F.col("record_id")).otherwise(F.col("concurrent_to")))
    request = F.struct("record_id", "uri", "date", "http")
    answer = F.struct("record_id", "type", "uri", "date", "http", "payload", "payload_bytes", "digest", "refers_to", "refers_to_page")
    note = F.struct("record_id", "page_id")
    met = rows.groupBy("capture_id").agg(
        F.first(F.when(F.col("type") == "request", request), ignorenulls=True).alias("request"),
        F.first(F.when(answers, answer), ignorenulls=True).alias("response"),
        F.first(F.when(F.col("type") == "metadata", note), ignorenulls=True).alias("metadata"))
    told = F.col("response")
    size, digest = F.octet_length("response.payload").cast("long"), F.sha1("response.payload")
    return met.withColumn("response", F.when(told.isNotNull(), told.withField("payload_bytes", F.coalesce(size, told["payload_bytes"])).withField(
        "digest", F.coalesce(digest, told["digest"])).withField(
        "intact", F.coalesce((size == told["payload_bytes"]) & (digest == told["digest"]), told["payload"].isNull()))))


def query(spark, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return captures(read_archives(spark, path)).select(
        "metadata.page_id", "response.payload_bytes", F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"), F.col("response.refers_to_page").alias("refers_to"))


SQL = f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
b AS (SELECT payload_digest, max(page_id) AS best FROM p WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY payload_digest),
r AS (SELECT p.*, payload_bytes >= {REVISIT_BYTES} AND page_id < best AS again, best FROM p LEFT JOIN b USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN best END AS refers_to FROM r
"""
