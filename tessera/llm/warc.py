"""Web archives: writing captures as WARC transactions, reading them back, one nested row per capture."""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import shared_folder, table

DATE = "1970-01-01T00:00:00Z"
_END = "\r\n"
_RECORD = "record_type string, record_id string, concurrent_to string, target_uri string, refers_to string, page_id long, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"


def base32(sha1_hex: Column) -> Column:
    """Base32 (RFC 4648) of 40 hexadecimal digits."""
    groups = [F.lpad(F.conv(F.substring(sha1_hex, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: Column, record_id: Column, headers: list[Column], media: str, block: Column) -> Column:
    """A record without its last two line ends; null headers are left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {DATE}"), *headers]
    lines += [F.lit(f"Content-Type: {media}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(_END, *lines), F.lit(2 * _END), block)


#: Equal rows whose numbers are made from one row.
COPIES = 1 << 16


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes a request, a response or revisit and a metadata record per row (page_id, url, html) as gzipped WARC files.

    Of the rows with equal payloads of at least least_bytes bytes, that with the smallest page_id is the response,
    which the others revisit; these carry no payload. A null html is an empty payload, a null page_id counts as the
    largest, a null url leaves its header out; of rows with one page_id the smallest url comes first, and of equal
    rows one. Payloads are text in UTF-8.

    A payload travels once, however many pages have it, as copies are combined before the shuffle; the
    revisits are made from ids, urls and digests alone. Each Spark task writes one file through Spark's text
    writer, as a record ends with two line ends.
    """
    pages = pages.select("page_id", F.regexp_replace("url", r"[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html")).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    order = F.struct(F.coalesce("page_id", F.lit((1 << 63) - 1)).alias("page"), "url")
    shared = F.octet_length("html") >= least_bytes
    rows = pages.select("page_id", "url", "sha1", F.octet_length("html").alias("size"), shared.alias("shared"), order.alias("order")).groupBy("page_id", "url", "sha1", "size", "shared", "order").agg(F.count("*").alias("n"))
    # the numbers of equal rows, in chunks: no array grows with the rows
    rows = rows.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {COPIES})")))
    rows = rows.withColumn("nth", F.explode(F.sequence(F.col("chunk") * COPIES + 1, F.least("n", (F.col("chunk") + 1) * COPIES)))).drop("chunk")
    firsts = pages.where(shared).groupBy(F.col("sha1").alias("of")).agg(F.min(order).alias("first"))
    rows = rows.where("shared").join(firsts, F.col("sha1") == F.col("of")).withColumn("leads", F.col("order").eqNullSafe(F.col("first")) & (F.col("nth") == 1))
    answers = pages.where(shared).groupBy("sha1").agg(F.first("html").alias("html"), F.min(F.struct(order.alias("order"), "page_id")).alias("lead"))
    answers = answers.select("lead.page_id", F.col("lead.order.url").alias("url"), "sha1", "html", F.octet_length("html").alias("size"), F.lit(1).cast("long").alias("nth"))
    if least_bytes > 0:
        own = pages.where(~shared).select("page_id", "url", "sha1", "html", F.octet_length("html").alias("size"))
        nth = F.row_number().over(Window.partitionBy("sha1", "page_id", "url").orderBy("size"))
        answers = answers.unionByName(own.withColumn("nth", nth.cast("long")))
    texts = _transaction(answers, None).union(_transaction(rows.where("not leads"), F.col("first")))
    texts.write.option("lineSep", 2 * _END).option("compression", "gzip").text(path)


def _transaction(rows: DataFrame, first: Column | None) -> DataFrame:
    """The three records of each row (page_id, url, sha1, size, nth); with html a response, else a revisit of `first` (page, url)."""

    def name(kind: str, page: Column, url: Column, nth: Column) -> Column:
        return _urn(F.lit(kind), "sha1", F.coalesce(page.cast("string"), F.lit("-")), F.coalesce(url, F.lit("-")), nth.cast("string"))

    page, url, nth = F.coalesce("page_id", F.lit((1 << 63) - 1)), F.col("url"), F.col("nth")
    capture = name("capture", page, url, nth)
    uri = F.concat(F.lit("WARC-Target-URI: "), url)
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), capture)
    headers = [uri, F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha1")))]
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("size").cast("string"), F.lit(2 * _END))
    if first is not None:
        headers.append(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(F.concat(F.lit("WARC-Refers-To: "), name("capture", first["page"], first["url"], F.lit(1))))
    else:
        head = F.concat(head, "html")
    parts = [F.coalesce(F.regexp_extract("url", r"^\w+://([^/?#]*)(/?[^#]*)", k), F.lit("")) for k in (1, 2)]
    request = F.concat(F.lit("GET "), F.when(parts[1] == "", "/").otherwise(parts[1]), F.lit(f" HTTP/1.1{_END}Host: "), parts[0], F.lit(2 * _END))
    fields = F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit(_END)), F.lit(""))
    records = [
        _record(F.lit("request"), name("request", page, url, nth), [concurrent, uri], "application/http; msgtype=request", request),
        _record(F.lit("response" if first is None else "revisit"), capture, headers, "application/http; msgtype=response", head),
        _record(F.lit("metadata"), name("metadata", page, url, nth), [concurrent, uri], "application/warc-fields", fields),
    ]
    return rows.select(F.concat_ws(2 * _END, *records))


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


class _Members(io.RawIOBase):
    """The bytes of a file of gzip members (or a plain one), expanded as they are read."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.expander = memoryview(raw), 0, None
        self.plain = raw[:2] != b"\x1f\x8b"

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while self.plain or self.at < len(self.raw) or self.expander:
            if self.plain:
                data = self.raw[self.at : self.at + len(into)]
                self.at += len(data)
            else:
                self.expander = self.expander or zlib.decompressobj(31)
                held = self.expander.unconsumed_tail or self.raw[self.at : self.at + (1 << 16)]
                if not self.expander.unconsumed_tail:
                    self.at += len(held)
                data = self.expander.decompress(held, len(into))
                if self.expander.eof:
                    self.at -= len(self.expander.unused_data)
                    self.expander = None
                elif not data and not self.expander.unconsumed_tail and self.at >= len(self.raw):
                    raise EOFError("the archive ends inside a gzip member")
            if data or self.plain:
                into[: len(data)] = data
                return len(data)
        return 0


def records(raw: bytes, with_payload: bool) -> Iterator[tuple]:
    """The records of an archive's bytes, in the order of _RECORD's columns."""
    stream = io.BufferedReader(_Members(raw), 1 << 16)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = _headers(stream)
        block = stream.read(length := int(head["content-length"]))
        if len(block) < length:
            raise EOFError("the archive ends inside a record")
        kind = head["warc-type"]
        page_id = size = digest = good = payload = None
        if kind == "metadata":
            page_id = _headers(io.BytesIO(block)).get("pageid")
        elif kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
            size = int(_headers(io.BytesIO(http.partition(b"\r\n")[2])).get("content-length", len(payload)))
            if kind == "response":
                own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                size, good, digest = len(payload), digest in (None, own), own
        yield kind, head["warc-record-id"], head.get("warc-concurrent-to"), head.get("warc-target-uri"), head.get("warc-refers-to"), page_id and int(page_id), size, digest, good, payload if with_payload and kind == "response" else None


def _parse(with_payload: bool):
    kinds = [pa.string()] * 5 + [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [c.split()[0] for c in _RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for row in records(content.as_py(), with_payload):
                    rows.append(row)
                    size += len(row[-1] or b"") + 300
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in a folder, a file a task at least; a cut or malformed archive fails.

    A file is read whole, so it must be below 2 GB. A folder without archives gives no rows; records that share an id are rows of their own.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_parse(with_payload), _RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit, request and metadata, as structs; null where one is missing.

    Records belong together that name one record in WARC-Concurrent-To, or are it. Of several records of one kind and capture the
    smallest is taken, field by field, so that a rerun takes the same; no records give no rows.
    """
    own = F.col("record_type").isin("response", "revisit")
    capture = F.struct("record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "digest_ok", "payload")
    return (
        found.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id"))
        .agg(
            F.min(F.when(own, capture)).alias("capture"),
            F.min(F.when(F.col("record_type") == "request", F.struct("record_id", "target_uri"))).alias("request"),
            F.min(F.when(F.col("record_type") == "metadata", F.struct("record_id", "page_id"))).alias("metadata"),
        )
    )


SQL = """
select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, d as payload_digest,
  case when page_id = f then 'response' else 'revisit' end as record_type, case when page_id <> f then f end as refers_to
from (
  select *, min(page_id) over (partition by d) as f
  from (select page_id, html, (
      select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(h, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8)) & 31)::integer + 1, 1), '' order by i)
      from range(32) t(i)) as d
    from (select *, sha1(coalesce(html, '')) as h from pages))
)
"""


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    captures = assemble(read_records(spark, path, with_payload=False))
    captures = captures.select("capture_id", "metadata.page_id", "capture.payload_bytes", "capture.payload_digest", "capture.record_type", F.col("capture.refers_to").alias("of"))
    responses = captures.where("record_type = 'response'").select(F.col("capture_id").alias("of"), F.col("page_id").alias("refers_to"))
    return captures.join(responses, "of", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
