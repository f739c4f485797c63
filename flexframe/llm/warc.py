"""WARC archives: pages written as request, response and metadata records, read back as one row per capture.

**Writing.** A capture becomes three records: a request, a response, and a
metadata record with the page's id; request and metadata name the response in
``WARC-Concurrent-To``. Where several captures have one payload of at least
``least`` bytes, the one with the greatest id keeps it as a response; the
others are revisit records, which hold the HTTP header alone and name the
response in ``WARC-Refers-To``. Spark's text writer separates rows by
``\\r\\n\\r\\n``, which is just what ends a WARC record, so archives go to any
store that Spark writes to, gzip-compressed as a whole file.

**Reading.** The text reader hands a compressed file to one task as a stream
of fragments, cut at ``\\r\\n\\r\\n``; the parser joins them again and goes by
``Content-Length`` alone, so payloads may hold anything. A task holds one
record at a time.

**Transactions.** ``captures`` joins records through their concurrent-to
identifiers, whichever side names the other, and gives one nested row per
capture. Rows of a capture share its own identifier, which no other capture
has; the references of revisits, where one response may be named by a third of
all rows, go through ``common.lookup``.

Defined results: null payloads are empty, a null id or URL is left out of the
records and read as null; line ends and blanks in a URL are percent-encoded;
of rows that repeat id and payload just one is the response and the others
revisit it; payloads below ``least`` bytes (so all empty ones) are always
responses; payloads of any length are kept whole; other columns are ignored;
an empty table gives an archive without records and no rows. A record cut off
at the end of its file, or bytes that are no record, raise with the file's
name. Requests and metadata that no capture of the input answers to are left
out of ``captures`` and stay in ``records``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import lookup, staged

END = "\r\n\r\n"
#: Payloads of fewer bytes are never replaced by a revisit.
LEAST = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records that stand for a capture; the others belong to one of them.
ANCHORS = ("response", "revisit", "resource")
#: Bytes of payloads, and records, that the parser hands over at once.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2048

RECORD = (
    "file string, type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, "
    "date string, content_type string, status int, fields map<string,string>, payload_bytes long, payload_digest string"
)


def _urn(*parts: Column | str) -> Column:
    h = F.md5(F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: Column | str, record_id: Column, uri: Column, date: str, content_type: str, block: Column, more: list[tuple[str, Column]]) -> Column:
    """The text of a record, without the ``END`` after it; fields whose value is null are left out."""
    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))

    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Target-URI", uri), ("WARC-Date", F.lit(date)),
            ("Content-Type", F.lit(content_type)), *more, ("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.lit("WARC/1.1"), *[field(n, v) for n, v in head], F.lit(END), block)


def write(spark: SparkSession, pages: DataFrame, folder: str, least: int = LEAST, date: str | None = None,
          compression: str = "gzip", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the archives of ``pages`` to ``folder``: one file per task."""
    html = F.coalesce(pages[html_col], F.lit(""))
    rows = staged(spark, pages.select(
        pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), html.alias("html"),
        F.octet_length(html).cast("long").alias("size"), F.sha1(html.cast("binary")).alias("sha1"),
        F.sha2(html, 256).alias("sha256"), F.monotonically_increasing_id().alias("uid")), "warc-pages")
    # the keeper of each payload that occurs more than once
    top = rows.where(F.col("size") >= least).groupBy("sha256").agg(
        F.max(F.struct("page_id", "uid")).alias("top"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    keepers = staged(spark, top.select("sha256", F.col("top.uid").alias("keeper")), "warc-keepers")
    marked = lookup(rows, keepers, ["sha256"])

    run, date = uuid.uuid4().hex, date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    again = F.coalesce(F.col("keeper") != F.col("uid"), F.lit(False))
    uri = F.col("url")
    for bad, code in (("%0D", "\r"), ("%0A", "\n"), ("%20", " "), ("%09", "\t")):
        uri = F.replace(uri, F.lit(code), F.lit(bad))
    host = F.coalesce(F.try_parse_url(uri, F.lit("HOST")), F.lit("-"))
    path = F.coalesce(F.try_parse_url(uri, F.lit("FILE")), F.lit(""))
    path = F.when(path == "", F.lit("/")).otherwise(path)
    here = _urn(run, "capture", F.col("uid"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")))
    request = _record("request", _urn(run, "request", F.col("uid")), uri, date, "application/http;msgtype=request",
                      F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END)), [("WARC-Concurrent-To", here)])
    answer = _record(
        F.when(again, "revisit").otherwise("response"), here, uri, date, "application/http;msgtype=response",
        F.concat(http, F.when(again, F.lit("")).otherwise(F.col("html"))),
        [digest, ("WARC-Refers-To", F.when(again, _urn(run, "capture", F.col("keeper")))), ("WARC-Profile", F.when(again, F.lit(PROFILE)))])
    about = _record("metadata", _urn(run, "metadata", F.col("uid")), uri, date, "application/warc-fields",
                    F.concat(F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")), F.lit("via: pages\r\n")),
                    [("WARC-Concurrent-To", here)])
    marked.select(F.explode(F.array(request, answer, about)).alias("value")).write.mode("overwrite").option(
        "lineSep", END).option("compression", compression).text(folder)


def _fields(head: bytes) -> list[tuple[str, str]]:
    """(lower-case name, value) of the lines of a header; lines that begin with a blank continue the one before."""
    out: list[tuple[str, str]] = []
    for line in head.split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def _sha1(text: str | None) -> str | None:
    """The bare hexadecimal form of a SHA-1 digest field, which may be base 32."""
    kind, _, value = (text or "").partition(":")
    if kind.lower() != "sha1":
        return None
    if len(value) == 32:
        return base64.b32decode(value.upper()).hex()
    return value.lower()


def _parsed(file: str, head: bytes, block: bytes, payload: bool) -> dict:
    """One record as a row of ``RECORD`` (and ``payload``)."""
    fields = _fields(head)
    of = dict(reversed(fields))  # the first of each name
    kind, content_type = of.get("warc-type"), of.get("content-type", "")
    row = {"file": file, "type": kind, "record_id": of.get("warc-record-id"), "refers_to": of.get("warc-refers-to"),
           "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"], "target_uri": of.get("warc-target-uri"),
           "date": of.get("warc-date"), "content_type": content_type or None, "status": None, "fields": None}
    body = block
    if content_type.lower().startswith("application/http"):
        http, gap, body = block.partition(b"\r\n\r\n")
        first, _, lines = http.partition(b"\r\n")
        row["fields"] = dict(reversed(_fields(lines)))
        words = first.split()
        row["status"] = int(words[1]) if kind in ANCHORS and len(words) > 1 and words[1].isdigit() else None
    elif content_type.lower().startswith("application/warc-fields"):
        row["fields"] = dict(reversed(_fields(block)))
    if kind == "revisit":  # both of the payload that it stands for
        size = (row["fields"] or {}).get("content-length", "")
        row["payload_bytes"] = int(size) if size.isdigit() else None
        row["payload_digest"] = _sha1(of.get("warc-payload-digest"))
    else:
        row["payload_bytes"], row["payload_digest"] = len(body), hashlib.sha1(body).hexdigest()
    if payload:
        row["payload"] = None if kind == "revisit" else body
    return row


def records(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of the archives below ``folder`` (``RECORD``, and ``payload``: binary, null for revisits).

    Compressed files of any size are streamed. Plain ``.warc`` files are read
    whole, one file a row, since Spark would split them anywhere; Spark's bound
    is 2 GB a file.
    """
    schema = RECORD + (", payload binary" if payload else "")
    plain = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc").load(folder).select(
        F.col("path").alias("file"), "content")
    packed = spark.read.option("lineSep", END).option("pathGlobFilter", "*.{gz,bz2,zst,deflate}").text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("content"))
    names = [f.strip().split(" ")[0] for f in schema.split(", ")]
    types = {"concurrent_to": pa.list_(pa.string()), "fields": pa.map_(pa.string(), pa.string()), "status": pa.int32(),
             "payload_bytes": pa.int64(), "payload": pa.binary()}
    arrow = pa.schema([(n, types.get(n, pa.string())) for n in names])

    def batch(rows: list[dict]) -> pa.RecordBatch:
        for r in rows:
            r["fields"] = None if r["fields"] is None else list(r["fields"].items())
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, held, head, need = None, bytearray(), None, 0
        rows: list[dict] = []
        size = 0

        def finish():
            if head is not None or held.strip(b"\r\n"):
                raise ValueError(f"{file}: the last record is cut off")

        for b in batches:
            for name, piece in zip(b.column(0).to_pylist(), b.column(1)):
                if name != file:
                    finish()
                    file, held = name, bytearray()
                held += piece.as_buffer()
                held += b"\r\n\r\n"
                while True:
                    if head is None:
                        while held[:2] == b"\r\n":
                            del held[:2]
                        at = held.find(b"\r\n\r\n")
                        if at < 0:
                            break
                        head = bytes(held[:at])
                        if not head.startswith(b"WARC/"):
                            raise ValueError(f"{file}: no WARC record at {head[:40]!r}")
                        length = dict(_fields(head)).get("content-length", "")
                        if not length.isdigit():
                            raise ValueError(f"{file}: a record without Content-Length")
                        need = int(length)
                        del held[:at + 4]
                    if len(held) < need:
                        break
                    rows.append(_parsed(file, head, bytes(held[:need]), payload))
                    size += need if payload else 0
                    del held[:need]
                    head = None
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        finish()
        if rows:
            yield batch(rows)

    return packed.mapInArrow(run, schema).unionByName(plain.mapInArrow(run, schema))


def captures(spark: SparkSession, found: DataFrame) -> DataFrame:
    """One nested row per capture of ``records`` (give a staged table): its answer, its request, its metadata records.

    ``capture_id``, ``target_uri``, ``date``, ``answer`` (type, status,
    payload_bytes, payload_digest, refers_to, fields, and payload if the
    records have it), ``request`` (record_id, fields; of several the one with
    the least id) and ``metadata`` (array of record_id, fields, by id).
    """
    is_anchor = F.col("type").isin(*ANCHORS)
    anchors, others = found.where(is_anchor & F.col("record_id").isNotNull()), found.where(~is_anchor)
    # either side may name the other
    named = others.select(F.col("record_id").alias("member"), F.explode("concurrent_to").alias("capture_id"))
    names = anchors.select(F.explode("concurrent_to").alias("member"), F.col("record_id").alias("capture_id"))
    links = named.unionByName(names).where("member is not null").distinct()
    part = F.struct(F.col("record_id"), F.col("fields"))
    parts = others.where(F.col("type").isin("request", "metadata")).join(links, F.col("record_id") == F.col("member")).groupBy("capture_id").agg(
        F.get(F.array_sort(F.collect_list(F.when(F.col("type") == "request", part)), _by_id), F.lit(0)).alias("request"),
        F.array_sort(F.collect_list(F.when(F.col("type") == "metadata", part)), _by_id).alias("metadata"))
    kept = ["type", "status", "payload_bytes", "payload_digest", "refers_to", "fields"] + [c for c in ("payload",) if c in found.columns]
    answers = anchors.select(F.col("record_id").alias("capture_id"), "target_uri", "date", F.struct(*kept).alias("answer"))
    return answers.join(parts, "capture_id", "left")


def _by_id(a: Column, b: Column) -> Column:
    """Order of two records (maps have none, so the ids are compared)."""
    a, b = a["record_id"], b["record_id"]
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def round_trip(spark: SparkSession, pages: DataFrame, least: int = LEAST, **columns: str) -> DataFrame:
    """Write the archives of ``pages``, read them back: a row per page, as its capture tells it.

    page_id, payload_bytes, payload_digest, record_type, refers_to (the page id
    of the response that a revisit refers to), target_uri.
    """
    folder = scratch_dir(spark, "warc")
    write(spark, pages, folder, least, **columns)
    nested = captures(spark, staged(spark, records(spark, folder, payload=False), "warc-records"))
    ids = F.filter("metadata", lambda m: m["fields"]["pageid"].isNotNull())
    flat = staged(spark, nested.select(
        "capture_id", F.get(ids, F.lit(0))["fields"]["pageid"].cast("long").alias("page_id"), "answer.payload_bytes", "answer.payload_digest",
        F.col("answer.type").alias("record_type"), F.col("answer.refers_to").alias("target"), "target_uri"), "warc-captures")
    responses = flat.where("record_type = 'response'").select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    return lookup(flat, responses, ["target"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")
