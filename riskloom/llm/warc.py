"""WARC archives: one transaction of three records per page, read back and assembled by join.

A page becomes a request, a response (or a revisit of an equal payload seen elsewhere) and a
metadata record; request and metadata name the response in ``WARC-Concurrent-To``. The archives
are WARC/1.1 files written by Spark's text writer, whose line separator is the record separator, so
committing and storing them is Spark's work. Reading parses whole files in Python, a record at a
time, and puts the transactions together by joins over the identifiers.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm.common import free_name, stored

#: Fixed texts of the format.
VERSION, GAP = "WARC/1.1", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PRINCIPAL = ("response", "revisit", "resource")
#: Parts into which the rows of one payload are dealt where they meet what is known of it.
SALTS = 16
RECORD = (
    "record_id string, record_type string, concurrent_to array<string>, target_uri string, date string, content_type string, "
    "refers_to_uri string, profile string, payload_digest string, payload_bytes long, intact boolean, block binary"
)


def base32_sha1(value: Column) -> Column:
    """Upper-case base32 SHA-1 of a text's UTF-8 bytes: five hex digits make four characters."""
    digest = F.sha1(value.cast("binary"))
    group = lambda i: F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*[group(i) for i in range(8)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def header_uri(url: Column) -> Column:
    """The address with everything but printable ASCII percent-encoded, so it fits into one header."""
    odd = "[^\\x21-\\x7e]"
    coded = F.transform(F.split(url, ""), lambda c: F.when(c.rlike(odd), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c))
    return F.when(url.rlike(odd), F.array_join(coded, "")).otherwise(url)


def _record(kind: str | Column, record_id: Column, block: Column, content_type: str, **headers: Column) -> Column:
    """One record without its closing gap; null headers are left out."""
    named = {"WARC-Type": F.lit(kind) if isinstance(kind, str) else kind, "WARC-Record-ID": record_id, **headers,
             "Content-Type": F.lit(content_type), "Content-Length": F.octet_length(block).cast("string")}
    lines = [F.concat(F.lit(f"{name.replace('_', '-')}: "), value) for name, value in named.items()]
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines), F.lit(GAP), block)


def _dealt(rows: DataFrame, known: DataFrame, key: str, *spread: Column) -> DataFrame:
    """Left join with a table of one row per ``key``, every key split into ``SALTS`` parts."""
    salt = free_name(rows, "salt")
    parts = known.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).join(parts, [key, salt], "left").drop(salt)


def write(
    pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", payload: str = "html",
    captured: str = "1970-01-01T00:00:00Z", least_bytes: int = 0, file_bytes: int = 128 << 20, compression: str = "gzip",
) -> None:
    """Write every row as one transaction below ``path``.

    Of rows whose payloads are equal and at least ``least_bytes`` long, the one with the smallest
    id is the response; the others revisit it and repeat neither its bytes nor its digest's work.
    Rows that share the smallest id are all responses; if no equal row has an id, all are. A
    null payload is empty, a null address gives no ``WARC-Target-URI``. Files hold about
    ``file_bytes`` of payload (by the average page), however many rows there are; no rows give an
    archive without records.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", header_uri(F.col("url")).alias("uri")))).alias("first")
    groups = stored(rows.groupBy("digest", "bytes").agg(F.count(F.lit(1)).alias("n"), first), "payloads")
    total = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("bytes") + 1024)).alias("bytes")).first()
    per_file = max(1, int(file_bytes * (total["n"] or 1) / (total["bytes"] or 1)))
    copied = groups.where((F.col("n") > 1) & (F.col("bytes") >= least_bytes) & F.col("first").isNotNull()).select("digest", "first")
    rows = _dealt(rows, copied, "digest", F.col("page_id"), F.col("url"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    token = F.monotonically_increasing_id()
    rows = rows.select("page_id", "url", "payload", "digest", "bytes", "first", revisit.alias("revisit"), token.alias("token"), header_uri(F.col("url")).alias("uri"))

    def record_id(kind: str) -> Column:
        # Three records of a row are made in one go, so the number only has to be unique in this run.
        d = F.md5(F.concat_ws(":", F.lit(uuid4_text), F.lit(kind), "token"))
        cut = [F.substring(d, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))

    uuid4_text = uuid4().hex
    principal, date, uri = record_id("response"), F.lit(captured), F.col("uri")
    place = F.regexp_extract("uri", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", 2)
    host = F.regexp_extract("uri", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", 1)
    target = F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), F.coalesce(place, F.lit(""))))
    asked = F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(GAP))
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(GAP))
    linked = {"WARC_Concurrent_To": principal, "WARC_Date": date, "WARC_Target_URI": uri}
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    request = _record("request", record_id("request"), asked, "application/http;msgtype=request", **linked)
    response = _record(
        F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), principal,
        F.when(F.col("revisit"), answer).otherwise(F.concat(answer, "payload")), "application/http;msgtype=response",
        WARC_Date=date, WARC_Target_URI=uri, WARC_Payload_Digest=digest,
        WARC_Profile=F.when(F.col("revisit"), F.lit(PROFILE)), WARC_Refers_To_Target_URI=F.when(F.col("revisit"), F.col("first.uri")),
        WARC_Refers_To_Date=F.when(F.col("revisit"), date),
    )
    metadata = _record("metadata", record_id("metadata"), F.to_json(F.struct("page_id", "url")), "application/json", **linked)
    text = F.concat(request, F.lit(GAP), response, F.lit(GAP), metadata)
    out = rows.select(text.alias("value")).write.option("lineSep", GAP).option("maxRecordsPerFile", per_file)
    out.option("compression", compression).text(path)


def parsed(content: pa.Buffer | bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(headers by lower-case name, block) of each record of a file, plain or gzip in any number of members."""
    file = io.BytesIO(memoryview(content))
    if bytes(memoryview(content)[:2]) == b"\x1f\x8b":
        file = io.BufferedReader(gzip.GzipFile(fileobj=file), 1 << 20)
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, list[str]] = {}
        while (line := file.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        block = file.read(size)
        if len(block) < size:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def _row(headers: dict[str, list[str]], block: bytes, payload: bool) -> tuple:
    one = lambda name: headers.get(name, [None])[0]
    kind, content_type = one("warc-type"), one("content-type") or ""
    body = block
    if content_type.startswith("application/http"):
        body = block.partition(b"\r\n\r\n")[2]
    stated = (one("warc-payload-digest") or "").rpartition(":")[2] or None
    own = base64.b32encode(hashlib.sha1(body).digest()).decode() if kind in PRINCIPAL else None
    held = kind in ("response", "resource")
    return (
        one("warc-record-id"), kind, headers.get("warc-concurrent-to", []), one("warc-target-uri"), one("warc-date"), content_type,
        one("warc-refers-to-target-uri"), one("warc-profile"), own if held else stated, len(body) if held else None,
        (stated in (None, own)) if held else None, body if payload and held else block if not held else None,
    )


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record of the archives below ``path`` (columns ``RECORD``).

    ``payload_bytes`` and ``payload_digest`` are taken from the bytes read; ``intact`` tells whether
    the stated digest agrees. A revisit has the stated digest only. ``block``: the payload of a
    response where ``payload`` asks for it, the whole block of other records. A file must fit
    into a task (``write`` bounds its files); anything that isn't a WARC record is an error.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    names = [c.split()[0] for c in RECORD.split(", ")]
    text, kinds = pa.string(), {"concurrent_to": pa.list_(pa.string()), "payload_bytes": pa.int64(), "intact": pa.bool_(), "block": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, text)) for n, c in zip(names, zip(*rows))], names=names)

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for headers, block in parsed(content.as_buffer()):
                    rows.append(_row(headers, block, payload))
                    held += 256 + len(rows[-1][-1] or b"")
                    if held > 4 << 20:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    return files.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, requests, metadata``.

    A response, revisit or resource stands for its capture. A request or metadata record belongs to
    it if either names the other in its concurrent-to identifiers, or if it and a record that
    belongs to it do so; of several captures the one with the smallest identifier. What leads to no
    response is a capture of its own with a null response. A record that is repeated (by its
    identifier) counts once; requests and metadata are sorted by identifier. The records are stored
    once, so archives are parsed once however many joins read them.
    """
    records = stored(records.dropDuplicates(["record_id"]), "records")
    main = F.col("record_type").isin(*PRINCIPAL)
    heads = records.where(main)
    others = records.where(~main)
    link = lambda df: df.select("record_id", F.explode("concurrent_to").alias("other"))
    named = link(others).unionByName(link(others).select(F.col("other").alias("record_id"), F.col("record_id").alias("other")))
    ids = heads.select(F.col("record_id").alias("other"), F.col("record_id").alias("capture_id"))
    direct = link(others).join(ids, "other").select("record_id", "capture_id").unionByName(
        link(heads).select(F.col("other").alias("record_id"), F.col("record_id").alias("capture_id"))
    )
    direct = direct.groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    onward = direct.select(F.col("record_id").alias("other"), "capture_id")
    through = named.join(direct, "record_id", "left_anti").join(onward, "other").groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    place = direct.unionByName(through)
    fields = [c for c in records.columns if c != "concurrent_to"]
    members = others.join(place, "record_id", "left").withColumn("capture_id", F.coalesce("capture_id", "record_id"))
    of = lambda kind: F.array_sort(F.collect_list(F.when(kind, F.struct(*fields))))
    asked = F.col("record_type") == "request"
    members = members.groupBy("capture_id").agg(of(asked).alias("requests"), of(~asked).alias("metadata"))
    heads = heads.select(F.col("record_id").alias("capture_id"), F.struct(*fields).alias("response"))
    none = F.array().cast(members.schema["requests"].dataType)
    return heads.join(members, "capture_id", "full").select(
        "capture_id", "response", F.coalesce("requests", none).alias("requests"), F.coalesce("metadata", none).alias("metadata")
    )


def resolved(captures: DataFrame) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` of assembled captures.

    ``page_id`` and ``url`` come from the first metadata record. A revisit takes the number of bytes and
    ``refers_to`` from the response that holds its digest (the smallest page id, should several);
    both are null where the archives have none.
    """
    about = F.get(F.col("metadata.block"), F.lit(0)).cast("string")
    rows = captures.where("response IS NOT NULL").select(
        F.get_json_object(about, "$.page_id").cast("long").alias("page_id"), F.get_json_object(about, "$.url").alias("url"),
        "response.payload_bytes", F.col("response.payload_digest").alias("payload_digest"), F.col("response.record_type").alias("record_type"),
    )
    rows = stored(rows, "captures")
    again = F.col("record_type") == "revisit"
    wanted = rows.where(again).select("payload_digest").distinct()
    kept = rows.where(~again & F.col("page_id").isNotNull()).join(wanted, "payload_digest", "left_semi")
    kept = kept.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("payload_bytes").alias("full"))
    back = _dealt(rows.where(again), kept, "payload_digest", F.col("page_id"), F.col("url"))
    back = back.withColumn("payload_bytes", F.col("full")).drop("full")
    return rows.where(~again).withColumn("refers_to", F.lit(None).cast("long")).unionByName(back)
