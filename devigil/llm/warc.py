"""WARC archives written and read with Spark, and captures assembled from their records.

A capture is a request, a response (or a revisit of an equal earlier payload) and a metadata record;
request and metadata name the response in WARC-Concurrent-To. The archives are gzip text files whose
"lines" are records: the line separator is the two line ends that close a record. They are read as
text again, file by file in order, and cut by Content-Length, so a task holds one record at a time.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "digest string, content_type string, block_bytes bigint, payload_bytes bigint, sha1 string, "
    "fields map<string,string>, payload binary"
)


def base32(hexed):
    """A hexadecimal SHA-1 in base 32, as in WARC-Payload-Digest."""

    def four(i):
        number = F.conv(hexed.substr(i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        places = [F.shiftright(number, by).bitwiseAND(31) for by in (15, 10, 5, 0)]
        return F.concat(*[F.lit(BASE32).substr(p + 1, F.lit(1)) for p in places])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def _header(kind: str, record_id, length, *more):
    """The header of a record; a null line is left out."""
    lines = [
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z"),
        *more,
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END))


def _record(kind: str, record_id, block, *more):
    return F.concat(_header(kind, record_id, F.octet_length(block), *more), block)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write the captures of ``page_id, url, html`` rows as WARC files under ``path``.

    The payload is the html in UTF-8, empty for null. Of records with equal payloads of at least
    ``least_bytes`` bytes, the one with the smallest page_id is the response and the others revisit
    it; rows that repeat that page_id are responses too. Only digests and ids are grouped.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumns(
        {"sha1": F.sha1("html"), "bytes": F.octet_length("html")}
    )
    first = rows.groupBy("sha1", "bytes").agg(F.min("page_id").alias("first_id"))
    rows = rows.join(first, ["sha1", "bytes"]).withColumn("digest", base32(F.col("sha1")))
    names = {"response": "r", "request": "q", "metadata": "m"}
    number = F.monotonically_increasing_id().cast("string")

    def uuid(of):
        h = F.md5(of)
        parts = [h.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    # a response is found by what it holds, so that those who revisit it can name it
    held = F.concat_ws(":", "digest", "bytes", F.coalesce(F.col("page_id").cast("string"), F.lit("none")))
    is_first = (F.col("page_id").eqNullSafe(F.col("first_id"))) | (F.col("bytes") < least_bytes)
    rows = rows.withColumns({"number": number, "response": is_first})
    original = F.concat_ws(":", "digest", "bytes", F.coalesce(F.col("first_id").cast("string"), F.lit("none")))
    rows = rows.withColumns(
        {
            "main": uuid(F.concat(held, F.when(F.col("response"), "").otherwise(F.concat(F.lit(":"), "number")))),
            "original": uuid(original),
            **{k: uuid(F.concat(F.lit(v), F.lit(":"), "number")) for k, v in names.items() if k != "response"},
        }
    )
    uri = F.regexp_replace("url", r"[\r\n]+", "%0D%0A")
    target = F.concat(F.lit("WARC-Target-URI: "), uri)
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest")
    together = F.concat(F.lit("WARC-Concurrent-To: "), "main")
    http = F.lit("Content-Type: application/http; msgtype=")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(END),
    )
    response = _record("response", F.col("main"), F.concat(head, "html"), target, digest, F.concat(http, F.lit("response")))
    revisit = _record(
        "revisit", F.col("main"), head, target, digest, F.concat(http, F.lit("response")),
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.concat(F.lit("WARC-Refers-To: "), "original"),
    )
    ask = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1"), F.lit(END))
    request = _record("request", F.col("request"), ask, target, together, F.concat(http, F.lit("request")))
    about = F.concat_ws(
        "\r\n",
        F.concat(F.lit("pageId: "), F.col("page_id").cast("string")),
        F.concat(F.lit("fetchedBytes: "), F.col("bytes").cast("string")),
        F.lit(""),
    )
    metadata = _record("metadata", F.col("metadata"), about, target, together, F.lit("Content-Type: application/warc-fields"))
    each = F.explode(F.array(request, F.when(F.col("response"), response).otherwise(revisit), metadata))
    rows.select(each.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``, with the columns of ``RECORD``.

    ``payload_bytes`` and ``sha1`` (hexadecimal) are those of the HTTP body. ``fields`` are the lines of
    a metadata record. Without ``payloads`` the payload itself is null.
    """
    wanted = {
        "warc-type": "type", "warc-record-id": "record_id", "warc-concurrent-to": "concurrent_to",
        "warc-refers-to": "refers_to", "warc-target-uri": "target_uri", "warc-date": "date",
        "warc-payload-digest": "digest", "content-type": "content_type",
    }
    names = [part.split()[0] for part in RECORD.split(", ")]

    def parse(batches):
        import hashlib

        buffer, at = bytearray(), 0

        def records():
            """Whole records at the start of the buffer."""
            nonlocal at
            while True:
                head_end = buffer.find(b"\r\n\r\n", at)
                if head_end < 0:
                    return
                head = buffer[at:head_end].decode("utf-8", "replace")
                length = int(re.search(r"(?im)^content-length:\s*(\d+)", head)[1])
                begin = head_end + 4
                if len(buffer) < begin + length + 4:
                    return
                row = dict.fromkeys(names)
                for line in head.split("\r\n")[1:]:
                    key, _, value = line.partition(":")
                    if (name := wanted.get(key.strip().lower())) is not None:
                        row[name] = value.strip()
                block = bytes(buffer[begin : begin + length])
                at = begin + length + 4
                row["block_bytes"] = length
                if (row["content_type"] or "").startswith("application/http"):
                    payload = block.partition(b"\r\n\r\n")[2]
                    row["payload_bytes"], row["sha1"] = len(payload), hashlib.sha1(payload).hexdigest()
                    row["payload"] = payload if payloads else None
                elif row["type"] == "metadata":
                    pairs = [x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x]
                    row["fields"] = [(k.strip(), v.strip()) for k, _, v in pairs]
                yield row

        kinds = [pa.string()] * 8 + [pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
        for batch in batches:
            buffer += b"\n".join(batch.column(0).to_pylist()) + b"\n"
            found, size = [], 0
            for row in records():
                found.append(row)
                size += len(row["payload"] or b"")
                if len(found) >= 5000 or size >= 8 << 20:
                    yield _batch(found, names, kinds)
                    found, size = [], 0
            del buffer[:at]
            at = 0
            if found:
                yield _batch(found, names, kinds)

    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("value").cast("binary")).mapInArrow(parse, RECORD)


def _batch(rows: list[dict], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: ``capture_id, target_uri, date, refers_to, main,
    request, metadata, revisited``.

    ``request`` and ``metadata`` are the records that name the capture in WARC-Concurrent-To (the
    first by id if there are several, null if none), ``revisited`` is the size and hash of the
    response that a revisit refers to. Records that name no capture appear nowhere.
    """
    whole = F.struct(*records.columns)
    main = records.filter(F.col("type").isin("response", "revisit"))
    main = main.select(
        F.col("record_id").alias("capture_id"), "target_uri", "date", "refers_to", whole.alias("main")
    )
    of_request = F.struct("record_id", "type", "target_uri", "date", "block_bytes", "payload")
    requests = records.filter("type = 'request' and concurrent_to is not null")
    requests = requests.groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min(of_request).alias("request"))
    of_metadata = F.struct("record_id", "type", "fields", "block_bytes")
    about = records.filter("type = 'metadata' and concurrent_to is not null")
    about = about.groupBy(F.col("concurrent_to").alias("capture_id")).agg(
        F.min_by(of_metadata, "record_id").alias("metadata")
    )
    answered = records.filter("type = 'response'").groupBy(F.col("record_id").alias("refers_to")).agg(
        F.max(F.struct("payload_bytes", "sha1")).alias("revisited")
    )
    found = main.join(requests, "capture_id", "left").join(about, "capture_id", "left")
    # most records refer to nothing and stay out of the join, where they would be one key
    referring = found.filter("refers_to is not null").join(answered, "refers_to", "left")
    nothing = F.lit(None).cast(referring.schema["revisited"].dataType)
    others = found.filter("refers_to is null").withColumn("revisited", nothing)
    return referring.unionByName(others).select(
        "capture_id", "target_uri", "date", "refers_to", "main", "request", "metadata", "revisited"
    )


def digest(captures: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, intact`` of captures with a
    ``page_id``; ``refers_to`` is the page of the response, ``intact`` that the digest in the header is
    the one of the payload that was read."""
    answered = captures.filter("main.type = 'response'").groupBy(F.col("capture_id").alias("refers_to")).agg(
        F.min("page_id").alias("refers_to_page")
    )
    held = F.when(F.col("main.type") == "response", F.struct("main.payload_bytes", "main.sha1")).otherwise(
        F.col("revisited")
    )
    referring = captures.filter("refers_to is not null").join(answered, "refers_to", "left")
    others = captures.filter("refers_to is null").withColumn("refers_to_page", F.lit(None).cast("bigint"))
    rows = referring.unionByName(others).withColumn("held", held)
    found = base32(F.col("held.sha1"))
    return rows.select(
        "page_id", "held.payload_bytes", found.alias("payload_digest"), F.col("main.type").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
        (F.col("main.digest") == F.concat(F.lit("sha1:"), found)).alias("intact"),
    )


CHECK = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first_id,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (('0x' || substr(h, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT & 31) + 1, 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to, TRUE AS intact
FROM d
"""
