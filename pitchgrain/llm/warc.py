"""WARC archives: written with repeats as revisits, read back along verified record boundaries.

Writing. Of pages with equal payloads (at least ``LEAST`` bytes, compared by SHA-256) the one with the
smallest ``page_id`` becomes a response, the others revisit records that keep the HTTP header and
refer to it. Spark's text writer makes the files, so a lost task leaves nothing half written; no file
holds more than ``PER_FILE`` records.

Reading. Tasks look for the magic of a record header and emit, for each place where one can be read,
the offset of its successor. Payloads may hold that magic too, whole records even. So from the start
of each file the successors are followed by pointer jumping: each round joins the table with itself
and doubles the distance, and what is never reached is no record. A file whose chain does not end at
its last byte is an error.

Cases: a null html is an empty payload, a null url is left out, line ends in a url are written as
blanks. A null ``page_id`` is kept and never refers to others nor is referred to. Rows that repeat the
smallest ``page_id`` of their payload are all responses. An empty table gives an empty archive. Other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchgrain.llm.shared import materialise

LEAST = 0
PER_FILE = 1000
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"WARC/1.1\r\n"
# Fixed by RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = "file string, at long, next long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32(hexadecimal: Column) -> Column:
    """40 hexadecimal digits in base 32: five of them are four letters."""
    fours = [F.lpad(F.conv(F.substr(hexadecimal, F.lit(5 * i + 1), F.lit(5)), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fours), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, key, first: the pages whose payload (SHA-256 ``key``) page ``first`` has too."""
    keys = pages.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).select("page_id", F.sha2("html", 256).alias("key"))
    groups = keys.groupBy("key").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first <> last")
    return keys.join(materialise(groups.select("key", "first"), "payloads"), "key").where("page_id > first").distinct()


def write(pages: DataFrame, path: str, least: int = LEAST, per_file: int = PER_FILE) -> None:
    """One record for each row of ``pages`` (page_id, url, html)."""
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    known = materialise(revisits(read, least), "revisits").withColumnsRenamed({"page_id": "of_id", "key": "of_key"})
    rows = read.join(known, (F.col("page_id") == F.col("of_id")) & (F.sha2("html", 256) == F.col("of_key")), "left")
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    again = F.col("first").isNotNull()
    urn = lambda number: F.concat(F.lit("<urn:page:"), F.coalesce(number.cast("string"), F.lit("none")), F.lit(">"))
    rows = rows.select("*", F.sha1("html").alias("sha1"), F.concat(http, F.when(again, "").otherwise(F.col("html"))).alias("block"))
    header = F.concat(
        F.lit(MAGIC.decode() + "WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        urn(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.translate("url", "\r\n", "  ")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        base32(F.col("sha1")),
        F.when(
            again,
            F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), urn(F.col("first"))),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit("\r\n\r\n"),
    )
    # The writer's line end is the last byte of the two line ends behind a record.
    lines = rows.select(F.concat(header, F.col("block"), F.lit("\r\n\r")).alias("value"))
    lines.write.option("lineSep", "\n").option("maxRecordsPerFile", per_file).text(path)


def parsed(data: memoryview, at: int) -> dict | None:
    """The record that seems to begin at ``at``, or None if no whole one does."""
    whole = data.obj
    end = whole.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    fields = dict(x.partition(": ")[::2] for x in bytes(data[at:end]).decode("utf-8", "replace").split("\r\n")[1:])
    size = fields.get("Content-Length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        return None
    block, after = end + 4, end + 4 + int(size)
    if whole[after : after + 4] != b"\r\n\r\n":
        return None
    split = whole.find(b"\r\n\r\n", block, after)
    length = re.search(rb"(?:^|\r\n)Content-Length: ([0-9]+)", bytes(data[block : max(split, block)]))
    number = lambda urn: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?[0-9]+)>", urn)) else None
    kind = fields.get("WARC-Type")
    payload = bytes(data[split + 4 : after]) if split >= 0 else b""
    told = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    return {
        "at": at,
        "next": after + 4,
        "page_id": number(fields.get("WARC-Record-ID", "")),
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "refers_to": number(fields.get("WARC-Refers-To", "")),
        "payload_bytes": len(payload) if kind == "response" else int(length[1]) if length else None,
        "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode() if kind == "response" else told,
        "payload": payload,
    }


def candidates(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every readable record at a magic, reached or not; the end of each file as a record without type."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("file", pa.string()), ("at", pa.int64()), ("next", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string())]
            + [("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
        )
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                whole = content.as_py()
                rows = [{"file": file.as_py(), "at": len(whole), "next": None}]
                for hit in re.finditer(re.escape(MAGIC), whole):
                    record = parsed(memoryview(whole), hit.start())
                    if record:
                        rows.append(record | {"file": file.as_py()} | ({} if payloads else {"payload": None}))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(found, RECORD)


def reached(steps: DataFrame) -> DataFrame:
    """file, at of the records that successors lead to from each file's start, of ``steps`` (file, at, next)."""
    table = materialise(steps.select("file", "at", F.col("next").alias("to"), (F.col("at") == 0).alias("reached")), "jumps")
    longest = table.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(longest - 1, 0).bit_length()):
        further = table.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
        hit = table.where("reached and to is not null").select("file", F.col("to").alias("at"), F.lit(True).alias("hit"))
        doubled = table.join(further, ["file", "to"], "left").join(hit, ["file", "at"], "left")
        table = materialise(doubled.select("file", "at", F.col("beyond").alias("to"), (F.col("reached") | F.col("hit").isNotNull()).alias("reached")), "jumps")
    return table.where("reached").select("file", "at")


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The archive's records: page_id, url, record_type, refers_to, payload_bytes, payload_digest and, if
    asked for, the payload of responses."""
    found = materialise(candidates(spark, path, payloads), "candidates")
    chain = materialise(reached(found), "chain")
    records = found.join(chain, ["file", "at"])
    ended = records.where("next is null").select("file")
    broken = found.select("file").distinct().join(ended, "file", "left_anti").limit(5).collect()
    if broken:
        raise ValueError(f"no chain of records to the end of {', '.join(r[0] for r in broken)}")
    out = records.where("next is not null").drop("file", "at", "next")
    return out if payloads else out.drop("payload")


#: In DuckDB's SQL; base 32 by way of the hexadecimal digits' bits.
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, h, array_to_string(list_transform(range(1, 41), lambda i:
    substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', substr(sha1(h), i, 1)) - 3, 4)), '') AS bits FROM p),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY sha256(h)) AS first,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', 1
    + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
    + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to FROM d
"""
