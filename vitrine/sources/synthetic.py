"""Image captures and page references derived from the test tables."""

from __future__ import annotations

import datetime
import gzip
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.sources.webarchive import arrow_schema, lots

#: The same views in DuckDB's SQL, as common table expressions.
SQL = """
img as (select source as surt, 'http://' || source || '.example/' || (doc_id % 7)::varchar || '.jpg' as url,
    timestamp '2024-01-01 00:00:00' + to_seconds((doc_id * 2591) % 2592000) as ts, sha256(text) as digest,
    40 + doc_id % 400 as width, 40 + (doc_id * 7) % 400 as height, length(text)::bigint as size,
    case when doc_id % 5 = 0 then 'image/gif' else 'image/jpeg' end as mime, 'arc' || (doc_id % 3)::varchar || '.warc.gz' as warc, doc_id as warc_offset,
    sha256(lang || (n_chars % 9)::varchar) as dense from documents),
img_dense as (select * replace (dense as digest) from img),
pg as (select 'src' || (user_id % 20)::varchar as surt, 'http://host' || (user_id % 9)::varchar || '.example/' || event_type || '/' || (event_id % 11)::varchar as page_url,
    date_trunc('second', ts)::timestamp as page_ts, event_type as img_title, case when event_id % 3 = 0 then '' else 'alt ' || (event_id % 4)::varchar end as img_alt,
    'cap ' || (event_id % 6)::varchar as img_caption, 1 + event_id % 30 as images_in_page, event_id,
    event_type || ' ' || case when event_id % 3 = 0 then '' else 'alt ' || (event_id % 4)::varchar end || ' cap ' || (event_id % 6)::varchar as m from events)
"""


def captures(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    """Images of documents; dense: few digests, many captures of each."""
    t = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = F.sha2(F.concat("lang", (F.col("n_chars") % 9).cast("string")), 256) if dense else F.sha2("text", 256)
    text = lambda n: (F.col("doc_id") % n).cast("string")
    return t.select(
        F.col("source").alias("surt"), F.concat(F.lit("http://"), "source", F.lit(".example/"), text(7), F.lit(".jpg")).alias("url"),
        F.expr("timestampadd(SECOND, cast((doc_id * 2591) % 2592000 as int), timestamp_ntz'2024-01-01 00:00:00')").alias("ts"), digest.alias("digest"),
        (40 + F.col("doc_id") % 400).alias("width"), (40 + F.col("doc_id") * 7 % 400).alias("height"), F.length("text").cast("long").alias("size"),
        F.when(F.col("doc_id") % 5 == 0, "image/gif").otherwise("image/jpeg").alias("mime"), F.concat(F.lit("arc"), text(3), F.lit(".warc.gz")).alias("warc"), F.col("doc_id").alias("warc_offset"),
    )


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page references from events."""
    t = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = lambda c, n: (F.col(c) % n).cast("string")
    return t.select(
        F.concat(F.lit("src"), text("user_id", 20)).alias("surt"), F.concat(F.lit("http://host"), text("user_id", 9), F.lit(".example/"), "event_type", F.lit("/"), text("event_id", 11)).alias("page_url"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("page_ts"), F.col("event_type").alias("img_title"), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("alt "), text("event_id", 4))).alias("img_alt"),
        F.concat(F.lit("cap "), text("event_id", 6)).alias("img_caption"), (1 + F.col("event_id") % 30).alias("images_in_page"), "event_id",
    )

PAGE = "<html><head><title>Title {i}</title></head><body><div><p>Before {i}</p><img src='/i/{i}.png' alt='A {i}' title='T {i}'></div>\n<p>Far</p>\n<p>Away</p>\n<a href='big/{i}.jpg'>Link {i}</a><a href='next.html'>next</a>\n<style>p {{ background: url('/bg/{k}.gif') }}</style></body></html>"
STARTED = 1704067200  # 2024-01-01


def png(width: int, height: int, tail: bytes = b"") -> bytes:
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", width, height) + b"\x08\x02\0\0\0" + tail


def _ts(i: int) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(STARTED + i * 61 % 2592000, datetime.UTC)


def warc_record(url: str, at: datetime.datetime, mime: str, body: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {mime}\r\n\r\n".encode() + body
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nWARC-Date: {at:%Y-%m-%dT%H:%M:%SZ}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def arc_record(url: str, at: datetime.datetime, mime: str, body: bytes) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {mime}\r\n\r\n".encode() + body
    return f"{url} 127.0.0.1 {at:%Y%m%d%H%M%S} {mime} {len(http)}\n".encode() + http + b"\n"


def warc_of(i: int, html: str) -> bytes:
    """A page as it is, a page with images (captured twice), its image, and an image as a resource; every member is compressed by itself."""
    site, at = f"http://h{i % 9}.example", _ts(i)
    resource = png(40 + i % 30, 60, b"r%d" % i)
    parts = [warc_record(f"{site}/raw/{i}", at, "text/html", html.encode())]
    parts += [warc_record(f"{site}/p/{i}", t, "text/html", PAGE.format(i=i, k=i % 5).encode()) for t in (at, at + datetime.timedelta(hours=1))]
    parts.append(warc_record(f"{site}/i/{i}.png", at, "image/png" if i % 4 else "image/gif", png(51 + i % 40, 51 + i % 7, b"%d" % (i % 50))))
    parts.append(f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: {site}/r/{i}.png\r\nWARC-Date: {at:%Y-%m-%dT%H:%M:%SZ}\r\nContent-Type: image/png\r\nContent-Length: {len(resource)}\r\n\r\n".encode() + resource + b"\r\n\r\n")
    return b"".join(gzip.compress(p, 1) for p in parts)


def arc_of(i: int, html: str) -> bytes:
    """A page, and for every tenth one a record whose line lacks a field before it."""
    site, at = f"http://h{i % 9}.example", _ts(i)
    broken = b"x y 3\nabc\n" if i % 10 == 0 else b""
    return broken + arc_record(f"{site}/raw/{i}", at, "text/html", html.encode())


def archives(spark: SparkSession, sf_dir: str, kind: str = "warc") -> DataFrame:
    """(name, content): an archive for each page; WARC archives of the last third of every 30 pages have junk at their end."""
    made, schema = warc_of if kind == "warc" else arc_of, "name string, content binary"

    def one(i: int, html: str) -> tuple[str, bytes]:
        return f"a{i}.{kind}.gz" if kind == "warc" else f"a{i}.arc", made(i, html) + (b"junk" if kind == "warc" and i % 30 >= 20 else b"")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from lots((one(i.as_py(), h.as_py()) for part in parts for i, h in zip(part["page_id"], part["html"])), arrow_schema(schema))

    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").mapInArrow(run, schema)
