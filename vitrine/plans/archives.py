"""From archives to the index."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.text import fix_mojibake
from vitrine.functions.time import parse_ts14
from vitrine.functions.url import host, image_filename, protocol, to_surt, too_long, url_tokens, with_scheme
from vitrine.operators.groups import LEAST_SIDE, MOST_AREA
from vitrine.operators.html_refs import MOST_IMAGES, html_references, page_references
from vitrine.operators.image_probe import inline_bytes, probe_one, probed
from vitrine.plans.index import index
from vitrine.sources.webarchive import FAILED, FAILED_ARCHIVE, FAILED_DOWNLOAD, LOT_BYTES, LOT_ROWS, archive_list, arrow_batch, arrow_schema, html_records, image_records, is_html, is_image, read_archives, read_listed


def page_text(payload: Column) -> Column:
    """Text of a page: by its byte order mark, as UTF-8 if it is valid, by the charset that its head names, else Latin-1."""
    raw = F.decode(payload, "ISO-8859-1")
    named = F.upper(F.regexp_extract(F.substring(raw, 1, 4096), r"(?i)<meta[^>]*charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", 1))
    other = F.when(named.isin("ISO-8859-15", "WINDOWS-1252", "CP1252", "LATIN-1", "ISO-8859-1"), raw).when(named == "UTF-16", F.decode(payload, "UTF-16"))
    start = F.hex(F.substring(payload, 1, 3))
    text = F.when(start == "EFBBBF", F.try_validate_utf8(F.expr("substring(payload, 4)").cast("string"))).when(start.startswith("FFFE") | start.startswith("FEFF"), F.decode(payload, "UTF-16"))
    return F.coalesce(text, F.try_validate_utf8(payload.cast("string")), other, raw)


def pages_of(records: DataFrame) -> DataFrame:
    """HTML records with page_url, page_ts, html and where they are from; repaired tells that doubly encoded text was mended."""
    text = html_records(records).withColumn("raw_html", page_text(F.col("payload")))
    out = text.withColumn("html", fix_mojibake(F.col("raw_html"))).withColumn("page_ts", parse_ts14(F.col("ts14"))).filter("page_ts is not null")
    return out.select(with_scheme(F.col("target_url")).alias("page_url"), "page_ts", "html", F.col("archive_name").alias("warc"), F.col("offset").alias("warc_offset"), (F.col("html") != F.col("raw_html")).alias("repaired"))


def references_of(pages: DataFrame) -> DataFrame:
    """References of pages, each with the capture of the page that it was found in."""
    found = html_references(pages, ("page_ts", "warc", "warc_offset")).filter(~too_long(F.col("page_url")))
    named = {"surt": to_surt(F.col("img_url")), "event_id": F.xxhash64("page_url", "img_url", "page_ts", "warc", "warc_offset"), "img_filename": image_filename(F.col("img_url")), "img_url_tokens": url_tokens(F.col("img_url")), "page_host": host(F.col("page_url")), "page_protocol": protocol(F.col("page_url"))}
    return found.withColumns(named)


def captures_of(records: DataFrame, refs: DataFrame) -> DataFrame:
    """Stored and inline images with type, sides (null if they can't be read), digest and bytes."""
    where = ("warc", "warc_offset")
    inline = refs.filter("is_inline").select(F.col("img_url").alias("url"), F.col("page_ts").alias("ts"), F.lit(None).cast("string").alias("mime"), F.lit(None).cast("binary").alias("payload"), *where, "inline_data")
    stored = image_records(records).select(F.col("target_url").alias("url"), parse_ts14(F.col("ts14")).alias("ts"), "mime", "payload", F.col("archive_name").alias("warc"), F.col("offset").alias("warc_offset"), F.lit(None).cast("string").alias("inline_data"))
    images = probed(stored.unionByName(inline).filter("ts is not null"), inline="inline_data")
    return images.withColumns({"surt": to_surt(F.col("url")), "image_url_hash": F.md5("url"), "mime_reported": F.col("mime"), "mime": F.coalesce(F.nullif("mime_detected", F.lit("")), "mime")}).withColumnRenamed("payload", "bytes")


def extract(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures and references, with the columns that the index takes."""
    refs = references_of(pages_of(records))
    return captures_of(records, refs).filter("width is not null"), refs.drop("inline_data")


FACTS = "kind string, archive_name string, record_type string, stored boolean, page boolean, repaired boolean, page_url string, page_ts timestamp_ntz, warc_offset long, found int, images_in_page int, url string, img_title string, img_alt string, img_caption string, tag string, is_inline boolean, mime_reported string, mime_detected string, width int, height int, digest string"


def _facts(records: DataFrame) -> DataFrame:
    """What the counters count, in one reading of the records: a row for each record, page with references, reference and image."""
    schema = arrow_schema(FACTS)
    names = schema.names

    def of_one(r: dict) -> Iterator[dict]:
        name = r["archive_name"]
        yield {"kind": "record", "archive_name": name, "record_type": r["record_type"], "stored": r["stored"], "page": r["page"], "repaired": r["repaired"]}

        def image(url: str, mime: str | None, data: bytes) -> dict:
            return {"kind": "image", "archive_name": name, "url": url, "mime_reported": mime} | dict(zip(("mime_detected", "width", "height"), probe_one(data, mime))) | {"digest": hashlib.sha256(data).hexdigest()}

        if r["image"] is not None:
            yield image(r["target_url"], r["mime"], r["image"])
        found = page_references(r["html"], r["page_url"]) if r["html"] is not None and r["page_url"] is not None else []
        for _, _, _, url, title, alt, caption, tag, is_inline, data in found:
            yield {"kind": "reference", "archive_name": name, "url": url, "img_title": title, "img_alt": alt, "img_caption": caption, "tag": tag, "is_inline": is_inline}
            if is_inline:
                yield image(url, *inline_bytes(data))
        if found:
            yield {"kind": "page", "archive_name": name, "page_url": found[0][0], "page_ts": r["page_ts"], "warc_offset": r["offset"], "found": len(found), "images_in_page": found[0][2]}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts:
            for i in range(part.num_rows):
                r = {n: part[n][i].as_py() for n in part.schema.names}
                held += [tuple(map(x.get, names)) for x in of_one(r)]
                size += len(r["image"] or b"") + len(r["html"] or "")
                if len(held) >= LOT_ROWS or size >= LOT_BYTES:
                    yield arrow_batch(held, schema)
                    held, size = [], 0
        if held:
            yield arrow_batch(held, schema)

    page_ts = parse_ts14(F.col("ts14"))
    one = records.select("archive_name", "offset", "record_type", "target_url", "mime", page_ts.alias("page_ts"), F.coalesce(is_image(), F.lit(False)).alias("stored"), F.coalesce(is_html() & page_ts.isNotNull(), F.lit(False)).alias("page"), F.col("payload").alias("body"))
    one = one.withColumns({"image": F.when(F.col("stored") & F.col("page_ts").isNotNull(), F.col("body")), "payload": F.when(F.col("page"), F.col("body"))}).withColumn("raw_html", page_text(F.col("payload")))
    one = one.withColumn("html", fix_mojibake(F.col("raw_html"))).withColumn("repaired", F.col("html") != F.col("raw_html")).withColumn("page_url", with_scheme(F.col("target_url")))
    return one.drop("body", "payload", "raw_html").mapInArrow(run, FACTS)


def extraction_counters(records: DataFrame) -> DataFrame:
    """The counters of the extraction (counter, value): what was read, found, kept, and lost on the way. The records are read once."""
    facts = _facts(records)
    kind, of, tag = F.col("record_type"), F.col("kind"), F.col("tag")
    w, h = F.col("width").cast("long"), F.col("height").cast("long")
    small, inline = (w < LEAST_SIDE) | (h < LEAST_SIDE), F.col("url").startswith("hash:")
    good = w.isNotNull() & ~small & (w * h <= MOST_AREA)
    rows = {
        "record": {
            "WARCS_DOWNLOAD_ERROR": kind == FAILED_DOWNLOAD, "WARCS_FAILED_STREAM": kind == FAILED_ARCHIVE, "RECORDS_READ": ~kind.isin(FAILED, FAILED_ARCHIVE, FAILED_DOWNLOAD), "RECORDS_FAILED": kind == FAILED,
            "IMAGES_IN_WARC_TOTAL": F.col("stored"), "PAGES": F.col("page"), "PAGE_UTF8_MISMATCH_DOUBLE": F.col("repaired"),
        },
        "image": {
            "IMAGES_IN_WARC_FAILED": w.isNull(), "IMAGES_IN_WARC_TOO_SMALL_BASE64": small & inline, "IMAGES_IN_WARC_TOO_SMALL": small & ~inline, "IMAGES_IN_WARC_TOO_LARGE": ~small & (w * h > MOST_AREA),
            "IMAGES_IN_WARC_MIME_INVALID": F.col("mime_detected") == "", "IMAGES_IN_WARC_MIME_WRONG": (F.col("mime_detected") != "") & (F.col("mime_detected") != F.coalesce("mime_reported", F.lit(""))), "IMAGES_IN_WARC_PARSED_DUP": good,
        },
        "reference": {"IMAGES_IN_HTML_MATCHING": F.lit(True), "IMAGES_IN_HTML_MATCHING_LINK": tag == "a", "IMAGES_IN_HTML_MATCHING_CSS": tag == "css", "IMAGES_IN_HTML_BASE64": F.col("is_inline"), "IMAGES_IN_HTML_SENT_DUP": F.lit(True)},
    }
    count = {name: F.count_if((of == k) & c) for k, names in rows.items() for name, c in names.items()}
    surt = F.when(of.isin("image", "reference"), to_surt(F.col("url")))
    # groups of all kinds in one shuffle, in place of a distinct count for each: archives, fit images, texts of references, pages
    group = ["group", "archive_name", "surt", "digest", "img_title", "img_alt", "img_caption", "page_url", "page_ts", "warc_offset"]
    fit = F.when((of == "image") & ~F.coalesce(good, F.lit(False)), "unfit").otherwise(of)
    keyed = facts.withColumns({"group": fit, "surt": surt}).withColumn("digest", F.when(F.col("group") == "image", F.col("digest"))).withColumn("surt", F.when(F.col("group") != "unfit", F.col("surt")))
    groups = keyed.groupBy(*group).agg(*[c.alias(name) for name, c in count.items()], F.max("images_in_page").cast("long").alias("n"))
    of, n = F.col("group"), F.when(F.col("group") == "page", F.col("n"))
    out = {name: F.sum(name) for name in count} | {
        "WARCS": F.count_if((of == "record") & F.col("archive_name").isNotNull()), "IMAGES_IN_WARC_PARSED": F.count_if(of == "image"), "IMAGES_IN_HTML_SENT": F.count_if(of == "reference"), "PAGES_WITH_IMAGES": F.count_if(of == "page"),
        "IMAGES_IN_HTML_TOTAL": F.sum(n), "IMAGES_IN_HTML_EXCEDED": F.count_if(n > MOST_IMAGES), "IMAGES_IN_HTML_NOT_PARSED": F.sum(F.greatest(n - MOST_IMAGES, F.lit(0))),
    }
    return groups.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in out.items()]).unpivot([], list(out), "counter", "value")


def index_archives(spark: SparkSession, path: str, mode: str = "COMPACT") -> DataFrame:
    """Lines of the index over the archives under a folder."""
    return index(*extract(read_archives(spark, path)), mode)


def index_listed(spark: SparkSession, path: str, mode: str = "COMPACT", per_task: int = 1) -> DataFrame:
    """Lines of the index over the archives that a text file names, by path or URL."""
    return index(*extract(read_listed(archive_list(spark, path, per_task))), mode)


def main(argv: list[str]) -> None:
    """LIST_OR_FOLDER OUTPUT [MODE]: writes the lines as text, in place of what OUTPUT held."""
    spark = SparkSession.builder.appName("vitrine").getOrCreate()
    lines = index_listed if argv[0].endswith(".txt") else index_archives
    lines(spark, argv[0], *argv[2:3]).write.mode("overwrite").text(argv[1])


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
