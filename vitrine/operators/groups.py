"""Aggregates over images and references of a key (a SURT, later a digest). All are free of arrival order.

Column names: images have surt, url, ts, digest, mime, width, height, size, warc, warc_offset; references have surt,
page_url, page_ts, img_title, img_alt, img_caption, images_in_page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.text import image_metadata
from vitrine.functions.time import span_seconds
from vitrine.functions.url import decoded_url_tokens

IMAGE_CAP, LEAST_SIDE, MOST_AREA = 500, 51, 15_000 * 15_000
#: Columns that travel with an image or a reference if they are there.
IMAGE_EXTRAS = ("surt", "mime_reported", "image_url_hash", "collection", "bytes")
REF_EXTRAS = ("img_filename", "img_url", "img_url_tokens", "is_inline", "page_title", "page_host", "page_protocol", "collection", "warc", "warc_offset")


def size_window(images: DataFrame) -> DataFrame:
    """Images of at least 51 pixels each way and no more than the largest area."""
    w, h = F.col("width").cast("long"), F.col("height").cast("long")
    return images.filter((w >= LEAST_SIDE) & (h >= LEAST_SIDE) & (w * h <= MOST_AREA))


def with_metadata(refs: DataFrame) -> DataFrame:
    return refs.withColumn("m", image_metadata(F.col("img_title"), F.col("img_alt"), F.col("img_caption"))).withColumn("tokens", decoded_url_tokens(F.col("page_url")))


def capture_order() -> Column:
    return F.struct("ts", F.length("url"), F.md5("url"))


def page_order() -> Column:
    return F.struct("page_ts", F.length("page_url"), F.col("page_url"))


def distinct_images(images: DataFrame, key: str = "surt") -> DataFrame:
    """One row per key and digest: the canonical capture (earliest, shorter URL, smaller md5), all capture times, count."""
    picked = F.struct("url", "ts", "mime", "width", "height", "size", "warc", "warc_offset", *[c for c in IMAGE_EXTRAS if c in images.columns and c != key])
    got = images.groupBy(key, "digest").agg(F.min_by(picked, capture_order()).alias("c"), F.array_sort(F.collect_set("ts")).alias("timestamps"), F.count(F.lit(1)).alias("captures"))
    out = got.select(key, "digest", "c.*", "timestamps", "captures").withColumnRenamed("ts", "first_ts")
    return out.withColumn("last_ts", F.element_at("timestamps", -1)).withColumn("timespan", span_seconds(F.col("first_ts"), F.col("last_ts")))


def distinct_references(refs: DataFrame, key: str = "surt") -> DataFrame:
    """One row per key and metadata: the canonical page (earliest, shorter URL), newest time, count."""
    picked = F.struct("page_url", "page_ts", "images_in_page", "tokens", *[c for c in REF_EXTRAS if c in refs.columns])
    got = refs.groupBy(key, "m").agg(F.min_by(picked, page_order()).alias("p"), F.min_by(F.struct("img_title", "img_alt", "img_caption"), page_order()).alias("i"), F.max("page_ts").alias("newest_ts"), F.count(F.lit(1)).alias("references"))
    return got.select(key, "m", "p.*", "i.*", "newest_ts", "references").withColumn("page_timespan", span_seconds(F.col("page_ts"), F.col("newest_ts")))


def page_metadata_changes(refs: DataFrame, key: str = "surt") -> DataFrame:
    """1 and the references whose page tokens differ from the ones held, those of the canonical page; counted by tokens, without sorting references."""
    by_tokens = refs.groupBy(key, "m", "tokens").agg(F.count(F.lit(1)).alias("n"), F.count("tokens").alias("k"), F.min(page_order()).alias("first"))
    each = by_tokens.groupBy(key, "m").agg(F.sum("k").alias("k"), F.min_by(F.struct("tokens", "k"), "first").alias("held"))
    return each.groupBy(key).agg((F.lit(1) + F.sum(F.when(F.col("held.tokens").isNull(), 0).otherwise(F.col("k") - F.col("held.k")))).alias("page_metadata_changes"))


def has_metadata(refs: DataFrame, key: str) -> DataFrame:
    """Whether any reference of the key has metadata of the image or of the page."""
    text = (F.coalesce("m", F.lit("")) != "") | (F.coalesce("tokens", F.lit("")) != "")
    return refs.groupBy(key).agg(F.bool_or(text).alias("has_metadata"))


def oldest_surt(rows: DataFrame, by: str) -> DataFrame:
    """The SURT that began first; of two, the longer one, then the smaller."""
    return rows.groupBy(by).agg(F.min_by("surt", F.struct("oldest_date", -F.length("surt"), "surt")).alias("oldest_surt"), F.min("oldest_date").alias("oldest_surt_date"))


def group_statistics(images: DataFrame, refs: DataFrame) -> DataFrame:
    """Per SURT with both sides: counts of captures, references, digests and metadata."""
    i = images.groupBy("surt").agg(F.count(F.lit(1)).alias("matching_images"), F.count_distinct("digest").alias("unique_digests"), F.min("ts").alias("oldest_date"))
    r = refs.groupBy("surt").agg(F.count(F.lit(1)).alias("matching_pages"), F.count_distinct("m").alias("image_metadata_changes"))
    return i.join(r, "surt").join(page_metadata_changes(refs), "surt")


def cap(rows: DataFrame, key: str, order: list, most: int = IMAGE_CAP) -> DataFrame:
    """The first `most` rows of each key, in a fixed order."""
    return rows.withColumn("cap_row", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("cap_row") <= most).drop("cap_row")


def ordered_lists(refs: DataFrame, key: str) -> DataFrame:
    """Titles, alternative texts and captions in order of metadata, without blanks, repeats kept."""
    lists = [F.filter(_column(c), lambda v: v != "").alias(f"{c}s") for c in ("img_title", "img_alt", "img_caption")]
    return refs.groupBy(key).agg(*lists)


def _column(name: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("m", name))), lambda x: x[name])


def representative_page(refs: DataFrame, key: str) -> DataFrame:
    """The page of the smallest metadata text."""
    return refs.groupBy(key).agg(F.min_by(F.struct("page_url", "page_ts", "images_in_page"), F.struct("m", page_order())).alias("p")).select(key, "p.*")


def one_sided(left: DataFrame, right: DataFrame, key: str = "surt") -> DataFrame:
    """Rows of left whose key right doesn't have."""
    return left.join(right.select(key).distinct(), key, "left_anti")
