"""The image index: references matched to captures within each SURT, split by digest, merged over SURTs, matched again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.ids import image_id, reference_id
from vitrine.functions.time import iso_text
from vitrine.operators import groups
from vitrine.operators.asof import nearest

MODES = ("FULL", "COMPACT")


@dataclass
class Index:
    """The stages, each a lazy DataFrame."""

    surt_images: DataFrame
    surt_refs: DataFrame
    surt_stats: DataFrame
    matched: DataFrame
    split: DataFrame
    digest_images: DataFrame
    digest_refs: DataFrame
    digest_stats: DataFrame


def build(images: DataFrame, refs: DataFrame, nearest_by_duration: bool = False) -> Index:
    images = groups.size_window(images)
    refs = groups.with_metadata(refs)
    surt_images = groups.distinct_images(images)
    stats = groups.group_statistics(images, refs)
    surt_refs = groups.distinct_references(refs).join(stats.select("surt"), "surt", "left_semi")
    times = surt_images.select("surt", F.explode("timestamps").alias("ts"))
    matched = nearest(surt_refs, times, "surt", nearest_by_duration)
    captured = surt_images.select("surt", "digest", F.explode("timestamps").alias("matched"))
    split = matched.drop("before", "after").join(captured, ["surt", "matched"]).join(stats.select("surt", "oldest_date", "matching_images", "matching_pages", "image_metadata_changes", "page_metadata_changes"), "surt")
    both = images.join(stats.select("surt"), "surt", "left_semi")
    digest_images = groups.distinct_images(both, "digest")
    parts = split.drop("matched")
    canonical = F.struct("page_url", "page_ts", "images_in_page", "tokens", *[c for c in groups.REF_EXTRAS if c in refs.columns])
    order = F.struct("page_ts", F.length("page_url"), F.col("page_url"))
    merged = parts.groupBy("digest", "m").agg(F.min_by(canonical, order).alias("p"), F.min_by(F.struct("img_title", "img_alt", "img_caption"), order).alias("i"), F.max("newest_ts").alias("newest_ts"), F.sum("references").alias("references"))
    merged = merged.select("digest", "m", "p.*", "i.*", "newest_ts", "references")
    digest_refs = nearest(merged, digest_images.select("digest", F.explode("timestamps").alias("ts")), "digest", nearest_by_duration)
    return Index(surt_images, surt_refs, stats, matched, split, digest_images, digest_refs, _digest_stats(surt_images, split, stats))


def _digest_stats(surt_images: DataFrame, split: DataFrame, stats: DataFrame) -> DataFrame:
    """Per digest: sums over its SURTs; its oldest SURT; changes, counted on from those of its first state."""
    states = surt_images.select("surt", "digest").join(stats, "surt")
    first = Window.partitionBy("digest").orderBy("oldest_date", "surt")
    sums = states.groupBy("digest").agg(
        F.sum("matching_images").alias("matching_images"), F.sum("matching_pages").alias("matching_pages"), F.min_by("surt", F.struct("oldest_date", -F.length("surt"), "surt")).alias("oldest_surt"), F.min("oldest_date").alias("oldest_surt_date"),
        F.min_by(F.struct("surt", "image_metadata_changes", "page_metadata_changes"), F.struct("oldest_date", "surt")).alias("first"),
    )
    rows = split.withColumn("first_surt", F.first("surt").over(first))
    arrivals = Window.partitionBy("digest", "m").orderBy("oldest_date", "surt").rowsBetween(Window.unboundedPreceding, -1)
    held = F.min_by("tokens", F.struct("page_ts", F.length("page_url"), "oldest_date", "surt")).over(arrivals)
    rows = rows.withColumn("held", held)
    changes = rows.groupBy("digest").agg(F.count_distinct("m").alias("all_m"), F.count_distinct(F.when(F.col("surt") == F.col("first_surt"), F.col("m"))).alias("first_m"), F.count_if(F.col("held").isNotNull() & (F.col("tokens") != F.col("held"))).alias("page_changes"))
    # the first state may have no reference of its own among the split rows; then nothing is subtracted for it
    starts = sums.select("digest", F.col("first.surt").alias("start"))
    own = split.join(starts, (split["digest"] == starts["digest"]) & (split["surt"] == starts["start"])).groupBy(split["digest"]).agg(F.count_distinct("m").alias("own_m"))
    # nor has every digest a reference that chose one of its captures; its images count all the same
    out = sums.join(changes, "digest", "left").join(own, "digest", "left").fillna(0, ["all_m", "own_m", "page_changes"])
    return out.select("digest", "matching_images", "matching_pages", "oldest_surt", "oldest_surt_date", (F.col("first.image_metadata_changes") + F.col("all_m") - F.col("own_m")).alias("image_metadata_changes"), (F.col("first.page_metadata_changes") + F.col("page_changes")).alias("page_metadata_changes"))


def compact(ix: Index) -> DataFrame:
    """One row per image that a page refers to: the image, its representative page and all texts."""
    page = groups.representative_page(ix.digest_refs, "digest")
    lists = groups.ordered_lists(ix.digest_refs, "digest")
    image = ix.digest_images.select("digest", "url", "first_ts", "last_ts", "mime", "width", "height", "size", "warc", "warc_offset", F.size("timestamps").cast("long").alias("n_timestamps"))
    return image.join(page, "digest").join(lists, "digest").join(ix.digest_stats, "digest")


def compact_json(docs: DataFrame) -> DataFrame:
    """Two JSON lines per row of compact: image and page."""
    listed = lambda c: F.when(F.size(c) > 0, F.col(c))
    image = F.to_json(F.struct(F.col("digest").alias("imgDigest"), F.lit("image").alias("type"), image_id(F.col("first_ts"), F.col("url")).alias("id"), F.col("oldest_surt").alias("oldestSurt"), F.md5("url").alias("imgSrcURLDigest"), F.col("url").alias("imgSrc"), F.col("mime").alias("imgMimeType"), F.col("width").alias("imgWidth"), F.col("height").alias("imgHeight"), "size", F.lit(0).alias("safe"), F.lit(0).alias("spam"), F.lit(0).alias("blocked"), F.col("warc").alias("warcName"), F.col("warc_offset").alias("warcOffset")))
    page = F.to_json(F.struct(F.lit("page").alias("type"), F.col("digest").alias("id"), listed("img_titles").alias("imgTitle"), listed("img_alts").alias("imgAlt"), listed("img_captions").alias("imgCaption"), F.col("url").alias("imgUrl"), iso_text(F.col("last_ts")).alias("imgCrawlTimestampLatest"), iso_text(F.col("first_ts")).alias("imgCrawlTimestamp"), iso_text(F.col("page_ts")).alias("pageCrawlTimestamp"), F.col("page_url").alias("pageUrl"), F.col("images_in_page").alias("imagesInOriginalPage"), F.col("image_metadata_changes").alias("imageMetadataChanges"), F.col("page_metadata_changes").alias("pageMetadataChanges"), F.col("matching_images").alias("matchingImages"), F.col("matching_pages").alias("matchingPages"), F.lit(0).alias("safe"), F.lit(0).alias("spam"), F.lit(0).alias("blocked")))
    return docs.select("digest", F.explode(F.array(image, page)).alias("value"))


def full_lines(ix: Index) -> DataFrame:
    """All images and all references as rows of one table: digest, kind and id."""
    images = ix.digest_images.select("digest", F.lit("image").alias("kind"), image_id(F.col("first_ts"), F.col("url")).alias("id"))
    pages = ix.digest_refs.select("digest", F.lit("page").alias("kind"), reference_id(F.col("page_ts"), F.col("page_url"), F.col("m"), F.col("digest")).alias("id"))
    return images.unionByName(pages)


def matched_references(ix: Index) -> DataFrame:
    """References of digests with the image they match: its time, span, sides, type, id and place, and what is known of its group."""
    i = ix.digest_images
    image = i.select("digest", "timespan", "width", "height", "mime", image_id(F.col("first_ts"), F.col("url")).alias("image_id"), F.col("url").alias("image_url"), F.col("warc").alias("image_warc"), F.col("warc_offset").alias("image_warc_offset"))
    unique = ix.surt_stats.select(F.col("surt").alias("oldest_surt"), "unique_digests")
    return ix.digest_refs.join(image, "digest").join(ix.digest_stats, "digest").join(unique, "oldest_surt", "left")


def _or_null(df: DataFrame, name: str, kind: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def full_json(ix: Index) -> DataFrame:
    """JSON lines (digest, value) with all fields of images and of references; fields without a value are left out."""
    i = ix.digest_images.join(ix.digest_stats.select("digest", "oldest_surt"), "digest", "left")
    zero = [F.lit(0).alias(c) for c in ("safe", "spam", "blocked")]
    picture = _or_null(i, "bytes", "binary")
    image = F.to_json(F.struct(
        F.col("digest").alias("imgDigest"), F.lit("image").alias("type"), image_id(F.col("first_ts"), F.col("url")).alias("id"), F.col("oldest_surt").alias("oldestSurt"), F.md5("url").alias("imgSrcURLDigest"), F.transform("timestamps", iso_text).alias("imgTstamps"),
        F.col("timespan").alias("imgTimespan"), F.col("url").alias("imgSrc"), _or_null(i, "surt").alias("imgSurt"), _or_null(i, "mime_reported").alias("imgMimeTypeReported"), F.col("mime").alias("imgMimeType"), F.base64(picture).alias("imgSrcBase64"),
        _or_null(i, "collection").alias("collection"), F.col("width").alias("imgWidth"), F.col("height").alias("imgHeight"), "size", *zero, F.col("warc").alias("warcName"), F.col("warc_offset").alias("warcOffset"),
    ))
    r = matched_references(ix)
    page = F.to_json(F.struct(
        F.lit("page").alias("type"), _or_null(r, "collection").alias("collection"), _or_null(r, "warc").alias("warc"), _or_null(r, "warc_offset", "long").alias("warcOffset"), F.col("img_title").alias("imgTitle"), F.col("img_alt").alias("imgAlt"), _or_null(r, "img_filename").alias("imgFilename"),
        F.col("img_caption").alias("imgCaption"), iso_text(F.col("matched")).alias("imgTimestamp"), F.col("timespan").alias("imgTimespan"), _or_null(r, "page_title").alias("pageTitle"), F.col("tokens").alias("pageURLTokens"), F.col("image_id").alias("imgId"), _or_null(r, "img_url").alias("imgURL"), _or_null(r, "img_url_tokens").alias("imgURLTokens"),
        F.col("height").alias("imgHeight"), F.col("width").alias("imgWidth"), F.col("mime").alias("imgMimeType"), F.col("image_warc").alias("imgWarc"), F.col("image_warc_offset").alias("imgWarcOffset"), iso_text(F.col("page_ts")).alias("pageTimestamp"), iso_text(F.col("newest_ts")).alias("pageTimestampNewest"),
        F.col("page_url").alias("pageURL"), _or_null(r, "page_host").alias("pageHost"), _or_null(r, "page_protocol").alias("pageProtocol"), F.col("matching_images").alias("matchingImages"), F.col("matching_pages").alias("matchingPages"), F.col("image_metadata_changes").alias("imageMetadataChanges"), F.col("page_metadata_changes").alias("pageMetadataChanges"),
        F.col("images_in_page").alias("imagesInPage"), F.col("unique_digests").alias("uniqueDigestsOnURL"), _or_null(r, "is_inline", "boolean").alias("inline"), F.col("digest").alias("imageDigest"), F.col("oldest_surt").alias("oldestSurt"), iso_text(F.col("oldest_surt_date")).alias("oldestSurtDate"),
    ))
    return i.select("digest", image.alias("value")).unionByName(r.select("digest", page.alias("value")))


def merge_counters(ix: Index) -> DataFrame:
    """The counters of the merge by digest (counter, value): states in, digests out, with and without metadata, and what they hold."""
    states = ix.surt_images.join(ix.surt_stats.select("surt"), "surt", "left_semi").select("surt", "digest").agg(F.count(F.lit(1)).cast("long").alias("RECORDS_IN"))
    held = ix.digest_images.select("digest", F.lit(1).alias("one")).join(ix.digest_refs.groupBy("digest").agg(F.count(F.lit(1)).alias("refs")), "digest", "left").join(groups.has_metadata(ix.digest_refs, "digest"), "digest", "left")
    some = F.coalesce("has_metadata", F.lit(False))
    names = {"RECORDS_OUT": F.count(F.lit(1)), "RECORDS_WITH_METADATA": F.count_if(some), "RECORDS_WITHOUT_METADATA": F.count_if(~some), "URL_IMAGES_PAGESALL": F.coalesce(F.sum("refs"), F.lit(0)), "URL_IMAGESALL_PAGES": F.count(F.lit(1)), "URL_IMAGES_PAGES": F.count(F.lit(1))}
    out = held.agg(*[c.cast("long").alias(k) for k, c in names.items()]).unpivot([], list(names), "counter", "value")
    return states.withColumn("RECORDS_MAP_IN", F.col("RECORDS_IN")).unpivot([], ["RECORDS_MAP_IN", "RECORDS_IN"], "counter", "value").union(out)


def index(images: DataFrame, refs: DataFrame, mode: str = "COMPACT") -> DataFrame:
    """JSON lines of the index in either mode."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    ix = build(images, refs)
    if mode == "COMPACT":
        return compact_json(compact(ix)).select("value")
    return full_json(ix).select("value")


def counters(images: DataFrame, refs: DataFrame) -> DataFrame:
    """The counters of the reduce steps, one row per name: SURTs by the sides they have, and what they hold."""
    sized = groups.size_window(images)
    i = sized.groupBy("surt").agg(F.count(F.lit(1)).alias("n_img"), F.count_distinct("digest").alias("n_digests"))
    r = refs.groupBy("surt").agg(F.count(F.lit(1)).alias("n_ref"))
    g = i.join(r, "surt", "full").fillna(0, ["n_img", "n_digests", "n_ref"])
    both, only_i, only_r = (F.col("n_img") > 0) & (F.col("n_ref") > 0), F.col("n_ref") == 0, F.col("n_img") == 0
    total = lambda c, v: F.coalesce(F.sum(F.when(c, v)), F.lit(0))
    names = {
        "URL_IMAGES_PAGES": F.count_if(both), "URL_IMAGESALL_PAGES": total(both, F.col("n_img")), "URL_IMAGES_PAGESALL": total(both, F.col("n_ref")), "URL_IMAGES_PAGES_DIGESTALL": total(both, F.col("n_digests")), "URL_IMAGES_PAGES_MULTIPLE_DIGEST": F.count_if(both & (F.col("n_digests") > 1)),
        "URL_IMAGES_NPAGES": F.count_if(only_i), "URL_IMAGESALL_NPAGES": total(only_i, F.col("n_img")), "URL_NIMAGES_PAGES": F.count_if(only_r), "URL_NIMAGES_PAGESALL": total(only_r, F.col("n_ref")),
    }
    one = g.agg(*[v.cast("long").alias(k) for k, v in names.items()])
    return one.unpivot([], list(names), "counter", "value")
