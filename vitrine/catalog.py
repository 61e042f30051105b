"""The library's queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import ids, text, time, url
from vitrine.operators import groups
from vitrine.operators.asof import nearest
from vitrine.operators.html_refs import html_references
from vitrine.operators.image_probe import probed
from vitrine.plans import archives as extraction
from vitrine.plans import index
from vitrine.sources.synthetic import PAGE, SQL, archives, captures, references
from vitrine.sources.webarchive import read_contents

QUERIES: dict = {}
ORACLE: dict = {}
_WITH = f"with {SQL}"
_MD5 = "row(ts, length(url), md5(url))"
_SIZED = "width >= 51 and height >= 51 and width * height <= 225000000"
_TOKENS = r"trim(regexp_replace(page_url, '[[:punct:]\x08]+', ' ', 'g'))"
_T = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = oracle
        return f

    return add


def _pages(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet")


def _dense(spark, d):
    return groups.size_window(captures(spark, d, dense=True))


def _refs(spark, d):
    return groups.with_metadata(references(spark, d))


def _text(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


@_query(r"select page_id, regexp_replace(regexp_replace(url, '[[:punct:]\x08]+$', ''), '[[:punct:]\x08]+', ' ', 'g') as tokens from pages")
def tokens_page_url(spark, d):
    return _pages(spark, d).select("page_id", url.url_tokens(F.col("url")).alias("tokens"))


@_query(r"select page_id, regexp_replace(regexp_replace(url_decode(replace(url, '+', ' ')), '[[:punct:]\x08]+$', ''), '[[:punct:]\x08]+', ' ', 'g') as tokens from pages")
def tokens_decoded(spark, d):
    return _pages(spark, d).select("page_id", url.decoded_url_tokens(F.col("url")).alias("tokens"))


@_query(r"""with p as (select page_id, regexp_replace(regexp_replace(url, '^(//|https://|http://)', ''), '^(www[.]|ww2[.]|ww3[.])', '') as bare from pages),
q as (select page_id, lower(regexp_extract(bare, '^([^/?#:]*)', 1)) as host, regexp_replace(regexp_extract(bare, '^[^/?#:]*(.*)$', 1), '#.*$', '') as rest from p)
select page_id, '(' || array_to_string(list_reverse(string_split(host, '.')), ',') || ',)' || case when starts_with(rest, '/') then rest else '/' || rest end as surt from q""")
def surt_pages(spark, d):
    return _pages(spark, d).select("page_id", url.to_surt(F.col("url")).alias("surt"))


@_query("select page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) as host, regexp_extract(url, '^([a-z]+):', 1) as protocol from pages")
def host_protocol(spark, d):
    return _pages(spark, d).select("page_id", url.host(F.col("url")).alias("host"), url.protocol(F.col("url")).alias("protocol"))


@_query(r"""select page_id, nullif(regexp_replace(regexp_replace(regexp_replace(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1), '\.[^.]*$', ''), '[[:punct:]]+$', ''), '[[:punct:]]+', ' ', 'g'), '') as filename from pages""")
def filename(spark, d):
    return _pages(spark, d).select("page_id", url.image_filename(F.col("url")).alias("filename"))


@_query(r"select count(*) as n_links, count(*) filter (lower(regexp_extract(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '\.([^./]*)$', 1)) in ('jpg','jpeg','png','tif','tiff','gif','svg','webp','bmp','ico')) as n_images from (select unnest([url, url || '.png', url || '.PNG?x=1', url || '.html']) as u from pages)")
def image_link_filter(spark, d):
    u = _pages(spark, d).select(F.explode(F.array("url", *[F.concat("url", F.lit(x)) for x in (".png", ".PNG?x=1", ".html")])).alias("u"))
    return u.agg(F.count(F.lit(1)).alias("n_links"), F.count_if(url.links_to_image(F.col("u"))).alias("n_images"))


@_query("""select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages""")
def page_anchor_explode(spark, d):
    return _pages(spark, d).select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))).alias("href"))


@_query("""select page_id, len(regexp_extract_all(html || ' url(''a.png'') url(b.gif) ', 'url\\([''"]*(.*?)[''"]*\\)', 1))::bigint as n_urls from pages""")
def css_url_extract(spark, d):
    html = F.concat("html", F.lit(" url('a.png') url(b.gif) "))
    return _pages(spark, d).select("page_id", F.size(F.regexp_extract_all(html, F.lit("url\\(['\"]*(.*?)['\"]*\\)"), F.lit(1))).cast("long").alias("n_urls"))


@_query("select event_id, strftime(date_trunc('second', ts), '%Y%m%d%H%M%S') as ts14, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') as from12, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as from16, null::varchar as bad from events")
def ts14_parse_format(spark, d):
    t = spark.read.parquet(f"{d}/events.parquet").withColumn("s", time.format_ts14(F.col("ts")))
    parsed = lambda c: _text(time.parse_ts14(c))
    return t.select("event_id", F.col("s").alias("ts14"), parsed(F.substring("s", 1, 12)).alias("from12"), parsed(F.concat("s", F.lit("99"))).alias("from16"), parsed(F.concat("s", F.lit("9"))).alias("bad"))


@_query("select event_id, case when second(ts) = 0 then strftime(ts, '%Y-%m-%dT%H:%M') else strftime(ts, '%Y-%m-%dT%H:%M:%S') end as iso from events")
def iso_ts(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", time.iso_text(F.col("ts")).alias("iso"))


@_query(f"{_WITH} select event_id, m from pg")
def image_metadata_key(spark, d):
    return _refs(spark, d).select("event_id", "m")


@_query(f"{_WITH} select event_id, strftime(page_ts, '%Y%m%d%H%M%S') || '/' || md5(page_url) || '/' || md5(m) || '/x' as ref_id, strftime(page_ts, '%Y%m%d%H%M%S') || '/' || page_url as url_ts from pg")
def reference_ids(spark, d):
    return _refs(spark, d).select("event_id", ids.reference_id(F.col("page_ts"), F.col("page_url"), F.col("m"), F.lit("x")).alias("ref_id"), ids.url_with_ts(F.col("page_ts"), F.col("page_url")).alias("url_ts"))


@_query("select doc_id, sha256(text) as sha, md5(text) as md5 from documents")
def sha256_md5(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", ids.sha256_hex(F.col("text")).alias("sha"), ids.md5_hex(F.col("text")).alias("md5"))


@_query(r"""with h as (select doc_id, text, substr(text, 1, 125) as head, right(text, 125) as tail from documents),
c as (select *, strpos(reverse(head), ' ') as a, strpos(tail, ' ') as b from h)
select doc_id, case when length(text) > 250 then case when a > 0 then substr(head, 1, 125 - a) else head end || chr(10) ||
 regexp_replace(case when b > 0 then substr(tail, b) else right(text, 126) end, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') else text end as caption from c""")
def trim_caption(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", text.trim_caption(F.col("text")).alias("caption"))


@_query("select doc_id, text as repaired from documents where not regexp_matches(text, '[^\u0000-ÿ]')")
def mojibake(spark, d):
    t = spark.read.parquet(f"{d}/documents.parquet").filter("not text rlike '[^\\\\x{0}-\\\\x{ff}]'")
    return t.select("doc_id", text.fix_mojibake(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).alias("repaired"))


@_query(f"{_WITH} select warc_offset, width, height from img where {_SIZED}")
def size_filter(spark, d):
    return groups.size_window(captures(spark, d)).select("warc_offset", "width", "height")


@_query(f"{_WITH} select surt, count(distinct digest) as n_digests, count(*) as n_captures from img_dense where {_SIZED} group by 1")
def distinct_images(spark, d):
    return groups.distinct_images(_dense(spark, d)).groupBy("surt").agg(F.count(F.lit(1)).alias("n_digests"), F.sum("captures").alias("n_captures"))


@_query(f"{_WITH} select surt, digest, arg_min(url, {_MD5}) as url, arg_min(warc_offset, {_MD5}) as warc_offset, {_T.format('min(ts)')} as first_ts from img_dense where {_SIZED} group by 1, 2")
def canonical_capture(spark, d):
    return groups.distinct_images(_dense(spark, d)).select("surt", "digest", "url", "warc_offset", _text("first_ts").alias("first_ts"))


@_query(f"{_WITH} select surt, digest, date_diff('second', min(ts), max(ts)) as timespan, {_T.format('max(ts)')} as last_ts, string_agg(distinct strftime(ts, '%Y%m%d%H%M%S'), ',' order by strftime(ts, '%Y%m%d%H%M%S')) as timestamps from img_dense where {_SIZED} group by 1, 2")
def capture_timespan(spark, d):
    return groups.distinct_images(_dense(spark, d)).select("surt", "digest", "timespan", _text("last_ts").alias("last_ts"), F.array_join(F.transform("timestamps", time.format_ts14), ",").alias("timestamps"))


@_query(f"{_WITH} select surt, m, count(*) as n from pg group by 1, 2")
def distinct_refs(spark, d):
    return groups.distinct_references(_refs(spark, d)).select("surt", "m", F.col("references").alias("n"))


@_query(f"{_WITH} select surt, m, arg_min(page_url, row(page_ts, length(page_url), page_url)) as page_url, {_T.format('min(page_ts)')} as page_ts, {_T.format('max(page_ts)')} as newest_ts, date_diff('second', min(page_ts), max(page_ts)) as page_timespan from pg group by 1, 2")
def canonical_page(spark, d):
    return groups.distinct_references(_refs(spark, d)).select("surt", "m", "page_url", _text("page_ts").alias("page_ts"), _text("newest_ts").alias("newest_ts"), "page_timespan")


@_query(f"{_WITH}, i as (select surt, count(*) as matching_images, count(distinct digest) as unique_digests, min(ts) as o from img_dense where {_SIZED} group by 1), r as (select surt, count(*) as matching_pages, count(distinct m) as image_metadata_changes from pg group by 1) select surt, matching_images, unique_digests, matching_pages, image_metadata_changes, {_T.format('o')} as oldest_date from i join r using (surt)")
def matching_counts(spark, d):
    out = groups.group_statistics(_dense(spark, d), _refs(spark, d))
    return out.select("surt", "matching_images", "unique_digests", "matching_pages", "image_metadata_changes", _text("oldest_date").alias("oldest_date"))


@_query(f"{_WITH} select surt, 1 + count(*) filter (tokens <> held) as page_metadata_changes from (select surt, {_TOKENS} as tokens, first_value({_TOKENS}) over (partition by surt, m order by page_ts, length(page_url), page_url) as held from pg) group by 1")
def page_metadata_changes(spark, d):
    return groups.page_metadata_changes(_refs(spark, d))


@_query(f"{_WITH}, o as (select surt, min(ts) as t from img_dense where {_SIZED} group by 1) select digest, arg_min(surt, row(t, -length(surt), surt)) as oldest_surt from (select distinct surt, digest from img_dense where {_SIZED}) join o using (surt) group by 1")
def oldest_surt(spark, d):
    i = _dense(spark, d)
    dates = i.groupBy("surt").agg(F.min("ts").alias("oldest_date"))
    return groups.oldest_surt(i.select("surt", "digest").distinct().join(dates, "surt"), "digest").select("digest", "oldest_surt")


@_query(f"{_WITH} select surt, event_id from pg qualify row_number() over (partition by surt order by page_ts, event_id) <= 500")
def cap_500(spark, d):
    return groups.cap(references(spark, d), "surt", ["page_ts", "event_id"]).select("surt", "event_id")


@_query(f"{_WITH}, r as (select surt, m, arg_min(img_title, o) as t, arg_min(img_alt, o) as a, arg_min(img_caption, o) as c from (select *, row(page_ts, length(page_url), page_url, img_title, img_alt, img_caption) as o from pg) group by 1, 2) select surt, array_to_string(list(t order by m) filter (t <> ''), '|') as titles, array_to_string(list(a order by m) filter (a <> ''), '|') as alts, array_to_string(list(c order by m) filter (c <> ''), '|') as captions from r group by 1")
def ordered_lists(spark, d):
    out = groups.ordered_lists(groups.distinct_references(_refs(spark, d)), "surt")
    return out.select("surt", *[F.array_join(f"img_{c}", "|").alias(c) for c in ("titles", "alts", "captions")])


@_query(f"{_WITH} select surt, arg_min(page_url, row(m, page_ts, length(page_url), page_url)) as page_url from pg group by 1")
def rep_page(spark, d):
    return groups.representative_page(groups.distinct_references(_refs(spark, d)), "surt").select("surt", "page_url")


_MAGNITUDE = "case when year({0}) <> year({1}) then year({0}) - year({1}) when month({0}) <> month({1}) then month({0}) - month({1}) when day({0}) <> day({1}) then day({0}) - day({1}) else sign(epoch({0}) - epoch({1})) end"
_LATER = {True: "epoch(a) - epoch(page_ts) < epoch(page_ts) - epoch(b)", False: f"{_MAGNITUDE.format('a', 'page_ts')} < {_MAGNITUDE.format('page_ts', 'b')}"}


def _asof_sql(by_duration: bool) -> str:
    return f"""{_WITH}, t as (select distinct surt, ts from img where {_SIZED}),
        f as (select pg.*, t.ts as b from pg asof left join t on pg.surt = t.surt and pg.page_ts >= t.ts),
        c as (select f.*, t.ts as a from f asof left join t on f.surt = t.surt and f.page_ts <= t.ts)
        select event_id, {_T.format("case when b is null then a when a is null then b when " + _LATER[by_duration] + " then a else b end")} as matched from c where a is not null or b is not null"""


def _asof(spark, d, by_duration):
    out = nearest(references(spark, d), groups.size_window(captures(spark, d)).select("surt", "ts"), "surt", by_duration)
    return out.select("event_id", _text("matched").alias("matched"))


@_query(_asof_sql(False))
def asof_compat(spark, d):
    return _asof(spark, d, False)


@_query(_asof_sql(True))
def asof_true(spark, d):
    return _asof(spark, d, True)


_HALF_I, _HALF_R = "surt < 'src15'", "surt > 'src12'"


@_query(f"{_WITH} select surt, n_img, n_ref from (select surt, count(*) as n_img from img where {_HALF_I} group by 1) join (select surt, count(*) as n_ref from pg where {_HALF_R} group by 1) using (surt)")
def cogroup_inner(spark, d):
    i = captures(spark, d).filter(_HALF_I).groupBy("surt").agg(F.count(F.lit(1)).alias("n_img"))
    return i.join(references(spark, d).filter(_HALF_R).groupBy("surt").agg(F.count(F.lit(1)).alias("n_ref")), "surt")


@_query(f"{_WITH} select surt, warc_offset from img where {_HALF_I} and surt not in (select surt from pg where {_HALF_R})")
def one_sided_images(spark, d):
    return groups.one_sided(captures(spark, d).filter(_HALF_I), references(spark, d).filter(_HALF_R)).select("surt", "warc_offset")


@_query(f"{_WITH} select surt, event_id from pg where {_HALF_R} and surt not in (select surt from img where {_HALF_I})")
def one_sided_refs(spark, d):
    return groups.one_sided(references(spark, d).filter(_HALF_R), captures(spark, d).filter(_HALF_I)).select("surt", "event_id")


_FLOW = f"""{_WITH}, ii as (select * from img_dense where {_SIZED}),
    si as (select surt, digest, ts from ii group by all),
    sp as (select surt, m, arg_min(page_url, o) as page_url, min(page_ts) as page_ts, arg_min(images_in_page, o) as images_in_page, count(*) as n from (select *, row(page_ts, length(page_url), page_url) as o from pg) where surt in (select surt from ii) group by 1, 2),
    t1 as (select distinct surt, ts from si),
    f1 as (select sp.*, t1.ts as b from sp asof left join t1 on sp.surt = t1.surt and sp.page_ts >= t1.ts),
    c1 as (select f1.*, t1.ts as a from f1 asof left join t1 on f1.surt = t1.surt and f1.page_ts <= t1.ts),
    m1 as (select surt, m, page_url, page_ts, images_in_page, n, case when b is null then a when a is null then b when {_LATER[False]} then a else b end as matched from c1),
    split as (select m1.*, digest from m1 join si on m1.surt = si.surt and m1.matched = si.ts),
    dp as (select digest, m, arg_min(page_url, row(page_ts, length(page_url), page_url)) as page_url, min(page_ts) as page_ts, arg_min(images_in_page, row(page_ts, length(page_url), page_url)) as images_in_page, sum(n)::bigint as n from split group by 1, 2),
    st as (select surt, mi, mp, o from (select surt, count(*) as mi, min(ts) as o from ii group by 1) join (select surt, count(*) as mp from pg group by 1) using (surt)),
    ds as (select digest, sum(mi)::bigint as matching_images, sum(mp)::bigint as matching_pages, arg_min(surt, row(o, -length(surt), surt)) as oldest_surt from (select distinct surt, digest from ii) join st using (surt) group by 1),
    di as (select digest, arg_min(url, {_MD5}) as url, min(ts) as first_ts, max(ts) as last_ts, count(distinct ts) as n_timestamps from ii where surt in (select surt from st) group by 1)"""


def _index(spark, d):
    return index.build(captures(spark, d, dense=True), references(spark, d))


@_query(f"{_FLOW} select surt, digest, m, page_url, {_T.format('matched')} as matched from split")
def digest_split(spark, d):
    return _index(spark, d).split.select("surt", "digest", "m", "page_url", _text("matched").alias("matched"))


@_query(f"{_FLOW} select digest, url, {_T.format('first_ts')} as first_ts, {_T.format('last_ts')} as last_ts, n_timestamps, matching_images, matching_pages, oldest_surt from di join ds using (digest)")
def digest_merge(spark, d):
    ix = _index(spark, d)
    out = ix.digest_images.join(ix.digest_stats, "digest")
    return out.select("digest", "url", _text("first_ts").alias("first_ts"), _text("last_ts").alias("last_ts"), F.size("timestamps").cast("long").alias("n_timestamps"), "matching_images", "matching_pages", "oldest_surt")


@_query(f"""{_FLOW}, t2 as (select distinct digest, ts from ii where surt in (select surt from st)), f2 as (select dp.*, t2.ts as b from dp asof left join t2 on dp.digest = t2.digest and dp.page_ts >= t2.ts),
    c2 as (select f2.*, t2.ts as a from f2 asof left join t2 on f2.digest = t2.digest and f2.page_ts <= t2.ts)
    select digest, m, page_url, n as references, {_T.format("case when b is null then a when a is null then b when " + _LATER[False] + " then a else b end")} as matched from c2""")
def rematch(spark, d):
    return _index(spark, d).digest_refs.select("digest", "m", "page_url", "references", _text("matched").alias("matched"))


@_query(f"{_FLOW} select digest, 'image' as kind, strftime(first_ts, '%Y%m%d%H%M%S') || '/' || md5(url) as id from di union all select digest, 'page', strftime(page_ts, '%Y%m%d%H%M%S') || '/' || md5(page_url) || '/' || md5(m) || '/' || digest from dp")
def full_docs(spark, d):
    return index.full_lines(_index(spark, d))


@_query(f"""{_FLOW} select digest, url, {_T.format('first_ts')} as first_ts, {_T.format('last_ts')} as last_ts, p.page_url, {_T.format('p.page_ts')} as page_ts, p.images_in_page, matching_images, matching_pages, oldest_surt
    from di join ds using (digest) join (select * from dp qualify row_number() over (partition by digest order by m) = 1) p using (digest)""")
def compact_docs(spark, d):
    out = index.compact(_index(spark, d))
    return out.select("digest", "url", _text("first_ts").alias("first_ts"), _text("last_ts").alias("last_ts"), "page_url", _text("page_ts").alias("page_ts"), "images_in_page", "matching_images", "matching_pages", "oldest_surt")


@_query(f"""{_WITH}, g as (select coalesce(i.surt, r.surt) as surt, coalesce(n_img, 0) as n_img, coalesce(n_digests, 0) as n_digests, coalesce(n_ref, 0) as n_ref
    from (select surt, count(*) as n_img, count(distinct digest) as n_digests from img_dense where {_SIZED} and {_HALF_I} group by 1) i full join (select surt, count(*) as n_ref from pg where {_HALF_R} group by 1) r on i.surt = r.surt),
    c as (select count(*) filter (n_img > 0 and n_ref > 0) as a, coalesce(sum(n_img) filter (n_ref > 0), 0) as b, coalesce(sum(n_ref) filter (n_img > 0), 0) as c, coalesce(sum(n_digests) filter (n_ref > 0), 0) as d, count(*) filter (n_digests > 1 and n_ref > 0) as e,
    count(*) filter (n_ref = 0) as f, coalesce(sum(n_img) filter (n_ref = 0), 0) as g, count(*) filter (n_img = 0) as h, coalesce(sum(n_ref) filter (n_img = 0), 0) as i from g)
    select unnest(['URL_IMAGES_PAGES', 'URL_IMAGESALL_PAGES', 'URL_IMAGES_PAGESALL', 'URL_IMAGES_PAGES_DIGESTALL', 'URL_IMAGES_PAGES_MULTIPLE_DIGEST', 'URL_IMAGES_NPAGES', 'URL_IMAGESALL_NPAGES', 'URL_NIMAGES_PAGES', 'URL_NIMAGES_PAGESALL']) as counter, unnest([a, b, c, d, e, f, g, h, i]::bigint[]) as value from c""")
def counters_reduce(spark, d):
    return index.counters(captures(spark, d, dense=True).filter(_HALF_I), references(spark, d).filter(_HALF_R))


def _add_whole(name, f):
    """A query over the whole views beside one over key ranges, with the same SQL but for these."""
    QUERIES[f"{name}_whole"] = f
    ORACLE[f"{name}_whole"] = ORACLE[name].replace(_HALF_I, "true").replace(_HALF_R, "true")


def cogroup_inner_whole(spark, d):
    i = captures(spark, d).groupBy("surt").agg(F.count(F.lit(1)).alias("n_img"))
    return i.join(references(spark, d).groupBy("surt").agg(F.count(F.lit(1)).alias("n_ref")), "surt")


_add_whole("cogroup_inner", cogroup_inner_whole)
_add_whole("one_sided_images", lambda spark, d: groups.one_sided(captures(spark, d), references(spark, d)).select("surt", "warc_offset"))
_add_whole("one_sided_refs", lambda spark, d: groups.one_sided(references(spark, d), captures(spark, d)).select("surt", "event_id"))
_add_whole("counters_reduce", lambda spark, d: index.counters(captures(spark, d, dense=True), references(spark, d)))


_AT = "timestamp '2024-01-01 00:00:00' + to_seconds(page_id * 61 % 2592000)"
_TS14 = f"strftime({_AT}, '%Y%m%d%H%M%S')"
_SITE = "'http://h' || page_id % 9 || '.example'"
_HTML = "replace(replace('" + PAGE.replace("'", "''").replace("{{", "{").replace("}}", "}") + "', '{i}', page_id::varchar), '{k}', (page_id % 5)::varchar)"


def _records(spark, d, kind="warc"):
    return read_contents(archives(spark, d, kind))


@_query(f"""with p as (select *, {_SITE} as site, {_TS14} as ts14 from pages)
    select 'response' as record_type, site || '/raw/' || page_id as target_url, ts14, 'text/html' as mime, '200' as http_status, md5(html) as payload from p
    union all select 'response', site || '/p/' || page_id, strftime({_AT} + to_hours(h), '%Y%m%d%H%M%S'), 'text/html', '200', md5({_HTML}) from p, (select unnest([0, 1]) as h)
    union all select 'response', site || '/i/' || page_id || '.png', ts14, case when page_id % 4 = 0 then 'image/gif' else 'image/png' end, '200', 'image' from p
    union all select 'resource', site || '/r/' || page_id || '.png', ts14, 'image/png', '', 'image' from p
    union all select 'failed archive', null, null, null, '', null from p where page_id % 30 >= 20""")
def warc_records(spark, d):
    payload = F.when(F.col("mime").contains("image"), F.lit("image")).otherwise(F.md5("payload"))
    return _records(spark, d).select("record_type", "target_url", "ts14", "mime", "http_status", payload.alias("payload"))


@_query(f"""select 'response' as record_type, {_SITE} || '/raw/' || page_id as target_url, {_TS14} as ts14, 'text/html' as mime, '200' as http_status, md5(html) as payload from pages
    union all select 'failed record', null, null, null, '', null from pages where page_id % 10 = 0""")
def arc_records(spark, d):
    return _records(spark, d, "arc").select("record_type", "target_url", "ts14", "mime", "http_status", F.md5("payload").alias("payload"))


@_query(f"""with p as (select page_id as i, {_SITE} as site from pages)
    select i, 'img' as tag, site || '/i/' || i || '.png' as img_url, 'T ' || i as img_title, 'A ' || i as img_alt, 'Before ' || i as img_caption, 1 as images_in_page, 'Title ' || i as page_title from p
    union all select i, 'a', site || '/p/big/' || i || '.jpg', '', '', 'Link ' || i, 1, 'Title ' || i from p
    union all select i, 'css', site || '/bg/' || i % 5 || '.gif', '', '', '', 1, 'Title ' || i from p""")
def html_image_refs(spark, d):
    i = F.col("page_id").cast("string")
    html = F.replace(F.replace(F.lit(PAGE.replace("{{", "{").replace("}}", "}")), F.lit("{i}"), i), F.lit("{k}"), (F.col("page_id") % 5).cast("string"))
    page = _pages(spark, d).select("page_id", F.concat(F.lit("http://h"), (F.col("page_id") % 9).cast("string"), F.lit(".example/p/"), i).alias("page_url"), html.alias("html"))
    return html_references(page, ("page_id",)).select(F.col("page_id").alias("i"), "tag", "img_url", "img_title", "img_alt", "img_caption", "images_in_page", "page_title")


@_query(f"""with p as (select page_id as i, {_SITE} as site, {_AT} as t from pages), c as (select i, site, t + to_hours(h) as t from p, (select unnest([0, 1]) as h))
    select strftime(t, '%Y%m%d%H%M%S') as page_ts, '(example,h' || i % 9 || ',)/i/' || i || '.png' as surt, i::varchar as img_filename, 'h' || i % 9 || '.example' as page_host, 'http' as page_protocol, 'a' || i || '.warc.gz' as warc from c
    union all select strftime(t, '%Y%m%d%H%M%S'), '(example,h' || i % 9 || ',)/p/big/' || i || '.jpg', i::varchar, 'h' || i % 9 || '.example', 'http', 'a' || i || '.warc.gz' from c
    union all select strftime(t, '%Y%m%d%H%M%S'), '(example,h' || i % 9 || ',)/bg/' || i % 5 || '.gif', (i % 5)::varchar, 'h' || i % 9 || '.example', 'http', 'a' || i || '.warc.gz' from c""")
def archive_references(spark, d):
    refs = extraction.references_of(extraction.pages_of(_records(spark, d).filter("not target_url like '%/raw/%'")))
    return refs.select(time.format_ts14(F.col("page_ts")).alias("page_ts"), "surt", "img_filename", "page_host", "page_protocol", "warc")


@_query(f"""with p as (select page_id as i, {_SITE} as site, {_TS14} as ts14 from pages)
    select site || '/i/' || i || '.png' as url, md5(site || '/i/' || i || '.png') as image_url_hash, ts14, 51 + i % 40 as width, 51 + i % 7 as height, case when i % 4 = 0 then 'image/gif' else 'image/png' end as mime_reported, 'image/png' as mime, 29 + length((i % 50)::varchar) as size from p
    union all select site || '/r/' || i || '.png', md5(site || '/r/' || i || '.png'), ts14, 40 + i % 30, 60, 'image/png', 'image/png', 30 + length(i::varchar) from p""")
def archive_captures(spark, d):
    images, _ = extraction.extract(_records(spark, d))
    return images.select("url", "image_url_hash", time.format_ts14(F.col("ts")).alias("ts14"), "width", "height", "mime_reported", "mime", "size")


@_query("""with p as (select page_id as i from pages)
    select i, 'image/png' as mime_detected, (1 + i % 300)::int as width, (7 + i % 200)::int as height from p union all select i, 'image/gif', 1 + i % 300, 7 + i % 200 from p union all select i, 'image/bmp', 1 + i % 300, 7 + i % 200 from p
    union all select i, 'image/jpeg', 1 + i % 300, 7 + i % 200 from p union all select i, 'image/svg+xml', 1 + i % 300, 7 + i % 200 from p union all select i, 'text/html', null, null from p""")
def image_probe(spark, d):
    sides = lambda w, size: F.lpad(F.hex(w), size, "0")
    little = lambda w: F.concat(F.substring(sides(w, 4), 3, 2), F.substring(sides(w, 4), 1, 2))
    w, h = 1 + F.col("page_id") % 300, 7 + F.col("page_id") % 200
    hexed = [
        F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), sides(w, 8), sides(h, 8)), F.concat(F.lit("474946383961"), little(w), little(h)), F.concat(F.lit("424D"), F.lit("00" * 16), little(w), F.lit("0000"), little(h), F.lit("0000")),
        F.concat(F.lit("FFD8FFE0000400" + "00" + "FFC0000B08"), sides(h, 4), sides(w, 4), F.lit("00")), F.hex(F.concat(F.lit("<svg xmlns='x' width='"), w.cast("string"), F.lit("' height='"), h.cast("string"), F.lit("'></svg>"))), F.hex(F.lit("<html></html>")),
    ]
    each = _pages(spark, d).select(F.col("page_id").alias("i"), F.explode(F.array(*[F.unhex(x) for x in hexed])).alias("payload")).withColumn("mime", F.lit("text/html"))
    return probed(each).select("i", "mime_detected", "width", "height")


@_query("""with p as (select page_id as i from pages), n as (select count(*) as n, count(*) filter (i % 30 >= 20) as cut, count(*) filter (i % 30 < 11) as small, count(*) filter (i % 4 = 0) as wrong from p)
    select unnest(['WARCS', 'WARCS_DOWNLOAD_ERROR', 'WARCS_FAILED_STREAM', 'RECORDS_READ', 'RECORDS_FAILED', 'IMAGES_IN_WARC_TOTAL', 'IMAGES_IN_WARC_FAILED', 'IMAGES_IN_WARC_TOO_SMALL_BASE64', 'IMAGES_IN_WARC_TOO_SMALL', 'IMAGES_IN_WARC_TOO_LARGE', 'IMAGES_IN_WARC_MIME_INVALID', 'IMAGES_IN_WARC_MIME_WRONG', 'IMAGES_IN_WARC_PARSED_DUP', 'IMAGES_IN_WARC_PARSED',
        'IMAGES_IN_HTML_MATCHING', 'IMAGES_IN_HTML_MATCHING_LINK', 'IMAGES_IN_HTML_MATCHING_CSS', 'IMAGES_IN_HTML_BASE64', 'IMAGES_IN_HTML_SENT_DUP', 'IMAGES_IN_HTML_SENT', 'PAGES_WITH_IMAGES', 'IMAGES_IN_HTML_TOTAL', 'IMAGES_IN_HTML_EXCEDED', 'IMAGES_IN_HTML_NOT_PARSED', 'PAGES', 'PAGE_UTF8_MISMATCH_DOUBLE']) as counter,
        unnest([n, 0, cut, 5 * n, 0, 2 * n, 0, 0, small, 0, 0, wrong, 2 * n - small, 2 * n - small, 6 * n, 2 * n, 2 * n, 0, 6 * n, 3 * n, 2 * n, 2 * n, 0, 0, 3 * n, 0]::bigint[]) as value from n""")
def counters_extraction(spark, d):
    return extraction.extraction_counters(_records(spark, d))


@_query(f"""{_FLOW}, n as (select count(*) as n from di), r as (select count(*) as refs, count(distinct digest) as with_refs from dp), s as (select count(*) as states from (select distinct surt, digest from ii) where surt in (select surt from st))
    select unnest(['RECORDS_MAP_IN', 'RECORDS_IN', 'RECORDS_OUT', 'RECORDS_WITH_METADATA', 'RECORDS_WITHOUT_METADATA', 'URL_IMAGES_PAGESALL', 'URL_IMAGESALL_PAGES', 'URL_IMAGES_PAGES']) as counter, unnest([states, states, n, with_refs, n - with_refs, refs, n, n]::bigint[]) as value from n, r, s""")
def counters_merge(spark, d):
    return index.merge_counters(_index(spark, d))


@_query(f"""{_FLOW}, im as (select digest, min(ts) as first_ts, date_diff('second', min(ts), max(ts)) as timespan, arg_min(url, {_MD5}) as url, arg_min(width, {_MD5}) as width, arg_min(warc, {_MD5}) as warc from ii where surt in (select surt from st) group by 1)
    select digest, m, page_url, im.timespan, im.width, strftime(im.first_ts, '%Y%m%d%H%M%S') || '/' || md5(im.url) as image_id, im.warc as image_warc, matching_images, matching_pages, ds.oldest_surt, u.unique_digests
    from dp join im using (digest) join ds using (digest) join (select surt, count(distinct digest) as unique_digests from ii group by 1) u on u.surt = ds.oldest_surt""")
def matched_refs(spark, d):
    return index.matched_references(_index(spark, d)).select("digest", "m", "page_url", "timespan", "width", "image_id", "image_warc", "matching_images", "matching_pages", "oldest_surt", "unique_digests")


@_query(f"""{_FLOW}, im as (select digest, min(ts) as first_ts, date_diff('second', min(ts), max(ts)) as timespan, arg_min(url, {_MD5}) as url, arg_min(width, {_MD5}) as width from ii where surt in (select surt from st) group by 1)
    select digest, 'image' as type, strftime(first_ts, '%Y%m%d%H%M%S') || '/' || md5(url) as id, url, timespan::varchar as timespan, width::varchar as width from im
    union all select digest, 'page', strftime(im.first_ts, '%Y%m%d%H%M%S') || '/' || md5(im.url), page_url, timespan::varchar, width::varchar from dp join im using (digest)""")
def full_json_lines(spark, d):
    get = lambda *keys: F.coalesce(*[F.get_json_object("value", f"$.{k}") for k in keys])
    return index.full_json(_index(spark, d)).select("digest", get("type").alias("type"), get("imgId", "id").alias("id"), get("pageURL", "imgSrc").alias("url"), get("imgTimespan").alias("timespan"), get("imgWidth").alias("width"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.compact(_index(spark, sf_dir))
