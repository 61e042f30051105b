import base64
import gzip
import json
import struct
import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[1]))
from vitrine import catalog
from vitrine.functions.time import iso_to_ts14, magnitude, parse_ts14
from vitrine.functions.url import image_filename, to_surt
from vitrine.operators import groups, html_refs
from vitrine.operators.html_refs import page_references
from vitrine.plans import archives, index
from vitrine.sources import synthetic, webarchive
from vitrine.sources.synthetic import captures, references

D = "/root/testdata/sf0.001"
PARENT = "<html><head><title>T</title></head><body><div><p>Before it</p><img src='/a.png' alt='x'></div>\n<p>Far</p>\n<p>Away</p>\n</body></html>"


@pytest.mark.parametrize("name", ["tokens_page_url", "surt_pages", "canonical_capture", "canonical_page", "asof_compat", "asof_true", "digest_split", "rematch", "compact_docs", "counters_reduce", "trim_caption", "mojibake"])
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "events"):
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet{'/*.parquet' if Path(f'{D}/{t}.parquet').is_dir() else ''}'")
    df = catalog.QUERIES[name](spark, D)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    ran = con.execute(catalog.ORACLE[name])
    names = [x[0] for x in ran.description]
    assert got == sorted((tuple(r[names.index(c)] for c in cols) for r in ran.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["cogroup_inner_whole", "one_sided_images_whole", "one_sided_refs_whole", "counters_reduce_whole"])
def test_whole_views(spark, name):
    test_same_as_sql(spark, name)


def test_both_sides_of_all_keys(spark):
    i, r = captures(spark, D), references(spark, D)
    got = {x.surt: (x.n_img, x.n_ref) for x in catalog.QUERIES["cogroup_inner_whole"](spark, D).collect()}
    n_i, n_r = ({x["surt"]: x["count"] for x in t.groupBy("surt").count().collect()} for t in (i, r))
    assert got == {k: (n_i[k], n_r[k]) for k in n_i.keys() & n_r.keys()} and len(got) > 2


def test_one_sided_groups(spark):
    i = spark.createDataFrame([("src2", 1), ("src15", 2), ("both", 3)], "surt string, warc_offset long")
    r = spark.createDataFrame([("src9", 4), ("both", 5), ("both", 6)], "surt string, event_id long")
    assert {x.warc_offset for x in groups.one_sided(i, r).collect()} == {1, 2} and {x.event_id for x in groups.one_sided(r, i).collect()} == {4}


def test_input_order_and_partitions_do_not_matter(spark):
    i, r = captures(spark, D, dense=True), references(spark, D)
    rows = lambda a, b: sorted(map(repr, index.compact(index.build(a, b)).collect()))
    assert rows(i, r) == rows(i.orderBy(F.rand(1)).repartition(3), r.orderBy(F.rand(2)).repartition(5))


def test_digests_without_references_keep_their_statistics(spark):
    shot = "'http://h/' || d || '.png' as url, d as digest, 'image/png' as mime, 60 as width, 60 as height, 1L as size, 'w' as warc, 0L as warc_offset"
    i = spark.sql(f"select 'a' as surt, ts, {shot} from values ('near', timestamp_ntz'2024-01-01'), ('far', timestamp_ntz'2024-03-01') as t(d, ts)")
    r = spark.sql("select 'a' as surt, 'http://h/p' as page_url, timestamp_ntz'2024-01-01' as page_ts, 't' as img_title, '' as img_alt, '' as img_caption, 1 as images_in_page")
    ix = index.build(i, r)
    assert [x.digest for x in ix.digest_refs.collect()] == ["near"]
    got = {x.digest: (x.matching_images, x.matching_pages, x.oldest_surt, x.image_metadata_changes, x.page_metadata_changes) for x in ix.digest_stats.collect()}
    assert got == {"near": (2, 1, "a", 1, 1), "far": (2, 1, "a", 1, 1)}
    assert {x.value for x in index.full_json(ix).filter("digest = 'far'").selectExpr("get_json_object(value, '$.oldestSurt') as value").collect()} == {"a"}


def test_scalars(spark):
    t = spark.createDataFrame([("201001011200",), ("2010010112003099",), ("20100101120030",), ("bad",)], "s string")
    assert [str(r[0]) for r in t.select(parse_ts14(F.col("s"))).collect()] == ["2010-01-01 12:00:00", "2010-01-01 12:00:30", "2010-01-01 12:00:30", "None"]
    one = spark.range(1)
    pick = lambda c: one.select(c).first()[0]
    assert pick(iso_to_ts14(F.lit("2020-01-02T03:04:05Z"))) == "20200102030405" and pick(iso_to_ts14(F.lit("x"))) is None
    assert pick(to_surt(F.lit("https://host.example/media/caf-ção.jpg"))) == "(example,host,)/media/caf-%c3%a7%c3%a3o.jpg"
    assert pick(to_surt(F.lit("https://www.h.example/a/1024"))) == "(example,h,)/a/1024"
    assert pick(image_filename(F.lit("http://a.b/c/big-picture.v2.png?x"))) == "big picture v2"
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    for a, b, n in (("2020-02-01", "2020-01-31", 1), ("2020-01-10", "2020-01-03", 7), ("2020-01-01 23:00:00", "2020-01-01 01:00:00", 1)):
        assert pick(magnitude(ts(a), ts(b))) == n


def test_captions():
    rows = page_references(PARENT, "http://h.example/p")
    assert [(r[3], r[5], r[6], r[7]) for r in rows] == [("http://h.example/a.png", "x", "Before it", "img")]


def test_archives_to_lines(spark, tmp_path):
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 60, 70) + b"\x08\x02\0\0\0"
    small = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 50, 70) + b"\x08\x02\0\0\0"
    html = PARENT.replace("</div>", f"<img src='data:image/png;base64,{base64.b64encode(png + b'i').decode()}'><img src='/s.png'></div>").encode()

    def record(url, date, mime, body):
        http = b"HTTP/1.1 200 OK\r\nContent-Type: " + mime + b"\r\n\r\n" + body
        return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: " + url + b"\r\nWARC-Date: " + date + b"\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: " + str(len(http)).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"

    parts = [record(b"http://h.example/a.png", b"2020-01-01T00:00:00Z", b"image/png", png), record(b"http://h.example/s.png", b"2020-01-01T00:00:00Z", b"image/png", small), record(b"http://h.example/p", b"2020-01-02T00:00:00Z", b"text/html", html)]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "broken.warc").write_bytes(parts[0] + b"junk\r\n")
    lines = [json.loads(r[0]) for r in archives.index_archives(spark, str(tmp_path)).collect()]
    assert len(lines) == 4 and {x["type"] for x in lines} == {"image", "page"}
    assert {x["imgWidth"] for x in lines if x["type"] == "image"} == {60}
    with pytest.raises(ValueError):
        index.index(captures(spark, D), references(spark, D), "OTHER")


@pytest.mark.parametrize("name", ["warc_records", "arc_records", "html_image_refs", "archive_references", "archive_captures", "image_probe", "counters_extraction", "counters_merge", "matched_refs", "full_json_lines", "page_metadata_changes"])
def test_archives_same_as_sql(spark, name):
    test_same_as_sql(spark, name)


def test_recaptured_pages_keep_their_own_references(spark, tmp_path):
    page = "<html><body><img src='/{0}.png' alt='{0}'></body></html>"
    at = [synthetic._ts(i * 1000) for i in range(3)]
    records = [synthetic.warc_record("http://h.example/p", t, "text/html", page.format(i).encode()) for i, t in enumerate(at)]
    records += [synthetic.warc_record(f"http://h.example/{i}.png", t, "image/png", synthetic.png(60, 70, b"%d" % i)) for i, t in enumerate(at)]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "search.html").write_bytes(b"not an archive")
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(records[0])[:-20])
    found = webarchive.read_archives(spark, str(tmp_path))
    assert {r.archive_name for r in found.collect()} == {"x.warc.gz", "cut.warc.gz"}
    refs = archives.references_of(archives.pages_of(found))
    assert sorted((r.img_alt, r.page_ts.strftime("%Y%m%d%H%M%S")) for r in refs.collect()) == [(str(i), t.strftime("%Y%m%d%H%M%S")) for i, t in enumerate(at)]
    counted = {r.counter: r.value for r in archives.extraction_counters(found).collect()}
    assert (counted["WARCS"], counted["WARCS_FAILED_STREAM"], counted["PAGES"]) == (2, 1, 3)
    lines = [json.loads(r[0]) for r in archives.index_archives(spark, str(tmp_path), "FULL").collect()]
    pictures = [x for x in lines if x["type"] == "image"]
    assert len(pictures) == 3 and len(lines) == 6 and all(base64.b64decode(x["imgSrcBase64"]).startswith(b"\x89PNG") and x["imgMimeTypeReported"] == "image/png" for x in pictures)
    assert all(x["imgId"] in {y["id"] for y in pictures} and x["pageHost"] == "h.example" for x in lines if x["type"] == "page")
    with pytest.raises(Exception, match="cut|Compressed|end|EOF"):
        webarchive.read_archives(spark, str(tmp_path), "FAILFAST").count()


def test_counters_read_the_records_once(spark):
    plan = catalog.QUERIES["counters_extraction"](spark, D)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_counters_of_odd_records(spark):
    png = lambda w, h, tail=b"": "data:image/png;base64," + base64.b64encode(synthetic.png(w, h, tail)).decode()
    page = f"<title>caf\u00e9</title><img src='/a.png' alt='x'><img src='{png(60, 70)}'><img src='{png(9, 70)}'><img src='data:image/png,%00'><a href='b.gif'>b</a><style>p {{ background: url('{png(80, 80)}'); x: url(/c.gif) }}</style>"
    twice = page.encode().decode("latin-1")
    at, h = synthetic._ts(0), "http://h.example"
    records = [synthetic.warc_record(f"{h}/p", at, "text/html", page.encode()), synthetic.warc_record(f"{h}/q", at, "text/html", twice.encode()), synthetic.warc_record(f"{h}/{'l' * 10_001}", at, "text/html", page.encode()), synthetic.warc_record(f"{h}/none", at, "text/html", b"<p>")]
    records += [synthetic.warc_record(f"{h}/{i}.png", at, "image/gif", synthetic.png(*sides, b"t")) for i, sides in enumerate([(60, 70), (60, 70), (9, 70), (16_000, 16_000)])]
    records += [synthetic.warc_record(f"{h}/0.png", at, "image/png", synthetic.png(60, 70, b"t")), synthetic.warc_record(f"{h}/x.png", at, "image/png", b"?"), synthetic.warc_record(f"{h}/both", at, "image/svg,text/html", page.encode()), records[0].replace(b"WARC-Date: 2024", b"WARC-Date: none")]
    whole = b"".join(records)
    found = webarchive.read_contents(spark.createDataFrame([("a.warc", bytearray(whole)), ("b.warc", bytearray(whole + b"junk")), ("a.warc", bytearray(whole))], "name string, content binary"))
    pages, kept = archives.pages_of(found), ("archive_name", "record_type", "mime")
    refs = archives.references_of(pages)
    images, refs, pages, found = (x.collect() for x in (archives.captures_of(found, refs), refs, pages, found.select(*kept)))
    assert sum(p.repaired for p in pages) == 3 and any(r.is_inline for r in refs)
    n = {"small": 0, "small64": 0, "good": [], "large": 0}
    for i in images:
        if i.width is not None and min(i.width, i.height) < 51:
            n["small64" if i.url.startswith("hash:") else "small"] += 1
        elif i.width is not None and i.width * i.height > 225_000_000:
            n["large"] += 1
        elif i.width is not None:
            n["good"].append((i.warc, i.surt, i.digest))
    by_page = {(r.page_url, r.page_ts, r.warc, r.warc_offset): r.images_in_page for r in refs}
    assert {r.counter: r.value for r in archives.extraction_counters(webarchive.read_contents(spark.createDataFrame([("a.warc", bytearray(whole)), ("b.warc", bytearray(whole + b"junk")), ("a.warc", bytearray(whole))], "name string, content binary"))).collect()} == {
        "WARCS": 2, "WARCS_DOWNLOAD_ERROR": 0, "WARCS_FAILED_STREAM": 1, "RECORDS_READ": 36, "RECORDS_FAILED": 0, "IMAGES_IN_WARC_TOTAL": 21, "IMAGES_IN_WARC_FAILED": sum(i.width is None for i in images), "IMAGES_IN_WARC_TOO_SMALL_BASE64": n["small64"], "IMAGES_IN_WARC_TOO_SMALL": n["small"],
        "IMAGES_IN_WARC_TOO_LARGE": n["large"], "IMAGES_IN_WARC_MIME_INVALID": sum(i.mime_detected == "" for i in images), "IMAGES_IN_WARC_MIME_WRONG": sum(i.mime_detected not in ("", i.mime_reported or "") for i in images), "IMAGES_IN_WARC_PARSED_DUP": len(n["good"]), "IMAGES_IN_WARC_PARSED": len(set(n["good"])),
        "IMAGES_IN_HTML_MATCHING": len(refs), "IMAGES_IN_HTML_MATCHING_LINK": sum(r.tag == "a" for r in refs), "IMAGES_IN_HTML_MATCHING_CSS": sum(r.tag == "css" for r in refs), "IMAGES_IN_HTML_BASE64": sum(r.is_inline for r in refs), "IMAGES_IN_HTML_SENT_DUP": len(refs), "IMAGES_IN_HTML_SENT": len({(r.warc, r.surt, r.img_title, r.img_alt, r.img_caption) for r in refs}),
        "PAGES_WITH_IMAGES": len(by_page), "IMAGES_IN_HTML_TOTAL": sum(by_page.values()), "IMAGES_IN_HTML_EXCEDED": 0, "IMAGES_IN_HTML_NOT_PARSED": 0, "PAGES": len(pages), "PAGE_UTF8_MISMATCH_DOUBLE": 3,
    }


class _Steps:
    """Stands for a DataFrame; keeps what a step would run in a Python worker."""

    schema = ()

    def select(self, *_):
        return self

    def mapInArrow(self, f, _):  # noqa: N802
        return f


def test_workers_hand_on_small_batches():
    some = b"".join(synthetic.warc_record(f"http://h.example/{i}", synthetic._ts(i), "text/html", b"x" * 100_000) for i in range(50))
    contents = pa.RecordBatch.from_pydict({"name": [f"{i}.warc" for i in range(10)] + [f"{i}.arc" for i in range(500)], "content": [some] * 10 + [synthetic.arc_of(1, "<html>")] * 500})
    sizes = [(b.num_rows, b.nbytes) for b in webarchive.read_contents(_Steps())(iter([contents]))]
    assert sum(n for n, _ in sizes) == 1000 and max(n for n, _ in sizes) == 200 and max(size for _, size in sizes) < 5_000_000 and len(sizes) < 20
    pages = pa.RecordBatch.from_pydict({"page_url": ["http://h.example/p"] * 3000 + [None], "html": ["<img src='/a.png'>"] * 3000 + [PARENT]})
    assert [b.num_rows for b in html_refs.html_references(_Steps())(iter([pages]))] == [200] * 15


def test_captures_take_few_steps_in_python(spark):
    images, _ = archives.extract(catalog._records(spark, D))
    plan = images._jdf.queryExecution().executedPlan().toString()
    # archives, records and sides of stored images; pages with inline ones have one more, by which these are found
    assert plan.count("MapInArrow") == 5 and plan.count("ArrowEvalPython") == 1


def test_listed_archives(spark, tmp_path):
    (tmp_path / "a.arc").write_bytes(synthetic.arc_of(0, "<html></html>"))
    (tmp_path / "list.txt").write_text(f"\n{tmp_path}/a.arc\n\nfile://{tmp_path}/none.warc.gz\n")
    rows = webarchive.read_listed(webarchive.archive_list(spark, str(tmp_path / "list.txt"))).collect()
    assert sorted((r.archive_name, r.record_type) for r in rows) == [("a.arc", "failed record"), ("a.arc", "response"), ("none.warc.gz", "failed download")]


def test_charsets(spark):
    text = "<meta charset='{}'>café"
    cases = [text.format("x").encode(), b"\xef\xbb\xbf" + text.format("y").encode(), text.format("iso-8859-1").encode("latin-1"), "<b>café".encode("utf-16")]
    rows = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(cases)], "i int, payload binary")
    assert all(r.t.endswith("café") for r in rows.select(archives.page_text(F.col("payload")).alias("t")).collect())
