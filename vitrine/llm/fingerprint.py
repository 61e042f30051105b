"""Document fingerprints: invertible Bloom lookup sketches over paragraph digests.

A text's paragraphs are its lines, long ones cut at sentence ends into passages of some PASSAGE characters; its set of
paragraphs is hashed to 64 bits each. A sketch has CELLS cells in three parts; every digest adds 1, itself and a check
to one cell in each part. Sketches subtract: what two versions share cancels, and peeling the cells that hold a single
digest recovers the digests on either side. Where peeling stops early, that group of digests is spread over SPREAD
sketches by other hash bits (a larger sketch for it), up to RETRIES times; what is still stuck (a repeated
collision) is counted by the difference of the sets. Likeness is 1 - differing / all digests, 1 for two empty texts.

Everything is DataFrame expressions. A text's digests are spread over groups of about PER_GROUP before they are
sketched, so work is linear in the text's length.

Defined results: a null text counts as empty; empty texts have no paragraph and equal fingerprints; of rows with the
same id the one with the smaller md5 of the text is first, and rows with null ids are last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PASSAGE, CELLS, PER_GROUP, SPREAD, RETRIES, PER_BUCKET, QUANTILES = 120, 24, 8, 4, 2, 2000, 256
PART = CELLS // 3


def paragraphs(text: Column) -> Column:
    """Distinct paragraph digests of a text (array of long)."""
    cut = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"[^\n]{{{PASSAGE},}}?[.!?](?=\s)|[^\n]+"), F.lit(0))
    return F.array_distinct(F.transform(cut, lambda p: F.xxhash64(p)))


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(91)).bitwiseAND(F.lit(0xFFFFFFFF))


def cell_of(digest: Column, part: int) -> Column:
    return (F.pmod(F.shiftright(digest, 16 * part), F.lit(PART)) + PART * part).cast("int")


def _marked(digests: Column, sign: Column | int) -> Column:
    sign = F.lit(sign).cast("long") if isinstance(sign, int) else sign
    return F.transform(digests, lambda d: F.struct(sign.alias("n"), d.alias("d"), check(d).alias("h"), cell_of(d, 0).alias("a"), cell_of(d, 1).alias("b"), cell_of(d, 2).alias("c")))


def sketch(marked: Column) -> Column:
    """CELLS cells (n, d, h) of signed digests: counts, sums of digests (xor) and sums of checks (xor)."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("h"))

    def cell(i: Column) -> Column:
        return F.aggregate(F.filter(marked, lambda u: (u["a"] == i) | (u["b"] == i) | (u["c"] == i)), zero, lambda s, u: F.struct((s["n"] + u["n"]).alias("n"), s["d"].bitwiseXOR(u["d"]).alias("d"), s["h"].bitwiseXOR(u["h"]).alias("h")))

    return F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), cell)


def encoded(cells: Column) -> Column:
    """A sketch as text: count, digest and check of each cell in hexadecimal."""
    return F.array_join(F.transform(cells, lambda c: F.concat(F.lower(F.hex(c["n"])), F.lit("."), F.lower(F.hex(c["d"])), F.lit("."), F.lower(F.hex(c["h"])))), ":")


def fingerprint(text: Column) -> Column:
    return encoded(sketch(_marked(paragraphs(text), 1)))


def peel(cells: Column, steps: Column) -> Column:
    """(cells, plus, minus): what is left of the cells, and the digests recovered on either side.

    Each step peels one digest; steps must be the number of digests or more.
    """
    longs = "array<bigint>"
    start = F.struct(cells.alias("cells"), F.array().cast(longs).alias("plus"), F.array().cast(longs).alias("minus"))

    def step(s: Column, _: Column) -> Column:
        pure = F.filter(s["cells"], lambda c: ((c["n"] == 1) | (c["n"] == -1)) & (c["h"] == check(c["d"])))
        return F.when(F.size(pure) == 0, s).otherwise(F.transform(F.slice(pure, 1, 1), lambda p: _without(s, p))[0])

    return F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, step)


def _without(s: Column, p: Column) -> Column:
    d = p["d"]

    def clear(c: Column, i: Column) -> Column:
        own = (i == cell_of(d, 0)) | (i == cell_of(d, 1)) | (i == cell_of(d, 2))
        return F.when(own, F.struct((c["n"] - p["n"]).alias("n"), c["d"].bitwiseXOR(d).alias("d"), c["h"].bitwiseXOR(p["h"]).alias("h"))).otherwise(c)

    one = F.array(d)
    return F.struct(F.transform(s["cells"], clear).alias("cells"), F.when(p["n"] > 0, F.concat(s["plus"], one)).otherwise(s["plus"]).alias("plus"), F.when(p["n"] < 0, F.concat(s["minus"], one)).otherwise(s["minus"]).alias("minus"))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _peeled(units: Column) -> Column:
    """plus, minus and whether the peeling got stuck."""

    def outcome(p: Column) -> Column:
        stuck = F.exists(p["cells"], lambda c: (c["n"] != 0) | (c["d"] != 0) | (c["h"] != 0))
        return F.struct(p["plus"].alias("plus"), p["minus"].alias("minus"), stuck.alias("stuck"))

    return _let(peel(sketch(units), F.size(units)), outcome)


def _spread(units: Column, parts: int) -> Column:
    """As _peeled, with `parts` sketches."""
    each = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: _peeled(F.filter(units, lambda u: F.pmod(F.xxhash64(u["d"], F.lit(parts)), F.lit(parts)) == i)))
    return _let(each, lambda e: F.struct(F.flatten(F.transform(e, lambda x: x["plus"])).alias("plus"), F.flatten(F.transform(e, lambda x: x["minus"])).alias("minus"), F.exists(e, lambda x: x["stuck"]).alias("stuck")))


def recovered(units: Column) -> Column:
    """(plus, minus): the digests only on the left and only on the right, of signed digests (array of n, d, h, a, b, c)."""

    def side(n: int) -> Column:
        return F.transform(F.filter(units, lambda u: u["n"] == n), lambda u: u["d"])

    out = F.struct(F.array_except(side(1), side(-1)).alias("plus"), F.array_except(side(-1), side(1)).alias("minus"), F.lit(False).alias("stuck"))
    for parts in [SPREAD**r for r in range(RETRIES, 0, -1)] + [1]:
        tried = _spread(units, parts) if parts > 1 else _peeled(units)
        out = _let(tried, _unless_stuck(out))
    return out


def _unless_stuck(instead: Column):
    return lambda tried: F.when(tried["stuck"], instead).otherwise(tried)


def n_groups(left: Column, right: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil((F.size(left) + F.size(right)) / F.lit(PER_GROUP))).cast("int")


def signed(left: Column, right: Column) -> Column:
    return F.concat(_marked(left, 1), _marked(right, -1))


def group_of(digest: Column, groups: Column) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(7)), groups).cast("int")


def differences(pairs: DataFrame, key: list[str], left: str, right: str) -> DataFrame:
    """For pairs of digest sets (unique by key): key, plus and minus, the digests only on the left and only on the right."""
    units = pairs.select(*key, n_groups(F.col(left), F.col(right)).alias("groups"), F.explode(signed(F.col(left), F.col(right))).alias("u"))
    grouped = units.groupBy(*key, group_of(F.col("u.d"), F.col("groups")).alias("group")).agg(F.collect_list("u").alias("units"))
    found = grouped.select(*key, recovered(F.col("units")).alias("r"))
    return found.groupBy(*key).agg(F.flatten(F.collect_list("r.plus")).alias("plus"), F.flatten(F.collect_list("r.minus")).alias("minus"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, digests (of its paragraphs), next (text and digests of the next row), and the row's key: bucket and row.

    Rows are in order of doc_id (null last), then of their text's md5; after the last comes the first. They are put in
    buckets of consecutive ids, so that a row's next is in its bucket or is the first of the next bucket: QUANTILES of the
    ids, and between two of them some PER_BUCKET rows each, if the ids are spread evenly there. Texts are shuffled once.
    """
    n, edges = docs.agg(F.count(F.lit(1)), F.percentile_approx("doc_id", [i / QUANTILES for i in range(QUANTILES + 1)], 20 * QUANTILES)).first()
    edges = sorted(set(edges or [0]))
    within = max(1, n // (len(edges) * PER_BUCKET))
    bucket = F.coalesce(_bucket(F.col("doc_id"), edges, within), F.lit(len(edges) * within)).cast("long")
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), bucket.alias("bucket"))
    order = [F.col("doc_id").asc_nulls_last(), F.md5("text")]
    run = Window.partitionBy("bucket").orderBy(*order)
    rows = rows.repartition("bucket").withColumn("digests", paragraphs(F.col("text")))
    rows = rows.withColumn("next", F.lead(F.struct("text", "digests")).over(run)).withColumn("row", F.row_number().over(run))
    ids = docs.select(bucket.alias("bucket")).distinct()
    wrap = Window.partitionBy()
    along = Window.orderBy("bucket")
    ids = ids.select(F.col("bucket").alias("last_of"), F.coalesce(F.lead("bucket").over(along), F.min("bucket").over(wrap)).alias("first_of"))
    first = docs.groupBy(bucket.alias("first_of")).agg(F.min_by(F.coalesce("text", F.lit("")), F.struct(F.col("doc_id").isNull(), "doc_id", F.md5(F.coalesce("text", F.lit(""))))).alias("first_text"))
    edge = ids.join(first, "first_of").select("last_of", F.struct(F.col("first_text").alias("text"), paragraphs(F.col("first_text")).alias("digests")).alias("edge"))
    rows = rows.join(edge, (rows["bucket"] == edge["last_of"]) & rows["next"].isNull(), "left")
    return rows.select("bucket", "row", "doc_id", "text", "digests", F.coalesce("next", "edge").alias("next"))


def _bucket(doc_id: Column, edges: list[int], within: int) -> Column:
    """Number of a row's bucket, never falling as the id rises; ids before the first edge are with those at it."""

    def place(low: int, high: int) -> Column:
        if high - low == 1:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(doc_id < F.lit(edges[mid]), place(low, mid)).otherwise(place(mid, high))

    starts = F.array(*[F.lit(float(e)) for e in edges])
    steps = F.array(*[F.lit(max(1.0, float(b) - float(a))) for a, b in zip(edges, [*edges[1:], edges[-1]])])
    at = F.when(doc_id.isNotNull(), place(0, len(edges)))
    share = (doc_id.cast("double") - F.get(starts, at)) / F.get(steps, at)
    return at * within + F.least(F.lit(within - 1), F.greatest(F.lit(0), F.floor(share * within)))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Per row: fingerprints of its text and of the text whose last quarter is the beginning of the next row's text, and their likeness.

    The paragraphs' digests of both comparisons are grouped, sketched, subtracted and peeled in the tasks that hold the
    rows; nothing else is shuffled. What the row itself returns travels along as one more element.
    """
    n_chars = F.length("text")
    taken = F.floor(n_chars / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 4) as int))"), F.expr("substring(next.text, 1, cast(floor(length(text) / 4) as int))"))
    rows = with_next(docs).withColumn("edited", F.when(taken > 0, edited).otherwise(F.col("text")))
    rows = rows.select("bucket", "row", "doc_id", n_chars.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "digests", paragraphs(F.col("edited")).alias("changed"), F.col("next.digests").alias("following"))
    own = F.struct("doc_id", "n_chars", "edited_sha256", encoded(sketch(_marked(F.col("digests"), 1))).alias("fingerprint"), encoded(sketch(_marked(F.col("changed"), 1))).alias("edited_fingerprint"), F.size("digests").alias("n"), F.size("changed").alias("n_changed"), F.size("following").alias("n_following"))
    rows = rows.select("bucket", "row", own.alias("own"), "digests", "changed", "following")
    nothing = F.lit(None).cast(rows.schema["own"].dataType)
    unit = F.lit(None).cast("struct<n:bigint,d:bigint,h:bigint,a:int,b:int,c:int>")

    def parts(kind: int, other: str) -> Column:
        left, right = F.col("digests"), F.col(other)
        return F.transform(signed(left, right), lambda u: F.struct(F.lit(kind).alias("kind"), group_of(u["d"], n_groups(left, right)).alias("group"), u.alias("u"), nothing.alias("own")))

    each = F.concat(F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).alias("group"), unit.alias("u"), F.col("own").alias("own"))), parts(1, "changed"), parts(2, "following"))
    units = rows.select("bucket", "row", F.explode(each).alias("e")).select("bucket", "row", "e.*")
    grouped = units.groupBy("bucket", "row", "kind", "group").agg(F.collect_list("u").alias("units"), F.first("own", ignorenulls=True).alias("own"))
    differ = F.when(F.col("kind") > 0, _let(recovered(F.col("units")), lambda r: F.size(r["plus"]) + F.size(r["minus"])))
    sums = grouped.withColumn("differ", differ).groupBy("bucket", "row").agg(F.first("own", ignorenulls=True).alias("own"), *[F.sum(F.when(F.col("kind") == k, F.col("differ"))).alias(f"differ_{k}") for k in (1, 2)])

    def likeness(k: int, n: str) -> Column:
        both = F.col("own.n") + F.col(f"own.{n}")
        return F.when(both == 0, 1.0).otherwise(1 - F.coalesce(f"differ_{k}", F.lit(0)) / both)

    return sums.select(*[f"own.{c}" for c in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")], likeness(1, "n_changed").alias("near_edited"), likeness(2, "n_following").alias("near_next"), F.col("own.n").cast("long").alias("n_paragraphs"))
