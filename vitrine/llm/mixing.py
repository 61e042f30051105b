"""Mixing sources to target weights by hash-threshold histograms.

Every row has a uniform 60-bit hash. A source that is to give r times its words gives floor(r) copies of all its
rows, and one copy more of the rows whose hash is under the source's threshold. The threshold is found by histograms:
words are summed by (source, leading hash bits), the bucket in which the budget ends is refined by the next bits, and
so on to the last bit. No row is sorted and no source is collected: a hot source is summed by partial aggregation.

Defined results: a null text has size 0; a null source is a source of its own, last in order; rows of size 0 take no
words; rows that repeat id and text share one hash and are taken together; an empty table gives an empty result.
The set taken for a smaller budget is contained in the set taken for a larger one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import drop_clashing, materialize, n_words

BITS, LEVELS = 15, 4


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of md5 over id and text."""
    key = F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """(source, source_size, target): shares by weight of all words, none above `most` times its source, the excess shared again.

    One row per source is sorted in one task: by cap over weight, the capped sources are those in front for which the
    level of the rest is still above their cap.
    """
    name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), ((F.row_number().over(name) - 1) % len(weights) + 1).cast("int"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    src = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    src = src.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    src = src.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    src = src.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    capped = F.col("cap") * (F.col("weights") - F.col("weight_before")) <= (F.col("total") - F.col("cap_before")) * F.col("weight")
    src = src.withColumn("capped", capped)
    held = lambda c: F.sum(F.when(F.col("capped"), F.col(c)).otherwise(0)).over(everything)
    src = src.withColumn("rest", F.col("total") - held("cap")).withColumn("rest_weight", F.col("weights") - held("weight"))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("rest").cast("double") / F.col("rest_weight").cast("double") * F.col("weight").cast("double"))
    return src.select("source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """(source, source_size, target, copies, edge, edge_taken): rows with a hash under edge, or at it if edge_taken, give one copy more."""
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    src = source_targets(sizes, weights, most).withColumn("copies", base)
    src = src.withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    state = src.withColumns({"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long"), "at": F.lit(0).cast("long")})
    rows = sizes.withColumnRenamed("source", "row_source")
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = F.col("row_source").eqNullSafe(F.col("source")) & (F.shiftright("hash", shift + BITS) == F.col("prefix"))
        found = rows.join(state, inside).groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("bucket_size"), *[F.first(c).alias(c) for c in ("source_size", "target", "copies", "budget", "below")])
        run = Window.partitionBy("source").orderBy("bucket")
        found = found.withColumn("upto", F.col("below") + F.sum("bucket_size").over(run)).filter(F.col("upto") > F.col("budget"))
        state = found.groupBy("source", "source_size", "target", "copies", "budget").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("bucket_size")).alias("below"), "bucket_size")).alias("m"))
        state = state.select("source", "source_size", "target", "copies", "budget", F.col("m.bucket").alias("prefix"), F.col("m.below").alias("below"), F.col("m.bucket_size").alias("at"))
    nearer = (F.col("below") + F.col("at") - F.col("budget")) < (F.col("budget") - F.col("below"))
    edges = state.select(F.col("source").alias("edge_source"), F.col("prefix").alias("edge"), nearer.alias("edge_taken"))
    return src.join(edges, src["source"].eqNullSafe(edges["edge_source"]), "left").select("source", "source_size", "target", "copies", "edge", "edge_taken")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """docs with size, source_size, target, copies (how often the mix has the row) and taken (its words, repeats counted).

    Sources are put in code point order, null last, and get the weights in turn; together they get as many words as
    the table has. No source gets more than `most` times its words, so no row is taken more than `most` times.
    """
    docs = drop_clashing(docs, "size", "source_size", "target", "copies", "taken")
    sizes = materialize(docs.select("source", n_words(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("hash"), "doc_id"), "mix")
    edges = materialize(thresholds(sizes.select("source", "size", "hash"), weights, most), "mix-edges").withColumnRenamed("source", "edge_source")
    return _apply(docs.withColumns({"size": n_words(F.col("text")), "row_hash": row_hash(F.col("doc_id"), F.col("text"))}), edges, docs.columns)


def _apply(rows: DataFrame, edges: DataFrame, keep: Sequence[str]) -> DataFrame:
    more = F.coalesce((F.col("row_hash") < F.col("edge")) | ((F.col("row_hash") == F.col("edge")) & F.col("edge_taken")), F.lit(False))
    out = rows.join(edges, rows["source"].eqNullSafe(edges["edge_source"]), "left")
    copies = (F.col("copies") + more.cast("long")).alias("copies")
    return out.select(*[rows[c] for c in keep], "size", "source_size", "target", copies).withColumn("taken", F.col("copies") * F.col("size"))


def mix_sizes(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """As mix, but without the texts: reads them once, and returns doc_id, source, size, source_size, target, copies, taken."""
    sizes = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("row_hash")), "mix")
    edges = thresholds(sizes.select("source", "size", F.col("row_hash").alias("hash")), weights, most).withColumnRenamed("source", "edge_source")
    return _apply(sizes, edges, ["doc_id", "source"])


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of docs."""
    out = mix(docs, weights, most).filter(F.col("copies") > 0)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)
