"""As-of match of references to the nearest capture, by windows: one sort per key, no range join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.time import magnitude, span_seconds


def nearest(refs: DataFrame, times: DataFrame, key: str, nearest_by_duration: bool = False) -> DataFrame:
    """refs with before, after and matched, the captures' times around page_ts and the one chosen.

    times has key and ts. The earlier capture is chosen unless the later is nearer, by the first differing field of
    the dates, or by duration. References of a key without captures are dropped.
    """
    null = F.lit(None)
    cols = refs.columns
    rows = refs.withColumn("at", F.col("page_ts")).withColumn("capture_ts", null.cast("timestamp_ntz")).withColumn("is_ref", F.lit(1))
    marks = times.select(key, F.col("ts").alias("at"), F.col("ts").alias("capture_ts")).distinct()
    both = rows.unionByName(marks.withColumn("is_ref", F.lit(0)), allowMissingColumns=True)
    upto = lambda at: Window.partitionBy(key).orderBy(at).rangeBetween(Window.unboundedPreceding, 0)  # noqa: E731  running frames, either way
    both = both.withColumn("before", F.max("capture_ts").over(upto(F.col("at")))).withColumn("after", F.min("capture_ts").over(upto(F.col("at").desc())))
    if nearest_by_duration:
        later = span_seconds(F.col("page_ts"), F.col("after")) < span_seconds(F.col("before"), F.col("page_ts"))
    else:
        later = F.abs(magnitude(F.col("page_ts"), F.col("after"))) < F.abs(magnitude(F.col("page_ts"), F.col("before")))
    matched = F.when(F.col("before").isNull(), F.col("after")).when(F.col("after").isNull(), F.col("before")).when(later, F.col("after")).otherwise(F.col("before"))
    return both.filter("is_ref = 1").withColumn("matched", matched).filter("matched is not null").select(*cols, "before", "after", "matched")
