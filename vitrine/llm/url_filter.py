"""URL filtering by hashed host-suffix and path-prefix expressions.

A rule is a host and the beginning of a path; it fits its host and all subdomains. Every URL is expanded into the
expressions host suffix + path prefix that have the shape (number of labels, path length) of some rule. They meet the
rules in an equi-join on the first 32 bits of their SHA-256; the full digest then confirms the match, and the longest
rule wins (of equally long ones the later by code point, and block before allow).

URLs are judged once per distinct (host, beginning of the path), so a host with a third of all pages is one row when
it meets the rules. The rules are spread over salts in case the join has to shuffle.

Defined results: a null URL, or one without "://", has an empty host and path, which no rule fits; a host counts with
its port or user as written; a path may be empty; repeated rows are judged alike; without rules all get the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import ascii_lower, drop_clashing

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Shapes are gathered on the driver; a rule list with more is refused.
MOST_SHAPES, SALTS = 10_000, 8


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, rule_host string, rule_path string")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return ascii_lower(host), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages with host, path, rule (host and path of the rule that decides, else null) and verdict."""
    pages = drop_clashing(pages, "host", "path", "rule", "verdict")
    host, path = split_url(F.col("url"))
    rules = rules.filter("rule_host is not null and rule_path is not null").withColumn("rule_host", ascii_lower(F.col("rule_host")))
    labels = F.size(F.split("rule_host", r"\.")).alias("labels")
    shapes = [tuple(r) for r in rules.select(labels, F.length("rule_path").alias("chars")).distinct().limit(MOST_SHAPES + 1).collect()]
    if len(shapes) > MOST_SHAPES:
        raise ValueError(f"the rules have more than {MOST_SHAPES} shapes")
    judged = pages.withColumns({"host": host, "path": path})
    if not shapes:
        return judged.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    longest = max(c for _, c in shapes)
    judged = judged.withColumn("url_key", F.substring("path", 1, longest))
    keys = judged.select("host", "url_key").distinct().withColumnsRenamed({"host": "key_host", "url_key": "key_path"})
    parts = F.split("key_host", r"\.")

    def expression(labels: int, chars: int) -> Column:
        suffix = F.concat_ws(".", F.slice(parts, -labels, labels))
        return F.when((F.size(parts) >= labels) & (F.length("key_path") >= chars), _digest(suffix, F.substring("key_path", 1, chars)))

    digests = F.array_compact(F.array(*[expression(*s) for s in sorted(shapes)]))
    expanded = keys.withColumn("full", F.explode(digests)).withColumn("short", F.substring("full", 1, 8)).withColumn("salt", F.pmod(F.xxhash64("key_host", "key_path"), F.lit(SALTS)))
    listed = rules.withColumn("rule_full", _digest(F.col("rule_host"), F.col("rule_path"))).withColumn("rule_short", F.substring("rule_full", 1, 8))
    listed = listed.withColumn("rule_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    met = expanded.join(listed, (F.col("short") == F.col("rule_short")) & (F.col("salt") == F.col("rule_salt"))).filter(F.col("full") == F.col("rule_full"))
    name = F.concat("rule_host", "rule_path")
    best = met.groupBy("key_host", "key_path").agg(F.max(F.struct(F.length(name).alias("chars"), name.alias("rule"), (F.col("verdict") == "block").alias("block"), F.col("verdict").alias("verdict"))).alias("best"))
    out = judged.join(best, (judged["host"] == best["key_host"]) & (judged["url_key"] == best["key_path"]), "left")
    return out.select(*[judged[c] for c in pages.columns], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
