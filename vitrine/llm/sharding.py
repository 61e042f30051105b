"""Balanced sharding by Karmarkar-Karp differencing.

Rows of equal text are one indivisible group. Differencing combines, again and again, the two partial partitions with
the largest spread, oppositely ordered. It runs within bins of some thousand groups, one bin per task; every bin then
is one item of k sums, and the bins are combined by the same method, level upon level, until one is left. So no task
holds more than `per_bin` items or so, and what one bin leaves uneven the next level evens out.

Defined results: a null text counts as the empty text (size 1); rows that repeat id and text keep a slot each; a group
larger than a shard's share stays whole; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import discard, drop_clashing, materialize

PER_BIN, PER_SLOT_TASK = 20_000, 100_000


def difference(items: Sequence[Sequence[int]], k: int) -> list[list[int]]:
    """For items of k sums each, the places of each item's sums in the combined partition."""
    heap = []
    kids: list[tuple] = []
    for i, sums in enumerate(items):
        order = sorted(range(k), key=lambda j: (-sums[j], j))
        ranked = [sums[j] for j in order]
        kids.append((order,))
        heap.append((ranked[-1] - ranked[0], i, ranked))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        sums = [x[j] + y[k - 1 - j] for j in range(k)]
        order = sorted(range(k), key=lambda j: (-sums[j], j))
        ranked = [sums[j] for j in order]
        kids.append((order, a, b))
        heapq.heappush(heap, (ranked[-1] - ranked[0], len(kids) - 1, ranked))
    places: list[list[int]] = [[] for _ in items]
    stack = [(heap[0][1], list(range(k)))] if heap else []
    while stack:  # at: the final place of each of the node's ranked sums
        node, at = stack.pop()
        order = kids[node][0]
        own = [0] * k
        for rank, j in enumerate(order):
            own[j] = at[rank]
        if len(kids[node]) == 1:
            places[node] = own
        else:
            stack.append((kids[node][1], own))
            stack.append((kids[node][2], own[::-1]))
    return places


def _label_groups(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(digest=pdf["digest"].map(bytes)).sort_values(["size", "digest"], ascending=[False, True], kind="stable")
        pad = [0] * (k - 1)
        places = difference([[int(s), *pad] for s in pdf["size"]], k)
        return pd.DataFrame({"digest": pdf["digest"].to_numpy(), "size": pdf["size"].to_numpy(), "bin": pdf["bin"].to_numpy(), "label": [p[0] for p in places]})

    return run


def _label_bins(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = {b: [0] * k for b in sorted(pdf["item"].unique())}
        for item, label, size in zip(pdf["item"], pdf["label"], pdf["size"]):
            sums[item][int(label)] += int(size)
        top = int(pdf["bin"].iloc[0])
        rows = [(item, j, top, place[j], s[j]) for (item, s), place in zip(sums.items(), difference(list(sums.values()), k)) for j in range(k)]
        return pd.DataFrame(rows, columns=["item", "label", "bin", "new_label", "size"])

    return run


def shard_groups(groups: DataFrame, k: int, per_bin: int = PER_BIN) -> DataFrame:
    """groups (digest, size), each digest once -> (digest, shard)."""
    bins = max(1, -(-groups.count() // per_bin))
    binned = groups.withColumn("bin", F.pmod(F.xxhash64("digest", F.lit(11)), F.lit(bins)))
    out = materialize(binned.groupBy("bin").applyInPandas(_label_groups(k), "digest binary, size long, bin long, label int"), "shard")
    while bins > 1:
        sums = out.groupBy(F.col("bin").alias("item"), "label").agg(F.sum("size").alias("size"))
        bins = -(-bins // per_bin)
        sums = sums.withColumn("bin", F.pmod("item", F.lit(bins)))
        moved = sums.groupBy("bin").applyInPandas(_label_bins(k), "item long, label int, bin long, new_label int, size long")
        moved = moved.select(F.col("item"), F.col("label").alias("old"), F.col("bin").alias("top"), "new_label")
        out = materialize(out.join(moved, (out["bin"] == moved["item"]) & (out["label"] == moved["old"])).select("digest", "size", F.col("top").alias("bin"), F.col("new_label").alias("label")), "shard")
    return out.select("digest", F.col("label").alias("shard"))


def shard(docs: DataFrame, k: int = 8, per_bin: int = PER_BIN, keep: Iterable[str] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs with size (bytes of the text, plus 1), text_crc32, shard (0 to k - 1) and slot (gapless in its shard)."""
    keep = list(keep)
    docs = drop_clashing(docs, *[c for c in ("size", "text_crc32", "shard", "slot", "digest", "row_key", "cell", "before") if c not in keep])
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("digest"), F.col("doc_id").alias("row_key"))
    slim = rows if {"text"} & set(keep) else materialize(rows, "shard-rows")
    groups = materialize(slim.groupBy("digest").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")), "shard-groups")
    shards = shard_groups(groups.select("digest", "size"), k, per_bin)
    cells = max(1, -(-(groups.agg(F.sum("rows")).first()[0] or 0) // PER_SLOT_TASK))
    placed = slim.join(shards, "digest").withColumn("cell", F.pmod(F.xxhash64("row_key", "digest"), F.lit(cells)))
    placed = placed if slim is rows else materialize(placed, "shard-placed")
    counts = placed.groupBy("shard", "cell").count()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("shard", "cell").orderBy(F.col("row_key").asc_nulls_last(), "digest")
    slots = placed.withColumn("row", F.row_number().over(within)).join(starts, ["shard", "cell"])
    return slots.select(*keep, "size", "text_crc32", "shard", (F.col("before") + F.col("row") - 1).alias("slot"))
