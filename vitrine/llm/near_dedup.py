"""Near-duplicate documents by HyperMinHash.

The distinct word shingles of a whole text fall into BANDS * ROWS buckets; of each bucket's smallest hash the number of
leading zeros and MANTISSA bits are kept, 2 bytes a register. Bands of ROWS registers are the candidates' keys: at a
Jaccard similarity of 0.8 a large pair misses all bands with a probability of 1e-5 to 1e-7. Sets under SMALL shingles
have, by size class, more bands than they can differ in; pairs with a set under TINY meet exactly, in two shingles of
their prefixes. Before a pair is confirmed on the full sets, the registers' estimate, corrected for chance collisions,
must be within six standard deviations. Of pairs that meet in a band, those whose sets are certainly or by six standard
deviations unlike by 256 bits of their shingles and registers are discarded in the join, since the pairs of strangers that meet
grow with the square of the input.

Equal sets are one node from the start, however many documents hold them. Every node is first compared with one head:
of the heads of its bands the one it shares most bands with. A band's head is the node whose bands are the fullest, so
the original from which thousands of copies were made is their head, and not any one of the copies, which are less
like each other. Confirmed links are joined into components; then only pairs of a band that are still in different
components are compared. So a group of thousands of near copies costs about a comparison each, and no link that would
join two components is left out. Components are found with distributed edges; every step's result is written to the
shared folder.

Defined results: texts without words (null, empty) are linked with nothing; a text with fewer words than a shingle is
one shingle; a null id is never the smallest id of a component, and a component of null ids only has a null id and is
kept; rows that repeat id and text are kept together, but deduplicated leaves one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import discard, doc_key, materialize
from vitrine.llm.components import components
from vitrine.llm.shingles import mixed, shingle_set, words_of

BANDS, ROWS, MANTISSA = 40, 5, 10
SMALL, STEP, TINY = 160, 1.25, 40
REGISTERS, PLACES = BANDS * ROWS, 128
BLOCK = 16 << 20
BITS = ("taken0", "taken1", "low0", "low1")
#: Chance that two different minima of a bucket get the same register.
COLLISION = 2.0**-MANTISSA
_ODD = np.random.default_rng(7).integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)


def registers(shingles: np.ndarray) -> np.ndarray:
    """REGISTERS numbers of 16 bits; 0 is an empty bucket."""
    out = np.zeros(REGISTERS, np.uint16)
    if len(shingles):
        bucket = ((shingles >> np.uint64(48)) * np.uint64(REGISTERS)) >> np.uint64(16)
        first = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))  # sorted: the first of a bucket is its smallest
        rest = shingles[first] & np.uint64((1 << 48) - 1)
        part, exponent = np.frexp(rest.astype(np.float64))
        mantissa = np.where(rest > 0, (part * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
        out[bucket[first].astype(np.int64)] = ((48 - exponent) << MANTISSA) + mantissa + 1
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows of registers, and the number of buckets they rest on."""
    used = ((a != 0) | (b != 0)).sum(1)
    share = ((a == b) & (a != 0)).sum(1) / np.maximum(used, 1)
    return np.clip((share - COLLISION) / (1 - COLLISION), 0, 1), used


def _bits(shingles: np.ndarray, registers: np.ndarray) -> np.ndarray:
    """The PLACES places that shingles take, and the lowest bits of the first PLACES registers: four numbers of 64 bits."""
    taken = np.zeros(PLACES, bool)
    taken[(shingles & np.uint64(PLACES - 1)).astype(np.int64)] = True
    return np.packbits(np.concatenate([taken, (registers[:PLACES] & 1).astype(bool)])).view(np.int64)


def _prefix(shingles: np.ndarray, percent: int) -> bytes | None:
    """Of a set that may be alike to one under TINY, the smallest hashes: two alike sets have two of these in common."""
    n = len(shingles)
    return shingles[: n - -(-n * percent // 100) + 2].tobytes() if n * percent < TINY * 100 else None


def _signed(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, keys, regs, prefixes, bits = [], [], [], [], []
            for words in words_of([t or b"" for t in b.column("text").to_pylist()]):
                s = shingle_set(words, n)
                sizes.append(len(s))
                keys.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                own = registers(s)
                regs.append(own.tobytes() if len(s) else None)
                prefixes.append(_prefix(s, percent))
                bits.append(_bits(s, own))
            columns = [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary()), pa.array(prefixes, pa.binary()), *map(pa.array, np.array(bits, np.int64).reshape(-1, len(BITS)).T.copy())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("doc_key"), *columns], names=["doc_id", "doc_key", "n_shingles", "set_key", "registers", "prefix", *BITS])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _small_bands(size_class: int) -> int:
    """More bands than two similar sets of this class or the next can differ in elements, so one band is untouched."""
    return min(BANDS, int(2 * STEP ** (size_class + 2) / 9) + 2)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band keys of sets (id, n, registers, prefix).

    Sets of SMALL or more shingles have BANDS bands of ROWS registers; bands with fewer than 2 or 3 used registers say
    too little and are left out. Sets from TINY to 1.25 * SMALL have bands by size class (their own and the next), as
    few as the similarity allows, so that each holds several shingles. Sets with a prefix have a key for every two of
    its hashes.
    """
    for b in batches:
        if not b.num_rows:
            continue
        ids, sizes, regs = b.column("id").to_numpy(), b.column("n").to_numpy(), _matrix(b.column("registers"))
        keys, owners = [], []
        large = np.flatnonzero(sizes >= SMALL)
        cut = regs[large].reshape(-1, BANDS, ROWS)
        hashed = mixed((cut.astype(np.uint64) * _ODD[:ROWS]).sum(2, dtype=np.uint64) + mixed(np.arange(BANDS, dtype=np.uint64)))
        row, band = np.nonzero((cut != 0).sum(2) >= np.where(sizes[large] < 2 * SMALL, 2, 3)[:, None])
        keys.append(hashed[row, band])
        owners.append(ids[large][row])
        small = np.flatnonzero((sizes >= TINY) & (sizes < STEP * SMALL))
        own = np.floor(np.log(sizes[small]) / np.log(STEP) + 1e-9).astype(int)
        for shift in (0, 1):
            for size_class in np.unique(own) + shift:
                rows = small[own + shift == size_class]
                starts = -(-np.arange(_small_bands(size_class)) * REGISTERS // _small_bands(size_class))
                hashed = np.add.reduceat(regs[rows].astype(np.uint64) * _ODD, starts, axis=1, dtype=np.uint64)
                used = np.add.reduceat((regs[rows] != 0).astype(np.int64), starts, axis=1)
                hashed = mixed(hashed + mixed(np.uint64(1000 + 100 * int(size_class)) + np.arange(len(starts), dtype=np.uint64)))
                row, band = np.nonzero(used)
                keys.append(hashed[row, band])
                owners.append(ids[rows][row])
        for i, prefix in zip(ids, b.column("prefix").to_pylist()):
            if prefix:
                hashes = np.frombuffer(prefix, np.uint64)
                x, y = np.triu_indices(len(hashes), 1)
                keys.append(mixed(hashes[x] * _ODD[0] + hashes[y] * _ODD[1]))
                owners.append(np.full(len(x), i))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))], names=["band", "id"])


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                j, used = estimate(_matrix(b.column("regs_a")), _matrix(b.column("regs_b")))
                t = percent / 100
                yield b.select(["a", "b"]).filter(pa.array(j >= t - 6 * np.sqrt(t * (1 - t) / np.maximum(used, 1)) - COLLISION))

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirmed_in_block(percent: int):
    """Of one block's pairs and sets, the pairs that are alike."""

    def run(key, pairs, sets):
        full = {i: np.frombuffer(x, np.uint64) for i, x in zip(sets.column("id").to_pylist(), sets.column("full").to_pylist())}
        keep = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            both = np.concatenate([full[a], full[b]])
            both.sort(kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(both) - shared))
        return pairs.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _full(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, s.tobytes()) for i, key, words in zip(b.column("id").to_pylist(), b.column("set_key").to_pylist(), words_of(b.column("text").to_pylist())) if hashlib.md5((s := shingle_set(words, n)).tobytes()).digest() == key]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["id", "full"])

    return run


def _headed(shared: DataFrame) -> DataFrame:
    """(a, b) of ids: for each node b the head a that it shares most bands with. shared: band, id, n, k, with the sizes of set and band."""
    mass = shared.groupBy("id").agg(F.sum("k").alias("mass"))
    heads = shared.join(mass, "id").groupBy("band").agg(F.max(F.struct("mass", (-F.col("id")).alias("head"), "n")).alias("h"))
    heads = heads.select("band", (-F.col("h.head")).alias("head"), F.col("h.n").alias("n_head"))
    met = shared.join(heads, "band").filter("id <> head").groupBy("id", "head").agg(F.count(F.lit(1)).alias("common"), F.first("n").alias("n"), F.first("n_head").alias("n_head"))
    return met.groupBy(F.col("id").alias("b")).agg(F.max_by("head", F.struct("common", "head")).alias("a"), F.max_by("n_head", F.struct("common", "head")).alias("n_a"), F.first("n").alias("n_b"))


def _alike_sizes(percent: int) -> Column:
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _alike_bits(percent: int) -> Column:
    """Whether two sets can be alike by their bits.

    An element that only one of them has changes one place at most, so no more places differ than elements may.
    Alike sets have equal registers but for a share of 1 - t, and half of those differ in their lowest bits.
    """
    differ = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    q = (1 - percent / 100) / 2
    low = PLACES * q + 6 * np.sqrt(PLACES * q * (1 - q))
    return ((100 + percent) * (differ("taken0") + differ("taken1")) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))) & (differ("low0") + differ("low1") <= int(low) + 1)


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """Per row: doc_id, doc_key, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id)."""
    rows = docs.select("doc_id", doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = materialize(rows.mapInArrow(_signed(words, percent), f"doc_id {kind}, doc_key binary, n_shingles long, set_key binary, registers binary, prefix binary, {', '.join(f'{c} long' for c in BITS)}"), "signed")
    first = [F.first(c).alias(a) for c, a in (("n_shingles", "n"), ("registers", "registers"), ("prefix", "prefix"), *zip(BITS, BITS))]
    sets = signed.filter("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.min_by("doc_key", F.struct(F.col("doc_id").isNull(), "doc_id", "doc_key")).alias("doc_key"), *first)
    sets = materialize(sets.withColumn("id", F.monotonically_increasing_id()), "sets")  # written once, so the ids stay
    bands = sets.select("id", "n", "registers", "prefix").mapInArrow(_banded, "band long, id long")
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    shared = materialize(bands.join(sizes, "band").join(sets.select("id", "n"), "id"), "bands")

    def full_sets(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        wanted = sets.select("id", "set_key", F.col("doc_key").alias("wanted_key")).join(wanted, "id", "left_semi")
        texts = rows.select("doc_key", "text").join(wanted, F.col("doc_key") == F.col("wanted_key")).select("id", "set_key", "text")
        return materialize(texts.mapInArrow(_full(words), "id long, full binary").dropDuplicates(["id"]), "full")

    def verified_in_blocks(pairs: DataFrame) -> DataFrame:
        """The alike pairs of (a, b, band). A bucket of bands gets each of its sets once, however many pairs the set is in.

        A bucket whose sets exceed BLOCK bytes is split into blocks of pairs of parts.
        """
        full = full_sets(pairs)
        members = pairs.select("band", F.explode(F.array("a", "b")).alias("id")).join(full.select("id", F.length("full").alias("size")), "id")
        total = members.distinct().agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * total // BLOCK + 1)
        bucket = F.pmod(F.xxhash64("band"), F.lit(buckets)).alias("bucket")
        members = members.select(bucket, "id", "size").distinct()
        parts = members.groupBy("bucket").agg(F.ceil(F.sum("size") / F.lit(BLOCK)).cast("int").alias("parts"))
        part = lambda c: F.pmod(F.xxhash64(c), F.col("parts")).cast("int")
        block = lambda x, y: (F.least(x, y).alias("low"), F.greatest(x, y).alias("high"))
        placed = members.select("bucket", "id").join(parts, "bucket").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        held = placed.select("bucket", "id", *block(part("id"), F.col("other"))).distinct().join(full, "id")
        asked = pairs.select("a", "b", bucket).join(parts, "bucket").select("a", "b", "bucket", *block(part("a"), part("b")))
        keys = ("bucket", "low", "high")
        links = materialize(asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_confirmed_in_block(percent), "a long, b long"), "links")
        discard(full)
        return links

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda x: sets.select(F.col("id").alias(x), F.col("registers").alias(f"regs_{x}"))
        seen = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "regs_a", "regs_b")
        likely = materialize(seen.mapInArrow(_likely(percent), "a long, b long"), "likely")
        full = full_sets(likely)
        side = lambda x: full.select(F.col("id").alias(x), F.col("full").alias(f"set_{x}"))
        links = materialize(likely.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b").mapInArrow(_confirmed(percent), "a long, b long"), "links")
        discard(likely, full)
        return links

    first_pairs = materialize(_headed(shared).filter(_alike_sizes(percent)).select("a", "b"), "headed")
    links = verified(first_pairs)
    roots = components(links)
    placed = shared.select("band", "id", "n").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed_bands = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("band")
    open_rows = materialize(placed.join(mixed_bands, "band", "left_semi").join(sets.select("id", *BITS), "id").select("band", "id", "n", "root", *BITS), "open")
    a, b = (open_rows.withColumnsRenamed({c: f"{c}_{x}" for c in ("n", "root", *BITS)} | {"id": x}) for x in "ab")
    left = a.join(b, "band").filter((F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & _alike_sizes(percent) & _alike_bits(percent)).groupBy("a", "b").agg(F.min("band").alias("band"))
    done = first_pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = materialize(left.join(done, ["a", "b"], "left_anti"), "left")
    if not left.isEmpty():
        more = verified_in_blocks(left)
        roots = components(links.union(more))
        discard(more)
    discard(shared, open_rows, left, first_pairs, links)
    roots = sets.select("id", "set_key", "doc_id").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    lowest = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = materialize(roots.join(lowest, "root").select("set_key", "component_id"), "components")
    discard(sets)
    out = signed.select("doc_id", "doc_key", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "doc_key", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each group of near duplicates, and one row of those that repeat id and text."""
    found = near_duplicates(docs, words, percent)
    gone = materialize(found.filter("not kept").select(F.col("doc_key").alias("gone")).distinct(), "gone")
    twice = materialize(found.filter("kept").groupBy(F.col("doc_key").alias("twice")).count().filter("count > 1").select("twice"), "twice")
    key = doc_key(docs["doc_id"], docs["text"])
    kept = docs.join(gone, key == gone["gone"], "left_anti")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, key == twice["twice"], "left_anti")
    return once.unionByName(kept.join(twice, key == twice["twice"], "left_semi").dropDuplicates(["doc_id", "text"]))
