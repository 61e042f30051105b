"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of a text become typed placeholders; the rest is lower-cased and stripped of punctuation.
Windows of WINDOW template words of the documents meet those of the benchmark in an equi-join on their hash. For the
pairs that share enough windows the words behind the placeholders are compared along each alignment: every value of
the item must stand for one value in the document, so a question with other parameters is caught, and a chance mix of
placeholders isn't. Everything is DataFrame expressions.

Names are capitalised words, also at the beginning of a sentence (there any word is one, on both sides); numbers are
words with a digit before any letter; units are listed words right after a number. Windows of which more than half is
placeholders say too little: they count only where the words themselves are the same. The windows of the words
themselves are joined as well, so that a copy is found whatever its capitals. A pair is reported if LEAST_WINDOWS
different windows of the item (all, if it has fewer) occur in consistent alignments, or as the words themselves. An item
shorter than a window is one window of its own length.

Defined results: null and empty texts have no windows and are clean; rows that repeat id and text are reported once;
an empty benchmark leaves all documents clean; null ids of documents and items are reported as null; items that share
an id are found each for itself, and reported once for each different number of windows or exactness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import doc_key, materialize

WINDOW, LEAST_WINDOWS = 8, 6
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
UNITS = "kg g mg lb lbs oz t km m cm mm mi ft in yd l ml cl gal km/h mph m/s s sec h hr hrs min ms hz khz mhz ghz w kw kwh v a c f k € $ £ % eur usd gbp euro euros dollar dollars cent cents pound pounds meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams kilogram kilograms liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years degree degrees percent".split()
_PLAIN = rf"[^ \p{{L}}\p{{M}}\p{{Nd}}{NAME}{NUMBER}{UNIT}]+"


def _spaced(text: Column) -> Column:
    """The text with every blank a space, and without characters that stand for placeholders."""
    text = F.coalesce(text, F.lit(""))
    for blank in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(blank), F.lit(" "))
    for mark in (NAME, NUMBER, UNIT):
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def _templated(spaced: Column) -> Column:
    """The same words between the same spaces, each a placeholder, plain, or empty."""
    units = "|".join(u.replace("$", r"\$") for u in sorted(UNITS, key=lambda u: (-len(u), u)) if any(c.isalpha() for c in u))
    t = F.regexp_replace(spaced, r"(?<![^ ])[^ \p{L}\p{Nd}]*\p{Lu}[^ ]*", NAME)
    t = F.regexp_replace(t, rf"(?<![^ ])[^ \p{{L}}\p{{Nd}}{NAME}]*\p{{Nd}}[^ ]*", NUMBER)
    t = F.regexp_replace(t, rf"(?i)(?<={NUMBER} )(?:{units})(?=[ .,;:!?)]|$)", UNIT)
    return F.regexp_replace(F.lower(t), _PLAIN, "")


def _plain(spaced: Column) -> Column:
    """The words themselves, lower-cased and stripped of punctuation."""
    return F.regexp_replace(F.lower(spaced), _PLAIN, "")


def _not_empty(words: Column) -> Column:
    return F.array_remove(words, "")


def template(text: Column) -> Column:
    """Template words of a text."""
    return _not_empty(F.split(_templated(_spaced(text)), " "))


def tokens(text: Column) -> Column:
    """Structs of template word (t), plain word (p) and word as written (raw): one list, so that places agree."""
    spaced = _spaced(text)
    each = F.arrays_zip(F.split(_templated(spaced), " ").alias("t"), F.split(_plain(spaced), " ").alias("p"), F.split(spaced, " ").alias("raw"))
    return F.filter(each, lambda w: w["t"] != "")


def _is_slot(word: Column) -> Column:
    return word.isin(NAME, NUMBER, UNIT)


def _windows(hashed: DataFrame, lengths: list[int], kind: int) -> DataFrame:
    """Hashes of the windows of so many words, by position. hashed: rows with the hashes of their words. kind: 0 template words, 1 plain words.

    The rows are taken apart before the windows are hashed, as that is compiled and an expression of a lambda isn't.
    """
    each = hashed.withColumn("length", F.explode(F.array(*[F.lit(n) for n in lengths])))
    last = F.size("hashed") - F.col("length")
    each = each.withColumn("pos", F.explode(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))))
    return each.withColumn("hash", F.xxhash64(F.col("length") + 1000 * kind, F.slice("hashed", F.col("pos") + 1, F.col("length")))).drop("hashed", "length")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_key, item_id, tokens): every different row of the benchmark with a word, under a key of its own."""
    rows = benchmark.select("item_id", "text").withColumn("tokens", tokens(F.col("text"))).filter(F.size("tokens") > 0)
    return rows.withColumn("item_key", doc_key(F.col("item_id"), F.col("text"))).dropDuplicates(["item_key"]).select("item_key", "item_id", "tokens")


def item_windows(items: DataFrame) -> DataFrame:
    """(item_key, kind, heavy, length, item_pos, hash): the windows of the items, each once per item: of template words (kind 0), if they aren't mostly placeholders, and of the words themselves (kind 1)."""
    words = items.withColumn("length", F.least(F.lit(WINDOW), F.size("tokens")))
    each = words.withColumn("item_pos", F.explode(F.sequence(F.lit(1), F.size("tokens") - F.col("length") + 1))).withColumn("window", F.slice("tokens", F.col("item_pos"), F.col("length")))
    each = each.withColumn("heavy", F.size(F.filter("window", lambda w: _is_slot(w["t"]))) * 2 > F.col("length"))
    each = each.withColumn("kind", F.explode(F.array(F.lit(0), F.lit(1)))).filter("kind = 1 or not heavy")
    hashes = F.transform("window", lambda w: F.xxhash64(F.when(F.col("kind") == 1, w["p"]).otherwise(w["t"])))
    each = each.withColumn("hash", F.xxhash64(F.col("length") + 1000 * F.col("kind"), hashes))
    return each.groupBy("item_key", "hash").agg(F.min("item_pos").alias("item_pos"), F.first("length").alias("length"), F.first("kind").alias("kind"), F.bool_or("heavy").alias("heavy"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, doc_key, item_id, n_windows, item_windows, exact): the pairs of document and leaked item; exact: no value was changed."""
    items = materialize(benchmark_items(benchmark), "items")
    windows = materialize(item_windows(items), "item-windows")
    templated = (F.col("kind") == 0) | F.col("heavy")  # the windows of which some may be re-parameterised
    totals = windows.groupBy("item_key").agg(F.count_if(templated).alias("item_windows"), F.count_if(F.col("kind") == 1).alias("item_plain"))
    shapes = sorted({(0, WINDOW)} | {tuple(r) for r in windows.select("kind", "length").distinct().collect()})  # two kinds, and WINDOW lengths of each at most
    spaced = _spaced(F.col("text"))
    words = {0: _not_empty(F.split(_templated(spaced), " ")), 1: _not_empty(F.split(_plain(spaced), " "))}
    keyed = docs.select("doc_id", "text", doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"))
    hits = None
    for kind in sorted({k for k, _ in shapes}):
        lengths = [n for k, n in shapes if k == kind]
        hashed = keyed.select("doc_key", F.transform(words[kind], lambda w: F.xxhash64(w)).alias("hashed"))
        found = _windows(hashed, lengths, kind).join(windows.filter(F.col("kind") == kind), "hash")
        # an alignment has no more places than the item
        found = found.select("doc_key", "item_key", (F.col("pos") + 1 - F.col("item_pos")).alias("line"), "item_pos", "length", "kind", "heavy", "hash")
        hits = found if hits is None else hits.unionByName(found)
    reached = lambda n, total: F.col(n) >= F.least(F.lit(LEAST_WINDOWS), F.col(total))
    enough = reached("n", "item_windows") | reached("n_plain", "item_plain")
    counts = [F.count_distinct(F.when(templated, F.col("hash"))).alias("n"), F.count_distinct(F.when(F.col("kind") == 1, F.col("hash"))).alias("n_plain")]
    lines = hits.groupBy("doc_key", "item_key", "line").agg(F.collect_set(F.struct("item_pos", "length", "kind", "heavy", "hash")).alias("at"))
    lines = materialize(lines, "alignments")
    likely = lines.select("doc_key", "item_key", F.explode("at").alias("m")).select("doc_key", "item_key", "m.*").groupBy("doc_key", "item_key").agg(*counts).join(totals, "item_key").filter(enough).drop("n", "n_plain")
    lines = lines.join(likely, ["doc_key", "item_key"])
    there = keyed.join(lines.select("doc_key").distinct(), "doc_key", "left_semi").select("doc_key", "doc_id", tokens(F.col("text")).alias("there")).dropDuplicates(["doc_key"])
    pairs = lines.join(there, "doc_key").join(items, "item_key")

    def slots(m: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), m["length"] - 1), lambda k: F.struct(F.element_at("tokens", (m["item_pos"] + k).cast("int")).alias("item"), F.element_at("there", (F.col("line") + m["item_pos"] + k).cast("int")).alias("doc")))
        strip = lambda c: F.regexp_replace(c, r"^[^\p{L}\p{Nd}]+|[^\p{L}\p{Nd}]+$", "")
        return F.transform(F.filter(each, lambda s: _is_slot(s["item"]["t"])), lambda s: F.struct(strip(s["item"]["raw"]).alias("item"), strip(s["doc"]["raw"]).alias("doc")))

    compared = pairs.withColumn("slots", F.array_distinct(F.flatten(F.transform(F.filter("at", lambda m: m["kind"] == 0), slots))))
    consistent = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: s["item"])))
    seen = F.when(consistent, F.col("at")).otherwise(F.filter("at", lambda m: m["kind"] == 1))
    exact = ~consistent | F.forall("slots", lambda s: s["item"] == s["doc"])
    each = compared.select("doc_id", "doc_key", "item_id", "item_key", "item_windows", "item_plain", exact.alias("exact"), F.explode(seen).alias("m")).select("*", "m.*")
    out = each.groupBy("doc_id", "doc_key", "item_id", "item_key", "item_windows", "item_plain").agg(*counts, F.bool_and("exact").alias("exact")).filter(enough)
    plain = reached("n_plain", "item_plain")
    found = F.greatest(F.col("n"), F.when(plain, F.col("n_plain")).otherwise(0))
    return out.select("doc_id", "doc_key", "item_id", found.alias("n_windows"), F.greatest("item_windows", F.when(plain, F.col("item_plain")).otherwise(0)).cast("long").alias("item_windows"), (F.col("exact") | plain).alias("exact")).distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold an item."""
    leaked = materialize(contaminated(docs, benchmark).select(F.col("doc_key").alias("leaked_key")).distinct(), "leaked")
    return docs.join(leaked, doc_key(docs["doc_id"], docs["text"]) == leaked["leaked_key"], "left_anti")
