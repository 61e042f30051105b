"""Whole results of the operators against brute force, and the inputs that used to break them."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import common, decontaminate, fingerprint, language_id, language_model, line_dedup, near_dedup, queries, sharding, token_counts, url_filter
from vitrine.llm.shingles import shingle_set, words_of

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet").cache()


@pytest.fixture(scope="module")
def long_text():
    rng = np.random.default_rng(3)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(180_000))  # over 1 MiB


def test_scratch_tables_go(spark, docs):
    t = common.materialize(docs.groupBy("source").count(), "gone")
    assert t.count() > 0
    path = t.vitrine_path
    common.discard(t)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(path).count()


def test_lines_of_families(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(120):  # near copies of one line, some further from each other than from the first
        words = list(base)
        for j in rng.choice(30, int(rng.integers(0, 6)), replace=False):
            words[j] = f"x{i}_{j}"
        rows.append((i, " ".join(words) + "\nalone " + str(i), "en", "s", 1))
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    lines = [(d, n, frozenset(x.split())) for d, text, *_ in rows for n, x in enumerate(text.split("\n"))]
    want = {(d, n) for k, (d, n, w) in enumerate(lines) if any(5 * len(w & v) >= 4 * len(w | v) for _, _, v in lines[:k])}
    assert {(r.doc_id, n) for r in line_dedup.line_report(docs).collect() for n in r.removed} == want


def test_tokens_of_the_query(spark, docs):
    first, rest = token_counts.load_pieces()
    bare, by_bytes = token_counts.load_fallbacks()
    pieces = {"▁" + p for p in first} | set(rest) | {"▁"}
    assert bare and by_bytes
    longest = max(map(len, pieces))

    def brute(word):
        s, at, n = "▁" + word, 0, 0
        while at < len(s):
            end = next((e for e in range(min(len(s), at + longest), at, -1) if s[at:e] in pieces), None)
            n += 1 if end else len(s[at].encode())
            at = end or at + 1
        return n

    memo = {}
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = queries.op3_token_counts(spark, D).collect()
    assert len(got) == len(texts)
    for r in got:
        words = texts[r.doc_id].split()
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(memo.setdefault(w, brute(w)) for w in words), 0)


def test_language_model_is_a_distribution(docs):
    counts = common.materialize(language_model.word_counts(docs.select(F.col("text").cast("binary").alias("text"))), "counts")
    lexicon = language_model.lexicon_of(counts)
    rng = np.random.default_rng(2)
    w = lexicon.start()
    w = {k: v + rng.normal(0, 0.1, v.shape).astype(np.float32) for k, v in w.items()}
    w["bo"] = lexicon.start()["bo"]
    state = rng.normal(0, 1, (1, language_model.HIDDEN)).astype(np.float32)
    head = len(lexicon.counts)
    y = np.concatenate([np.arange(head), language_model.HEAD + np.arange(language_model.TAILS)])
    p = np.exp(language_model._log_likelihood(w, np.repeat(state, len(y), 0), y))
    assert abs(p.sum() - 1) < 1e-3
    shares = defaultdict(float)
    for r in counts.collect():
        number = lexicon.numbers.get(r.word.encode())
        if number is None or number >= head:
            shares[r.tail] += r.c + 0.1
    for tail in range(language_model.TAILS):  # an unseen word has 0.1
        assert shares[tail] + 0.1 == pytest.approx(lexicon.tail_sums[tail])


def test_language_model_whole_result(docs):
    held = common.fold(F.col("doc_id"), 10) == 0
    rows = {n: {r.doc_id: r for r in language_model.score(docs.repartition(n), held).collect()} for n in (1, 4)}
    counts = Counter()
    texts = {r.doc_id: r.text for r in docs.collect()}
    tokens = {i: [*t.encode().lower().split(), b"\n"] for i, t in texts.items()}
    for i, words in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        r = rows[1][i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 10 == 0, len(words), sum(w in counts for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel=1e-9)
        assert rows[4][i].score == pytest.approx(r.score, rel=1e-6)


def test_language_model_is_better_than_counts(spark):
    """On 340,000 training tokens, held-out texts are at least 1.5 % more likely, in logarithms, than by counts alone."""
    docs = spark.read.parquet(D.replace("sf0.001", "sf0.01") + "/documents.parquet")
    held_out = language_model.score(docs, common.fold(F.col("doc_id"), 10) == 0).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held_out[0] > 0.985 * held_out[1]


def test_rare_words_are_shuffled_by_word_and_row_only(spark, monkeypatch):
    """Words that aren't sent to the tasks meet their counts, however often a text has them, in one join."""
    monkeypatch.setattr(language_model, "KNOWN", 3)
    texts = {i: f"a a a b b c rare{i // 2} rare{i // 2} own{i} own{i} own{i}" for i in range(12)}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], DOCS)
    scored = language_model.score(docs, F.col("doc_id") >= 9)
    assert not re.search(r"keys=\[row_id#\d+L?, word#", scored._jdf.queryExecution().executedPlan().toString())
    counts = Counter(w for i, t in texts.items() if i < 9 for w in [*t.split(), "\n"])
    n, v = sum(counts.values()), len(counts)
    for r in scored.collect():
        words = [*texts[r.doc_id].split(), "\n"]
        assert (r.n_tokens, r.n_known) == (len(words), sum(w in counts for w in words))
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel=1e-9)


def test_odd_texts(spark, long_text):
    bad = spark.createDataFrame([(1, bytearray(b"good words \xff\xfe here")), (2, None)], "doc_id long, text binary").select("doc_id", F.col("text").cast("string").alias("text"), F.lit("en").alias("lang"), F.lit(1).alias("n_tokens"), F.lit(2).alias("unknown"))
    assert {r.doc_id: r.n_words for r in token_counts.count_tokens(bad).collect()} == {1: 4, 2: 0}
    assert {r.doc_id: r.n_tokens for r in language_model.score(bad, F.lit(False)).collect()} == {1: 5, 2: 1}
    texts = spark.createDataFrame([(1, long_text, "en", "s", 1), (2, long_text + " end", "en", "s", 1), (3, "short", "en", "s", 1)], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(texts).collect()}
    assert got[1][1] == got[2][1] == 1 and got[3] == (1, 3) and got[2][0] == got[1][0] + 1
    assert {r.doc_id: r.n_removed for r in line_dedup.line_report(texts).collect()} == {1: 0, 2: 1, 3: 0}
    assert {r.doc_id: r.n_words for r in token_counts.count_tokens(texts).collect()} == {1: 180_000, 2: 180_001, 3: 1}


def test_empty_tables(spark, docs):
    none = docs.filter("false")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert token_counts.count_tokens(none).count() == language_model.score(none, F.lit(False)).count() == decontaminate.contaminated(none, items).count() == 0
    assert url_filter.judge_urls(none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url")), url_filter.rules_table(spark)).count() == 0
    assert near_dedup.deduplicated(none).count() == 0


def test_letters():
    has = language_id.has_letter
    assert has("é".encode()) and has("字".encode()) and not any(has(t.encode()) for t in ("½", "²", "Ⅷ", "①", "12 ?", "")) and not has(None)


def test_models_of_one_worker_are_kept_apart():
    grams = lambda t: np.sort(language_id.grams(t.encode()))
    a = language_id.fit([(grams("das ist ein haus und der hund"), "de"), (grams("this is the house and a dog"), "en")])
    b = language_id.fit([(grams("das ist ein haus und der hund"), "xx"), (grams("this is the house and a dog"), "yy")])
    text = [b"the house"]
    assert [language_id.predict(m, text)[0] for m in (a, b, a)] == [["en"], ["yy"], ["en"]]


def test_repeated_texts_take_one_place_in_the_sample(spark):
    rows = [(i, "immer der gleiche satz", "de", "s", 1) for i in range(300)] + [(1000 + i, f"noch ein anderer satz nummer {'abcdefghij'[i]} hier", "de", "s", 1) for i in range(10)] + [(2000 + i, f"one more english text {'abcdefghij'[i]} here", "en", "s", 1) for i in range(10)]
    model = language_id.train(spark.createDataFrame(rows, DOCS), F.lit(True), most=8)
    assert model.languages == ["de", "en"] and language_id.predict(model, [b"noch ein anderer satz", b"one more english text"])[0] == ["de", "en"]


def _links(sets, percent=80):
    ids = sorted(sets)
    return [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]


def _components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("sizes", [(4, 12), (12, 60), (150, 340)])
def test_near_duplicates_just_above_the_bound(spark, sizes):
    rng = np.random.default_rng(sizes[0])
    texts, pairs = {}, 60 if sizes[1] < 100 else 25
    for i in range(pairs):
        n = int(rng.integers(*sizes))
        words = [f"p{i}w{j}" for j in range(n + 1)]  # n shingles of two words
        texts[2 * i] = " ".join(words)
        texts[2 * i + 1] = " ".join(words + [f"p{i}x{j}" for j in range(n // 4)])  # 0.8 alike, or little more
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], DOCS).repartition(4)
    sets = {i: set(shingle_set(w, 2).tolist()) for i, w in zip(texts, words_of([t.encode() for t in texts.values()]))}
    want = _components(texts, _links(sets))
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(rows).collect()} == want and len(set(want.values())) == pairs


def test_one_row_of_a_repeated_document_stays(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1)] * 3 + [(2, "a b c d e f g", "en", "s", 1), (3, None, "en", "s", 1), (3, None, "en", "s", 1)]
    assert sorted(r.doc_id for r in near_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).collect()) == [1, 3]


def test_shards_are_balanced(docs):
    rows = sharding.shard(docs, 8).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= max(1, sum(sizes.values()) // 8 // 500)


def test_leaks_of_odd_items(spark):
    items = spark.createDataFrame(
        [(1, "Anna has 12 apples. Bob has 7 pears. Who has more?"), (2, "Compute 12 + 7 * 3 - 4 / 2 + 9 now"), (2, "This second text has the same id as the one before it"), (None, "An item without any id is an item all the same, is it not?"), (4, None), (5, "")],
        "item_id long, text string",
    )
    texts = [
        (1, "Look: Maria has 40 apples. Tom has 9 pears. Who has more?"), (2, "so compute 12 + 7 * 3 - 4 / 2 + 9 now and go"), (3, "so compute 13 + 8 * 3 - 4 / 2 + 9 now and go"),
        (4, "́ ...  this second text has the same id as the one before it"), (5, "yes, An item without any id is an item all the same, is it not? yes"), (6, None), (7, "Maria has 40 apples. Maria has 9 pears. Who has more?"), (None, "́"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit(9))
    got = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1, False), (2, 2, True), (4, 2, True), (5, None, True), (7, 1, False)}


def test_verbatim_items_are_found(spark, docs):
    bench = spark.read.parquet(f"{D}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in items.items() if t in r.text}
    assert want and want <= got


def test_likeness_is_that_of_the_sets(docs):
    got = fingerprint.fingerprint_edits(docs).orderBy("doc_id").collect()
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    edited = [(t[: len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][: len(t) // 4],) for i, t in enumerate(texts)]
    sets = [frozenset(r.p) for r in docs.orderBy("doc_id").select(fingerprint.paragraphs(F.col("text")).alias("p")).collect()]
    changed = [frozenset(r.p) for r in docs.sparkSession.createDataFrame(edited, "text string").coalesce(1).select(fingerprint.paragraphs(F.col("text")).alias("p")).collect()]
    like = lambda a, b: 1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0
    for i, r in enumerate(got):
        assert r.near_edited == pytest.approx(like(sets[i], changed[i])) and r.near_next == pytest.approx(like(sets[i], sets[(i + 1) % len(got)]))
    by_text = {}
    assert all(by_text.setdefault(t, r.fingerprint) == r.fingerprint for t, r in zip(texts, got))


@pytest.mark.parametrize("ids", [[-(1 << 63), 1 << 62, 5, 3, -7, (1 << 63) - 1], [1, 2, 3, 4, 5, 10**15], [None, 1, None, 2, 3, 4], [7, 7, 7, 7, 7, 7]])
def test_next_of_odd_ids(spark, ids):
    import hashlib

    texts = [f"text {i} of some length.\nanother line {i}" for i in range(len(ids))]
    docs = spark.createDataFrame([(i, t, 5) for i, t in zip(ids, texts)], "doc_id long, text string, row int").repartition(3)
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is None, x[0] or 0, hashlib.md5(x[1].encode()).hexdigest()))
    want = set()
    for k, (i, t) in enumerate(order):
        q = len(t) // 4
        want.add((i, len(t), hashlib.sha256((t[: len(t) - q] + order[(k + 1) % len(order)][1][:q]).encode()).hexdigest()))
    before = fingerprint.PER_BUCKET
    fingerprint.PER_BUCKET = 1
    try:
        assert {(r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprint.fingerprint_edits(docs).collect()} == want
    finally:
        fingerprint.PER_BUCKET = before


def test_strangers_of_a_band_are_discarded_in_the_join(spark, monkeypatch):
    rows = [(i, f"one and the same {' '.join(f'w{i}x{j}' for j in range(8))}", "en", "s", 1) for i in range(200)]
    counts, write = [], near_dedup.materialize
    monkeypatch.setattr(near_dedup, "materialize", lambda df, tag, *more: (out := write(df, tag, *more), counts.append(out.count()) if tag == "left" else None)[0])
    assert near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS)).filter("kept").count() == 200
    assert counts == [0]


def test_pairs_of_a_family_are_confirmed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4000)  # a set has some 1600 bytes
    rng = np.random.default_rng(5)
    base = [f"w{j}" for j in range(200)]
    texts = {i: " ".join(f"t{i}x{j}" if j in gone else w for j, w in enumerate(base)) for i in range(40) for gone in [set(rng.choice(200, int(rng.integers(6, 16)), False))]}
    sets = {i: set(shingle_set(w, 2).tolist()) for i, w in zip(texts, words_of([t.encode() for t in texts.values()]))}
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], DOCS)
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(rows).collect()} == _components(texts, _links(sets))


@pytest.mark.parametrize("setting", [{"SPACED": 0}, {"COUNTED": 1 << 30}, {"TEXTS": 64}, {"TEXTS": 1 << 22}])
def test_lines_of_all_sizes(spark, monkeypatch, setting):
    """The words are joined by size, rarity is unknown, or the bitmap of texts is full: the result is the same."""
    for name, value in setting.items():
        monkeypatch.setattr(line_dedup, name, value)
    rng = np.random.default_rng(9)
    rows = []
    for i in range(150):  # sizes 1 to 40, alike across size classes too
        words = [f"f{i % 25}w{j}" for j in range(1 + 13 * (i % 25) % 40)]
        gone = set(rng.choice(len(words), int(rng.integers(0, 1 + len(words) // 4)), False))
        rows.append((i if i % 30 else None, " ".join([w for j, w in enumerate(words) if j not in gone] + [f"x{i}"] * int(rng.integers(0, 2))) + f"\nown{i} line", "en", "s", 1))
    lines = [(d is None, d, n, t, frozenset(x.split())) for d, t, *_ in rows for n, x in enumerate(t.split("\n"))]
    known = sorted((x for x in lines if not x[0]), key=lambda x: x[1:3])
    want = Counter((d, n) for k, (_, d, n, _, w) in enumerate(known) if w and any(5 * len(w & v[4]) >= 4 * len(w | v[4]) for v in known[:k]))
    got = line_dedup.line_report(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert Counter((r.doc_id, n) for r in got for n in r.removed if r.doc_id is not None) == want and len(got) == 150


def test_windows_are_hashed_in_compiled_code(spark):
    rows = [(0, list(range(10))), (1, [5]), (2, []), (3, [7, 8])]
    windows = decontaminate._windows(spark.createDataFrame(rows, "doc_key long, hashed array<long>"), [1, 2, 8], 1)
    assert not [x for x in windows._jdf.queryExecution().executedPlan().toString().split("\n") if "slice(" in x and "lambda" in x]
    want = [(d, i, h[i : i + n]) for d, h in rows for n in (1, 2, 8) for i in range(len(h) - n + 1)]
    hashes = spark.createDataFrame(want, "doc_key long, pos int, w array<long>").select("doc_key", "pos", F.xxhash64(F.size("w") + 1000, "w").alias("hash"))
    assert sorted(map(tuple, windows.select("doc_key", "pos", "hash").collect())) == sorted(map(tuple, hashes.collect()))


def test_texts_are_hashed_once(spark, monkeypatch):
    tables, real = {}, line_dedup.materialize
    monkeypatch.setattr(line_dedup, "materialize", lambda df, tag: tables.setdefault(tag, df) and real(df, tag))
    line_dedup._Lines(spark.createDataFrame([(1, "a\tB a\nc", "en", "s", 1)], DOCS), 80)
    plan = tables["lines"]._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate posexplode") < plan.index("AS text_hash")  # below, so before the lines


def test_words_of_lines(spark):
    texts = ["A b", "a\tb", "b\x0b\x0ca\r a", "  a  ", "", "\t\r"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = rows.select("i", F.size(line_dedup._keys(F.col("t"), F.array(F.lit(0).cast("long")))).alias("n"), line_dedup._words(F.col("t")).alias("w")).collect()
    assert {r.i: r.n for r in got} == {0: 2, 1: 2, 2: 2, 3: 1, 4: 0, 5: 0}
    assert {r.i: [w for w in r.w if w] for r in got} == {i: t.lower().split() for i, t in enumerate(texts)}


def test_words_meet_once_and_at_alike_sizes(spark):
    """Of two classes with a common word the smaller looks it up among its first words only, and a frequent word meets alike sizes only."""
    prefix = lambda n: n - math.ceil(0.8 * n) + 1
    sizes = [5, 6, 8, 10, 12, 13, 20, 25, 26, 40, 50, 200]
    for rare in (0, 99):  # all words are frequent, or none
        rows = [(i, n, 0, 0, i, 0, rare, [7, *range(1000 * i, 1000 * i + prefix(n) - 2), 8], False) for i, n in enumerate(sizes)]
        flags = spark.createDataFrame(rows, "id long, n int, bits0 long, bits1 long, doc_id long, line int, rare int, prefix array<int>, settled boolean")
        small, large = line_dedup.word_sides(flags, 80)
        met = [tuple(r) for r in line_dedup._side(small, "s").join(line_dedup._side(large, "l"), "word").filter("id_s != id_l").select("id_s", "id_l").collect()]
        at_first = {(i, j) for i in range(len(sizes)) for j in range(len(sizes)) if i != j}
        if rare:  # word 7 is at all places the first, word 8 beyond the first words of sets of 8 or more
            assert at_first <= set(met) and len(met) < 1.5 * len(at_first)
        else:
            assert {(i, j) for i, j in at_first if 0 <= j - i and sizes[i] >= 0.8 * sizes[j]} <= set(met) and len(met) < 0.5 * len(at_first)


def test_words_meet_in_few_rows(spark):
    """A word goes with another size only where its place leaves that possible, and then it does."""
    sizes = list(range(1, 42))
    prefix = {n: n - math.ceil(0.8 * n) + 1 for n in sizes}
    flags = spark.createDataFrame([(n, n, 0, 0, n, 0, 0, [7] * prefix[n], False) for n in sizes], "id long, n int, bits0 long, bits1 long, doc_id long, line int, rare int, prefix array<int>, settled boolean")
    small, large = [x.collect() for x in line_dedup.word_sides(flags, 80)]
    assert len(small) + len(large) < 2.2 * sum(prefix.values())
    place = lambda r: (r.id, (r.packed & 0xFFFFFFFF) >> 1)
    met = {(place(s), place(x)) for s in small for x in large if s.word == x.word}
    for n in sizes:
        for m in range(n, min(42, int(1.25 * n) + 1)):
            for i in range(n - math.ceil(160 * n / 180) + 1):
                assert {((n, i), (m, j)) for j in range(prefix[m]) if 180 * min(n - i, m - j) >= 80 * (n + m)} <= met


def test_sketches_tell_long_lines_apart(spark):
    rng = np.random.default_rng(3)
    rows = []
    for common in [60] * 60 + [135] * 60:  # of 150 words
        words = rng.integers(0, 1 << 62, 300 - common).tolist()
        rows.append((common, words[:150], words[150 - common :]))
    pairs = spark.createDataFrame(rows, "common int, keys_a array<long>, keys_b array<long>")
    for x in "ab":
        pairs = pairs.withColumn(f"n_{x}", F.size(f"keys_{x}")).withColumns({f"bits{i}_{x}": line_dedup._sketch(F.col(f"keys_{x}"), i) for i in (0, 1)})
    possible = Counter(r.common for r in pairs.filter(line_dedup._possible("a", "b", 80)).collect())
    assert possible[135] == 60 and possible[60] < 3


def test_line_table_does_little_per_word(spark, monkeypatch):
    """A word takes one place of one sketch only, and classes of rarity are small numbers, of which Java shares the objects."""
    tables, real = {}, line_dedup.materialize
    monkeypatch.setattr(line_dedup, "materialize", lambda df, tag: tables.setdefault(tag, real(df, tag)))
    docs = spark.createDataFrame([(i, f"w{i}\na{i} b{i} A{i}\n", "en", "s", 1) for i in range(200)], DOCS)
    lines = line_dedup._Lines(docs, 80)
    rows = tables["lines"].collect()
    places = [(r.n, r.bits0.bit_count() if r.bits0 >= 0 else (r.bits0 & (1 << 64) - 1).bit_count(), r.bits1.bit_count() if r.bits1 >= 0 else (r.bits1 & (1 << 64) - 1).bit_count()) for r in rows]
    assert Counter(n for n, *_ in places) == {0: 200, 1: 200, 2: 200}
    assert {a + b for n, a, b in places if n < 2} == {0, 1} and {a + b for n, a, b in places if n == 2} <= {0, 2}
    assert 50 < sum(a for n, a, _ in places if n == 1) < 150  # both halves are in use
    monkeypatch.setattr(line_dedup, "COUNTED", 1)
    assert max(line_dedup.rarity_classes(docs)) in range(1, 64)
    assert lines.every.count() == 400


def test_parts_of_the_words(spark):
    """The parts hold each row once, and no word twice."""
    rng = np.random.default_rng(4)
    rows = [(i, n, 0, 0, i, 0, 0, rng.integers(-50, 50, n - math.ceil(0.8 * n) + 1).tolist(), False) for i, n in enumerate(range(1, 60))]
    flags = spark.createDataFrame(rows, "id long, n int, bits0 long, bits1 long, doc_id long, line int, rare int, prefix array<int>, settled boolean")
    whole = [Counter(map(tuple, x.collect())) for x in line_dedup.word_sides(flags, 80)]
    parts = [[Counter(map(tuple, x.collect())) for x in line_dedup.word_sides(flags, 80, i, 2)] for i in range(2)]
    assert [parts[0][k] + parts[1][k] for k in range(2)] == whole
    words = [{r[0] for side in p for r in side} for p in parts]
    assert all(words) and not words[0] & words[1]


def test_lines_are_counted_once(spark):
    """The number of lines comes with the lines; the report doesn't split the texts again."""
    rows = [(1, "a b\n\nc"), (1, "a b\n\nc"), (2, None), (None, None), (None, "x\ny"), (3, "")]
    out = line_dedup.line_report(spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCS).repartition(3))
    assert "split(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.doc_id or 0, r.n_lines) for r in out.collect()) == [(0, 0), (0, 2), (1, 3), (1, 3), (2, 0), (3, 1)]


def test_only_texts_with_candidates_are_shuffled(spark, monkeypatch):
    rows = [(i, f"{i}a {i}b {i}c {i}d {i}e" if i > 1 else f"u v w x y z{i * ' more'}", "en", "s", 1) for i in range(400)]
    asked, build = [], line_dedup._Lines.verified
    docs = spark.createDataFrame(rows, DOCS)

    def verified(self, pairs):
        asked.append(line_dedup.texts_of(self.docs, self.groups.select("place.doc_id", "place.text_hash").filter("doc_id < 2")).count())
        return build(self, pairs)

    monkeypatch.setattr(line_dedup._Lines, "verified", verified)
    assert [r.doc_id for r in line_dedup.line_report(docs).filter("n_removed > 0").collect()] == [1]
    assert asked == [2, 2]


def test_language_model_gradients(spark):
    """One update by back-propagation against numerical gradients, texts that begin inside a window included."""
    rng = np.random.default_rng(2)
    words = [("\n", 0, 9)] + [(f"w{i}", language_model.tail_of(f"w{i}".encode()), 50 - i % 40) for i in range(1, 90)]
    w = {k: v + rng.normal(0, 0.2, v.shape).astype(np.float32) for k, v in language_model.Lexicon(words, {}, 1000, 90).start().items()}
    w["bo"] = np.maximum(w["bo"], -5)
    y = rng.integers(0, 90, (6, 4))
    y[2, 1] = 0  # an end
    x = np.concatenate([np.zeros((1, 4), int), y[:-1]])
    x[4, 2] = y[5, 3] = language_model.HEAD + 3  # of a tail class
    live = (x != 0).astype(np.float32)[:, :, None]
    h = np.zeros((4, language_model.HIDDEN), np.float32)

    def loss(w, mask):
        return -language_model._log_likelihood(w, language_model._recur(w, x, h, None, live)[0][mask], y[mask]).mean()

    for mask in (np.ones(y.shape, bool), rng.random(y.shape) < 0.7):
        after, past = {k: v.copy() for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
        language_model._step(after, past, x, y, mask, h)  # past: the squares of the gradients
        for k in w:
            for at in np.argsort(past[k].ravel())[-3:]:
                near = []
                for d in (1e-2, -1e-2):
                    moved = {n: v.astype(np.float64) for n, v in w.items()}
                    moved[k].ravel()[at] += d
                    near.append(loss({n: v.astype(np.float32) for n, v in moved.items()}, mask))
                grad = np.sign(w[k].ravel()[at] - after[k].ravel()[at]) * np.sqrt(past[k].ravel()[at])
                assert abs((near[0] - near[1]) / 2e-2 - grad) < 2e-3 + 0.02 * abs(grad), k
