"""Operators against brute force, round trips and held-out accuracy; and the odd inputs of each."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from vitrine.llm import decontaminate, fingerprint, language_id, language_model, line_dedup, mixing, near_dedup, sharding, token_counts, url_filter
from vitrine.llm.common import fold

D = "/root/testdata/sf0.001"
ODD = [(1, "a b c d e f g h.\nsame words in this line here now", "en", "s"), (2, None, None, None), (3, "", "en", ""), (None, "x " * 3000, "de", "s"), (1, "a b c d e f g h.\nsame words in this line here now", "en", "s"), (5, "other\nsame words in this line here now", "en", "t")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{D}/documents.parquet").cache()


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 2) for r in ODD], "doc_id long, text string, lang string, source string, size long, score long")


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def test_lines(docs, odd, none):
    lines = [(r.doc_id, i, frozenset(line.lower().split())) for r in docs.orderBy("doc_id").collect() for i, line in enumerate(r.text.split("\n"))]
    want = {(d, i) for k, (d, i, w) in enumerate(lines) if w and any(5 * len(w & v) >= 4 * len(w | v) for _, _, v in lines[:k])}
    got = {(r.doc_id, n) for r in line_dedup.line_report(docs).collect() for n in r.removed}
    assert got == want
    assert sorted((r.doc_id or 0, r.n_lines, r.n_removed) for r in line_dedup.line_report(odd).collect()) == [(0, 1, 0), (1, 2, 0), (1, 2, 0), (2, 0, 0), (3, 1, 0), (5, 2, 1)]
    assert line_dedup.without_repeated_lines(odd).filter("doc_id = 5").first().text == "other"
    assert line_dedup.line_report(none).count() == 0


def test_urls(spark):
    urls = ["http://a.org/x", "http://Example.ORG/es/1?q", "http://example.org/en/12", "https://notexample.com/de/", "x.com/de/", None, "http://com", "http://b.com/fr/#"]
    pages = spark.createDataFrame([(i, u, "?") for i, u in enumerate(urls)] + [(9, "http://a.org/x", "?")], "page_id int, url string, rule string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_filter.judge_urls(pages, url_filter.rules_table(spark)).collect()}
    assert got == {0: ("a.org", "org/", "allow"), 1: ("example.org", "example.org/es/", "block"), 2: ("example.org", "example.org/en/1", "block"), 3: ("notexample.com", "com/de/", "block"), 4: ("", None, "allow"), 5: ("", None, "allow"), 6: ("com", None, "allow"), 7: ("b.com", "com/fr/", "allow"), 9: ("a.org", "org/", "allow")}


def test_tokens(docs, odd):
    first, rest = token_counts.load_pieces()
    a, known, more = token_counts.Automaton(first, rest), set(first), set(rest)

    def brute(word):
        at = n = 0
        while at < len(word):
            pieces = known if at == 0 else more
            end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
            if end is None:
                return 0
            at, n = end, n + 1
        return n

    words = {w for r in docs.limit(40).collect() for w in r.text.split()}
    assert all(a.count(w) == brute(w) for w in words)
    assert {r.doc_id: r.n_words for r in token_counts.count_tokens(odd).collect()}[2] == 0


def test_tokens_of_every_word(spark, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.VOCABULARY)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}

    def brute(word):
        s, at, n = "▁" + word, 0, 0
        while at < len(s):
            end = next((e for e in range(min(len(s), at + 40), at, -1) if s[at:e] in pieces), None)
            n += 1 if end else len(s[at].encode())
            at = end or at + 1
        return n

    words = {"1234567", "ñado", "çç", "9" * 500, "\U0001f9ff", "a\U0001f9ffb", "\u0378x", "中文字符", "привет"} | {w for r in docs.limit(40).collect() for w in r.text.split()}
    a = token_counts.Automaton(*token_counts.load_pieces(), *token_counts.load_fallbacks())
    assert max(map(len, pieces)) <= 40 and {w: a.count(w) for w in words} == {w: brute(w) for w in words}
    row = token_counts.count_tokens(spark.createDataFrame([(1, "1234567 ñado " + "9" * 500)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_tokens, row.n_unknown) == (3, sum(map(brute, ["1234567", "ñado", "9" * 500])), 0)


def test_language_model(docs, odd):
    rows = {r.doc_id: r for r in language_model.score(docs.repartition(3), fold(F.col("doc_id"), 10) == 0).collect()}
    held = [r for r in rows.values() if r.held_out]
    assert len(rows) == docs.count() and sum(r.score for r in held) > 1.02 * sum(r.base_score for r in held) and all(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in held)
    assert sorted(r.n_tokens for r in language_model.score(odd, F.lit(False)).collect()) == [1, 1, 9, 16, 16, 3001]


def test_language_model_learns_from_every_text(spark):
    ids = [i for i in range(60) if zlib.crc32(f"lm:{i}".encode()) % 16]
    texts = spark.createDataFrame([(i, "one two three four " * 20) for i in ids], "doc_id long, text string").coalesce(1)
    rows = language_model.score(texts, F.lit(False)).collect()
    assert len(rows) == len(ids) and all(r.score > 0.7 * r.base_score for r in rows)


def test_language(docs, odd, none):
    learn = fold(F.col("doc_id"), 4) != 2
    out = language_id.identify(docs, language_id.train(docs, learn), ("doc_id", "lang")).filter(fold(F.col("doc_id"), 4) == 2).collect()
    assert sum(r.lang == r.lang_pred for r in out) > 0.95 * len(out)
    got = {r.doc_id: r.lang_pred for r in language_id.identify(odd, language_id.train(odd, F.lit(True)), ("doc_id",)).collect()}
    assert got[2] == got[3] == "und" and language_id.train(none, F.lit(True)) is None


def test_unlike_texts_are_rejected(spark):
    import base64
    import random

    rng = random.Random(1)
    texts = {
        -1: "Это длинный русский текст о погоде, городе и людях, которые живут там много лет и любят гулять по вечерам. " * 3,
        -2: "这是一个关于天气和城市的很长的中文文本,人们在那里生活了很多年。" * 4,
        -3: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(2000)),
        -4: base64.b64encode(rng.randbytes(1500)).decode(),
        -5: "Wczoraj poszliśmy do lasu, żeby zebrać grzyby i posłuchać ptaków śpiewających wśród drzew. " * 3,
    }
    docs = spark.read.parquet(D.replace("sf0.001", "sf0.01") + "/documents.parquet").select("doc_id", "text", "lang")
    learn = fold(F.col("doc_id"), 4) != 2
    clean = docs.filter(~learn)
    mixed = clean.unionByName(spark.createDataFrame([(i, t, "en") for i, t in texts.items()], docs.schema))
    got = {r.doc_id for r in language_id.accepted(mixed, language_id.train(docs, learn)).collect()}
    assert got == {r.doc_id for r in clean.collect()}


def test_near_duplicates(docs, odd, none):
    got = near_dedup.near_duplicates(odd).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 3, True), (5, 5, True)]
    assert near_dedup.near_duplicates(none).count() == 0


def test_mixing(odd, none):
    rows = {r.doc_id: r for r in mixing.mix_sizes(odd.filter("doc_id is not null")).collect()}
    assert rows[2].size == rows[2].taken == 0 and all(r.taken <= 3 * r.size for r in rows.values())
    assert mixing.mix_sizes(none).count() == 0 and mixing.mixed(odd).columns == odd.columns


def test_sharding(docs, odd, none):
    for small in (10, 20_000):
        rows = sharding.shard(docs, 8, per_bin=small).collect()
        by = {}
        for r in rows:
            by.setdefault(r.shard, []).append(r)
        assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
        sizes = [sum(r.size for r in x) for x in by.values()]
        assert len(rows) == docs.count() and max(sizes) < 1.2 * min(sizes)
        shards = {}
        assert all(shards.setdefault(r.text_crc32, r.shard) == r.shard for r in rows)
    assert sharding.shard(odd, 8).count() == len(ODD) and sharding.shard(none, 8).count() == 0


def test_fingerprints(spark, docs, odd):
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    got = [r for r in fingerprint.fingerprint_edits(docs).orderBy("doc_id").collect()]
    for i, r in enumerate(got):
        q = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - q] + texts[(i + 1) % len(texts)][:q]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
    assert sum(r.near_edited for r in got) > 10 * sum(r.near_next for r in got)
    pairs = spark.createDataFrame([(1, list(range(40)), list(range(3, 45))), (2, [], [7]), (3, [5], [5])], "k int, a array<long>, b array<long>")
    out = {r.k: (sorted(r.plus), sorted(r.minus)) for r in fingerprint.differences(pairs, ["k"], "a", "b").collect()}
    assert out == {1: ([0, 1, 2], [40, 41, 42, 43, 44]), 2: ([], [7]), 3: ([], [])}
    assert fingerprint.fingerprint_edits(odd).count() == len(ODD)


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(1, "If Anna has 12 apples and gives 3 kg to Bob then how many apples will Anna still have left?"), (2, "so short one"), (3, None)], "item_id long, text string")
    changed = "Intro. If Maria has 40 apples and gives 7 lb to Tom then how many apples will {} still have left? Bye"
    texts = spark.createDataFrame([(1, changed.format("Maria")), (2, "We say: so short one indeed"), (3, changed.format("Peter")), (None, "xx so short one"), (5, None), (6, "")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.contaminated(texts, items).collect()}
    assert got == {(1, 1, False), (2, 2, True), (None, 2, True)}
    assert decontaminate.decontaminated(texts, items).count() == 3 and decontaminate.contaminated(odd, none.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{D}/documents.parquet")
    out = corpus_pipeline.run(spark, D)
    rows = out.collect()
    assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()} and {r.shard for r in rows} <= set(range(8))
    kept = near_dedup.deduplicated(docs)
    words = {r.doc_id: (w := (r.text or "").lower().split()) and {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for r in kept.collect()}
    ids = sorted(words)
    assert not any(words[a] and 5 * len(words[a] & words[b]) >= 4 * len(words[a] | words[b]) for i, a in enumerate(ids) for b in ids[i + 1 :])
