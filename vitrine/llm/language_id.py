"""Language identification by a string kernel, Nystroem landmarks and one-versus-rest kernel ridge regression.

The kernel counts the byte n-grams (1 to 3 bytes of the text, A-Z lower-cased, other ASCII than letters as one space)
that two whole texts share, each present or not, over the geometric mean of their numbers. It is learned from at most
`most` labelled rows, the same number per language, chosen by hash; `landmarks` of them span the Nystroem space. The
decision values of a text are linear in its n-grams' presence, so a batch of texts is scored by one matrix product of
presence and weights. The score is the best language's decision value, from -1..1 to 0..1.

Defined results: null texts and texts without a letter are `und` with score 0; ties go to the first language by code
point; without labelled rows every text is `und`; extra columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST, LANDMARKS, RIDGE, BATCH, SLICE = 2000, 256, 1e-3, 64, 512
LEAST_UNKNOWN = 0.25  # no text with a smaller share of unknown n-grams is rejected
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPACES = re.compile(rb" {2,}")
BASE2, BASE3 = 1 << 8, (1 << 8) + (1 << 16)
SIZE = BASE3 + (1 << 24)
_last = None


def grams(text: bytes) -> np.ndarray:
    """Distinct n-grams of 1 to 3 bytes, as numbers, in no special order."""
    global _last
    if _last is None:
        _last = np.zeros(SIZE, np.int32)
    a = np.frombuffer(_SPACES.sub(b" ", b" " + text.translate(TABLE) + b" "), np.uint8).astype(np.int32)
    ids = np.concatenate([a, BASE2 + (a[:-1] << 8) + a[1:], BASE3 + (a[:-2] << 16) + (a[1:-1] << 8) + a[2:]])
    order = np.arange(len(ids), dtype=np.int32)
    _last[ids] = order
    return ids[_last[ids] == order]


class Model:
    """most_unknown: the share of n-grams outside the vocabulary up to which a text counts as like the learned ones."""

    def __init__(self, languages: list[str], vocabulary: np.ndarray, weights: np.ndarray, most_unknown: float = 1.0):
        self.languages, self.vocabulary, self.weights, self.most_unknown = languages, vocabulary, weights, most_unknown
        self.digest = hashlib.md5(repr((languages, most_unknown)).encode() + vocabulary.tobytes() + weights.tobytes()).digest()

    def claims(self, known: int, n: int) -> bool:
        """Whether a text with so many n-grams, of which so many are known, is like the learned ones; in doubt it is."""
        p = self.most_unknown
        return n - known <= p * n + 2 * np.sqrt(n * p * (1 - p))


def fit(samples: list[tuple[np.ndarray, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """samples: distinct n-grams and language of each text, in a fixed order."""
    languages = sorted({lang for _, lang in samples}, key=lambda x: x.encode())
    turn: dict[str, int] = {}
    ranked = []
    for i, (_, lang) in enumerate(samples):  # landmarks alternate between the languages
        turn[lang] = turn.get(lang, 0) + 1
        ranked.append((turn[lang], i))
    chosen = [i for _, i in sorted(ranked)[:landmarks]]
    vocabulary = np.unique(np.concatenate([samples[i][0] for i in chosen]))
    marks = np.zeros((len(vocabulary), len(chosen)), np.float32)
    for j, i in enumerate(chosen):
        marks[np.searchsorted(vocabulary, samples[i][0]), j] = 1 / np.sqrt(len(samples[i][0]))
    shared = (marks > 0).sum(1) > 1
    landmark, unknown = set(chosen), np.zeros(len(samples))  # each text's share of n-grams that no other landmark has
    kernel = np.zeros((len(samples), len(chosen)))
    for i, (g, _) in enumerate(samples):
        at = np.minimum(np.searchsorted(vocabulary, g), len(vocabulary) - 1)
        at = at[vocabulary[at] == g]
        kernel[i] = marks[at].sum(0, dtype=np.float64) / np.sqrt(len(g))
        unknown[i] = 1 - (shared[at].sum() if i in landmark else len(at)) / len(g)
    values, vectors = np.linalg.eigh(kernel[chosen])
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    wanted = np.array([[1.0 if lang == x else -1.0 for x in languages] for _, lang in samples])
    solved = np.linalg.solve(features.T @ features + ridge * len(samples) * np.eye(features.shape[1]), features.T @ wanted)
    most_unknown = min(1.0, max(LEAST_UNKNOWN, 2 * float(np.quantile(unknown, 0.99))))
    return Model(languages, vocabulary, marks @ (root @ solved).astype(np.float32), most_unknown)


_lookup: tuple[bytes, np.ndarray] | None = None  # of the last model, by its digest: a worker can meet several


def has_letter(text: bytes | None) -> bool:
    """Whether the text has a character of the general category L; numbers such as a half or a Roman eight are none."""
    return bool(text) and any(map(str.isalpha, text.decode(errors="replace")))


def predict(model: Model, texts: list[bytes | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language and score of each text, and whether it is like the learned ones."""
    global _lookup
    if _lookup is None or _lookup[0] != model.digest:
        places = np.zeros(SIZE, np.int32)  # pages that nothing is written to take no memory
        places[model.vocabulary] = np.arange(1, len(model.vocabulary) + 1)
        _lookup = (model.digest, places)
    places = _lookup[1]
    names, scores, claimed = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
    todo = [i for i, t in enumerate(texts) if has_letter(t)]
    for k in range(0, len(todo), BATCH):
        part = todo[k : k + BATCH]
        presence = np.zeros((len(part), len(model.vocabulary)), np.float32)
        for row, i in enumerate(part):
            g = grams(texts[i])
            at = places[g] - 1
            at = at[at >= 0]
            presence[row, at] = 1 / np.sqrt(len(g))
            claimed[i] = bool(model.claims(len(at), len(g)))
        decided = presence @ model.weights
        best = decided.argmax(1)
        for row, i in enumerate(part):
            names[i] = model.languages[best[row]]
            scores[i] = float(np.clip((decided[row, best[row]] + 1) / 2, 0, 1))
    return names, scores, claimed


def train(docs: DataFrame, learn: Column, most: int = MOST) -> Model | None:
    """Learns from different texts for which learn holds and lang isn't null: at most `most` (or one of each language, if there are more), evenly by language, by hash of the text."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = rows.select("lang", F.col("text").cast("binary").alias("text"), F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 40)).alias("at"))
    counts = {r["lang"]: r["count"] for r in hashed.groupBy("lang").agg(F.approx_count_distinct("at").alias("count")).collect()}  # one row per language
    if not counts:
        return None
    share = max(1, most // len(counts))
    below = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int(min(1 << 40, 2 * share / n * (1 << 40)))))])
    near = hashed.filter(F.col("at") < F.element_at(below, F.col("lang"))).dropDuplicates(["lang", "at"])  # twice the share, before ranking; a text that repeats takes one place

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [grams(t).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("at"), pa.array(packed, pa.binary())], names=["lang", "at", "grams"])

    top = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("at", F.md5("text")))).filter(F.col("rank") <= share)
    got = top.select("lang", "at", "text").mapInArrow(made, "lang string, at long, grams binary").collect()
    got.sort(key=lambda r: (r["at"], r["lang"], bytes(r["grams"])))
    return fit([(np.sort(np.frombuffer(bytes(r["grams"]), np.int32)), r["lang"]) for r in got])


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...], claimed: bool = False) -> DataFrame:
    """The kept columns of docs with lang_pred and score; and claimed, if asked for: whether the text is like the learned ones."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    if model is None:
        return docs.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), *[F.lit(False).alias("claimed")] * claimed)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            names, scores, like = predict(sent.value, b.column("vitrine_text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64()), *[pa.array(like, pa.bool_())] * claimed], names=[*keep, "lang_pred", "score", *["claimed"] * claimed])

    return docs.select(*keep, F.col("text").cast("binary").alias("vitrine_text")).mapInArrow(run, f"{kept}, lang_pred string, score double" + ", claimed boolean" * claimed)


def accepted(docs: DataFrame, model: Model | None, least: float = 0.25) -> DataFrame:
    """docs without those that no language claims: `und`, a score under `least` (a decision value under -0.5), or too many n-grams that no learned text has."""
    out = identify(docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns if c != "text"}), model, tuple("text" if c == "text" else f"own_{c}" for c in docs.columns), claimed=True)
    return out.filter((F.col("lang_pred") != "und") & (F.col("score") >= least) & F.col("claimed")).select(*[F.col("text") if c == "text" else F.col(f"own_{c}").alias(c) for c in docs.columns])
