"""Document log-likelihoods of a gated recurrent language model.

Tokens are lower-cased (A-Z) words and one end per text. Word counts cover all training texts. The HEAD most frequent
tokens form classes of CLASS words, whose softmax within the class depends on the state; all other words are in one of
TAILS classes by their last three bytes and share their class by smoothed counts, (c + 0.1) over the class's sum. So
P(word) = P(class | state) * P(word | class, state) is a distribution over all words, one unseen per tail class
included. The state is a GRU's; it is carried across windows of WINDOW tokens through the whole text.

Every text is encoded once, as numbers of model inputs. Training is truncated back-propagation in numpy (Adagrad) over
all training texts, each once. Their pieces of PIECE tokens at most are spread by hash over shards of some SHARD
tokens, and the shards over ROUNDS rounds: in a round every shard trains from the same weights (at first those of the
class unigram model), and the weights are averaged, by tokens, in a tree. So the result depends on the texts and not on
how they are partitioned, and only averages come to the driver. Lanes of texts run side by side, NARROW at first (STEPS
windows), then twice as many, up to WIDTH.

In scoring, texts of one chunk are sorted by length and run side by side. Counts of the KNOWN most frequent words are
sent to the tasks (a fixed number); all other words meet the counts in a join.

Defined results: a null text is the empty text: one end token. Repeated rows score alike. Without training texts the
model is uniform over its classes. Bytes that are not UTF-8 count as replacement characters.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import discard, drop_clashing, materialize

HEAD, CLASS, TAILS, HIDDEN, WINDOW = 1024, 32, 32, 24, 32
KNOWN, WIDTH, NARROW, STEPS, RATE, FAN, CHUNK = 1 << 17, 128, 8, 8, 0.1, 64, 1_500_000
SHARD, ROUNDS, PIECE = 1_000_000, 4, 1 << 16
HEADS = HEAD // CLASS
CLASSES, INPUTS = HEADS + TAILS, HEAD + TAILS
END = "\n"  # no word
MOST_COUNTED = 400_000


def tail_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAILS


def _strings(words: list[bytes]) -> pa.Array:
    try:
        return pa.array(words, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([w.decode(errors="replace") for w in words], pa.string())


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, tail, c) over a column `text` of bytes; the end token included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            words = list(counts)
            return pa.RecordBatch.from_arrays([_strings(words), pa.array([tail_of(w) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())], names=["word", "tail", "c"])

        for b in batches:
            for t in b.column("text").to_pylist():
                counts.update((t or b"").lower().split())
                counts[END.encode()] += 1
                if len(counts) > MOST_COUNTED:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return texts.mapInArrow(run, "word string, tail int, c long").groupBy("word", "tail").agg(F.sum("c").alias("c"))


class Lexicon:
    """The known words: number, logarithm of count, and model input; and what the counts say of the classes."""

    def __init__(self, words: list[tuple[str, int, int]], tail_sums: dict[int, float], n: int, v: int):
        self.n, self.v = n, v
        head = [(END, 0, next((c for w, _, c in words if w == END), 0))] + [x for x in words if x[0] != END][: HEAD - 1]
        rest = [x for x in words if x[0] != END][HEAD - 1 :]
        self.numbers = {w.encode(): i for i, (w, _, _) in enumerate(head + rest)}
        self.inputs = np.array([*range(len(head)), *(HEAD + t for _, t, _ in rest)], np.int32)
        self.logs = np.log10(np.array([c + 0.1 for _, _, c in head + rest]))
        self.counts = np.array([c for _, _, c in head], np.float64)
        sums = np.array([tail_sums.get(t, 0.0) + 0.1 for t in range(TAILS)])
        for w, t, c in words:  # tail_sums are over all words; the head isn't in the tail
            if w != END and self.numbers[w.encode()] < len(head):  # the end is not in the sums
                sums[t] -= c + 0.1
        self.tail_sums = np.maximum(sums, 0.1)

    def start(self) -> dict[str, np.ndarray]:
        """Weights of the class unigram model."""
        rng = np.random.default_rng(11)
        counts = np.full(HEAD, 1e-30)  # places without a word have no probability
        counts[: len(self.counts)] = self.counts + 1e-3
        mass = np.concatenate([counts.reshape(HEADS, CLASS).sum(1), self.tail_sums])
        f = lambda x: np.asarray(x, np.float32)
        return {
            "wx": f(rng.normal(0, 0.3, (INPUTS, 3 * HIDDEN))), "uzr": f(rng.normal(0, 0.1, (HIDDEN, 2 * HIDDEN))), "uc": f(rng.normal(0, 0.1, (HIDDEN, HIDDEN))),
            "wc": f(np.zeros((HIDDEN, CLASSES))), "bc": f(np.log(mass / mass.sum())), "wo": f(np.zeros((HEADS, HIDDEN, CLASS))), "bo": f(np.log(counts.reshape(HEADS, CLASS))),
        }

    def encode(self, text: bytes | None) -> tuple[np.ndarray, list[bytes]]:
        """Numbers of the words (unknown ones: -1 - tail class), with the end; and the unknown words."""
        words = (text or b"").lower().split()
        get = self.numbers.get
        numbers = np.zeros(len(words) + 1, np.int32)
        numbers[:-1] = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        missing = np.flatnonzero(numbers < 0)
        unknown = [words[i] for i in missing]
        numbers[missing] = [-1 - tail_of(w) for w in unknown]
        return numbers, unknown

    def to_inputs(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers >= 0, self.inputs[np.maximum(numbers, 0)], HEAD - 1 - numbers).astype(np.int32)


def _recur(w: dict, x: np.ndarray, h: np.ndarray, keep: list | None = None, live: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """States of the steps of x (steps, texts), and the last. live: 0 where a text begins. keep: gets each step's state before, gates and candidate."""
    half = np.concatenate([np.full(2 * HIDDEN, 0.5, np.float32), np.ones(HIDDEN, np.float32)])  # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2
    g = (w["wx"] * half)[x]
    out = np.empty((len(x), *h.shape), np.float32)
    uzr, uc = w["uzr"] * np.float32(0.5), w["uc"]
    for t in range(len(x)):
        if live is not None:
            h = h * live[t]
        zr = np.matmul(h, uzr, out=keep[1][t] if keep else None)
        zr += g[t, :, : 2 * HIDDEN]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.matmul(r * h, uc, out=keep[2][t] if keep else None)
        c += g[t, :, 2 * HIDDEN :]
        np.tanh(c, out=c)
        if keep:
            keep[0][t] = h
        new = out[t]
        np.subtract(c, h, out=new)
        new *= z
        new += h
        h = new
    return out, h


def _class_of(y: np.ndarray) -> np.ndarray:
    return np.where(y < HEAD, y // CLASS, y - HEAD + HEADS)


def _by_class(y: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Places of the targets in head classes, class by class, and each class's slice of them."""
    kinds = np.minimum(y // CLASS, HEADS).astype(np.uint8)
    order = np.argsort(kinds, kind="stable")
    ends = np.searchsorted(kinds[order], np.arange(HEADS + 1))
    return order[: ends[HEADS]], [(k, slice(ends[k], ends[k + 1])) for k in range(HEADS) if ends[k + 1] > ends[k]]


def _row_sums(a: np.ndarray) -> np.ndarray:
    return a @ np.ones(a.shape[1], a.dtype)  # faster than sum, as rows are short


def _log_likelihood(w: dict, states: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(class) and, in head classes, of P(word | class)."""
    kinds = _class_of(y)
    logits = states @ w["wc"]
    logits += w["bc"]
    out = logits[np.arange(len(y)), kinds] - np.log(_row_sums(np.exp(logits, out=logits)))
    order, classes = _by_class(y)
    own, place = states[order], y[order] % CLASS
    logits = np.empty((len(order), CLASS), np.float32)
    for k, at in classes:
        np.matmul(own[at], w["wo"][k], out=logits[at])
        logits[at] += w["bo"][k]
    out[order] += logits[np.arange(len(order)), place] - np.log(_row_sums(np.exp(logits, out=logits)))
    return out


def _step(w: dict, past: dict, x: np.ndarray, y: np.ndarray, mask: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One update by back-propagation through a window; returns the last states."""
    keep = before, zr, c = [np.empty((*x.shape, k * HIDDEN), np.float32) for k in (1, 2, 1)]
    live = (x != 0).astype(np.float32)[:, :, None]  # after an end, another text begins
    states, last = _recur(w, x, h, keep, live)
    whole = mask.all()
    flat, target = (states.reshape(-1, HIDDEN), y.ravel()) if whole else (states[mask], y[mask])
    n = len(target)
    grad = {}
    p = flat @ w["wc"] + w["bc"]
    np.exp(p, out=p)
    p /= _row_sums(p)[:, None]
    p[np.arange(n), _class_of(target)] -= 1
    grad["wc"], grad["bc"] = flat.T @ p, p.sum(0)
    d_flat = p @ w["wc"].T
    heads, wo, bo = [], [], []
    order, classes = _by_class(target)
    own, place = flat[order], target[order] % CLASS
    q = np.empty((len(order), CLASS), np.float32)
    for k, at in classes:
        np.matmul(own[at], w["wo"][k], out=q[at])
        q[at] += w["bo"][k]
    np.exp(q, out=q)
    q /= _row_sums(q)[:, None]
    q[np.arange(len(order)), place] -= 1
    d_own = np.empty_like(own)
    for k, at in classes:
        heads.append(k)
        wo.append(own[at].T @ q[at])
        bo.append(q[at].sum(0))
        np.matmul(q[at], w["wo"][k].T, out=d_own[at])
    d_flat[order] += d_own
    if whole:
        d_states = d_flat.reshape(states.shape)
    else:
        d_states = np.zeros_like(states)
        d_states[mask] = d_flat
    dg = np.empty((*x.shape, 3 * HIDDEN), np.float32)
    dzr, dc = dg[:, :, : 2 * HIDDEN], dg[:, :, 2 * HIDDEN :]
    z, r = np.ascontiguousarray(zr[:, :, :HIDDEN]), np.ascontiguousarray(zr[:, :, HIDDEN:])
    rest = 1 - z
    to_c, to_z, to_r = z * (1 - c * c), (c - before) * z * rest, before * r * (1 - r)
    uc, uzr = np.ascontiguousarray(w["uc"].T), np.ascontiguousarray(w["uzr"].T)
    dh = np.zeros_like(h)
    for t in range(len(x) - 1, -1, -1):
        dh += d_states[t]
        np.multiply(dh, to_c[t], out=dc[t])
        drh = dc[t] @ uc
        np.multiply(dh, to_z[t], out=dzr[t, :, :HIDDEN])
        np.multiply(drh, to_r[t], out=dzr[t, :, HIDDEN:])
        dh *= rest[t]
        drh *= r[t]
        dh += drh
        dh += dzr[t] @ uzr
        dh *= live[t]
    flat_dg, flat_before = dg.reshape(-1, 3 * HIDDEN), before.reshape(-1, HIDDEN)
    grad["uc"] = (r.reshape(-1, HIDDEN) * flat_before).T @ flat_dg[:, 2 * HIDDEN :]
    grad["uzr"] = flat_before.T @ flat_dg[:, : 2 * HIDDEN]
    rows = {}
    order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
    met = x.ravel()[order]
    first = np.flatnonzero(np.diff(met, prepend=-1))
    rows["wx"], grad["wx"] = met[first], np.add.reduceat(flat_dg[order], first, axis=0)
    if heads:
        rows["wo"] = rows["bo"] = np.array(heads)
        grad["wo"], grad["bo"] = np.stack(wo), np.stack(bo)
    for k, g in grad.items():  # inputs and classes left out have no gradient and stay as they are
        at = rows.get(k, slice(None))
        g /= n
        np.clip(g, -1, 1, out=g)
        seen = past[k][at] + g * g
        past[k][at] = seen
        w[k][at] -= RATE * g / np.sqrt(seen + 1e-8)
    return last


def _windows(inputs: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of texts sorted by falling length: number of texts still there, inputs, targets and mask (steps, texts)."""
    lengths = np.array([len(i) for i in inputs])
    flat = np.concatenate(inputs)
    starts = np.cumsum(lengths) - lengths
    for at in range(0, int(lengths[0]), WINDOW):
        n = int(np.searchsorted(-lengths, -at, side="left"))
        steps = min(WINDOW, int(lengths[0]) - at)
        place = at + np.arange(steps)[:, None]
        mask = place < lengths[:n]
        where = starts[:n] + np.minimum(place, lengths[:n] - 1)
        y = flat[where]
        x = np.where(place > 0, flat[np.maximum(where - 1, 0)], 0)
        yield n, x, y, mask


def train_on(state: dict[str, np.ndarray], inputs: list[np.ndarray], width: int = WIDTH) -> dict[str, np.ndarray]:
    """Weights and sums of squared gradients (`past.` before the name) after one pass over the texts, in their order.

    The texts follow each other in one stream; a stretch of it is cut into `width` lanes that run side by side, window
    by window. A lane carries its state on, from 0 where a text begins.
    """
    w = {k: v for k, v in state.items() if not k.startswith("past.")}
    past = {k: state[f"past.{k}"] for k in w}
    y = np.concatenate(inputs)
    x = np.concatenate([np.zeros(1, y.dtype), y[:-1]])
    at = 0
    while at < len(y):
        stretch = len(y) - at if width >= WIDTH else min(len(y) - at, WINDOW * STEPS * width)
        long = -(-stretch // width)
        lanes = np.minimum(at + np.arange(width)[None, :] * long + np.arange(long)[:, None], len(y) - 1)
        mask = np.arange(width)[None, :] * long + np.arange(long)[:, None] < stretch
        h = np.zeros((width, HIDDEN), np.float32)
        for t in range(0, long, WINDOW):
            h = _step(w, past, x[lanes[t : t + WINDOW]], y[lanes[t : t + WINDOW]], mask[t : t + WINDOW], h)
        at, width = at + stretch, min(WIDTH, 2 * width)
    return w | {f"past.{k}": v for k, v in past.items()}


def score_chunk(w: dict, inputs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each text, without the words' shares of tail classes."""
    order = sorted(range(len(inputs)), key=lambda i: -len(inputs[i]))
    total = np.zeros(len(inputs))
    width = 4096
    for k in range(0, len(order), width):
        part = order[k : k + width]
        h = np.zeros((len(part), HIDDEN), np.float32)
        for n, x, y, mask in _windows([inputs[i] for i in part]):
            states, h = _recur(w, x, h[:n])
            each = np.zeros(mask.shape)
            each[mask] = _log_likelihood(w, states[mask], y[mask])
            total[part[:n]] += each.sum(0)
    return total


def _packed(w: dict) -> bytes:
    return b"".join(w[k].astype(np.float32).tobytes() for k in sorted(w))


def _unpacked(blob: bytes, like: dict) -> dict:
    out, at = {}, 0
    flat = np.frombuffer(blob, np.float32)
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _averaged(key, rows):
    total, weight = None, 0
    rows = rows.sort_by("part")
    for blob, n in zip(rows.column("blob").to_pylist(), rows.column("n").to_pylist()):
        part = np.frombuffer(blob, np.float32).astype(np.float64) * n
        total, weight = part if total is None else total + part, weight + n
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([weight], pa.int64()), "blob": pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary())})


def _frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words with counts above a bound, `most` at most; the bound is found by sums over counts of equal leading bits."""
    c = F.col("c")
    bits = F.floor(F.log2(c)).cast("int")
    level = F.when(c < 4096, c).otherwise(bits * 4096 + F.floor((c / F.pow(F.lit(2.0), bits) - 1) * 4096).cast("long"))  # some 200,000 levels at most
    found, bound = 0, None
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).orderBy(F.desc("level")).collect():
        found += r["n"]
        if found > most:
            break
        bound = r["least"]
    return counts.filter(c >= bound) if bound is not None else counts.filter("false")


def lexicon_of(counts: DataFrame) -> Lexicon:
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    words = sorted((tuple(r) for r in _frequent(counts, KNOWN).select("word", "tail", "c").collect()), key=lambda x: (-x[2], x[0].encode()))
    if all(w != END for w, _, _ in words):
        words += [tuple(r) for r in counts.filter(F.col("word") == END).select("word", "tail", "c").collect()]
    sums = {r[0]: float(r[1]) for r in counts.filter(F.col("word") != END).groupBy("tail").agg(F.sum("c").cast("double") + 0.1 * F.count(F.lit(1))).collect()}
    return Lexicon(words, sums, int(n), int(v))


def encoded(docs: DataFrame, held_out: Column, lexicon: Lexicon) -> DataFrame:
    """Per row: what its tokens say without the network (n_tokens, n_known, base_score and share, in logarithms to 10), the rare words, and the model's inputs (2 bytes each)."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    base_log = math.log10(lexicon.n + 0.1 * (lexicon.v + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = sent.value
        tail_logs = np.log10(lexicon.tail_sums)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            columns: list[list] = [[] for _ in range(7)]
            for text in b.column("text").to_pylist():
                numbers, unknown = lexicon.encode(text)
                x = lexicon.to_inputs(numbers)
                known = numbers[numbers >= 0]
                logs = lexicon.logs[known]
                share = logs[known >= HEAD].sum() - tail_logs[x[x >= HEAD] - HEAD].sum()
                for column, value in zip(columns, (row, len(numbers), len(known), share, logs.sum() - len(numbers) * base_log, [w.decode(errors="replace") for w in unknown], x.astype(np.uint16).tobytes())):
                    column.append(value)
                row += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), b.column("order"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["doc_id", "held_out", "order", "row_id", "n_tokens", "n_known", "share", "base_score", "unknown", "inputs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.xxhash64("doc_id", "text").alias("order"), F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(run, "doc_id long, held_out boolean, order long, row_id long, n_tokens long, n_known long, share double, base_score double, unknown array<string>, inputs binary"), "encoded")


def _trained(sent, shapes: dict[str, np.ndarray], width: int):
    def run(key, rows):
        rows = rows.sort_by([("order", "ascending"), ("piece", "ascending")])
        inputs = [np.frombuffer(x, np.uint16).astype(np.int32) for x in rows.column("inputs").to_pylist()]
        made = train_on(_unpacked(sent.value, shapes), inputs, width)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([sum(map(len, inputs))], pa.int64()), "blob": pa.array([_packed(made)], pa.binary())})

    return run


def learned(rows: DataFrame, lexicon: Lexicon) -> dict[str, np.ndarray]:
    """The weights after ROUNDS rounds over all training rows of encoded."""
    spark = rows.sparkSession
    shards = max(1, -(-lexicon.n // SHARD))
    pieces = rows.filter(~F.col("held_out")).select("order", "inputs", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / PIECE))).alias("piece"))
    pieces = pieces.select("order", "piece", F.expr(f"substring(inputs, cast(piece * {2 * PIECE} + 1 as int), {2 * PIECE})").alias("inputs"), F.pmod(F.xxhash64("order", "piece"), F.lit(shards)).alias("shard"))
    state = lexicon.start()
    state |= {f"past.{k}": np.full_like(v, 1e-3) for k, v in state.items()}
    shape = "part long, n long, blob binary"
    rounds = min(ROUNDS, shards)
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(_packed(state))
        shapes = {k: np.empty(v.shape, np.float32) for k, v in state.items()}

        made = materialize(pieces.filter(F.pmod("shard", F.lit(rounds)) == r).groupBy("shard").applyInArrow(_trained(sent, shapes, NARROW if r == 0 else WIDTH), shape), "weights", "snappy")
        while (parts := made.count()) > 1:
            narrower = materialize(made.withColumn("part", F.pmod(F.floor(F.col("part") / rounds), F.lit(max(1, parts // FAN)))).groupBy("part").applyInArrow(_averaged, shape), "weights", "snappy")
            discard(made)
            made = narrower
        got = made.collect()
        discard(made)
        if got:
            state = _unpacked(bytes(got[0]["blob"]), shapes)
    return {k: v for k, v in state.items() if not k.startswith("past.")}


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned from the rows not held out."""
    docs = drop_clashing(docs, "row_id", "unknown")
    counts = materialize(word_counts(docs.filter(~held_out).select(F.col("text").cast("binary").alias("text"))), "counts")
    lexicon = lexicon_of(counts)
    rows = encoded(docs, held_out, lexicon)
    sent = docs.sparkSession.sparkContext.broadcast(learned(rows, lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, inputs, size = [], [], 0

        def out() -> pa.RecordBatch:
            logs = score_chunk(sent.value, inputs) / math.log(10)
            done = pa.concat_tables([pa.Table.from_batches([p]) for p in parts]).combine_chunks()
            columns = {c: done.column(c) for c in ("row_id", "doc_id", "held_out", "n_tokens", "n_known", "base_score")}
            return pa.table(columns | {"score": pa.array(done.column("share").to_numpy() + logs)}).to_batches()[0]

        for b in batches:
            parts.append(b.drop_columns(["inputs"]))
            new = [np.frombuffer(x, np.uint16).astype(np.int32) for x in b.column("inputs").to_pylist()]
            inputs.extend(new)
            size += sum(map(len, new))
            if size > CHUNK:
                yield out()
                parts, inputs, size = [], [], 0
        if inputs:
            yield out()

    scored = rows.drop("unknown", "order").mapInArrow(run, "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    rare = rows.select("row_id", F.explode("unknown").alias("word")).join(counts.select("word", "c"), "word", "left")  # few are there twice in a text
    c = F.coalesce("c", F.lit(0))
    rare = rare.groupBy("row_id").agg(F.sum(F.log10(c + 0.1)).alias("more"), F.count_if(c > 0).alias("more_known"))
    out = scored.join(rare, "row_id", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(lexicon.n).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))
