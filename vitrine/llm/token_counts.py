"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie; every node has a failure link to the node reached when the longest pieces of its string have
been cut off, and the number of pieces so cut. A word's length in pieces then is a sum over one walk, without building
any piece and without going back in the text. The vocabulary file (a sentencepiece model, by default the one that this
environment provides; any other by its path) is read on the driver and its pieces are sent with the tasks; the automaton
is built once per Python worker, and counts of seen words are kept in a bounded memo.

Words are runs of other than space and tab to carriage return. A word that no piece begins starts with the bare mark of
a word's beginning, and a character without a piece counts as its bytes, if the vocabulary has these. Without them, a
word that cannot be cut into pieces is one unknown piece. Defined results: null and empty texts have 0 words and pieces; repeated rows
are counted alike; bytes that are not UTF-8 count as replacement characters.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MEMO = 200_000


def load_pieces(path: str = VOCABULARY) -> tuple[list[str], list[str]]:
    """Pieces that begin a word, and pieces that continue one, of a sentencepiece model; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    first, rest = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        if piece.startswith("▁"):
            if len(piece) > 1:
                first.append(piece[1:])
        else:
            rest.append(piece)
    return first, rest


def load_fallbacks(path: str = VOCABULARY) -> tuple[bool, bool]:
    """Whether the bare mark of a word's beginning is a piece, and whether there is a piece for every byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return any(model.id_to_piece(i) == "▁" for i in ids), sum(model.is_byte(i) for i in ids) == 256


class Automaton:
    """Node 0 is the root of a word's beginning, node 1 that of its continuation.

    bare: the beginning can be a piece of its own. by_bytes: a character without a piece is cut off as its bytes.
    """

    def __init__(self, first: Iterable[str], rest: Iterable[str], bare: bool = False, by_bytes: bool = False):
        self.by_bytes = by_bytes
        self.next: list[dict[str, int]] = [{}, {}]
        piece = [False, False]
        for root, words in ((0, first), (1, rest)):
            for w in words:
                at = root
                for c in w:
                    to = self.next[at].get(c)
                    if to is None:
                        to = self.next[at][c] = len(self.next)
                        self.next.append({})
                        piece.append(False)
                    at = to
                if w:
                    piece[at] = True
        n = len(self.next)
        self.fail, self.popped = [-1] * n, [0] * n
        if bare:
            self.fail[0], self.popped[0] = 1, 1
        queue = deque((0, 1))
        while queue:
            u = queue.popleft()
            for c, v in self.next[u].items():
                if piece[v]:
                    self.fail[v], self.popped[v] = 1, 1
                else:
                    z, cut, last = self.fail[u], self.popped[u], u
                    while z >= 0 and c not in self.next[z]:
                        cut += self.popped[z]
                        z, last = self.fail[z], z
                    if by_bytes and z < 0 and last == 1:
                        self.fail[v], self.popped[v] = 1, cut + len(c.encode())
                    elif z >= 0:
                        self.fail[v], self.popped[v] = self.next[z][c], cut
                queue.append(v)

    def count(self, word: str) -> int:
        """Number of pieces; 0 if the word can't be cut."""
        u, n = 0, 0
        nodes, fail, popped = self.next, self.fail, self.popped
        for c in word:
            to = nodes[u].get(c)
            while to is None:
                if fail[u] < 0:
                    if u != 1 or not self.by_bytes:
                        return 0
                    n += len(c.encode())
                    to = 1
                    break
                n += popped[u]
                u = fail[u]
                to = nodes[u].get(c)
            u = to
        while u != 1:
            if fail[u] < 0:
                return 0
            n += popped[u]
            u = fail[u]
        return n


class _Memo(dict):
    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word.decode(errors="replace"))
        if len(self) >= MEMO:
            self.clear()
        self[word] = n
        return n


_built: dict[bytes, _Memo] = {}


def _counter(broadcast) -> _Memo:
    if broadcast.id not in _built:
        _built.clear()
        _built[broadcast.id] = _Memo(Automaton(*broadcast.pieces))
    return _built[broadcast.id]


class _Pieces:
    def __init__(self, pieces):
        self.pieces, self.id = pieces, hashlib.md5(repr(pieces).encode()).digest()


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs with n_words, n_tokens (an unknown word is one) and n_unknown."""
    sent = docs.sparkSession.sparkContext.broadcast(_Pieces((*load_pieces(vocabulary), *load_fallbacks(vocabulary))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _counter(sent.value)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column("vitrine_text").to_pylist():
                counts = [memo[w] for w in text.split()] if text else []
                missed = counts.count(0)
                words.append(len(counts))
                tokens.append(sum(counts) + missed)
                unknown.append(missed)
            made = [pa.array(x, pa.int64()) for x in (words, tokens, unknown)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=[*keep, "n_words", "n_tokens", "n_unknown"])

    rows = docs.select(*keep, F.col("text").cast("binary").alias("vitrine_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(run, f"{kept}, n_words long, n_tokens long, n_unknown long")
