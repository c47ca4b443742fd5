"""Language identification by unigram pieces, summed over all segmentations.

A language is a distribution over the pieces of a fixed public vocabulary (a rank
file of byte strings; every single byte is a piece, so every word has a
segmentation).  A word's probability is the sum, over all ways to cut it into
pieces, of the product of their probabilities; the forward algorithm adds them up
by end position.  A text's score for a language is the sum of its words' log
probabilities plus the log of the language's share of documents.

Words are maximal runs of letters in lower case with a space before them, as the
vocabulary writes word starts; a run of more than ``UNIT_BYTES`` bytes is scored in
that many bytes at a time.  Pieces with other characters fit no word and are left out.  Piece counts are expected counts: forward and backward
sums over all segmentations with equal piece weights, over the words of all
learning documents, with no sample.  They are added up as whole numbers, so reruns
agree to the last bit.  A model is a number a piece and language; that is all that
tasks and the driver hold, whatever the corpus.

Defined results: null texts and texts without a letter are ``und`` with score 0, and
so is every text when no document can be learned from; rows that repeat a doc_id
are learned from and predicted each; a null doc_id is held out; equal scores go to
the language first in code point order; empty tables give empty results; columns
other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import slices
from voltframe.llm.labelled import crc_remainder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
UNKNOWN = "und"
UNIT_BYTES = 32
#: Share of a language's probability that is spread evenly over all pieces.
EVEN = 0.01
#: Expected counts are added up in this fraction of one.
GRAIN = 1 << 20
#: Distinct words that a task keeps before it starts its cache anew.
CACHE_ENTRIES = 300_000
#: Units that go through the forward algorithm side by side.
CHUNK = 8_000
_LETTERS = regex.compile(r"\p{L}+")
_LOWER = bytes(range(ord("a"), ord("z") + 1))
#: Bytes of scored units: a space, letters a to z, and whatever is beyond ASCII.
_WORD_BYTES = b" " + _LOWER + bytes(range(128, 256))
#: ASCII letters in lower case; other ASCII characters as spaces.
_FOLDED = bytes(b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def held_out_fold(column: str = "doc_id") -> Column:
    return crc_remainder(F.col(column), 5) == 0


@dataclass
class Edges:
    """Pieces found in a row of units: from byte position ``start`` to ``end``, in steps of the forward algorithm."""
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    steps: np.ndarray  # bounds of runs with one end (counted in the unit) and one length
    first: np.ndarray  # of each unit, its first position
    last: np.ndarray


class Pieces:
    """The vocabulary as a trie over bytes; byte column 0 stands between units and leads nowhere."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.size = len(tokens)
        used = sorted(set(b"".join(tokens)))
        self.column = np.zeros(256, np.int32)
        for k, byte in enumerate(used):
            self.column[byte] = k + 1
        nodes: dict[bytes, int] = {b"": 0}
        for token in tokens:
            for n in range(1, len(token) + 1):
                nodes.setdefault(token[:n], len(nodes))
        self.child = np.full((len(nodes), len(used) + 1), -1, np.int32)
        for prefix, node in nodes.items():
            if prefix:
                self.child[nodes[prefix[:-1]], self.column[prefix[-1]]] = node
        self.piece = np.full(len(nodes), -1, np.int32)
        for k, token in enumerate(tokens):
            self.piece[nodes[token]] = k

    def edges(self, units: list[bytes]) -> Edges:
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        last = np.cumsum(sizes + 1) - 1
        first = last - sizes
        row = np.zeros(int(last[-1]) + 2 if len(units) else 1, np.int32)
        inside = np.ones(len(row), bool)
        inside[last] = inside[-1] = False
        row[inside] = self.column[np.frombuffer(b"".join(units), np.uint8)]
        offset = np.arange(len(row)) - np.repeat(np.append(first, len(row) - 1),
                                                 np.append(sizes + 1, 1))[:len(row)]
        at, node = np.flatnonzero(inside), 0
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        length = 0
        while len(at):
            node = self.child[node, row[at + length]]
            live = node >= 0
            at, node = at[live], node[live]
            length += 1
            whole = self.piece[node]
            hit = whole >= 0
            found.append((at[hit], np.full(int(hit.sum()), length), whole[hit]))
        nothing = [(np.empty(0, np.int64),) * 3]
        start, length_of, piece = (np.concatenate(x) for x in zip(*(found or nothing)))
        end = start + length_of
        key = (offset[start] + length_of) * (UNIT_BYTES + 1) + length_of
        order = np.argsort(key, kind="stable")
        key = key[order]
        steps = np.flatnonzero(np.diff(key, prepend=-1, append=-1)) if len(key) else np.zeros(1, np.int64)
        return Edges(start[order], end[order], piece[order], steps, first, last)

    @staticmethod
    def forward(e: Edges, weight: np.ndarray) -> np.ndarray:
        """By byte position, the summed probability of all segmentations from the unit's start; ``weight``: piece x model."""
        total = np.zeros((int(e.last[-1]) + 2 if len(e.last) else 1, weight.shape[1]))
        total[e.first] = 1.0
        for a, b in zip(e.steps[:-1], e.steps[1:]):
            # One end and one length: no position occurs twice.
            total[e.end[a:b]] += total[e.start[a:b]] * weight[e.piece[a:b]]
        return total

    def expected(self, units: list[bytes], counts: np.ndarray) -> np.ndarray:
        """piece x language: expected uses of pieces in ``units``, that a language has ``counts`` times, in GRAINs."""
        out = np.zeros((self.size, counts.shape[1]))
        if not units:
            return out
        e = self.edges(units)
        even = np.full((self.size, 1), 1.0 / self.size)
        ahead = self.forward(e, even)[:, 0]
        behind = np.zeros(len(ahead))
        behind[e.last] = 1.0
        for a, b in zip(e.steps[:-1][::-1], e.steps[1:][::-1]):
            # Ends come in falling order, so what lies behind an end is complete; starts differ within a step.
            behind[e.start[a:b]] += behind[e.end[a:b]] / self.size
        unit = np.searchsorted(e.last, e.start)
        share = ahead[e.start] * behind[e.end] / self.size / ahead[e.last][unit]
        grains = np.rint(share * GRAIN)
        for k in range(counts.shape[1]):
            out[:, k] = np.bincount(e.piece, grains * counts[unit, k], self.size)
        return out


@functools.lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    """The vocabulary's pieces that words can have, read once by each Python process."""
    with open(path, "rb") as f:
        tokens = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return Pieces([t for t in tokens if not t.strip(_WORD_BYTES)])


def units_of(word: bytes) -> list[bytes]:
    """The scored byte strings of a text without white space, ASCII letters in lower case already."""
    if word.isascii():
        runs = [word]
    else:
        runs = [x.encode() for x in _LETTERS.findall(word.decode().lower())]
    return [(b" " + run)[k:k + UNIT_BYTES] for run in runs for k in range(0, len(run) + 1, UNIT_BYTES)]


class Words:
    """Words of texts by number, kept once until there are too many."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}

    def numbers(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").translate(_FOLDED).split()
        known = self.number
        for w in set(words).difference(known):
            known[w] = len(known)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def units(self, since: int = 0) -> tuple[list[bytes], np.ndarray]:
        """The units of the words from number ``since`` on, and each unit's word less ``since``."""
        parts = list(map(units_of, itertools.islice(self.number, since, None)))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return list(itertools.chain.from_iterable(parts)), np.repeat(np.arange(len(parts)), sizes)


def _count_batches(path: str, languages: list[str], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pieces, place = load_pieces(path), {x: k for k, x in enumerate(languages)}
    total = np.zeros((pieces.size, len(languages)), np.int64)

    def settled(words: Words, seen: list[np.ndarray]) -> np.ndarray:
        units, word = words.units()
        counts = np.stack([np.pad(x, (0, len(words.number) - len(x))) for x in seen], 1)
        # Whole numbers below 2 ** 53, so the order of adding is no matter.
        return sum((pieces.expected(units[k:k + CHUNK], counts[word[k:k + CHUNK]]).astype(np.int64)
                    for k in range(0, len(units), CHUNK)), np.zeros_like(total))

    words, seen = Words(), [np.zeros(0, np.int64)] * len(languages)
    for batch in slices(batches):
        numbers: list[list[np.ndarray]] = [[] for _ in languages]
        for text, lang in zip(batch.column(0), batch.column(1)):
            numbers[place[lang.as_py()]].append(words.numbers(text.as_py()))
        for k, own in enumerate(numbers):
            here = np.bincount(np.concatenate([*own, np.zeros(0, np.int64)]), minlength=len(seen[k]))
            here[:len(seen[k])] += seen[k]
            seen[k] = here
        if len(words.number) > CACHE_ENTRIES:
            total += settled(words, seen)
            words, seen = Words(), [np.zeros(0, np.int64)] * len(languages)
    total += settled(words, seen)
    for k, lang in enumerate(languages):
        piece = np.flatnonzero(total[:, k])
        yield pa.record_batch([pa.array([lang] * len(piece), pa.string()), pa.array(piece, pa.int32()),
                               pa.array(total[piece, k], pa.int64())], names=["lang", "piece", "grains"])


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray   # log share of documents
    weight: np.ndarray  # piece x language, probabilities
    path: str


def train(docs: DataFrame, held_out: Column | None = None, path: str | None = None) -> Model:
    """Piece probabilities of every language among the documents that are not held out."""
    path = path or vocabulary_path()
    held_out = held_out_fold() if held_out is None else held_out
    rows = docs.where(~held_out & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("text").cast("string").cast("binary").alias("text"), F.col("lang").cast("string").alias("lang"))
    # A row a language, and below a row a piece and language: the model itself.
    share = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())
    languages = [x for x, _ in share]
    size = load_pieces(path).size
    counts = np.zeros((size, len(languages)))
    if languages:
        got = (rows.mapInArrow(lambda it: _count_batches(path, languages, it),
                               "lang string, piece int, grains bigint")
               .groupBy("lang", "piece").agg(F.sum("grains").alias("grains")).toPandas())
        place = {x: k for k, x in enumerate(languages)}
        counts[got["piece"].to_numpy(int), got["lang"].map(place).to_numpy(int)] = got["grains"].to_numpy(float) / GRAIN
    sums = np.maximum(counts.sum(0), 1e-9)
    weight = (1 - EVEN) * counts / sums + EVEN / size
    docs_of = np.array([n for _, n in share], float)
    return Model(languages, np.log(docs_of / max(docs_of.sum(), 1)), weight, path)


def word_scores(model: Model, units: list[bytes], pieces: Pieces | None = None) -> np.ndarray:
    """unit x language: log of the summed probability of all segmentations."""
    pieces = pieces or load_pieces(model.path)
    out = [np.zeros((0, len(model.languages)))]
    for k in range(0, len(units), CHUNK):
        e = pieces.edges(units[k:k + CHUNK])
        out.append(np.log(pieces.forward(e, model.weight)[e.last]))
    return np.concatenate(out)


class Scorer:
    """Sums of word scores by text, with the words met so far kept."""

    def __init__(self, model: Model) -> None:
        self.model, self.pieces = model, load_pieces(model.path)
        self.reset()

    def reset(self) -> None:
        self.words = Words()
        self.scores = np.zeros((0, len(self.model.languages) + 1))  # the last column counts units

    def learn(self) -> None:
        units, word = self.words.units(len(self.scores))
        if len(self.words.number) == len(self.scores):
            return
        scores = np.append(word_scores(self.model, units, self.pieces), np.ones((len(units), 1)), 1)
        n = len(self.words.number) - len(self.scores)
        self.scores = np.append(self.scores, np.stack([np.bincount(word, x, n) for x in scores.T], 1), 0)

    def sums(self, texts: list[bytes | None]) -> np.ndarray:
        if len(self.words.number) > CACHE_ENTRIES:
            self.reset()
        numbers = [self.words.numbers(t) for t in texts]
        self.learn()
        return np.stack([self.scores[n].sum(0) for n in numbers])


def _score_batches(model: Model, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(model)
    n = len(model.languages)
    for batch in slices(batches):
        sums = scorer.sums([x.as_py() for x in batch.column("text")])
        z = sums[:, :n] + model.prior
        best = z.argmax(1)
        score = 1 / np.exp(np.minimum(z - z[np.arange(len(z)), best][:, None], 0)).sum(1)
        lettered = sums[:, n] > 0
        names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                               pa.array(np.where(lettered, score, 0.0))],
                              names=["doc_id", "held_out", "lang_pred", "score"])


_SCORED = "doc_id bigint, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, model: Model, held_out: Callable[[str], Column] = held_out_fold) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the language's posterior probability) of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out("doc_id").alias("held_out"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    if not model.languages:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    # The model is a number a piece and language, sent once to each executor.
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda it: _score_batches(sent.value, it), _SCORED)


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Learns from the documents outside the held-out fold and predicts all."""
    return predict(docs, train(docs, path=path))
