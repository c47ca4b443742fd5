"""BPE encoding and decoding with forced boundaries.

Two neighbouring bytes that stand next to each other in no vocabulary token can
never end up in one token: every merge result is a vocabulary token and would
contain the pair.  Such pairs are certain cuts.  A word is cut at all of them,
the fragments are encoded on their own by merge rank, and their ids are
concatenated.  Text is split at ASCII white space first (no pre-token crosses
it), and equal chunks, words and fragments are encoded once a batch of work.

The vocabulary file is a parameter; it is read on each executor, or carried to
them as text (:func:`load_vocabulary`).  Special tokens found in the raw text
become their ids, as the library does by default.

Defined results: null and empty text give no ids and decode to the empty
string; rows that repeat a doc_id are encoded each; empty tables give empty
results; other columns are not read.  Texts are encoded whole, one row at a
time; memory is bounded by the longest text and the cache bound.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import slices, text_of, tidied

VOCABULARY = "word_bpe_49k.json"
#: Distinct chunks and words that a task keeps before it starts its cache anew.
CACHE_ENTRIES = 150_000
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_SPLIT = re.compile(r"[ \t\n\r]+")
#: Only these characters go the short way; everything else asks the library's own splitter.
_PLAIN = re.compile(r"[!-~¡-ɏ]*\Z")
_KEPT_CONTROLS = re.compile(r"[\x1c-\x1f]")
_END = "</w>"
#: Rank of a pair that never merges.
NO_MERGE = 1 << 40
#: Fragments longer than this many bytes are merged one by one.
LONG_FRAGMENT = 256
#: Characters of text that are split and encoded side by side.
GROUP_CHARS = 2_000_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(0x100 + k)
    return [letters[b] for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file with word ends."""

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(vocabulary)
        spec = json.loads(vocabulary)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokens: list[str] = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        alphabet = _byte_alphabet()
        self.start = [vocab[c] for c in alphabet]
        self.last = [vocab[c + _END] for c in alphabet]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        ranked = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[ranked], ranked
        self.made = np.array([m for _, m in self.merges.values()], np.int64)
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.inner, self.final = self._pairs(vocab, self.byte_of)
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    @staticmethod
    def _pairs(vocab: dict[str, int], byte_of: dict[str, int]) -> tuple[set[int], set[int]]:
        """Byte pairs (a * 256 + b) inside some token; ``final``: with b at the end of a word."""
        inner: set[int] = set()
        final: set[int] = set()
        for token in vocab:
            ends = token.endswith(_END) and len(token) > len(_END)
            raw = [byte_of[c] for c in (token[: -len(_END)] if ends else token) if c in byte_of]
            pairs = [a * 256 + b for a, b in zip(raw, raw[1:])]
            if ends and pairs:
                final.add(pairs.pop())
            inner.update(pairs)
        return inner, final

    def cuts(self, word: bytes) -> list[int]:
        """Positions inside ``word`` where a forced boundary lies."""
        n = len(word)
        inner, out = self.inner, []
        for i in range(1, n - 1):
            if word[i - 1] * 256 + word[i] not in inner:
                out.append(i)
        if n > 1 and word[-2] * 256 + word[-1] not in self.final:
            out.append(n - 1)
        return out

    def _rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, or ``NO_MERGE``."""
        key = first.astype(np.int64) << 32 | second
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_MERGE)

    def merge(self, fragments: list[list[int]]) -> list[np.ndarray]:
        """Merges by rank, the leftmost of equals first, in all fragments side by side.

        The ids of all fragments lie in one array.  Each round finds the best pair of
        every fragment, merges it, and drops the fragments that are done.
        """
        done: list[np.ndarray] = [np.empty(0, np.int64)] * len(fragments)
        lengths = np.array([len(f) for f in fragments], np.int64)
        ids = np.fromiter(itertools.chain.from_iterable(fragments), np.int64, int(lengths.sum()))
        owner = np.arange(len(fragments))
        ranks = np.full(len(ids), NO_MERGE)
        if len(ids) > 1:
            ranks[:-1] = self._rank(ids[:-1], ids[1:])
        ends = np.cumsum(lengths)
        ranks[ends - 1] = NO_MERGE
        while len(owner):
            starts = ends - lengths
            best = np.minimum.reduceat(ranks, starts)
            over = best == NO_MERGE
            if over.any():
                for k in np.flatnonzero(over):
                    done[owner[k]] = ids[starts[k]:ends[k]]
                keep = np.repeat(~over, lengths)
                ids, ranks = ids[keep], ranks[keep]
                owner, lengths, best = owner[~over], lengths[~over], best[~over]
                if not len(owner):
                    break
                ends = np.cumsum(lengths)
                starts = ends - lengths
            hits = np.flatnonzero(ranks == np.repeat(best, lengths))
            whose = np.searchsorted(ends, hits, side="right")
            at = hits[np.concatenate(([True], whose[1:] != whose[:-1]))]  # the leftmost of each
            ids[at] = self.made[best]
            stay = np.ones(len(ids), bool)
            stay[at + 1] = False
            ids, ranks = ids[stay], ranks[stay]
            at = at - np.arange(len(at))  # each fragment before has lost one id
            lengths = lengths - 1
            ends = np.cumsum(lengths)
            new_pairs = at[at + 1 < len(ids)]
            ranks[new_pairs] = self._rank(ids[new_pairs], ids[new_pairs + 1])
            earlier = at[at > 0] - 1
            ranks[earlier] = self._rank(ids[earlier], ids[earlier + 1])
            ranks[ends - 1] = NO_MERGE
        return done

    def _merge_long(self, ids: list[int]) -> np.ndarray:
        """The same for one long fragment without a cut: a heap over a linked list."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        heap = [(m[0], k, ids[k], ids[k + 1], m[1]) for k in range(n - 1)
                if (m := merges.get((ids[k], ids[k + 1]))) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, k, a, b, made = heapq.heappop(heap)
            j = after[k]
            if gone[k] or j >= n or ids[k] != a or ids[j] != b:
                continue
            ids[k], gone[j], after[k] = made, True, after[j]
            if after[j] < n:
                before[after[j]] = k
                if (m := merges.get((made, ids[after[j]]))) is not None:
                    heapq.heappush(heap, (m[0], k, made, ids[after[j]], m[1]))
            if (p := before[k]) >= 0 and (m := merges.get((ids[p], made))) is not None:
                heapq.heappush(heap, (m[0], p, ids[p], made, m[1]))
        return np.array([x for x, g in zip(ids, gone) if not g], np.int64)

    def learn_words(self, words: Iterable[bytes]) -> None:
        """Encodes pre-tokens (their UTF-8 bytes, each once) into the cache, fragment by fragment."""
        order: list[bytes] = []
        counts: list[int] = []
        fragments: list[list[int]] = []
        long: dict[int, np.ndarray] = {}
        start, last = self.start, self.last
        for raw in words:
            at, n = 0, len(raw)
            cuts = self.cuts(raw)
            ids = [start[b] for b in raw]
            ids[-1] = last[raw[-1]]
            order.append(raw)
            counts.append(len(cuts) + 1)
            for cut in [*cuts, n]:
                if cut - at > LONG_FRAGMENT:
                    long[len(fragments)] = self._merge_long(ids[at:cut])
                    fragments.append([ids[at]])
                else:
                    fragments.append(ids[at:cut])
                at = cut
        merged = self.merge(fragments)
        for k, ids_of in long.items():
            merged[k] = ids_of
        k = 0
        for raw, count in zip(order, counts):
            self.words[raw] = b"".join([x.astype("<u4").tobytes() for x in merged[k:k + count]])
            k += count

    def _split(self, text: str) -> list[bytes]:
        """Pre-tokens of text without special tokens, by the library's own rules."""
        pieces = self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(text))
        return [bytes([self.byte_of[c] for c in piece]) for piece, _ in pieces]

    def _split_odd(self, chunk: str) -> list[bytes | int]:
        """Pre-tokens of any chunk; special tokens stand as their ids."""
        out, at = [], 0
        for m in self.special_at.finditer(chunk):
            out += [*self._split(chunk[at:m.start()]), self.special[m[0]]]
            at = m.end()
        return [*out, *self._split(chunk[at:])]

    def learn(self, chunks: Iterable[str]) -> None:
        """Encodes chunks (non-empty, without ASCII white space) into the cache."""
        split: dict[str, list[bytes | int]] = {}
        plain: list[str] = []
        for c in chunks:
            if _PLAIN.match(c) and not ("<|" in c and self.special_at.search(c)):
                plain.append(c)
            else:
                split[c] = self._split_odd(c)
        # A space is a fixed point of the normaliser and no plain chunk holds one: many at once.
        for k in range(0, len(plain), 5000):
            part = plain[k:k + 5000]
            normal = self.lib.normalizer.normalize_str(" ".join(part)).split(" ")
            for chunk, text in zip(part, normal, strict=True):
                split[chunk] = [w.encode() for w in _PIECES.findall(text)]
        if len(self.words) >= CACHE_ENTRIES:
            self.words.clear()
        words = self.words
        new = {w for pieces in split.values() for w in pieces if not isinstance(w, int) and w not in words}
        if new:
            self.learn_words(new)
        for chunk, pieces in split.items():
            self.chunks[chunk] = b"".join(
                [words[w] if not isinstance(w, int) else w.to_bytes(4, "little") for w in pieces])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        # str.split() also splits at four control characters that the vocabulary's rules keep.
        parts = [_SPLIT.split(t) if _KEPT_CONTROLS.search(t) else t.split() for t in texts]
        if len(self.chunks) >= CACHE_ENTRIES:
            self.chunks.clear()
        chunks = self.chunks
        chunks[""] = b""
        new = {c for own in parts for c in own if c not in chunks}
        if new:
            self.learn(new)
        return [b"".join([chunks[c] for c in own]) for own in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space: this vocabulary file names no decoder of its own."""
        got = array("I")
        got.frombytes(ids)
        return " ".join(map(self.tokens.__getitem__, got))


def load_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encode_batches(path: str, batches: Iterator[pa.RecordBatch], codec: Codec | None = None) -> Iterator[pa.RecordBatch]:
    codec = codec or Codec(load_vocabulary(path))
    for batch in slices(batches, 1024):
        out: list[bytes] = []
        group: list[str] = []
        chars = 0
        for s in batch.column(1):
            group.append(s.as_py() or "")
            chars += len(group[-1])
            if chars >= GROUP_CHARS:
                out += codec.encode_batch(group)
                group, chars = [], 0
        out += codec.encode_batch(group)
        yield pa.record_batch([batch.column(0), pa.array([len(x) // 4 for x in out], pa.int64()),
                               pa.array(out, pa.binary())], names=["doc_id", "n_tokens", "ids"])


def _decode_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = Codec(load_vocabulary(path))
    for batch in slices(batches):
        decoded = [codec.decode(x.as_py() or b"") for x in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(decoded, pa.string())],
                              names=["doc_id", "n_tokens", "ids", "decoded"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of each document."""
    place = path or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(lambda it: _encode_batches(place, it), "doc_id bigint, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``decoded``, the text that the ids stand for."""
    place = path or vocabulary_path()
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        lambda it: _decode_batches(place, it), "doc_id bigint, n_tokens bigint, ids binary, decoded string")


def _digest_batches(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoding and decoding with one codec; only digests leave the task."""
    codec = Codec(load_vocabulary(path))
    digest = lambda raw: hashlib.sha256(raw).hexdigest()
    tokens = np.array([t.encode() for t in codec.tokens], object)
    decoded = lambda ids: b" ".join(tokens[np.frombuffer(ids, "<u4")].tolist())  # noqa: E731  as Codec.decode()
    for batch in _encode_batches(path, batches, codec):
        ids = [x.as_py() or b"" for x in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(map(digest, ids), pa.string()),
                               pa.array((digest(decoded(x)) for x in ids), pa.string())],
                              names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the decoded text."""
    place = path or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(lambda it: tidied(_digest_batches(place, it)),
                           "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
