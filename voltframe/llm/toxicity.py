"""Toxicity: a factorization machine over hashed terms.

A document's terms are its distinct lower-cased runs of letters and digits and
the stems (first ``STEM`` characters) of the longer ones, hashed to ``DIMENSIONS``
slots.  The score is the logistic of a bias, a weight per term, and for every pair
of terms the inner product of their factors, so that terms can count together (an
insult with a mention of a group) that mean little alone.  The pair sum needs one
pass over the terms.

The machine is fitted with AdaGrad on a bounded sample (``PER_CLASS`` documents of
each class at most; fewer labelled rows are all used), whose classes are weighed
back to their shares.  A term whose link with the label in the sample can be chance
(likelihood ratio, corrected for the number of terms) is kept only for its pairs: if
it is frequent (``FREQUENT``) and its presence together with another frequent term
is linked with the label by more than chance (corrected for the number of pairs).
Rare words are not learned by heart, and the model's size is bounded by the sample.
Scoring covers every whole text.

Defined results: null and empty text have no terms and score the bias; documents
that repeat a doc_id are scored each, and count once in training; without any
label, or with one class only, the scores are that share of toxic labels (0 for
none); only doc_id and text of documents are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import free_name, slices, text_of, tidied
from voltframe.llm.labelled import crc_remainder, sampled_labels

DIMENSIONS = 1 << 31
STEM = 4
#: Times the logarithm of the number of terms that a likelihood ratio must exceed.
CHANCE = 1.4
#: Share of the sample's documents that must have a term for its pairs to be tested.
FREQUENT = 0.02
#: The same as ``CHANCE`` for pairs: at twice the logarithm less than one pair in all passes by chance.
PAIR_CHANCE = 2.0
#: Terms whose pairs are counted at once (a matrix of this width by the sample).
PAIR_TERMS = 128
FACTORS = 4
PER_CLASS = 10_000
EPOCHS = 8
BATCH = 256
RATE = 0.1
DECAY = 1e-4
SEED = 5
REJECT_AT = 0.5


def terms(text: Column) -> Column:
    """The slots of a text's distinct terms."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    slot = lambda kind, w: F.pmod(F.xxhash64(F.lit(kind), w), F.lit(DIMENSIONS)).cast("int")
    whole = F.transform(words, lambda w: slot(0, w))
    stems = F.transform(F.filter(words, lambda w: F.length(w) > STEM), lambda w: slot(1, F.substring(w, 1, STEM)))
    return F.array_union(whole, stems)


@dataclass
class Machine:
    bias: float
    slots: np.ndarray  # the known slots, ascending
    weights: np.ndarray  # one for each known slot, and 0 at the end for all others
    factors: np.ndarray  # the same, times FACTORS

    def margins(self, slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log odds of each document; ``starts`` has an end as its last entry."""
        n = len(starts) - 1
        owner = np.repeat(np.arange(n), np.diff(starts))
        at = np.searchsorted(self.slots, slots)
        if len(self.slots):
            known = self.slots[np.minimum(at, len(self.slots) - 1)] == slots
            owner, at = owner[known], at[known]
        z = self.bias + np.bincount(owner, self.weights[at], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f].astype(np.float64)
            z += 0.5 * (np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n))
        return z

    def scores(self, slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return logistic(self.margins(slots, starts))


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def constant(share: float) -> Machine:
    share = min(1 - 1e-9, max(1e-9, share))
    return Machine(float(np.log(share / (1 - share))), np.empty(0, np.int32), np.zeros(1, np.float32),
                   np.zeros((1, FACTORS), np.float32))


def likelihood_ratio(n: np.ndarray, ones: np.ndarray, share: float) -> np.ndarray:
    """How much better ``ones`` of ``n`` documents are explained by a share of their own than by ``share``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * (np.where(ones > 0, ones * np.log(ones / (n * share)), 0.0)
                    + np.where(n > ones, (n - ones) * np.log((n - ones) / (n * (1 - share))), 0.0))


def linked(owner: np.ndarray, slots: np.ndarray, n_slots: int, labels: np.ndarray) -> np.ndarray:
    """Which slots' counts of documents of label 1 differ from their share by more than chance."""
    n = np.bincount(slots, minlength=n_slots).astype(float)
    ones = np.bincount(slots, labels[owner], n_slots)
    return likelihood_ratio(n, ones, labels.mean()) > CHANCE * np.log(max(2, n_slots))


def paired(owner: np.ndarray, slots: np.ndarray, n_slots: int, labels: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which of the frequent slots ``among`` are linked with the label together with another of them."""
    n = np.bincount(slots, minlength=n_slots)
    chosen = np.flatnonzero(among & (n >= max(2, FREQUENT * len(labels))))
    out = np.zeros(n_slots, bool)
    if len(chosen) < 2:
        return out
    by_slot, ends = owner[np.argsort(slots, kind="stable")], np.cumsum(n)

    def block(at: int) -> np.ndarray:
        terms_ = chosen[at:at + PAIR_TERMS]
        held = np.zeros((len(labels), len(terms_)), np.float32)
        for k, t in enumerate(terms_):
            held[by_slot[ends[t] - n[t]:ends[t]], k] = 1
        return held

    bound = PAIR_CHANCE * np.log(len(chosen) * (len(chosen) - 1) / 2 + 1)
    toxic = labels.astype(np.float32)[:, None]
    for i in range(0, len(chosen), PAIR_TERMS):
        left = block(i)
        for j in range(i, len(chosen), PAIR_TERMS):
            right = block(j) if j > i else left
            hit = likelihood_ratio(left.T @ right, left.T @ (right * toxic), labels.mean()) > bound
            if i == j:
                np.fill_diagonal(hit, False)
            out[chosen[i:i + PAIR_TERMS][hit.any(1)]] = True
            out[chosen[j:j + PAIR_TERMS][hit.any(0)]] = True
    return out


def fit(slots: np.ndarray, starts: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> Machine:
    """AdaGrad on the weighted log loss over the slots that are linked with the label, alone or in a pair."""
    seen, slots = np.unique(slots, return_inverse=True)
    slots = slots.astype(np.int32)
    owner = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(starts))
    enough = linked(owner, slots, len(seen), labels)
    enough |= paired(owner, slots, len(seen), labels, ~enough)
    keep = enough[slots]
    place = np.cumsum(enough, dtype=np.int32) - 1
    del owner
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    starts, slots, seen = kept_before[starts], place[slots[keep]], seen[enough]
    share = float((labels * importance).sum() / importance.sum())
    machine = constant(share)
    rng = np.random.default_rng(SEED)
    w = np.zeros(len(seen) + 1)
    v = np.zeros((len(seen) + 1, FACTORS))
    v[:-1] = rng.normal(0.0, 0.01, (len(seen), FACTORS))
    w_sum, v_sum, b, b_sum = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), machine.bias, 1e-2
    importance = importance / importance.mean()
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for k in range(0, len(order), BATCH):
            docs = order[k:k + BATCH]
            sizes = starts[docs + 1] - starts[docs]
            owner = np.repeat(np.arange(len(docs)), sizes)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ids, local = np.unique(slots[np.repeat(starts[docs], sizes) + within], return_inverse=True)
            wi, vi, n = w[ids], v[ids], len(docs)
            sums = np.stack([np.bincount(owner, vi[local, f], n) for f in range(FACTORS)], 1)
            squares = np.bincount(owner, (vi * vi).sum(1)[local], n)
            z = b + np.bincount(owner, wi[local], n) + 0.5 * ((sums ** 2).sum(1) - squares)
            g = importance[docs] * (logistic(z) - labels[docs]) / np.sqrt(n)
            per_term = g[owner]
            gw = np.bincount(local, per_term, len(ids)).astype(float)
            gv = np.stack([np.bincount(local, per_term * sums[owner, f], len(ids)) for f in range(FACTORS)], 1).astype(float)
            gv -= vi * gw[:, None]
            gw += DECAY * wi
            gv += DECAY * vi
            w_sum[ids] += gw ** 2
            v_sum[ids] += gv ** 2
            w[ids] = wi - RATE * gw / np.sqrt(w_sum[ids])
            v[ids] = vi - RATE * gv / np.sqrt(v_sum[ids])
            b_sum += g.sum() ** 2
            b -= RATE * g.sum() / np.sqrt(b_sum)
    return Machine(float(b), seen.astype(np.int32), w.astype(np.float32), v.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int = PER_CLASS) -> Machine:
    """Fits a machine to the labels that are not held out."""
    sample, stands_for = sampled_labels(labels, "toxic", held_out, per_class)
    # At most 2 * per_class rows of two numbers.
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of("text").alias("text"))
            .join(F.broadcast(sample), "doc_id")
            .select("doc_id", "label", terms(F.col("text")).alias("slots"))
            .groupBy("doc_id", "label").agg(F.min("slots").alias("slots")))
    table = rows.toArrow().combine_chunks().sort_by("doc_id")
    if not table.num_rows:
        return constant(0.0)
    y = table["label"].to_numpy().astype(float)
    if y.min() == y.max():
        return constant(y[0])
    slots, starts = _flat(table["slots"].combine_chunks())
    return fit(slots, starts, y, np.array(stands_for)[y.astype(int)])


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], lists.type)
    starts = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy(zero_copy_only=False)[starts[0]:starts[-1]], starts - starts[0]


def _score(machine: Machine, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots, starts = _flat(batch.column(1))
        yield pa.record_batch([batch.column(0), pa.array(machine.scores(slots, starts), pa.float64())],
                              names=["doc_id", "score"])


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), terms(text_of("text")).alias("slots"))
    return rows.mapInArrow(lambda it: _score(machine, it), "doc_id bigint, score double")


def held_out_fold(column: str = "doc_id") -> Column:
    return crc_remainder(F.col(column), 5) == 0


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs, train(docs, labels, held_out_fold()))
    return scored.select("doc_id", held_out_fold().alias("held_out"), "score",
                         (F.col("score") >= REJECT_AT).cast("int").alias("predicted"))


def _keep(machine: Machine, columns: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        slots, starts = _flat(batch.column(batch.num_columns - 1))
        kept = batch.filter(pa.array(machine.scores(slots, starts) < REJECT_AT))
        yield kept.select(list(range(len(columns))))


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the machine does not call toxic, with all their columns."""
    machine = train(docs, labels, held_out_fold())
    columns = docs.columns
    # The terms come last and are found by place, so that no column's name can clash.
    rows = docs.select("*", terms(text_of("text")).alias(free_name("slots", columns)))
    return rows.mapInArrow(lambda it: tidied(_keep(machine, columns, it)), docs.schema)
