"""Vector codes: four codebooks, parts assigned along a trie of the distinct parts.

Vectors become integers and are cut into ``PARTS`` equal parts.  The distinct parts
with their counts are written once, sorted; rounds and the last assignment visit
them as a trie, a level a dimension.  A node holds the squared distances so far of
its prefix to every codebook entry, which all parts with that prefix share; a node
adds one dimension to its parent's vector.  The walk is depth first, so that only
one path of distance vectors is kept; subtrees of at most ``BLOCK`` parts are
unrolled level by level.  Leaves take the argmin, and their part times its count
goes to the entry's sum.

A task sends at most a row a part position and entry; the driver holds the
codebooks (``PARTS`` x ``ENTRIES`` x width integers) and nothing that grows.

Defined results: rows with a null vector or null, NaN or infinite components are
left out; rows that repeat a vec_id or a vector count and are returned each, and
start entries go by vec_id, then vector, null vec_ids last; fewer rows than entries
make a smaller codebook; vectors whose length is not the most frequent one (of
equals the longest), or not divisible by the parts, come back with null code and
error; null labels are one group; empty tables give empty results; scaled
components of 2 ** 27 or more raise ValueError, as errors would not fit a long;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import broadcast_if_small, staged
from voltframe.llm.vectors import checked, integers, matrix

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Subtrees of at most so many distinct parts are unrolled level by level.
BLOCK = 512


def nearest(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry (ties: the lower index) of sorted rows."""
    n, width = parts.shape
    index, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n:
        return index, distance
    # Integers of half the size are exact too where no distance can reach 2 ** 31.
    reach = int(np.abs(parts).max(initial=0)) + int(np.abs(codebook).max(initial=0))
    if width * reach * reach < 1 << 31:
        parts, codebook = parts.astype(np.int32), codebook.astype(np.int32)
    differs = parts[1:] != parts[:-1]
    # Length of the prefix that a row shares with the row before it; equal rows share all.
    shared = np.append(-1, np.where(differs.any(1), differs.argmax(1) if width else 0, width))
    # Rows from, to, prefix length, and the distances of the prefix without its last dimension.
    stack = [(0, n, 0, np.zeros(len(codebook), codebook.dtype))]
    while stack:
        low, high, depth, so_far = stack.pop()
        if depth:
            so_far = so_far + (parts[low, depth - 1] - codebook[:, depth - 1]) ** 2
        if high - low > BLOCK and depth < width:
            starts = low + np.flatnonzero(np.append(True, shared[low + 1:high] <= depth))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), high]):
                stack.append((a, b, depth + 1, so_far))
            continue
        at, sums = np.zeros(1, np.int64), so_far[None]
        for d in range(depth, width):
            starts = np.flatnonzero(np.append(True, shared[low + 1:high] <= d))
            step = parts[low + starts, d][:, None] - codebook[:, d]
            step *= step
            # Where no prefix splits any more, the vectors are carried on in place.
            step += sums if len(starts) == len(at) else sums[np.searchsorted(at, starts, side="right") - 1]
            at, sums = starts, step
        best = sums.argmin(1)
        times = np.diff(np.append(at, high - low))
        index[low:high] = np.repeat(best, times)
        distance[low:high] = np.repeat(sums[np.arange(len(best)), best], times)
    return index, distance


def _sum_batches(codebooks: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, entries, width = codebooks.shape
    n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
    for batch in batches:
        part, count = batch.column("part").to_numpy(), batch.column("n").to_numpy()
        rows = matrix(batch.column("v"), width)
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            index, _ = nearest(rows[own], codebooks[p])
            np.add.at(n[p], index, count[own])
            np.add.at(sums[p], index, rows[own] * count[own][:, None])
    p, e = np.nonzero(n)
    yield pa.record_batch([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]),
                           pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])


def _code_batches(codebooks: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, _, width = codebooks.shape
    for batch in batches:
        fits = np.asarray(pc.equal(pc.list_value_length(batch.column("v")), parts * width).to_numpy(False), bool)
        rows = checked(matrix(batch.column("v").filter(pa.array(fits)), parts * width))
        index, error = np.zeros((len(rows), parts), np.int64), np.zeros(len(rows), np.int64)
        for p in range(parts):
            own = rows[:, p * width:(p + 1) * width]
            order = np.lexsort(own.T[::-1]) if width else np.arange(len(own))
            index[order, p], distance = nearest(own[order], codebooks[p])
            error[order] += distance
        codes, errors = np.full(len(fits), None, object), np.full(len(fits), None, object)
        codes[fits] = ["".join(f"{k:02x}" for k in row) for row in index.tolist()]
        errors[fits] = error.tolist()
        yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                               pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])


def usual_length(kept: DataFrame) -> int | None:
    """The most frequent length of vectors, of equals the longest; None without rows."""
    rows = (kept.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), F.desc("n")).limit(1).collect())
    return rows[0]["n"] if rows else None


def fit(kept: DataFrame, length: int) -> np.ndarray:
    """Codebooks (part x entry x component) of integer vectors of ``length`` components, a multiple of the parts."""
    width = length // PARTS
    kept = kept.where(F.size("v") == length)
    start = (kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES)
             .select("v").collect())  # ENTRIES rows at most
    codebooks = checked(np.array([r["v"] for r in start], np.int64).reshape(len(start), PARTS, width))
    codebooks = codebooks.transpose(1, 0, 2).copy()
    cut = F.array(*[F.slice("v", p * width + 1, width) for p in range(PARTS)])
    distinct = staged(kept.select(F.posexplode(cut).alias("part", "v"))
                      .groupBy("part", "v").agg(F.count(F.lit(1)).alias("n"))
                      .sortWithinPartitions("part", "v"), "vector-parts")
    for _ in range(ROUNDS):
        sent = codebooks.copy()
        sums = (distinct.mapInArrow(lambda it, sent=sent: _sum_batches(sent, it),
                                    "part int, entry int, n bigint, sums array<bigint>")
                .groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(
                    *[F.sum(F.col("sums")[k]) for k in range(width)]).alias("sums")))
        for r in sums.collect():  # PARTS x ENTRIES rows at most
            codebooks[r["part"], r["entry"]] = [s // r["n"] for s in r["sums"]]
    return codebooks


_CODED = "vec_id bigint, label {label}, code string, error bigint"


def encode(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that is kept."""
    kept = integers(embeddings.withColumn("vec_id", F.col("vec_id").cast("bigint")), SCALE, "vec_id", "label",
                    column=column)
    length = usual_length(kept)
    schema = _CODED.format(label=kept.schema["label"].dataType.simpleString())
    usable = length is not None and length % PARTS == 0
    if usable:
        codebooks = fit(kept, length)
        coded = kept.mapInArrow(lambda it: _code_batches(codebooks, it), schema)
        numbers = ",".join(map(str, codebooks.ravel().tolist()))
    else:
        coded, numbers = kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                                     F.lit(None).cast("bigint").alias("error")), ""
    coded = staged(coded, "vector-codes")
    # A row a label, broadcast when the counted labels are few.
    totals = broadcast_if_small(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    digest = hashlib.sha256(numbers.encode()).hexdigest()
    rows = coded.alias("c").join(totals.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label")))
    return rows.select("c.vec_id", "c.code", "c.error", "t.label_error", F.lit(digest).alias("codebooks_sha256"))
