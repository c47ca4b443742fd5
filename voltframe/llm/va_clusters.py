"""Centroid clustering over a file of approximations (VA-file).

Every component falls into one of ``CELLS`` cells of its dimension (six bits; with
four, nearly all intervals of the test embeddings overlap), and a vector's cells are
written beside it, a byte each.  Cell bounds are taken from the
exact mean and spread of each dimension, with its smallest and largest value at
the ends, so a cell is a closed range of integers.  For a centroid c and a cell, a
lookup table has the least and the largest c * c - 2 * x * c of the cell's values
x; summed over dimensions they bound the squared distance less the vector's own
squared length, which is the same for all centroids.  A centroid stays a candidate
while its lower bound does not pass the least upper bound.  Only rows with several
candidates have their vector fetched and compared exactly.

Centroid sums are kept from round to round: after the first sum of all vectors, a
round fetches only rows that are not settled by their cells under the old and the
new centroids, or that change over, and moves their vectors between sums.  Parquet
has no access by row, so cells and vector are columns of one written table, and
"fetch" means decoding the row's vector in the task that read its cells: no join.

A task sends a row a centroid at most; the driver holds the centroids, their sums
and the cell bounds, and nothing that grows.

Defined results: only vectors of ``WIDTH`` components without null, NaN or infinite
ones are kept and returned; rows that repeat a vec_id or vector count each; start
centroids go by the hash of vec_id, then vector, null vec_ids last; fewer vectors
than centroids make fewer clusters; empty tables give empty results; scaled
components of 2 ** 27 or more raise ValueError; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.llm.common import slices, staged
from voltframe.llm.vectors import LARGEST, integers, matrix

WIDTH = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
CELLS = 64
#: Where the standard normal distribution leaves equal shares below it.
_CUTS = np.array([NormalDist().inv_cdf(k / CELLS) for k in range(1, CELLS)])
#: Rows whose bounds are summed side by side.
SLICE = 2048


@dataclass
class Grid:
    """By dimension, the first value of every cell but the lowest, and all values' range."""
    starts: np.ndarray  # dimension x (CELLS - 1), ascending
    least: np.ndarray
    most: np.ndarray

    def pack(self, rows: np.ndarray) -> np.ndarray:
        """Each component's cell."""
        cells = [np.searchsorted(s, rows[:, d], side="right") for d, s in enumerate(self.starts)]
        return np.stack(cells, 1).astype(np.uint8)

    def bounds(self, centroids: np.ndarray) -> np.ndarray:
        """dimension x cell x (lower bounds of all centroids, then upper bounds)."""
        low = np.concatenate([self.least[:, None], self.starts], 1)
        high = np.concatenate([self.starts - 1, self.most[:, None]], 1)
        c = centroids.T[:, None, :]
        at_low, at_high = c * c - 2 * low[:, :, None] * c, c * c - 2 * high[:, :, None] * c
        return np.concatenate([np.minimum(at_low, at_high), np.maximum(at_low, at_high)], 2)


def candidates(cells: np.ndarray, table: np.ndarray) -> np.ndarray:
    """row x centroid: whether its distance interval reaches below the least upper bound."""
    total = np.zeros((len(cells), table.shape[2]), np.int64)
    for d in range(cells.shape[1]):
        total += table[d][cells[:, d]]
    k = table.shape[2] // 2
    return total[:, :k] <= total[:, k:].min(1)[:, None]


def closest(rows: np.ndarray, centroids: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest candidate (ties: the smaller number) and the squared distance to it."""
    distance = np.full(may.shape, np.iinfo(np.int64).max)
    for k, c in enumerate(centroids):
        own = np.flatnonzero(may[:, k])
        distance[own, k] = ((rows[own] - c) ** 2).sum(1)
    best = distance.argmin(1)
    return best, distance[np.arange(len(best)), best]


def _cells_of(batch: pa.RecordBatch) -> np.ndarray:
    packed = batch.column("cells").cast(pa.binary())
    return np.frombuffer(b"".join(packed.to_pylist()), np.uint8).reshape(batch.num_rows, -1)


def _fetch(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    return matrix(batch.column("v").take(pa.array(rows)), WIDTH)


def _stat_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = matrix(batch.column("v"), WIDTH)
        if not len(rows):
            continue
        # Sums of squares only place cell bounds, so they need not be exact.
        yield pa.record_batch([pa.array(np.arange(WIDTH), pa.int32()), pa.array(rows.min(0)), pa.array(rows.max(0)),
                               pa.array(rows.sum(0)), pa.array((rows.astype(float) ** 2).sum(0)),
                               pa.array([len(rows)] * WIDTH, pa.int64())],
                              names=["d", "least", "most", "total", "squares", "n"])


def grid_of(kept: DataFrame) -> Grid | None:
    stats = (kept.mapInArrow(_stat_batches, "d int, least bigint, most bigint, total bigint, squares double, n bigint")
             .groupBy("d").agg(F.min("least").alias("least"), F.max("most").alias("most"),
                               F.sum("total").alias("total"), F.sum("squares").alias("squares"),
                               F.sum("n").alias("n")).orderBy("d").toPandas())  # a row a dimension
    if not len(stats):
        return None
    least, most = stats["least"].to_numpy(np.int64), stats["most"].to_numpy(np.int64)
    if max(int(most.max()), -int(least.min())) >= LARGEST:
        raise ValueError(f"a scaled vector component reaches {LARGEST}; distances would not fit 64 bits")
    n = stats["n"].to_numpy(float)
    mean = stats["total"].to_numpy(float) / n
    spread = np.sqrt(np.maximum(stats["squares"].to_numpy(float) / n - mean ** 2, 0))
    starts = np.ceil(mean[:, None] + spread[:, None] * _CUTS).astype(np.int64)
    return Grid(np.clip(starts, least[:, None], most[:, None] + 1), least, most)


def _pack_batches(grid: Grid, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = grid.pack(matrix(batch.column("v"), WIDTH))
        yield pa.record_batch([batch.column("vec_id"), batch.column("v").cast(pa.list_(pa.int32())),
                               pa.array([x.tobytes() for x in packed], pa.binary())], names=["vec_id", "v", "cells"])


def moved(cells: np.ndarray, grid: Grid, old: np.ndarray | None, new: np.ndarray, fetch) -> tuple[np.ndarray, ...]:
    """(count, sum) changes by centroid from ``old`` to ``new``, and how many rows were fetched."""
    n, sums = np.zeros(len(new), np.int64), np.zeros((len(new), WIDTH), np.int64)
    may = candidates(cells, grid.bounds(new))
    if old is None:
        wanted = np.arange(len(cells))
    else:
        before = candidates(cells, grid.bounds(old))
        settled = (may.sum(1) == 1) & (before.sum(1) == 1) & (may.argmax(1) == before.argmax(1))
        wanted = np.flatnonzero(~settled)
    rows = fetch(wanted)
    now, _ = closest(rows, new, may[wanted])
    if old is None:
        np.add.at(n, now, 1)
        np.add.at(sums, now, rows)
    else:
        was, _ = closest(rows, old, before[wanted])
        over = was != now
        for index, sign in ((was[over], -1), (now[over], 1)):
            np.add.at(n, index, sign)
            np.add.at(sums, index, sign * rows[over])
    return n, sums, len(wanted)


def _move_batches(grid: Grid, old: np.ndarray | None, new: np.ndarray,
                  batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums, fetched = np.zeros(len(new), np.int64), np.zeros((len(new), WIDTH), np.int64), 0
    for batch in slices(batches, SLICE):
        dn, ds, df = moved(_cells_of(batch), grid, old, new, lambda rows, b=batch: _fetch(b, rows))
        n, sums, fetched = n + dn, sums + ds, fetched + df
    share = np.zeros(len(new), np.int64)
    share[:1] = fetched
    yield pa.record_batch([pa.array(np.arange(len(new)), pa.int32()), pa.array(n),
                           pa.array(list(sums), pa.list_(pa.int64())), pa.array(share)],
                          names=["cluster", "n", "sums", "fetched"])


def _place_batches(grid: Grid, centroids: np.ndarray, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = grid.bounds(centroids)
    for batch in slices(batches, SLICE):
        may = candidates(_cells_of(batch), table)
        # Every row's distance is asked for, so every vector is read here, for its candidates only.
        best, distance = closest(matrix(batch.column("v"), WIDTH), centroids, may)
        yield pa.record_batch([batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(distance)],
                              names=["vec_id", "cluster", "distance"])


@dataclass
class Clustering:
    file: DataFrame          # vec_id, v, cells: the written table
    grid: Grid | None
    centroids: np.ndarray
    fetched: list[int]       # vectors fetched in each round


def fit(embeddings: DataFrame, column: str = "embedding") -> Clustering:
    """Cells of all kept vectors and the centroids after ``ROUNDS`` rounds."""
    kept = integers(embeddings.withColumn("vec_id", F.col("vec_id").cast("bigint")).where(F.size(column) == WIDTH),
                    SCALE, "vec_id", column=column)
    by_hash = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256).asc_nulls_last()
    start = kept.orderBy(by_hash, "v").limit(CENTROIDS).select("v").collect()  # CENTROIDS rows at most
    new = np.array([r["v"] for r in start], np.int64).reshape(-1, WIDTH)
    grid = grid_of(kept)
    if grid is None:
        return Clustering(kept.withColumn("cells", F.lit(b"")), None, new, [])
    file = staged(kept.mapInArrow(lambda it: _pack_batches(grid, it), "vec_id bigint, v array<int>, cells binary"),
                  "va-file")
    old, n, sums, fetched = None, [0] * len(new), [[0] * WIDTH for _ in new], []
    for _ in range(ROUNDS):
        changes = (file.mapInArrow(lambda it, a=old, b=new: _move_batches(grid, a, b, it),
                                   "cluster int, n bigint, sums array<bigint>, fetched bigint")
                   .groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("fetched").alias("fetched"),
                                           *[F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(WIDTH)]))
        fetched.append(0)
        old, new = new, new.copy()
        for r in changes.collect():  # a row a centroid
            k = r["cluster"]
            fetched[-1] += r["fetched"]
            n[k] += r["n"]
            sums[k] = [s + r[f"s{d}"] for d, s in enumerate(sums[k])]
            if n[k]:
                new[k] = [s // n[k] for s in sums[k]]
    return Clustering(file, grid, new, fetched)


def cluster(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    spark, found = embeddings.sparkSession, fit(embeddings, column)
    schema = "vec_id bigint, cluster int, distance bigint"
    if found.grid is None:
        placed = found.file.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    else:
        grid, centroids = found.grid, found.centroids
        placed = staged(found.file.mapInArrow(lambda it: _place_batches(grid, centroids, it), schema), "va-placed")
    sums = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    facts = [(k, d, sum(sums.values()), hashlib.sha256(",".join(map(str, found.centroids[k].tolist())).encode()).hexdigest())
             for k, d in sums.items()]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # A row a centroid at most.
    return placed.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
