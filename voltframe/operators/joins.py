"""Join shapes of the views."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_chain(base: DataFrame, others: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``base LEFT JOIN o1 USING keys LEFT JOIN o2 ...``.

    Every side is pre-aggregated on ``keys``, so all of them are already hash
    partitioned on the join keys and the chain adds no exchange.  Plain
    equality: NULL keys never match (Q15).
    """
    cond_cols = list(keys)

    def step(acc: DataFrame, other: DataFrame) -> DataFrame:
        cond = reduce(lambda a, b: a & b, [acc[k] == other[k] for k in cond_cols])
        kept = [c for c in other.columns if c not in cond_cols]
        return acc.join(other, cond, "left").select(*[acc[c] for c in acc.columns],
                                                     *[other[c] for c in kept])

    return reduce(step, others, base)


def full_outer_coalesced(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``f1 FULL JOIN f2 ON keys FULL JOIN f3 ON COALESCE(f1.k, f2.k) = f3.k ...``.

    Every frame is unique on its keys (an aggregate on them), so the joins are one
    aggregation over the tagged union of the frames: a key's group has at most a row
    of each frame.  One exchange for any number of frames, where the chain of joins
    moves everything again for each coalesced key.  A NULL in a key matches nothing:
    such rows stay apart by frame and row.
    """
    values = [c for df in frames for c in df.columns if c not in keys]
    if len(set(values)) < len(values):
        raise ValueError("frames must not share names of value columns")
    types = {f.name: f.dataType for df in frames for f in df.schema.fields}
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    tagged = [df.select(*keys, F.when(any_null, F.struct(F.lit(i).alias("frame"), F.monotonically_increasing_id()
                                                         .alias("row"))).alias("_apart"),
                        *[(F.col(c) if c in df.columns else F.lit(None).cast(types[c])).alias(c) for c in values])
              for i, df in enumerate(frames)]
    merged = reduce(DataFrame.unionByName, tagged).groupBy(*keys, "_apart").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values])
    return merged.drop("_apart")


def with_scalar(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Attach a one-column aggregate (``SELECT max(...)``) as a scalar subquery.

    The aggregate has no grouping keys, so it is exactly one row: the size bound
    holds at any scale.  As a scalar subquery it can also prune partitions when
    compared with the partition column.
    """
    return df.withColumn(name, one_row.scalar())


def scalar(one_row: DataFrame) -> Column:
    """The single value of a global aggregate, usable in any expression."""
    return one_row.scalar()
