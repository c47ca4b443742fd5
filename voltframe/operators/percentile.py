"""Exact PERCENTILE_CONT per group, guided by a mergeable quantile summary.

``F.percentile`` merges a value -> count map per group in one task, so a hot
group (one release year holding a third of the rows) lands whole on one
executor.  Here the rows are read twice:

1. a partial aggregation gives each group's count and a quantile summary's
   values a little below and above the wanted rank.  The summary's rank error is
   at most ``1 / accuracy`` of the group whatever its distribution, and the
   bounds are taken ``MARGIN`` times as far out, so the wanted rows lie between;
2. equal values of a group become one row with a count (map-side combine), values
   below the band one count, values above it are dropped.  What is left, the
   band, is ranked with a window: at most ``accuracy`` distinct values of a group,
   or ``2 * (MARGIN + 1) / accuracy`` of its rows, with any distribution.

The two neighbours are interpolated exactly as Spark's ``percentile`` does.  Counts
decide, so a summary that broke its promise would raise, never mislead.  Building
the plan runs no job and keeps nothing, so a view over it answers from the data of
the moment.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The bounds lie this many summary errors away from the wanted rank.
MARGIN = 4


def percentile_band(df: DataFrame, keys: Sequence[str], value: Column | str, p: float,
                    accuracy: int = 10_000) -> DataFrame:
    """Per group: ``_n`` values, and rows of (``_v``, ``_m`` times) in the band; NULL ``_v`` counts what is below.

    A group without values has one row with NULL ``_v`` and ``_m`` 0.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must lie in [0, 1]")
    keys = list(keys)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*keys, v.alias("_v"))
    margin = MARGIN / accuracy
    bounds = F.percentile_approx("_v", [max(0.0, p - margin), min(1.0, p + margin)], accuracy)
    # A group of at most ``accuracy`` values is its own band: bounds by share could miss its few ranks.
    state = rows.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(
        F.count("_v").alias("_n"), F.when(F.count("_v") > accuracy, bounds).alias("_b"))
    values = rows.groupBy(*keys, "_v").agg(F.count("_v").alias("_m"))
    same_group = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys], F.lit(True))
    below = F.col("_b").isNotNull() & (F.col("_v") < F.col("_b")[0])
    above = F.coalesce(F.col("_v") > F.col("_b")[1], F.lit(False))
    return (values.join(state, same_group).where(~above)
            .groupBy(*keys, "_n", F.when(~below, F.col("_v")).alias("_v")).agg(F.sum("_m").alias("_m")))


def exact_percentile(df: DataFrame, keys: Sequence[str], value: Column | str, p: float,
                     name: str, accuracy: int = 10_000) -> DataFrame:
    """``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)`` per ``keys`` as DOUBLE."""
    keys = list(keys)
    band = percentile_band(df, keys, value, p, accuracy)
    position = (F.col("_n") - 1) * F.lit(p)
    end = F.sum("_m").over(Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()))
    ranked = band.withColumns({"_end": end, "_pos": position})

    def at(rank: Column) -> Column:
        held = (F.col("_end") - F.col("_m") <= rank) & (rank < F.col("_end"))
        return F.min(F.when(held, F.col("_v")))

    picked = ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), F.max("_pos").alias("_pos"),
                                       at(F.floor("_pos")).alias("_v0"), at(F.ceil("_pos")).alias("_v1"))
    lower, higher, pos = F.floor("_pos"), F.ceil("_pos"), F.col("_pos")
    between = (higher - pos) * F.col("_v0") + (pos - lower) * F.col("_v1")
    result = (F.when(F.col("_n") == 0, F.lit(None).cast("double"))
              .when(F.col("_v0").isNull() | F.col("_v1").isNull(),
                    F.raise_error(F.lit("the quantile summary missed a wanted rank")).cast("double"))
              .when((lower == higher) | (F.col("_v0") == F.col("_v1")), F.col("_v0"))
              .otherwise(between))
    return picked.select(*keys, result.alias(name))
