"""Keep the newest row per entity.

``row_number() OVER (PARTITION BY keys ORDER BY order) = 1``.  Spark plans this
as a partial WindowGroupLimit before the shuffle and a final one after it, so
each map task forwards at most one row per key: a hot key (a third of all rows,
or the NULL key) shrinks to one row per map partition before the exchange.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Last sort keys of every "latest" (those that a table has): identity, place, kind, size.
TIEBREAK = ("utility_id", "utility_name", "plant_code", "generator_id", "state", "county", "technology",
            *(f"energy_source_{k}" for k in range(1, 7)), "nameplate_capacity_mw")


def newest_first() -> tuple[Column, Column]:
    """Default order: newest release first, then newest file (both NOT NULL)."""
    return (F.col("file_year").desc(), F.col("file_date").desc())


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
           tiebreak: Sequence[Column] = (), where: Column | None = None) -> DataFrame:
    """Newest row per ``keys``.

    ``where`` filters *before* ranking (view b); filter the result instead to
    rank first (view a) - the two orders answer different questions (Q1).
    ``tiebreak`` completes the order where keys tie (Q3).  Rows that still tie, such as
    a unit listed twice in one file or units without keys, are ordered by
    :data:`TIEBREAK`, the columns that the views read, so equal input gives equal
    answers whatever the partitioning; wider rows would undo column pruning.
    """
    if where is not None:
        df = df.where(where)
    order = newest_first() if order is None else order
    rest = [F.col(c).asc_nulls_last() for c in TIEBREAK if c in df.columns and c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *tiebreak, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
