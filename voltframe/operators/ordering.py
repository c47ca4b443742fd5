"""O1: ORDER BY with PostgreSQL's NULL placement, and positions and lags along it.

PostgreSQL treats NULL as larger than every value: ASC puts NULLs last and
DESC puts them first; Spark's defaults are the opposite (Q12).

A window per group would sort a whole group in one task.  :func:`numbered` sorts
globally instead (ranges of the full order, so a large group spans many tasks),
writes the rows once with the number they have in their range, and leaves a table
of (group, range) totals that is as small as ranges plus groups.  Positions and
lags are the numbers inside a range plus what the ranges before carry over.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.session import written


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def pg_order(df: DataFrame, *spec: str) -> DataFrame:
    """``pg_order(df, 'state', '-capacity_mw')``: '-' marks a descending key."""
    cols = [desc(s[1:]) if s.startswith("-") else asc(s) for s in spec]
    return df.orderBy(*cols)


#: Number of a row in the global order: its range and its place in it.
AT = "_at"


def _range() -> Column:
    return F.shiftright(F.col(AT), 33)


def numbered(df: DataFrame, group: Sequence[str], *spec: str) -> DataFrame:
    """``df`` in the order of ``group``, then ``spec``, written with a growing number ``AT`` (range in the high bits)."""
    return written(pg_order(df, *group, *spec).withColumn(AT, F.monotonically_increasing_id()), "numbered")


def _per_range(rows: DataFrame, group: Sequence[str], *aggregates: Column) -> DataFrame:
    """A row for each group in each range: its first number and ``aggregates``."""
    return rows.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group], _range().alias("_r")).agg(
        F.min(AT).alias("_first"), *aggregates)


def _back(rows: DataFrame, group: Sequence[str], carried: DataFrame) -> DataFrame:
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
    return rows.join(carried, reduce(lambda a, b: a & b, same, _range() == F.col("_r")))


def _ranges_of(group: Sequence[str]) -> Window:
    """A group's ranges in order: at most as many rows as the sort has partitions."""
    return Window.partitionBy(*[f"_g_{g}" for g in group]).orderBy("_r")


def positions(df: DataFrame, group: Sequence[str], *spec: str, name: str = "position") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group ORDER BY spec)`` in PostgreSQL's order, no group in one task.

    Ties of ``spec`` are numbered in any order; NULL group keys are groups of their own.
    """
    rows = numbered(df, group, *spec)
    counted = _per_range(rows, group, F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(_ranges_of(group)) - F.col("_rows")
    carried = counted.withColumn("_before", before)
    return _back(rows, group, carried).select(
        *df.columns, (F.col(AT) - F.col("_first") + F.col("_before") + 1).alias(name))


def lagged(df: DataFrame, value: str, group: Sequence[str], *spec: str, name: str) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY group ORDER BY spec)`` in PostgreSQL's order, no group in one task.

    Inside a range a window looks one row back; a range's first row of a group gets
    the last value of the nearest range before that has the group.
    """
    rows = numbered(df, group, *spec)
    ends = _per_range(rows, group, F.max_by(F.struct(F.col(value).alias("v")), AT).alias("_last"))
    carried = ends.withColumn("_carried", F.lag("_last").over(_ranges_of(group))["v"])
    inside = F.lag(value).over(Window.partitionBy(*group, "_in").orderBy(AT))
    with_lag = rows.withColumn("_in", _range()).withColumn("_inside", inside)
    previous = F.when(F.col(AT) == F.col("_first"), F.col("_carried")).otherwise(F.col("_inside"))
    return _back(with_lag, group, carried).select(*df.columns, previous.alias(name))
