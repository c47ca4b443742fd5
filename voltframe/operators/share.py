"""A value as a percentage of its group total."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.casting import percent


def share_of_group(df: DataFrame, value: str, group: Sequence[str], name: str,
                   digits: int = 2) -> DataFrame:
    """``ROUND(100 * value / SUM(value) OVER (PARTITION BY group), digits)``.

    Meant for aggregated input (one row per group member).  A zero group total
    yields NULL instead of a division error (Q16).
    """
    total = F.sum(value).over(Window.partitionBy(*group))
    return df.withColumn(name, percent(F.col(value), total, digits))


def share_of_large_group(df: DataFrame, value: str, group: Sequence[str], name: str,
                         digits: int = 2) -> DataFrame:
    """The same for groups of any size: totals by partial aggregation, joined back.

    A group is summed on the map side and never gathered; the join sends the totals
    to the rows (broadcast by measured size), or splits a hot group's partition (AQE
    skew join).  NULL group keys are a group, as in a window.
    """
    totals = df.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group]).agg(F.sum(value).alias("_total"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group])
    return df.join(totals, same).select(*df.columns, percent(F.col(value), F.col("_total"), digits).alias(name))
