"""Difference to the previous row of the same key (LAG)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.operators.ordering import lagged


def change_from_previous(df: DataFrame, value: str, keys: Sequence[str],
                         order: Sequence[Column], name: str) -> DataFrame:
    """``value - LAG(value) OVER (PARTITION BY keys ORDER BY order)``.

    Previous *row*, not previous year: a gap year compares to the last
    present one (Q6).  Run it after aggregation so each window partition holds
    one row per year, never raw rows.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.col(value) - F.lag(value).over(w))


def change_along_order(df: DataFrame, value: str, keys: Sequence[str], *spec: str, name: str) -> DataFrame:
    """The same over raw rows, for keys of any size: lag inside sorted ranges with boundary carry.

    ``spec`` names the order as in ``pg_order`` and must leave no ties within a key.
    Runs the sort when called, as its ranges are written (see ``ordering``).
    """
    rows = lagged(df, value, keys, *spec, name="_previous")
    return rows.withColumn(name, F.col(value) - F.col("_previous")).drop("_previous")
