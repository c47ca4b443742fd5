"""UNION ALL variants."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name (each branch already column-pruned)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def zero_padded_union(branches: Sequence[tuple[DataFrame, Mapping[str, str]]],
                      keys: Sequence[str], measures: Sequence[str],
                      dtype: T.DataType = T.DecimalType(38, 6)) -> DataFrame:
    """Each branch fills its own measures, the others are a typed zero.

    ``branches`` is a list of ``(df, {measure: source column})``.  The result
    is the wide layout of the reference's four-branch union; summing it per key
    afterwards is the pivot of a long union.
    """
    padded = []
    for df, filled in branches:
        cols = [F.col(k) for k in keys]
        for m in measures:
            src = F.col(filled[m]) if m in filled else F.lit(0)
            cols.append(src.cast(dtype).alias(m))
        padded.append(df.select(*cols))
    return union_all(*padded)
