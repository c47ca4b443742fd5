"""Standardisation of file, sheet and column names, as one Column expression.

Names in a DataFrame are standardised where they are; the few names that the
driver knows (headers) go through the same expression in one small query.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The name rules of the survey loader, as (pattern, replacement) in order.
# White space and digits are those of Unicode.
BEFORE_LOWER = ((r"(?U)\d+__|Y\d+\.xlsx", ""),   # numbered prefixes, 'Y2023.xlsx' suffix
                (r"(?U)^(\d+_\d+_+|_+)", ""))    # '3_1_' style or bare '_' prefix
AFTER_LOWER = ((r"\p{Punct}", ""),               # ASCII punctuation, underscore included
               (r"(?U)[\s\x1c-\x1f]+", "_"))     # white space runs become one '_'
MAX_IDENTIFIER = 63                              # identifier length kept by the target store


def standardize_name_col(c: Column | str) -> Column:
    """T1: '3_1_Generator_Y2023.xlsx' -> 'generator'; 'Nameplate Capacity (MW)' -> 'nameplate_capacity_mw'."""
    apply = lambda col, rule: F.regexp_replace(col, *rule)
    column = F.col(c) if isinstance(c, str) else c
    return reduce(apply, AFTER_LOWER, F.lower(reduce(apply, BEFORE_LOWER, column)))


def column_name_col(c: Column | str) -> Column:
    """The name a raw header gets in the table."""
    return F.substring(standardize_name_col(c), 1, MAX_IDENTIFIER)


def truncate_name(name: str, limit: int = MAX_IDENTIFIER) -> str:
    return name[:limit]


def column_names(spark: SparkSession, raw_names: Sequence[str]) -> list[str]:
    """The table names of raw headers, in one query over the list (no table is read)."""
    if not raw_names:
        return []
    raw = F.array(*[F.lit(n) for n in raw_names])
    return list(spark.range(1).select(F.transform(raw, column_name_col)).first()[0])


def check_unique_names(spark: SparkSession, raw_names: Sequence[str]) -> list[str]:
    """Q19: two raw headers that standardise to one name are an error, not a merge."""
    names = column_names(spark, raw_names)
    first: dict[str, str] = {}
    for raw, name in zip(raw_names, names):
        if name in first:
            raise ValueError(f"headers {first[name]!r} and {raw!r} both standardise to {name!r}")
        first[name] = raw
    return names
