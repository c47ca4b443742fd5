"""Row predicates used by the views."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a release year written as exactly four digits (\z: no final newline).
FOUR_DIGITS = r"^\d{4}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_list(c: Column | str, codes: Iterable[str]) -> Column:
    """``c IN (codes)``; Catalyst turns long lists into an InSet."""
    return _col(c).isin(list(codes))


def any_of(cols: Iterable[Column | str], codes: Iterable[str]) -> Column:
    """true when any of the columns holds one of the codes.

    Written as an OR of IN tests (not ``exists(array(...))``) so that the
    predicate stays pushable into the Parquet scan.  NULL OR true is true.
    """
    codes = list(codes)
    return reduce(or_, [in_list(c, codes) for c in cols])


def four_digit_year(c: Column | str) -> Column:
    """F8: ``c ~ '^\\d{4}$'`` with PostgreSQL's end anchor semantics."""
    return _col(c).rlike(FOUR_DIGITS)


def within_recent(c: Column | str, max_year: Column, years: int) -> Column:
    """``max_year - years <= c <= max_year``."""
    return _col(c).between(max_year - F.lit(years), max_year)
