"""Casts and scalar helpers (E1-E8, T4, T7) plus the output typing rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c: Column | str) -> Column:
    """E6 for text: NULL instead of an error on text that is not an integer (Q13)."""
    return _col(c).try_cast(T.IntegerType())


def yes_no(c: Column | str) -> Column:
    """T4: 'Y' -> true, 'N' -> false, anything else -> NULL."""
    col = _col(c)
    return F.when(col == "Y", F.lit(True)).when(col == "N", F.lit(False))


def zero_if_null(c: Column | str) -> Column:
    """``COALESCE(x, 0)``."""
    return F.coalesce(_col(c), F.lit(0))


def percent(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """``ROUND(100 * n / d, digits)`` as NUMERIC computes it, half away from zero; NULL on d = 0 (Q16).

    The quotient is rounded in whole numbers (counts and decimals of up to six places
    are exact there), so a tie is a tie; the result leaves as DOUBLE.
    """
    whole = lambda c: (c.cast("decimal(28,6)") * 1_000_000).cast("decimal(34,0)")
    n, d = whole(numerator), F.nullif(whole(denominator), F.lit(0).cast("decimal(34,0)"))
    scaled = F.abs(n) * F.lit(200 * 10 ** digits).cast("decimal(8,0)") + F.abs(d)
    rounded = F.call_function("div", scaled.cast("decimal(38,0)"), (F.abs(d) * 2).cast("decimal(38,0)"))
    return F.signum(n.cast("double")) * F.signum(d.cast("double")) * rounded / F.lit(float(10 ** digits))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``n / NULLIF(d, 0)`` in DOUBLE."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def measures_as_double(df: DataFrame) -> DataFrame:
    """Output rule: decimal measures leave a query as DOUBLE; counts stay BIGINT."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
