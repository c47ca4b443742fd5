"""Turn one extracted sheet of one release into rows of a raw table.

All steps are one projection over the scan: rename (T1/T2/T8), lineage
columns (T3), Y/N booleans (T4), typed NULLs for missing columns (T5), target
column order with extras dropped (T6) and declared-type coercion (T7).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe import registry
from voltframe.functions.casting import yes_no
from voltframe.functions.names import check_unique_names


def rename_columns(df: DataFrame) -> DataFrame:
    """Standardised, 63-character names in one projection (Q19 checked)."""
    return df.toDF(*check_unique_names(df.sparkSession, df.columns))


def add_lineage(df: DataFrame, file_year: int | Column | None = None,
                file_date: Column | None = None, upload: Column | None = None) -> DataFrame:
    """``file_year`` (int), ``file_date`` (file time), ``upload_timestamp`` (now).

    Defaults: the year already in the frame, the file's modification time from
    the scan metadata, and the session's current timestamp.
    """
    year = F.col("file_year") if file_year is None else (
        file_year if isinstance(file_year, Column) else F.lit(file_year))
    fdate = file_date if file_date is not None else F.col("_metadata.file_modification_time")
    up = upload if upload is not None else F.current_timestamp()
    return df.withColumns({
        "file_year": year.cast(T.IntegerType()),
        "file_date": fdate.cast(T.TimestampNTZType()),
        "upload_timestamp": up.cast(T.TimestampNTZType()),
    })


def coerce(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """T4 + T7 for one column.

    Declared BOOLEAN fed by text: Y/N mapping.  Any other mismatch: ``try_cast``
    (text that does not parse becomes NULL rather than failing the load).
    """
    if source == target:
        return c
    if isinstance(target, T.BooleanType) and isinstance(source, T.StringType):
        return yes_no(c)
    return c.try_cast(target)


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def coerce_sql(name: str, source: T.DataType, target: T.DataType) -> str:
    """SQL text of :func:`coerce` (used to build a whole projection in one call)."""
    q = _quote(name)
    if source == target:
        return q
    if isinstance(target, T.BooleanType) and isinstance(source, T.StringType):
        return f"CASE WHEN {q} = 'Y' THEN true WHEN {q} = 'N' THEN false END"
    return f"try_cast({q} AS {target.simpleString()})"


def conform(df: DataFrame, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Project ``df`` onto the declared schema of ``table``.

    Missing columns become typed NULLs, unknown ones are dropped, the result has
    exactly the registry's column order and types.  Built as one ``selectExpr``
    so a 76-column table costs one call, not one per column.
    """
    target = schema or registry.schema(table)
    present = {f.name: f.dataType for f in df.schema.fields}
    exprs = []
    for f in target.fields:
        if f.name in present:
            exprs.append(f"{coerce_sql(f.name, present[f.name], f.dataType)} AS {_quote(f.name)}")
        else:
            exprs.append(f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quote(f.name)}")
    return df.selectExpr(*exprs)


def lost_casts(df: DataFrame, schema: T.StructType) -> str:
    """SQL text of an array with the names of the columns whose non-NULL text fails its declared cast."""
    present = {f.name: f.dataType for f in df.schema.fields}
    names = []
    for f in schema.fields:
        if f.name in present and present[f.name] != f.dataType:
            cast = coerce_sql(f.name, present[f.name], f.dataType)
            label = f.name.replace("'", "\\'")
            names.append(f"CASE WHEN {_quote(f.name)} IS NOT NULL AND {cast} IS NULL THEN '{label}' END")
    return f"array_compact(array({', '.join(names)}))" if names else "CAST(array() AS array<string>)"


def reject_counts(df: DataFrame, table: str, schema: T.StructType | None = None,
                  by_year: bool = False) -> DataFrame:
    """T7 report: per declared column (and ``file_year``), how many non-NULL raw values failed coercion."""
    keys = ["file_year"] if by_year else []
    target = schema or registry.schema(table)
    present = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for f in target.fields:
        if f.name in present and f.name not in keys and present[f.name] != f.dataType:
            raw = F.col(f.name)
            lost = raw.isNotNull() & coerce(raw, present[f.name], f.dataType).isNull()
            aggs.append(F.count_if(lost).alias(f.name))
    if not aggs:
        years = "file_year int, " if by_year else ""
        return df.sparkSession.createDataFrame([], f"{years}column string, rejected bigint")
    wide = df.groupBy(*keys).agg(*aggs)
    return wide.unpivot(keys, [c for c in wide.columns if c not in keys], "column", "rejected")
