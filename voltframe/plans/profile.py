"""Profile every column of every release and derive one schema per table.

Input is the *long* form of the raw extracts: one row per cell (file_year,
column id, position, value as text), built by :func:`long_cells` from each
scan group (files that share a header).  A column that a release does not
have simply has no cells for that year.

The whole profile is two aggregations: (year, column, value) with partial
aggregation (a hot value collapses map-side), then (year, column).  Values
are only grouping keys; no per-column distinct aggregate is expanded N times.
"""

from __future__ import annotations

from typing import Iterable, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.sources.delimited import union_balanced

# Reader types and their SQL rendering.
SQL_TYPES = {"Int64": "BIGINT", "String": "VARCHAR", "Float64": "NUMERIC(18, 6)",
             "Boolean": "BOOLEAN"}
LINEAGE_DDL = ("file_year INT NOT NULL", "file_date TIMESTAMP NOT NULL",
               "upload_timestamp TIMESTAMP DEFAULT CURRENT_TIMESTAMP NOT NULL")
# Texts that are numbers; a cast alone also takes '1D', '2F' and 'NaN', which are identifiers or words here.
INTEGER = r"^\s*[+-]?[0-9]+\s*\z"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
PROFILE_KEYS = ("table_name", "file_year", "column_name")


class LongCells(NamedTuple):
    """Long form of raw extracts.

    ``cells``   (file_year, cid, value): one row per non-NULL cell, plus one
                marker cell per source row (cid < 0, one id per scan group)
    ``layout``  (marker, cid, position): which columns each scan group has
    ``columns`` (cid, table_name, column_name): one row per (table, column)
    Both small frames are schema metadata, built on the driver.
    """

    cells: DataFrame
    layout: DataFrame
    columns: DataFrame


def long_cells(groups: Iterable[tuple[str, DataFrame]]) -> LongCells:
    """Scan groups ``(table, DataFrame of file_year + text columns)`` -> long cells.

    Each (table, column) gets one integer id across all groups, so the shuffle
    keys are (year, id, value) instead of two repeated strings per cell; names
    come back through a broadcast join with the column list.  NULL cells are
    not emitted (survey sheets are mostly empty columns); the row marker gives
    the rows per group and year, and NULLs are rows minus non-NULL values, so
    every extract is scanned once.
    """
    groups = list(groups)
    ids: dict[tuple[str, str], int] = {}
    layout: list[tuple[int, int, int]] = []
    parts = []
    for g, (table, df) in enumerate(groups):
        cols = [c for c in df.columns if c != "file_year"]
        marker = -(g + 1)
        cid = {c: ids.setdefault((table, c), len(ids)) for c in cols}
        layout += [(marker, cid[c], pos) for pos, c in enumerate(cols)]
        # Built as SQL text: one call per projection, however wide the sheet.
        cells = ", ".join([f"named_struct('cid', {marker}, 'value', '')"]
                          + [f"named_struct('cid', {cid[c]}, 'value', CAST({_q(c)} AS STRING))"
                             for c in cols])
        # Plain inline + a codegen'd filter right after it (NULL cells never reach
        # the aggregation); cheaper than filtering inside the array.
        parts.append(df.selectExpr("CAST(file_year AS INT) AS file_year", f"inline(array({cells}))")
                     .where("value IS NOT NULL"))
    spark = groups[0][1].sparkSession
    columns = spark.createDataFrame([(i, t, c) for (t, c), i in ids.items()],
                                    "cid int, table_name string, column_name string")
    layout_df = spark.createDataFrame(layout, "marker int, cid int, position int")
    return LongCells(union_long(parts), layout_df, columns)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def union_long(parts: Iterable[DataFrame]) -> DataFrame:
    parts = list(parts)
    return union_balanced(parts)


def profile_table(long: LongCells, strict_yn: bool = False) -> DataFrame:
    """P9 (with P1-P4): one row per (table, year, column).

    distinct_count counts NULL as a value (P1); max_len is the longest text of a
    String column, NULL otherwise (P2); is_unique = distinct_count = rows (P3,
    the intended rule); col_type is Boolean for exactly two distinct values,
    else Int64 / Float64 when every non-NULL value is such a number, else String
    (P4), and NULL for a year without any value.
    ``strict_yn`` (Q8) only calls a column Boolean when its values are Y, N or NULL,
    so a ``{NULL, 'text'}`` column is not turned into an all-NULL boolean.
    """
    per_value = long.cells.groupBy("file_year", "cid", "value").agg(F.count(F.lit(1)).alias("n"))
    v = F.col("value")
    values = per_value.where(F.col("cid") >= 0).groupBy("file_year", "cid").agg(
        F.sum("n").alias("non_null"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.max(F.length(v)).alias("text_len"),
        F.count_if(~v.rlike(INTEGER) | v.try_cast("bigint").isNull()).alias("not_int"),
        F.count_if(~v.rlike(NUMBER)).alias("not_num"),
        F.count_if(~v.isin("Y", "N")).alias("not_yn"))
    group_rows = (per_value.where(F.col("cid") < 0)
                  .select("file_year", F.col("cid").alias("marker"), F.col("n").alias("rows")))
    # layout / columns: one row per extract column (schema metadata, bounded).
    totals = (group_rows.join(F.broadcast(long.layout), "marker")
              .groupBy("file_year", "cid").agg(F.min("position").alias("position"),
                                               F.sum("rows").alias("n_rows")))
    stats = (totals.join(values, ["file_year", "cid"], "left")
             .join(F.broadcast(long.columns), "cid")
             .withColumn("n_null", F.col("n_rows") - F.coalesce(F.col("non_null"), F.lit(0))))
    distinct = (F.coalesce(F.col("distinct_values"), F.lit(0))
                + F.when(F.col("n_null") > 0, 1).otherwise(0)).cast("bigint")
    not_int = F.coalesce(F.col("not_int"), F.lit(0))
    not_num = F.coalesce(F.col("not_num"), F.lit(0))
    two_values = distinct == 2
    if strict_yn:
        two_values = two_values & (F.coalesce(F.col("not_yn"), F.lit(0)) == 0)
    # A year without any value says nothing about the type.
    col_type = (F.when(F.coalesce(F.col("non_null"), F.lit(0)) == 0, F.lit(None).cast("string"))
                .when(two_values, F.lit("Boolean"))
                .when(not_int == 0, F.lit("Int64"))
                .when(not_num == 0, F.lit("Float64"))
                .otherwise(F.lit("String")))
    reader_string = (not_int > 0) & (not_num > 0)
    return stats.select(
        *PROFILE_KEYS, "position", F.col("n_rows").cast("bigint").alias("n_rows"),
        distinct.alias("distinct_count"),
        (distinct == F.col("n_rows")).alias("is_unique"),
        F.when(reader_string, F.col("text_len")).cast("bigint").alias("max_len"),
        col_type.alias("col_type"))


def profile_distinct(long: DataFrame) -> DataFrame:
    """P1."""
    return profile_table(long).select(*PROFILE_KEYS, "distinct_count")


def profile_max_len(long: DataFrame) -> DataFrame:
    """P2."""
    return profile_table(long).select(*PROFILE_KEYS, "max_len")


def profile_unique(long: DataFrame) -> DataFrame:
    """P3."""
    return profile_table(long).select(*PROFILE_KEYS, "n_rows", "is_unique")


def classify_type(long: DataFrame) -> DataFrame:
    """P4."""
    return profile_table(long).select(*PROFILE_KEYS, "distinct_count", "col_type")


def consolidate_types(profile: DataFrame, widen_numeric: bool = False) -> DataFrame:
    """P5: one type per (table, column) over all years.

    One type in every year that has values -> that type; otherwise, and without
    any value, String (Int64 + Float64 too, Q17) unless ``widen_numeric`` makes that pair Float64.  Also keeps the
    first-seen order (earliest year, then position) for rendering.
    """
    types = F.array_sort(F.collect_set("col_type"))
    merged = profile.groupBy("table_name", "column_name").agg(
        types.alias("types"),
        F.min(F.struct("file_year", "position")).alias("first_seen"),
        F.bool_and("is_unique").alias("is_unique"))
    final = F.when(F.size("types") == 1, F.col("types")[0])
    if widen_numeric:
        final = final.when(F.array_join("types", ",") == "Float64,Int64", F.lit("Float64"))
    final = final.otherwise(F.lit("String"))
    return merged.select(
        "table_name", "column_name", final.alias("col_type"),
        F.col("first_seen.file_year").alias("first_year"),
        F.col("first_seen.position").alias("first_position"), "is_unique")


def years_present(profile: DataFrame) -> DataFrame:
    """Sorted release years per table (from the profile: a table-year is
    present exactly when some column of it has cells)."""
    return (profile.select("table_name", "file_year").distinct()
            .groupBy("table_name").agg(F.array_sort(F.collect_set("file_year")).alias("years")))


def years_of(listing: DataFrame) -> DataFrame:
    """P6 from the file listing: a table has a release where it has a file, even one without rows."""
    return listing.groupBy("table_name").agg(F.array_sort(F.collect_set("file_year")).alias("years"))


def with_empty_columns(consolidated: DataFrame, long: LongCells) -> DataFrame:
    """Adds the columns that only extracts without rows have: VARCHAR, after all others."""
    places = long.layout.groupBy("cid").agg(F.min("position").alias("first_position"))
    known = consolidated.select("table_name", "column_name")
    empty = (long.columns.join(known, ["table_name", "column_name"], "left_anti").join(places, "cid")
             .select("table_name", "column_name", F.lit("String").alias("col_type"),
                     F.lit(9999).alias("first_year"), "first_position", F.lit(False).alias("is_unique")))
    return consolidated.unionByName(empty)


def missing_years(present: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Requested years a table has no release for (tables with none missing are left out)."""
    wanted = F.sequence(F.lit(start_year), F.lit(end_year))
    gaps = F.array_except(wanted, F.col("years"))
    return (present.select("table_name", gaps.alias("missing_years"))
            .where(F.size("missing_years") > 0))


def render_schema(consolidated: DataFrame) -> DataFrame:
    """``CREATE TABLE`` text per table, columns in first-seen order, lineage last.

    The first Int64 column that is unique in every year is the PRIMARY KEY (Q9); a
    table can have only one.
    """
    sql_type = F.element_at(F.create_map(*[F.lit(x) for kv in SQL_TYPES.items() for x in kv]),
                            F.col("col_type"))
    col_ddl = F.concat_ws(" ", F.col("column_name"), sql_type)
    per_table = consolidated.groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.struct(
            "first_year", "first_position", col_ddl.alias("ddl"),
            (F.col("is_unique") & (F.col("col_type") == "Int64")).alias("is_key")))).alias("cols"))
    key = F.array_position(F.transform("cols", lambda c: c["is_key"]), F.lit(True)) - 1
    per_table = per_table.withColumn("key", key)
    body = F.concat(F.transform("cols", lambda c, i: F.when(
                        i == F.col("key"), F.concat(c["ddl"], F.lit(" PRIMARY KEY"))).otherwise(c["ddl"])),
                    F.array(*[F.lit(x) for x in LINEAGE_DDL]))
    ddl = F.concat(F.lit("CREATE TABLE "), F.col("table_name"), F.lit("(\n\t"),
                   F.array_join(body, ",\n\t"), F.lit("\n);"))
    return per_table.select("table_name", F.size("cols").alias("n_columns"), ddl.alias("ddl"))


def declared_schema(consolidated: DataFrame) -> DataFrame:
    """Final schema rows (table, column, SQL type) - the artefact the loader reads."""
    sql_type = F.element_at(F.create_map(*[F.lit(x) for kv in SQL_TYPES.items() for x in kv]),
                            F.col("col_type"))
    return consolidated.select("table_name", "column_name", sql_type.alias("sql_type"),
                               "first_year", "first_position")



def ddl_script(rendered: DataFrame) -> DataFrame:
    """P8 text artefact: sorted ``CREATE SCHEMA`` statements, then the tables.

    One row per statement, ordered by ``ordinal`` (schemas first, then tables
    by name); the row count is the number of tables, not data.
    """
    schemas = (rendered.select(F.split("table_name", r"\.")[0].alias("name")).distinct()
               .select(F.lit(0).alias("kind"), "name",
                       F.concat(F.lit("CREATE SCHEMA "), F.col("name"), F.lit(";")).alias("statement")))
    tables = rendered.select(F.lit(1).alias("kind"), F.col("table_name").alias("name"),
                             F.concat(F.col("ddl"), F.lit("\n")).alias("statement"))
    return schemas.unionByName(tables)
