"""Ingest and profiling operators run on the release extracts of the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe import fixtures as FX
from voltframe.functions.casting import yes_no
from voltframe.functions.names import column_name_col, standardize_name_col
from voltframe.plans import profile as P
from voltframe.sources.ingest import add_lineage, conform, reject_counts, rename_columns
from voltframe.sources.releases import is_data_file, select_years, table_names
from voltframe.sources.sinks import replace_years


def _long(spark: SparkSession, sf_dir: str) -> P.LongCells:
    return P.long_cells(FX.release_groups(spark, sf_dir))


def _orders_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = FX.order_release_groups(FX.read_driver(spark, sf_dir, "orders"))
    parts = [conform(df, "sales.orders", FX.ORDERS_RELEASE_SCHEMA) for _, df in groups]
    return parts[0].unionByName(parts[1])


def name_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1/T2 on header- and file-like names built from part attributes."""
    part = FX.read_driver(spark, sf_dir, "part")
    header = F.concat(F.col("p_size").cast("string"), F.lit("__"), F.col("p_type"), F.lit(" "),
                      F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))
    long_header = F.concat_ws(" ", header, *[F.col("p_name")] * 5)
    file_name = F.concat(F.lit("3_"), (F.col("p_size") % 9).cast("string"), F.lit("_"),
                         F.col("p_type"), F.lit("_Y"), (1995 + F.col("p_partkey") % 7).cast("string"),
                         F.lit(".xlsx"))
    # A no-break space and Arabic-Indic digits, which count as white space and as digits.
    unicode_name = F.concat(F.lit("\u0663__"), F.col("p_type"), F.lit("\u00a0"), F.col("p_brand"), F.lit("\u2003ID"))
    return part.select(
        "p_partkey",
        standardize_name_col(unicode_name).alias("unicode_name"),
        standardize_name_col(header).alias("header_name"),
        column_name_col(long_header).alias("column_name"),
        standardize_name_col(file_name).alias("topic"))


def _workbook():
    k = F.col("p_partkey") % 5
    return (F.when(k == 0, F.concat(F.lit("~$3_1_"), "p_type", F.lit("_Y2001.xlsx")))
            .when(k == 1, F.lit("LayoutY2001.xlsx"))
            .when(k == 2, F.concat(F.lit("3_1_"), "p_type", F.lit("_Y2001.xlsx")))
            .when(k == 3, F.concat(F.lit("2___"), "p_brand", F.lit("_Y1999.xlsx")))
            .otherwise(F.concat("p_name", F.lit(".txt"))))


def file_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data workbooks among file names; lock files, layouts and other files go."""
    names = FX.read_driver(spark, sf_dir, "part").select("p_partkey", _workbook().alias("file_name"))
    return names.where(is_data_file("file_name"))


def table_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of each workbook and sheet, derived from their names."""
    sheets = FX.read_driver(spark, sf_dir, "part").select(
        "p_partkey", _workbook().alias("workbook"), F.concat("p_brand", F.lit(" & "), "p_name").alias("sheet"))
    return table_names(sheets).select("p_partkey", "table_name")


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_year from the release, file_date from the scan metadata, upload time now."""
    orders = FX.read_driver(spark, sf_dir, "orders")
    with_lineage = add_lineage(orders, file_year=F.year("o_orderdate"))
    return with_lineage.select(
        "o_orderkey", "file_year",
        F.col("file_date").isNotNull().alias("has_file_date"),
        F.col("upload_timestamp").isNotNull().alias("has_upload_timestamp"))


def yes_no_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: a Y/N text column as BOOLEAN; other text becomes NULL."""
    orders = FX.read_driver(spark, sf_dir, "orders")
    raw = (F.when(F.col("o_orderstatus") == "F", F.lit("Y"))
           .when(F.col("o_orderstatus") == "O", F.lit("N"))
           .otherwise(F.col("o_orderstatus")))
    return orders.select("o_orderkey", raw.alias("raw_flag"), yes_no(raw).alias("is_fulfilled"))


def fill_missing_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two release groups with different columns projected onto one declared schema."""
    return _orders_conformed(spark, sf_dir)


def declared_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text cast to the declared types; '$'-prefixed prices become NULL."""
    return _orders_conformed(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice",
                                                   "file_year")


def declared_cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 report: per declared column, non-NULL texts that failed the cast."""
    groups = FX.order_release_groups(FX.read_driver(spark, sf_dir, "orders"))
    per_group = [reject_counts(df, "sales.orders", FX.ORDERS_RELEASE_SCHEMA) for _, df in groups]
    return (P.union_long(per_group).groupBy("column")
            .agg(F.sum("rejected").cast("bigint").alias("rejected")))


def rename_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw headers renamed to standard names in one projection."""
    orders = FX.read_driver(spark, sf_dir, "orders")
    raw = orders.select(F.col("o_orderkey").alias("Order Key"),
                        F.col("o_custkey").alias("Customer ID"),
                        F.col("o_totalprice").alias("Total Price ($)"),
                        F.col("o_orderstatus").alias("Status?"))
    return rename_columns(raw)


def year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases 1996-1999 of the conformed orders table."""
    return select_years(_orders_conformed(spark, sf_dir), 1996, 1999).select(
        "o_orderkey", "file_year")


def replace_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table holding releases up to 1999, reloaded with re-issued releases 1998-2001."""
    table = _orders_conformed(spark, sf_dir)
    existing = table.where(F.col("file_year") <= 1999)
    reissued = (table.where(F.col("file_year") >= 1998)
                .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    # 2002 is requested and has no data: nothing of it comes in, nothing goes.
    return replace_years(existing, reissued, years=range(1998, 2003)).select(
        "o_orderkey", "file_year", "o_totalprice")


def profile_table_q(spark, sf_dir):
    """P9."""
    return P.profile_table(_long(spark, sf_dir))


def profile_distinct_q(spark, sf_dir):
    """P1."""
    return P.profile_distinct(_long(spark, sf_dir))


def profile_max_len_q(spark, sf_dir):
    """P2."""
    return P.profile_max_len(_long(spark, sf_dir))


def profile_unique_q(spark, sf_dir):
    """P3."""
    return P.profile_unique(_long(spark, sf_dir))


def classify_type_q(spark, sf_dir):
    """P4."""
    return P.classify_type(_long(spark, sf_dir))


def consolidate_types_q(spark, sf_dir):
    """P5."""
    return P.consolidate_types(P.profile_table(_long(spark, sf_dir)))


def years_present_q(spark, sf_dir):
    """P6 (years as a comma list so the value compares as text)."""
    yp = P.years_present(P.profile_table(_long(spark, sf_dir)))
    return yp.select("table_name", F.array_join("years", ",").alias("years"))


def missing_years_q(spark, sf_dir):
    """P7 over the requested range 1995-2001."""
    mis = P.missing_years(P.years_present(P.profile_table(_long(spark, sf_dir))), *FX.RELEASE_YEARS)
    return mis.select("table_name", F.array_join("missing_years", ",").alias("missing_years"))


def render_schema_q(spark, sf_dir):
    """P8."""
    return P.render_schema(P.consolidate_types(P.profile_table(_long(spark, sf_dir))))


INGEST_QUERIES = {
    "name_standardize": name_standardize,
    "lineage_columns": lineage_columns,
    "yes_no_boolean": yes_no_boolean,
    "fill_missing_align": fill_missing_align,
    "declared_cast": declared_cast,
    "declared_cast_rejects": declared_cast_rejects,
    "rename_columns": rename_columns_q,
    "file_filter": file_filter,
    "table_routing": table_routing,
    "year_range": year_range,
    "replace_year": replace_year,
    "profile_table": profile_table_q,
    "profile_distinct": profile_distinct_q,
    "profile_max_len": profile_max_len_q,
    "profile_unique": profile_unique_q,
    "classify_type": classify_type_q,
    "consolidate_types": consolidate_types_q,
    "years_present": years_present_q,
    "missing_years": missing_years_q,
    "render_schema": render_schema_q,
}
