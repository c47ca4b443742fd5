"""Survey-shaped tables derived from the driver's generated tables.

The driver ships TPC-H-like tables, not survey releases.  Both the Spark side
and the SQL oracle start from one definition: ``lineitem`` grouped to a unique
grain ``(ship year, part, line number)``, one row per generator and release.

  file_year   year(l_shipdate)            plant_code  l_partkey
  file_date   max(l_shipdate)             generator_id 'G' || l_linenumber
  utility_id  min(l_suppkey)              county      'C' || plant_code % 7
  utility_name 'U' || id, ' new' appended for ids divisible by 10 from 1999 (Q5, Q6)
  state       NULL when plant_code % 101 = 0, else 'S' || (utility_id + [plant_code % 97 = 0]) % 25
  energy_source_1  cycle NG SUN WND WDS LFG BIT MWH WAT NULL over (plant_code + line) % 9
  energy_source_2  'MSW' when (plant_code + file_year) % 11 = 0
  nameplate_capacity_mw  sum of extended prices as decimal, NULL when plant_code % 53 = 0
  operating_year  1950 + plant_code % 55;  current_year 1996 + plant_code % 8
  retirement_year 'n/a' when plant_code % 13 = 0, NULL when % 17 = 0,
                  '<year> ' (trailing blank) when % 19 = 0, else 1990 + plant_code % 12

Tables: generator.operable = all rows; solar / wind / energystorage.operable =
energy_source_1 SUN / WND / MWH; *.retired_and_canceled = rows with a returned
line; generator.proposed = rows with an open line, sited in counties C0-C8;
energystorage.proposed = open storage rows of the two newest releases only (the
table is published in two years).  Every table is conformed to its registry
schema, so unused survey columns are typed NULLs that column pruning removes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.sources.ingest import conform

# Fixed values of the fixture definition.
ENERGY_SOURCE_CYCLE = ("NG", "SUN", "WND", "WDS", "LFG", "BIT", "MWH", "WAT", None)
TECH_TABLES = {"solar": "SUN", "wind": "WND", "energystorage": "MWH"}
SURVEY_TABLES_USED = (
    "generator.operable", "solar.operable", "wind.operable", "energystorage.operable",
    "generator.retired_and_canceled", "solar.retired_and_canceled",
    "wind.retired_and_canceled", "energystorage.retired_and_canceled",
    "generator.proposed", "energystorage.proposed",
)


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cycle(idx: Column, values) -> Column:
    arr = F.array(*[F.lit(v) if v is not None else F.lit(None).cast("string") for v in values])
    return F.element_at(arr, (idx + F.lit(1)).cast("int"))


def generator_rows(lineitem: DataFrame) -> DataFrame:
    """One row per (release year, plant, generator) with every fixture column."""
    grain = lineitem.groupBy(
        F.year("l_shipdate").cast("int").alias("file_year"),
        F.col("l_partkey").alias("plant_code"),
        F.col("l_linenumber").alias("line_no"),
    ).agg(
        F.max("l_shipdate").alias("file_date"),
        F.min("l_suppkey").alias("utility_id"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price_sum"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("is_ret"),
        F.max((F.col("l_linestatus") == "O").cast("int")).alias("is_prop"),
    )
    pc, uid, year = F.col("plant_code"), F.col("utility_id"), F.col("file_year")
    renamed = (uid % 10 == 0) & (year >= 1999)
    state_no = (uid + F.when(pc % 97 == 0, 1).otherwise(0)) % 25
    es1 = _cycle((pc + F.col("line_no")) % 9, ENERGY_SOURCE_CYCLE)
    retire = (F.when(pc % 13 == 0, F.lit("n/a"))
              .when(pc % 17 == 0, F.lit(None).cast("string"))
              .when(pc % 19 == 0, F.concat((1990 + pc % 12).cast("string"), F.lit(" ")))
              .otherwise((1990 + pc % 12).cast("string")))
    return grain.select(
        "file_year", "file_date", "utility_id",
        F.concat(F.lit("U"), uid.cast("string"),
                 F.when(renamed, F.lit(" new")).otherwise(F.lit(""))).alias("utility_name"),
        "plant_code",
        F.concat(F.lit("P"), pc.cast("string")).alias("plant_name"),
        F.concat(F.lit("G"), F.col("line_no").cast("string")).alias("generator_id"),
        F.when(pc % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("S"), state_no.cast("string"))).alias("state"),
        F.concat(F.lit("C"), (pc % 7).cast("string")).alias("county"),
        es1.alias("technology"),
        es1.alias("energy_source_1"),
        F.when((pc + year) % 11 == 0, F.lit("MSW")).alias("energy_source_2"),
        F.when(pc % 53 == 0, F.lit(None).cast("decimal(18,6)"))
         .otherwise(F.col("price_sum").cast("decimal(18,6)")).alias("nameplate_capacity_mw"),
        (1950 + pc % 55).cast("bigint").alias("operating_year"),
        retire.alias("retirement_year"),
        (1996 + pc % 8).cast("bigint").alias("current_year"),
        F.concat(F.lit("C"), (pc % 9).cast("string")).alias("proposed_county"),
        "is_ret", "is_prop",
    )


def survey_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The ten survey tables the views read, each conformed to its registry schema."""
    es1 = F.col("energy_source_1")
    ret = rows.where(F.col("is_ret") == 1)
    prop = rows.where(F.col("is_prop") == 1).withColumn("county", F.col("proposed_county"))
    lineage = {"upload_timestamp": F.col("file_date")}
    raw = {
        "generator.operable": rows,
        "generator.retired_and_canceled": ret,
        "generator.proposed": prop,
    }
    for topic, code in TECH_TABLES.items():
        raw[f"{topic}.operable"] = rows.where(es1 == code)
        raw[f"{topic}.retired_and_canceled"] = ret.where(es1 == code)
    newest = rows.select(F.max("file_year"))
    raw["energystorage.proposed"] = prop.where(
        (es1 == "MWH") & (F.col("file_year") >= newest.scalar() - 1))
    return {t: conform(df.withColumns(lineage), t) for t, df in raw.items()}


def fixture_tables(spark: SparkSession, sf_dir: str, stage_dir: str | None = None) -> dict[str, DataFrame]:
    """The ten survey tables.  With ``stage_dir`` the shared generator rows are
    written there once (a table in the shared checkpoint folder, which also cuts
    the lineage) and the ten tables are derived from that copy."""
    rows = generator_rows(read_driver(spark, sf_dir, "lineitem"))
    if stage_dir is not None:
        rows.write.mode("overwrite").parquet(stage_dir)
        rows = spark.read.parquet(stage_dir)
    return survey_tables(rows)


# ---------------------------------------------------------------------------
# Raw release extracts for the ingest and profiling operators.
#
# Three "tables" released yearly as text extracts (what a delimited read with
# an all-string schema yields), with deliberate drift between releases:
#   sales.orders     orders by year(o_orderdate); o_totalprice written with a
#                    '$' prefix up to 1996 (text that is not a number) and
#                    o_orderpriority dropped from 2000 on (missing column);
#                    releases up to 1999 also carry an extra o_comment column
#   sales.lineitem   lineitem by year(l_shipdate); l_quantity written as an
#                    integer from 1999 on, with two decimals before (Q17)
#   sales.late_lines lineitem shipped from 2000 on only: a table with
#                    releases in two years
# ---------------------------------------------------------------------------
RELEASE_YEARS = (1995, 2001)
ORDERS_RELEASE_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DecimalType(18, 6)),
    T.StructField("o_orderpriority", T.StringType()),
    T.StructField("o_clerk", T.StringType()),
    T.StructField("file_year", T.IntegerType()),
])


def _money_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def order_release_groups(orders: DataFrame) -> list[tuple[str, DataFrame]]:
    """The two scan groups of sales.orders (different headers), all columns text."""
    year = F.year("o_orderdate").cast("int")
    price = F.when(year <= 1996, F.concat(F.lit("$"), _money_text(F.col("o_totalprice")))) \
             .otherwise(_money_text(F.col("o_totalprice")))
    base = orders.select(
        year.alias("file_year"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus", price.alias("o_totalprice"), "o_orderpriority")
    early = base.where(F.col("file_year") <= 1999).withColumn(
        "o_comment", F.concat(F.lit("order "), F.col("o_orderkey")))
    late = base.where(F.col("file_year") >= 2000).drop("o_orderpriority")
    return [("sales.orders", early), ("sales.orders", late)]


def lineitem_release_groups(lineitem: DataFrame) -> list[tuple[str, DataFrame]]:
    year = F.year("l_shipdate").cast("int")
    qty = F.when(year >= 1999, F.col("l_quantity").cast("bigint").cast("string")) \
           .otherwise(_money_text(F.col("l_quantity")))
    lines = lineitem.select(
        year.alias("file_year"),
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        qty.alias("l_quantity"), "l_returnflag", "l_linestatus")
    late = lineitem.where(year >= 2000).select(
        year.alias("file_year"),
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.to_date("l_shipdate").cast("string").alias("l_shipdate"))
    return [("sales.lineitem", lines), ("sales.late_lines", late)]


def release_groups(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    return (order_release_groups(read_driver(spark, sf_dir, "orders"))
            + lineitem_release_groups(read_driver(spark, sf_dir, "lineitem")))
