"""Ka-Kj: the ten analytical views, plus Kg2, Kh2, Ki2 (README intent).

Each view is a function ``tables -> DataFrame`` where ``tables`` maps
``schema.table`` to a DataFrame with the registry schema (a partitioned
Parquet table in production, the fixture projection in tests).  Measures are
kept in DECIMAL as in the reference; ``queries()`` casts them to DOUBLE at the
very end.  ``ordered=False`` drops the final ORDER BY (a global range sort)
when the caller only needs the rows.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.casting import percent, ratio, try_int, zero_if_null
from voltframe.functions.predicates import any_of, four_digit_year, in_list, within_recent
from voltframe.operators.change import change_from_previous
from voltframe.operators.joins import full_outer_coalesced, left_join_chain, scalar
from voltframe.operators.latest import latest
from voltframe.operators.ordering import pg_order
from voltframe.operators.percentile import exact_percentile
from voltframe.operators.share import share_of_group
from voltframe.operators.unions import union_all
from voltframe.registry import BIOMASS_CODES, FOSSIL_CODES, RENEWABLE_CODES

Tables = Mapping[str, DataFrame]

ENERGY_SOURCES = tuple(f"energy_source_{i}" for i in range(1, 7))
GENERATOR_KEY = ("plant_code", "generator_id")
MW = "nameplate_capacity_mw"
GEO_YEAR = ("file_year", "state", "county")
RECENT_YEARS = 3


def _mw_not_null(df: DataFrame) -> DataFrame:
    return df.where(F.col(MW).isNotNull())


def _max_year(tables: Tables) -> Column:
    """Newest release of generator.operable as a scalar subquery (prunes partitions)."""
    return scalar(tables["generator.operable"].select(F.max("file_year")))


def _maybe_order(df: DataFrame, ordered: bool, *spec: str) -> DataFrame:
    return pg_order(df, *spec) if ordered else df


# (a) ----------------------------------------------------------------------
def biomass_generators_count(t: Tables) -> DataFrame:
    """Ka: latest row per generator first, then the biomass test on six fuels (Q1, Q2)."""
    g = t["generator.operable"].select(*GENERATOR_KEY, "file_year", "file_date", *ENERGY_SOURCES)
    newest = latest(g, GENERATOR_KEY)
    return (newest.where(any_of(ENERGY_SOURCES, BIOMASS_CODES))
            .agg(F.count(F.lit(1)).alias("biomass_operable_generators")))


# (b) ----------------------------------------------------------------------
def _latest_mw(df: DataFrame, where: Column | None = None) -> DataFrame:
    return latest(df, GENERATOR_KEY, where=where).select("utility_id", "utility_name", MW)


def utilities_with_existing_renewable_offset(t: Tables, ordered: bool = True) -> DataFrame:
    """Kb: biomass filter before "latest"; renewables joined on utility_id only (Q5)."""
    biomass = (_latest_mw(t["generator.operable"], any_of(ENERGY_SOURCES, BIOMASS_CODES))
               .groupBy("utility_id", "utility_name").agg(F.sum(MW).alias("biomass_mw")))
    # One window over the tagged union of the three tables (partitioned by
    # table, plant, generator) = three separate "latest" CTEs, one exchange.
    cols = ["utility_id", "utility_name", *GENERATOR_KEY, "file_year", "file_date", MW]
    tagged = union_all(*[t[f"{x}.operable"].select(F.lit(x).alias("_source"), *cols)
                         for x in ("solar", "wind", "energystorage")])
    renew = (latest(tagged, ["_source", *GENERATOR_KEY])
             .groupBy("utility_id", "utility_name").agg(F.sum(MW).alias("renew_mw")))
    b, r = biomass.alias("b"), renew.alias("r")
    renew_mw = zero_if_null(F.col("r.renew_mw"))
    out = (b.join(r, F.col("r.utility_id") == F.col("b.utility_id"), "left")
           .where(renew_mw >= F.col("b.biomass_mw"))
           .select(F.col("b.utility_id").alias("utility_id"),
                   F.col("b.utility_name").alias("utility_name"),
                   F.col("b.biomass_mw").alias("biomass_mw"),
                   renew_mw.alias("renew_mw"),
                   (renew_mw - F.col("b.biomass_mw")).alias("surplus_mw")))
    return _maybe_order(out, ordered, "-surplus_mw")


# (c) ----------------------------------------------------------------------
def facility_type_count_by_state(t: Tables, ordered: bool = True) -> DataFrame:
    """Kc: one row per plant (newest release, lowest generator_id on ties - Q3)."""
    g = t["generator.operable"].select("plant_code", "generator_id", "file_year", "file_date",
                                       "state", "technology")
    per_plant = latest(g, ["plant_code"], tiebreak=[F.col("generator_id").asc()])
    # One row per plant_code after latest(), so COUNT(plant_code) equals the
    # reference's COUNT(DISTINCT plant_code) (NULL not counted, Q4) without the
    # extra distinct-aggregation stage.
    out = (per_plant.groupBy("state", "technology")
           .agg(F.count("plant_code").alias("facilities")))
    return _maybe_order(out, ordered, "state", "-facilities")


# (d) ----------------------------------------------------------------------
def multi_state_solar_facilities_percentage(t: Tables) -> DataFrame:
    """Kd: over all solar releases, utilities present in more than one state."""
    per_utility = (t["solar.operable"].groupBy("utility_id", "utility_name")
                   .agg(F.count_distinct("state").alias("state_count")))
    summary = per_utility.agg(
        F.count(F.lit(1)).alias("total_utilities"),
        F.count_if(F.col("state_count") > 1).alias("multistate_utilities"))
    return summary.select(
        "multistate_utilities", "total_utilities",
        percent(F.col("multistate_utilities"), F.col("total_utilities")).alias("percent_multistate"))


# (e) ----------------------------------------------------------------------
def median_battery_capacity_by_year(t: Tables, approx: bool = False,
                                    ordered: bool = True) -> DataFrame:
    """Ke: exact interpolated median per release year.

    A release year is a group that may hold a large share of all rows, so the
    median is computed by :func:`exact_percentile` (a quantile summary bounds the
    values that are ranked) rather than one task per year.
    ``approx=True`` uses ``percentile_approx`` instead.
    """
    e = _mw_not_null(t["energystorage.operable"]).select(*GENERATOR_KEY, "file_year", "file_date", MW)
    newest = latest(e, [*GENERATOR_KEY, "file_year"], order=[F.col("file_date").desc()])
    value = F.col(MW).cast("double")
    if approx:
        out = newest.groupBy("file_year").agg(
            F.percentile_approx(value, 0.5, 100000).alias("median_battery_mw"))
    else:
        out = exact_percentile(newest, ["file_year"], value, 0.5, "median_battery_mw")
    return _maybe_order(out, ordered, "file_year")


# (f) ----------------------------------------------------------------------
def wind_solar_capacity_by_utility(t: Tables, ordered: bool = True) -> DataFrame:
    """Kf: wind + solar MW per (utility, name, year), change to the utility's previous row (Q6)."""
    cols = ["utility_id", "utility_name", "file_year", MW]
    both = union_all(_mw_not_null(t["wind.operable"]).select(*cols),
                     _mw_not_null(t["solar.operable"]).select(*cols))
    per_year = (both.groupBy("utility_id", "utility_name", "file_year")
                .agg(F.sum(MW).alias("wind_solar_capacity_mw")))
    out = change_from_previous(per_year, "wind_solar_capacity_mw", ["utility_id"],
                               [F.col("file_year").asc(), F.col("utility_name").asc()],
                               "yoy_increase_mw")
    return _maybe_order(out, ordered, "utility_id", "file_year")


# (g) ----------------------------------------------------------------------
def _capacity_by_fuel(t: Tables, year_filter: Column) -> DataFrame:
    """Generator rows by energy_source_1, plus solar and wind tagged as fuels (Q7)."""
    def branch(name: str, fuel: Column) -> DataFrame:
        return (_mw_not_null(t[name]).where(year_filter)
                .select("file_year", "state", fuel.alias("fuel_type"), MW))
    return union_all(branch("generator.operable", F.col("energy_source_1")),
                     branch("solar.operable", F.lit("Solar")),
                     branch("wind.operable", F.lit("Wind")))


def current_capacity_mix_by_fuel_type(t: Tables, ordered: bool = True) -> DataFrame:
    """Kg: newest release only; MW per (state, fuel) and share of the state's total."""
    cap = _capacity_by_fuel(t, F.col("file_year") == _max_year(t))
    per_fuel = cap.groupBy("state", "fuel_type").agg(F.sum(MW).alias("capacity_mw"))
    out = share_of_group(per_fuel, "capacity_mw", ["state"], "pct_of_state_capacity")
    return _maybe_order(out, ordered, "state", "-capacity_mw")


def capacity_mix_evolution(t: Tables, years: int = 5, ordered: bool = True) -> DataFrame:
    """Kg2: the mix of each of the last ``years`` releases and the change in share."""
    cap = _capacity_by_fuel(t, F.col("file_year") > _max_year(t) - F.lit(years))
    per_fuel = (cap.groupBy("file_year", "state", "fuel_type")
                .agg(F.sum(MW).alias("capacity_mw")))
    shared = share_of_group(per_fuel, "capacity_mw", ["file_year", "state"], "pct_of_state_capacity")
    out = change_from_previous(shared, "pct_of_state_capacity", ["state", "fuel_type"],
                               [F.col("file_year").asc()], "pct_change")
    return _maybe_order(out, ordered, "state", "fuel_type", "file_year")


# (h) ----------------------------------------------------------------------
def _aged(t: Tables, min_age: int) -> DataFrame:
    g = t["generator.operable"].where(F.col("operating_year").isNotNull())
    age = (_max_year(t) - F.col("operating_year")).alias("age_years")
    return g.select("*", age).where(F.col("age_years") >= min_age)


def generators_reaching_retirement(t: Tables, min_age: int = 40, ordered: bool = True) -> DataFrame:
    """Kh: age = newest release year - operating year, one row per generator *and* release (Q11)."""
    out = _aged(t, min_age).select(
        "utility_id", "utility_name", "plant_code", "plant_name", "generator_id", "state",
        "technology", "energy_source_1", "operating_year", "age_years", MW)
    return _maybe_order(out, ordered, "-age_years", f"-{MW}")


def retirement_capacity_gap(t: Tables, min_age: int = 40, ordered: bool = True) -> DataFrame:
    """Kh2: capacity that would leave per (state, technology) if aged units of the newest release retire."""
    newest = _aged(t, min_age).where(F.col("file_year") == _max_year(t))
    out = newest.groupBy("state", "technology").agg(
        F.sum(MW).alias("capacity_gap_mw"), F.count(F.lit(1)).alias("aged_generators"))
    return _maybe_order(out, ordered, "-capacity_gap_mw", "state", "technology")


# (i) ----------------------------------------------------------------------
def _geo_sum(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(*GEO_YEAR).agg(F.sum(MW).alias(name))


def capacity_by_tech_geo_year(t: Tables) -> DataFrame:
    """Ki: total / solar / wind / storage MW per (year, state, county); total drives.

    Each side is aggregated on the join keys first, so the three left joins
    reuse that hash partitioning (or AQE broadcasts a small side).
    """
    total = _geo_sum(t["generator.operable"], "total_mw")
    sides = [_geo_sum(t["solar.operable"], "solar_mw"),
             _geo_sum(t["wind.operable"], "wind_mw"),
             _geo_sum(t["energystorage.operable"], "storage_mw")]
    joined = left_join_chain(total, sides, GEO_YEAR)
    return joined.select(*GEO_YEAR, "total_mw",
                         *[zero_if_null(c).alias(c) for c in ("solar_mw", "wind_mw", "storage_mw")])


def penetration_change(t: Tables, ordered: bool = True) -> DataFrame:
    """Ki2: renewable (solar + wind) and storage share of total MW, and change to the previous release."""
    base = capacity_by_tech_geo_year(t)
    shares = base.select(
        *GEO_YEAR,
        percent(F.col("solar_mw") + F.col("wind_mw"), F.col("total_mw")).alias("renewable_share"),
        percent(F.col("storage_mw"), F.col("total_mw")).alias("storage_share"))
    out = change_from_previous(shares, "renewable_share", ["state", "county"],
                               [F.col("file_year").asc()], "renewable_share_change")
    out = change_from_previous(out, "storage_share", ["state", "county"],
                               [F.col("file_year").asc()], "storage_share_change")
    return _maybe_order(out, ordered, "state", "county", "file_year")


def greatest_penetration_increase(t: Tables, k: int = 10) -> DataFrame:
    """Ki2 report: the ``k`` places with the largest renewable-share increase in the newest release.

    The limit is the feature (a top-k report); ties are broken by state, county.
    """
    changes = penetration_change(t, ordered=False)
    newest = changes.where(F.col("file_year") == _max_year(t))
    return (newest.where(F.col("renewable_share_change").isNotNull())
            .orderBy(F.col("renewable_share_change").desc(), F.col("state").asc_nulls_last(),
                     F.col("county").asc_nulls_last())
            .limit(k))


# (j) ----------------------------------------------------------------------
RET_MEASURES = ("retired_gen_mw", "retired_renew_mw", "retired_fossil_mw",
                "retired_solar_mw", "retired_wind_mw", "retired_storage_mw")


def _recent_retirements(df: DataFrame, max_year: Column, aggs: list[Column]) -> DataFrame:
    ry = F.col("retirement_year")
    year = try_int(ry)
    recent = df.where(ry.isNotNull() & four_digit_year(ry) & within_recent(year, max_year, RECENT_YEARS))
    return recent.groupBy("state", "county", year.alias("year")).agg(*aggs)


RETIREMENT_SOURCES = (("gen", "generator.retired_and_canceled"),
                      ("solar", "solar.retired_and_canceled"),
                      ("wind", "wind.retired_and_canceled"),
                      ("storage", "energystorage.retired_and_canceled"))


def _recent_retirements_all(t: Tables, max_year: Column) -> DataFrame:
    """ret_all of the reference in one aggregation over a tagged union.

    The reference aggregates each table per (state, county, year), zero-fills
    (A12) and pads the other measures with 0 (U3).  Summing per source inside
    one aggregation and zero-filling afterwards gives the same rows: a key
    with no rows of a source gets 0 for that source's measures, exactly like
    the padded branches.  One exchange instead of four.
    """
    def branch(src: str, name: str) -> DataFrame:
        df = t[name]
        fuel = (F.col("energy_source_1") if "energy_source_1" in df.columns
                else F.lit(None).cast("string"))
        return df.select(F.lit(src).alias("_source"), "state", "county", "retirement_year",
                         fuel.alias("energy_source_1"), MW)

    tagged = union_all(*[branch(src, name) for src, name in RETIREMENT_SOURCES])
    src = F.col("_source")

    def from_source(tag: str, extra: Column | None = None) -> Column:
        cond = src == tag
        if extra is None:
            return F.sum(F.when(cond, F.col(MW)))
        return F.sum(F.when(cond & extra, F.col(MW)).when(cond, F.lit(0)))

    fuel = F.upper(F.coalesce(F.col("energy_source_1"), F.lit("")))
    per_year = _recent_retirements(tagged, max_year, [
        from_source("gen").alias("retired_gen_mw"),
        from_source("gen", in_list(fuel, RENEWABLE_CODES)).alias("retired_renew_mw"),
        from_source("gen", in_list(fuel, FOSSIL_CODES)).alias("retired_fossil_mw"),
        from_source("solar").alias("retired_solar_mw"),
        from_source("wind").alias("retired_wind_mw"),
        from_source("storage").alias("retired_storage_mw")])
    return per_year.select("state", "county", "year", *[zero_if_null(m).alias(m) for m in RET_MEASURES])


def _recent_proposals(df: DataFrame, max_year: Column, name: str) -> DataFrame:
    cy = F.col("current_year")
    recent = df.where(cy.isNotNull() & within_recent(cy, max_year, RECENT_YEARS))
    per_year = recent.groupBy("state", "county", cy.cast("int").alias("year")).agg(F.sum(MW).alias(name))
    return per_year.groupBy("state", "county").agg(F.sum(name).alias(f"{name}_recent"))


def _mw_if(codes) -> Column:
    fuel = F.upper(F.coalesce(F.col("energy_source_1"), F.lit("")))
    return F.sum(F.when(in_list(fuel, codes), F.col(MW)).otherwise(F.lit(0)))


def additions_vs_retirements_geo(t: Tables, dedupe: bool = False) -> DataFrame:
    """Kj: retirements of the last releases' band vs proposals, per (state, county).

    Band = [max_year - 3, max_year] of generator.operable.  Sums run over all
    releases, so a unit listed in several releases counts several times (Q14);
    ``dedupe=True`` keeps only the newest release row of each generator of each
    retirement / proposal table instead.  Net change subtracts generator
    retirements only, as the reference does.
    """
    max_year = _max_year(t)
    if dedupe:
        t = {name: (latest(df, GENERATOR_KEY) if name.endswith(("retired_and_canceled", "proposed"))
                    else df) for name, df in t.items()}
    ret_all = _recent_retirements_all(t, max_year)
    ret_rollup = ret_all.groupBy("state", "county").agg(
        *[F.sum(m).alias(f"{m}_recent") for m in RET_MEASURES])

    prop = _recent_proposals(t["generator.proposed"], max_year, "proposed_gen_mw")
    prop_storage = _recent_proposals(t["energystorage.proposed"], max_year, "proposed_storage_mw")
    joined = full_outer_coalesced([ret_rollup, prop, prop_storage], ["state", "county"])

    z = {c: zero_if_null(c) for c in joined.columns if c.endswith("_recent")}
    proposed_total = z["proposed_gen_mw_recent"] + z["proposed_storage_mw_recent"]
    return joined.select(
        "state", "county",
        *[z[f"{m}_recent"].alias(f"{m}_recent") for m in
          ("retired_gen_mw", "retired_fossil_mw", "retired_renew_mw", "retired_solar_mw",
           "retired_wind_mw", "retired_storage_mw", "proposed_gen_mw", "proposed_storage_mw")],
        proposed_total.alias("proposed_total_mw_recent"),
        (proposed_total - z["retired_gen_mw_recent"]).alias("net_mw_change_recent"),
        ratio(proposed_total, z["retired_gen_mw_recent"]).alias("replacement_ratio_recent"),
    )


# S9 ------------------------------------------------------------------------
VIEWS = {
    "biomass_generators_count": biomass_generators_count,
    "utilities_with_existing_renewable_offset": utilities_with_existing_renewable_offset,
    "facility_type_count_by_state": facility_type_count_by_state,
    "multi_state_solar_facilities_percentage": multi_state_solar_facilities_percentage,
    "median_battery_capacity_by_year": median_battery_capacity_by_year,
    "wind_solar_capacity_by_utility": wind_solar_capacity_by_utility,
    "current_capacity_mix_by_fuel_type": current_capacity_mix_by_fuel_type,
    "generators_reaching_retirement": generators_reaching_retirement,
    "capacity_by_tech_geo_year": capacity_by_tech_geo_year,
    "additions_vs_retirements_geo": additions_vs_retirements_geo,
}


def register_views(spark: SparkSession, tables: Tables, prefix: str = "analysis_") -> list[str]:
    """Register the raw tables and the ten views as temporary views.

    Tables become ``generator_operable`` etc.; views ``analysis_<name>``.  No job runs
    and nothing is kept but plans.  A plan holds its tables' file list, so register
    again after a load (:func:`register_warehouse`).
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name.replace(".", "_"))
    names = []
    for name, fn in VIEWS.items():
        fn(tables).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def register_warehouse(spark: SparkSession, warehouse: str) -> list[str]:
    """S9 over the landed tables below ``warehouse``, with the files of the moment; the loader's last step."""
    from voltframe.sources.catalog import read_tables

    for name in SURVEY_TABLES:
        spark.catalog.refreshByPath(f"{warehouse.rstrip('/')}/{name}")
    return register_views(spark, read_tables(spark, warehouse, SURVEY_TABLES))


#: The raw tables that the ten views read.
SURVEY_TABLES = ("generator.operable", "generator.proposed", "generator.retired_and_canceled", "solar.operable",
                 "solar.retired_and_canceled", "wind.operable", "wind.retired_and_canceled",
                 "energystorage.operable", "energystorage.proposed", "energystorage.retired_and_canceled")
