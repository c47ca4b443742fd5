"""One query per relational operator of SURVEY section 2.4-2.9.

Each function takes the survey tables (``schema.table -> DataFrame``) and
applies one library operator, so that the operator is checked on its own
against the SQL oracle.  IDs in the docstrings are the survey's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.casting import percent, try_int, zero_if_null
from voltframe.functions.predicates import any_of, four_digit_year, in_list, within_recent
from voltframe.operators.change import change_along_order, change_from_previous
from voltframe.operators.joins import full_outer_coalesced, left_join_chain, scalar, with_scalar
from voltframe.operators.latest import latest
from voltframe.operators.ordering import positions
from voltframe.operators.percentile import exact_percentile
from voltframe.operators.share import share_of_group, share_of_large_group
from voltframe.operators.unions import union_all, zero_padded_union
from voltframe.plans.views import (ENERGY_SOURCES, GENERATOR_KEY, MW, Tables, _max_year,
                                   _recent_retirements, _mw_if)
from voltframe.registry import BIOMASS_CODES, FOSSIL_CODES, RENEWABLE_CODES

KEY_YEAR = ("plant_code", "generator_id", "file_year")


def _gen(t: Tables) -> DataFrame:
    return t["generator.operable"]


# Windows ------------------------------------------------------------------
def latest_per_entity(t: Tables) -> DataFrame:
    """Newest release row per (plant_code, generator_id)."""
    return latest(_gen(t), GENERATOR_KEY).select(*KEY_YEAR, "utility_id", MW)


def latest_per_group_tiebreak(t: Tables) -> DataFrame:
    """Newest row per plant, lowest generator_id among the ties (Q3)."""
    return (latest(_gen(t), ["plant_code"], tiebreak=[F.col("generator_id").asc()])
            .select(*KEY_YEAR, "state", "technology"))


def latest_per_entity_year(t: Tables) -> DataFrame:
    """Newest file per (plant_code, generator_id, file_year)."""
    return (latest(t["energystorage.operable"], KEY_YEAR, order=[F.col("file_date").desc()])
            .select(*KEY_YEAR, MW))


def change_from_previous_q(t: Tables) -> DataFrame:
    """State capacity per release and change to the state's previous release."""
    per_year = _gen(t).groupBy("state", "file_year").agg(F.sum(MW).alias("capacity_mw"))
    return change_from_previous(per_year, "capacity_mw", ["state"], [F.col("file_year").asc()],
                                "change_mw")


def share_of_group_q(t: Tables) -> DataFrame:
    """Each fuel's share of its state's capacity over all releases."""
    per_fuel = (_gen(t).groupBy("state", F.col("energy_source_1").alias("fuel_type"))
                .agg(F.sum(MW).alias("capacity_mw")))
    return share_of_group(per_fuel, "capacity_mw", ["state"], "pct_of_state_capacity")


# Projection and predicates ------------------------------------------------
def project_alias(t: Tables) -> DataFrame:
    """Projection with aliases and typed literal columns."""
    return t["solar.operable"].select(
        "utility_id", F.col("plant_code").alias("plant"), F.col("plant_name").alias("name"),
        "file_year", F.lit("Solar").alias("fuel_type"),
        F.lit(0).cast("decimal(38,6)").alias("zero_mw"))


def in_list_q(t: Tables) -> DataFrame:
    """energy_source_1 IN (renewable codes)."""
    return (_gen(t).where(in_list("energy_source_1", RENEWABLE_CODES))
            .select(*KEY_YEAR, "energy_source_1"))


def any_of_membership(t: Tables) -> DataFrame:
    """any of the six energy sources is a biomass code."""
    return (_gen(t).where(any_of(ENERGY_SOURCES, BIOMASS_CODES))
            .select(*KEY_YEAR, "energy_source_1", "energy_source_2"))


def not_null_compare(t: Tables) -> DataFrame:
    """IS NOT NULL and range comparisons."""
    return (_gen(t).where(F.col(MW).isNotNull() & (F.col("operating_year") >= 1980)
                          & (F.col("file_year") > 1996) & (F.col("file_year") <= 2000))
            .select(*KEY_YEAR, "operating_year"))


def regex_guarded_cast(t: Tables) -> DataFrame:
    """The four-digit test guards the integer cast (Q13); ' 1999 '-style text fails it."""
    ry = F.col("retirement_year")
    ok = four_digit_year(ry)
    return t["generator.retired_and_canceled"].select(
        *KEY_YEAR, "retirement_year", F.coalesce(ok, F.lit(False)).alias("is_year"),
        F.when(ok, try_int(ry)).alias("retirement_year_int"))


def recency_band(t: Tables) -> DataFrame:
    """proposals whose current_year lies in [max_year - 3, max_year]."""
    return (t["generator.proposed"]
            .where(within_recent("current_year", _max_year(t), 3))
            .select(*KEY_YEAR, "current_year"))


def derived_predicate(t: Tables) -> DataFrame:
    """a predicate over a derived expression (COALESCE(mw, 0) >= x)."""
    return (_gen(t).withColumn("mw_or_zero", zero_if_null(MW))
            .where(F.col("mw_or_zero") >= 100000).select(*KEY_YEAR, "mw_or_zero"))


# Scalar functions ---------------------------------------------------------
def coalesce_nullif_round(t: Tables) -> DataFrame:
    """COALESCE, NULLIF as a division guard, ROUND on decimal (half up)."""
    per_plant = t["solar.operable"].groupBy("plant_code").agg(
        F.sum(MW).alias("mw"), F.count(MW).alias("n"))
    return per_plant.select(
        "plant_code", zero_if_null("mw").alias("total_mw"),
        F.round(F.col("mw"), 0).alias("rounded_mw"),
        (F.col("mw").cast("double") / F.nullif(F.col("n").cast("double"), F.lit(0.0))).alias("mw_per_unit"))


def case_upper(t: Tables) -> DataFrame:
    """CASE over upper(coalesce(code, ''))."""
    fuel = F.upper(F.coalesce(F.lower("energy_source_1"), F.lit("")))
    return t["generator.retired_and_canceled"].select(
        *KEY_YEAR, fuel.alias("fuel_code"),
        F.when(in_list(fuel, RENEWABLE_CODES), F.lit("renewable"))
         .when(in_list(fuel, FOSSIL_CODES), F.lit("fossil"))
         .otherwise(F.lit("other")).alias("fuel_class"))


def arithmetic_casts(t: Tables) -> DataFrame:
    """Arithmetic on BIGINT and DECIMAL and the 0::numeric cast."""
    return _gen(t).select(
        *KEY_YEAR,
        (F.col("operating_year") + 1).alias("next_year"),
        (F.col("file_year") - F.col("operating_year")).alias("age"),
        (F.col(MW) * 2).alias("double_mw"),
        (F.col(MW) - F.lit(0).cast("decimal(38,6)")).alias("same_mw"),
        (F.col(MW) / 1000).cast("decimal(38,6)").alias("gw"))


# Aggregation ------------------------------------------------------------------
def global_count(t: Tables) -> DataFrame:
    """A1: COUNT(*) with no keys (always one row)."""
    return _gen(t).agg(F.count(F.lit(1)).alias("n_rows"))


def count_distinct_null(t: Tables) -> DataFrame:
    """A2: COUNT(DISTINCT technology) per state; NULL technology is not counted."""
    return _gen(t).groupBy("state").agg(F.count_distinct("technology").alias("technologies"))


def count_filter(t: Tables) -> DataFrame:
    """A3: COUNT(*) FILTER (WHERE capacity IS NULL) next to COUNT(*)."""
    return _gen(t).agg(F.count(F.lit(1)).alias("n_rows"),
                       F.count_if(F.col(MW).isNull()).alias("n_missing_mw"))


def grouped_sum(t: Tables) -> DataFrame:
    """A4: SUM(decimal) by three keys."""
    return (_gen(t).groupBy("file_year", "state", "technology")
            .agg(F.sum(MW).alias("capacity_mw")))


def conditional_sum(t: Tables) -> DataFrame:
    """A5: SUM(CASE WHEN code IN (...) THEN mw ELSE 0 END) per state."""
    return (t["generator.retired_and_canceled"].groupBy("state")
            .agg(_mw_if(RENEWABLE_CODES).alias("retired_renew_mw"),
                 _mw_if(FOSSIL_CODES).alias("retired_fossil_mw")))


def global_max(t: Tables) -> DataFrame:
    """MAX over the whole table (NULL on empty input)."""
    g = _gen(t)
    return g.agg(F.max("file_year").alias("max_year"),
                 F.max(F.when(F.col("state") == "none", F.col("file_year"))).alias("max_year_empty"))


def median_by_year(t: Tables) -> DataFrame:
    """Exact interpolated median of solar capacity per release year."""
    return exact_percentile(t["solar.operable"], ["file_year"], MW, 0.5, "median_mw")


def group_by_expression(t: Tables) -> DataFrame:
    """GROUP BY retirement_year::int over the rows whose year text is four digits."""
    ry = F.col("retirement_year")
    return (t["generator.retired_and_canceled"].where(four_digit_year(ry))
            .groupBy(try_int(ry).alias("year"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(MW).alias("retired_mw")))


def two_stage_rollup(t: Tables) -> DataFrame:
    """(state, county, year) sums rolled up to (state, county)."""
    per_year = (_gen(t).groupBy("state", "county", "file_year")
                .agg(F.sum(MW).alias("mw")))
    return per_year.groupBy("state", "county").agg(
        F.sum("mw").alias("capacity_mw"), F.count(F.lit(1)).alias("releases"))


def multi_property_percent(t: Tables) -> DataFrame:
    """Wind utilities in more than one state, total and percent."""
    per_utility = (t["wind.operable"].groupBy("utility_id")
                   .agg(F.count_distinct("state").alias("states")))
    s = per_utility.agg(F.count(F.lit(1)).alias("total_utilities"),
                        F.count_if(F.col("states") > 1).alias("multistate_utilities"))
    return s.select("*", percent(F.col("multistate_utilities"),
                                 F.col("total_utilities")).alias("percent_multistate"))


def zero_filled_sum(t: Tables) -> DataFrame:
    """COALESCE(SUM(mw), 0) per plant; plants without any capacity give 0."""
    return t["solar.operable"].groupBy("plant_code").agg(zero_if_null(F.sum(MW)).alias("mw"))


# Joins ----------------------------------------------------------------------
def left_join_one_key(t: Tables) -> DataFrame:
    """LEFT JOIN on utility_id between two per-utility aggregates."""
    solar = (t["solar.operable"].groupBy("utility_id", "utility_name")
             .agg(F.sum(MW).alias("solar_mw"))).alias("s")
    wind = (t["wind.operable"].groupBy("utility_id")
            .agg(F.sum(MW).alias("wind_mw"))).alias("w")
    return (solar.join(wind, F.col("s.utility_id") == F.col("w.utility_id"), "left")
            .select("s.utility_id", "s.utility_name", "s.solar_mw", "w.wind_mw"))


def left_join_chain_q(t: Tables) -> DataFrame:
    """A total LEFT JOINed with three co-partitioned aggregates on (file_year, state)."""
    keys = ["file_year", "state"]

    def agg(name, col):
        return t[name].groupBy(*keys).agg(F.sum(MW).alias(col))
    return left_join_chain(agg("generator.operable", "total_mw"),
                           [agg("solar.operable", "solar_mw"), agg("wind.operable", "wind_mw"),
                            agg("energystorage.operable", "storage_mw")], keys)


def _ret_rollup(t: Tables) -> DataFrame:
    g = t["generator.retired_and_canceled"]
    return g.groupBy("state", "county").agg(F.sum(MW).alias("retired_mw"))


def _prop_rollup(t: Tables, name: str, col: str) -> DataFrame:
    return t[name].groupBy("state", "county").agg(F.sum(MW).alias(col))


def full_outer_two_key(t: Tables) -> DataFrame:
    """FULL OUTER JOIN on (state, county); NULL keys stay unmatched on both sides."""
    return full_outer_coalesced([_ret_rollup(t), _prop_rollup(t, "generator.proposed", "proposed_mw")],
                                ["state", "county"])


def full_outer_coalesced_key(t: Tables) -> DataFrame:
    """A third FULL OUTER JOIN on the coalesced keys of the first two."""
    return full_outer_coalesced(
        [_ret_rollup(t), _prop_rollup(t, "generator.proposed", "proposed_mw"),
         _prop_rollup(t, "energystorage.proposed", "proposed_storage_mw")], ["state", "county"])


def latest_year_filter(t: Tables) -> DataFrame:
    """Rows of the newest release only (scalar subquery on the partition column)."""
    return (_gen(t).where(F.col("file_year") == _max_year(t))
            .groupBy("state").agg(F.count(F.lit(1)).alias("generators")))


def cross_one_row(t: Tables) -> DataFrame:
    """Rows combined with a one-row parameter relation (max year, 3 recent years).

    The one-row relation is attached as scalar subqueries rather than a cross
    join: same rows, and the single row is guaranteed by the keyless aggregate.
    """
    params = _gen(t).select(F.max("file_year").alias("max_year"))
    g = with_scalar(_gen(t), "max_year", params)
    return (g.where(F.col("file_year") >= F.col("max_year") - 3)
            .groupBy("file_year", "max_year").agg(F.count(F.lit(1)).alias("generators")))


def scalar_subquery(t: Tables) -> DataFrame:
    """An uncorrelated scalar subquery in the SELECT list."""
    newest = _max_year(t)
    return _gen(t).select(*KEY_YEAR, newest.alias("max_year"),
                          (newest - F.col("file_year")).alias("releases_behind"))


# Set operations and ordering -------------------------------------------------
def union_two(t: Tables) -> DataFrame:
    """UNION ALL of two column-pruned tables."""
    cols = ["utility_id", "file_year", MW]
    return union_all(t["wind.operable"].select(*cols), t["solar.operable"].select(*cols))


def union_tagged(t: Tables) -> DataFrame:
    """Three branches with a tag literal."""
    def branch(name, tag):
        return t[name].select("state", F.lit(tag).alias("kind"), MW)
    return union_all(branch("generator.operable", "Generator"), branch("solar.operable", "Solar"),
                     branch("wind.operable", "Wind"))


def union_zero_padded(t: Tables) -> DataFrame:
    """Four retirement branches, each filling its own measure, zeros elsewhere."""
    max_year = _max_year(t)
    measures = ["gen_mw", "solar_mw", "wind_mw", "storage_mw"]
    branches = []
    for table, m in (("generator.retired_and_canceled", "gen_mw"),
                     ("solar.retired_and_canceled", "solar_mw"),
                     ("wind.retired_and_canceled", "wind_mw"),
                     ("energystorage.retired_and_canceled", "storage_mw")):
        df = _recent_retirements(t[table], max_year, [zero_if_null(F.sum(MW)).alias(m)])
        branches.append((df, {m: m}))
    return zero_padded_union(branches, ["state", "county", "year"], measures)


def order_nulls(t: Tables) -> DataFrame:
    """O1: PostgreSQL order (DESC puts NULL first) made visible as a position per county."""
    per_plant = (_gen(t).where(F.col("file_year") == _max_year(t))
                 .groupBy("state", "county", "plant_code").agg(F.sum(MW).alias("capacity_mw")))
    return positions(per_plant, ["state", "county"], "-capacity_mw", "plant_code")


def change_along_state(t: Tables) -> DataFrame:
    """W4 on raw rows: each generator row's capacity less that of the row before it in its state."""
    rows = _gen(t).select("state", *KEY_YEAR, MW)
    return change_along_order(rows, MW, ["state"], "file_year", "plant_code", "generator_id", name="change_mw")


def share_of_state_year(t: Tables) -> DataFrame:
    """W5 on raw rows: each generator row's share of its state's capacity in its release."""
    rows = _gen(t).select("state", *KEY_YEAR, MW)
    return share_of_large_group(rows, MW, ["state", "file_year"], "pct_of_state_capacity")


OPERATOR_QUERIES = {
    "latest_per_entity": latest_per_entity,
    "latest_per_group_tiebreak": latest_per_group_tiebreak,
    "latest_per_entity_year": latest_per_entity_year,
    "change_from_previous": change_from_previous_q,
    "share_of_group": share_of_group_q,
    "project_alias": project_alias,
    "in_list": in_list_q,
    "any_of_membership": any_of_membership,
    "not_null_compare": not_null_compare,
    "regex_guarded_cast": regex_guarded_cast,
    "recency_band": recency_band,
    "derived_predicate": derived_predicate,
    "coalesce_nullif_round": coalesce_nullif_round,
    "case_upper": case_upper,
    "arithmetic_casts": arithmetic_casts,
    "global_count": global_count,
    "count_distinct_null": count_distinct_null,
    "count_filter": count_filter,
    "grouped_sum": grouped_sum,
    "conditional_sum": conditional_sum,
    "global_max": global_max,
    "median_by_year": median_by_year,
    "group_by_expression": group_by_expression,
    "two_stage_rollup": two_stage_rollup,
    "multi_property_percent": multi_property_percent,
    "zero_filled_sum": zero_filled_sum,
    "left_join_one_key": left_join_one_key,
    "left_join_chain": left_join_chain_q,
    "full_outer_two_key": full_outer_two_key,
    "full_outer_coalesced_key": full_outer_coalesced_key,
    "latest_year_filter": latest_year_filter,
    "cross_one_row": cross_one_row,
    "scalar_subquery": scalar_subquery,
    "union_two": union_two,
    "union_tagged": union_tagged,
    "union_zero_padded": union_zero_padded,
    "order_nulls": order_nulls,
    "change_along_state": change_along_state,
    "share_of_state_year": share_of_state_year,
}
