"""The query catalogue behind ``__spark_entry__.queries()``.

Every entry takes ``(spark, sf_dir)``, reads the driver's tables under
``sf_dir`` and returns a DataFrame whose decimal measures are cast to DOUBLE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltframe.fixtures import fixture_tables
from voltframe.functions.casting import measures_as_double
from voltframe.plans import views as V
from voltframe.plans.single_operators import OPERATOR_QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def _view(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return measures_as_double(fn(fixture_tables(spark, sf_dir), **kw))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    "view_a": _view(V.biomass_generators_count),
    "view_b": _view(V.utilities_with_existing_renewable_offset),
    "view_c": _view(V.facility_type_count_by_state),
    "view_d": _view(V.multi_state_solar_facilities_percentage),
    "view_e": _view(V.median_battery_capacity_by_year),
    "view_f": _view(V.wind_solar_capacity_by_utility),
    "view_g": _view(V.current_capacity_mix_by_fuel_type),
    "view_h": _view(V.generators_reaching_retirement),
    "view_i": _view(V.capacity_by_tech_geo_year),
    "view_j": _view(V.additions_vs_retirements_geo),
    "view_j_dedupe": _view(V.additions_vs_retirements_geo, dedupe=True),
    "view_g_evolution": _view(V.capacity_mix_evolution),
    "view_h_gap": _view(V.retirement_capacity_gap),
    "view_i_change": _view(V.penetration_change),
    "view_i_top": _view(V.greatest_penetration_increase),
}

QUERIES.update({name: _view(fn) for name, fn in OPERATOR_QUERIES.items()})

from voltframe.plans.ingest_queries import INGEST_QUERIES  # noqa: E402


def _direct(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return measures_as_double(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES.update({name: _direct(fn) for name, fn in INGEST_QUERIES.items()})
