"""Plan assertions: the physical plans are the ones the design relies on."""

import pytest

from voltframe.fixtures import SURVEY_TABLES_USED, fixture_tables
from voltframe.plans import views as V
from voltframe.sources.catalog import read_tables
from voltframe.sources.sinks import write_releases

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explain_text(df, mode="formatted"):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    for name, df in fixture_tables(spark, SF).items():
        write_releases(df, f"{root}/{name}")
    return read_tables(spark, root, SURVEY_TABLES_USED)


def test_latest_uses_window_group_limit(spark, landed):
    df = V.biomass_generators_count(landed)
    df.collect()
    assert "WindowGroupLimit" in plan(df)


def test_latest_year_is_a_partition_filter(spark, landed):
    import re
    df = V.current_capacity_mix_by_fuel_type(landed, ordered=False)
    text = explain_text(df)
    # generator, solar and wind scans are all pruned to the newest release by the
    # scalar subquery on the partition column (computed once, then reused).
    hits = re.findall(r"PartitionFilters: \[[^\]]*file_year#\d+ = (?:Reused)?Subquery", text)
    assert len(hits) >= 3


def test_column_pruning_on_wide_tables(spark, landed):
    df = V.biomass_generators_count(landed)
    text = plan(df)
    assert "ReadSchema: struct<plant_code:bigint,generator_id:string,energy_source_1:string" in text
    assert "summer_capacity_mw" not in text


@pytest.mark.parametrize("name", list(V.VIEWS))
def test_no_cartesian_or_python_in_views(spark, landed, name):
    df = V.VIEWS[name](landed)
    text = plan(df) + optimized(df)
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in text, f"{name}: {bad}"


def test_geo_left_join_chain_adds_no_exchange(spark, landed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = V.capacity_by_tech_geo_year(landed)
        df._jdf.queryExecution().executedPlan()
        text = df._jdf.queryExecution().sparkPlan().toString()
        physical = df._jdf.queryExecution().executedPlan().toString()
        # Four aggregates shuffle once each (plus their partial stage); the joins add none.
        assert physical.count("SortMergeJoin") == 3
        assert text.count("HashAggregate") >= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_full_outer_on_coalesced_keys_is_one_aggregation(spark, landed):
    df = V.additions_vs_retirements_geo(landed)
    text = plan(df)
    assert "FullOuter" not in text and "NestedLoopJoin" not in text and "CartesianProduct" not in text
    # Retirements and both proposal rollups meet in one union below one final aggregation.
    assert "first(proposed_storage_mw_recent" in text
