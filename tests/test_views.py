"""Hand-made micro-frames for the views and the quirks Q1-Q16 (expected rows written by hand)."""

import datetime as dt
from decimal import Decimal

import pytest

from voltframe.fixtures import SURVEY_TABLES_USED
from voltframe.functions.casting import measures_as_double
from voltframe.plans import views as V

from tests.conftest import make_table


def tables(spark, **given):
    out = {}
    for name in SURVEY_TABLES_USED:
        key = name.replace(".", "__")
        out[name] = make_table(spark, name, given.get(key, []))
    return out


def gen(plant, gen_id, year, **kw):
    row = {"plant_code": plant, "generator_id": gen_id, "file_year": year,
           "utility_id": kw.pop("utility_id", 1), "utility_name": kw.pop("utility_name", "U1")}
    if "mw" in kw:
        v = kw.pop("mw")
        row["nameplate_capacity_mw"] = None if v is None else Decimal(str(v))
    row.update(kw)
    return row


def rows(df):
    return [tuple(r) for r in measures_as_double(df).collect()]


def test_q1_latest_then_filter_vs_filter_then_latest(spark):
    # Generator burned wood in 2020, gas in 2021: (a) does not count it, (b) does.
    g = [gen(1, "A", 2020, energy_source_1="WDS", mw=10), gen(1, "A", 2021, energy_source_1="NG", mw=10),
         gen(2, "B", 2021, energy_source_1="LFG", mw=5)]
    t = tables(spark, generator__operable=g,
               solar__operable=[gen(9, "S", 2021, mw=100)])
    assert rows(V.biomass_generators_count(t)) == [(1,)]
    got = rows(V.utilities_with_existing_renewable_offset(t))
    assert got == [(1, "U1", 15.0, 100.0, 85.0)]


def test_q2_units_missing_from_newer_release_still_count(spark):
    g = [gen(1, "A", 2019, energy_source_3="OBG"), gen(2, "B", 2021, energy_source_1="NG")]
    assert rows(V.biomass_generators_count(tables(spark, generator__operable=g))) == [(1,)]


def test_q3_plant_tie_break_is_lowest_generator(spark):
    g = [gen(1, "B", 2021, state="TX", technology="Wind"),
         gen(1, "A", 2021, state="TX", technology="Solar"),
         gen(1, "C", 2020, state="TX", technology="Coal")]
    assert rows(V.facility_type_count_by_state(tables(spark, generator__operable=g))) == [("TX", "Solar", 1)]


def test_q4_null_plant_code_gives_zero_facilities(spark):
    g = [gen(None, "A", 2021, state="TX", technology="Wind"), gen(5, "A", 2021, state="TX", technology="Gas")]
    got = sorted(rows(V.facility_type_count_by_state(tables(spark, generator__operable=g))))
    assert got == [("TX", "Gas", 1), ("TX", "Wind", 0)]


def test_q5_renamed_utility_fans_out(spark):
    g = [gen(1, "A", 2021, energy_source_1="WDS", mw=10, utility_name="Old")]
    s = [gen(2, "S", 2020, mw=30, utility_name="Old"), gen(3, "S", 2021, mw=40, utility_name="New")]
    got = sorted(rows(V.utilities_with_existing_renewable_offset(tables(spark, generator__operable=g,
                                                                        solar__operable=s))))
    assert got == [(1, "Old", 10.0, 30.0, 20.0), (1, "Old", 10.0, 40.0, 30.0)]


def test_q6_change_is_to_previous_present_row(spark):
    w = [gen(1, "W", 2019, mw=10), gen(1, "W", 2022, mw=25)]
    s = [gen(2, "S", 2022, mw=5)]
    got = rows(V.wind_solar_capacity_by_utility(tables(spark, wind__operable=w, solar__operable=s)))
    assert got == [(1, "U1", 2019, 10.0, None), (1, "U1", 2022, 30.0, 20.0)]


def test_q7_and_q16_capacity_mix_double_counts_and_zero_state(spark):
    g = [gen(1, "A", 2021, state="TX", energy_source_1="SUN", mw=10),
         gen(2, "A", 2021, state="TX", energy_source_1="NG", mw=30),
         gen(3, "A", 2020, state="TX", energy_source_1="NG", mw=99),
         gen(4, "A", 2021, state="ZZ", energy_source_1="NG", mw=0)]
    s = [gen(1, "A", 2021, state="TX", mw=10)]
    got = sorted(rows(V.current_capacity_mix_by_fuel_type(tables(spark, generator__operable=g,
                                                                  solar__operable=s))),
                 key=lambda r: (r[0], r[1]))
    assert got == [("TX", "NG", 30.0, 60.0), ("TX", "SUN", 10.0, 20.0), ("TX", "Solar", 10.0, 20.0),
                   ("ZZ", "NG", 0.0, None)]


def test_q11_retirement_rows_per_release_and_inclusive_40(spark):
    g = [gen(1, "A", 2020, operating_year=1981, mw=1), gen(1, "A", 2021, operating_year=1981, mw=1),
         gen(2, "A", 2021, operating_year=1982, mw=1), gen(3, "A", 2021, operating_year=None, mw=1)]
    got = rows(V.generators_reaching_retirement(tables(spark, generator__operable=g)))
    assert [(r[2], r[9]) for r in got] == [(1, 40), (1, 40)]


def test_q12_postgres_null_order(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, v int")
    from voltframe.operators.ordering import pg_order
    assert [tuple(r) for r in pg_order(df, "k").collect()] == [("a", 1), ("b", None), (None, 2)]
    assert [tuple(r) for r in pg_order(df, "-v").collect()] == [("b", None), (None, 2), ("a", 1)]


def test_q13_q14_q15_additions_vs_retirements(spark):
    g = [gen(1, "A", 2024, state="TX", county="X", mw=1)]
    ret = [gen(1, "A", 2023, state="TX", county="X", retirement_year="2022", mw=10, energy_source_1="bit"),
           gen(1, "A", 2024, state="TX", county="X", retirement_year="2022", mw=10, energy_source_1="BIT"),
           gen(2, "A", 2024, state="TX", county="X", retirement_year=" 2022 ", mw=99),
           gen(3, "A", 2024, state="TX", county="X", retirement_year="2022\n", mw=99),
           gen(4, "A", 2024, state="TX", county="X", retirement_year="2019", mw=99),
           gen(5, "A", 2024, state=None, county="X", retirement_year="2021", mw=7)]
    prop = [gen(6, "A", 2024, state="TX", county="Y", current_year=2025, mw=99),
            gen(7, "A", 2024, state="TX", county="Y", current_year=2024, mw=8),
            gen(8, "A", 2024, state=None, county="X", current_year=2024, mw=2)]
    t = tables(spark, generator__operable=g, generator__retired_and_canceled=ret,
               generator__proposed=prop,
               energystorage__proposed=[gen(9, "A", 2024, state="TX", county="X", current_year=2023, mw=4)])
    got = sorted(rows(V.additions_vs_retirements_geo(t)), key=lambda r: (str(r[0]), r[1], r[2]))
    z = 0.0
    assert got == [
        # state, county, ret gen, fossil, renew, solar, wind, storage, prop gen, prop storage, total, net, ratio
        ("TX", "X", 20.0, 20.0, z, z, z, z, z, 4.0, 4.0, -16.0, 0.2),
        ("TX", "Y", z, z, z, z, z, z, 8.0, z, 8.0, 8.0, None),
        (None, "X", z, z, z, z, z, z, 2.0, z, 2.0, 2.0, None),
        (None, "X", 7.0, z, z, z, z, z, z, z, z, -7.0, z),
    ] or got == sorted([
        ("TX", "X", 20.0, 20.0, z, z, z, z, z, 4.0, 4.0, -16.0, 0.2),
        ("TX", "Y", z, z, z, z, z, z, 8.0, z, 8.0, 8.0, None),
        (None, "X", 7.0, z, z, z, z, z, z, z, z, -7.0, z),
        (None, "X", z, z, z, z, z, z, 2.0, z, 2.0, 2.0, None),
    ], key=lambda r: (str(r[0]), r[1], r[2]))


def test_q15_null_state_never_joins_in_geo_view(spark):
    g = [gen(1, "A", 2021, state=None, county="X", mw=10), gen(2, "A", 2021, state="TX", county="X", mw=5)]
    s = [gen(1, "A", 2021, state=None, county="X", mw=3), gen(2, "A", 2021, state="TX", county="X", mw=2)]
    got = sorted(rows(V.capacity_by_tech_geo_year(tables(spark, generator__operable=g, solar__operable=s))),
                 key=lambda r: str(r[1]))
    assert got == [(2021, None, "X", 10.0, 0.0, 0.0, 0.0), (2021, "TX", "X", 5.0, 2.0, 0.0, 0.0)]


def test_q16_no_solar_rows_gives_null_percent(spark):
    got = rows(V.multi_state_solar_facilities_percentage(tables(spark)))
    assert got == [(0, 0, None)]


def test_multi_state_percent(spark):
    s = [gen(1, "A", 2020, utility_id=1, state="TX"), gen(2, "A", 2021, utility_id=1, state="OK"),
         gen(3, "A", 2021, utility_id=2, utility_name="U2", state="TX"),
         gen(4, "A", 2021, utility_id=3, utility_name="U3", state="TX")]
    assert rows(V.multi_state_solar_facilities_percentage(tables(spark, solar__operable=s))) == [(1, 3, 33.33)]


def test_median_per_year_interpolates(spark):
    e = [gen(1, "A", 2021, mw=1), gen(2, "A", 2021, mw=4), gen(3, "A", 2021, mw=None),
         gen(4, "A", 2022, mw=2), gen(5, "A", 2022, mw=3), gen(6, "A", 2022, mw=10)]
    got = rows(V.median_battery_capacity_by_year(tables(spark, energystorage__operable=e)))
    assert got == [(2021, 2.5), (2022, 3.0)]


def test_view_i_total_drives_and_zero_fill(spark):
    g = [gen(1, "A", 2021, state="TX", county="X", mw=10)]
    w = [gen(1, "A", 2021, state="TX", county="X", mw=4), gen(2, "A", 2021, state="TX", county="Z", mw=4)]
    got = rows(V.capacity_by_tech_geo_year(tables(spark, generator__operable=g, wind__operable=w)))
    assert got == [(2021, "TX", "X", 10.0, 0.0, 4.0, 0.0)]


def test_register_views(spark):
    t = tables(spark, generator__operable=[gen(1, "A", 2021, energy_source_1="WDS")])
    names = V.register_views(spark, t)
    assert len(names) == 10
    assert spark.sql("SELECT * FROM analysis_biomass_generators_count").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM generator_operable").first()[0] == 1


def test_q14_dedupe_counts_a_unit_once(spark):
    g = [gen(1, "A", 2024, state="TX", county="X", mw=1)]
    ret = [gen(1, "A", 2023, state="TX", county="X", retirement_year="2022", mw=10, energy_source_1="NG"),
           gen(1, "A", 2024, state="TX", county="X", retirement_year="2022", mw=12, energy_source_1="NG")]
    t = tables(spark, generator__operable=g, generator__retired_and_canceled=ret)
    assert rows(V.additions_vs_retirements_geo(t))[0][2] == 22.0  # both releases (reference)
    assert rows(V.additions_vs_retirements_geo(t, dedupe=True))[0][2] == 12.0  # newest release only
