"""Properties on seeded random frames."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from voltframe.functions.casting import measures_as_double
from voltframe.operators.latest import latest
from voltframe.plans import views as V
from tests.test_views import gen, tables

SEEDS = [1, 7, 42]


def random_generators(rng, n=150):
    rows = []
    for _ in range(n):
        plant = rng.randrange(25)
        rows.append(gen(plant, f"G{rng.randrange(3)}", rng.choice([2019, 2020, 2021, 2022]),
                        utility_id=rng.randrange(6), utility_name=f"U{rng.randrange(2)}",
                        state=rng.choice(["TX", "OK", None]), county=rng.choice(["A", "B"]),
                        energy_source_1=rng.choice(["NG", "SUN", "WND", "WDS", None]),
                        mw=rng.choice([None, rng.randrange(1, 500) / 4]),
                        retirement_year=rng.choice(["2019", "2020", "2021", "2022", "n/a", None]),
                        current_year=rng.choice([2019, 2020, 2021, 2022, 2023]),
                        file_date=None))
    for r in rows:  # file_date unique per (plant, generator, year) is not required, keep ties
        r.pop("file_date")
    return rows


@pytest.mark.parametrize("seed", SEEDS)
def test_latest_one_row_per_key_and_is_newest(spark, seed):
    rng = random.Random(seed)
    df = tables(spark, generator__operable=random_generators(rng))["generator.operable"]
    out = latest(df, ["plant_code", "generator_id"], tiebreak=[F.col("nameplate_capacity_mw").desc()])
    keys = out.groupBy("plant_code", "generator_id").count()
    assert keys.where("count > 1").count() == 0
    assert keys.count() == df.select("plant_code", "generator_id").distinct().count()
    newest = df.groupBy("plant_code", "generator_id").agg(F.max("file_year").alias("y"))
    joined = out.join(newest, ["plant_code", "generator_id"])
    assert joined.where(F.col("file_year") != F.col("y")).count() == 0


@pytest.mark.parametrize("seed", SEEDS)
def test_state_shares_total_100(spark, seed):
    rng = random.Random(seed)
    g = random_generators(rng)
    t = tables(spark, generator__operable=g)
    mix = measures_as_double(V.current_capacity_mix_by_fuel_type(t, ordered=False))
    for r in mix.groupBy("state").agg(F.sum("pct_of_state_capacity").alias("s"),
                                      F.sum("capacity_mw").alias("mw")).collect():
        if r.mw:
            assert abs(r.s - 100.0) <= 0.01 * 20


@pytest.mark.parametrize("seed", SEEDS)
def test_solar_never_exceeds_total_when_solar_is_a_subset(spark, seed):
    rng = random.Random(seed)
    g = random_generators(rng)
    solar = [dict(r) for r in g if r.get("energy_source_1") == "SUN"]
    t = tables(spark, generator__operable=g, solar__operable=solar)
    out = measures_as_double(V.capacity_by_tech_geo_year(t))
    assert out.where(F.col("solar_mw") > F.coalesce(F.col("total_mw"), F.lit(0.0)) + 1e-9).count() == 0


@pytest.mark.parametrize("seed", SEEDS)
def test_net_is_proposed_minus_retired(spark, seed):
    rng = random.Random(seed)
    g = random_generators(rng)
    t = tables(spark, generator__operable=g, generator__retired_and_canceled=g, generator__proposed=g,
               energystorage__proposed=[r for r in g if r.get("energy_source_1") == "WDS"])
    out = V.additions_vs_retirements_geo(t)
    bad = out.where(F.col("net_mw_change_recent") != F.col("proposed_total_mw_recent")
                    - F.col("retired_gen_mw_recent"))
    assert bad.count() == 0
    assert out.where(F.col("proposed_total_mw_recent") != F.col("proposed_gen_mw_recent")
                     + F.col("proposed_storage_mw_recent")).count() == 0


def test_decimal_sums_are_exact(spark):
    g = [gen(1, "A", 2022, mw=Decimal("0.1")), gen(2, "A", 2022, mw=Decimal("0.2"))]
    t = tables(spark, wind__operable=g)
    r = V.wind_solar_capacity_by_utility(t).first()
    assert r.wind_solar_capacity_mw == Decimal("0.300000")
