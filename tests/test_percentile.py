"""Exact percentile guided by a summary, against Spark's single-task percentile."""

import random

import pytest
from pyspark.sql import functions as F

from voltframe.operators.percentile import MARGIN, exact_percentile, percentile_band


def frame(spark, seed, n=600):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        g = rng.choice(["a", "a", "a", "b", "c", None])  # 'a' is the hot group
        v = rng.choice([None, round(rng.lognormvariate(3, 2), 2), 7.0, rng.randrange(5) * 1e6])
        rows.append((g, v))
    rows.append(("nulls", None))
    rows.append(("single", 4.5))
    return spark.createDataFrame(rows, "g string, v double")


def check(df, p, accuracy):
    want = {r.g: r.x for r in df.groupBy("g").agg(F.percentile("v", p).alias("x")).collect()}
    rows = exact_percentile(df, ["g"], "v", p, "x", accuracy=accuracy).collect()
    got = {r.g: r.x for r in rows}
    assert len(rows) == len(got) and set(got) == set(want)
    for g in want:
        if want[g] is None:
            assert got[g] is None
        else:
            assert got[g] == pytest.approx(want[g], rel=1e-12, abs=1e-12), g


@pytest.mark.parametrize("seed", [3, 11])
@pytest.mark.parametrize("p", [0.5, 0.1, 0.9, 0.0, 1.0])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_matches_builtin(spark, seed, p, accuracy):
    check(frame(spark, seed), p, accuracy)


def heavy(spark, n=200_000):
    """One hot year with a heavy tail (values over 20 orders of magnitude, all distinct), two small ones."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "b").otherwise("c").alias("g"),
        F.exp((F.abs(F.xxhash64("id")) % 1_000_003) / 1_000_003.0 * 46 - 23).alias("v"))


@pytest.mark.parametrize("p", [0.5, 0.99])
def test_band_is_bounded_for_a_heavy_tail(spark, p):
    df, accuracy = heavy(spark), 1000
    check(df, p, accuracy)
    for r in percentile_band(df, ["g"], "v", p, accuracy).groupBy("g").agg(
            F.count(F.lit(1)).alias("rows"), F.max("_n").alias("n")).collect():
        assert r.rows <= max(accuracy, 2 * (MARGIN + 1) * r.n / accuracy) + 2, r


def test_plan_reads_the_input_twice(spark, tmp_path):
    heavy(spark, 1000).write.parquet(str(tmp_path / "t"))
    out = exact_percentile(spark.read.parquet(str(tmp_path / "t")), ["g"], "v", 0.5, "x")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 3 and plan.count("Join") <= 1


def test_building_runs_no_job_and_follows_the_data(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1.0)], "g string, v double").write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("percentile_rows")
    exact_percentile(spark.table("percentile_rows"), ["g"], "v", 0.5, "x").createOrReplaceTempView("percentile_of_rows")
    assert spark.table("percentile_of_rows").collect() == [("a", 1.0)]
