"""ROUND as NUMERIC computes it."""

from pyspark.sql import functions as F

from voltframe.functions.casting import percent

TIES = [(23, 160, 14.38), (1, 800, 0.13), (3, 800, 0.38), (-23, 160, -14.38), (1, 3, 33.33), (2, 3, 66.67),
        (0, 5, 0.0), (5, 0, None), (None, 5, None), (7, 7, 100.0), (41, 160, 25.63), (43, 160, 26.88)]


def test_exact_ties_round_away_from_zero(spark):
    df = spark.createDataFrame([(n, d, w) for n, d, w in TIES], "n bigint, d bigint, want double")
    got = df.select(percent(F.col("n"), F.col("d")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_decimal_measures(spark):
    df = spark.createDataFrame([("0.000115", "0.0008"), ("14.375", "100")], "n string, d string")
    got = df.select(percent(F.col("n").cast("decimal(18,6)"), F.col("d").cast("decimal(18,6)")).alias("p"))
    assert [r.p for r in got.collect()] == [14.38, 14.38]
