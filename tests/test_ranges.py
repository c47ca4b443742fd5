"""Positions, lags, shares and outer joins that split a hot group, against windows and joins on random frames."""

import random
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voltframe.operators.change import change_along_order, change_from_previous
from voltframe.operators.joins import full_outer_coalesced
from voltframe.operators.ordering import AT, asc, desc, numbered, positions
from voltframe.operators.share import share_of_group, share_of_large_group

SCHEMA = "g string, h int, k int, v decimal(12,2)"


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Rows as few as these would be merged into one range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def frame(spark, seed, n=2000):
    """A third of the rows and more have one key; NULL keys and values; k has no ties."""
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "b", None, str(rng.randrange(50))]), rng.choice([None, 1, 1, 2]), k,
             rng.choice([None, Decimal(rng.randrange(-500, 500)) / 4])) for k in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_positions_equal_row_number(spark, seed):
    df = frame(spark, seed)
    w = Window.partitionBy("g", "h").orderBy(desc("v"), asc("k"))
    want = df.withColumn("position", F.row_number().over(w).cast("bigint"))
    assert rows(positions(df, ["g", "h"], "-v", "k")) == rows(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_change_along_order_equals_lag(spark, seed):
    df = frame(spark, seed)
    want = change_from_previous(df, "v", ["g"], [asc("h"), asc("k")], "d")
    assert rows(change_along_order(df, "v", ["g"], "h", "k", name="d")) == rows(want)


def test_a_hot_key_spans_ranges(spark):
    out = numbered(frame(spark, 3), ["g"], "k").where("g = 'hot'").groupBy(F.shiftright(AT, 33).alias("r")).count()
    sizes = [r["count"] for r in out.collect()]
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_no_window_by_group_over_rows(spark):
    plan = positions(frame(spark, 3), ["g"], "k")._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 1 and "_rows" in windows[0]  # over the totals by range only


def test_empty_frames(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert positions(df, ["g"], "k").collect() == []
    assert change_along_order(df, "v", ["g"], "k", name="d").collect() == []
    assert share_of_large_group(df, "v", ["g"], "s").collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_share_equals_window(spark, seed):
    df = frame(spark, seed)
    got = share_of_large_group(df, "v", ["g", "h"], "s")
    assert rows(got) == rows(share_of_group(df, "v", ["g", "h"], "s"))
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def chain(frames, keys):
    """The joins as written: each next frame on the coalesced keys of those before."""
    acc, key = None, None
    for i, df in enumerate(frames):
        own = df.select(*[F.col(k).alias(f"_{i}_{k}") for k in keys], *[c for c in df.columns if c not in keys])
        if acc is None:
            acc, key = own, {k: F.col(f"_0_{k}") for k in keys}
            continue
        acc = acc.join(own, reduce(lambda a, b: a & b, [key[k] == F.col(f"_{i}_{k}") for k in keys]), "full_outer")
        key = {k: F.coalesce(key[k], F.col(f"_{i}_{k}")) for k in keys}
    return acc.select(*[key[k].alias(k) for k in keys], *[c for c in acc.columns if not c.startswith("_")])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_outer_join_equals_chain_with_null_keys(spark, seed):
    rng = random.Random(seed)
    frames = []
    for name in ("x", "y", "z"):
        keys = {(rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, 1, 2])) for _ in range(9)}
        frames.append(spark.createDataFrame([(*k, rng.choice([None, 1.5, 2.5]), "t") for k in sorted(keys, key=str)],
                                            f"state string, county int, {name} double, {name}_text string"))
    got = full_outer_coalesced(frames, ["state", "county"])
    assert rows(got) == rows(chain(frames, ["state", "county"]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1


def test_outer_join_rejects_shared_value_names(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="share names"):
        full_outer_coalesced([df, df], ["k"])
