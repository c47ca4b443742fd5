"""Ingest round trips on files written to a fresh temporary folder."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.sources.delimited import (data_rows, load_report, read_extracts, read_records, rejected_rows,
                                         split_records, whole_records)
from voltframe.sources.ingest import add_lineage, conform, reject_counts
from voltframe.sources.releases import SURVEY_TABLE_MAP, check_year_range, is_data_file, select_years, table_names
from voltframe.sources.sinks import replace_years, write_metadata, write_releases

SCHEMA = T.StructType([
    T.StructField("utility_id", T.LongType()),
    T.StructField("utility_name", T.StringType()),
    T.StructField("nameplate_capacity_mw", T.DecimalType(18, 6)),
    T.StructField("multiple_fuels", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("file_year", T.IntegerType()),
    T.StructField("file_date", T.TimestampNTZType()),
    T.StructField("upload_timestamp", T.TimestampNTZType()),
])

RELEASE_1 = """Survey of power plants, release 2022, data as of December
Utility ID,Utility Name,Nameplate Capacity (MW),Multiple Fuels?,Retired Column
1,"Alpha, Inc.",10.5,Y,old
2,Beta,20,N,old
3,Gamma,n/a,X,old
NOTE: totals exclude confidential plants
"""
RELEASE_2 = """Survey of power plants, release 2023
Utility ID,Utility Name,Nameplate Capacity (MW),Status
1,Alpha,11,OP
4,Delta,7.25,SB
"""


@pytest.fixture
def landing(tmp_path):
    for year, text in (("2022", RELEASE_1), ("2023", RELEASE_2)):
        d = tmp_path / "landing" / year
        d.mkdir(parents=True)
        (d / f"3_1_Generator_Y{year}.csv").write_text(text)
        (d / "~lock.csv").write_text("x")
        (d / "EIA-860 Form.csv").write_text("x")
    return tmp_path


def test_year_range_check():
    check_year_range(2020, 2020)
    with pytest.raises(ValueError):
        check_year_range(2021, 2020)


def test_file_filter(spark):
    names = ["3_1_Generator_Y2023.xlsx", "~$3_1_Generator_Y2023.xlsx", "EIA-860 Form.xlsx",
             "LayoutY2023.xlsx", "readme.txt"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    kept = [r.file_name for r in df.where(is_data_file("file_name")).collect()]
    assert kept == ["3_1_Generator_Y2023.xlsx"]


def test_routing_by_name_equals_the_known_map(spark):
    books = {"energystorage": "3_4_Energy_Storage_Y2023.xlsx", "enviroassoc": "6_1_EnviroAssoc_Y2023.xlsx"}
    rows = [(books.get(topic, f"3_1_{topic.title()}_Y2023.xlsx"), sheet, table)
            for topic, sheets in SURVEY_TABLE_MAP.items() for sheet, table in sheets.items()]
    df = spark.createDataFrame(rows, "workbook string, sheet string, want string")
    assert df.count() == 30 and table_names(df).where("table_name <> want").count() == 0


def test_delimited_read_keeps_every_record(spark, landing):
    paths = sorted(str(p) for p in (landing / "landing").rglob("3_1_*.csv"))
    groups = read_extracts(spark, paths)
    assert len(groups) == 2  # two distinct headers -> two scans
    rows = sorted((r.file_year, r.utility_id) for g in groups for r in data_rows(g).collect())
    assert rows == [(2022, "1"), (2022, "2"), (2022, "3"), (2023, "1"), (2023, "4")]
    rejects = [(r.file_year, r.record) for g in groups for r in rejected_rows(g).collect()]
    assert rejects == [(2022, "NOTE: totals exclude confidential plants")]


LOSSLESS = {
    "doubled quotes": ('1,"Smith ""Big"" Plant, Inc",10\n', [("1", 'Smith "Big" Plant, Inc', "10")], 0),
    "line break": ('1,"two\nlines",10\n2,b,11\n', [("1", "two\nlines", "10"), ("2", "b", "11")], 0),
    "text and empty id": ('A7,a,10\n,b,11\n', [("A7", "a", "10"), (None, "b", "11")], 0),
    "decimal id": ("3.0,a,10\n", [("3.0", "a", "10")], 0),
    "surplus field": ("1,a,10,x\n2,b,11\n", [("2", "b", "11")], 1),
    "missing field": ("1,a\r\n2,b,11\r\n", [("2", "b", "11")], 1),
    "no rows": ("", [], 0),
}


@pytest.mark.parametrize("case", sorted(LOSSLESS))
def test_lossless(spark, tmp_path, case):
    body, want, rejected = LOSSLESS[case]
    folder = tmp_path / "2022"
    folder.mkdir()
    path = folder / "x.csv"
    path.write_text('Title, with commas\n"Utility\nID",Utility Name,"Plant Code"\n' + body, newline="")
    (group,) = read_extracts(spark, [str(path)])
    got = sorted(((r.utility_id, r.utility_name, r.plant_code) for r in data_rows(group).collect()), key=str)
    assert got == sorted(want, key=str)
    report = [(r.rows_read, r.rows_loaded, r.rows_rejected) for r in load_report([group]).collect()]
    assert report == ([(len(want) + rejected, len(want), rejected)] if want or rejected else [])


def test_reject_counts(spark):
    df = spark.createDataFrame([("1", "10.5"), ("x", "n/a"), (None, "3")],
                               "utility_id string, nameplate_capacity_mw string")
    got = {r.column: r.rejected for r in reject_counts(df, "t", SCHEMA).collect()}
    assert got == {"utility_id": 1, "nameplate_capacity_mw": 1}


def test_replace_years_semantics(spark):
    existing = spark.createDataFrame([(2021, "a"), (2022, "b"), (2022, "c")], "file_year int, v string")
    incoming = spark.createDataFrame([(2022, "B"), (2023, "D")], "file_year int, v string")
    got = sorted(tuple(r) for r in replace_years(existing, incoming).collect())
    assert got == [(2021, "a"), (2022, "B"), (2023, "D")]
    twice = replace_years(replace_years(existing, incoming), incoming)
    assert sorted(tuple(r) for r in twice.collect()) == got
    by_range = replace_years(existing, incoming, years=range(2022, 2024))
    assert sorted(tuple(r) for r in by_range.collect()) == got
    # A requested year without data keeps its rows, and so do rows without a year.
    only_2023 = replace_years(existing, incoming.where("file_year = 2023"), years=range(2022, 2024))
    assert sorted(tuple(r) for r in only_2023.collect()) == [(2021, "a"), (2022, "b"), (2022, "c"), (2023, "D")]
    no_year = spark.createDataFrame([(None, "n")], "file_year int, v string")
    assert replace_years(no_year, incoming).where("v = 'n'").count() == 1


def test_write_releases_replaces_only_given_years(spark, tmp_path):
    target = str(tmp_path / "t")
    write_releases(spark.createDataFrame([(2021, "a"), (2022, "b")], "file_year int, v string"), target)
    write_releases(spark.createDataFrame([(2022, "B")], "file_year int, v string"), target)
    write_releases(spark.createDataFrame([(2022, "B")], "file_year int, v string"), target)
    got = sorted((r.file_year, r.v) for r in spark.read.parquet(target).collect())
    assert got == [(2021, "a"), (2022, "B")]
    assert select_years(spark.read.parquet(target), 2022, 2022).count() == 1


def test_lineage_columns(spark):
    df = spark.createDataFrame([(1,)], "x int")
    out = add_lineage(df, file_year=2024, file_date=F.lit(dt.datetime(2024, 5, 1)))
    r = out.first()
    assert (r.file_year, r.file_date) == (2024, dt.datetime(2024, 5, 1))
    assert dict(out.dtypes)["upload_timestamp"] == "timestamp_ntz"


def test_metadata_sink(spark, tmp_path):
    df = spark.createDataFrame([("t", [2023, 2024])], "table_name string, years array<int>")
    write_metadata(df, str(tmp_path / "table_years"))
    assert spark.read.json(str(tmp_path / "table_years")).first().years == [2023, 2024]


def test_arrow_hand_over(spark):
    import pyarrow as pa
    from voltframe.sources.arrow import from_arrow
    from voltframe.sources.ingest import rename_columns
    table = pa.table({"Utility ID": [1, 2], "Nameplate Capacity (MW)": [1.5, None]})
    df = rename_columns(from_arrow(spark, table))
    assert df.columns == ["utility_id", "nameplate_capacity_mw"]
    out = conform(df.withColumn("file_year", F.lit(2024)), "t", SCHEMA)
    got = sorted((r.utility_id, r.nameplate_capacity_mw) for r in out.collect())
    assert got == [(1, Decimal("1.500000")), (2, None)]


PIECES = ['a', 'b,c', '"x"', '"', '""', '\n', '\r\n', '\n\n', ',', '"two\nlines"', 'é', ' ']


@pytest.mark.parametrize("seed", range(6))
def test_splits_give_the_records_of_the_whole_file(spark, tmp_path, seed):
    """Random text, quotes open or closed anywhere, splits of a few bytes."""
    import random
    rng = random.Random(seed)
    paths = []
    for k in range(3):
        path = tmp_path / f"{k}.csv"
        path.write_text("﻿" * (k % 2) + "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 5, 400]))),
                        newline="")
        paths.append(str(path))
    want = sorted((r.path, r.position, r.record) for r in whole_records(spark, paths).collect())
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.set(f"spark.sql.files.{key}", "50")
    try:
        got = split_records(spark, paths)
        assert sorted((r.path, r.position, r.record) for r in got.collect()) == want
        head = sorted((r.path, r.position, r.record) for r in read_records(spark, paths, set(paths), head=True)
                      .where("position < 2").collect())
        assert head == [w for w in want if w[1] < 2]
    finally:
        for key in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.unset(f"spark.sql.files.{key}")
    assert sorted((r.path, r.position, r.record) for r in whole_records(spark, paths, head=True).collect()) == head


def test_large_extracts_use_many_tasks(spark, tmp_path):
    folder = tmp_path / "2022"
    folder.mkdir()
    path = folder / "x.csv"
    rows = "".join(f'{k},"line one\nline two of {k}",{k % 7}\n' for k in range(20_000))
    path.write_text('Title\n"Utility\nID",Utility Name,"Plant Code"\n' + rows + "footnote\n", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        (small,) = read_extracts(spark, [str(path)])
        (large,) = read_extracts(spark, [str(path)], whole_bytes=1000)
        key = lambda df: sorted(map(str, data_rows(df).collect()))
        assert key(small) == key(large) and len(key(large)) == 20_000
        assert [r.record for r in rejected_rows(large).collect()] == ["footnote"]
        scan = spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions()
        assert scan >= 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_bare_carriage_return_in_a_split_file_is_an_error(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('t\nh\n"in\rside",2\n', newline="")
    assert [r.record for r in split_records(spark, [str(path)]).where("position = 2").collect()] == ['"in\rside",2']
    path.write_text("t\nh\na,1\rb,2\n", newline="")
    with pytest.raises(Exception, match="carriage return outside quotes"):
        split_records(spark, [str(path)]).collect()
