"""End-to-end: landing folder of yearly sheet extracts -> derived schemas and loaded tables."""

import pytest
from pyspark.sql import functions as F

from voltframe.fixtures import fixture_tables as read_all
from voltframe.jobs import derive_schemas, load_raw, sheet_listing
from voltframe.plans.views import register_warehouse
from voltframe.sources.sinks import write_releases, write_tables

GEN_2022 = """Page 1 of the generator workbook
Utility ID,Utility Name,Plant Code,Generator ID,Nameplate Capacity (MW),Operating Year,Energy Source 1
1,Alpha,10,G1,10.5,1980,NG
2,Beta,11,G2,20,1975,WDS
5,Epsilon,14,G3,7.25,1960,NG
NOTE: footnote
"""
GEN_2023 = """Page 1 of the generator workbook
Utility ID,Utility Name,Plant Code,Generator ID,Nameplate Capacity (MW),Operating Year
1,Alpha,10,G1,11,1980
3,Gamma,12,G2,5,1990
4,Delta,13,G3,6,1991
"""
UTIL_2023 = """Utility listing
Utility ID,Utility Name,Entity Type
1,Alpha,I
3,Gamma,C
4,Delta,I
"""


def landing_folder(tmp_path):
    root = tmp_path / "landing"
    files = {
        ("2022", "3_1_Generator_Y2022.xlsx", "Operable"): GEN_2022,
        ("2023", "3_1_Generator_Y2023.xlsx", "Operable"): GEN_2023,
        ("2023", "1___Utility_Y2023.xlsx", "Utility"): UTIL_2023,
        ("2023", "LayoutY2023.xlsx", "Layout"): "x\ny\n",
        ("2023", "3_1_Generator_Y2023.xlsx", "proposed"): "t\nUtility ID,Plant Code\n",  # lower case, no rows
        ("2021", "3_1_Generator_Y2021.xlsx", "Operable"): GEN_2022,
    }
    for (year, book, sheet), text in files.items():
        d = root / year / book
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{sheet}.csv").write_text(text)
    return str(root)


def test_listing_routes_and_filters(spark, tmp_path):
    landing = landing_folder(tmp_path)
    got = sorted((r.file_year, r.topic, r.sheet, r.table_name)
                 for r in sheet_listing(spark, landing, 2022, 2023).collect())
    assert got == [(2022, "generator", "Operable", "generator.operable"),
                   (2023, "generator", "Operable", "generator.operable"),
                   (2023, "generator", "proposed", "generator.proposed"),
                   (2023, "utility", "Utility", "utility.utility")]


def test_derive_schemas(spark, tmp_path):
    landing = landing_folder(tmp_path)
    out = str(tmp_path / "meta")
    derive_schemas(spark, landing, out, 2022, 2023)
    years = {r.table_name: r.years for r in spark.read.json(f"{out}/table_years").collect()}
    assert years == {"generator.operable": [2022, 2023], "generator.proposed": [2023], "utility.utility": [2023]}
    missing = {r.table_name: r.missing_years for r in spark.read.json(f"{out}/missing_years").collect()}
    assert missing == {"generator.proposed": [2022], "utility.utility": [2022]}
    types = {(r.table_name, r.column_name): r.sql_type
             for r in spark.read.json(f"{out}/table_schemas").collect()}
    assert types[("generator.operable", "plant_code")] == "BIGINT"
    assert types[("generator.operable", "nameplate_capacity_mw")] == "VARCHAR"  # Float64 + Int64 (Q17)
    assert types[("generator.operable", "energy_source_1")] == "BOOLEAN"  # two values (Q8)
    assert types[("utility.utility", "entity_type")] == "BOOLEAN"
    assert types[("generator.proposed", "plant_code")] == "VARCHAR"  # an extract without rows keeps its columns
    ddl = {r.table_name: r.ddl for r in spark.read.json(f"{out}/table_ddls").collect()}
    assert ddl["utility.utility"].startswith("CREATE TABLE utility.utility(\n\tutility_id BIGINT PRIMARY KEY,")
    assert ddl["generator.operable"].count("PRIMARY KEY") == 1
    text = "\n".join(r.value for r in spark.read.text(f"{out}/table_ddls.sql").collect())
    assert text.startswith("CREATE SCHEMA generator;\nCREATE SCHEMA utility;\nCREATE TABLE generator.operable(")


def test_load_raw(spark, tmp_path):
    landing = landing_folder(tmp_path)
    wh = str(tmp_path / "wh")
    tables = ["generator.operable", "generator.proposed", "utility.utility"]
    assert load_raw(spark, landing, wh, 2022, 2023) == tables
    report = spark.read.json(f"{wh}/_load/report").collect()
    assert sorted((r.file_year, r.rows_read, r.rows_loaded, r.rows_rejected) for r in report) == [
        (2022, 4, 3, 1), (2023, 3, 3, 0), (2023, 3, 3, 0)]
    assert [r.record for r in spark.read.json(f"{wh}/_load/rejects").collect()] == ["NOTE: footnote"]
    load_raw(spark, landing, wh, 2023, 2023)  # reload one year: no duplicates
    g = spark.read.parquet(f"{wh}/generator.operable")
    got = sorted((r.file_year, r.plant_code, r.generator_id, float(r.nameplate_capacity_mw), r.energy_source_1)
                 for r in g.collect())
    assert got == [(2022, 10, "G1", 10.5, "NG"), (2022, 11, "G2", 20.0, "WDS"), (2022, 14, "G3", 7.25, "NG"),
                   (2023, 10, "G1", 11.0, None), (2023, 12, "G2", 5.0, None), (2023, 13, "G3", 6.0, None)]
    assert len(g.columns) == 76
    u = spark.read.parquet(f"{wh}/utility.utility")
    assert sorted((r.file_year, r.utility_id, r.entity_type) for r in u.collect()) == [
        (2023, 1, "I"), (2023, 3, "C"), (2023, 4, "I")]


def test_unknown_sheet_is_an_error_until_its_schema_is_derived(spark, tmp_path):
    landing = landing_folder(tmp_path)
    folder = tmp_path / "landing" / "2023" / "9_9_Novel_Y2023.xlsx"
    folder.mkdir()
    (folder / "New Sheet.csv").write_text("t\nCode,Size\n1D,5\n2F,6\nNaN,7\n")
    with pytest.raises(ValueError, match="novel.new_sheet"):
        load_raw(spark, landing, str(tmp_path / "wh"), 2023, 2023)
    meta, wh = str(tmp_path / "meta"), str(tmp_path / "wh2")
    derive_schemas(spark, landing, meta, 2023, 2023)
    assert "novel.new_sheet" in load_raw(spark, landing, wh, 2023, 2023, schemas=meta)
    got = sorted((r.code, r["size"]) for r in spark.read.parquet(f"{wh}/novel.new_sheet").collect())
    assert got == [("1D", 5), ("2F", 6), ("NaN", 7)]


def test_views_answer_from_reloaded_data(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    wh = str(tmp_path / "wh")
    write_tables(read_all(spark, sf), wh)
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    register_warehouse(spark, wh)
    assert jobs() == before  # registering runs no job
    storage = spark.read.parquet(f"{wh}/energystorage.operable")
    year = storage.agg({"file_year": "max"}).first()[0]
    one = storage.where(storage.file_year == year).limit(1).withColumn("nameplate_capacity_mw", F.lit(1).cast("decimal(18,6)"))
    write_releases(spark.createDataFrame(one.collect(), one.schema),
                   f"{wh}/energystorage.operable")
    register_warehouse(spark, wh)
    got = spark.sql(f"SELECT median_battery_mw FROM analysis_median_battery_capacity_by_year WHERE file_year = {year}")
    assert [r[0] for r in got.collect()] == [1.0]
    storage_mw = spark.sql(f"SELECT sum(storage_mw) FROM analysis_capacity_by_tech_geo_year WHERE file_year = {year}")
    assert float(storage_mw.first()[0]) in (0.0, 1.0)


def test_load_reads_the_extracts_once_for_rows(spark, tmp_path, monkeypatch):
    """Without rejects and failed casts nothing is parsed a second time; with them, only the files concerned."""
    from voltframe import jobs
    seen = []
    real = jobs.read_group
    monkeypatch.setattr(jobs, "read_group", lambda s, names, paths, large: seen.append(len(paths)) or real(s, names, paths, large))
    landing = landing_folder(tmp_path)
    load_raw(spark, landing, str(tmp_path / "wh"), 2023, 2023)
    assert seen == [1, 1, 1]
    seen.clear()
    load_raw(spark, landing, str(tmp_path / "wh"), 2022, 2023)
    assert sorted(seen) == [1] * 5  # four files, and the one with a footnote again


def test_failed_casts_and_wrong_counts(spark, tmp_path, monkeypatch):
    from voltframe import jobs
    landing = landing_folder(tmp_path)
    bad = tmp_path / "landing" / "2023" / "3_1_Generator_Y2023.xlsx" / "Operable.csv"
    bad.write_text(GEN_2023.replace("5,1990", "five,1990"))
    wh = str(tmp_path / "wh")
    load_raw(spark, landing, wh, 2022, 2023)
    casts = [(r.table_name, r.file_year, r.column, r.rejected) for r in spark.read.json(f"{wh}/_load/casts").collect()]
    assert casts == [("generator.operable", 2023, "nameplate_capacity_mw", 1)]
    want = sorted(map(str, spark.read.json(f"{wh}/_load/report").collect()))
    report = jobs.Watch.report
    monkeypatch.setattr(jobs.Watch, "report", lambda self: [(u, y, 2 * n, 2 * k, r) for u, y, n, k, r in report(self)])
    load_raw(spark, landing, wh, 2022, 2023)  # counts that do not fit the tables are not reported
    assert sorted(map(str, spark.read.json(f"{wh}/_load/report").collect())) == want
