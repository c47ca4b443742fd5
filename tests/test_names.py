import pytest

from voltframe.functions.names import check_unique_names, column_names, standardize_name_col

CASES = [
    ("3_1_Generator_Y2023.xlsx", "generator"),
    ("2___Plant_Y2022.xlsx", "plant"),
    ("Nameplate Capacity (MW)", "nameplate_capacity_mw"),
    ("Multiple Fuels?", "multiple_fuels"),
    ("Utility ID", "utility_id"),
    ("Emission Standards & Strategies", "emission_standards_strategies"),
    ("Boiler SO2", "boiler_so2"),
    ("RTO/ISO LMP Node Designation", "rtoiso_lmp_node_designation"),
    ("Retired and Canceled", "retired_and_canceled"),
    ("Energy Source 1 ", "energy_source_1_"),
    ("__Status", "status"),
    ("12__Sector Name", "sector_name"),
    ("Utility\u00a0ID", "utility_id"),           # a no-break space is white space
    ("\u0663__Sector\u2003Name", "sector_name"),  # an Arabic-Indic digit is a digit
]


def test_standard_names_of_headers(spark):
    assert column_names(spark, [raw for raw, _ in CASES]) == [name for _, name in CASES]
    assert column_names(spark, []) == []


def test_standard_names_of_a_column(spark):
    df = spark.createDataFrame([(raw,) for raw, _ in CASES], "raw string")
    got = {r.raw: r.std for r in df.select("raw", standardize_name_col("raw").alias("std")).collect()}
    assert got == dict(CASES)


def test_truncation_to_63(spark):
    raw = "RTO/ISO Location Designation for Reporting Wholesale Sales Data to FERC"
    assert column_names(spark, [raw]) == [
        "rtoiso_location_designation_for_reporting_wholesale_sales_data_to_ferc"[:63]]


def test_q19_colliding_headers_raise(spark):
    with pytest.raises(ValueError, match="both standardise"):
        check_unique_names(spark, ["Plant Code", "Plant Code?"])


def test_registry_uses_63_char_names():
    from voltframe import registry
    names = [f.name for f in registry.schema("generator.operable").fields]
    assert "rtoiso_location_designation_for_reporting_wholesale_sales_data_to_ferc"[:63] in names
    assert all(len(n) <= 63 for t in registry.table_names() for n, _ in registry.catalogue()[t])
    assert len(registry.table_names()) == 30
    assert sum(len(registry.catalogue()[t]) for t in registry.table_names()) == 895
