"""Profiling and schema derivation on small hand-made releases."""

from voltframe.plans import profile as P


def group_of(spark, table, rows, cols):
    return table, spark.createDataFrame(rows, "file_year int, " + ", ".join(f"{c} string" for c in cols))


def long_of(spark, table, rows, cols):
    return P.long_cells([group_of(spark, table, rows, cols)])


def test_profile_counts_null_as_value_and_unique_by_rows(spark):
    long = long_of(spark, "t.a", [(2020, "1", None), (2020, "2", None), (2020, "3", "x")], ["id", "flag"])
    prof = {r.column_name: r for r in P.profile_table(long).collect()}
    assert prof["id"].distinct_count == 3 and prof["id"].is_unique  # Q9: compared with rows
    assert prof["flag"].distinct_count == 2 and not prof["flag"].is_unique  # NULL counted (P1)
    assert prof["id"].col_type == "Int64" and prof["id"].max_len is None  # P2: numeric -> no length
    assert prof["flag"].col_type == "Boolean"  # Q8: {NULL, 'x'} -> Boolean by the reference rule
    assert prof["flag"].max_len == 1


def test_strict_yn_keeps_text_columns(spark):
    long = long_of(spark, "t.a", [(2020, "x"), (2020, None), (2020, "x")], ["note"])
    assert P.profile_table(long).first().col_type == "Boolean"
    assert P.profile_table(long, strict_yn=True).first().col_type == "String"
    yn = long_of(spark, "t.a", [(2020, "Y"), (2020, "N"), (2020, None)], ["flag"])
    assert P.profile_table(yn, strict_yn=True).first().col_type == "String"  # three values
    yn2 = long_of(spark, "t.a", [(2020, "Y"), (2020, "N")], ["flag"])
    assert P.profile_table(yn2, strict_yn=True).first().col_type == "Boolean"


def test_consolidation_rules(spark):
    long = P.long_cells([
        group_of(spark, "t.a", [(2020, "1", "1.5", "a")], ["n", "m", "s"]),
        group_of(spark, "t.a", [(2021, "2.5", "2.5", "b"), (2021, "3", "3.5", "c"), (2021, "4", "4.5", "d")],
                 ["n", "m", "s"]),
    ])
    prof = P.profile_table(long)
    types = {r.column_name: r.col_type for r in P.consolidate_types(prof).collect()}
    assert types == {"n": "String", "m": "Float64", "s": "String"}  # Q17: Int64 + Float64 -> String
    widened = {r.column_name: r.col_type for r in P.consolidate_types(prof, widen_numeric=True).collect()}
    assert widened["n"] == "Float64"


def test_years_missing_and_render(spark):
    long = P.long_cells([
        group_of(spark, "t.a", [(2020, "1")], ["id"]),
        group_of(spark, "t.a", [(2022, "1", "x")], ["id", "extra"]),
        group_of(spark, "t.b", [(2021, "1")], ["id"]),
    ])
    prof = P.profile_table(long)
    present = {r.table_name: r.years for r in P.years_present(prof).collect()}
    assert present == {"t.a": [2020, 2022], "t.b": [2021]}
    missing = {r.table_name: r.missing_years
               for r in P.missing_years(P.years_present(prof), 2020, 2022).collect()}
    assert missing == {"t.a": [2021], "t.b": [2020, 2022]}
    ddl = {r.table_name: r.ddl for r in P.render_schema(P.consolidate_types(P.profile_table(long))).collect()}
    assert ddl["t.a"].startswith("CREATE TABLE t.a(\n\tid BIGINT PRIMARY KEY,\n\textra VARCHAR,\n\tfile_year INT NOT NULL")
    assert ddl["t.a"].endswith("upload_timestamp TIMESTAMP DEFAULT CURRENT_TIMESTAMP NOT NULL\n);")


def test_one_table_year_over_two_header_groups_counts_values_once(spark):
    long = P.long_cells([
        group_of(spark, "t.a", [(2020, "1", "x"), (2020, "2", "y")], ["id", "note"]),
        group_of(spark, "t.a", [(2020, "y", "2"), (2020, "z", "3")], ["note", "id"]),
    ])
    prof = {r.column_name: r for r in P.profile_table(long).collect()}
    assert (prof["id"].n_rows, prof["id"].distinct_count) == (4, 3)
    assert (prof["note"].n_rows, prof["note"].distinct_count, prof["note"].position) == (4, 3, 0)
