"""The two batch jobs of the survey pipeline, as Spark jobs.

Landing layout: ``<root>/<year>/<workbook file>/<sheet>.csv`` - one delimited
extract per sheet of each yearly workbook (title on line 1, header on line 2).
A sheet's table is its standardised workbook and sheet name.

``derive_schemas``  profile every extract of the requested years, whatever sheets
                    there are, and write the metadata artefacts: per-year profile,
                    final schemas, table years, the workbook/sheet -> table map
                    and the DDL text (S10).
``load_raw``        load every extract into its raw table, replacing only the
                    loaded years (S7), with the declared schemas of the registry
                    or of a schema job's artefact, and write the load report.

Usage with spark-submit::

    spark-submit voltframe/jobs.py derive --landing L --out M --start_year 2019 --end_year 2024
    spark-submit voltframe/jobs.py load --landing L --warehouse W --start_year 2019 --end_year 2024 [--schemas M]
"""

from __future__ import annotations

import argparse
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe import registry
from voltframe.plans import profile as P
from voltframe.plans.views import register_warehouse
from voltframe.sources.delimited import (REJECTED, REPORT, Watch, data_rows, group_by_header, large_files, load_report,
                                         read_group, rejected_rows, standard_headers, union_balanced)
from voltframe.sources.ingest import conform, lost_casts, reject_counts
from voltframe.sources.releases import check_year_range, is_data_file, table_names
from voltframe.sources.sinks import write_metadata, write_tables


def sheet_listing(spark: SparkSession, landing: str, start_year: int, end_year: int) -> DataFrame:
    """S1 + S2 + S4 over the landing folder: one row per sheet extract with its table.

    The requested years are chosen by path before anything is listed below them.
    """
    check_year_range(start_year, end_year)
    years = ",".join(str(y) for y in range(start_year, end_year + 1))
    parts = F.split(F.col("path"), "/")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("ignoreMissingFiles", "true")
             .load(f"{landing.rstrip('/')}/{{{years}}}/*").select("path"))
    sheet = F.regexp_replace(F.element_at(parts, -1), r"\.csv$", "")
    listing = files.select("path", F.element_at(parts, -3).try_cast("int").alias("file_year"),
                           F.url_decode(F.element_at(parts, -2)).alias("workbook"), F.url_decode(sheet).alias("sheet"))
    return table_names(listing.where(is_data_file("workbook")))


def _files_by_table(listing: DataFrame) -> dict[str, list[str]]:
    """The listing is file metadata: a row per sheet and year."""
    by_table: dict[str, list[str]] = defaultdict(list)
    for r in listing.select("table_name", "path").collect():
        by_table[r.table_name].append(r.path)
    return {t: sorted(p) for t, p in sorted(by_table.items())}


@dataclass
class Group:
    """A table's files with one header: their paths and URIs, and their records."""
    table: str
    files: dict[str, str]
    names: list[str]
    large: set[str]

    def rows(self, spark: SparkSession, files: Iterable[str] | None = None) -> DataFrame:
        return read_group(spark, self.names, list(self.files if files is None else files), self.large)


def _groups(spark: SparkSession, by_table: dict[str, list[str]]) -> list[Group]:
    """The files by table and distinct header; all headers come from one scan."""
    table_of = {p: t for t, paths in by_table.items() for p in paths}
    large = large_files(spark, table_of) if table_of else set()
    headers = group_by_header(spark, table_of, large)
    names = standard_headers(spark, headers)
    out = []
    for header, paths in headers.items():
        own: dict[str, dict[str, str]] = defaultdict(dict)
        for p, uri in paths.items():
            own[table_of[p]][p] = uri
        out += [Group(table, files, names[header], large) for table, files in sorted(own.items())]
    return out


def derive_schemas(spark: SparkSession, landing: str, out: str, start_year: int, end_year: int,
                   widen_numeric: bool = False, strict_yn: bool = False) -> dict[str, DataFrame]:
    """Profile all releases (P1-P9), consolidate (P5), report years (P6/P7), render DDL."""
    listing = sheet_listing(spark, landing, start_year, end_year)
    groups = [(g.table, data_rows(g.rows(spark)).drop("file_date")) for g in _groups(spark, _files_by_table(listing))]
    long = P.long_cells(groups)
    profile = P.profile_table(long, strict_yn=strict_yn)
    # Write the per-year profile once; every other artefact is derived from that
    # copy instead of re-profiling the extracts.
    profile_path = f"{out.rstrip('/')}/year_schemas"
    write_metadata(profile, profile_path)
    profile = spark.read.schema(profile.schema).json(profile_path)
    consolidated = P.with_empty_columns(P.consolidate_types(profile, widen_numeric=widen_numeric), long)
    # A table has a release where it has a file, with or without rows.
    present = P.years_of(listing)
    artefacts = {
        "table_schemas": P.declared_schema(consolidated),
        "table_years": present,
        "missing_years": P.missing_years(present, start_year, end_year),
        "file_table_map": listing.select("workbook", "topic", "sheet", "table_name").distinct(),
        "table_ddls": P.render_schema(consolidated),
    }
    for name, df in artefacts.items():
        write_metadata(df, f"{out.rstrip('/')}/{name}")
    artefacts["year_schemas"] = profile
    # The DDL as one SQL text file (a row per schema and table, so one task is bounded).
    script = P.ddl_script(artefacts["table_ddls"])
    (script.repartition(1).sortWithinPartitions("kind", "name").select("statement")
     .write.mode("overwrite").text(f"{out.rstrip('/')}/table_ddls.sql"))
    return artefacts


LINEAGE = [T.StructField("file_year", T.IntegerType()), T.StructField("file_date", T.TimestampNTZType()),
           T.StructField("upload_timestamp", T.TimestampNTZType())]


def derived_schemas(spark: SparkSession, metadata: str) -> dict[str, T.StructType]:
    """The schemas that ``derive_schemas`` wrote below ``metadata`` (a row per column)."""
    kinds = {"BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "NUMERIC(18, 6)": T.DecimalType(18, 6)}
    rows = spark.read.json(f"{metadata.rstrip('/')}/table_schemas").collect()
    fields: dict[str, list[T.StructField]] = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.table_name, r.first_year or 0, r.first_position)):
        fields[r.table_name].append(T.StructField(r.column_name, kinds.get(r.sql_type, T.StringType())))
    return {t: T.StructType([*own, *LINEAGE]) for t, own in fields.items()}


def _watched(rows: DataFrame, schema: T.StructType, watch: Watch) -> DataFrame:
    """The rows to load with the declared columns; ``watch`` counts all records on the way."""
    kept = [T.StructField(n, T.StringType()) for n in ("path", REJECTED)]
    lost = rows.withColumn("_lost", F.expr(f"{REJECTED} IS NULL AND size({lost_casts(rows, schema)}) > 0"))
    typed = conform(lost, "", T.StructType([*schema, *kept, T.StructField("_lost", T.BooleanType())]))
    seen = watch.over(typed, F.col("_lost"))
    return seen.where(F.col(REJECTED).isNull()).select(*schema.names)


def _counts_hold(spark: SparkSession, warehouse: str, report: dict[str, list[tuple]]) -> bool:
    """Whether the written tables have the rows that were counted (a stage run twice counts twice)."""
    want = {(t, year): 0 for t, rows in report.items() for _, year, *_ in rows}
    for t, rows in report.items():
        for _, year, _, loaded, _ in rows:
            want[t, year] += loaded
    written = [spark.read.parquet(f"{warehouse.rstrip('/')}/{t}").where(F.col("file_year").isin(sorted({r[1] for r in rows})))
               .groupBy("file_year").count().select(F.lit(t).alias("t"), "file_year", "count")
               for t, rows in report.items() if any(r[3] for r in rows)]
    got = {(r.t, r.file_year): r["count"] for r in union_balanced(written).toLocalIterator()} if written else {}
    return {k: n for k, n in want.items() if n} == got


def load_raw(spark: SparkSession, landing: str, warehouse: str, start_year: int, end_year: int,
             max_parallel: int = 4, schemas: str | None = None, views: bool = False) -> list[str]:
    """Load every extract into ``warehouse/<schema.table>`` (replace loaded years) and write the report.

    Declared schemas come from the registry, or from the schema job's folder
    ``schemas``.  A sheet whose table nobody declares is an error that names it.
    Below ``warehouse/_load``: ``report`` (rows read, loaded and rejected by path),
    ``rejects`` (the rejected records) and ``casts`` (texts that failed their cast).
    ``views`` registers the ten views again over what now lies in the warehouse.
    """
    by_table = _files_by_table(sheet_listing(spark, landing, start_year, end_year))
    declared = derived_schemas(spark, schemas) if schemas else {t: registry.schema(t) for t in registry.table_names()}
    unknown = sorted(set(by_table) - set(declared))
    if unknown:
        raise ValueError(f"no declared schema for {', '.join(unknown)}; derive schemas first and pass them")
    upload = F.current_timestamp().cast("timestamp_ntz")
    parts: dict[str, list[DataFrame]] = defaultdict(list)
    groups = [(g, Watch(g.files.values())) for g in _groups(spark, by_table)]
    for g, watch in groups:
        rows = g.rows(spark).withColumn("upload_timestamp", upload)
        parts[g.table].append(_watched(rows, declared[g.table], watch))
    tables = {table: union_balanced(own) for table, own in parts.items()}
    # The extracts are parsed once, on their way into the tables.
    write_tables(tables, warehouse, max_parallel=max_parallel)
    if groups:
        _write_report(spark, groups, declared, warehouse)
    if views:
        register_warehouse(spark, warehouse)
    return sorted(tables)


def _write_report(spark: SparkSession, groups: list[tuple[Group, Watch]], declared: dict[str, T.StructType],
                  warehouse: str) -> None:
    """``_load/report`` from the counts of the write; only files with rejects and groups with failed casts are read again."""
    folder = f"{warehouse.rstrip('/')}/_load"
    by_table: dict[str, list[tuple]] = defaultdict(list)
    for g, watch in groups:
        by_table[g.table] += watch.report()
    if _counts_hold(spark, warehouse, by_table):
        report = spark.createDataFrame([r for rows in by_table.values() for r in rows], REPORT)
    else:
        report = load_report([g.rows(spark) for g, _ in groups])
    write_metadata(report, f"{folder}/report")
    rejects, casts = [], []
    for g, watch in groups:
        bad = {uri for uri, _, _, _, rejected in watch.report() if rejected}
        if bad:
            rejects.append(rejected_rows(g.rows(spark, [p for p, uri in g.files.items() if uri in bad])))
        if watch.lost():
            counts = reject_counts(data_rows(g.rows(spark)), g.table, declared[g.table], by_year=True)
            casts.append(counts.withColumn("table_name", F.lit(g.table)))
    none = spark.createDataFrame([], "path string, file_year int, record string")
    write_metadata(union_balanced(rejects or [none]), f"{folder}/rejects")
    none = spark.createDataFrame([], "file_year int, column string, rejected bigint, table_name string")
    write_metadata(union_balanced(casts or [none]).groupBy("table_name", "file_year", "column")
                   .agg(F.sum("rejected").alias("rejected")).where("rejected > 0"), f"{folder}/casts")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser("voltframe")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("derive", "load"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--start_year", type=int, required=True)
        p.add_argument("--end_year", type=int, required=True)
        if name == "derive":
            p.add_argument("--out", required=True)
            p.add_argument("--widen_numeric", action="store_true")
            p.add_argument("--strict_yn", action="store_true")
        else:
            p.add_argument("--warehouse", required=True)
            p.add_argument("--schemas")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"voltframe-{args.job}").getOrCreate()
    if args.job == "derive":
        derive_schemas(spark, args.landing, args.out, args.start_year, args.end_year,
                       args.widen_numeric, args.strict_yn)
    else:
        load_raw(spark, args.landing, args.warehouse, args.start_year, args.end_year, schemas=args.schemas)


if __name__ == "__main__":
    main()
