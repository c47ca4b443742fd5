"""Writers, and the replace-by-year semantics as a DataFrame operation."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_years(existing: DataFrame, incoming: DataFrame,
                  years: Iterable[int] | None = None) -> DataFrame:
    """S7 semantics: the years that really come in replace those years of ``existing``.

    ``years`` (the requested range) only bounds ``incoming``; a requested year without
    data keeps its old rows, as the partitioned writer does, and rows without a year
    are never replaced.  Loading the same release twice gives the table once (Q10).
    The year list has one row a year, so the anti join is planned by its measured size.
    """
    if years is not None:
        incoming = incoming.where(F.col("file_year").isin(sorted(set(years))))
    kept = existing.join(incoming.select("file_year").distinct(), "file_year", "left_anti")
    return kept.unionByName(incoming)


def write_releases(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S7 physical form: dynamic partition overwrite by ``file_year``.

    Only the years present in ``df`` are replaced; other partitions stay.  The
    write is a job of independent tasks committed atomically, so a lost
    executor only re-runs its tasks.
    """
    # REBALANCE on the partition column: AQE sizes the write tasks to the
    # advisory partition size (few, large files per year) and splits a hot
    # year over several tasks instead of funnelling it into one.
    (df.hint("rebalance", "file_year").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("file_year")
     .format(fmt)
     .save(path))


def write_tables(tables: Mapping[str, DataFrame], root: str, max_parallel: int = 4) -> None:
    """Write several raw tables (``root/<schema.table>``) as concurrent Spark jobs.

    The tables are independent, so their jobs are submitted from a few driver
    threads and share the executors; small tables then no longer wait for each
    other.  Each write is still a separate, atomically committed job.
    """
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        futures = [pool.submit(write_releases, df, f"{root.rstrip('/')}/{name}")
                   for name, df in tables.items()]
        for f in futures:
            f.result()


def jdbc_append(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
                batch_size: int = 10000) -> None:
    """Append rows to a JDBC table (one connection per task, batched inserts)."""
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    df.write.mode("append").jdbc(url, table, properties=props)


def write_metadata(df: DataFrame, path: str) -> None:
    """A metadata DataFrame (profile, schemas, table years) as JSON lines."""
    df.write.mode("overwrite").json(path)


def stamp_upload(df: DataFrame) -> DataFrame:
    """T3 upload column for a sink that has no default timestamp."""
    return df.withColumn("upload_timestamp", F.current_timestamp().cast("timestamp_ntz"))
