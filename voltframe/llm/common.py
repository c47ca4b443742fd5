"""Helpers shared by the operators: table reads, staged tables, text handling."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these characters (space, tab to carriage return).
SPACES = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which driver and executors share.

    Only a session that runs in one process (tests) gets a folder of its own when
    the setting is missing; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="voltframe-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: an executor lost later costs a re-read, not the work so far.
    Every call takes a new folder; the folder is the run's to clean up.
    """
    path = f"{shared_dir(df.sparkSession)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of identifiers up to which a written table is broadcast (some tens of MB).
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(ids: DataFrame) -> DataFrame:
    """A written table of identifiers, to be broadcast if its counted rows are few; else Spark shuffles."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(ids) if few else ids


def slices(batches, rows: int = 256):
    """Record batches in slices of few rows, so that what a task makes of texts stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_name(name: str, columns: list[str]) -> str:
    """A name that none of ``columns`` has, whatever the case of its letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def tidied(batches):
    """Batches of a task's end, after which freed memory goes back to the system: workers outlive their tasks."""
    yield from batches
    release()


def release() -> None:
    """Gives freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a system without it keeps the pages
        pass


def text_of(column: str | Column) -> Column:
    """The text as a string, null as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def unit_hash(seed: int, key: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key only (null is a key of its own)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    first_52_bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10)
    return first_52_bits.cast("bigint") / F.lit(float(1 << 52))
