"""Labelled rows for the trained operators: held-out split and bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo ``modulus`` (null identifiers: of the empty text)."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def sampled_labels(labels: DataFrame, label: str, held_out: Column, per_class: int) -> tuple[DataFrame, list[float]]:
    """(doc_id, label) of at most ``per_class`` documents of each class, and what one row of each class stands for.

    The rows with the smallest hashes of the identifier are taken, so a sample is
    the same on every run.  Held-out rows, null labels and labels other than 0 and
    1 are left out; a document labelled twice has the larger label.
    """
    rows = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out)
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    picked = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
              for k in (0, 1)]
    stands_for = [max(1.0, counts.get(k, 0) / per_class) for k in (0, 1)]
    return picked[0].unionAll(picked[1]), stands_for
