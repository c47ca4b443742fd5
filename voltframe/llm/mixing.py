"""Mixing sources to target weights.

Words are summed per source, each source gets a target share of all words, and
the ratio target / size is its repetition rate.  A document is emitted
``floor(rate)`` times, plus once more if a hash-seeded draw falls below the
fraction, so reruns take the same documents.

Targets are filled like water: sources get words in proportion to their
weights, no source more than ``max_repeats`` times its own size, and what a full
source cannot take is shared again by weight.  With sources ordered by
``max_repeats * size / weight`` the full ones are a prefix, so one ordered pass
over the per-source sums (one row a source) gives the final level.

Defined results: null text has size 0; a null source is a source of its own,
last in the order; empty tables give empty results; sources of size 0 have
target 0; rows that repeat a doc_id share one draw; extra columns are carried
along by :func:`mix` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.llm.common import WORD_PATTERN, staged, text_of, unit_hash

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 17


def word_count(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD_PATTERN)).cast("bigint")


def source_targets(sizes: DataFrame, max_repeats: int = MAX_REPEATS, weights=WEIGHTS) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    # One row a source from here on: the unpartitioned windows see the sums only.
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("place", F.row_number().over(by_name))
    turns = F.array(*[F.lit(w) for w in weights])
    weighed = ranked.withColumn(
        "weight", F.element_at(turns, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    weighed = (weighed
               .withColumn("cap", (F.col("source_size") * max_repeats).cast("bigint"))
               .withColumn("full_at", F.col("cap") / F.col("weight")))
    by_level = Window.orderBy("full_at", "place")
    everyone = Window.partitionBy(F.lit(1))
    levels = (weighed
              .withColumn("total", F.sum("source_size").over(everyone))
              .withColumn("cap_before", F.coalesce(F.sum("cap").over(
                  by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(
                  by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
              .withColumn("rank", F.row_number().over(by_level)))
    open_at = F.when(F.col("level") <= F.col("full_at"), F.struct("rank", "level"))
    water = F.min(open_at).over(everyone)["level"]
    return levels.select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"),
                F.coalesce(water * F.col("weight"), F.col("cap").cast("double"))).alias("target"))


def with_copies(docs: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows with ``doc_id`` and ``source``.

    ``targets`` is a written table of one row a source, so Spark knows its size and
    broadcasts it only while it is small.
    """
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    joined = docs.join(t, docs["source"].eqNullSafe(t["_source"]), "left").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    extra = (unit_hash(seed, F.col("doc_id")) < rate - whole).cast("bigint")
    return joined.withColumn("copies", (whole + extra).cast("bigint"))


def mixture(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies."""
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = staged(source_targets(sizes), "mix-targets")
    return with_copies(sizes, targets, seed)


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as many times as its copies say."""
    columns = docs.columns
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = staged(source_targets(sizes), "mix-targets")
    rows = with_copies(docs.select(F.struct("*").alias("_row"), "doc_id", "source"), targets, seed)
    repeated = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies")))).where("_copy > 0")
    return repeated.select(*[F.col("_row")[c].alias(c) for c in columns])
