"""Hand a columnar (Arrow) table to Spark.

For small frames built on the driver (tests, lookup tables): bulk data is
read by the executors from files and never passes through here.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_arrow(spark: SparkSession, table: pa.Table, schema: T.StructType | None = None) -> DataFrame:
    """Arrow table -> DataFrame (Arrow-batched transfer), optionally cast to ``schema``."""
    df = spark.createDataFrame(table)
    if schema is None:
        return df
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
