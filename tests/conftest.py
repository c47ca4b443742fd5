import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from voltframe.session import checkpoint_dir  # noqa: E402
from voltframe.sources.ingest import conform  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: install a checkpoint folder when the environment names none.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="voltframe-ckpt-"))
    yield s


def make_table(spark, name, rows):
    """Rows (dicts with a subset of columns) -> a raw table with the full registry schema.

    Missing lineage defaults: file_date = Jan 1 of file_year, upload = file_date.
    """
    filled = []
    for r in rows:
        r = dict(r)
        r.setdefault("file_date", dt.datetime(r["file_year"], 1, 1))
        r.setdefault("upload_timestamp", r["file_date"])
        filled.append(r)
    cols = sorted({k for r in filled for k in r})
    from voltframe import registry
    target = {f.name: f.dataType for f in registry.schema(name).fields}
    from pyspark.sql import types as T
    cols = [c for c in cols if c in target]  # columns a table does not declare are dropped (T6)
    schema = T.StructType([T.StructField(c, target[c]) for c in cols])
    df = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in filled], schema)
    return conform(df, name)


@pytest.fixture
def table(spark):
    def build(name, rows):
        return make_table(spark, name, rows)
    return build
