"""Static guards: the library keeps data on the executors."""

import pathlib

LIB = pathlib.Path(__file__).resolve().parents[1] / "voltframe"

# (file, pattern) pairs that are allowed: driver-side reads of metadata only.
ALLOWED = {
    ("jobs.py", ".collect()"),  # file listing: one row per sheet and year
}


def test_no_rows_collected_no_rdds_no_python_udfs():
    bad = []
    for path in LIB.rglob("*.py"):
        if "llm" in path.relative_to(LIB).parts:  # optional subpackage with rules of its own
            continue
        text = path.read_text()
        for pattern in (".collect()", ".toPandas(", "localCheckpoint", "pandas_udf", "@F.udf", ".rdd."):
            if pattern in text and (path.name, pattern) not in ALLOWED:
                bad.append(f"{path.relative_to(LIB)}: {pattern}")
    assert bad == []
