"""Write PLANS.md: the executed physical plan of every view over landed tables.

usage: python tools/plan_report.py [sf_dir]
Lands the fixture tables as file_year-partitioned Parquet (in the session's
checkpoint folder), runs each view once so AQE settles its final plan, and
records the plan tree plus, for every scan, the pushed filters, partition
filters and read schema.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voltframe.fixtures import SURVEY_TABLES_USED, fixture_tables  # noqa: E402
from voltframe.plans import views as V  # noqa: E402
from voltframe.session import build_session, shared_folder  # noqa: E402
from voltframe.sources.catalog import read_tables  # noqa: E402
from voltframe.sources.sinks import write_tables  # noqa: E402

VIEWS = {
    "a": V.biomass_generators_count, "b": V.utilities_with_existing_renewable_offset,
    "c": V.facility_type_count_by_state, "d": V.multi_state_solar_facilities_percentage,
    "e": V.median_battery_capacity_by_year, "f": V.wind_solar_capacity_by_utility,
    "g": V.current_capacity_mix_by_fuel_type, "h": V.generators_reaching_retirement,
    "i": V.capacity_by_tech_geo_year, "j": V.additions_vs_retirements_geo,
    "g2": V.capacity_mix_evolution, "h2": V.retirement_capacity_gap, "i2": V.penetration_change,
}


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(text: str) -> tuple[str, list[str], dict[str, int]]:
    tree = text.split("\n\n\n")[0]
    final = tree.split("+- == Initial Plan ==")[0]
    scans = []
    for block in re.findall(r"\(\d+\) Scan parquet.*?(?=\n\(\d+\) |\Z)", text, flags=re.S):
        loc = re.search(r"Location: \S+ \[([^\]]+)\]", block)
        table = loc.group(1).rstrip("/").split("/")[-1] if loc else "?"
        pf = re.search(r"PartitionFilters: (\[.*?\])\n", block)
        pu = re.search(r"PushedFilters: (\[.*?\])\n", block)
        rs = re.search(r"ReadSchema: (.*)", block)
        scans.append(f"| {table} | {pf.group(1) if pf else ''} | {pu.group(1) if pu else ''} | "
                     f"{rs.group(1) if rs else ''} |")
    counts = {k: final.count(k) for k in ("Exchange", "BroadcastExchange", "SortMergeJoin",
                                          "BroadcastHashJoin", "WindowGroupLimit", "HashAggregate")}
    return final, sorted(set(scans)), counts


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    base = shared_folder(spark)
    root = f"{base.rstrip('/')}/plans-{uuid.uuid4().hex[:8]}"
    write_tables(fixture_tables(spark, sf_dir, stage_dir=f"{root}/_generator_rows"), root)
    tables = read_tables(spark, root, SURVEY_TABLES_USED)
    out = ["# Physical plans of the views", "",
           f"Generated by `tools/plan_report.py` over the fixture tables of `{sf_dir}` landed as "
           "`file_year`-partitioned Parquet, after one execution (AQE final plans), local[8], "
           "16 shuffle partitions.  Table names are the landed folders.", ""]
    for key, fn in VIEWS.items():
        df = fn(tables)
        df.write.format("noop").mode("overwrite").save()
        final, scans, counts = summarize(formatted(df))
        out += [f"## ({key}) {fn.__name__}", "",
                "Operators in the final plan: " + ", ".join(f"{k} {v}" for k, v in counts.items()), "",
                "| scan | partition filters | pushed filters | read schema |", "| --- | --- | --- | --- |",
                *scans, "", "```", final.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
