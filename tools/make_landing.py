"""Write survey-shaped yearly sheet extracts into a landing folder (bench/test input).

Layout ``<landing>/<year>/<workbook>/<sheet>.csv`` with a title on line 1 and
raw-style headers ('Nameplate Capacity Mw') on line 2, built from the fixture
tables of a driver scale factor.  Spark writes one CSV per (table, year); the
file is then copied under its landing name with the title line in front.
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from voltframe import registry
from voltframe.fixtures import SURVEY_TABLES_USED, fixture_tables
from voltframe.sources.releases import SURVEY_TABLE_MAP

WORKBOOKS = {"generator": "3_1_Generator_Y{y}.xlsx", "solar": "3_3_Solar_Y{y}.xlsx",
             "wind": "3_2_Wind_Y{y}.xlsx", "energystorage": "3_4_Energy_Storage_Y{y}.xlsx"}


def raw_header(name: str) -> str:
    return name.replace("_", " ").title()


def make_landing(spark: SparkSession, sf_dir: str, landing: str, scratch: str) -> list[str]:
    sheets = {table: sheet for topic in SURVEY_TABLE_MAP.values() for sheet, table in topic.items()}
    tables = fixture_tables(spark, sf_dir, stage_dir=f"{scratch}/_rows")
    written = []
    for name in SURVEY_TABLES_USED:
        survey = [f.name for f in registry.survey_schema(name).fields]
        df = tables[name].select("file_year", *[F.col(c).alias(raw_header(c)) for c in survey])
        out = f"{scratch}/{name}"
        # Test-input setup only: the landing layout needs exactly one file per
        # (table, year), so each year goes to one task here.  Library writers
        # use write_releases (rebalance, hot years split over several tasks).
        df.repartition("file_year").write.mode("overwrite").partitionBy("file_year") \
          .option("header", "true").csv(out)
        for part in sorted(glob.glob(f"{out}/file_year=*/part-*.csv")):
            year = part.split("file_year=")[1].split("/")[0]
            topic = name.split(".")[0]
            target_dir = os.path.join(landing, year, WORKBOOKS[topic].format(y=year))
            os.makedirs(target_dir, exist_ok=True)
            target = os.path.join(target_dir, f"{sheets[name]}.csv")
            with open(part) as src, open(target, "a" if os.path.exists(target) else "w") as dst:
                if dst.tell() == 0:
                    dst.write(f"Survey release {year}: {sheets[name]}\n")
                    dst.write(src.read())
                else:  # a second part file of the same year: skip its header line
                    src.readline()
                    dst.write(src.read())
            written.append(target)
    return sorted(set(written))
