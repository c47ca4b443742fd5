"""S3: read yearly sheet extracts whose first line is a title and second the header.

Layout: ``<root>/<year>/[<workbook>/]<file>.csv``; one file is one sheet.  A file is
cut into records outside quotes, so line breaks inside a quoted field stay in it;
quotes are doubled.  Record 1 is the title, record 2 the header, and every other
record is data, whatever its key columns hold.  Records whose number of fields
differs from the header's (footnotes, surplus fields) go to the rejects with their
path; nothing is cut off or dropped.

Files up to ``WHOLE_BYTES`` are read whole, a task a file (a sheet has at most a
million rows).  Larger ones are read in splits by :func:`split_records`: whether a
split begins inside quotes follows from the parity of all quotes before it.
"""

from __future__ import annotations

import csv
import io
import re
from collections import defaultdict
from typing import Iterable
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.names import column_names

# Release year: the folder holding the extract, or the one above a workbook folder.
YEAR_IN_PATH = r"/(\d{4})/(?:[^/]+/)?[^/]+$"
#: A record: quoted stretches and anything but quotes and line ends.
RECORD = r'(?:[^"\r\n]++|"[^"]*+"?)++'
TITLE, HEADER, FIRST_DATA = 0, 1, 2
#: Where the text of a record with a wrong number of fields is kept.
REJECTED = "_rejected"


#: Files above this size are read in splits.
WHOLE_BYTES = 64 << 20
#: A large file's title and header lie in splits that begin before this offset.
HEAD_BYTES = 1 << 20
#: Characters in which title and header are looked for first.
HEAD_CHARS = 1 << 16
_BOM = "^\ufeff"


def large_files(spark: SparkSession, paths: Iterable[str], whole_bytes: int | None = None) -> set[str]:
    """The local paths of files above ``whole_bytes``, from the file listing alone."""
    files = (spark.read.format("binaryFile").load(list(paths)).select("path", "length")
             .where(F.col("length") > (WHOLE_BYTES if whole_bytes is None else whole_bytes)))
    return {unquote(_local(r["path"])) for r in files.toLocalIterator()}  # a row a large file


def read_records(spark: SparkSession, paths: Iterable[str], large: set[str] = frozenset(),
                 head: bool = False) -> DataFrame:
    """path, file_date, position and record of every non-empty record of the files.

    ``large`` names the files that are read in splits; ``head`` asks for title and header only.
    """
    paths = list(paths)
    parts = []
    whole = [p for p in paths if _local(p) not in large]
    split = [p for p in paths if _local(p) in large]
    if whole:
        parts.append(whole_records(spark, whole, head))
    if split:
        parts.append(split_records(spark, split, head))
    return union_balanced(parts)


def _ended(record: Column) -> Column:
    """Without the line ends of the file's end, which only a record with an unclosed quote holds."""
    return F.rtrim(record, F.lit("\r\n"))


def whole_records(spark: SparkSession, paths: list[str], head: bool = False) -> DataFrame:
    """Records of files that fit a task each."""
    files = (spark.read.text(paths, wholetext=True)
             .select("value", F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_date")))
    text = F.regexp_replace("value", _BOM, "")
    if head:
        # Two records that end within the first characters spare the rest of the text.
        first_two = rf"^[\r\n]*+({RECORD})(?:[\r\n]++({RECORD}))"
        start = F.substring(text, 1, HEAD_CHARS)
        found = F.array(*[F.coalesce(
            F.nullif(F.regexp_extract(start, first_two + r"[\r\n]", k), F.lit("")),
            F.nullif(F.regexp_extract(text, first_two + "?", k), F.lit(""))) for k in (1, 2)])
        rows = files.select("path", "file_date", F.posexplode(found).alias("position", "record"))
        return rows.where(F.col("record").isNotNull()).withColumn("record", _ended(F.col("record")))
    rows = files.select("path", "file_date", F.posexplode(F.regexp_extract_all(text, F.lit(RECORD), F.lit(0)))
                        .alias("position", "record"))
    return rows.withColumn("record", _ended(F.col("record")))


def split_records(spark: SparkSession, paths: list[str], head: bool = False) -> DataFrame:
    """Records of files of any size, whose lines end in ``\\n`` or ``\\r\\n``.

    Lines come with the split they lie in.  Inside a split a window counts the quotes
    before each line, and record starts for both cases, that the split begins outside
    or inside quotes.  A row a split then says which case holds (parity of all quotes
    before) and how many records began before it, so every line has its record's
    number.  Only the lines of records over several lines are gathered again.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("file_date"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    if head:
        lines = lines.where(F.col("split") < HEAD_BYTES)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    filled = F.rtrim("value", F.lit("\r")) != ""
    own = Window.partitionBy("path", "split").orderBy("line")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumns({"odd": quotes % 2, "filled": filled})
    lines = lines.withColumn("flips", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    lines = lines.withColumns({f"starts{s}": F.count_if((F.col("flips") == s) & F.col("filled")).over(
        own.rowsBetween(Window.unboundedPreceding, 0)) for s in (0, 1)})

    splits = lines.groupBy("path", "split").agg(F.sum("odd").alias("odds"), F.max("starts0").alias("starts0"),
                                                F.max("starts1").alias("starts1"))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2)
    began = F.when(F.col("inside") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    splits = splits.withColumn("began", began).withColumn("began", F.coalesce(F.sum("began").over(earlier), F.lit(0)))

    rows = lines.join(splits.select("path", "split", "inside", "began"), ["path", "split"])
    outside = (F.col("flips") + F.col("inside")) % 2 == 0
    here = F.when(F.col("inside") == 0, F.col("starts0")).otherwise(F.col("starts1"))
    rows = rows.where(~outside | F.col("filled")).select(
        "path", "file_date", (F.col("began") + here - 1).cast("int").alias("position"), "value", "split", "line",
        (outside & (F.col("odd") == 0)).alias("alone"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("split", "line", "value"))), lambda x: x["value"])
    records = rows.where("alone").select("path", "file_date", "position", "value").unionByName(
        rows.where("NOT alone").groupBy("path", "file_date", "position").agg(
            F.array_join(in_order, "\n").alias("value")))
    text = F.when(F.col("position") == 0, F.regexp_replace("value", _BOM, "")).otherwise(F.col("value"))
    found = F.regexp_extract_all(text, F.lit(RECORD), F.lit(0))
    one = F.when(F.size(found) == 1, found[0]).otherwise(F.raise_error(F.concat(
        F.lit("a carriage return outside quotes ends a line in the middle of "), F.col("path"))))
    return records.select("path", "file_date", "position", _ended(one).alias("record"))


def read_headers(spark: SparkSession, paths: Iterable[str], large: set[str] = frozenset()) -> dict[str, tuple[str, ...]]:
    """The raw header of every file, from one scan of all of them (a row a file)."""
    heads = read_records(spark, paths, large, head=True).where(F.col("position") == HEADER).select("path", "record")
    return {r["path"]: tuple(next(csv.reader(io.StringIO(r["record"], newline="")))) for r in heads.toLocalIterator()}


def group_by_header(spark: SparkSession, paths: Iterable[str],
                    large: set[str] = frozenset()) -> dict[tuple[str, ...], dict[str, str]]:
    """Files, and the URIs that the scan reports for them, by header; a file without a header is an error."""
    paths = list(paths)
    headers = read_headers(spark, paths, large)
    short = len(paths) - len(headers)
    if short:
        raise ValueError(f"{short} of {len(paths)} extracts have no header line")
    given = {_local(p): p for p in paths}  # the scan reports paths as URIs
    groups: dict[tuple[str, ...], dict[str, str]] = defaultdict(dict)
    for uri, header in sorted(headers.items()):
        groups[header][given[unquote(_local(uri))]] = uri
    return dict(groups)


def _local(path: str) -> str:
    """A path without scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def standard_headers(spark: SparkSession, headers: Iterable[tuple[str, ...]]) -> dict[tuple[str, ...], list[str]]:
    """Standard names (T1/T2) of all headers in one query; colliding names raise (Q19)."""
    headers = list(headers)
    names = iter(column_names(spark, [h for header in headers for h in header]))
    out = {}
    for header in headers:
        own = [next(names) for _ in header]
        for k, name in enumerate(own):
            if name in own[:k]:
                raise ValueError(
                    f"headers {header[own.index(name)]!r} and {header[k]!r} both standardise to {name!r}")
        out[header] = own
    return out


def read_group(spark: SparkSession, names: list[str], paths: list[str], large: set[str] = frozenset()) -> DataFrame:
    """All data records of files with one header: text columns, lineage, ``path`` and ``_rejected``."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, REJECTED]])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED,
               "multiLine": "true", "maxCharsPerColumn": "-1"}
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    data = read_records(spark, paths, large).where(F.col("position") >= FIRST_DATA)
    parsed = data.select("path", "file_date", F.from_csv("record", ddl, options).alias("r"))
    year = F.regexp_extract("path", YEAR_IN_PATH, 1).try_cast("int")
    return parsed.select("r.*", year.alias("file_year"), "file_date", "path")


def read_extracts(spark: SparkSession, paths: Iterable[str], whole_bytes: int | None = None) -> list[DataFrame]:
    """One DataFrame per distinct header: text columns, file_year, file_date, path and ``_rejected``."""
    paths = list(paths)
    large = large_files(spark, paths, whole_bytes)
    groups = group_by_header(spark, paths, large)
    names = standard_headers(spark, groups)
    return [read_group(spark, names[header], list(files), large) for header, files in groups.items()]


def data_rows(group: DataFrame) -> DataFrame:
    """The records with the right number of fields, without the reading columns."""
    return group.where(F.col(REJECTED).isNull()).drop(REJECTED, "path")


def rejected_rows(group: DataFrame) -> DataFrame:
    """path, file_year and text of the records with a wrong number of fields."""
    return group.where(F.col(REJECTED).isNotNull()).select("path", "file_year", F.col(REJECTED).alias("record"))


def load_report(groups: Iterable[DataFrame]) -> DataFrame:
    """path, file_year, rows_read, rows_loaded, rows_rejected: what was read is loaded or rejected."""
    rows = union_balanced([g.select("path", "file_year", F.col(REJECTED).isNull().alias("loaded")) for g in groups])
    return rows.groupBy("path", "file_year").agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if("loaded").alias("rows_loaded"),
        F.count_if(~F.col("loaded")).alias("rows_rejected"))


REPORT = "path string, file_year int, rows_read bigint, rows_loaded bigint, rows_rejected bigint"


class Watch:
    """Counts of one group's rows, taken while they are written: by file read and rejected, and rows with failed casts."""

    def __init__(self, uris: Iterable[str]) -> None:
        self.uris, self.seen = list(uris), Observation()

    def over(self, rows: DataFrame, lost: Column) -> DataFrame:
        """``rows`` (with ``path`` and ``_rejected``), watched; a group has a file a release."""
        counts = []
        for k, uri in enumerate(self.uris):
            own = F.col("path") == uri
            counts += [F.count_if(own).alias(f"read{k}"), F.count_if(own & F.col(REJECTED).isNotNull()).alias(f"rejected{k}")]
        return rows.observe(self.seen, *counts, F.count_if(lost).alias("lost"))

    def counts(self) -> dict[str, int] | None:
        """The metrics of the finished write; None where Spark found nothing to read and so kept none."""
        try:
            return self.seen.get
        except Py4JJavaError:
            return None

    def report(self) -> list[tuple]:
        """Rows of the load report; files without records have none."""
        got = self.counts() or defaultdict(int)
        return [(uri, int(re.search(YEAR_IN_PATH, uri).group(1)), got[f"read{k}"],
                 got[f"read{k}"] - got[f"rejected{k}"], got[f"rejected{k}"])
                for k, uri in enumerate(self.uris) if got[f"read{k}"]]

    def lost(self) -> int:
        return (self.counts() or defaultdict(int))["lost"]


def union_balanced(parts: list[DataFrame]) -> DataFrame:
    """Unions pairs of pairs, so the plan's depth grows with the logarithm of the parts."""
    while len(parts) > 1:
        parts = [parts[k].unionByName(parts[k + 1]) if k + 1 < len(parts) else parts[k]
                 for k in range(0, len(parts), 2)]
    return parts[0]
