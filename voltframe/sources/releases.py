"""Which releases and which files are read, and where they go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.names import standardize_name_col

# File-name markers of files that are not data sheets.
SKIP_MARKERS = ("EIA-860 Form", "LayoutY")
DATA_SUFFIX = ".xlsx"
LOCK_PREFIX = "~"


def check_year_range(start_year: int, end_year: int) -> None:
    """S1 argument check.  A single year (start == end) is allowed."""
    if start_year > end_year:
        raise ValueError(f"start_year {start_year} must not be after end_year {end_year}")


def select_years(df: DataFrame, start_year: int, end_year: int) -> DataFrame:
    """Releases in ``[start_year, end_year]``; on a ``file_year`` partitioned
    table this is a partition filter, so other years are never listed or read."""
    check_year_range(start_year, end_year)
    return df.where(F.col("file_year").between(start_year, end_year))


def is_data_file(name: Column | str, suffix: str = DATA_SUFFIX) -> Column:
    """Keep data workbooks; drop form/layout documents and editor lock files."""
    n = F.col(name) if isinstance(name, str) else name
    keep = n.endswith(suffix) & ~n.startswith(LOCK_PREFIX)
    for marker in SKIP_MARKERS:
        keep = keep & ~n.contains(marker)
    return keep


def table_names(listing: DataFrame) -> DataFrame:
    """``topic`` and ``table_name`` of each (workbook, sheet), derived from the names that are there."""
    return listing.withColumn("topic", standardize_name_col("workbook")).withColumn(
        "table_name", F.concat_ws(".", "topic", standardize_name_col("sheet")))


# The workbook / sheet -> table map of the survey releases, as documentation
# and test input; routing derives tables from the names.
SURVEY_TABLE_MAP = {
    "solar": {"Operable": "solar.operable", "Retired and Canceled": "solar.retired_and_canceled"},
    "enviroequip": {
        "Emission Standards & Strategies": "enviroequip.emission_standards_strategies",
        "Boiler Info & Design Parameters": "enviroequip.boiler_info_design_parameters",
        "Cooling": "enviroequip.cooling", "FGP": "enviroequip.fgp", "FGD": "enviroequip.fgd",
        "Stack Flue": "enviroequip.stack_flue"},
    "multifuel": {"Operable": "multifuel.operable", "Proposed": "multifuel.proposed",
                  "Retired and Canceled": "multifuel.retired_and_canceled"},
    "utility": {"Utility": "utility.utility"},
    "wind": {"Operable": "wind.operable", "Retired and Canceled": "wind.retired_and_canceled"},
    "energystorage": {"Operable": "energystorage.operable", "Proposed": "energystorage.proposed",
                      "Retired and Canceled": "energystorage.retired_and_canceled"},
    "plant": {"Plant": "plant.plant"},
    "enviroassoc": {
        "Boiler Generator": "enviroassoc.boiler_generator",
        "Boiler Cooling": "enviroassoc.boiler_cooling",
        "Boiler Particulate Matter": "enviroassoc.boiler_particulate_matter",
        "Boiler SO2": "enviroassoc.boiler_so2", "Boiler NOx": "enviroassoc.boiler_nox",
        "Boiler Mercury": "enviroassoc.boiler_mercury",
        "Boiler Stack Flue": "enviroassoc.boiler_stack_flue",
        "Emissions Control Equipment": "enviroassoc.emissions_control_equipment"},
    "generator": {"Operable": "generator.operable", "Proposed": "generator.proposed",
                  "Retired and Canceled": "generator.retired_and_canceled"},
    "owner": {"Ownership": "owner.ownership"},
}
