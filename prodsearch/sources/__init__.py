"""Sources and sinks: landed JSON pages, CSV and Parquet files."""

from . import files, pages, tables  # noqa: F401
