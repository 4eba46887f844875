"""Change-data-capture feeds applied to tables with Spark DataFrames."""

from tidemark.table import TableSpec

__all__ = ["TableSpec"]
