"""Plain tables by path, and tables whose format has row-level changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.decode import changes, row_images
from tidemark.operators.fold import net_changes
from tidemark.table import DELETED, TableSpec


def scan_path(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A table by path, in any format on the class path."""
    return spark.read.format(format).load(path)


def append_path(decoded: DataFrame, path: str, format: str = "parquet") -> None:
    """Add every created or updated row to a table, without matching keys."""
    row_images(decoded).write.format(format).mode("append").save(path)


def merge_into(decoded: DataFrame, table: str, spec: TableSpec) -> None:
    """Apply decoded records to a table whose format supports MERGE, named as
    in SQL (a catalog name, or a format and a path).

    Such a table keeps no feed positions, so batches have to come in feed
    order, as they do from Kafka; and its keys should be unique, since a
    deleted key that comes back in the same batch updates its rows in place.
    """
    net = net_changes(changes(decoded), spec)
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in spec.columns}
    matching = " AND ".join(f"t.{quoted[k]} = n.{quoted[k]}" for k in spec.keys)
    assigned = ", ".join(f"t.{c} = n.{c}" for c in quoted.values())
    columns = ", ".join(quoted.values())
    values = ", ".join(f"n.{c}" for c in quoted.values())
    decoded.sparkSession.sql(
        f"MERGE INTO {table} AS t USING {{net}} AS n ON {matching}"
        f" WHEN MATCHED AND n.{DELETED} THEN DELETE"
        f" WHEN MATCHED THEN UPDATE SET {assigned}"
        f" WHEN NOT MATCHED AND NOT n.{DELETED} THEN INSERT ({columns}) VALUES ({values})",
        net=net,
    )
