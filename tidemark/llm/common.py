"""What several operators share: tables, words, and tables written half-way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.workdir import work_dir

#: A word is a run of characters other than space and the ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the folder that all executors share and read again.

    Cuts the lineage: what was computed is not computed again when an executor
    is lost, and every later reader sees the same rows.
    """
    spark = df.sparkSession
    path = work_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(*told_apart_by: str) -> Column:
    """What a row is known by: its id, if it has one, and a hash of further columns. Never null.

    Text, since a join on structs or on values that may be null casts its keys,
    and what follows would shuffle again.
    """
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64(*told_apart_by).cast("string"))


def share_of_rows(share: Column | float) -> Column:
    """Whether a row is in a share of all rows, picked by a hash of its id and text together:
    rows without an id, or with the same one, are picked apart from each other."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40)) < share


def hex_to_long(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")
