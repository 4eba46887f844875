"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Parts that the rows of one key are dealt to.
SALTS = 64


def with_least(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Each row with the least `value` of its `key`, null if all are null, as `name`; keys are not null.

    A key's rows are dealt to SALTS parts, each part gives its least value, and
    the least of a key's parts comes back to all of them: a key with most of the
    rows is neither one task of the aggregation nor one of the join.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    parts = salted.groupBy(key, "salt").agg(F.min(value).alias(name))
    least = parts.withColumn(name, F.min(name).over(Window.partitionBy(key)))
    return salted.join(least, [key, "salt"]).drop("salt")


def _nearest(pairs: DataFrame) -> DataFrame:
    """Each (a, b) with the least node that is next to a."""
    return with_least(pairs, "a", "b", "least")


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node that can be reached, for every node with an edge.

    edges: a and b, not null, in any order; loops and repeats do no harm.
    Rounds of two steps, each of which keeps what is connected: every node's
    larger neighbours, then its smaller ones, are linked to its least neighbour.
    The number of rounds grows with the logarithm of the longest path; the edges
    of a node with very many neighbours are dealt to several tasks.
    """
    now = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = None
    while True:
        # large step: both directions; neighbours above a go to the least of a and its neighbours
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            _nearest(both)
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("least", "a").alias("b"))
            .distinct()
        )
        # small step: a's smaller neighbours and a itself go to the least of them
        small = _nearest(large)
        now = stored(
            small.filter("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionByName(small.select("a", F.col("least").alias("b")))
            .distinct()
        )
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = seen
