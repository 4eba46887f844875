"""Many changes per key to the last one.

Where no source order is declared, offsets are compared within a partition only:
a key belongs to the last partition that has a change for it, by topic and
number, and changes from others do not count. ``moved_changes`` names those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, any_of, named
from tidemark.operators.decode import MOVED_KEY, all_records, changes, rejects
from tidemark.table import DELETED, GONE, POS, REJECTED, TableSpec


def null_key(spec: TableSpec) -> Column:
    return any_of([F.lit(False)] + [named(k).isNull() for k in spec.keys])


def _folded(changes: DataFrame, spec: TableSpec, *apart: Column) -> DataFrame:
    """The last change of each group of equal keys (and equal values of ``apart``)
    and the position of its last delete, in the columns of the changes.

    ``max_by`` is combined in every map task before the shuffle, so a key
    holding most of the feed costs its reducer one row per map task.
    """
    keys = [named(k) for k in spec.keys]
    rest = [c for c in changes.columns if c not in (*spec.keys, GONE)]
    parts = [F.max_by(F.struct(*[named(c) for c in rest]), F.col(POS)).alias("_last")]
    if GONE in changes.columns:
        parts.append(F.max(GONE).alias(GONE))
    last = changes.groupBy(*keys, *apart).agg(*parts)

    def value(c: str) -> Column:
        if c != GONE:
            return named(c, "_last")
        if spec.order_column:
            return F.col(GONE)
        # a delete in another partition than the last change says nothing of it
        here = [F.col(f"{GONE}.{p}") == F.col(f"_last.{POS}.{p}") for p in ("topic", "partition")]
        return F.when(all_of(here), F.col(GONE))

    # A generator is not cut down to the columns in use, so every use of the
    # result needs the very same shuffle, and Spark runs it once for all. Keys
    # pass beside it, for the sake of their partitioning; with null keys there
    # is none, and joins would filter them below the shuffle.
    others = [value(c).alias(c) for c in changes.columns if c not in spec.keys]
    if apart:
        listed = last.select(F.inline(F.array(F.struct(*keys, *others))))
    else:
        listed = last.select(*keys, F.inline(F.array(F.struct(*others))))
    return listed.select(*[named(c) for c in changes.columns])


def last_per_key(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The last change for each key, and beside it the position of the key's
    last delete. The result is partitioned by the key, which a merge can use.

    A key with a null in it equals nothing; see ``net_changes``.
    """
    return _folded(changes.where(~null_key(spec)), spec)


def net_changes(changes: DataFrame, spec: TableSpec, *apart: Column) -> DataFrame:
    """The last change for each key, and each row that has a null in its key:
    these are rows of their own, told by their position and kept once. Keys are
    folded for themselves wherever the columns ``apart``, as a table's name, differ."""
    if not spec.null_keys:
        return _folded(changes.where(~null_key(spec)), spec, *apart)
    return _folded(changes, spec, F.when(null_key(spec), F.col(POS)).alias("_alone"), *apart)


def rows_after(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The table that the changes alone leave behind."""
    return net_changes(changes, spec).where(~F.col(DELETED)).select(*[named(c) for c in spec.columns])


def moved_changes(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Without a source order: the last changes in partitions that their keys do
    not belong to. They are not applied."""
    place = [F.col(f"{POS}.topic"), F.col(f"{POS}.partition")]
    keys = [named(k) for k in spec.keys]
    complete = changes.where(~null_key(spec))
    each = complete.groupBy(*keys, *place).agg(F.max(POS).alias(POS))
    homes = each.groupBy(*keys).agg(
        F.max(F.struct(*place)).alias("_home"), F.collect_list(POS).alias("_all")
    )
    listed = homes.select(*keys, "_home", F.explode("_all").alias(POS))
    here = F.struct(F.col(f"{POS}.topic").alias("topic"), F.col(f"{POS}.partition").alias("partition"))
    return listed.where(here != F.col("_home")).select(*keys, POS)


def set_aside(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    """All records of a batch that do not reach the table, with the reason: those that cannot
    be applied and, without a source order, a key's last changes in partitions it has left."""
    found = rejects(decoded)
    if spec.order_column:
        return found
    place = [F.col(f"{POS}.{c}") for c in ("topic", "partition", "offset")]
    moved = moved_changes(changes(decoded), spec).select(
        *place,
        F.lit(MOVED_KEY).alias("action"),
        F.to_json(F.struct(*[named(k) for k in spec.keys])).alias("raw_key"),
        F.lit(None).cast("string").alias("raw_value"),
    )
    return found.unionByName(moved)


def batch_outcome(decoded: DataFrame, spec: TableSpec, table: Column | None = None) -> DataFrame:
    """All that a batch amounts to, in one pass and one shuffle: the last change
    per key (in each partition that has one, where no source order is declared),
    the rows with null keys, and the rejected records (``_rejected``) with their
    reason and raw texts. With ``table``, a name made from ``topic``, the same for
    each table, as a further column ``_table``."""
    records = all_records(decoded)
    # a record that stands alone is a group of its own
    apart = [F.when(F.col(REJECTED) | null_key(spec), F.col(POS)).alias("_alone")]
    if not spec.order_column:
        apart += [F.col(f"{POS}.topic"), F.col(f"{POS}.partition")]
    if table is None:
        return _folded(records, spec, *apart)
    columns = records.columns
    routed = records.select("*", F.col(f"{POS}.topic").alias("topic")).select(*columns, table.alias("_table"))
    return _folded(routed, spec, *apart, F.col("_table"))
