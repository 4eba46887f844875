"""Changing tables: merge, delete, append and update by condition.

A target may hold any number of rows per key, and one key may hold a large part
of it. So the target is always the left side of a join against one row per key.
Changes small enough to be broadcast leave the target unshuffled; else the
adaptive skew join splits the target's hot partitions. Which changes are inserts
is found from the target's keys alone, reduced before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, named
from tidemark.functions.conditions import (
    Conditions,
    column_of,
    condition_pairs,
    predicate,
    typed_literal,
)
from tidemark.operators.decode import row_images
from tidemark.operators.fold import net_changes
from tidemark.table import DELETED, GONE, POS, TableSpec


def same_key(keys: tuple[str, ...], left: str, right: str) -> Column:
    return all_of([named(k, left) == named(k, right) for k in keys])


def same_key_split(spec: TableSpec, left: str, right: str) -> Column:
    """Equal keys, in a join whose left side may be skewed.

    Spark splits skewed partitions only where a join shuffles both of its
    sides. The right side comes partitioned by the key already; the key's hash
    as a second join key makes the join shuffle it again.
    """
    hashes = [F.xxhash64(*[named(k, side) for k in spec.keys]) for side in (left, right)]
    return same_key(spec.keys, left, right) & (hashes[0] == hashes[1])


def conform(target: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns in its types and order, and positions if it has any."""
    cells = [
        named(column_of(target, f.name)).cast(f.dataType).alias(f.name) for f in spec.schema.fields
    ]
    return target.select(*cells, *[POS for c in target.columns if c == POS])


def can_be_broadcast(df: DataFrame) -> bool:
    """Whether Spark's size estimate lets it broadcast the DataFrame."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def merge_unique(state: DataFrame, net: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply one change per key to rows with unique keys, by one join that meets
    every row once. Delete markers are rows here, and the result has them.

    The later position wins; a row without one is older than any change. Rows
    with a null in the key meet nothing and stay.
    """
    markers = DELETED in state.columns
    new = F.col(f"n.{POS}")
    hit = new.isNotNull()
    if POS in state.columns:
        held = F.col(f"t.{POS}")
        hit = hit & (held.isNull() | (new > held))

    def cell(c: str) -> Column:
        if c in spec.keys:
            return F.coalesce(named(c, "t"), named(c, "n")).alias(c)
        return F.when(hit, named(c, "n")).otherwise(named(c, "t")).alias(c)

    met = state.alias("t").join(net.alias("n"), same_key(spec.keys, "t", "n"), "full_outer")
    columns = [cell(c) for c in state.columns]
    if markers:
        return met.select(*columns)
    deleted = hit & F.col(f"n.{DELETED}")
    return met.where(~F.coalesce(deleted, F.lit(False))).select(*columns)


def merge(target: DataFrame, net: DataFrame, spec: TableSpec) -> DataFrame:
    """Apply one change per key: every matching row is replaced or deleted, a
    change without a match is inserted unless it is a delete.

    Rows older than the key's last delete are gone even if the key came back
    later; it comes back as one row. So of rows that were changed since a delete
    one is left: they were there before the change. Where the target keeps feed
    positions, a change or delete older than the row it meets does nothing else.
    """
    target = conform(target, spec)
    new, gone, deleted = F.col(f"n.{POS}"), F.col(f"n.{GONE}"), F.col(f"n.{DELETED}")
    hit, removed = new.isNotNull(), gone.isNotNull()
    returned = F.lit(False)
    if guarded := POS in target.columns:
        held = F.col(f"t.{POS}")
        hit = hit & (held.isNull() | (new > held))
        removed = removed & (held.isNull() | (gone > held))
        returned = F.coalesce(gone < held, F.lit(False))

    def cell(c: str) -> Column:
        # equal on both sides; taken from the target, conditions reach its scan
        if c in spec.keys:
            return named(c, "t")
        return F.when(hit, named(c, "n")).otherwise(named(c, "t")).alias(c)

    met = target.alias("t").join(net.alias("n"), same_key_split(spec, "t", "n"), "left")
    cells = [cell(c) for c in target.columns]
    kept = met.where(~removed & ~returned).select(*cells)
    if guarded:
        # only rows whose key has a delete among the changes that came late
        back = met.where(~removed & returned).select(*cells)
        kept = kept.unionByName(back.dropDuplicates(list(spec.keys)))

    keys = [named(k) for k in spec.keys]
    narrow = target.select(*keys, *([POS] if guarded else []))
    present_key = same_key(spec.keys, "n", "t")
    if can_be_broadcast(net):
        # look for the few keys first; the target's other keys stay where they are
        surviving = narrow.alias("t").join(net.alias("n"), present_key & ~removed, "left_semi")
        present = surviving.select(*keys).distinct()
    else:
        # one row per key leaves each map task, and meets the changes where the
        # fold has put them
        present = narrow.groupBy(*keys).agg(F.max(POS).alias(POS)) if guarded else narrow.distinct()
        present_key = present_key & ~removed
    missing = (
        net.alias("n").where(~deleted).join(present.alias("t"), present_key, "left_anti")
    )
    inserted = missing.select(*[named(c, "n").alias(c) for c in target.columns])
    return kept.unionByName(inserted)


def apply_changes(target: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The target after any number of changes per key; the changes are read
    once. Those with null keys meet nothing, so they are inserted."""
    net = net_changes(changes, spec)
    if spec.unique:
        return merge_unique(conform(target, spec), net, spec)
    return merge(target, net, spec)


def delete_by_key(target: DataFrame, gone: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows whose key is not among the deleted ones."""
    target = conform(target, spec)
    gone = gone.select(*[named(k) for k in spec.keys]).distinct()
    return target.alias("t").join(gone.alias("g"), same_key_split(spec, "t", "g"), "left_anti")


def append_log(target: DataFrame, decoded: DataFrame) -> DataFrame:
    """The table with every row image added, without matching keys."""
    return target.unionByName(row_images(decoded))


def filter_by_conditions(target: DataFrame, conditions: Conditions) -> DataFrame:
    return target.where(predicate(target, conditions))


def updated(
    target: DataFrame, conditions: Conditions, updates: Mapping[str, object], where: Column | None
) -> DataFrame:
    """Columns set to constants, where the condition holds or everywhere;
    columns used in ``conditions`` are left as they are."""
    fixed = {column_of(target, c) for c, _ in condition_pairs(conditions)}
    new = {column_of(target, c): v for c, v in updates.items()}

    def cell(c: str) -> Column:
        if c not in new or c in fixed:
            return named(c)
        value = typed_literal(target, c, new[c])
        if where is not None:
            value = F.when(where, value).otherwise(named(c))
        return value.alias(c)

    return target.select(*[cell(c) for c in target.columns])


def keyed_update(
    target: DataFrame, conditions: Conditions, updates: Mapping[str, object]
) -> DataFrame:
    """Set columns on the rows that meet the conditions; keep all other rows.
    Columns used in the conditions are left as they are."""
    return updated(target, conditions, updates, predicate(target, conditions))


def keyed_update_overwrite(
    target: DataFrame, conditions: Conditions, updates: Mapping[str, object]
) -> DataFrame:
    """Only the rows that meet the conditions, changed; all others are lost."""
    return updated(filter_by_conditions(target, conditions), conditions, updates, None)
