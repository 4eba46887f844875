"""What a target table looks like: its name, columns and key."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Bookkeeping columns next to a table's own columns: the feed position of the
# last change, whether that was a delete, the position of the last delete, and
# whether the record was rejected.
POS = "_pos"
DELETED = "_deleted"
GONE = "_gone"
REJECTED = "_rejected"
#: The order key of a record, where it is taken from the record's own log numbers.
COMMIT = "_commit"
EPOCH_UNITS = ("s", "ms", "us", "days")
ENCODINGS = ("base64", "hex")
RESERVED = {POS, DELETED, GONE, REJECTED, "_record", "_last", "_alone", "_hit", "_home", "_all", COMMIT}



def position_type(time: T.DataType) -> T.StructType:
    """Where a record stood in the feed. Struct order is also the order in which
    changes win: by the declared source order (0 where none is declared), then by
    topic and partition, then by offset, which tells time only within a partition."""
    return T.StructType(
        [
            T.StructField("time", time),
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
        ]
    )


@dataclass(frozen=True)
class TableSpec:
    """A target table. Column names are matched without regard to case.

    A column that is not nullable makes upserts without it bad values. Keys
    should be declared so: null keys are rows of their own.

    ``order_by`` names a column of the feed (a record timestamp, a log sequence
    number) by which changes of one key are ordered wherever they come from.
    ``source_order`` takes the order from the records themselves: the fields of
    ``payload.source`` that make it up, first things first, and what they are
    (``hex`` groups or a ``number``), as in
    ``{"commit_lsn": "hex", "change_lsn": "hex", "event_serial_no": "number"}``.
    Without either a key belongs to one partition of one topic: the last one by
    name and number that has a change for it.

    ``unique`` says that no two rows of the target have the same key, which
    makes a merge one join.

    ``epochs`` gives the unit (s, ms, us, days) of columns of dates and times
    that the feed carries as numbers, ``encodings`` how it writes columns of
    bytes (base64, hex; else they are the text's own).

    ``check_allowed`` holds row images against the lists of allowed values in the
    schemas that the records carry.
    """

    name: str
    schema: T.StructType | str
    keys: tuple[str, ...]
    upsert_ops: tuple[str, ...] = ("c", "u")
    order_by: str | None = None
    source_order: Mapping[str, str] = field(default_factory=dict, hash=False)
    unique: bool = False
    epochs: Mapping[str, str] = field(default_factory=dict, hash=False)
    encodings: Mapping[str, str] = field(default_factory=dict, hash=False)
    check_allowed: bool = False

    def __post_init__(self):
        if not self.name:
            raise ValueError("a table needs a name")
        schema = self.schema
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        keys = (self.keys,) if isinstance(self.keys, str) else tuple(self.keys)
        spelled = {f.name.lower(): f.name for f in schema.fields}
        if not spelled or len(spelled) != len(schema.fields):
            raise ValueError(f"{self.name}: columns must be given and differ by more than case")
        if reserved := RESERVED & set(spelled):
            raise ValueError(f"{self.name}: reserved column names {sorted(reserved)}")
        if not keys or len({k.lower() for k in keys}) != len(keys):
            raise ValueError(f"{self.name}: key columns must be given once each")
        if unknown := [k for k in keys if k.lower() not in spelled]:
            raise ValueError(f"{self.name}: key columns {unknown} are not in the table")
        if not self.upsert_ops:
            raise ValueError(f"{self.name}: at least one upsert operation is needed")
        if self.order_by and self.source_order:
            raise ValueError(f"{self.name}: changes are ordered in one way")
        if odd := [kind for kind in self.source_order.values() if kind not in ("hex", "number")]:
            raise ValueError(f"{self.name}: no order by {odd}")
        epochs = {spelled.get(c.lower(), c): unit for c, unit in self.epochs.items()}
        for column, unit in epochs.items():
            if column not in schema.names or unit not in EPOCH_UNITS:
                raise ValueError(f"{self.name}: no column {column!r} with a unit {unit!r}")
        encodings = {spelled.get(c.lower(), c): how for c, how in self.encodings.items()}
        for column, how in encodings.items():
            if column not in schema.names or how not in ENCODINGS or not isinstance(schema[column].dataType, T.BinaryType):
                raise ValueError(f"{self.name}: no column {column!r} of bytes in {how!r}")
        object.__setattr__(self, "epochs", epochs)
        object.__setattr__(self, "encodings", encodings)
        object.__setattr__(self, "schema", schema)
        object.__setattr__(self, "keys", tuple(spelled[k.lower()] for k in keys))
        object.__setattr__(self, "upsert_ops", tuple(self.upsert_ops))

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def order_column(self) -> str | None:
        """The feed's column that tells the order of changes, if there is one."""
        return COMMIT if self.source_order else self.order_by

    @property
    def position(self) -> T.StructType:
        return position_type(T.BinaryType() if self.source_order else T.LongType())

    @property
    def null_keys(self) -> list[str]:
        """The key columns that may be null."""
        return [k for k in self.keys if self.schema[k].nullable]

    @property
    def state_schema(self) -> T.StructType:
        """The table's columns plus the bookkeeping columns, all nullable."""
        fields = [T.StructField(f.name, f.dataType) for f in self.schema.fields]
        kept = {POS: self.position, DELETED: T.BooleanType(), GONE: self.position}
        return T.StructType([*fields, *[T.StructField(n, t) for n, t in kept.items()]])
