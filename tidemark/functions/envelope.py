"""Reading change records: JSON key and value envelopes to typed columns.

Each envelope is parsed once, into text by field name. Names then decide
whether the record fits the table, and the texts are cast to its types. Nothing
here raises on bad input: what does not fit becomes NULL, and no value is changed:
neither rounded, nor cut, nor left out of a nested one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import any_of

# The envelope's field names.
KEY_ENVELOPE = "payload MAP<STRING, STRING>"
VALUE_ENVELOPE = "payload STRUCT<op: STRING, after: MAP<STRING, STRING>>"


def key_payload(key: Column) -> Column:
    """Key columns as name -> text; NULL unless there is a payload object."""
    return F.from_json(key, KEY_ENVELOPE)["payload"]


def value_payload(value: Column) -> Column:
    """``op`` and the row image ``after`` as name -> text."""
    return F.from_json(value, VALUE_ENVELOPE)["payload"]


def has_payload_field(value: Column, field: str) -> Column:
    """Whether the payload names the field at all, be it null or not."""
    names = F.json_object_keys(F.get_json_object(value, "$.payload"))
    return F.coalesce(F.array_contains(names, field), F.lit(False))


class Fields:
    """The fields of a JSON object, looked up for a fixed list of columns.

    Feeds write fields in the table's order and spelling, new ones at the end,
    and then a field is found by its place. Any other layout is searched
    without regard to case.
    """

    def __init__(self, entries: Column, columns: list[str], prefix: str):
        self.columns = columns
        keys, width = F.map_keys(entries), len(columns)
        first = F.when(F.size(keys) == width, keys).otherwise(F.slice(keys, 1, width))
        in_order = F.coalesce(first == F.array(*[F.lit(c) for c in columns]), F.lit(False))
        plain = in_order & (F.size(keys) == width)
        # to be selected first; what follows works on these columns
        self.parts = [
            F.map_values(entries).alias(f"{prefix}_values"),
            in_order.alias(f"{prefix}_in_order"),
            F.when(~plain, F.transform(keys, F.lower)).alias(f"{prefix}_names"),
        ]
        self.values = F.col(f"{prefix}_values")
        self.in_order = F.col(f"{prefix}_in_order")
        self.names = F.col(f"{prefix}_names")

    def text(self, column: str) -> Column:
        """The text of a field; NULL if the object has none by that name."""
        place = F.array_position(self.names, column.lower()).cast("int")
        return F.when(
            self.in_order, F.get(self.values, F.lit(self.columns.index(column)))
        ).otherwise(F.get(self.values, place - 1))

    def complete(self) -> Column:
        """Whether every column is named, and no name comes twice."""
        wanted = F.array(*[F.lit(c.lower()) for c in self.columns])
        found = (F.size(F.array_except(wanted, self.names)) == 0) & (
            F.size(F.array_distinct(self.names)) == F.size(self.names)
        )
        plain = self.in_order & (F.size(self.values) == len(self.columns))
        return F.coalesce(plain | found, F.lit(False))

    def exact(self) -> Column:
        """Whether the columns are named and nothing else is."""
        return self.complete() & (F.size(self.values) == len(self.columns))


def epoch_to(text: Column, dtype: T.DataType, unit: str) -> Column:
    """A count of units since 1970 as a date or time, NULL where it is none."""
    number = text_to(text, T.LongType())
    if unit == "days":
        moment = F.date_from_unix_date(number.try_cast("int"))
    else:
        moment = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}[unit](number)
        if isinstance(dtype, T.TimestampNTZType):  # the clock in UTC, whatever the session's zone
            return F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast(dtype))
    return moment.cast(dtype)


def decimals_needed(text: Column) -> Column:
    """How many digits behind the point a number needs, written out without trailing
    zeros; below zero for 100. NULL or any number for what is no number."""
    whole, fraction = (F.regexp_extract(text, r"^\s*[-+]?([0-9]*)(?:\.([0-9]*))?", n) for n in (1, 2))
    exponent = F.regexp_extract(text, r"[eE]([-+]?[0-9]+)\s*$", 1).try_cast("int")
    digits = F.concat(whole, fraction)
    zeros = F.length(digits) - F.length(F.rtrim(digits, F.lit("0")))
    needed = F.length(fraction) - F.coalesce(exponent, F.lit(0)) - zeros
    return F.when(F.length(digits) == zeros, F.lit(0)).otherwise(needed)


def _exact_decimal(text: Column, dtype: T.DecimalType) -> Column:
    """NULL where the type has too few digits behind the point: casts would round."""
    plain = text.rlike(rf"^-?[0-9]+(\.[0-9]{{1,{dtype.scale}}})?$" if dtype.scale else "^-?[0-9]+$")
    return F.when(plain | (decimals_needed(text) <= dtype.scale), text.try_cast(dtype))


def _exact_whole(text: Column, dtype: T.IntegralType) -> Column:
    """3.0 and 1e3 are whole numbers too; 3.7 is none."""
    plain = text.rlike("^-?[0-9]+$")
    written_out = F.when(decimals_needed(text) <= 0, text.try_cast(T.DecimalType(38, 0)).try_cast(dtype))
    return F.when(plain, text.try_cast(dtype)).otherwise(written_out)


def _exact_date(text: Column) -> Column:
    """NULL for a moment within a day; its midnight is the day."""
    day = text.try_cast("date")
    moment = text.try_cast("timestamp_ntz")
    return F.when(~text.contains(":") | (moment == day.cast("timestamp_ntz")), day)


def _nested(text: Column, dtype: T.DataType) -> Column:
    """A JSON object or array; NULL if any part of it is no value of its type.

    Parts are taken as texts and read like cells. The lambda binds what has been
    parsed, which would be parsed for each part otherwise.
    """

    def bound(parsed: Column, build) -> Column:
        return F.get(F.transform(F.array(parsed), build), 0)

    def listed(items: Column, item_type: T.DataType) -> Column:
        read = F.transform(items, lambda x: F.struct(x.alias("text"), text_to(x, item_type).alias("cell")))
        good = bound(read, lambda r: F.when(~F.exists(r, _unreadable), F.transform(r, lambda x: x["cell"])))
        return F.when(items.isNotNull(), good)

    if isinstance(dtype, T.ArrayType):
        return listed(F.from_json(text, T.ArrayType(T.StringType())), dtype.elementType).cast(dtype)
    if isinstance(dtype, T.MapType):
        parsed = F.from_json(text, T.MapType(T.StringType(), T.StringType()))

        def mapped(m: Column) -> Column:
            keys, cells = listed(F.map_keys(m), dtype.keyType), listed(F.map_values(m), dtype.valueType)
            # texts that are the same key, as 1 and 1.0, make it no map
            distinct = F.size(F.array_distinct(keys)) == F.size(keys)
            return F.when(keys.isNotNull() & cells.isNotNull() & distinct, F.map_from_arrays(keys, cells))

        return bound(parsed, mapped).cast(dtype)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in dtype.fields])

    def built(parsed: Column) -> Column:
        cells = [text_to(parsed[f.name], f.dataType) for f in dtype.fields]
        bad = [parsed[f.name].isNotNull() & c.isNull() for f, c in zip(dtype.fields, cells)]
        bad += [parsed[f.name].isNull() for f in dtype.fields if not f.nullable]
        whole = F.struct(*[c.alias(f.name) for f, c in zip(dtype.fields, cells)])
        return F.when(parsed.isNotNull() & ~any_of([F.lit(False), *bad]), whole)

    # what is no object would be read as one without any field
    is_object = F.json_object_keys(text).isNotNull()
    return F.when(is_object, bound(F.from_json(text, texts), built)).cast(dtype)


def _unreadable(part: Column) -> Column:
    return part["text"].isNotNull() & part["cell"].isNull()


def text_to(text: Column, dtype: T.DataType, unit: str | None = None) -> Column:
    """JSON scalar text as a column type, NULL where it cannot be read as one exactly.

    ``unit`` says how the feed writes it otherwise: a unit of time for counts since
    1970, base64 or hex for bytes.
    """
    if isinstance(dtype, T.BinaryType):
        return F.try_to_binary(text, F.lit(unit)) if unit else text.cast(dtype)
    if unit:
        return epoch_to(text, dtype, unit)
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return _nested(text, dtype)
    if isinstance(dtype, T.VariantType):
        return F.try_parse_json(text)
    if isinstance(dtype, T.IntegralType):
        return _exact_whole(text, dtype)
    if isinstance(dtype, T.DecimalType):
        return _exact_decimal(text, dtype)
    if isinstance(dtype, T.DateType):
        return _exact_date(text)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # digits beyond microseconds would be cut off
        return F.when(~text.rlike(r"\.[0-9]{6}[0-9]*[1-9]"), text.try_cast(dtype))
    if isinstance(dtype, T.FractionalType):
        number = text.try_cast(dtype)  # the nearest one; too large ones would be endless
        endless = (F.abs(number) == F.lit(float("inf"))) & ~text.rlike("[iI]")
        return F.when(~endless, number)
    return text.try_cast(dtype)


def entries(document: Column) -> Column:
    """A flat JSON object as name -> text."""
    return F.from_json(document, "MAP<STRING, STRING>")
