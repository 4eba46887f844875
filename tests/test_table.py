"""What a table description accepts."""

import pytest

from tidemark.table import TableSpec


def test_names_are_spelled_as_in_the_schema(spark):
    spec = TableSpec("t", "ID BIGINT NOT NULL, Name STRING", ("id",))
    assert spec.keys == ("ID",) and spec.columns == ["ID", "Name"] and spec.null_keys == []


@pytest.mark.parametrize(
    "name, schema, keys, ops",
    [
        ("", "ID BIGINT", ("ID",), ("c",)),
        ("t", "ID BIGINT", (), ("c",)),
        ("t", "ID BIGINT", ("Name",), ("c",)),
        ("t", "ID BIGINT", ("ID", "id"), ("c",)),
        ("t", "ID BIGINT, id STRING", ("ID",), ("c",)),
        ("t", "ID BIGINT, _pos STRING", ("ID",), ("c",)),
        ("t", "ID BIGINT", ("ID",), ()),
    ],
)
def test_incomplete_descriptions_fail(spark, name, schema, keys, ops):
    with pytest.raises(ValueError):
        TableSpec(name, schema, keys, ops)
