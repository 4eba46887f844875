"""Topic lists and table names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_list(text: str) -> list[str]:
    """Topics of a comma-separated list, each once, in order of first mention."""
    return list(dict.fromkeys(t for t in (part.strip() for part in text.split(",")) if t))


def table_name(topic: Column) -> Column:
    """The table a topic goes to by name: dots to underscores, lower case."""
    return F.lower(F.translate(topic, ".", "_"))


def routed_name(
    topic: Column, routes: Mapping[str, str] | None = None, default: str | None = None
) -> Column:
    """The table a topic goes to: by the map, else the default, else by name."""
    fallback = F.lit(default) if default else table_name(topic)
    if not routes:
        return fallback
    chosen = None
    for source, table in routes.items():
        chosen = (F if chosen is None else chosen).when(topic == source, F.lit(table))
    return chosen.otherwise(fallback)
