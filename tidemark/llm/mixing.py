"""Mixing sources to target weights by systematic sampling.

A mix has as many words as all documents together. Sources take turns through
`weights` in the order of their names (by code point, null last) and share the
words by weight, but none gets more than `most` times its own words: what is
over goes to the others by weight.

Within a source every document is expected `target / source_size` times. Its
documents stand in a fixed order, by size and then by a hash of the id; the
expected copies are summed along it, one random offset is added for the source,
and a document is emitted once for each integer that its part of the sum
crosses. Copies so differ by at most one between documents, and the words taken
from a source miss its target by about one large document.

Only DataFrame functions are used. A source may hold most of the rows: its
order is cut into pieces (size class and leading hash digits), rows are numbered
within pieces, and the pieces' counts are summed.

Defined results: a null text has size 0; documents of size 0 take 0 words but
keep their place; a null source is a source of its own; a null id sorts first
among its equals; rows that repeat an id are documents of their own, and which
of several identical rows is emitted more often does not show. A source without
words has target 0, and an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hex_to_long, row_key, stored, table, word_count

WEIGHTS = (5, 2, 1)
MOST = 3

#: The offset is a multiple of 2^-20, so that whole steps add up exactly.
OFFSET_DIGITS = 5


def _key(source: Column) -> Column:
    """Never null, and in the order of the sources: null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def size_class(size: Column) -> Column:
    """Eight classes to a doubling, by integer arithmetic; rises with the size."""
    bits = F.length(F.bin(size))
    fine = F.call_function("shiftright", size, F.greatest(bits - 4, F.lit(0))).cast("long")
    return F.when(size < 16, size).otherwise(bits * 8 + fine % 8).cast("long")


def _numbered(df: DataFrame) -> DataFrame:
    """Sources with `place` 0, 1, ... by name, without one task for all of them."""
    parts = stored(
        df.repartitionByRange("key").withColumn("part", F.spark_partition_id())
    )
    counts = parts.groupBy("part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    return parts.withColumn("inside", inside).join(starts, "part").select(
        *df.columns, (F.col("start") + F.col("inside") - 1).alias("place")
    )


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row a source: key, source, source_size, target, rate, offset.

    sizes: source and size of each document. The level, words per unit of
    weight, is raised until no further source is above `most` times its size:
    one aggregation of the sources for each round, one row to the driver.
    """
    grouped = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    places = _numbered(grouped.withColumn("key", _key(F.col("source"))))
    shares = F.array(*[F.lit(w) for w in weights])
    weighed = stored(
        places.select(
            "key",
            "source",
            "source_size",
            F.element_at(shares, (F.col("place") % len(weights) + 1).cast("int")).cast("long").alias("weight"),
        )
    )
    cap = F.col("source_size") * most
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, above = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > cap
        now = weighed.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("filled"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
            F.coalesce(F.sum(full.cast("long")), F.lit(0)).alias("above"),
        ).first()
        if now.above == above or not now.open:
            break
        level, above = (total - now.filled) / now.open, now.above
    target = F.least(F.col("weight") * F.lit(float(level)), cap.cast("double"))
    digest = F.md5(F.concat(F.lit("mix:"), F.col("key")))
    offset = hex_to_long(F.substring(digest, 1, OFFSET_DIGITS)) / F.lit(float(16**OFFSET_DIGITS))
    return weighed.select(
        "key",
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
        offset.alias("offset"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies, taken.

    Reads the texts once, for their sizes. `carry` names further columns to keep.
    """
    kept = docs.select(
        F.col("doc_id"), "source", word_count(F.col("text")).alias("size"), F.struct(F.lit(0).alias("_"), *carry).alias("carried")
    )
    sized = stored(kept)
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = sized.select(
        "*",
        _key(F.col("source")).alias("key"),
        size_class(F.col("size")).alias("class"),
        order.alias("order"),
        F.substring(order, 1, 2).alias("lead"),
    )
    piece = ["key", "class", "lead"]
    along = Window.partitionBy("key").orderBy("class", "lead")
    before = F.sum("rows").over(along.rowsBetween(Window.unboundedPreceding, -1))
    pieces = (
        placed.groupBy(*piece)
        .agg(F.count("*").alias("rows"))
        .select(*piece, F.coalesce(before, F.lit(0)).alias("start"))
        .join(targets(sized, weights, most).drop("source"), "key")
    )
    inside = F.row_number().over(Window.partitionBy(*piece).orderBy("order", "doc_id"))
    place = F.col("start") + F.col("inside") - 1
    crossed = F.floor(F.col("offset") + F.col("rate") * (place + 1)) - F.floor(
        F.col("offset") + F.col("rate") * place
    )
    return (
        placed.withColumn("inside", inside)
        .join(pieces, piece)
        .withColumn("copies", F.least(crossed, F.lit(most)).cast("long"))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
            *[f"carried.{c}" for c in carry],
        )
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: each document's row once for each copy, with `copy` 1, 2, ...

    All columns are kept, but for one named `copy`, which this one replaces. Rows that repeat an id are told apart by text and
    source, and rows equal in these by their number.
    """
    key = row_key("text", "source").alias("row_key")
    chosen = (
        mix(docs.select("doc_id", "source", "text", key), weights, most, carry=("row_key",))
        .groupBy("row_key")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
        .filter("copies > 0")
    )
    own_columns = [docs[c] for c in docs.columns if c.lower() != "copy"]
    rows = docs.select(F.struct(*own_columns).alias("document"), key)
    # equal rows have copies that differ by one at most; the texts are shuffled once
    nth = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key"))
    own = F.expr("copies DIV rows + CAST(nth <= copies % rows AS BIGINT)")
    return (
        rows.join(chosen, "row_key")
        .withColumn("nth", nth)
        .select("document", own.cast("int").alias("own"))
        .filter("own > 0")
        .select("document", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("copy"))
        .select("document.*", "copy")
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the mix, with the words that it takes of each."""
    return mix(table(spark, sf_dir, "documents"))


_CLASS = """CASE WHEN size < 16 THEN size
    ELSE length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 4, 0)) % 8 END"""

#: The level is solved in one pass here: sources in the order in which they fill up.
OP4_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([5, 2, 1])[(place % 3) + 1]::BIGINT AS weight, {MOST} * source_size AS cap
  FROM sources),
filling AS (
  SELECT *, row_number() OVER o AS nth,
         coalesce(sum(cap) OVER before, 0)::BIGINT AS filled,
         sum(weight) OVER ()::BIGINT - coalesce(sum(weight) OVER before, 0)::BIGINT AS open,
         sum(source_size) OVER ()::BIGINT AS total
  FROM weighed
  WINDOW o AS (ORDER BY cap::DOUBLE / weight, place),
         before AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT (total - filled)::DOUBLE / open::DOUBLE AS level
  FROM filling WHERE weight * ((total - filled)::DOUBLE / open::DOUBLE) <= cap
  ORDER BY nth LIMIT 1),
targets AS (
  SELECT source, place, source_size,
         least(weight * (SELECT level FROM level), cap::DOUBLE) AS target,
         ('0x' || substr(md5('mix:' || coalesce('0' || source, '1')), 1, {OFFSET_DIGITS}))::BIGINT / {float(16**OFFSET_DIGITS)} AS u
  FROM weighed),
placed AS (
  SELECT doc_id, d.source, size, source_size, target, u,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY place ORDER BY {_CLASS},
             md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST) - 1 AS i
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, least(floor(u + rate * (i + 1)) - floor(u + rate * i), {MOST})::BIGINT AS copies
  FROM placed)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM mixed
"""
