"""From raw documents to a training mix, stage by stage.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and gives
a DataFrame, which is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of documents.

* language ID: texts in no learned language go.
* SimHash near-dedup: of each component of near-duplicates the row with the
  least id stays.
* benchmark decontamination: documents that leak a benchmark item go.
* secret scans: secrets are replaced by a mark, and n_chars follows; no document
  goes.
* mixing: each document as often as the mix takes it, with the number of the copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, langid, mixing, secret_scan, simhash
from tidemark.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.recognised(docs, langid.learned_languages(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.without_secrets(docs, secret_scan.discovery_levels(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("mixing sources to target weights", source_mix),
]

#: Profiles, fingerprints and tests of randomness are beyond SQL; tests/llm compare the rows with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
