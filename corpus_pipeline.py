"""Training-data pipeline over the documents table: filter, deduplicate, decontaminate and pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept, read from the Parquet files that one wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reefgrid.llm.common import ready, stored, table
from reefgrid.llm.decontaminate import decontaminated
from reefgrid.llm.linespread import without_boilerplate
from reefgrid.llm.minmax import without_near_duplicates
from reefgrid.llm.packing import pack_documents
from reefgrid.llm.toxicity import without_toxic

#: No DuckDB text: the models' scores and the tokenizer are beyond SQL.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return without_toxic(docs, table(ready(spark), sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand on many sites."""
    ready(spark)
    return without_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five-word shingles with a similarity of 0.8 or more."""
    ready(spark)
    return without_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminated(docs, table(ready(spark), sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids, placed in sequences."""
    ready(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity), ("line dedup", line_dedup), ("near dedup", near_dedup), ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
