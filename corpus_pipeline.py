"""From raw documents to packed sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panes.llm import stages
from panes.llm.common import write_table
from panes.sources.tables import table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", stages.keep_good),
    ("exact dedup", stages.keep_first_copies),
    ("MinHash near-dedup", stages.keep_one_of_near_copies),
    ("packing", stages.pack_sequences),
]

#: Learned weights and a tokenizer's ids cannot be expressed in SQL; tests/llm
#: checks the stages against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
