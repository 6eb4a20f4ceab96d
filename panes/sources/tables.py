"""Parquet tables of a scale-factor folder (test inputs and stand-ins)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` as a DataFrame (lazy; pruned and pushed down)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))

