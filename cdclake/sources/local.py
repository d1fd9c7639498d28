"""Small driver-side rows (configuration, cursors, progress) as DataFrames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Rows given as dicts, built by the JVM from one literal.

    Needs no Python worker, unlike parallelizing a list.
    """
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    return local_rows(spark, [], schema)
