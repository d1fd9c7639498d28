"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common
from cdclake.sources import storage


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); component is the least id that it reaches.

    Each round joins a node's neighbours to the least one (larger neighbours first, then
    smaller ones), and halves what is left in depth; edges only ever get fewer. A node
    with very many neighbours is combined before the shuffle, and its join is split. Only the
    last round's table stays.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now, before, step = common.written(now, f"{folder}/0"), None, 0
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        before, step = state, step + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = common.written(small, f"{folder}/{step}")
        storage.delete(edges.sparkSession, f"{folder}/{step - 1}")
