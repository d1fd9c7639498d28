"""Change rows: late-row filter, newest change per key, merge, merge actions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cdclake.functions.types import quote
from cdclake.sources.csvio import POSITION

DELETE = "D"


def after_checkpoint(changes: DataFrame, checkpoint_ts: int, ts: str = "cdc_commit_ts") -> DataFrame:
    """Rows committed strictly after the stored checkpoint. No upper bound."""
    return changes.where(F.col(ts) > F.lit(checkpoint_ts).cast("decimal(20,0)"))


def latest_change(
    changes: DataFrame, pk: list[str], ts: str = "cdc_commit_ts", tie_break: list[str] | None = None,
) -> DataFrame:
    """The newest change of every key.

    Ranking by ``row_number() = 1`` is limited on both sides of the shuffle, so
    a key that holds a third of all changes leaves one row per map task.
    """
    order = [ts] + ([c for c in POSITION if c in changes.columns] if tie_break is None else tie_break)
    w = Window.partitionBy(*[F.col(quote(k)) for k in pk]).orderBy(*[F.col(c).desc() for c in order])
    return changes.withColumn("cdc_rank", F.row_number().over(w)).where("cdc_rank = 1").drop("cdc_rank")


def _joined(target: DataFrame, latest: DataFrame, pk: list[str], flag: str) -> DataFrame:
    """Target columns ``t0..`` and change columns ``s0..`` side by side.

    Columns stay flat, so whoever reads few of the result scans few.
    """
    names = target.columns
    t = target.select(F.lit(True).alias("t"), *[F.col(quote(c)).alias(f"t{i}") for i, c in enumerate(names)])
    s = latest.select(F.lit(True).alias("s"), F.col(flag).alias("flag"), *[F.col(quote(c)).alias(f"s{i}") for i, c in enumerate(names)])
    at = [names.index(k) for k in pk]
    return t.join(s, functools.reduce(Column.__and__, [F.col(f"t{i}") == F.col(f"s{i}") for i in at]), "full_outer")


def merge_action() -> Column:
    """What the merge does with a joined row."""
    t, s = F.col("t").isNotNull(), F.col("s").isNotNull()
    delete = F.col("flag") == DELETE
    return (
        F.when(~s, "keep")
        .when(F.col("flag").isNull(), F.when(t, "keep").otherwise("ignore"))
        .when(t & delete, "delete")
        .when(delete, "ignore")
        .when(t, "update")
        .otherwise("insert")
    )


def merge_changes(
    target: DataFrame, latest: DataFrame, pk: list[str], flag: str = "cdc_flag", observation: Observation | None = None,
) -> DataFrame:
    """Apply the newest changes to a table.

    One full outer join on the key: matched rows are updated or deleted,
    unmatched changes are inserted unless they are deletes. Null keys never
    match. ``observation`` receives the number of rows per action.
    """
    joined = _joined(target, latest, pk, flag).withColumn("action", merge_action())
    if observation is not None:
        joined = joined.observe(
            observation,
            *[F.count_if(F.col("action") == a).alias(a) for a in ("insert", "update", "delete", "ignore")],
        )
    keep = F.col("action") == "keep"
    return joined.where(~F.col("action").isin("delete", "ignore")).select(
        *[F.when(keep, F.col(f"t{i}")).otherwise(F.col(f"s{i}")).alias(c) for i, c in enumerate(target.columns)]
    )


def merge_actions(target: DataFrame, latest: DataFrame, pk: list[str], flag: str = "cdc_flag") -> DataFrame:
    """Rows affected by a merge, by action. Reads only keys and flags."""
    keys = target.select(*[F.col(quote(k)) for k in pk])
    joined = _joined(keys, latest, pk, flag).where(F.col("s").isNotNull())
    return joined.groupBy(merge_action().alias("action")).agg(F.count("*").alias("n_rows"))
