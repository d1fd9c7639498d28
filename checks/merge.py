"""Newest change, late-row filter, merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.operators.changes import after_checkpoint, latest_change, merge_actions, merge_changes
from checks.common import (
    CHECKPOINT, LATEST_SQL, MERGED_ORDERS_SQL, ORDER_CHANGES_SQL, ORDER_COLUMNS, order_changes, table,
)

PK = ["o_orderkey"]


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(table(spark, sf_dir, "orders"))
    return latest_change(after_checkpoint(changes, CHECKPOINT), PK)


def q_latest_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir).select(
        F.col("cdc_flag").alias("flag"), F.col("cdc_commit_ts").cast("bigint").alias("ts"), *ORDER_COLUMNS
    )


def q_latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return latest_change(events, ["user_id"], ts="ts", tie_break=["event_id"]).select(
        "user_id", "event_id", "event_type", "value"
    )


def q_merge_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_changes(table(spark, sf_dir, "orders"), _latest(spark, sf_dir), PK)


def q_merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_actions(table(spark, sf_dir, "orders"), _latest(spark, sf_dir), PK)


def q_merge_composite_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    e = F.col("event_id")
    changes = events.withColumn("value", F.when(e % 5 == 1, F.col("value") * 2).otherwise(F.col("value"))).withColumns({
        "cdc_flag": F.when(e % 5 == 0, "D").when(e % 5 == 2, F.lit(None)).otherwise("U"), "cdc_commit_ts": e.cast("decimal(20,0)")})
    return merge_changes(events, latest_change(changes, ["user_id", "ts"]), ["user_id", "ts"])


def q_checkpoint_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(table(spark, sf_dir, "orders"))
    return after_checkpoint(changes, CHECKPOINT).select(
        F.col("cdc_flag").alias("flag"), F.col("cdc_commit_ts").cast("bigint").alias("ts"), "o_orderkey"
    )


def q_replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the changes, then all of them again: the same table as once."""
    orders = table(spark, sf_dir, "orders")
    changes = after_checkpoint(order_changes(orders), CHECKPOINT)
    half = merge_changes(orders, latest_change(changes.where(F.col("cdc_commit_ts") % 2 == 0), PK), PK)
    return merge_changes(half, latest_change(changes, PK), PK)


QUERIES = {
    "latest_change": q_latest_change,
    "latest_per_user": q_latest_per_user,
    "merge_apply": q_merge_apply,
    "merge_actions": q_merge_actions,
    "merge_composite_pk": q_merge_composite_pk,
    "checkpoint_filter": q_checkpoint_filter,
    "replay_idempotent": q_replay_idempotent,
}

ORACLES = {
    "latest_change": f"WITH ch AS ({ORDER_CHANGES_SQL}) {LATEST_SQL}",
    "latest_per_user": """
        SELECT user_id, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "merge_apply": MERGED_ORDERS_SQL,
    "merge_actions": f"""
        WITH ch AS ({ORDER_CHANGES_SQL}), latest AS ({LATEST_SQL})
        SELECT CASE WHEN o.o_orderkey IS NOT NULL AND l.flag = 'D' THEN 'delete' WHEN l.flag = 'D' THEN 'ignore'
                    WHEN o.o_orderkey IS NOT NULL THEN 'update' ELSE 'insert' END AS action, count(*) AS n_rows
        FROM latest l LEFT JOIN orders o USING (o_orderkey) GROUP BY 1""",
    "merge_composite_pk": """
        WITH latest AS (
          SELECT CASE event_id % 5 WHEN 0 THEN 'D' WHEN 2 THEN NULL ELSE 'U' END AS flag, * REPLACE (CASE WHEN event_id % 5 = 1 THEN value * 2 ELSE value END AS value)
          FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
        SELECT e.* FROM events e JOIN latest l ON e.user_id = l.user_id AND e.ts = l.ts WHERE l.flag IS NULL
        UNION ALL SELECT * EXCLUDE (flag) FROM latest WHERE flag <> 'D'""",
    "checkpoint_filter": f"WITH ch AS ({ORDER_CHANGES_SQL}) SELECT flag, ts, o_orderkey FROM ch WHERE ts > {CHECKPOINT}",
    "replay_idempotent": MERGED_ORDERS_SQL,
}
