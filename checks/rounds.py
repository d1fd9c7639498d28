"""Whole jobs over orders: snapshot load, several epochs, hand-off, stream."""

from __future__ import annotations

import copy
import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta
from cdclake.plans import progress as pg
from cdclake.plans import replicate as rp
from cdclake.sources import csvio, storage
from cdclake.streaming.rounds import start_rounds
from checks.common import CHECKPOINT, LATEST_SQL, MERGED_ORDERS_SQL, ORDER_CHANGES_SQL, ORDERS_META, order_changes, table

PUBLISHED = 10**12
FQN = "shop.orders"


def _lake(spark: SparkSession) -> rp.Settings:
    root = storage.scratch_dir(spark)
    return rp.Settings(f"{root}/source", f"{root}/target", [FQN], csv={"line_sep": "\n"})


def _by_key(changes: DataFrame) -> DataFrame:
    """Rows of one key in one file, in commit order, as the source writes them."""
    return changes.repartition("o_orderkey").sortWithinPartitions("cdc_commit_ts")


def _publish(spark: SparkSession, s: rp.Settings, orders: DataFrame) -> None:
    csvio.write_snapshot(spark, orders, s.source, ORDERS_META, CHECKPOINT)
    csvio.write_schema_epoch(spark, s.source, ORDERS_META, 1000)
    changes = order_changes(orders)
    early = F.col("cdc_commit_ts") % 2 == 0
    csvio.write_change_files(spark, _by_key(changes.where(early)), s.source, ORDERS_META, 1000, "2026-07-01")
    csvio.write_change_files(spark, _by_key(changes.where(~early)), s.source, ORDERS_META, 1000, "2026-07-02")
    csvio.write_checkpoint(spark, s.source, PUBLISHED)


def snapshot_source(spark: SparkSession, sf_dir: str) -> rp.Settings:
    s = _lake(spark)
    csvio.write_snapshot(spark, table(spark, sf_dir, "orders"), s.source, ORDERS_META, CHECKPOINT, "gzip")
    return s


def whole_source(spark: SparkSession, sf_dir: str) -> rp.Settings:
    s = _lake(spark)
    _publish(spark, s, table(spark, sf_dir, "orders"))
    return s


def replicated(spark: SparkSession, s: rp.Settings, mode: str) -> DataFrame:
    rp.replicate(spark, s, mode)
    return rp.read_target(spark, s, FQN)


def q_snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicated(spark, snapshot_source(spark, sf_dir), "snapshot-only")


def q_full_replication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replicated(spark, whole_source(spark, sf_dir), "all")


def q_second_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds from one state, the second with more changes: the first one's commit is the result."""
    orders = table(spark, sf_dir, "orders")
    s = _lake(spark)
    _publish(spark, s, orders)
    rp.replicate(spark, s, "snapshot-only")
    state = pg.load(spark, s.target, s.tables)
    rp.apply_round(spark, s, copy.deepcopy(state))
    late = order_changes(orders).withColumn("cdc_commit_ts", F.col("cdc_commit_ts") + PUBLISHED).withColumn("cdc_flag", F.lit("D"))
    csvio.write_change_files(spark, _by_key(late), s.source, ORDERS_META, 1000, "2026-07-03")
    csvio.write_checkpoint(spark, s.source, 3 * PUBLISHED)
    try:
        rp.apply_round(spark, s, copy.deepcopy(state))
    except pg.ProgressError:
        return rp.read_target(spark, s, FQN)
    raise AssertionError("both writers committed")


def q_read_while_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that is held while a round runs keeps the rows of its version."""
    s = _lake(spark)
    _publish(spark, s, table(spark, sf_dir, "orders"))
    rp.replicate(spark, s, "snapshot-only")
    held = rp.read_target(spark, s, FQN)
    rp.replicate(spark, s, "incremental-only")
    return held


def q_cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _lake(spark)
    _publish(spark, s, table(spark, sf_dir, "orders"))
    rp.replicate(spark, s, "snapshot-only")
    start_rounds(spark, s, s.target + "/_stream", every=None).awaitTermination()
    return rp.read_target(spark, s, FQN)


SECOND_META = dataclasses.replace(ORDERS_META, columns=(
    *ORDERS_META.columns[:5], ColumnMeta("priority", "varchar", "32"),
    ColumnMeta("channel", "varchar", "8", nullable=False, default="web", default_kind="literal")))
SECOND_QUERY = "ALTER TABLE orders CHANGE COLUMN o_orderpriority priority VARCHAR(32), ADD COLUMN channel VARCHAR(8) NOT NULL DEFAULT 'web'"


def epochs_source(spark: SparkSession, sf_dir: str) -> rp.Settings:
    """Files of changes before and after a schema change."""
    orders = table(spark, sf_dir, "orders")
    s = _lake(spark)
    _publish(spark, s, orders)
    second = orders.where("o_orderkey % 7 = 3").select(
        F.when(F.col("o_orderkey") % 2 == 0, "U").otherwise("D").alias("cdc_flag"), F.lit("orders").alias("cdc_table"),
        F.lit("shop").alias("cdc_schema"), (F.col("o_orderkey") + 5000).cast("decimal(20,0)").alias("cdc_commit_ts"),
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        F.lower("o_orderpriority").alias("priority"), F.lit("app").alias("channel"))
    csvio.write_schema_epoch(spark, s.source, SECOND_META, 4000, SECOND_QUERY, 70)
    csvio.write_change_files(spark, _by_key(second), s.source, SECOND_META, 4000, "2026-07-02")
    return s


def q_multi_epoch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes before and after a schema change, folded into one merge by one round."""
    s = epochs_source(spark, sf_dir)
    (result,) = rp.replicate(spark, s)
    if result.active_tables != 1:
        raise AssertionError("one round should have done it")
    return rp.read_target(spark, s, FQN)


QUERIES = {
    "snapshot_load": q_snapshot_load,
    "full_replication": q_full_replication,
    "cdc_stream": q_cdc_stream,
    "multi_epoch_apply": q_multi_epoch_apply,
    "second_writer": q_second_writer,
    "read_while_round": q_read_while_round,
}

ORACLES = {
    "second_writer": MERGED_ORDERS_SQL,
    "read_while_round": "SELECT * FROM orders",
    "snapshot_load": "SELECT * FROM orders",
    "full_replication": MERGED_ORDERS_SQL,
    "cdc_stream": MERGED_ORDERS_SQL,
    "multi_epoch_apply": f"""
        WITH ch AS ({ORDER_CHANGES_SQL}), latest AS ({LATEST_SQL})
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
               CASE WHEN o_orderkey % 7 = 3 THEN lower(o_orderpriority) ELSE o_orderpriority END AS priority,
               CASE WHEN o_orderkey % 7 = 3 THEN 'app' ELSE 'web' END AS channel
        FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest WHERE o_orderkey % 7 <> 3) AND (o_orderkey % 7 <> 3 OR o_orderkey % 2 = 0)
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'web' FROM latest WHERE flag <> 'D' AND o_orderkey % 7 <> 3""",
}
