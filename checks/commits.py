"""Commits per table, recovery, runs of changes, buckets that split, over orders and customers."""

from __future__ import annotations

import copy
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta, TableMeta
from cdclake.plans import progress as pg
from cdclake.plans import replicate as rp
from cdclake.sources import csvio, storage
from checks.common import CHECKPOINT, MERGED_ORDERS_SQL, ORDERS_META, order_changes, table
from checks.rounds import FQN, PUBLISHED, _by_key, _lake

CUSTOMERS = TableMeta("shop", "customer", (
    ColumnMeta("c_custkey", "bigint", nullable=False, is_pk=True), ColumnMeta("c_name", "varchar", "25"), ColumnMeta("c_nationkey", "int"),
    ColumnMeta("c_acctbal", "double"), ColumnMeta("c_mktsegment", "varchar", "16")), ("c_custkey",))


def _customer_changes(customers: DataFrame) -> DataFrame:
    """Every third customer goes, every other one moves to the next segment name."""
    k = F.col("c_custkey")
    return customers.select(
        F.when(k % 3 == 0, "D").otherwise("U").alias("cdc_flag"), F.lit("customer").alias("cdc_table"), F.lit("shop").alias("cdc_schema"),
        (k + 3000).cast("decimal(20,0)").alias("cdc_commit_ts"), "c_custkey", "c_name", "c_nationkey", "c_acctbal", F.lower("c_mktsegment").alias("c_mktsegment"))


def q_table_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers fail after orders have committed: orders are new before the restart, which does the rest."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    s = _lake(spark)
    s.tables, s.parallel_tables = [FQN, "shop.customer"], 1
    for rows, meta, changes in ((orders, ORDERS_META, order_changes(orders)), (customers, CUSTOMERS, _customer_changes(customers))):
        csvio.write_snapshot(spark, rows.select(*meta.names), s.source, meta, CHECKPOINT)
        csvio.write_schema_epoch(spark, s.source, meta, 1000)
        key = meta.names[0]
        csvio.write_change_files(spark, changes.repartition(key).sortWithinPartitions("cdc_commit_ts"), s.source, meta, 1000, "2026-07-01")
    broken = f"{s.source}/increment/shop/customer/1000/2026-07-02"
    storage.write_text(spark, f"{broken}/CDC000000000000001.csv", '"U","customer"\n')
    storage.write_text(spark, f"{broken}/meta/CDC.index", "CDC000000000000001.csv\n")
    csvio.write_checkpoint(spark, s.source, PUBLISHED)
    rp.replicate(spark, s, "snapshot-only")
    try:
        rp.apply_round(spark, s)
    except Exception:
        pass
    else:
        raise AssertionError("a broken file was loaded")
    after = rp.read_target(spark, s, FQN)
    state = pg.load(spark, s.target, s.tables)
    if state.checkpoint_ts != CHECKPOINT or state.tables[FQN].checkpoint_ts != PUBLISHED:
        raise AssertionError("orders alone should have been brought forward")
    storage.write_text(spark, f"{broken}/CDC000000000000001.csv", '"U","customer","shop","1","1","old","0","0.0","late"\n')
    (result,) = rp.replicate(spark, s)
    if FQN in result.rows:
        raise AssertionError("orders were merged twice")
    mine = rp.read_target(spark, s, "shop.customer")
    return after.select(F.lit("orders").alias("tbl"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("word")).unionByName(
        mine.select(F.lit("customer").alias("tbl"), F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("word")))


def _rounds(spark: SparkSession, sf_dir: str, rounds: int = 2, **settings) -> rp.Settings:
    """A snapshot, and the changes of orders in several rounds, split by commit time."""
    orders = table(spark, sf_dir, "orders")
    s = _lake(spark)
    for name, value in settings.items():
        setattr(s, name, value)
    csvio.write_snapshot(spark, orders, s.source, ORDERS_META, CHECKPOINT)
    csvio.write_schema_epoch(spark, s.source, ORDERS_META, 1000)
    rp.replicate(spark, s, "snapshot-only")
    changes = order_changes(orders)
    last = int(changes.agg(F.max("cdc_commit_ts")).first()[0])
    ends = [CHECKPOINT + (last - CHECKPOINT) * (k + 1) // rounds for k in range(rounds)]
    first = 1
    for low, high in zip([0, *ends], ends):
        part = changes.where((F.col("cdc_commit_ts") > low) & (F.col("cdc_commit_ts") <= high))
        first = csvio.write_change_files(spark, _by_key(part), s.source, ORDERS_META, 1000, "2026-07-01", first_index=first) + 1
        csvio.write_checkpoint(spark, s.source, high)
        if high != last:
            rp.replicate(spark, s)
    return s


def q_commit_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit file that was cut short, and two writers of one round: one of them commits, once."""
    s = _rounds(spark, sf_dir, 1)
    home = f"{s.target}/_progress/table={FQN.replace('.', '%2E')}"
    storage.write_text(spark, f"{home}/commit=2", "")
    storage.write_text(spark, f"{s.target}/_progress/all/commit=2", "\"row=2-")
    state = pg.load(spark, s.target, s.tables)

    def write(_):
        try:
            rp.apply_round(spark, s, copy.deepcopy(state))
            return 1
        except pg.ProgressError:
            return 0

    with ThreadPoolExecutor(2) as pool:
        done = sum(pool.map(write, range(2)))
    rp.replicate(spark, s)
    after = pg.load(spark, s.target, s.tables)
    if done > 1 or (after.batch, after.tables[FQN].batch) != (2, 2):
        raise AssertionError(f"{done} writers committed, batches {after.batch}, {after.tables[FQN].batch}")
    return rp.read_target(spark, s, FQN)


def q_delta_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds that write runs of changes only; reading merges them with the buckets."""
    s = _rounds(spark, sf_dir, 3, deltas=True, fold=100.0, runs=3)
    rp.replicate(spark, s)
    if [d.level for d in pg.load_table(spark, s.target, FQN).deltas] != [1]:
        raise AssertionError("three runs should have become one of the next level")
    return rp.read_target(spark, s, FQN)


def q_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs folded into the buckets; later runs lie on top of those."""
    s = _rounds(spark, sf_dir, 2, deltas=True, fold=100.0)
    rp.compact(spark, s, FQN)
    rp.replicate(spark, s)
    if not rp.compact(spark, s, FQN) or rp.compact(spark, s, FQN) or pg.load_table(spark, s.target, FQN).deltas:
        raise AssertionError("runs are left")
    return rp.read_target(spark, s, FQN)


def q_rebucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets split between two rounds, with a run on top."""
    s = _rounds(spark, sf_dir, 2, deltas=True, fold=100.0)
    before = pg.load_table(spark, s.target, FQN).buckets
    rp.rebucket(spark, s, FQN, 4)
    rp.replicate(spark, s)
    if pg.load_table(spark, s.target, FQN).buckets != 4 * before:
        raise AssertionError("buckets were not split")
    return rp.read_target(spark, s, FQN)


QUERIES = {
    "table_commit": q_table_commit,
    "commit_recovery": q_commit_recovery,
    "delta_read": q_delta_read,
    "compact": q_compact,
    "rebucket": q_rebucket,
}

ORACLES = {
    "table_commit": f"""
        SELECT 'orders' AS tbl, o_orderkey AS k, o_totalprice AS amount, o_orderpriority AS word FROM ({MERGED_ORDERS_SQL})
        UNION ALL SELECT 'customer', c_custkey, c_acctbal, lower(c_mktsegment) FROM customer WHERE c_custkey % 3 <> 0""",
    "commit_recovery": MERGED_ORDERS_SQL,
    "delta_read": MERGED_ORDERS_SQL,
    "compact": MERGED_ORDERS_SQL,
    "rebucket": MERGED_ORDERS_SQL,
}
