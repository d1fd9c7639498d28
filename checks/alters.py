"""Schema changes that go through whole rounds over orders: defaults, nullability, rejected and other DDL, initial schemas."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta
from cdclake.operators import evolve as ev
from cdclake.plans import progress as pg
from cdclake.plans import replicate as rp
from cdclake.sources import csvio, storage
from checks.common import CHECKPOINT, LATEST_SQL, MERGED_ORDERS_SQL, ORDER_CHANGES_SQL, ORDER_COLUMNS, ORDERS_META, order_changes, table
from checks.rounds import FQN, PUBLISHED, _by_key, _lake, _publish

#: Status must be there, and priorities have a default.
STRICT = dataclasses.replace(ORDERS_META, columns=tuple(
    dataclasses.replace(c, nullable=False) if c.name == "o_orderstatus" else dataclasses.replace(c, default="9-NONE", default_kind="literal") if c.name == "o_orderpriority" else c
    for c in ORDERS_META.columns))
WITH_NOTE = dataclasses.replace(STRICT, columns=(*STRICT.columns, ColumnMeta("note", "varchar", "8", nullable=False, default="none", default_kind="literal")))


def q_evolve_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A default set, a null forbidden, and then a column whose default fills what is stored: three versions, two rounds."""
    orders = table(spark, sf_dir, "orders")
    s = _lake(spark)
    _publish(spark, s, orders)
    csvio.write_schema_epoch(spark, s.source, STRICT, 3000, "ALTER TABLE orders MODIFY COLUMN o_orderstatus CHAR(1) NOT NULL, ALTER COLUMN o_orderpriority SET DEFAULT '9-NONE'", 70)
    rp.replicate(spark, s)
    stored = {c.name: c for c in pg.load_table(spark, s.target, FQN).meta.columns}
    if stored["o_orderstatus"].nullable or stored["o_orderpriority"].default != "9-NONE":
        raise AssertionError("the stored schema does not follow the change")
    csvio.write_schema_epoch(spark, s.source, WITH_NOTE, 4000, "ALTER TABLE orders ADD COLUMN note VARCHAR(8) NOT NULL DEFAULT 'none'", 5)
    csvio.write_checkpoint(spark, s.source, PUBLISHED + 1)
    rp.replicate(spark, s)
    return rp.read_target(spark, s, FQN)


def q_ddl_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DDL that no target can follow fails the round, and nothing moves; a dropped table is gone."""
    s = _lake(spark)
    _publish(spark, s, table(spark, sf_dir, "orders"))
    rp.replicate(spark, s, "snapshot-only")
    for version, query, action in ((3000, "RENAME TABLE orders TO sales", ev.RENAME_TABLE), (3001, "CREATE TABLE orders LIKE sales", ev.CREATE_TABLE)):
        path = csvio.write_schema_epoch(spark, s.source, ORDERS_META, version, query, action)
        try:
            rp.apply_round(spark, s)
        except ev.UnsupportedChange:
            storage.delete(spark, path)
        else:
            raise AssertionError(f"applied: {query}")
    state = pg.load(spark, s.target, s.tables)
    if (state.checkpoint_ts, state.tables[FQN].batch, state.tables[FQN].watermark) != (CHECKPOINT, 1, 0):
        raise AssertionError("a rejected change moved the progress")
    rows = rp.read_target(spark, s, FQN)
    csvio.write_schema_epoch(spark, s.source, ORDERS_META, PUBLISHED + 1, "DROP TABLE orders", ev.DROP_TABLE)
    csvio.write_checkpoint(spark, s.source, PUBLISHED + 2)
    rp.replicate(spark, s)
    try:
        rp.read_target(spark, s, FQN)
    except ValueError:
        return rows  # a held reader keeps its version
    raise AssertionError("a dropped table was read")


def q_ddl_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a snapshot: the first schema is the table; indexes and other databases change nothing; applied versions are skipped."""
    orders = table(spark, sf_dir, "orders")
    s = _lake(spark)
    csvio.write_schema_epoch(spark, s.source, ORDERS_META, 1000)
    csvio.write_schema_epoch(spark, s.source, ORDERS_META, 2000, "ALTER TABLE orders ADD INDEX by_customer (o_custkey), COMMENT = 'drop column x'", 7)
    csvio.write_schema_epoch(spark, s.source, ORDERS_META, 2500, "DROP DATABASE archive", ev.DROP_SCHEMA)
    changes = order_changes(orders)
    early = F.col("cdc_commit_ts") <= 3000
    csvio.write_change_files(spark, _by_key(changes.where(early)), s.source, ORDERS_META, 1000, "2026-07-01")
    csvio.write_checkpoint(spark, s.source, 900)  # below every change
    rp.replicate(spark, s, "incremental-only")
    seen = pg.load_table(spark, s.target, FQN).watermark
    csvio.write_change_files(spark, _by_key(changes.where(~early)), s.source, ORDERS_META, 2500, "2026-07-02")
    csvio.write_checkpoint(spark, s.source, PUBLISHED)
    (result,) = rp.replicate(spark, s, "incremental-only")
    if (seen, pg.load_table(spark, s.target, FQN).watermark) != (2500, 2500) or result.active_tables != 1:
        raise AssertionError("an applied version was applied again")
    return rp.read_target(spark, s, FQN)


def q_half_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without their metadata are no snapshot; with it they are."""
    s = _lake(spark)
    csvio.write_snapshot(spark, table(spark, sf_dir, "orders"), s.source, ORDERS_META, CHECKPOINT)
    text = storage.read_text(spark, f"{s.source}/snapshot/metadata")
    storage.delete(spark, f"{s.source}/snapshot/metadata")
    try:
        rp.replicate(spark, s, "snapshot-only")
    except ValueError as e:
        if "not complete" not in str(e):
            raise
    else:
        raise AssertionError("half a snapshot was loaded")
    storage.write_text(spark, f"{s.source}/snapshot/metadata", text)
    rp.replicate(spark, s, "snapshot-only")
    return rp.read_target(spark, s, FQN)


QUERIES = {
    "evolve_defaults": q_evolve_defaults,
    "ddl_rejected": q_ddl_rejected,
    "ddl_other": q_ddl_other,
    "half_snapshot": q_half_snapshot,
}

ORACLES = {
    "evolve_defaults": f"SELECT *, 'none' AS note FROM ({MERGED_ORDERS_SQL})",
    "ddl_rejected": "SELECT * FROM orders",
    "ddl_other": f"""
        WITH ch AS ({ORDER_CHANGES_SQL}), latest AS ({LATEST_SQL.replace(f"ts > {CHECKPOINT}", "ts > 0")})
        SELECT {', '.join(ORDER_COLUMNS)} FROM latest WHERE flag <> 'D'""",
    "half_snapshot": "SELECT * FROM orders",
}
