"""Schema evolution of orders and the classification of DDL texts."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta, TableMeta
from cdclake.operators import evolve as ev
from checks.common import ORDERS_META, table


def _next(*columns: ColumnMeta) -> TableMeta:
    return dataclasses.replace(ORDERS_META, columns=columns)


KEY, CUST, STATUS, PRICE, DATE, PRIORITY = ORDERS_META.columns
ADD_DROP = _next(KEY, CUST, STATUS, PRICE, DATE,
                 ColumnMeta("channel", "varchar", "12", nullable=False, default="web", default_kind="literal"),
                 ColumnMeta("note", "text"))
RENAMED = _next(KEY, dataclasses.replace(CUST, name="buyer", tp="decimal", precision="20", scale="0"), STATUS, PRICE, DATE,
                dataclasses.replace(PRIORITY, name="urgency", precision="24"))
MULTI = _next(KEY, CUST, dataclasses.replace(STATUS, name="state", tp="varchar", precision="6"), DATE, PRIORITY,
              ColumnMeta("booked_on", "date", default="2019-05-17", default_kind="literal"))

ADD_DROP_QUERY = "ALTER TABLE shop.orders ADD COLUMN channel VARCHAR(12) NOT NULL DEFAULT 'web', ADD COLUMN note TEXT, DROP COLUMN o_orderpriority"
RENAME_QUERY = "ALTER TABLE `orders` MODIFY COLUMN o_custkey DECIMAL(20,0), RENAME COLUMN o_custkey TO buyer, CHANGE `o_orderpriority` `urgency` VARCHAR(24)"
MULTI_QUERY = "ALTER TABLE shop.orders DROP COLUMN o_totalprice, CHANGE o_orderstatus state VARCHAR(6), ADD COLUMN booked_on DATE DEFAULT '2019-05-17'"


def _evolved(df: DataFrame, nxt: TableMeta, query: str, action: int = 0, prev: TableMeta = ORDERS_META) -> DataFrame:
    return ev.assert_evolved(ev.evolve(df, ev.plan_evolution(prev, nxt, action, query)))


def q_evolve_add_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evolved(table(spark, sf_dir, "orders"), ADD_DROP, ADD_DROP_QUERY)


def q_evolve_rename_modify(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _evolved(table(spark, sf_dir, "orders"), RENAMED, RENAME_QUERY)
    return out.withColumn("buyer", F.col("buyer").cast("string"))


def q_evolve_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _evolved(table(spark, sf_dir, "orders"), MULTI, MULTI_QUERY)
    return out.withColumn("booked_on", F.date_format("booked_on", "yyyy-MM-dd"))


def q_evolve_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A truncate, then the changes that follow it."""
    orders = table(spark, sf_dir, "orders")
    from cdclake.operators.changes import merge_changes

    empty = _evolved(orders, ORDERS_META, "TRUNCATE TABLE orders", ev.TRUNCATE_TABLE)
    after = orders.withColumn("cdc_flag", F.when(F.col("o_orderkey") % 20 < 13, "I").otherwise("D"))
    return merge_changes(empty, after, ["o_orderkey"])


# Texts by order key, with the kind of each.
DDL_TEXTS = [
    ("ALTER TABLE t ADD COLUMN c INT", 5, "alter"),
    ("ALTER TABLE t DROP COLUMN c", 6, "alter"),
    ("ALTER TABLE t ADD KEY by_clerk (clerk)", 7, "none"),
    ("TRUNCATE TABLE t", 11, "truncate"),
    ("DROP TABLE t", 4, "drop"),
    ("RENAME TABLE a TO b", 14, "error"),
    ("ALTER TABLE t RENAME TO b", 0, "error"),
    ("ALTER TABLE t RENAME COLUMN a TO b", 0, "alter"),
    ("ALTER TABLE t COMMENT = 'rename column a to b'", 0, "none"),
    ("", 3, "none"),
    ("CREATE TABLE t (id INT)", 3, "error"),
    ("DROP DATABASE d", 2, "none"),
    ("ALTER TABLE t DROP PRIMARY KEY", 0, "none"),
    ("ALTER TABLE t ALTER COLUMN c DROP DEFAULT", 0, "alter"),
    ("CREATE INDEX i ON t(c)", 7, "error"),
    ("ALTER TABLE `drop me` ADD UNIQUE KEY `change a` (`c`)", 0, "none"),
]


def q_ddl_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.col("o_orderkey") % len(DDL_TEXTS)
    pick = lambda i: F.element_at(F.array(*[F.lit(t[i]) for t in DDL_TEXTS]), (slot + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", pick(0).alias("query"), pick(1).alias("action"))
    return ev.classify_ddl(rows).select("o_orderkey", "query", "kind")


def _orders_catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A previous and a next catalog of one table per order."""
    k = F.col("o_orderkey")
    cols = lambda *rows: F.explode(F.array(*[
        F.struct(*[v if not isinstance(v, str) and v is not None else F.lit(v).cast("string") for v in r]) for r in rows]))
    shape = ["name", "tp", "precision", "scale", "nullable", "default_value"]

    def catalog(*rows):
        df = table(spark, sf_dir, "orders").select(F.lit("shop").alias("db"), F.concat(F.lit("t"), k.cast("string")).alias("table"), k, cols(*rows).alias("c"))
        return df.select("db", "table", *[F.col(f"c.col{i + 1}").alias(n) for i, n in enumerate(shape)])

    null = F.lit(None).cast("string")
    prev = catalog(("station", "char", "4", "", F.lit(False), null), ("Depth", "decimal", "7", "3", F.lit(True), null), ("remark", "text", "", "", F.lit(True), F.lit("dry")))
    scale = F.when(k % 3 == 0, "4").otherwise("3")
    nxt = catalog(("station", "char", "4", "", k % 5 == 0, null), ("DEPTH", "decimal", "7", scale, F.lit(True), null), ("litres", "double", "", "", F.lit(True), null))
    return prev, nxt


def q_schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev, nxt = _orders_catalog(spark, sf_dir)
    return ev.schema_diff(prev, nxt)


QUERIES = {
    "evolve_add_drop": q_evolve_add_drop,
    "evolve_rename_modify": q_evolve_rename_modify,
    "evolve_multi": q_evolve_multi,
    "evolve_truncate": q_evolve_truncate,
    "ddl_classify": q_ddl_classify,
    "schema_diff": q_schema_diff,
}

_quoted = lambda s: "'" + s.replace("'", "''") + "'"
_case = lambda i: (
    f"CASE o_orderkey % {len(DDL_TEXTS)} " + " ".join(f"WHEN {n} THEN {_quoted(t[i])}" for n, t in enumerate(DDL_TEXTS)) + " END")

ORACLES = {
    "evolve_add_drop": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'web' AS channel, CAST(NULL AS VARCHAR) AS note FROM orders""",
    "evolve_rename_modify": """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS buyer, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority AS urgency FROM orders""",
    "evolve_multi": """
        SELECT o_orderkey, o_custkey, o_orderstatus AS state, o_orderdate, o_orderpriority, '2019-05-17' AS booked_on FROM orders""",
    "evolve_truncate": "SELECT * FROM orders WHERE o_orderkey % 20 < 13",
    "ddl_classify": f"SELECT o_orderkey, {_case(0)} AS query, {_case(2)} AS kind FROM orders",
    "schema_diff": """
        SELECT 'shop' AS db, 't' || o_orderkey AS "table", name, change FROM orders, (VALUES
          ('remark', 'dropped', 0), ('litres', 'added', 0), ('DEPTH', 'type', 3), ('station', 'nullability', 5)) v(name, change, every)
        WHERE every = 0 OR o_orderkey % CASE WHEN every = 0 THEN 1 ELSE every END = 0""",
}
