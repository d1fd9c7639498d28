"""Reconciliation, selection and progress rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.operators import reconcile as rc
from cdclake.operators.select import ColumnSelector, allowed_tables, select_columns, table_set_differences
from cdclake.plans.progress import latest_progress, round_summary
from checks.common import table
from checks.files import CUSTOMER_META

NAMES = ["customer", "orders", "lineitem", "part", "supplier", "nation", "region"]


def _altered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").where(k % 100 != 5).select(
        k, "o_custkey",
        F.when(k % 50 == 7, None).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 70 == 9, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")
    extra = table(spark, sf_dir, "orders").where(k % 100 == 6).withColumn("o_orderkey", k + 10_000_000_000)
    return o.unionByName(extra)


ALTERED_SQL = """
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 <> 7 THEN o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 70 = 9 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 100 <> 5
  UNION ALL SELECT o_orderkey + 10000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 100 = 6"""


def q_keyed_diff(spark, sf_dir):
    return rc.keyed_diff(table(spark, sf_dir, "orders"), _altered_orders(spark, sf_dir), ["o_orderkey"])


def q_count_reconcile(spark, sf_dir):
    source = rc.table_counts({n: table(spark, sf_dir, n) for n in NAMES})
    target = {f' "{n.upper()}" ': table(spark, sf_dir, n) for n in NAMES if n != "region"}
    target["Orders"] = _altered_orders(spark, sf_dir)
    del target[' "ORDERS" ']
    target["events"] = table(spark, sf_dir, "events")
    return rc.compare_counts(source, rc.table_counts(target))


def q_duplicate_keys(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k % 2 == 0, F.upper("p_name")).otherwise(F.concat(F.lit(' "'), F.col("p_name"), F.lit('" ')))
    return rc.duplicate_names(table(spark, sf_dir, "part").select(name.alias("table")))


def q_conditional_agg(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    is2 = F.col("o_orderkey") == 2
    return rc.assertions(
        o,
        n_rows=F.count("*"),
        price=rc.value_where(is2, F.col("o_totalprice"), -1.0),
        status=rc.value_where(is2, F.col("o_orderstatus"), ""),
        absent=rc.value_where(F.col("o_orderkey") == -2, F.col("o_totalprice"), -1.0),
        n_open=rc.rows_where(F.col("o_orderstatus") == "O"),
        n_gone=rc.rows_where(F.col("o_orderkey") == -3),
    )


def q_column_selectors(spark, sf_dir):
    rules = [
        ColumnSelector(("shop.eu.order*",), ("*",)),
        ColumnSelector(("shop.eu.*",), ("*", "!c_acctbal", "!c_m*", "c_mktsegment")),
        ColumnSelector(("*",), ("c_custkey",)),
    ]
    return select_columns(table(spark, sf_dir, "customer"), CUSTOMER_META, rules)


def q_table_allow_list(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(
        F.lit("shop").alias("db"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("table"), "o_orderkey")
    configured = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.lit("shop").alias("db"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("table"))
    return allowed_tables(files, configured)


def q_table_set_check(spark, sf_dir):
    configured = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("table"))
    stored = table(spark, sf_dir, "orders").select(
        F.concat(F.when(F.col("o_orderkey") % 40 == 0, "x").otherwise("c"), F.col("o_custkey").cast("string")).alias("table"))
    return table_set_differences(configured, stored)


def _progress_log(spark, sf_dir):
    """One progress row per order: table, stream, batch and watermarks."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("t"), (F.col("o_custkey") % 20).cast("string")).alias("table"),
        F.concat((k % 3).cast("string"), F.lit("/0/CDC")).alias("cursor"),
        k.alias("batch"),
        (k * 2).cast("decimal(20,0)").alias("checkpoint_ts"),
        (k % 1000).cast("decimal(20,0)").alias("watermark"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        (k % 97).alias("file_index"))


PROGRESS_SQL = """
  SELECT 't' || (o_custkey % 20) AS "table", (o_orderkey % 3) || '/0/CDC' AS cursor, o_orderkey AS batch,
         o_orderkey * 2 AS checkpoint_ts, o_orderkey % 1000 AS watermark,
         strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey % 97 AS file_index
  FROM orders"""


def q_progress_latest(spark, sf_dir):
    out = latest_progress(_progress_log(spark, sf_dir))
    return out.withColumn("checkpoint_ts", F.col("checkpoint_ts").cast("bigint")).withColumn("watermark", F.col("watermark").cast("bigint"))


def q_round_summary(spark, sf_dir):
    k = F.col("o_orderkey")
    work = table(spark, sf_dir, "orders").select(
        (k % 7).alias("batch"), F.concat(F.lit("t"), (F.col("o_custkey") % 20).cast("string")).alias("table"),
        F.when(k % 9 == 0, 0).otherwise(1).alias("kind"), F.lit(1).cast("bigint").alias("start_idx"), (k % 4).alias("end_idx"))
    return round_summary(work)


QUERIES = {
    "keyed_diff": q_keyed_diff,
    "count_reconcile": q_count_reconcile,
    "duplicate_keys": q_duplicate_keys,
    "conditional_agg": q_conditional_agg,
    "column_selectors": q_column_selectors,
    "table_allow_list": q_table_allow_list,
    "table_set_check": q_table_set_check,
    "progress_latest": q_progress_latest,
    "round_summary": q_round_summary,
}

_count = lambda n: f"(SELECT CAST(count(*) AS VARCHAR) FROM {n})"

ORACLES = {
    "keyed_diff": f"""
        WITH b AS ({ALTERED_SQL})
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
               CASE WHEN b.o_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS kind,
               CASE WHEN a.o_orderkey IS NULL OR b.o_orderkey IS NULL THEN '' ELSE concat_ws(',',
                 CASE WHEN a.o_custkey IS DISTINCT FROM b.o_custkey THEN 'o_custkey' END,
                 CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus THEN 'o_orderstatus' END,
                 CASE WHEN a.o_totalprice IS DISTINCT FROM b.o_totalprice THEN 'o_totalprice' END,
                 CASE WHEN a.o_orderdate IS DISTINCT FROM b.o_orderdate THEN 'o_orderdate' END,
                 CASE WHEN a.o_orderpriority IS DISTINCT FROM b.o_orderpriority THEN 'o_orderpriority' END) END AS changed
        FROM orders a FULL JOIN b ON a.o_orderkey = b.o_orderkey
        WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_custkey IS DISTINCT FROM b.o_custkey
           OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_totalprice IS DISTINCT FROM b.o_totalprice
           OR a.o_orderdate IS DISTINCT FROM b.o_orderdate OR a.o_orderpriority IS DISTINCT FROM b.o_orderpriority""",
    "count_reconcile": f"""
        WITH altered AS ({ALTERED_SQL}), c AS (
        """ + " UNION ALL ".join(
            f"SELECT '{n.upper()}' AS \"table\", {_count(n)} AS source_rows, "
            + ("'MISSING'" if n == "region" else _count("altered") if n == "orders" else _count(n)) + " AS target_rows" for n in NAMES)
        + f""" UNION ALL SELECT 'EVENTS', 'MISSING', {_count('events')})
        SELECT *, source_rows <> target_rows AS differs FROM c""",
    "duplicate_keys": "SELECT upper(p_name) AS key, count(*) AS n_names FROM part GROUP BY 1 HAVING count(*) > 1",
    "conditional_agg": """
        SELECT count(*) AS n_rows, coalesce(max(CASE WHEN o_orderkey = 2 THEN o_totalprice END), -1) AS price,
               coalesce(max(CASE WHEN o_orderkey = 2 THEN o_orderstatus END), '') AS status,
               coalesce(max(CASE WHEN o_orderkey = -2 THEN o_totalprice END), -1) AS absent,
               CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_open,
               CAST(sum(CASE WHEN o_orderkey = -3 THEN 1 ELSE 0 END) AS BIGINT) AS n_gone FROM orders""",
    "column_selectors": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer",
    "table_allow_list": """
        SELECT 'shop' AS db, 'c' || o_custkey AS "table", o_orderkey FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "table_set_check": """
        WITH a AS (SELECT 'c' || c_custkey AS "table" FROM customer),
             b AS (SELECT CASE WHEN o_orderkey % 40 = 0 THEN 'x' ELSE 'c' END || o_custkey AS "table" FROM orders)
        SELECT "table", 'not stored' AS problem FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT "table", 'not configured' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
    "progress_latest": f"""
        WITH p AS ({PROGRESS_SQL})
        SELECT "table", cursor, max(checkpoint_ts) AS checkpoint_ts, max(watermark) AS watermark,
               max(batch) AS batch, arg_max(date, date || '/' || lpad(CAST(file_index AS VARCHAR), 9, '0')) AS date,
               arg_max(file_index, date || '/' || lpad(CAST(file_index AS VARCHAR), 9, '0')) AS file_index
        FROM p GROUP BY 1, 2""",
    "round_summary": """
        SELECT o_orderkey % 7 AS batch, count(DISTINCT o_custkey % 20) AS active_tables,
               CAST(sum(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 4 ELSE 0 END) AS BIGINT) AS loaded_files
        FROM orders GROUP BY 1""",
}
