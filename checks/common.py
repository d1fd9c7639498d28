"""Inputs shared by the queries: the tables, and change rows derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta, TableMeta

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CHECKPOINT = 2000
KEY_SHIFT = 10_000_000_000

ORDERS_META = TableMeta(
    "shop", "orders",
    (
        ColumnMeta("o_orderkey", "bigint", nullable=False, is_pk=True),
        ColumnMeta("o_custkey", "bigint"),
        ColumnMeta("o_orderstatus", "char", "1"),
        ColumnMeta("o_totalprice", "double"),
        ColumnMeta("o_orderdate", "datetime", "6"),
        ColumnMeta("o_orderpriority", "varchar", "16"),
    ),
    ("o_orderkey",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_changes(orders: DataFrame) -> DataFrame:
    """Deletes, updates and inserts of all orders; a third of them changed twice."""
    k = F.col("o_orderkey")
    base = orders
    key = F.when(k % 7 == 2, k + KEY_SHIFT).otherwise(k)

    def generation(df: DataFrame, flag, g: int) -> DataFrame:
        return df.select(
            flag.alias("cdc_flag"),
            F.lit("orders").alias("cdc_table"),
            F.lit("shop").alias("cdc_schema"),
            (k + 1000 + g).cast("decimal(20,0)").alias("cdc_commit_ts"),
            key.alias("o_orderkey"),
            "o_custkey", "o_orderstatus",
            (F.col("o_totalprice") + 1 + g).alias("o_totalprice"),
            "o_orderdate", "o_orderpriority",
        )

    first = F.when(k % 7 == 0, "D").when(k % 7 == 2, "I").otherwise("U")
    second = F.when(k % 14 == 0, "I").when((k % 7 == 1) | (k % 7 > 3), "U").otherwise("D")
    return generation(base, first, 0).unionByName(generation(base.where(k % 3 == 0), second, 1))


ORDER_CHANGES_SQL = f"""
  SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'D' WHEN o_orderkey % 7 = 2 THEN 'I' ELSE 'U' END AS flag,
         1000 + o_orderkey AS ts,
         CASE WHEN o_orderkey % 7 = 2 THEN o_orderkey + {KEY_SHIFT} ELSE o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders
  UNION ALL
  SELECT CASE WHEN o_orderkey % 14 = 0 THEN 'I' WHEN o_orderkey % 7 = 1 OR o_orderkey % 7 > 3 THEN 'U' ELSE 'D' END,
         1001 + o_orderkey,
         CASE WHEN o_orderkey % 7 = 2 THEN o_orderkey + {KEY_SHIFT} ELSE o_orderkey END,
         o_custkey, o_orderstatus, o_totalprice + 2, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 3 = 0
"""

LATEST_SQL = f"""
  SELECT * FROM ch WHERE ts > {CHECKPOINT}
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY ts DESC) = 1
"""

MERGED_ORDERS_SQL = f"""
WITH ch AS ({ORDER_CHANGES_SQL}), latest AS ({LATEST_SQL})
SELECT {', '.join(ORDER_COLUMNS)} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)
UNION ALL
SELECT {', '.join(ORDER_COLUMNS)} FROM latest WHERE flag <> 'D'
"""
