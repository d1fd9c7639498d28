"""Schema epochs, index files, cursors and ranges derived from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.names import cursor_key, parse_cursor_key
from cdclake.sources import discover
from checks.common import table

# Streams by arithmetic: table, version, partition, date and file index.
STREAMS_SQL = """
  SELECT 'shop' AS db, 'orders_' || (o_orderkey % 4) AS "table", o_orderkey % 5 AS version,
         o_custkey % 3 AS partition, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey % 97 + 1 AS idx
  FROM orders"""
INDEX_SQL = f"SELECT db, \"table\", version, partition, date, max(idx) AS idx FROM ({STREAMS_SQL}) GROUP BY ALL"
CURSORS_SQL = f"""
  SELECT db, "table", version, partition, max(date) AS date,
         max(idx) // 2 AS file_index
  FROM ({STREAMS_SQL}) WHERE version < 4 AND date < '1998-01-01' GROUP BY ALL"""
RANGES_SQL = f"""
  SELECT i.db, i."table", i.version, i.partition, i.date,
         CASE WHEN i.date = c.date THEN c.file_index ELSE 0 END + 1 AS start_idx, i.idx AS end_idx
  FROM ({INDEX_SQL}) i LEFT JOIN ({CURSORS_SQL}) c USING (db, "table", version, partition)
  WHERE i.date >= coalesce(c.date, '') AND i.idx >= CASE WHEN i.date = c.date THEN c.file_index ELSE 0 END + 1"""


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.lit("shop").alias("db"), F.concat(F.lit("orders_"), (k % 4).cast("string")).alias("table"),
        (k % 5).cast("decimal(20,0)").alias("version"), (F.col("o_custkey") % 3).alias("partition"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), (k % 97 + 1).alias("idx"),
    )


def index_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir)
    part = F.when(F.col("partition") == 0, "").otherwise(F.concat(F.col("partition").cast("string"), F.lit("/")))
    path = F.concat(F.lit("s3://b/increment/"), "db", F.lit("/"), "table", F.lit("/"), F.col("version").cast("string"), F.lit("/"), part, "date", F.lit("/meta/CDC.index"))
    return s.select(path.alias("path"), F.concat(F.lit("CDC"), F.lpad(F.col("idx").cast("string"), 15, "0"), F.lit(".csv\n")).alias("text"))


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.index_rows(index_texts(spark, sf_dir))


def cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams(spark, sf_dir).where("version < 4 and date < '1998-01-01'").groupBy(*discover.STREAM).agg(
        F.max("date").alias("date"), F.floor(F.max("idx") / 2).alias("file_index"))


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.pending_ranges(index(spark, sf_dir), cursors(spark, sf_dir))


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumn("version", F.col("version").cast("bigint"))


def q_cdc_index_scan(spark, sf_dir):
    return _plain(index(spark, sf_dir)).drop("width")


def q_pending_ranges(spark, sf_dir):
    return _plain(ranges(spark, sf_dir)).drop("width")


def q_range_expand(spark, sf_dir):
    return _plain(discover.expand_ranges(ranges(spark, sf_dir))).select("db", "table", "version", "partition", "date", "idx", "file")


def q_date_prune(spark, sf_dir):
    return _plain(discover.prune_dates(streams(spark, sf_dir), cursors(spark, sf_dir)))


def _with_schema_entries(spark, sf_dir):
    r = ranges(spark, sf_dir).withColumn("kind", F.lit(1))
    entries = r.select("db", "table", "version").distinct().select(
        "db", "table", "version", F.lit(0).cast("bigint").alias("partition"), F.lit("").alias("date"),
        F.lit(0).cast("bigint").alias("start_idx"), F.lit(0).cast("bigint").alias("end_idx"), F.lit(0).cast("bigint").alias("width"), F.lit(0).alias("kind"))
    return r.unionByName(entries)


ENTRIES_SQL = f"""
  SELECT db, "table", version, partition, date, start_idx, end_idx, 1 AS kind FROM ({RANGES_SQL})
  UNION ALL SELECT DISTINCT db, "table", version, CAST(0 AS BIGINT), '', CAST(0 AS BIGINT), CAST(0 AS BIGINT), 0 FROM ({RANGES_SQL})"""


def q_range_file_count(spark, sf_dir):
    return discover.count_files(_with_schema_entries(spark, sf_dir))


def q_replay_order(spark, sf_dir):
    return _plain(discover.replay_order(_with_schema_entries(spark, sf_dir))).select(
        "db", "table", "version", F.col("kind").cast("bigint").alias("kind"), "partition", "date", "start_idx", "end_idx", "first_position")


def epochs(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.lit("shop").alias("db"), F.concat(F.lit("t"), (k % 50).cast("string")).alias("table"), k.cast("decimal(20,0)").alias("version"))


def q_epoch_classify(spark, sf_dir):
    e = epochs(spark, sf_dir)
    marks = e.groupBy("db", "table").agg(F.max(F.when(F.col("version") < 700, F.col("version"))).alias("m")).where(
        F.substring("table", 2, 9).cast("int") % 2 == 0).select("db", "table", F.col("m").alias("watermark"))
    return _plain(discover.classify_epochs(e, marks, 900)).select("db", "table", "version", "status")


def q_range_schema_check(spark, sf_dir):
    known = streams(spark, sf_dir).where("version <> 3 or table <> 'orders_1'").select("db", "table", "version").distinct()
    return _plain(discover.ranges_without_schema(ranges(spark, sf_dir), known)).drop("width")


def q_cursor_key(spark, sf_dir):
    s = streams(spark, sf_dir).withColumn("cursor_key", cursor_key(F.col("version"), F.col("partition")))
    version, partition = parse_cursor_key(F.col("cursor_key"))
    return s.select("idx", "cursor_key", version.cast("bigint").alias("version"), partition.alias("partition"))


def q_round_gate(spark, sf_dir):
    k = F.col("o_orderkey")
    stored, published = k.cast("decimal(20,0)"), F.when(k % 11 != 0, k + k % 5 - 2).cast("decimal(20,0)")
    return table(spark, sf_dir, "orders").select("o_orderkey", discover.round_gate(stored, published).alias("action"))


QUERIES = {
    "cdc_index_scan": q_cdc_index_scan,
    "pending_ranges": q_pending_ranges,
    "range_expand": q_range_expand,
    "range_file_count": q_range_file_count,
    "range_schema_check": q_range_schema_check,
    "replay_order": q_replay_order,
    "date_prune": q_date_prune,
    "epoch_classify": q_epoch_classify,
    "cursor_key": q_cursor_key,
    "round_gate": q_round_gate,
}

ORACLES = {
    "cdc_index_scan": INDEX_SQL,
    "pending_ranges": RANGES_SQL,
    "range_expand": f"""
        SELECT db, "table", version, partition, date, idx, 'CDC' || lpad(CAST(idx AS VARCHAR), 15, '0') || '.csv' AS file
        FROM (SELECT db, "table", version, partition, date, unnest(range(start_idx, end_idx + 1)) AS idx FROM ({RANGES_SQL}))""",
    "range_file_count": f"""
        SELECT db, "table", CAST(sum(CASE WHEN kind = 1 AND end_idx >= start_idx THEN end_idx - start_idx + 1 ELSE 0 END) AS BIGINT) AS n_files
        FROM ({ENTRIES_SQL}) GROUP BY ALL""",
    "range_schema_check": f"""SELECT * FROM ({RANGES_SQL}) WHERE version = 3 AND "table" = 'orders_1'""",
    "replay_order": f"""
        SELECT db, "table", version, CAST(kind AS BIGINT) AS kind, partition, date, start_idx, end_idx,
               CAST(1 + coalesce(sum(CASE WHEN kind = 1 THEN end_idx - start_idx + 1 ELSE 1 END) OVER (
                 PARTITION BY db, "table" ORDER BY version, kind, partition, date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_position
        FROM ({ENTRIES_SQL})""",
    "date_prune": f"""
        SELECT s.* FROM ({STREAMS_SQL}) s LEFT JOIN ({CURSORS_SQL}) c USING (db, "table", version, partition)
        WHERE s.date >= coalesce(c.date, '')""",
    "epoch_classify": """
        WITH e AS (SELECT 'shop' AS db, 't' || (o_orderkey % 50) AS "table", o_orderkey AS version, o_orderkey % 50 AS n FROM orders),
             m AS (SELECT *, CASE WHEN n % 2 = 0 THEN max(CASE WHEN version < 700 THEN version END) OVER (PARTITION BY "table") END AS w,
                          max(CASE WHEN version <= 900 THEN version END) OVER (PARTITION BY "table") AS b FROM e)
        SELECT db, "table", version,
               CASE WHEN w IS NOT NULL THEN CASE WHEN version < w THEN 'stale' WHEN version = w THEN 'current' ELSE 'pending' END
                    WHEN version > 900 THEN 'pending' WHEN version = b THEN 'baseline' ELSE 'stale' END AS status
        FROM m""",
    "cursor_key": f"""
        SELECT idx, version || '/' || partition || '/CDC' AS cursor_key, version, partition FROM ({STREAMS_SQL})""",
    "round_gate": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'absent' WHEN o_orderkey % 5 < 2 THEN 'behind'
                                WHEN o_orderkey % 5 = 2 THEN 'stuck' ELSE 'run' END AS action FROM orders""",
}
