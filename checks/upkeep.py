"""Listings, patterns of ranges, exports, logs and digests, over orders."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.operators import reconcile as rc
from cdclake.plans import replicate as rp
from cdclake.sources import csvio, discover, storage
from cdclake.streaming.rounds import start_rounds
from checks import compare
from checks.commits import _rounds
from checks.common import CHECKPOINT, LATEST_SQL, MERGED_ORDERS_SQL, ORDER_CHANGES_SQL, ORDERS_META, table
from checks.discovery import RANGES_SQL, ranges
from checks.rounds import FQN, _lake, _publish

STREAM_YEARS = """
  SELECT 'shop' AS db, 'orders_' || (o_orderkey % 4) AS "table", o_orderkey % 5 AS version, o_custkey % 3 AS partition,
         strftime(o_orderdate, '%Y') || '-01-01' AS date, o_orderkey % 97 + 1 AS idx FROM orders"""


def q_index_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index files of four tables over the years of their orders; dates before 1994 are done for partition 0 of version 1."""
    k = F.col("o_orderkey")
    found = table(spark, sf_dir, "orders").groupBy(
        (k % 4).alias("t"), (k % 5).alias("version"), (F.col("o_custkey") % 3).alias("partition"), F.date_format("o_orderdate", "yyyy").alias("year")).agg(F.max(k % 97 + 1).alias("idx"))
    root = storage.scratch_dir(spark)

    def write(r) -> None:
        part = f"{r['partition']}/" if r["partition"] else ""
        storage.write_text(spark, f"{root}/increment/shop/orders_{r['t']}/{r['version']}/{part}{r['year']}-01-01/meta/CDC.index", f"CDC{r['idx']:015d}.csv\n")

    with ThreadPoolExecutor(16) as pool:  # a file per stream and year, whatever the number of orders
        list(pool.map(write, found.collect()))
    wanted = {f"shop.orders_{t}": {v: {0: "1994-01-01"} if v == 1 else {} for v in range(5)} for t in range(4)}
    rows = discover.index_rows(discover.read_index_texts(spark, discover.index_listing(spark, root, wanted)))
    return rows.withColumn("version", F.col("version").cast("bigint")).drop("width")


@F.arrow_udf(T.ArrayType(T.StringType()))
def _globs(start: pa.Array, end: pa.Array, width: pa.Array) -> pa.Array:
    return pa.array([discover.number_globs(*x) for x in zip(start.to_pylist(), end.to_pylist(), width.to_pylist())], pa.list_(pa.string()))


def q_range_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that the patterns of each pending range match among all files of its stream and date, up to the newest and five more."""
    pending = ranges(spark, sf_dir)
    keys = [*discover.STREAM, "date"]
    there = discover.expand_ranges(pending.withColumns({"start_idx": F.lit(1).cast("bigint"), "end_idx": F.col("end_idx") + 5})).select(*keys, "file")
    patterns = pending.select(*keys, F.explode(_globs("start_idx", "end_idx", "width")).alias("pattern"))
    hits = there.join(patterns, keys).where(F.rlike("file", F.concat(F.lit("^CDC"), "pattern", F.lit("[.]csv$"))))
    return hits.groupBy(*keys).agg(F.count("*").alias("n_files"), F.min("file").alias("first"), F.max("file").alias("last")).withColumn("version", F.col("version").cast("bigint"))


def q_export_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports into one place: the second one is what is loaded."""
    orders = table(spark, sf_dir, "orders")
    s = _lake(spark)
    csvio.write_snapshot(spark, orders, s.source, ORDERS_META, CHECKPOINT)
    csvio.write_snapshot(spark, orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), s.source, ORDERS_META, CHECKPOINT + 1, "gzip")
    rp.replicate(spark, s, "snapshot-only")
    return rp.read_target(spark, s, FQN)


def q_round_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream's round wrote into the log of rounds."""
    s = _lake(spark)
    _publish(spark, s, table(spark, sf_dir, "orders"))
    rp.replicate(spark, s, "snapshot-only")
    start_rounds(spark, s, s.target + "/_stream", every=None).awaitTermination()
    log = rp.round_log(spark, s).withColumn("checkpoint_ts", F.col("checkpoint_ts").cast("bigint"))
    return log.drop("loaded_files")


def q_digest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rc.digest_diff(table(spark, sf_dir, "orders"), compare._altered_orders(spark, sf_dir), ["o_orderkey"])


def q_target_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replicated target against its source as it was before the last round, by kept digests."""
    s = _rounds(spark, sf_dir, 2)
    before = rp.read_target(spark, s, FQN)
    if rp.compare_target(spark, s, FQN, before).count():
        raise AssertionError("a table differs from itself")
    rp.replicate(spark, s)
    rp.table_digests(spark, s, FQN)
    return rp.compare_target(spark, s, FQN, table(spark, sf_dir, "orders")).select("o_orderkey", "kind")


QUERIES = {
    "index_listing": q_index_listing,
    "range_globs": q_range_globs,
    "export_twice": q_export_twice,
    "round_log": q_round_log,
    "digest_diff": q_digest_diff,
    "target_digests": q_target_digests,
}

ORACLES = {
    "index_listing": f"""
        SELECT db, "table", version, partition, date, max(idx) AS idx FROM ({STREAM_YEARS})
        WHERE NOT (version = 1 AND partition = 0 AND date < '1994-01-01') GROUP BY ALL""",
    "range_globs": f"""
        SELECT db, "table", version, partition, date, end_idx - start_idx + 1 AS n_files, 'CDC' || lpad(CAST(start_idx AS VARCHAR), 15, '0') || '.csv' AS first,
               'CDC' || lpad(CAST(end_idx AS VARCHAR), 15, '0') || '.csv' AS last FROM ({RANGES_SQL})""",
    "export_twice": "SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders",
    "round_log": f"""
        WITH ch AS ({ORDER_CHANGES_SQL}), latest AS ({LATEST_SQL}),
             a AS (SELECT flag = 'D' AS gone, o_orderkey IN (SELECT o_orderkey FROM orders) AS known FROM latest)
        SELECT CAST(2 AS BIGINT) AS batch, CAST(1000000000000 AS BIGINT) AS checkpoint_ts, 'shop.orders' AS "table", count(*) FILTER (NOT gone AND NOT known) AS n_insert,
               count(*) FILTER (NOT gone AND known) AS n_update, count(*) FILTER (gone AND known) AS n_delete, count(*) FILTER (gone AND NOT known) AS n_ignore FROM a""",
    "digest_diff": compare.ORACLES["keyed_diff"],
    "target_digests": f"""
        WITH m AS ({MERGED_ORDERS_SQL})
        SELECT coalesce(a.o_orderkey, m.o_orderkey) AS o_orderkey, CASE WHEN m.o_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS kind
        FROM orders a FULL JOIN m ON a.o_orderkey = m.o_orderkey WHERE a.o_orderkey IS NULL OR m.o_orderkey IS NULL OR a.o_totalprice IS DISTINCT FROM m.o_totalprice""",
}
