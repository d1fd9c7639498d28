"""Plans and skew: what must hold however large the tables are."""

import re

from pyspark.sql import functions as F

from cdclake.operators import changes as ch
from cdclake.operators import reconcile as rc
from checks.common import order_changes, table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A key with a third of all changes leaves one row per map task."""
    orders = table(spark, SF, "orders")
    k = F.col("o_orderkey")
    hot = order_changes(orders).withColumn("o_orderkey", F.when(F.col("cdc_commit_ts") % 3 == 0, 7).otherwise(k))
    text = plan(ch.latest_change(hot, ["o_orderkey"]))
    partial, exchange = text.index("Partial"), text.index("Exchange hashpartitioning")
    assert text.count("WindowGroupLimit") == 2 and exchange < partial  # printed top down
    out = ch.latest_change(hot, ["o_orderkey"])
    assert out.count() == hot.select("o_orderkey").distinct().count()
    newest = hot.where("o_orderkey = 7").agg(F.max("cdc_commit_ts")).first()[0]
    assert out.where("o_orderkey = 7").first()["cdc_commit_ts"] == newest


def test_merge_is_one_join_with_one_exchange_per_side(spark):
    orders = table(spark, SF, "orders")
    latest = ch.latest_change(ch.after_checkpoint(order_changes(orders.where("o_orderkey % 7 = 1")), 2000), ["o_orderkey"])
    text = plan(ch.merge_changes(orders, latest, ["o_orderkey"]))
    assert text.count("SortMergeJoin") == 1 and "FullOuter" in text
    # Target, and the two generations of changes below one union.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_actions_read_only_keys(spark):
    orders = table(spark, SF, "orders")
    latest = ch.latest_change(order_changes(orders), ["o_orderkey"])
    text = plan(ch.merge_actions(orders, latest, ["o_orderkey"]))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_merge_prunes_columns(spark):
    orders = table(spark, SF, "orders")
    latest = orders.where("o_orderkey % 7 = 0").withColumn("cdc_flag", F.lit("U"))
    text = plan(ch.merge_changes(orders, latest, ["o_orderkey"]).select("o_orderkey", "o_custkey"))
    assert "o_orderpriority" not in text


def test_replays_and_ties(spark):
    """Ties on the timestamp go to the later file and the later row."""
    rows = [("U", 5, 1, 90, 0, "2026-07-01", 1, 0, 1, "a"), ("U", 5, 1, 90, 0, "2026-07-01", 1, 0, 2, "b"),
            ("D", 5, 2, 90, 0, "2026-07-01", 2, 0, 1, "c"), ("I", 5, 2, 90, 0, "2026-07-02", 1, 0, 0, "d"),
            ("I", 9, 3, 90, 0, "2026-07-01", 1, 0, 0, "e"), ("I", 10, 3, 90, 0, "2026-07-01", 1, 0, 0, "f")]
    df = spark.createDataFrame(
        rows,
        "cdc_flag string, ts long, id long, ver long, cdc_partition long, cdc_date string, cdc_file_idx long, cdc_block long, cdc_row long, v string"
    ).withColumn("cdc_commit_ts", F.col("ts").cast("decimal(20,0)")).withColumn("cdc_version", F.col("ver").cast("decimal(20,0)"))
    got = {r["id"]: r["v"] for r in ch.latest_change(df.repartition(5), ["id"]).collect()}
    assert got == {1: "b", 2: "d", 3: "f"}


def test_merge_actions_and_null_flags(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "id long, v string")
    latest = spark.createDataFrame([("U", 1, "x"), ("D", 2, "y"), (None, 3, "z"), ("D", 8, "q"), ("I", 9, "w"), (None, 10, "w"), ("I", None, "m")],
                                   "cdc_flag string, id long, v string")
    got = sorted(ch.merge_changes(target, latest, ["id"]).collect(), key=str)
    assert sorted([tuple(r) for r in got], key=str) == sorted([(1, "x"), (3, "c"), (9, "w"), (None, "n"), (None, "m")], key=str)
    counts = {r["action"]: r["n_rows"] for r in ch.merge_actions(target, latest, ["id"]).collect()}
    assert counts == {"update": 1, "delete": 1, "keep": 1, "ignore": 2, "insert": 2}


def test_keyed_diff_is_null_safe(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0), (3, None, 2.0), (4, "z", float("nan"))], "id long, s string, d double")
    b = spark.createDataFrame([(1, "x", None), (2, None, 1.5), (4, "z", float("nan")), (5, "n", 0.0)], "id long, s string, d double")
    got = sorted(tuple(r) for r in rc.keyed_diff(a, b, ["id"]).collect())
    assert got == [(2, "changed", "s,d"), (3, "missing", ""), (5, "extra", "")]
    assert rc.keyed_diff(a, a, ["id"]).count() == 0
