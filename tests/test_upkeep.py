"""Listings, patterns, exports, logs and digests: what must hold at any size."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdclake.operators import reconcile as rc
from cdclake.plans import replicate as rp
from cdclake.plans import target as tg
from cdclake.sources import csvio, discover, storage
from cdclake.streaming.rounds import start_rounds, stream_log
from tests.test_replicate import META, changes, lake, rows_of, snapshot  # noqa: F401


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 10**4), st.integers(1, 8), st.data())
def test_patterns_match_the_range_and_nothing_else(start, n, width, data):
    end = start + n
    globs = discover.number_globs(start, end, max(width, len(str(end))))
    assert len(globs) <= 18 * len(str(end))
    for x in {start, end, start - 1, end + 1, *data.draw(st.lists(st.integers(0, 2 * 10**6), max_size=20))}:
        if x >= 0:
            hits = sum(bool(re.fullmatch(g, f"{x:0{max(width, len(str(end)))}d}")) for g in globs)
            assert hits == (start <= x <= end)


def test_a_million_files_are_few_patterns():
    for start, end, width in ((1, 10**6, 15), (123456, 10**6 + 98765, 15), (5, 12345, 3)):
        rng = dict(db="d", table="t{x}", version=9, partition=0, date="2026-07-01", start_idx=start, end_idx=end, width=width)
        globs = discover.range_globs("/r", rng)
        assert len(globs) < 60 and all(g.startswith("/r/increment/d/t\\{x\\}/9/2026-07-01/CDC") for g in globs)


def test_missing_file_fails_the_round(spark, lake):
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    for k in range(3):
        last = changes(spark, lake.source, [("U", 101 + k, 1, "x", k)], first_index=1 + k)
    assert last == 3
    csvio.write_checkpoint(spark, lake.source, 110)
    gone = f"{lake.source}/increment/db/t/90/2026-07-01/CDC000000000000002.csv"
    text = storage.read_text(spark, gone)
    storage.delete(spark, gone)
    with pytest.raises(FileNotFoundError, match="1 of 3"):
        rp.replicate(spark, lake)
    storage.write_text(spark, gone, text)
    (r,) = rp.replicate(spark, lake)
    assert r.loaded_files == 3 and rows_of(spark, lake)[0] == (1, "x", 2)


def test_listing_calls_do_not_follow_dates(spark, monkeypatch):
    root = storage.scratch_dir(spark)
    for day in range(1, 29):
        for part in ("", "3/"):
            storage.write_text(spark, f"{root}/increment/d/t/90/{part}2026-02-{day:02d}/meta/CDC.index", f"CDC{day:06d}.csv")
            storage.write_text(spark, f"{root}/increment/d/t/90/{part}2026-02-{day:02d}/CDC000001.csv", "")
    calls = []
    for name in ("glob", "list_names", "exists"):
        real = getattr(storage, name)
        monkeypatch.setattr(storage, name, lambda *a, real=real: (calls.append(a), real(*a))[1])
    found = discover.index_listing(spark, root, {"d.t": {90: {3: "2026-02-20"}, 95: {}}, "d.u": {}})
    assert len(calls) == 2 and len(found) == 28 + 9
    storage.write_text(spark, f"{root}/increment/d/t/90/someday/meta/CDC.index", "CDC000001.csv")
    with pytest.raises(ValueError, match="neither a date"):
        discover.index_listing(spark, root, {"d.t": {90: {}}})


def test_exports_replace_each_other(spark, lake):
    other = type(META)("db", "u", META.columns, META.pk)
    lake.tables = ["db.t", "db.u"]
    snapshot(spark, lake.source, rows=[(i, "x", i) for i in range(50)])
    snapshot(spark, lake.source, rows=[(9, "u", 9)], meta=other)
    snapshot(spark, lake.source, rows=[(1, "new", 5)])
    csv = [n for n in storage.list_names(spark, f"{lake.source}/snapshot") if n.startswith("db.t.") and n.endswith(".csv")]
    assert len(csv) == 1
    rp.replicate(spark, lake, "snapshot-only")
    assert rows_of(spark, lake) == [(1, "new", 5)] and rows_of(spark, lake, "db.u") == [(9, "u", 9)]


def test_logs_have_no_cap(spark, lake):
    """Every round is in the log, and every report of a stream, whoever listens."""
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    rp.replicate(spark, lake, "snapshot-only")
    done = []
    for k in range(3):
        changes(spark, lake.source, [("U", 101 + 100 * k, 1, "x", k), ("D", 101 + 100 * k, 77, "x", k)], first_index=1 + k)
        csvio.write_checkpoint(spark, lake.source, 110 + 100 * k)
        start_rounds(spark, lake, lake.target + "/_stream", None, done.append).awaitTermination()
    got = sorted((r["batch"], r["table"], r["loaded_files"], r["n_update"], r["n_ignore"]) for r in rp.round_log(spark, lake).collect())
    assert got == [(2 + k, "db.t", 1, 1, 1) for k in range(3)] and len(done) == 3
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30000)
    import time
    deadline = time.time() + 30
    while stream_log(spark, lake).where("descriptors > 0").count() < 3 and time.time() < deadline:
        time.sleep(0.5)
    assert stream_log(spark, lake).where("descriptors > 0").count() >= 3


def test_digests_read_only_what_differs(spark, lake, monkeypatch):
    lake.buckets = 16
    rows = [(i, f"n{i}", i) for i in range(400)]
    snapshot(spark, lake.source, rows=rows)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    rp.replicate(spark, lake, "snapshot-only")
    source = spark.createDataFrame(rows, META.ddl())
    reads = []
    real = tg.read_live
    monkeypatch.setattr(tg, "read_live", lambda *a, **k: (reads.append(a[5] if len(a) > 5 else None), real(*a, **k))[1])
    assert rp.compare_target(spark, lake, "db.t", source).count() == 0 and reads == [list(range(16))]
    reads.clear()
    assert rp.compare_target(spark, lake, "db.t", source).count() == 0 and reads == []
    altered = spark.createDataFrame([(i, "other" if i == 7 else n, a) for i, n, a in rows if i != 8] + [(999, None, None)], META.ddl())
    got = sorted(tuple(r) for r in rp.compare_target(spark, lake, "db.t", altered).collect())
    assert got == [(7, "changed", "name"), (8, "extra", ""), (999, "missing", "")] and len(reads) == 1 and len(reads[0]) <= 3
    # After a round only the buckets that it wrote are digested again.
    reads.clear()
    changes(spark, lake.source, [("U", 101, 7, "z", 1)])
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake)
    reads.clear()
    rp.table_digests(spark, lake, "db.t")
    assert [len(r) for r in reads] == [1]


def test_digest_diff_is_keyed_diff(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0), (3, None, 2.0), (4, "z", float("nan")), (6, None, "q")][:4], "id long, s string, d double")
    b = spark.createDataFrame([(1, "x", None), (2, None, 1.5), (4, "z", float("nan")), (5, "n", 0.0)], "id long, s string, d double")
    for n in (1, 3, 64):
        assert sorted(map(tuple, rc.digest_diff(a, b, ["id"], n).collect())) == sorted(map(tuple, rc.keyed_diff(a, b, ["id"]).collect()))
    assert rc.digest_diff(a, a, ["id"]).count() == 0
    # A null and its neighbour are not mistaken for each other.
    x, y = (spark.createDataFrame([r], "id long, s string, t string") for r in ((1, None, "v"), (1, "v", None)))
    assert rc.digest_diff(x, y, ["id"]).first()["changed"] == "s,t"
    assert rc.bucket_digests(a.union(a), ["id"], 4).agg(F.sum("n_rows")).first()[0] == 8


def test_stream_on_a_store_that_only_hadoop_knows(spark, lake):
    """The source is a mount of the view file system, which nothing outside the JVM can list."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.elsewhere.link./src", "file:" + lake.source.removeprefix("file:"))
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    lake.source, place, done = "viewfs://elsewhere/src", lake.target + "/_stream", []
    rp.replicate(spark, lake, "snapshot-only")
    for k in range(2):
        changes(spark, lake.source, [("U", 101 + 100 * k, 1, "x", k)], first_index=1 + k)
        csvio.write_checkpoint(spark, lake.source, 110 + 100 * k)
        start_rounds(spark, lake, place, None, done.append).awaitTermination()
    start_rounds(spark, lake, place, None, done.append).awaitTermination()
    assert [r.action for r in done] == ["run", "run", "stuck"] and rows_of(spark, lake)[0] == (1, "x", 1)
    q = start_rounds(spark, lake, place, "1 second", done.append)
    changes(spark, lake.source, [("D", 321, 1, "x", 1)], first_index=3)
    csvio.write_checkpoint(spark, lake.source, 330)
    import time
    deadline = time.time() + 60
    while not any(r.checkpoint_ts == 330 for r in done) and time.time() < deadline:
        time.sleep(0.5)
    q.stop()
    assert rows_of(spark, lake)[0] == (2, "box", 57)
