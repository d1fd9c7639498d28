"""Commits: one value per entry whatever the order of steps, per-table durability, runs, splits."""

import random
import threading
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdclake.plans import commits
from cdclake.plans import progress as pg
from cdclake.plans import replicate as rp
from cdclake.plans import target as tg
from cdclake.sources import csvio, storage
from tests.test_replicate import META, changes, lake, rows_of, snapshot  # noqa: F401


class Memory:
    """Whole files by path; nothing is exclusive. ``torn`` says which writes are cut short."""

    def __init__(self):
        self.files, self.torn = {}, set()

    def names(self, path=""):
        depth = f"{path}/" if path else ""
        return sorted({p[len(depth):].split("/")[0] for p in self.files if p.startswith(depth)})

    def read(self, path):
        return self.files.get(path)

    def write(self, path, text):
        self.files[path] = text[:len(text) // 2] if path in self.torn else text

    def delete(self, paths):
        for p in paths:
            for q in [q for q in self.files if q == p or q.startswith(p + "/")]:
                del self.files[q]


@settings(max_examples=300, deadline=None)
@given(st.integers(2, 4), st.randoms(use_true_random=False), st.integers(0, 3))
def test_one_value_in_any_order_of_steps(writers, r, crashes):
    store = Memory()
    running = {w: commits.steps(store, 7, f"v{w}", f"w{w}") for w in range(writers)}
    crash = set(r.sample(range(writers), min(crashes, writers - 1)))
    chosen, told = {}, set()
    for _ in range(4000):
        if not running:
            break
        w = r.choice(sorted(running))
        for _ in range(r.choice([1, 1, 2, 7])):
            try:
                value = next(running[w])
            except StopIteration:
                running.pop(w)
                break
            if value is not None:
                chosen[w] = value
        if w in crash and w in running and r.random() < 0.1:
            running.pop(w)
        seen = commits.value_of(store, 7)
        if "commit=7" in store.files:
            told.add(seen)
    assert len(set(chosen.values()) | told) <= 1
    if not running:
        assert set(chosen) >= set(range(writers)) - crash
    late = commits.propose(store, 7, "late")
    assert late == next(iter(told), late) and commits.propose(store, 7, "later") == late


def test_files_that_are_cut_short():
    store = Memory()
    assert commits.propose(store, 1, "a") == "a" and commits.newest(store) == (1, "a")
    # Without ballots an empty commit file is no commit, and the entry can be written.
    store.files["commit=2"] = ""
    assert commits.newest(store) == (1, "a") and commits.propose(store, 2, "b") == "b" and commits.newest(store) == (2, "b")
    # With them the choice is told by them.
    store.files["commit=2"] = store.files["commit=2"][:5]
    assert commits.newest(store) == (2, "b") and commits.propose(store, 2, "c") == "b" and commits.unsealed(store.files["commit=2"]) == "b"
    # A ballot that is cut short was not written.
    store.files["ballot=3/x.1"] = commits.sealed({"ballot": [9, "x"], "at": [9, "x"], "value": "x"})[:-4]
    assert commits.propose(store, 3, "d") == "d"
    commits.forget(store, [1, 2])
    assert commits.entries(store) == [3] and commits.newest(store) == (3, "d")


def test_threads_on_one_folder(spark):
    for _ in range(2):
        store = commits.Store(spark, f"{storage.scratch_dir(spark)}/log")
        got = []
        threads = [threading.Thread(target=lambda n=n: got.append(commits.propose(store, 1, f"v{n}"))) for n in range(3)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        assert len(got) == 3 and len(set(got)) == 1 and commits.newest(store) == (1, got[0])


def _two_tables(spark, lake):
    other = type(META)("db", "u", META.columns, META.pk)
    lake.tables = ["db.t", "db.u"]
    for m in (META, other):
        snapshot(spark, lake.source, meta=m)
        csvio.write_schema_epoch(spark, lake.source, m, 90)
        changes(spark, lake.source, [("U", 101, 1, m.table, 1)], meta=m)
    csvio.write_checkpoint(spark, lake.source, 110)
    return other


def test_failure_cancels_siblings_and_keeps_commits(spark, lake, monkeypatch):
    _two_tables(spark, lake)
    lake.tables = ["db.t", "db.u", "db.v"]
    lake.parallel_tables = 3
    v = type(META)("db", "v", META.columns, META.pk)
    snapshot(spark, lake.source, meta=v)
    csvio.write_schema_epoch(spark, lake.source, v, 90)
    rp.replicate(spark, lake, "snapshot-only")
    real, committed, ended = rp._apply_table, threading.Event(), []
    commit = pg.commit

    def noted(spark, root, fqn, *rest):
        commit(spark, root, fqn, *rest)
        committed.set()

    def apply(spark, settings, fqn, *rest):
        if fqn == "db.u":
            assert committed.wait(120)
            time.sleep(1)
            raise RuntimeError("db.u is broken")
        if fqn == "db.v":
            try:
                spark.range(0, 8, 1, 1).mapInArrow(_slow, "id long").count()
            finally:
                ended.append(time.time())
        return real(spark, settings, fqn, *rest)

    monkeypatch.setattr(pg, "commit", noted)
    monkeypatch.setattr(rp, "_apply_table", apply)
    began = time.time()
    with pytest.raises(RuntimeError, match="db.u is broken"):
        rp.replicate(spark, lake)
    assert ended and time.time() - began < 90  # the job of db.v would take far longer
    monkeypatch.undo()
    state = pg.load(spark, lake.target, lake.tables)
    assert (state.checkpoint_ts, [state.tables[t].batch for t in lake.tables]) == (100, [2, 1, 1])
    assert rows_of(spark, lake, "db.t")[0] == (1, "t", 1) and rows_of(spark, lake, "db.u")[0] == (1, "ash", 41)
    (r,) = rp.replicate(spark, lake)
    assert list(r.rows) == ["db.u"] and rows_of(spark, lake, "db.u")[0] == (1, "u", 1)
    assert pg.load(spark, lake.target, lake.tables).checkpoint_ts == 110


def _slow(batches):
    import time

    time.sleep(300)
    yield from batches


def test_snapshot_goes_on_where_it_stopped(spark, lake, monkeypatch):
    _two_tables(spark, lake)
    lake.parallel_tables = 1
    commit = pg.commit

    def failing(spark, root, fqn, *rest):
        if fqn == "db.u":
            raise RuntimeError("lost")
        commit(spark, root, fqn, *rest)

    with monkeypatch.context() as m:
        m.setattr(pg, "commit", failing)
        with pytest.raises(RuntimeError, match="lost"):
            rp.replicate(spark, lake, "snapshot-only")
    first = pg.load(spark, lake.target, lake.tables)
    assert not first.snapshot_finished and [t.batch for t in first.tables.values()] == [1, 0]
    rp.replicate(spark, lake, "snapshot-only")
    then = pg.load(spark, lake.target, lake.tables)
    assert then.snapshot_finished and then.tables["db.t"].live == first.tables["db.t"].live and len(rows_of(spark, lake, "db.u")) == 3


def _files(spark, path):
    return {n for n in storage.list_names(spark, path) if n.startswith("part-")}


def test_runs_in_levels(spark, lake):
    """Rounds write runs only; reads merge them; runs of a level become one; schema changes fold them."""
    lake.deltas, lake.fold, lake.runs, lake.buckets = True, 1e9, 2, 8
    r = random.Random(3)
    have = {i: (f"n{i}", i) for i in range(300)}
    snapshot(spark, lake.source, rows=[(k, *v) for k, v in have.items()])
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    levels, ts, live = [], 101, None
    for n in range(5):
        rows = []
        for _ in range(25):
            k, ts = r.randrange(320), ts + 1
            if r.random() < 0.4:
                have.pop(k, None)
                rows.append(("D", ts, k, "x", 0))
            else:
                have[k] = (f"r{n}", ts)
                rows.append(("U", ts, k, *have[k]))
        changes(spark, lake.source, rows, first_index=n + 1)
        csvio.write_checkpoint(spark, lake.source, ts)
        rp.replicate(spark, lake)
        t = pg.load(spark, lake.target, lake.tables).tables["db.t"]
        live = live or t.live
        assert t.live == live  # no bucket was written
        levels.append([d.level for d in t.deltas])
        assert rows_of(spark, lake) == sorted((k, *v) for k, v in have.items())
    assert levels == [[0], [1], [1, 0], [2], [2, 0]]
    text = rp.read_target(spark, lake, "db.t")._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in text and "Exchange" not in text
    v2 = type(META)("db", "t", (META.columns[0], type(META.columns[0])("label", "varchar", "16"), META.columns[2]), ("id",))
    csvio.write_schema_epoch(spark, lake.source, v2, ts + 1, "ALTER TABLE t RENAME COLUMN name TO label", 5)
    changes(spark, lake.source, [("D", ts + 2, 0, "x", 0), ("I", ts + 3, 900, "new", 9)], version=ts + 1, meta=v2)
    csvio.write_checkpoint(spark, lake.source, ts + 9)
    rp.replicate(spark, lake)
    have.pop(0, None)
    have[900] = ("new", 9)
    assert rows_of(spark, lake) == sorted((k, *v) for k, v in have.items()) and rp.read_target(spark, lake, "db.t").columns == ["id", "label", "amount"]
    assert pg.load(spark, lake.target, lake.tables).tables["db.t"].deltas == []
    base = tg.location(lake.target, "db", "t")
    rp.vacuum(spark, lake, keep_commits=1)
    assert not [n for n in storage.list_names(spark, base) if n.startswith(tg.DELTA) and _files(spark, f"{base}/{n}")]
    assert rows_of(spark, lake) == sorted((k, *v) for k, v in have.items())


def test_bytes_written_follow_changes(spark, lake):
    """One change in each bucket of a large table: a run is a small part of what its buckets are."""
    lake.deltas, lake.buckets = True, 8
    rows = spark.range(60000).select("id", F.sha2(F.col("id").cast("string"), 256).substr(1, 16).alias("name"), F.col("id").alias("amount"))
    csvio.write_snapshot(spark, rows, lake.source, META, 100)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("U", 101 + i, i, "x", 0) for i in range(40)])
    csvio.write_checkpoint(spark, lake.source, 200)
    rp.replicate(spark, lake)
    t = pg.load(spark, lake.target, lake.tables).tables["db.t"]
    base = tg.location(lake.target, "db", "t")
    assert len(tg.buckets_in(spark, f"{base}/{tg.DELTA}={t.deltas[0].version}")) == 8
    assert t.deltas[0].bytes < 0.05 * tg.stored_bytes(spark, base, t.live)
    assert rp.read_target(spark, lake, "db.t").where("name = 'x'").count() == 40
    # Runs that outweigh their share are folded by the round itself.
    lake.fold = 0.001
    changes(spark, lake.source, [("D", 301 + i, i, "x", 0) for i in range(40)], first_index=2)
    csvio.write_checkpoint(spark, lake.source, 400)
    rp.replicate(spark, lake)
    assert pg.load(spark, lake.target, lake.tables).tables["db.t"].deltas == [] and rp.read_target(spark, lake, "db.t").count() == 59960


def test_split_buckets(spark, lake, monkeypatch):
    """Splitting shuffles nothing, every row stays, and a table that grows splits by itself."""
    snapshot(spark, lake.source, rows=[(i, f"n{i}", i) for i in range(2000)])
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    rp.replicate(spark, lake, "snapshot-only")
    want, base = rows_of(spark, lake), tg.location(lake.target, "db", "t")
    plans = []
    real = tg.write_version
    monkeypatch.setattr(tg, "write_version", lambda spark, df, *a, **k: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(spark, df, *a, **k))[1])
    assert rp.rebucket(spark, lake, "db.t")
    t = pg.load(spark, lake.target, lake.tables).tables["db.t"]
    assert (t.buckets, t.batch) == (16, 2) and "Exchange" not in plans[0] and rows_of(spark, lake) == want
    folder = f"{base}/{tg.VERSION}={t.live[0]}"
    assert len(_files(spark, folder)) == 16 and tg.buckets_in(spark, folder) == list(range(16))
    own = tg.read_live(spark, base, t.meta, 16, t.live, bucketed=False).withColumn("b", tg.bucket_of(["id"], 16)).select("b", F.regexp_extract(F.input_file_name(), r"_([0-9]+)\.c", 1).cast("int").alias("f"))
    assert own.where("b <> f").count() == 0
    with pytest.raises(ValueError, match="two or more"):
        rp.rebucket(spark, lake, "db.t", 1)
    monkeypatch.setattr(tg, "SPLIT_BYTES", tg.stored_bytes(spark, base, t.live) // 60)
    changes(spark, lake.source, [("U", 101, 5, "x", 5), ("I", 102, 9000, "y", 6)])
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake)
    t = pg.load(spark, lake.target, lake.tables).tables["db.t"]
    assert t.buckets == 64 and rows_of(spark, lake) == sorted([w for w in want if w[0] != 5] + [(5, "x", 5), (9000, "y", 6)])
    changes(spark, lake.source, [("D", 111, 9000, "y", 6)], first_index=2)
    csvio.write_checkpoint(spark, lake.source, 120)
    rp.replicate(spark, lake)
    assert len(rows_of(spark, lake)) == 2000
