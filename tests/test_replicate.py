import copy

import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta, TableMeta
from cdclake.operators import evolve as ev
from cdclake.operators.select import ColumnSelector
from cdclake.plans import progress as pg
from cdclake.plans import replicate as rp
from cdclake.plans import target as tg
from cdclake.sources import csvio, storage
from cdclake.streaming.rounds import RoundLog, start_rounds

ID, NAME, AMOUNT = ColumnMeta("id", "bigint", nullable=False, is_pk=True), ColumnMeta("name", "varchar", "16"), ColumnMeta("amount", "bigint")
META = TableMeta("db", "t", (ID, NAME, AMOUNT), ("id",))


def rows_of(spark, s, fqn="db.t"):
    return sorted(tuple(r) for r in rp.read_target(spark, s, fqn).collect())


def snapshot(spark, root, rows=((1, "ash", 41), (2, "box", 57), (3, "cob", 63)), meta=META, ts=100):
    df = spark.createDataFrame(list(rows), meta.ddl())
    csvio.write_snapshot(spark, df, root, meta, ts)


def changes(spark, root, rows, version=90, date="2026-07-01", meta=META, **kw):
    """Rows are (flag, commit_ts, *values), in commit order."""
    values = [(r[0], meta.table, meta.db, Decimal(r[1]), *r[2:]) for r in rows]
    df = spark.createDataFrame(values, "cdc_flag string, cdc_table string, cdc_schema string, cdc_commit_ts decimal(20,0), " + meta.ddl())
    return csvio.write_change_files(spark, df.coalesce(1), root, meta, version, date, **kw)


@pytest.fixture()
def lake(spark):
    root = storage.scratch_dir(spark)
    return rp.Settings(f"{root}/src", f"{root}/dst", ["db.t"], csv={"line_sep": "\n"})


def batches(table):
    """Batch of each bucket's live version."""
    return [v >> tg.ATTEMPT_BITS for v in table.live]


def test_end_to_end(spark, lake):
    snapshot(spark, lake.source, rows=((10, "ash", 31), (20, "elm", 7), (30, "fir", 12), (45, "oak", None)))
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("D", 101, 20, "elm", 7), ("I", 102, 51, "yew", 3), ("U", 103, 45, "oak", 18), ("I", 104, 20, "lime", 1), ("D", 105, 30, "fir", 12),
                                 ("U", 100, 10, "late", 0)])
    csvio.write_checkpoint(spark, lake.source, 110)
    (r,) = rp.replicate(spark, lake)
    assert rows_of(spark, lake) == [(10, "ash", 31), (20, "lime", 1), (45, "oak", 18), (51, "yew", 3)]
    assert (r.loaded_files, r.active_tables) == (1, 1)
    assert r.rows["db.t"] == {"insert": 1, "update": 2, "delete": 1, "ignore": 0}
    # Stuck and behind checkpoints start no round.
    assert rp.apply_round(spark, lake)[0].action == "stuck"
    csvio.write_checkpoint(spark, lake.source, 109)
    assert rp.apply_round(spark, lake)[0].action == "behind"
    # More files of the stream; rows above the checkpoint are consumed too.
    changes(spark, lake.source, [("U", 300, 10, "ash", 77)], first_index=2)
    csvio.write_checkpoint(spark, lake.source, 120)
    (r,) = rp.replicate(spark, lake)
    assert r.loaded_files == 1 and rows_of(spark, lake)[0] == (10, "ash", 77)
    state = pg.load(spark, lake.target, lake.tables)
    assert state.tables["db.t"].cursors == {"90/0/CDC": ("2026-07-01", 2)} and state.checkpoint_ts == 120
    # Only the touched bucket was written.
    assert batches(state.tables["db.t"]).count(3) == 1
    log = pg.latest_progress(pg.progress_log(spark, lake.target)).where("cursor is not null").collect()
    assert [(r["table"], r["file_index"]) for r in log] == [("db.t", 2)]


def test_later_date_and_partition(spark, lake):
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("U", 101, 1, "p", 1)], partition=55, date="2026-06-30")
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake)
    # An older date directory that shows up later is not read any more.
    changes(spark, lake.source, [("U", 111, 2, "old", 0)], partition=55, date="2026-06-29")
    changes(spark, lake.source, [("U", 112, 3, "new", 0)], partition=55, date="2026-07-02")
    csvio.write_checkpoint(spark, lake.source, 120)
    (r,) = rp.replicate(spark, lake)
    assert r.loaded_files == 1
    assert rows_of(spark, lake) == [(1, "p", 1), (2, "box", 57), (3, "new", 0)]


def test_epochs_with_ddl(spark, lake):
    """Rename, widen, add and drop between change files of one round."""
    snapshot(spark, lake.source)
    v2 = TableMeta("db", "t", (ID, ColumnMeta("tree", "varchar", "40"), ColumnMeta("amount", "decimal", "20", "2"),
                               ColumnMeta("grade", "int", nullable=False, default="3")), ("id",))
    v3 = TableMeta("db", "t", (ID, v2.columns[1], v2.columns[3]), ("id",))
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, v2, 105, "ALTER TABLE t CHANGE COLUMN name tree VARCHAR(40), MODIFY COLUMN amount DECIMAL(20,2), ADD COLUMN grade INT NOT NULL DEFAULT 3", 70)
    csvio.write_schema_epoch(spark, lake.source, v3, 108, "ALTER TABLE t DROP COLUMN amount", 6)
    changes(spark, lake.source, [("U", 101, 1, "first", 11), ("I", 102, 9, "nine", 99)])
    changes(spark, lake.source, [("U", 106, 1, "second", Decimal("1.50"), 8)], version=105, meta=v2)
    changes(spark, lake.source, [("D", 109, 2, "x", 0), ("U", 110, 9, "third", 5)], version=108, meta=v3)
    csvio.write_checkpoint(spark, lake.source, 120)
    (r,) = rp.replicate(spark, lake)
    assert r.loaded_files == 3
    assert rp.read_target(spark, lake, "db.t").columns == ["id", "tree", "grade"]
    assert rows_of(spark, lake) == [(1, "second", 8), (3, "cob", 3), (9, "third", 5)]
    assert pg.load(spark, lake.target, lake.tables).tables["db.t"].watermark == 108


def test_metadata_only_ddl_and_readded_column(spark, lake):
    snapshot(spark, lake.source)
    v2 = TableMeta("db", "t", (ID, NAME), ("id",))
    v3 = TableMeta("db", "t", (ID, NAME, ColumnMeta("note", "text")), ("id",))
    v4 = TableMeta("db", "t", (*v3.columns, AMOUNT), ("id",))
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, v2, 101, "ALTER TABLE t DROP COLUMN amount", 6)
    csvio.write_schema_epoch(spark, lake.source, v3, 102, "ALTER TABLE t ADD COLUMN note TEXT", 5)
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake)
    state = pg.load(spark, lake.target, lake.tables).tables["db.t"]
    assert set(batches(state)) == {1} and state.hidden == ["amount"] and state.watermark == 102
    assert rows_of(spark, lake) == [(1, "ash", None), (2, "box", None), (3, "cob", None)]
    # The dropped values must not come back under the same name.
    csvio.write_schema_epoch(spark, lake.source, v4, 111, "ALTER TABLE t ADD COLUMN amount BIGINT", 5)
    changes(spark, lake.source, [("U", 112, 1, "a", "n", 5)], version=111, meta=v4)
    csvio.write_checkpoint(spark, lake.source, 120)
    rp.replicate(spark, lake)
    assert rows_of(spark, lake) == [(1, "a", "n", 5), (2, "box", None, None), (3, "cob", None, None)]


def test_truncate_and_drop(spark, lake):
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, META, 105, "TRUNCATE TABLE t", ev.TRUNCATE_TABLE)
    changes(spark, lake.source, [("U", 101, 1, "gone", 0), ("I", 102, 7, "gone", 0)])
    changes(spark, lake.source, [("I", 106, 8, "kept", 0)], version=105)
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake)
    assert rows_of(spark, lake) == [(8, "kept", 0)]
    csvio.write_schema_epoch(spark, lake.source, META, 111, "DROP TABLE t", ev.DROP_TABLE)
    csvio.write_checkpoint(spark, lake.source, 120)
    rp.replicate(spark, lake)
    with pytest.raises(ValueError, match="does not exist"):
        rp.read_target(spark, lake, "db.t")


def test_key_type_change_moves_buckets(spark, lake):
    snapshot(spark, lake.source)
    v2 = TableMeta("db", "t", (ColumnMeta("id", "varchar", "24", nullable=False, is_pk=True), NAME, AMOUNT), ("id",))
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, v2, 105, "ALTER TABLE t MODIFY COLUMN id VARCHAR(24)", 12)
    changes(spark, lake.source, [("U", 106, "1", "x", 1), ("D", 107, "2", "b", 0)], version=105, meta=v2)
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake)
    assert rows_of(spark, lake) == [("1", "x", 1), ("3", "cob", 63)]
    changes(spark, lake.source, [("U", 111, "3", "y", 1)], version=105, meta=v2, first_index=2)
    csvio.write_checkpoint(spark, lake.source, 120)
    rp.replicate(spark, lake)
    assert rows_of(spark, lake) == [("1", "x", 1), ("3", "y", 1)]


def test_unsupported_ddl_changes_nothing(spark, lake):
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, META, 105, "RENAME TABLE t TO u", ev.RENAME_TABLE)
    changes(spark, lake.source, [("U", 101, 1, "x", 0)])
    csvio.write_checkpoint(spark, lake.source, 110)
    with pytest.raises(ev.UnsupportedChange, match="rename table"):
        rp.replicate(spark, lake)
    state = pg.load(spark, lake.target, lake.tables)
    assert (state.batch, state.checkpoint_ts, state.tables["db.t"].watermark) == (1, 100, 0)
    assert len(rows_of(spark, lake)) == 3


def test_lossy_change_fails_only_for_surviving_rows(spark, lake):
    snapshot(spark, lake.source, rows=((1, "abcdefgh", 1), (2, "abc", 2)))
    v2 = TableMeta("db", "t", (ID, ColumnMeta("name", "varchar", "4"), AMOUNT), ("id",))
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, v2, 105, "ALTER TABLE t MODIFY COLUMN name VARCHAR(4)", 12)
    csvio.write_checkpoint(spark, lake.source, 110)
    with pytest.raises(Exception, match="does not fit the new schema"):
        rp.replicate(spark, lake)
    changes(spark, lake.source, [("U", 101, 1, "abcd", 1)])
    rp.replicate(spark, lake)
    assert rows_of(spark, lake) == [(1, "abcd", 1), (2, "abc", 2)]


def test_crash_between_merge_and_commit(spark, lake, monkeypatch):
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("U", 101, 1, "x", 1), ("D", 102, 2, "b", 0), ("I", 103, 4, "d", 4)])
    rp.replicate(spark, lake, "snapshot-only")
    csvio.write_checkpoint(spark, lake.source, 110)
    with monkeypatch.context() as m:
        m.setattr(pg, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            rp.replicate(spark, lake)
    assert len(rows_of(spark, lake)) == 3 and rows_of(spark, lake)[0] == (1, "ash", 41)
    rp.replicate(spark, lake)
    assert rows_of(spark, lake) == [(1, "x", 1), (3, "cob", 63), (4, "d", 4)]


def test_selectors_and_modes(spark, lake):
    snapshot(spark, lake.source)
    lake.selectors = [ColumnSelector(("db.*",), ("*", "!amount"))]
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("U", 101, 1, "x", 1)])
    csvio.write_checkpoint(spark, lake.source, 110)
    assert rp.replicate(spark, lake, "snapshot-only") == []
    assert rows_of(spark, lake) == [(1, "ash"), (2, "box"), (3, "cob")]
    assert len(rp.replicate(spark, lake, "incremental-only")) == 1
    assert rows_of(spark, lake) == [(1, "x"), (2, "box"), (3, "cob")]
    lake.selectors = [ColumnSelector(("db.t",), ("*", "!id"))]
    with pytest.raises(ValueError, match="must stay selected"):
        rp.snapshot_load(spark, lake, pg.Progress())


def test_table_set_must_match(spark, lake):
    snapshot(spark, lake.source)
    rp.replicate(spark, lake, "snapshot-only")
    lake.tables = ["db.t", "db.u"]
    with pytest.raises(pg.ProgressError, match="not stored"):
        rp.replicate(spark, lake)


def test_progress_guards():
    prev = pg.Progress(1, 100, True, {"t": pg.TableProgress(5, {"1/0/CDC": ("2026-07-01", 3)})})
    pg.check_forward(prev, pg.Progress(2, 100, True, {"t": pg.TableProgress(4, {"1/0/CDC": ("2026-07-02", 1)})}))
    with pytest.raises(pg.ProgressError, match="checkpoint"):
        pg.check_forward(prev, pg.Progress(2, 99, True, {}))
    with pytest.raises(pg.ProgressError, match="cursor"):
        pg.check_forward(prev, pg.Progress(2, 101, True, {"t": pg.TableProgress(5, {"1/0/CDC": ("2026-07-01", 2)})}))


def test_stored_generated_is_rejected(spark, lake):
    snapshot(spark, lake.source)
    v2 = TableMeta("db", "t", (*META.columns, ColumnMeta("s", "int")), ("id",))
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, v2, 105, "ALTER TABLE t ADD COLUMN s INT AS (id+1) STORED", 5)
    csvio.write_checkpoint(spark, lake.source, 110)
    with pytest.raises(ev.UnsupportedChange, match="STORED"):
        rp.replicate(spark, lake)
    lake.reject_stored_generated = False
    assert len(rp.replicate(spark, lake)) == 1


def test_stream_resumes(spark, lake):
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("U", 101, 1, "x", 1)])
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake, "snapshot-only")
    done = []
    place = lake.target + "/_stream"
    start_rounds(spark, lake, place, None, done.append).awaitTermination()
    assert [r.loaded_files for r in done] == [1] and rows_of(spark, lake)[0] == (1, "x", 1)
    changes(spark, lake.source, [("D", 111, 1, "x", 1)], first_index=2)
    csvio.write_checkpoint(spark, lake.source, 120)
    start_rounds(spark, lake, place, None, done.append).awaitTermination()
    assert [(r.announced_files, r.loaded_files) for r in done] == [(1, 1), (1, 1)] and rows_of(spark, lake)[0] == (2, "box", 57)
    log = RoundLog()
    spark.streams.addListener(log)
    q = start_rounds(spark, lake, place, "1 second", done.append)
    changes(spark, lake.source, [("I", 121, 1, "back", 1)], first_index=3)
    csvio.write_checkpoint(spark, lake.source, 130)
    q.processAllAvailable()
    q.stop()
    deadline = time.time() + 30  # reports arrive later than the batch
    while not log.reports and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(log)
    assert log.errors == [] and sum(r["descriptors"] for r in log.reports) >= 1
    assert not any(purpose.startswith("round") for _, purpose in tg._handles)
    assert rows_of(spark, lake)[0] == (1, "back", 1)


def test_merge_plan_shuffles_only_changes(spark, lake):
    """The target side of a merge has no exchange below its join."""
    from cdclake.operators.changes import latest_change, merge_changes

    snapshot(spark, lake.source)
    rp.replicate(spark, lake, "snapshot-only")
    state = pg.load(spark, lake.target, lake.tables).tables["db.t"]
    target = tg.read_live(spark, tg.location(lake.target, "db", "t"), META, 8, state.live)
    fresh = target.select(F.lit("U").alias("cdc_flag"), F.lit(1).cast("decimal(20,0)").alias("cdc_commit_ts"), "*")
    base = tg.location(lake.target, "db", "t")
    path = f"{base}/_staging/plan"
    tg.write_bucketed(spark, latest_change(fresh, ["id"]), path, ["id"], 8)
    staged = tg.read_bucketed(spark, path, "cdc_flag string, cdc_commit_ts decimal(20,0), " + META.ddl(), ["id"], 8)
    plan = lambda: merge_changes(target, staged, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan() and "Exchange" not in plan() and plan().count("Sort [") == 2
    with tg.sorted_buckets(spark):
        assert "FullOuter" in plan() and "Exchange" not in plan() and "Sort [" not in plan()
    assert plan().count("Sort [") == 2


def test_sparse_rounds_touch_few_buckets(spark, lake):
    """Few touched buckets out of many: same result, only those are written."""
    lake.buckets = 64
    snapshot(spark, lake.source, rows=[(i, f"n{i}", i) for i in range(500)])
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("U", 101, 7, "x", 1), ("D", 102, 8, "x", 1), ("I", 103, 900, "y", 2)])
    csvio.write_checkpoint(spark, lake.source, 110)
    (r,) = rp.replicate(spark, lake)
    assert r.rows["db.t"] == {"insert": 1, "update": 1, "delete": 1, "ignore": 0}
    want = sorted([(i, f"n{i}", i) for i in range(500) if i not in (7, 8)] + [(7, "x", 1), (900, "y", 2)])
    assert rows_of(spark, lake) == want
    state = pg.load(spark, lake.target, lake.tables).tables["db.t"]
    assert 1 <= batches(state).count(2) <= 3
    # The next round reads several versions side by side.
    changes(spark, lake.source, [("D", 111, 900, "y", 2), ("U", 112, 9, "z", 3)], first_index=2)
    csvio.write_checkpoint(spark, lake.source, 120)
    rp.replicate(spark, lake)
    want = sorted([w for w in want if w[0] not in (900, 9)] + [(9, "z", 3)])
    assert rows_of(spark, lake) == want
    # Bucket files hold exactly their bucket.
    df = rp.read_target(spark, lake, "db.t")
    assert df.groupBy("id").count().where("count > 1").count() == 0


def test_half_written_snapshot(spark, lake):
    with pytest.raises(ValueError, match="no snapshot"):
        rp.replicate(spark, lake)
    storage.write_text(spark, f"{lake.source}/snapshot/db.t.000000001.csv", "1,a,1\n")
    with pytest.raises(ValueError, match="not complete"):
        rp.replicate(spark, lake)


def test_several_tables_in_one_commit(spark, lake):
    other = TableMeta("db", "u", (ColumnMeta("a", "int", nullable=False, is_pk=True), ColumnMeta("b", "varchar", "8", nullable=False, is_pk=True), ColumnMeta("v", "text")), ("b", "a"))
    lake.tables = ["db.t", "db.u"]
    snapshot(spark, lake.source)
    snapshot(spark, lake.source, rows=((1, "x", None), (1, "y", "")), meta=other)
    for m in (META, other):
        csvio.write_schema_epoch(spark, lake.source, m, 90)
    changes(spark, lake.source, [("D", 101, 1, "a", 0)])
    changes(spark, lake.source, [("D", 101, 1, "x", None), ("I", 102, 1, "z", "a,\"b\"\nc"), ("U", 103, 1, "y", "\\n")], meta=other)
    csvio.write_checkpoint(spark, lake.source, 110)
    (r,) = rp.replicate(spark, lake)
    assert (r.active_tables, r.loaded_files) == (2, 2)
    assert [x[0] for x in rows_of(spark, lake)] == [2, 3]
    assert rows_of(spark, lake, "db.u") == [(1, "y", "\\n"), (1, "z", "a,\"b\"\nc")]


def test_incremental_without_snapshot(spark, lake):
    """Changes alone build the table; old files stay until vacuumed."""
    lake.keep_old_files = True
    v2 = TableMeta("db", "t", (ID, NAME), ("id",))
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    csvio.write_schema_epoch(spark, lake.source, v2, 105, "ALTER TABLE t DROP COLUMN amount", 6)
    changes(spark, lake.source, [("I", 91, 1, "a", 1), ("I", 92, 2, "b", 2), ("D", 93, 1, "a", 1)])
    csvio.write_checkpoint(spark, lake.source, 95)
    with pytest.raises(ValueError, match="unknown mode"):
        rp.replicate(spark, lake, "some")
    rp.replicate(spark, lake, "incremental-only")
    assert rows_of(spark, lake) == [(2, "b")]
    changes(spark, lake.source, [("U", 106, 2, "z")], version=105, meta=v2)
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake, "incremental-only")
    base = tg.location(lake.target, "db", "t")
    folders = lambda: [n for n in storage.list_names(spark, base) if "=" in n and any(f.startswith("part-") for f in storage.list_names(spark, f"{base}/{n}"))]
    versions = lambda: [int(n.split("=")[1]) >> tg.ATTEMPT_BITS for n in folders()]
    assert sorted(versions()) == [1, 2]
    rp.vacuum(spark, lake)
    assert sorted(versions()) == [1, 2]
    rp.vacuum(spark, lake, keep_commits=1)
    assert versions() == [2]
    assert rows_of(spark, lake) == [(2, "z")]


def _two_rounds(spark, lake):
    snapshot(spark, lake.source)
    csvio.write_schema_epoch(spark, lake.source, META, 90)
    changes(spark, lake.source, [("U", 101, 1, "first", 1), ("I", 102, 40, "new", 4)])
    csvio.write_checkpoint(spark, lake.source, 110)


def test_two_writers(spark, lake):
    """Of two rounds from one state the first to commit counts, whole and alone."""
    _two_rounds(spark, lake)
    rp.replicate(spark, lake, "snapshot-only")
    state = pg.load(spark, lake.target, lake.tables)
    rp.apply_round(spark, lake, copy.deepcopy(state))
    want = rows_of(spark, lake)
    changes(spark, lake.source, [("U", 111, 2, "second", 2), ("D", 112, 1, "first", 1)], first_index=2)
    csvio.write_checkpoint(spark, lake.source, 120)
    with pytest.raises(pg.ProgressError, match="another writer"):
        rp.apply_round(spark, lake, copy.deepcopy(state))
    assert rows_of(spark, lake) == want and pg.load(spark, lake.target, lake.tables).checkpoint_ts == 110
    rp.replicate(spark, lake)
    assert rows_of(spark, lake)[0] == (2, "second", 2)


def test_held_reader(spark, lake):
    _two_rounds(spark, lake)
    lake.keep_commits = 2
    rp.replicate(spark, lake, "snapshot-only")
    entries = lambda: {e.name for e in spark.catalog.listTables()}
    before = entries()
    held = rp.read_target(spark, lake, "db.t")
    want = sorted(map(tuple, held.collect()))
    assert entries() == before
    rp.replicate(spark, lake)
    assert sorted(map(tuple, rp.read_target(spark, lake, "db.t").collect())) != want
    assert sorted(map(tuple, held.collect())) == want
    for k in range(3):  # beyond the kept commits a held reader fails, and never has fewer rows
        changes(spark, lake.source, [("U", 200 + k, i, "x", k) for i in range(1, 60)], first_index=2 + k)
        csvio.write_checkpoint(spark, lake.source, 210 + k)
        rp.replicate(spark, lake)
    with pytest.raises(Exception):
        held.select("name").collect()


def test_progress_archive(spark, lake):
    _two_rounds(spark, lake)
    lake.keep_progress, lake.keep_commits = 1, 1
    for k in range(3):
        rp.replicate(spark, lake)
        changes(spark, lake.source, [("U", 200 + k, 1, "x", k)], first_index=2 + k)
        csvio.write_checkpoint(spark, lake.source, 210 + k)
    rp.replicate(spark, lake)
    log = pg.progress_log(spark, lake.target)
    assert sorted({r.batch for r in log.collect()}) == list(range(1, pg.newest_batch(spark, lake.target) + 1))
    assert storage.exists(spark, f"{lake.target}/_progress/archive")


def test_table_names_with_pattern_signs(spark, lake):
    odd = TableMeta("d[b]", "t{a}", META.columns, ("id",))
    lake.tables = ["d[b].t{a}"]
    snapshot(spark, lake.source, meta=odd)
    csvio.write_schema_epoch(spark, lake.source, odd, 90)
    changes(spark, lake.source, [("D", 101, 1, "a", 0)], meta=odd)
    csvio.write_checkpoint(spark, lake.source, 110)
    rp.replicate(spark, lake)
    assert [r[0] for r in rows_of(spark, lake, "d[b].t{a}")] == [2, 3]
