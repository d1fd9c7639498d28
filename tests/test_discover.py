from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdclake.functions import names
from cdclake.plans import progress as pg
from cdclake.plans import replicate as rp
from cdclake.functions.types import ColumnMeta, TableMeta
from cdclake.sources import csvio, discover, storage

META = TableMeta("db", "t", (ColumnMeta("id", "int", nullable=False, is_pk=True),), ("id",))


def index(spark, root, version, date, idx, partition=None, text=None):
    stream = f"{root}/increment/db/t/{version}/" + (f"{partition}/" if partition is not None else "") + date
    storage.write_text(spark, f"{stream}/meta/CDC.index", text or f"CDC{idx:015d}.csv\n")


def plan(spark, root, checkpoint, watermark=0, cursors=None):
    """Versions with a schema entry, and ranges, as one round sees them."""
    s = rp.Settings(root, root + "/dst", ["db.t"])
    state = pg.Progress(1, checkpoint, True, {"db.t": pg.TableProgress(watermark, cursors or {})})
    epochs = rp._epochs(spark, s, state)["db.t"]
    ranges = rp._ranges(spark, s, "db.t", epochs, state.tables["db.t"])
    return (
        [e.version for e in epochs if e.status == "pending"],
        [(int(r["version"]), r["partition"], r["date"], r["start_idx"], r["end_idx"]) for r in ranges],
        [(e.version, e.status) for e in epochs],
    )


@pytest.fixture()
def root(spark):
    return storage.scratch_dir(spark)


def schema(spark, root, *versions):
    for v in versions:
        csvio.write_schema_epoch(spark, root, META, v)


def test_cursor_and_new_epoch(spark, root):
    schema(spark, root, 4300, 4420)
    index(spark, root, 4300, "2025-03-04", 3)
    index(spark, root, 4420, "2025-03-04", 2)
    pending, ranges, _ = plan(spark, root, 4360, 4300, {"4300/0/CDC": ("2025-03-04", 1)})
    assert pending == [4420] and ranges == [(4300, 0, "2025-03-04", 2, 3), (4420, 0, "2025-03-04", 1, 2)]


def test_baseline_has_no_schema_entry(spark, root):
    schema(spark, root, 4210, 4300)
    index(spark, root, 4300, "2025-03-04", 1)
    index(spark, root, 4210, "2025-03-04", 1)
    assert plan(spark, root, 4300)[1:] == ([(4300, 0, "2025-03-04", 1, 1)], [(4300, "baseline")])


def test_versions_below_the_watermark_are_stale(spark, root):
    schema(spark, root, 4180, 4210, 4300)
    assert plan(spark, root, 4300, 4300)[2] == [(4300, "current")]


def test_no_upper_bound(spark, root):
    schema(spark, root, 4300, 4510)
    index(spark, root, 4510, "2025-03-04", 2)
    assert plan(spark, root, 4360, 4300)[:2] == ([4510], [(4510, 0, "2025-03-04", 1, 2)])


def test_watermark_beyond_checkpoint(spark, root):
    schema(spark, root, 4420)
    index(spark, root, 4420, "2025-03-04", 1)
    assert plan(spark, root, 4300, 4420)[:2] == ([], [(4420, 0, "2025-03-04", 1, 1)])


@pytest.mark.parametrize("partition", [None, 12])
def test_dates_before_the_active_one(spark, root, partition):
    schema(spark, root, 4300)
    index(spark, root, 4300, "2025-02-27", 5, partition)
    index(spark, root, 4300, "2025-02-28", 2, partition)
    cursors = {f"4300/{partition or 0}/CDC": ("2025-02-28", 1)}
    assert plan(spark, root, 4360, 4300, cursors)[1] == [(4300, partition or 0, "2025-02-28", 2, 2)]


def test_missing_current_schema(spark, root):
    schema(spark, root, 4300)
    with pytest.raises(Exception, match="applied version"):
        plan(spark, root, 4360, 105)


def test_index_of_another_kind_fails(spark, root):
    schema(spark, root, 4300)
    index(spark, root, 4300, "2025-03-04", 1, text="CDC_3f2504e0_000001.csv")
    with pytest.raises(Exception, match="unsupported index file"):
        plan(spark, root, 4360, 4300)


def test_numeric_table_name(spark):
    df = spark.createDataFrame([("s3://b/increment/db/5/4300/2025-03-04/meta/CDC.index", "CDC000010.csv"),
                                ("s3://b/increment/db/5/4300/7/2025-03-04/meta/CDC.index", " CDC3.csv\n")], "path string, text string")
    got = {(r["table"], int(r["version"]), r["partition"], r["idx"], r["width"]) for r in discover.index_rows(df).collect()}
    assert got == {("5", 4300, 0, 10, 6), ("5", 4300, 7, 3, 1)}


def test_file_count_and_expansion(spark):
    r = spark.createDataFrame([("d", "t", 0, 1, 1), ("d", "t", 1, 2, 4)], "db string, table string, kind int, start_idx long, end_idx long")
    assert discover.count_files(r).first()["n_files"] == 3
    big = spark.createDataFrame([(1, 10_000, 6)], "start_idx long, end_idx long, width long")
    out = discover.expand_ranges(big)
    assert out.count() == 10_000 and out.agg(F.countDistinct("file")).first()[0] == 10_000
    assert out.where("idx = 42").first()["file"] == "CDC000042.csv"


def test_names(spark):
    rows = ["test", "d.b", "a%2Eb", "x-schema", "X-Schema.y", "a\x01b", 'q"*/:<>?\\|', "plus+name", "ünïcode"]
    df = spark.createDataFrame([(r,) for r in rows], "n string").select("n", names.escape_name(F.col("n")).alias("e"))
    got = dict(df.collect())
    assert got["d.b"] == "d%2Eb" and got["x-schema"] == "x%2Dschema" and got["X-Schema.y"] == "X%2DSchema%2Ey" and got["a\x01b"] == "a%01b"
    assert {n: names.escape_text(n) for n in rows} == got
    assert df.where(~names.unescape_name(F.col("e")).eqNullSafe(F.col("n"))).collect() == []
    idents = spark.createDataFrame([("abc",), ("a-b",), ("1a",), ("_x$1",), ("a\n",)], "n string").select("n", names.fold_ident(F.col("n")))
    assert dict(idents.collect()) == {"abc": "ABC", "a-b": "a-b", "1a": "1a", "_x$1": "_X$1", "a\n": "a\n"}
    db, table = names.split_table_name(F.lit("a.b.c"))
    assert tuple(spark.range(1).select(db, table).first()) == ("a", "b.c")
    at = spark.range(1).select(names.commit_time(F.lit(Decimal(466924115091783691))).cast("string")).first()[0]
    assert at == "2026-06-11 10:35:45.095"
    with pytest.raises(Exception, match="invalid cursor key"):
        spark.createDataFrame([("1/x/CDC",)], "k string").select(names.parse_cursor_key(F.col("k"))[0]).collect()
