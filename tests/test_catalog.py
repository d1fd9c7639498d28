import re

import pytest
from pyspark.sql import functions as F

from cdclake.functions import ddl
from cdclake.functions import types as ty
from cdclake.sources import catalog, csvio, storage

#: One statement in three layouts: each column on a line, all in one line, several per line.
READINGS = """CREATE TABLE `readings` (
  `station` char(4) NOT NULL,
  `seen_on` date NOT NULL,
  `depth` decimal(7,3) unsigned DEFAULT '0.5',
  `remark` varchar(80) DEFAULT 'dry, (mostly); primary key (x)',
  `stamp` datetime(6) DEFAULT CURRENT_TIMESTAMP(6),
  `litres` double GENERATED ALWAYS AS (round(`depth` * 4, greatest(1, 2))) STORED,
  KEY `by_remark` (`remark`(10)),
  CONSTRAINT `main` PRIMARY KEY (`seen_on`,`station`(2) DESC)
) ENGINE=InnoDB COMMENT='a, b (c)';"""
LAYOUTS = [
    READINGS,
    " ".join(READINGS.split("\n")),
    "-- first\r\nSET time_zone='+00:00';\r\n" + READINGS.replace(",\n  `depth`", ", `depth`").replace(",\n  `stamp`", ",`stamp`").replace("\n", "\r\n").replace("CREATE TABLE", "create table if not exists"),
]


def columns(spark, text, keep=False):
    df = spark.createDataFrame([("d", "t", text)], "db string, table string, text string")
    return {r["name"]: r for r in catalog.ddl_columns(df, keep).orderBy("ordinal").collect()}


@pytest.mark.parametrize("text", LAYOUTS)
def test_any_layout(spark, text):
    cols = columns(spark, text, keep=True)
    assert [(r["name"], r["tp"], r["precision"], r["scale"], r["nullable"], r["is_pk"], r["default_value"], r["default_kind"], r["generated"]) for r in cols.values()] == [
        ("station", "char", "4", "", False, True, None, "none", ""),
        ("seen_on", "date", "", "", False, True, None, "none", ""),
        ("depth", "decimal unsigned", "7", "3", True, False, "0.5", "literal", ""),
        ("remark", "varchar", "80", "", True, False, "dry, (mostly); primary key (x)", "literal", ""),
        ("stamp", "datetime", "6", "", True, False, "CURRENT_TIMESTAMP(6)", "expression", ""),
        ("litres", "double", "", "", True, False, None, "none", "stored"),
    ]
    assert "litres" not in columns(spark, text)
    df = spark.createDataFrame([("d", "readings", text)], "db string, table string, text string")
    (meta,) = catalog.table_metas(catalog.ddl_columns(df))
    assert meta.pk == ("seen_on", "station")


def test_keys_in_one_line(spark):
    key = lambda text: [n for n, r in columns(spark, text).items() if r["is_pk"]]
    assert key("CREATE TABLE k (n bigint primary key, w int);") == ["n"]
    assert key("CREATE TABLE k (w int, n bigint, primary key (n))") == ["n"]
    assert list(columns(spark, "CREATE TABLE k (n bigint, w varchar(5), x enum('a,)','b''c'), y int)")) == ["n", "w", "x", "y"]


def test_types(spark):
    """Lengths that are implied, and types written in another way."""
    one = lambda t: columns(spark, f"CREATE TABLE k (n int primary key, c {t})")["c"]
    assert [(one(t)["tp"], one(t)["precision"]) for t in ("mediumblob", "tinyblob", "bit", "bit(3)")] == [("mediumblob", "16777215"), ("tinyblob", "255"), ("bit", "1"), ("bit", "3")]
    assert one("set('p','q r','s''t')")["elems"] == ["p", "q r", "s't"]
    assert (one("float(30)")["tp"], one("float(20)")["tp"]) == ("double", "float")
    wide = one("numeric(50,4) zerofill")
    assert (wide["tp"], wide["scale"], ty.spark_type(wide["tp"], wide["precision"], wide["scale"])) == ("decimal unsigned", "4", "string")
    odd = one("smallint unsigned not null default '12' comment 'default 3 primary key as (z) stored'")
    assert (odd["tp"], odd["default_value"], odd["nullable"], odd["is_pk"], odd["generated"]) == ("smallint unsigned", "12", False, False, "")


@pytest.mark.parametrize("text", ["", "CREATE VIEW v AS SELECT 1", "CREATE TABLE k (n int, ???)", "CREATE TABLE k (n int"])
def test_texts_that_are_not_understood_fail(spark, text):
    with pytest.raises(Exception, match="no CREATE TABLE|not understood"):
        columns(spark, text)


def test_stored_generated(spark):
    texts = [
        ("CREATE TABLE p (k BIGINT PRIMARY KEY, w DOUBLE AS (sqrt(k)) VIRTUAL)", False),
        ("CREATE TABLE p (w DOUBLE AS (sqrt(k)) STORED, k BIGINT PRIMARY KEY)", True),
        ("ALTER TABLE p ADD w CHAR(3) GENERATED ALWAYS AS (left(upper(n), 3)) STORED AFTER k", True),
        ("ALTER TABLE p ADD stored INT, ADD w INT AS (k) VIRTUAL", False),
        ("ALTER TABLE p MODIFY n TEXT COMMENT 'kept as (k) stored'", False),
    ]
    df = spark.createDataFrame(texts, "q string, want boolean")
    assert df.where(catalog.stored_generated(F.col("q")) != F.col("want")).collect() == []


def test_snapshot_names(spark):
    names = ["db.t.000001.csv.gz", "d%2Eb.t%2Ea.000001.csv", "notes.csv", "db.t-schema.sql", "test-schema-create.sql",
             "d%2Eb-schema-create.sql", "-schema-create.sql", "bad%zz.t.1.csv", "a+b.t.csv", "x..1.csv"]
    files = spark.createDataFrame([("/r/snapshot/" + n, 1) for n in names], "path string, length long")
    got = {(r["db"], r["table"], r["gzip"]) for r in catalog.snapshot_files(files).collect()}
    assert got == {("db", "t", True), ("d.b", "t.a", False), ("a+b", "t", False)}
    assert {r[0] for r in catalog.snapshot_databases(files).collect()} == {"test", "d.b"}
    tables = spark.createDataFrame([("d.b", "t.a")], "db string, table string")
    assert [r["table"] for r in catalog.snapshot_files(files, tables).collect()] == ["t.a"]
    assert [r["db"] for r in catalog.snapshot_databases(files, tables).collect()] == ["d.b"]


def test_written_catalog_reads_back(spark):
    root = storage.scratch_dir(spark)
    meta = ty.TableMeta("d.b", "t.a", (
        ty.ColumnMeta("id", "bigint", nullable=False, is_pk=True),
        ty.ColumnMeta("n", "varchar", "10", default="it's", default_kind="literal"),
        ty.ColumnMeta("x", "decimal unsigned", "12", "3"),
    ), ("id",))
    df = spark.createDataFrame([(1, "a", None)], "id long, n string, x decimal(12,3)")
    csvio.write_snapshot(spark, df, root, meta, 466924115091783691)
    assert catalog.table_metas(catalog.ddl_columns(catalog.read_ddl_texts(spark, root))) == [meta]
    assert catalog.read_snapshot_commit_ts(spark, root) == 466924115091783691
    files = catalog.list_files(spark, f"{root}/snapshot")
    assert [(r["db"], r["table"]) for r in catalog.snapshot_files(files).collect()] == [("d.b", "t.a")]
    csvio.write_schema_epoch(spark, root, meta, 100, "", 3)
    epochs = catalog.schema_epochs(catalog.read_schema_texts(spark, root))
    assert [(int(r["version"]), r["table"]) for r in epochs.collect()] == [(100, "t.a")]
    (back,) = catalog.table_metas(catalog.epoch_columns(epochs))
    assert back.columns[:2] == meta.columns[:2] and back.pk == ("id",)
    assert catalog.read_checkpoint(spark, root) is None
    csvio.write_checkpoint(spark, root, 18446744073709551615)
    assert catalog.read_checkpoint(spark, root) == 18446744073709551615


def test_bad_metadata_fails(spark):
    for text in ["", "Pos: 0", "Pos: x", "Position: 5"]:
        df = spark.createDataFrame([("m", text)], "path string, text string")
        with pytest.raises(Exception, match="no usable Pos"):
            catalog.snapshot_commit_ts(df).collect()
    ok = spark.createDataFrame([("m", "Started\n  Pos: 466924115091783691 \nFinished")], "path string, text string")
    assert int(catalog.snapshot_commit_ts(ok).first()[1]) == 466924115091783691


def _nested(depth, inner="k + 1"):
    return "(" * depth + inner + ")" * depth


@pytest.mark.parametrize("depth", [1, 2, 5, 6, 12, 60])
def test_brackets_of_any_depth(spark, depth):
    text = (f"CREATE TABLE deep (k INT NOT NULL, d DATE DEFAULT {_nested(depth, 'curdate(), 1')} COMMENT 'a) (b', /* not (closed */ w INT GENERATED ALWAYS AS {_nested(depth)} STORED,"
            f" v TEXT AS {_nested(depth, 'concat(k, 1)')} VIRTUAL, CHECK {_nested(depth, 'k > 0')}, PRIMARY KEY (k)) COMMENT='(x'")
    cols = columns(spark, text, keep=True)
    assert [(n, r["generated"], r["default_kind"], r["is_pk"]) for n, r in cols.items()] == [("k", "", "none", True), ("d", "", "expression", False), ("w", "stored", "none", False), ("v", "virtual", "none", False)]
    assert cols["d"]["default_value"] == _nested(depth, "curdate(), 1")
    texts = [(f"ALTER TABLE p ADD COLUMN g INT GENERATED ALWAYS AS {_nested(depth)} STORED", True), (f"ALTER TABLE p ADD COLUMN (a INT, g INT AS {_nested(depth, chr(39) + ')' + chr(39))} stored not null)", True),
             (f"ALTER TABLE p ADD COLUMN g INT AS {_nested(depth)} VIRTUAL, ADD stored INT", False), (f"ALTER TABLE p ADD c INT DEFAULT {_nested(depth)} /* as (k) stored */", False), (None, None)]
    df = spark.createDataFrame(texts, "q string, want boolean")
    assert df.where(~catalog.stored_generated(F.col("q")).eqNullSafe(F.col("want"))).collect() == []


@pytest.fixture
def one_split(spark):
    """Texts of many tables that Spark reads as one split."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark.range(0, 400, 1, 1).select(
        F.lit("d").alias("db"), F.concat(F.lit("t"), "id").alias("table"),
        F.concat(F.lit("CREATE TABLE `t"), "id", F.lit("` (\n `id` int PRIMARY KEY,\n `n` int AS (`id` + 1) STORED\n);")).alias("text"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _parsing_tasks(df):
    """Tasks over which the rows are spread."""
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def test_ddl_columns_of_one_split_are_parsed_by_many_tasks(one_split):
    columns = catalog.ddl_columns(one_split)
    assert columns.count() == 400
    assert _parsing_tasks(columns) > 1


def test_key_columns_are_found_once_per_text(one_split):
    plan = catalog.ddl_columns(one_split)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate ")]
    assert "primary\\s+key\\s*" not in above


def test_pk_admission_of_one_split_is_counted_by_many_tasks(one_split):
    admitted = catalog.pk_admission(catalog.ddl_columns(one_split))
    assert admitted.where("n_pk = 1 and admitted").count() == 400
    parsed = admitted._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < parsed.index("Generate ") < parsed.index("RepartitionByExpression")


def test_generated_columns_of_one_split_are_counted_by_many_tasks(one_split):
    report = catalog.generated_report(one_split)
    assert report.where("n_stored = 1 and n_plain = 1 and not incremental_ok").count() == 400
    parsed = report._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < parsed.index("Generate ") < parsed.index("RepartitionByExpression")


@pytest.fixture
def outlined(spark):
    """flat, groups and the text put together again, per text."""
    def of(*texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", ddl.outline(F.col("t")).alias("o"))
        rows = df.select("i", "o.flat", F.filter("o.groups", lambda g: g.isNotNull()), ddl.restored(F.col("o.flat"), F.col("o.groups"))).orderBy("i").collect()
        return [(re.sub(r"\([0-9]+\)", "()", r[1]), r[2], r[3]) for r in rows]

    return of


@pytest.mark.parametrize("depth", [1, 6, 7, 40])
def test_outline_is_the_same_on_both_ways(outlined, depth):
    """Groups of few levels are found at once, deeper ones and open brackets by running depth."""
    deep = _nested(depth, "k, ')', `(`")
    (whole, shut, open_) = outlined(f"a{deep}b(c -- )\n)", f"a){deep}) '", f"a{deep}b (c {deep}")
    assert whole == ("a()b()", [deep[1:-1], "c  \n"], f"a{deep}b(c  \n)")
    assert shut == (f"a)()) '", [deep[1:-1]], f"a){deep}) '")
    assert open_[0] == "a()b " and open_[1] == [deep[1:-1]]


def test_escaped_line_end_within_quotes(spark):
    cols = columns(spark, "CREATE TABLE q (a varchar(9) DEFAULT 'x\\\n, (y' COMMENT \"p\\\n, q\", /* it's */ b int)")
    assert list(cols) == ["a", "b"] and cols["a"]["default_kind"] == "literal"


def test_groups_of_few_levels_are_one_part(spark):
    """So a text without deeper ones is read without the pass over single brackets."""
    text = "CREATE TABLE t (a int DEFAULT (((((1))))), b int) -- c"
    parts = spark.createDataFrame([(text,)], "t string").select(
        F.regexp_extract_all(ddl.uncommented(F.col("t")), F.lit(rf"{ddl._GROUP}|{ddl._RUN}|[()]"), 0)).first()[0]
    assert parts == ["CREATE TABLE t ", "(a int DEFAULT (((((1))))), b int)", "  "]


def test_generated_columns_after_an_escaped_line_end(spark):
    text = "CREATE TABLE q (a varchar(9) DEFAULT 'x\\\n, y int as (2) stored, ', b int AS ((a + 1)) VIRTUAL, c int AS (b) STORED)"
    df = spark.createDataFrame([("d", "q", text)], "db string, table string, text string")
    assert [tuple(r) for r in catalog.generated_report(df).collect()] == [("d", "q", 1, 1, 1, False)]


def test_groups_are_put_back_only_where_they_are_read(spark):
    """Counting generated columns reads outlines alone; an error names the whole line nevertheless."""
    df = spark.createDataFrame([("d", "t", READINGS)], "db string, table string, text string")
    put_back = r"\([0-9]+\)|(?:"
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString().partition("Generate ")[2]
    assert put_back not in plan(catalog.generated_report(df)) and put_back in plan(catalog.pk_admission(catalog.ddl_columns(df)))
    with pytest.raises(Exception, match=r"not understood in CREATE TABLE of d\.t: \?\(1, \(x\)\) int"):
        columns(spark, "CREATE TABLE t (a int, ?(1,\n(x)) int)").clear()


def test_type_arguments_and_keys_over_line_ends(spark):
    text = "CREATE TABLE t (e enum('a,\n)', 'b') DEFAULT ('b'), `d (1)` decimal(12,\n3) AS (e * (2)) STORED, CONSTRAINT `k` PRIMARY KEY (e\n(3), `d (1)`))"
    rows = [(r["name"], r["tp"], r["precision"], r["scale"], r["generated"], r["pk_ordinal"], r["default_value"]) for r in columns(spark, text, keep=True).values()]
    assert rows == [("e", "enum", "", "", "", 1, "('b')"), ("d (1)", "decimal", "12", "3", "stored", 2, None)]
