import dataclasses

import pytest

from cdclake.functions.types import ColumnMeta, TableMeta
from cdclake.operators import evolve as ev

SHIP, PORT = ColumnMeta("ship", "bigint", nullable=False, is_pk=True), ColumnMeta("port", "varchar", "20")
CREW, FLAG = ColumnMeta("crew", "int"), ColumnMeta("flag", "varchar", "8", default="none", default_kind="literal")
PREV = TableMeta("sea", "voyages", (SHIP, PORT, CREW, FLAG), ("ship",))


def meta(*cols):
    return dataclasses.replace(PREV, columns=cols)


def run(spark, nxt, query, action=0, prev=PREV, rows=((1, "a", 7, "no"), (2, None, None, None))):
    plan = ev.plan_evolution(prev, nxt, action, query)
    df = spark.createDataFrame(list(rows), prev.ddl())
    out = ev.assert_evolved(ev.evolve(df, plan))
    return plan, [tuple(r) for r in out.orderBy(out.columns[0]).collect()]


def test_add_not_null_default(spark):
    g = ColumnMeta("tons", "decimal", "9", "2", nullable=False, default="12.5", default_kind="literal")
    plan, rows = run(spark, meta(SHIP, PORT, CREW, FLAG, g), "ALTER TABLE sea.voyages ADD tons DECIMAL(9,2) NOT NULL DEFAULT 12.5")
    assert [float(r[4]) for r in rows] == [12.5, 12.5] and plan.rewrites()


def test_drop_and_add_nullable_need_no_rewrite(spark):
    plan, rows = run(spark, meta(SHIP, PORT, FLAG, ColumnMeta("sailed", "date")), "ALTER TABLE voyages DROP COLUMN crew, ADD COLUMN sailed DATE")
    assert rows[0] == (1, "a", "no", None) and not plan.rewrites()


def test_rename(spark):
    plan, rows = run(spark, meta(SHIP, dataclasses.replace(PORT, name="harbour"), CREW, FLAG), "ALTER TABLE sea.voyages RENAME COLUMN port TO harbour")
    assert plan.source["harbour"] == "port" and rows[0] == (1, "a", 7, "no")


def test_swap_names(spark):
    nxt = meta(SHIP, dataclasses.replace(PORT, name="flag"), CREW, dataclasses.replace(FLAG, name="port"))
    _, rows = run(spark, nxt, "ALTER TABLE voyages RENAME COLUMN port TO flag, RENAME COLUMN flag TO port")
    assert rows[0] == (1, "a", 7, "no")


def test_modify_key_to_text(spark):
    _, rows = run(spark, meta(dataclasses.replace(SHIP, tp="varchar", precision="24"), PORT, CREW, FLAG), "ALTER TABLE voyages MODIFY ship VARCHAR(24)")
    assert [r[0] for r in rows] == ["1", "2"]


def test_change_multi(spark):
    wharf, left = ColumnMeta("wharf", "varchar", "40"), ColumnMeta("left_at", "datetime", "3")
    q = "ALTER TABLE voyages CHANGE port wharf VARCHAR(40), ADD left_at DATETIME(3), DROP crew"
    plan, rows = run(spark, meta(SHIP, wharf, FLAG, left), q)
    assert plan.dropped == ["crew"] and rows == [(1, "a", "no", None), (2, None, None, None)]


def test_drop_and_add_again_under_one_name(spark):
    _, rows = run(spark, meta(SHIP, PORT, FLAG, CREW), "ALTER TABLE voyages DROP COLUMN crew, ADD COLUMN crew INT")
    assert rows[0] == (1, "a", "no", None)


def test_no_op_queries(spark):
    for q in ("ALTER TABLE voyages ADD KEY by_port (port)", "ALTER TABLE voyages COMMENT 'drop column crew, rename column port to x'", "  "):
        assert ev.plan_evolution(PREV, PREV, 0, q).kind == "none"
    dropped = meta(SHIP, PORT, CREW, dataclasses.replace(FLAG, default=None, default_kind="none"))
    plan = ev.plan_evolution(PREV, dropped, 0, "ALTER TABLE voyages ALTER COLUMN flag DROP DEFAULT")
    assert plan.kind == "alter" and not plan.rewrites() and plan.dropped == []


def test_quoted_names_are_not_clauses(spark):
    odd = ColumnMeta("drop crew", "int")
    _, rows = run(spark, meta(SHIP, PORT, CREW, FLAG, odd), "ALTER TABLE `rename to x` ADD COLUMN `drop crew` INT")
    assert rows[0] == (1, "a", 7, "no", None)


def test_table_changes():
    assert ev.plan_evolution(PREV, PREV, ev.TRUNCATE_TABLE, "TRUNCATE TABLE t").kind == "truncate"
    assert ev.plan_evolution(None, PREV, ev.DROP_TABLE, "").kind == "drop"
    assert ev.plan_evolution(None, PREV, ev.DROP_SCHEMA, "DROP DATABASE d").kind == "none"
    for action, q in ((ev.RENAME_TABLE, "RENAME TABLE a TO b"), (0, "ALTER TABLE voyages RENAME TO b"), (0, "ALTER TABLE voyages RENAME b"),
                      (ev.CREATE_TABLE, "CREATE TABLE t (id INT)"), (0, "CREATE INDEX i ON voyages(port)")):
        with pytest.raises(ev.UnsupportedChange):
            ev.plan_evolution(PREV, PREV, action, q)


def test_unexplained_differences_fail():
    with pytest.raises(ev.UnsupportedChange, match="vanished"):
        ev.plan_evolution(PREV, meta(SHIP, PORT, FLAG), 0, "ALTER TABLE voyages ADD COLUMN x INT")
    with pytest.raises(ev.UnsupportedChange, match="not found"):
        ev.plan_evolution(PREV, PREV, 0, "ALTER TABLE voyages RENAME COLUMN nope TO harbour")


def test_narrowing(spark):
    small = meta(SHIP, dataclasses.replace(PORT, precision="1"), dataclasses.replace(CREW, tp="tinyint"), FLAG)
    _, rows = run(spark, small, "ALTER TABLE voyages MODIFY port VARCHAR(1), MODIFY crew TINYINT")
    assert rows[0] == (1, "a", 7, "no")
    with pytest.raises(Exception, match="column crew does not fit"):
        run(spark, small, "ALTER TABLE voyages MODIFY port VARCHAR(1), MODIFY crew TINYINT", rows=((1, "a", 300, ""),))
    with pytest.raises(Exception, match="column port does not fit"):
        run(spark, small, "ALTER TABLE voyages MODIFY port VARCHAR(1), MODIFY crew TINYINT", rows=((1, "ab", 3, ""),))


def test_set_not_null(spark):
    nxt = meta(SHIP, dataclasses.replace(PORT, nullable=False), CREW, FLAG)
    with pytest.raises(Exception, match="column port does not fit"):
        run(spark, nxt, "ALTER TABLE voyages MODIFY COLUMN port VARCHAR(20) NOT NULL")
    back = dataclasses.replace(nxt)
    plan = ev.plan_evolution(back, PREV, 0, "ALTER TABLE voyages MODIFY COLUMN port VARCHAR(20) NULL")
    assert plan.kind == "alter" and not plan.rewrites()
