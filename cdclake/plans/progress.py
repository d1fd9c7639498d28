"""Durable progress: a log of commits per table, and one of the checkpoint that all tables have reached.

A writer puts its row into a file of its own and then proposes it as the next entry of
the table's log (``commits``), which only one writer's row becomes. That is the commit
point of a table's snapshot or of its part of a round: data written before it stays
invisible until then, and for ever if another writer was first. Tables commit one by one,
so what one has done stands if another fails; a restart finds it has nothing left to do.

Each table's row says which checkpoint it has been brought to. The log of all tables holds
the least of them, which is the checkpoint that rounds go on from.
"""

from __future__ import annotations

import itertools
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.names import escape_text
from cdclake.functions.types import TableMeta
from cdclake.plans import commits
from cdclake.sources import storage

FORMAT = 3
_SCHEMA = """
  format int, table string, batch bigint, checkpoint_ts decimal(20,0), snapshot_ts decimal(20,0),
  watermark decimal(20,0), cursors map<string, struct<date: string, file_index: bigint>>,
  meta string, buckets int, live array<struct<version: bigint, n: int>>, hidden array<string>, dropped boolean,
  deltas array<struct<version: bigint, level: int, bytes: bigint>>
"""


class ProgressError(ValueError):
    """Progress that does not fit: moved backward, or of other tables."""


@dataclass
class Delta:
    """A run of changes that reads merge with the buckets; a run of level n holds several of level n - 1."""

    version: int
    level: int
    bytes: int


@dataclass
class TableProgress:
    """State of one table.

    ``watermark`` is the applied table version. ``cursors`` maps a stream key
    to its date and last consumed file. ``live`` holds, per hash bucket, the
    data version that is current; ``deltas`` the runs on top of them, oldest
    first; ``hidden`` the dropped columns that stored files may still contain.
    ``batch`` counts the table's commits, ``checkpoint_ts`` is what it has been
    brought to, ``snapshot_ts`` the snapshot it was loaded from.
    """

    watermark: int = 0
    cursors: dict[str, tuple[str, int]] = field(default_factory=dict)
    meta: TableMeta | None = None
    buckets: int = 0
    live: list[int] = field(default_factory=list)
    hidden: list[str] = field(default_factory=list)
    dropped: bool = False
    batch: int = 0
    checkpoint_ts: int = 0
    snapshot_ts: int = 0
    deltas: list[Delta] = field(default_factory=list)


@dataclass
class Progress:
    batch: int = 0
    checkpoint_ts: int = 0
    snapshot_finished: bool = False
    tables: dict[str, TableProgress] = field(default_factory=dict)


def _dir(root: str) -> str:
    return f"{root}/_progress"


def _log(spark: SparkSession, root: str, fqn: str | None = None) -> commits.Store:
    """The log of a table, or that of all tables."""
    return commits.Store(spark, f"{_dir(root)}/{'all' if fqn is None else 'table=' + escape_text(fqn)}")


def _each(work, items: list, parallel: int = 32) -> list:
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(work, items))


def newest_batch(spark: SparkSession, root: str) -> int | None:
    """Newest commit of all tables together."""
    found = commits.newest(_log(spark, root))
    return found[0] if found else None


def progress_log(spark: SparkSession, root: str) -> DataFrame:
    """All commits of tables, one row per table and stream."""
    found = []
    for name in storage.list_names(spark, _dir(root)):
        if name.startswith("table="):
            log = commits.Store(spark, f"{_dir(root)}/{name}")
            found += [f"{log.folder}/{v}" for v in _each(lambda n, log=log: commits.value_of(log, n), commits.entries(log)) if v]
    rows = spark.read.schema(_SCHEMA).json([storage.literal(p) for p in found])
    if storage.exists(spark, f"{_dir(root)}/archive"):
        rows = rows.unionByName(spark.read.schema(_SCHEMA).parquet(storage.literal(f"{_dir(root)}/archive")))
    # A commit is in both places if archiving stopped halfway.
    rows = rows.dropDuplicates(["table", "batch"])
    return rows.select(
        "batch", "checkpoint_ts", F.col("snapshot_ts").isNotNull().alias("snapshot_finished"), "table", "watermark",
        F.explode_outer("cursors").alias("cursor", "c"),
    ).select("*", F.col("c.date").alias("date"), F.col("c.file_index").alias("file_index")).drop("c")


def latest_progress(log: DataFrame) -> DataFrame:
    """Highest progress per table and stream of a progress log."""
    at = F.max(F.struct("date", "file_index"))
    return log.groupBy("table", "cursor").agg(
        F.max("checkpoint_ts").alias("checkpoint_ts"), F.max("watermark").alias("watermark"),
        F.max("batch").alias("batch"), at["date"].alias("date"), at["file_index"].alias("file_index"))


def round_summary(work: DataFrame) -> DataFrame:
    """Active tables and loaded files per batch; schema entries (kind 0) load none."""
    n = F.when((F.col("kind") == 1) & (F.col("end_idx") >= F.col("start_idx")), F.col("end_idx") - F.col("start_idx") + 1).otherwise(0)
    # One row per table first, so that distinct tables are counted without expansion.
    per_table = work.groupBy("batch", "table").agg(F.sum(n).alias("n"))
    return per_table.groupBy("batch").agg(F.count("*").alias("active_tables"), F.sum("n").alias("loaded_files"))


def validate(progress: Progress, tables: list[str]) -> None:
    """The stored table set must equal the configured one."""
    extra, missing = sorted(set(progress.tables) - set(tables)), sorted(set(tables) - set(progress.tables))
    if extra or missing:
        raise ProgressError(f"progress does not match the configured tables: not configured {extra}, not stored {missing}")


def load(spark: SparkSession, root: str, tables: list[str]) -> Progress:
    """Newest committed progress of all tables, fresh where there is none."""
    out = Progress(tables={t: TableProgress() for t in tables})
    found = commits.newest(_log(spark, root))
    if found is not None:
        row = json.loads(storage.read_text(spark, f"{_log(spark, root).folder}/{found[1]}"))
        if row["format"] != FORMAT:
            raise ProgressError(f"unsupported progress format {row['format']}")
        out = Progress(row["batch"], row["checkpoint_ts"], row["snapshot_finished"], {t: TableProgress() for t in row["tables"]})
        validate(out, tables)
    elif storage.list_names(spark, _dir(root)):
        older = [n for n in storage.list_names(spark, _dir(root)) if n.startswith("commit=")]
        if older:
            raise ProgressError(f"unsupported progress format: {_dir(root)}/{older[-1]}")
    out.tables.update(zip(tables, _each(lambda t: load_table(spark, root, t), tables)))
    return out


def load_table(spark: SparkSession, root: str, fqn: str) -> TableProgress:
    """Newest committed progress of one table."""
    log = _log(spark, root, fqn)
    found = commits.newest(log)
    return TableProgress() if found is None else _parse(fqn, _row(log, found[1]))


def _row(log: commits.Store, name: str) -> dict:
    return json.loads(storage.read_text(log.spark, f"{log.folder}/{name}"))


def recent_tables(spark: SparkSession, root: str, fqn: str, keep: int) -> list[TableProgress]:
    """What the newest commits of a table said, oldest first."""
    log = _log(spark, root, fqn)
    values = _each(lambda n: commits.value_of(log, n), commits.entries(log)[-keep:])
    return [_parse(fqn, r) for r in _each(lambda v: _row(log, v), [v for v in values if v])]


def _packed(live: list[int]) -> list[dict]:
    """Runs of equal versions."""
    return [dict(version=v, n=len(list(g))) for v, g in itertools.groupby(live)]


def _unpacked(runs) -> list[int]:
    return [r["version"] for r in runs for _ in range(r["n"])]


def _parse(fqn: str, row: dict) -> TableProgress:
    if row["format"] != FORMAT:
        raise ProgressError(f"unsupported progress format {row['format']}")
    if row["cursors"] is None:
        raise ProgressError(f"progress misses the cursors of {fqn}")
    return TableProgress(
        row["watermark"], {k: (c["date"], c["file_index"]) for k, c in row["cursors"].items()},
        TableMeta.from_json(row["meta"]) if row["meta"] else None, row["buckets"], _unpacked(row["live"]), row["hidden"], row["dropped"],
        row["batch"], row["checkpoint_ts"], row["snapshot_ts"] or 0, [Delta(**d) for d in row["deltas"]])


def check_table(name: str, prev: TableProgress, nxt: TableProgress) -> None:
    """Cursors never move backward; watermarks only grow."""
    nxt.watermark = max(nxt.watermark, prev.watermark)
    for key, cursor in prev.cursors.items():
        if nxt.cursors.get(key, ("", 0)) < cursor:
            raise ProgressError(f"cursor cannot move backward: {name} {key}")


def check_forward(prev: Progress, nxt: Progress) -> None:
    """Checkpoint and cursors never move backward; watermarks only grow."""
    if nxt.checkpoint_ts <= 0:
        raise ProgressError("checkpoint is empty")
    if nxt.checkpoint_ts < prev.checkpoint_ts:
        raise ProgressError(f"checkpoint cannot move backward: {prev.checkpoint_ts} to {nxt.checkpoint_ts}")
    for name, t in nxt.tables.items():
        check_table(name, prev.tables.get(name, TableProgress()), t)


def _commit(log: commits.Store, batch: int, row: dict, what: str) -> None:
    """Make a row the next entry of a log; fails when another writer's row has become it."""
    name = f"row={batch}-{uuid.uuid4().hex}.json"
    storage.write_text(log.spark, f"{log.folder}/{name}", json.dumps(row) + "\n")
    if commits.propose(log, batch, name) != name:
        log.delete([name])
        raise ProgressError(f"batch {batch} of {what} was committed by another writer")


def commit(spark: SparkSession, root: str, fqn: str, prev: TableProgress, nxt: TableProgress) -> None:
    """Commit one table. Its other work, and other tables, are not waited for."""
    check_table(fqn, prev, nxt)
    nxt.batch = prev.batch + 1
    _commit(_log(spark, root, fqn), nxt.batch, dict(
        format=FORMAT, table=fqn, batch=nxt.batch, checkpoint_ts=nxt.checkpoint_ts, snapshot_ts=nxt.snapshot_ts or None,
        watermark=nxt.watermark, cursors={k: dict(date=d, file_index=i) for k, (d, i) in nxt.cursors.items()},
        meta=nxt.meta.to_json() if nxt.meta else None, buckets=nxt.buckets, live=_packed(nxt.live), hidden=nxt.hidden, dropped=nxt.dropped,
        deltas=[vars(d) for d in nxt.deltas]), fqn)


def advance(spark: SparkSession, root: str, prev: Progress, nxt: Progress) -> None:
    """Commit the checkpoint that all tables have reached."""
    check_forward(prev, nxt)
    row = dict(format=FORMAT, batch=nxt.batch, checkpoint_ts=nxt.checkpoint_ts, snapshot_finished=nxt.snapshot_finished, tables=sorted(nxt.tables))
    _commit(_log(spark, root), nxt.batch, row, "all tables")


def archive(spark: SparkSession, root: str, tables: list[str], keep: int) -> None:
    """Once twice as many rows of a table as are to be kept lie about singly, move the older ones into one table.

    Rows of the log of all tables that are no longer needed are deleted.
    """
    def old_of(fqn: str | None) -> tuple[commits.Store, list[int]]:
        log = _log(spark, root, fqn)
        found = commits.entries(log)
        return log, found[:-keep] if len(found) >= 2 * keep else []

    found = [x for x in _each(old_of, list(tables)) if x[1]]
    rows = {log.folder: [v for v in _each(lambda n, log=log: commits.value_of(log, n), old) if v] for log, old in found}
    paths = [storage.literal(f"{folder}/{v}") for folder, values in rows.items() for v in values]
    if paths:
        spark.read.schema(_SCHEMA).json(paths).coalesce(1).write.mode("append").parquet(f"{_dir(root)}/archive")
    everywhere = old_of(None)
    for log, old in [*found, everywhere]:
        values = rows[log.folder] if log.folder in rows else [v for v in (commits.value_of(log, n) for n in old) if v]
        commits.forget(log, old)
        log.delete(values)
