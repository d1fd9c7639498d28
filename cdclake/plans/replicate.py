"""Snapshot load and incremental rounds.

A round reads the checkpoint, finds new files, and turns them into at most one
merge per table. Each table commits when its merge is done, and is visible from
then on; when all have, the checkpoint moves on. If a table fails, jobs of the
others are cancelled, what was committed stands, and the next round finishes the
rest. What a writer leaves that did not commit is never read, and goes with a
later vacuum.
"""

from __future__ import annotations

import copy
import hashlib
import json
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.types import TableMeta, quote
from cdclake.operators import evolve as ev
from cdclake.operators import reconcile
from cdclake.operators.changes import latest_change, merge_changes
from cdclake.operators.select import ColumnSelector, select_meta
from cdclake.plans import progress as pg
from cdclake.plans import target as tg
from cdclake.sources import catalog, csvio, discover, storage
from cdclake.sources.local import local_rows, no_rows

MODES = ("all", "snapshot-only", "incremental-only")


@dataclass
class Settings:
    """What to replicate and how."""

    source: str
    target: str
    tables: list[str]
    selectors: list[ColumnSelector] = field(default_factory=list)
    reject_stored_generated: bool = True
    # Options of the CSV reader: escape, multiline, line_sep.
    csv: dict = field(default_factory=dict)
    buckets: int | None = None
    # Tables worked on at a time; each submits its own Spark jobs.
    parallel_tables: int = 16
    # Files of replaced versions stay for the readers of this many commits.
    keep_commits: int = 10
    # Keep files of replaced versions until `vacuum` is called.
    keep_old_files: bool = False
    # Newest progress rows that are kept singly; older ones are put together.
    keep_progress: int = 1000
    # Write changes as runs that reads merge, instead of writing touched buckets anew.
    deltas: bool = False
    # Runs of a level that are put together into one of the next.
    runs: int = 4
    # Share of a table's bytes that runs may take before they are folded into its buckets.
    fold: float = 0.25
    # Split buckets that have grown; a number of buckets given above stays.
    split_buckets: bool = True


@dataclass
class RoundResult:
    """What one round did. ``action`` is run, absent, behind or stuck."""

    action: str
    batch: int
    checkpoint_ts: int
    active_tables: int = 0
    loaded_files: int = 0
    # Files that a streaming batch announced.
    announced_files: int = 0
    # Rows by action and table.
    rows: dict[str, dict[str, int]] = field(default_factory=dict)


def split_fqn(fqn: str) -> tuple[str, str]:
    """``db.table`` cut at the first dot."""
    db, dot, table = fqn.partition(".")
    if not dot or not db or not table:
        raise ValueError(f"invalid table name {fqn!r}")
    return db, table


class Cancelled(RuntimeError):
    """Another table failed."""


def _each_table(spark: SparkSession, settings: Settings, work: Callable[[str, Callable[[], None]], object]) -> list:
    """Run ``work(fqn, alive)`` for all tables side by side.

    When one fails, Spark jobs of the others are cancelled by their tag, ``alive`` raises where
    they are between jobs, and tables that have not begun don't. The first error is raised once all have ended.
    """
    tag, stop, errors = f"cdclake-{uuid.uuid4().hex}", threading.Event(), []

    def alive() -> None:
        if stop.is_set():
            raise Cancelled("another table failed")

    def one(fqn: str):
        try:
            spark.sparkContext.addJobTag(tag)
            alive()
            return work(fqn, alive)
        except BaseException as e:  # noqa: BLE001 - raised below
            if not stop.is_set():
                errors.append(e)
                stop.set()

    with ThreadPoolExecutor(max(1, min(settings.parallel_tables, len(settings.tables)))) as pool:
        futures = [pool.submit(_inherit(one), t) for t in settings.tables]
        while wait(futures, timeout=0.2).not_done:
            if stop.is_set():  # again and again: a table may be about to submit a job
                spark.sparkContext.cancelJobsWithTag(tag)
    if errors:
        raise errors[0]
    return [f.result() for f in futures]


def _inherit(work):
    """Carry the caller's job group and scheduler pool into worker threads."""
    def run(arg):
        box = []
        t = InheritableThread(target=lambda: box.append(work(arg)))
        t.start()
        t.join()
        return box[0]

    return run


# --------------------------------------------------------------------------
# Snapshot
# --------------------------------------------------------------------------

def snapshot_metas(spark: SparkSession, settings: Settings) -> dict[str, TableMeta]:
    """Schemas of all configured tables; every one must exist and have a key."""
    wanted = local_rows(spark, [dict(zip(("db", "table"), split_fqn(t))) for t in settings.tables], "db string, table string")
    texts = catalog.read_ddl_texts(spark, settings.source).join(F.broadcast(wanted), ["db", "table"], "left_semi")
    metas = {f"{m.db}.{m.table}": m for m in catalog.table_metas(catalog.ddl_columns(texts))}
    for t in settings.tables:
        if t not in metas:
            raise ValueError(f"snapshot has no schema file of table {t}")
        if not metas[t].pk:
            raise ValueError(f"table {t} has no primary key")
    return metas


def snapshot_load(spark: SparkSession, settings: Settings, state: pg.Progress) -> pg.Progress:
    """Replace all target tables by the snapshot, each in a commit of its own, and commit its timestamp.

    Tables that an earlier, unfinished attempt loaded from the same snapshot are not loaded again.
    """
    if not storage.exists(spark, f"{settings.source}/snapshot/metadata"):
        half = catalog.has_files(spark, f"{settings.source}/snapshot")
        raise ValueError("snapshot is not complete: no metadata file" if half else "no snapshot")
    commit_ts = catalog.read_snapshot_commit_ts(spark, settings.source)
    metas = snapshot_metas(spark, settings)

    def load(fqn: str, alive: Callable[[], None]) -> pg.TableProgress:
        before = state.tables.get(fqn, pg.TableProgress())
        if before.snapshot_ts == commit_ts:
            return before  # an earlier attempt has loaded this table
        meta = metas[fqn]
        kept = select_meta(meta, settings.selectors)
        found = csvio.snapshot_paths(spark, settings.source, meta)
        size = sum(n * (tg.GZIP_RATIO if p.endswith(".gz") else 1) for p, n in found)
        buckets = settings.buckets or tg.bucket_count(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
        if found:
            rows = csvio.read_snapshot(spark, [storage.literal(p) for p, _ in found], meta, **settings.csv)
        else:
            rows = no_rows(spark, meta.ddl())
        rows = rows.select(*[F.col(quote(n)) for n in kept.names])
        version = tg.new_version(before.batch + 1)
        tg.write_version(spark, rows, tg.location(settings.target, meta.db, meta.table), version, list(meta.pk), buckets)
        alive()
        nxt = pg.TableProgress(meta=kept, buckets=buckets, live=[version] * buckets, checkpoint_ts=commit_ts, snapshot_ts=commit_ts)
        pg.commit(spark, settings.target, fqn, before, nxt)
        return nxt

    loaded = _each_table(spark, settings, load)
    nxt = pg.Progress(state.batch + 1, commit_ts, True, dict(zip(settings.tables, loaded)))
    pg.advance(spark, settings.target, state, nxt)
    return nxt


# --------------------------------------------------------------------------
# One round
# --------------------------------------------------------------------------

@dataclass
class _Epoch:
    version: int
    status: str
    query: str
    action: int
    meta: TableMeta


def _epochs(spark: SparkSession, settings: Settings, state: pg.Progress) -> dict[str, list[_Epoch]]:
    """Schema epochs each table needs this round, in version order."""
    texts = catalog.read_schema_texts(spark, settings.source, settings.tables, {t: p.watermark for t, p in state.tables.items()})
    marks = local_rows(
        spark, [dict(zip(("db", "table"), split_fqn(t)), watermark=p.watermark) for t, p in state.tables.items()],
        "db string, table string, watermark decimal(20,0)")
    # Tables and versions are catalog-sized; rows of tables never come here.
    rows = discover.classify_epochs(catalog.schema_epochs(texts), marks, state.checkpoint_ts).where("status <> 'stale'")
    rows = rows.withColumn("stored", catalog.stored_generated(F.col("query")))
    out: dict[str, list[_Epoch]] = {t: [] for t in settings.tables}
    for r in rows.collect():
        fqn = f"{r['db']}.{r['table']}"
        if fqn not in out:
            continue
        if settings.reject_stored_generated and r["stored"]:
            raise ev.UnsupportedChange(f"{fqn}: STORED generated columns are not supported in change files")
        columns = tuple(csvio.column_from_schema_file(c) for c in r["columns"] or [])
        pk = tuple(c.name for c in columns if c.is_pk)
        out[fqn].append(_Epoch(int(r["version"]), r["status"], r["query"], r["action"], TableMeta(r["db"], r["table"], columns, pk)))
    for fqn, epochs in out.items():
        epochs.sort(key=lambda e: e.version)
        if state.tables[fqn].watermark and not any(e.status == "current" for e in epochs):
            raise ValueError(f"schema file of the applied version {state.tables[fqn].watermark} of {fqn} not found")
    return out


def _ranges(spark: SparkSession, settings: Settings, fqn: str, epochs: list[_Epoch], table: pg.TableProgress) -> list:
    """Pending file ranges of a table, in replay order. One row per stream."""
    db, name = split_fqn(fqn)
    active: dict[int, dict[int, str]] = {}
    cursor_rows = []
    for key, (date, idx) in table.cursors.items():
        version, partition, _ = key.split("/")
        active.setdefault(int(version), {})[int(partition)] = date
        cursor_rows.append(dict(db=db, table=name, version=int(version), partition=int(partition), date=date, file_index=idx))
    paths = discover.index_listing(spark, settings.source, {fqn: {e.version: active.get(e.version, {}) for e in epochs}})
    if not paths:
        return []
    cursors = local_rows(
        spark, cursor_rows, "db string, table string, version decimal(20,0), partition bigint, date string, file_index bigint")
    index = discover.index_rows(discover.read_index_texts(spark, paths))
    pending = discover.pending_ranges(index, cursors).withColumn("kind", F.lit(1))
    return sorted(discover.replay_order(pending).collect(), key=lambda r: r["first_position"])


def _keep_key_order(prev: TableMeta, plan: ev.Evolution) -> TableMeta:
    """Next schema with its key in the stored order, which the buckets follow."""
    name_of = {src.lower(): name for name, src in plan.source.items() if src}
    carried = tuple(name_of.get(k.lower(), "") for k in prev.pk)
    return replace(plan.next, pk=carried) if set(carried) == set(plan.next.pk) else plan.next


def _key_types(meta: TableMeta) -> list[str]:
    types = {c.name: c.spark_type for c in meta.columns}
    return [types[k] for k in meta.pk]


def _check_columns(fqn: str, epoch: _Epoch, meta: TableMeta) -> None:
    have, want = {n.lower() for n in epoch.meta.names}, {n.lower() for n in meta.names}
    if not want <= have:
        raise ValueError(f"{fqn}: version {epoch.version} misses the target's columns {sorted(want - have)}")


def _apply_table(
    spark: SparkSession, settings: Settings, fqn: str, epochs: list[_Epoch], state: pg.Progress, alive: Callable[[], None], purpose: str,
) -> tuple[pg.TableProgress, int, dict[str, int]]:
    """Bring one table forward; returns its progress, file count and row counts."""
    table = copy.deepcopy(state.tables[fqn])
    batch = table.batch + 1
    ranges = _ranges(spark, settings, fqn, epochs, table)
    if not ranges and not any(e.status == "pending" for e in epochs):
        return table, 0, {}
    db, name = split_fqn(fqn)
    base = tg.location(settings.target, db, name)
    stored = table.meta
    plans: list[ev.Evolution] = []
    changes: list[DataFrame] = []
    truncated, rewrite, files = False, False, 0

    for e in epochs:
        if table.meta is None and e.status != "pending":
            # No snapshot was loaded here: the first known schema is the start.
            table.meta = select_meta(e.meta, settings.selectors)
        if e.status == "pending":
            if e.query.strip() and e.action not in (ev.TRUNCATE_TABLE, ev.DROP_TABLE, ev.DROP_SCHEMA) and not e.meta.pk:
                raise ValueError(f"{fqn}: no primary key in the schema of version {e.version}")
            nxt = select_meta(e.meta, settings.selectors) if e.meta.columns and e.meta.pk else table.meta
            plan = ev.plan_evolution(table.meta, nxt, e.action, e.query)
            if plan.kind == "truncate":
                truncated, plans, changes = True, [], []
            elif plan.kind == "drop":
                table.dropped, changes, plans = True, [], []
            elif plan.kind == "alter":
                table.hidden = sorted(set(table.hidden) | set(plan.dropped))
                # Stored files would show old values under a name used again.
                readded = {c.name.lower() for c in plan.added} & {h.lower() for h in table.hidden}
                rewrite = rewrite or plan.rewrites() or bool(readded)
                plans.append(plan)
                changes = [ev.evolve(c, plan) for c in changes]
                table.meta = _keep_key_order(table.meta, plan)
                rewrite = rewrite or _key_types(table.meta) != _key_types(plan.prev)
            elif table.meta is None:
                table.meta = nxt
            table.watermark = max(table.watermark, e.version)
        mine = [r for r in ranges if int(r["version"]) == e.version]
        if not mine:
            continue
        if table.dropped:
            raise ValueError(f"{fqn}: change files after the table was dropped")
        _check_columns(fqn, e, table.meta)
        paths = [p for r in mine for p in discover.range_globs(settings.source, r)]
        here = sum(r["end_idx"] - r["start_idx"] + 1 for r in mine)
        discover.check_files(spark, paths, here)
        files += here
        rows = csvio.read_changes(
            spark, paths, list(e.meta.columns), version=e.version, after=state.checkpoint_ts, **settings.csv)
        own = {c.lower(): c for c in rows.columns}
        casts = [F.col(quote(own[c.name.lower()])).cast(c.spark_type).alias(c.name) for c in table.meta.columns]
        changes.append(rows.select(*csvio.ENVELOPE, *csvio.POSITION, *casts))
        for r in mine:
            key = f"{int(r['version'])}/{r['partition']}/CDC"
            table.cursors[key] = max(table.cursors.get(key, ("", 0)), (r["date"], r["end_idx"]))

    if table.dropped:
        table.live, table.buckets, table.deltas = [], 0, []
        return table, files, {}
    pk = list(table.meta.pk)
    if not table.buckets:
        table.buckets = settings.buckets or tg.MIN_BUCKETS
        table.live = [-1] * table.buckets
    if truncated:
        table.live, table.hidden, table.deltas, rewrite = [-1] * table.buckets, [], [], False

    if not changes and not rewrite:
        return table, files, {}

    counts: dict[str, int] = {}
    version = tg.new_version(batch)
    latest, touched = None, list(range(table.buckets))
    alive()
    if changes:
        rows = changes[0]
        for c in changes[1:]:
            rows = rows.unionByName(c, allowMissingColumns=True)
        as_run = settings.deltas and not plans and not rewrite
        path = f"{base}/{tg.DELTA}={version}" if as_run else f"{base}/_staging/{version}"
        latest, touched = _stage(spark, rows, base, path, table, pk, purpose)
        if as_run:
            if touched:
                table.deltas.append(pg.Delta(version, 0, tg.folder_bytes(spark, path)))
                alive()
                _settle(spark, settings, base, table, batch, purpose)
            return table, files, counts
    if rewrite:
        touched = list(range(table.buckets))
    if touched and table.deltas:
        touched = _with_runs(spark, base, table, touched)
    if not touched:
        return table, files, counts
    only = touched if len(touched) < table.buckets else None
    alive()

    # Stored rows are read in the schema they were written in, then evolved.
    if rewrite and stored is not None:
        current = _current(spark, base, stored, table, only, purpose)
        for plan in plans:
            current = ev.evolve(current, plan)
        if _key_types(stored) != _key_types(table.meta):
            # Another key type hashes to other buckets.
            current = current.repartition(table.buckets, *[F.col(quote(k)) for k in pk])
    else:
        current = _current(spark, base, table.meta, table, only, purpose)
    if latest is not None:
        if ev.ERROR_COLUMN in current.columns and ev.ERROR_COLUMN not in latest.columns:
            latest = latest.withColumn(ev.ERROR_COLUMN, F.lit(None).cast("string"))
        if ev.ERROR_COLUMN in latest.columns and ev.ERROR_COLUMN not in current.columns:
            current = current.withColumn(ev.ERROR_COLUMN, F.lit(None).cast("string"))
        seen = Observation()
        current = merge_changes(current, latest, pk, observation=seen)
    current = ev.assert_evolved(current)
    tg.write_version(spark, current, base, version, pk, table.buckets, distributed=True)
    if latest is not None:
        counts = {k: int(v) for k, v in seen.get.items()}
    for b in touched:
        table.live[b] = version
    table.deltas = []
    if rewrite:
        table.hidden = []
    return table, files, counts


# --------------------------------------------------------------------------
# Runs of changes, and buckets that grow
# --------------------------------------------------------------------------

def _with_runs(spark: SparkSession, base: str, table: pg.TableProgress, touched: list[int]) -> list[int]:
    """These buckets and all that runs have changes of: a run is folded into all of its buckets or none."""
    found = {b for d in table.deltas for b in tg.buckets_in(spark, f"{base}/{tg.DELTA}={d.version}")}
    return sorted(found | set(touched))


def _current(spark: SparkSession, base: str, meta: TableMeta, table: pg.TableProgress, only: list[int] | None, purpose: str) -> DataFrame:
    """Current rows of all or some buckets: the buckets' files, merged with the runs on top of them."""
    rows = tg.read_live(spark, base, meta, table.buckets, table.live, only, purpose=purpose)
    if not table.deltas:
        return rows
    newest = tg.read_deltas(spark, base, meta, table.buckets, [d.version for d in table.deltas], only, purpose)
    return merge_changes(rows, newest, list(meta.pk))


def _fold(spark: SparkSession, base: str, table: pg.TableProgress, batch: int, purpose: str) -> None:
    """Write the buckets that runs have changes of anew, without the runs."""
    touched = _with_runs(spark, base, table, [])
    version = tg.new_version(batch)
    only = touched if len(touched) < table.buckets else None
    tg.write_version(spark, _current(spark, base, table.meta, table, only, purpose), base, version, list(table.meta.pk), table.buckets, distributed=True)
    for b in touched:
        table.live[b] = version
    table.deltas = []


def _settle(spark: SparkSession, settings: Settings, base: str, table: pg.TableProgress, batch: int, purpose: str) -> None:
    """Put the newest runs of a level together once there are enough; fold all once they outweigh their share.

    A change is so written once a level, and the levels grow with the logarithm of the changes.
    """
    if sum(d.bytes for d in table.deltas) > settings.fold * tg.stored_bytes(spark, base, table.live):
        _fold(spark, base, table, batch, purpose)
        return
    while len(table.deltas) >= settings.runs:
        level = table.deltas[-1].level
        same = [d for d in table.deltas if d.level == level]
        if len(same) < settings.runs:
            return
        version = tg.new_version(batch)
        path = f"{base}/{tg.DELTA}={version}"
        pk = list(table.meta.pk)
        tg.write_bucketed(spark, tg.read_deltas(spark, base, table.meta, table.buckets, [d.version for d in same], purpose=purpose), path, pk, table.buckets)
        table.deltas = [d for d in table.deltas if d.level != level] + [pg.Delta(version, level + 1, tg.folder_bytes(spark, path))]


def _maintain(spark: SparkSession, settings: Settings, fqn: str, work: Callable[[str, pg.TableProgress, int, str], bool]) -> bool:
    """Rearrange a table's files in a commit of its own; its rows stay what they are."""
    before = pg.load_table(spark, settings.target, fqn)
    if before.dropped or before.meta is None or not before.buckets:
        return False
    table, base = copy.deepcopy(before), tg.location(settings.target, *split_fqn(fqn))
    purpose = f"round {uuid.uuid4().hex}"
    try:
        with tg.sorted_buckets(spark):
            done = work(base, table, before.batch + 1, purpose)
    finally:
        tg.release(spark, base, purpose)
    if done:
        pg.commit(spark, settings.target, fqn, before, table)
    return done


def compact(spark: SparkSession, settings: Settings, fqn: str) -> bool:
    """Fold all runs of a table into its buckets; says whether there were any."""
    def work(base: str, table: pg.TableProgress, batch: int, purpose: str) -> bool:
        if table.deltas:
            _fold(spark, base, table, batch, purpose)
            return True
        return False

    return _maintain(spark, settings, fqn, work)


def rebucket(spark: SparkSession, settings: Settings, fqn: str, factor: int = 2) -> bool:
    """Split every bucket b of n into b, b + n, ...: the stored hash tells which, so nothing is shuffled.

    A task reads one bucket with its runs and writes ``factor`` of them.
    """
    def work(base: str, table: pg.TableProgress, batch: int, purpose: str) -> bool:
        version, pk, n = tg.new_version(batch), list(table.meta.pk), table.buckets * factor
        tg.write_version(spark, _current(spark, base, table.meta, table, None, purpose), base, version, pk, n, distributed=True)
        table.buckets, table.live, table.deltas = n, [version] * n, []
        return True

    if factor < 2:
        raise ValueError("buckets are split into two or more")
    return _maintain(spark, settings, fqn, work)


_DIGESTS = "version bigint, columns string, bucket int, n_rows bigint, total decimal(38,0), mixed bigint"


def table_digests(spark: SparkSession, settings: Settings, fqn: str) -> tuple[DataFrame, int]:
    """(bucket, n_rows, total, mixed) of a target table, and its number of buckets.

    A bucket's file never changes, so its digest is kept beside it, by version and columns, and
    only buckets without one are read. Runs of changes are folded in first.
    """
    compact(spark, settings, fqn)
    t, base = pg.load_table(spark, settings.target, fqn), tg.location(settings.target, *split_fqn(fqn))
    columns = hashlib.sha256(t.meta.ddl().encode()).hexdigest()[:16]
    folder = f"{base}/_digests"
    live = F.element_at(F.split(F.lit(",".join(map(str, t.live))), ",").cast("array<bigint>"), F.col("bucket") + 1)

    def kept() -> DataFrame:
        if not storage.list_names(spark, folder):
            return no_rows(spark, _DIGESTS)
        rows = spark.read.schema(_DIGESTS).parquet(storage.literal(folder))
        return rows.where((F.col("columns") == columns) & (F.col("bucket") < t.buckets)).where(live == F.col("version")).dropDuplicates(["bucket"])

    known = {r[0] for r in kept().select("bucket").collect()}  # one row per bucket
    missing = [b for b in range(t.buckets) if b not in known and t.live[b] >= 0]
    if missing:
        rows = tg.read_live(spark, base, t.meta, t.buckets, t.live, missing, bucketed=False)
        found = reconcile.bucket_digests(rows, list(t.meta.pk), t.buckets)
        found = found.select(live.alias("version"), F.lit(columns).alias("columns"), "bucket", "n_rows", "total", "mixed")
        # Buckets without rows are known, too.
        none = [dict(version=t.live[b], columns=columns, bucket=b, n_rows=0, total=0, mixed=0) for b in missing]
        both = found.unionByName(local_rows(spark, none, _DIGESTS)).groupBy("version", "columns", "bucket").agg(*[F.sum(c).cast(ty).alias(c) for c, ty in (("n_rows", "bigint"), ("total", "decimal(38,0)"), ("mixed", "bigint"))])
        both.coalesce(1).write.mode("append").parquet(folder)
    return kept().where("n_rows > 0").select("bucket", "n_rows", "total", "mixed"), t.buckets


def compare_target(spark: SparkSession, settings: Settings, fqn: str, source: DataFrame) -> DataFrame:
    """Keys in which a target table differs from ``source``; of the target only buckets that differ are read."""
    digests, buckets = table_digests(spark, settings, fqn)
    t, base = pg.load_table(spark, settings.target, fqn), tg.location(settings.target, *split_fqn(fqn))
    pk = list(t.meta.pk)
    some = reconcile.differing_buckets(reconcile.bucket_digests(source.select(*[F.col(quote(n)) for n in t.meta.names]), pk, buckets), digests)
    if not some:
        return reconcile.keyed_diff(source.limit(0), no_rows(spark, t.meta.ddl()), pk, [n for n in t.meta.names if n not in pk])
    target = tg.read_live(spark, base, t.meta, buckets, t.live, some, bucketed=False)
    mine = source.where(tg.bucket_of(pk, buckets).isin(some))
    return reconcile.keyed_diff(mine, target, pk, [n for n in t.meta.names if n not in pk])


def _grown(spark: SparkSession, settings: Settings, fqn: str, table: pg.TableProgress) -> int:
    """By how much a table's buckets should be split: a power of two, 1 for not at all."""
    if settings.buckets or not settings.split_buckets or not table.buckets:
        return 1
    size, factor = tg.stored_bytes(spark, tg.location(settings.target, *split_fqn(fqn)), table.live), 1
    while size > tg.SPLIT_BYTES * table.buckets * factor:
        factor *= 2
    return factor


def _stage(
    spark: SparkSession, changes: DataFrame, base: str, path: str, table: pg.TableProgress, pk: list[str], purpose: str,
) -> tuple[DataFrame, list[int]]:
    """Write the newest change per key under ``path``, bucketed like the target.

    The files are read once and shuffled once. What the merge needs to know in
    advance, the touched buckets, is in the names of the staged files.
    """
    keep = ["cdc_flag", *table.meta.names] + ([ev.ERROR_COLUMN] if ev.ERROR_COLUMN in changes.columns else [])
    newest = latest_change(changes, pk)
    newest = newest.select(*[F.col(quote(c)) for c in keep])
    if table.buckets % int(spark.conf.get("spark.sql.shuffle.partitions")):
        newest = newest.repartition(table.buckets, *[F.col(quote(k)) for k in pk])
    # Otherwise every bucket lies within one shuffle partition of the ranking.
    tg.write_bucketed(spark, newest, path, pk, table.buckets)
    ddl = f"cdc_flag string, {table.meta.ddl()}" + (f", {ev.ERROR_COLUMN} string" if len(keep) > len(table.meta.names) + 1 else "")
    staged = tg.read_bucketed(spark, path, ddl, pk, table.buckets, purpose=purpose)
    return staged, tg.buckets_in(spark, path)


def apply_round(spark: SparkSession, settings: Settings, state: pg.Progress | None = None) -> tuple[RoundResult, pg.Progress]:
    """Run one round against the newest committed progress."""
    state = state or pg.load(spark, settings.target, settings.tables)
    # The checkpoint is read before the files it covers are looked for.
    published = catalog.read_checkpoint(spark, settings.source)
    stamp = lambda v: F.lit(v).cast("decimal(20,0)")
    action = spark.range(1).select(discover.round_gate(stamp(state.checkpoint_ts), stamp(published))).first()[0]
    if action != "run":
        return RoundResult(action, state.batch, state.checkpoint_ts), state
    epochs = _epochs(spark, settings, state)

    def work(fqn: str, alive: Callable[[], None]):
        before = state.tables[fqn]
        purpose = f"round {uuid.uuid4().hex}"
        try:
            table, files, rows = _apply_table(spark, settings, fqn, epochs[fqn], state, alive, purpose)
        finally:
            tg.release(spark, tg.location(settings.target, *split_fqn(fqn)), purpose)
        table.checkpoint_ts = published
        if vars(table) | {"checkpoint_ts": 0} != vars(before) | {"checkpoint_ts": 0}:
            alive()
            pg.commit(spark, settings.target, fqn, before, table)
        return table, files, rows

    with tg.sorted_buckets(spark):
        results = _each_table(spark, settings, work)
    tables = {t: r[0] for t, r in zip(settings.tables, results)}
    nxt = pg.Progress(state.batch + 1, min([t.checkpoint_ts for t in tables.values()], default=published), state.snapshot_finished, tables)
    pg.advance(spark, settings.target, state, nxt)
    active = [t for t, r in zip(settings.tables, results) if r[1] or r[0].watermark != state.tables[t].watermark]
    for fqn in active:
        factor = _grown(spark, settings, fqn, tables[fqn])
        if factor > 1 and rebucket(spark, settings, fqn, factor):
            tables[fqn] = pg.load_table(spark, settings.target, fqn)
    pg.archive(spark, settings.target, settings.tables, max(settings.keep_progress, settings.keep_commits))
    _drop_staged(spark, settings, tables)
    if not settings.keep_old_files:
        vacuum(spark, settings, tables=active)
    _note_round(spark, settings, nxt, {t: r for t, r in zip(settings.tables, results) if t in active})
    return RoundResult(
        "run", nxt.batch, published, active_tables=len(active), loaded_files=sum(r[1] for r in results),
        rows={t: r[2] for t, r in zip(settings.tables, results) if r[2]},
    ), nxt


ACTIONS = ("insert", "update", "delete", "ignore")
_ROUNDS = "batch bigint, checkpoint_ts decimal(20,0), table string, loaded_files bigint, " + ", ".join(f"n_{a} bigint" for a in ACTIONS)


def _note_round(spark: SparkSession, settings: Settings, state: pg.Progress, active: dict) -> None:
    """One file per round, with a line per table that had something to do."""
    lines = [dict(batch=state.batch, checkpoint_ts=state.checkpoint_ts, table=t, loaded_files=files, **{f"n_{a}": rows.get(a) for a in ACTIONS})
             for t, (_, files, rows) in active.items()]
    if lines:
        storage.write_text(spark, f"{settings.target}/_rounds/round={state.batch:012d}.json", "".join(json.dumps(x) + "\n" for x in lines))


def round_log(spark: SparkSession, settings: Settings) -> DataFrame:
    """What every round did, one row per table that had something to do; rounds that write runs count no rows by action."""
    folder = f"{settings.target}/_rounds"
    if not storage.list_names(spark, folder):
        return no_rows(spark, _ROUNDS)
    return spark.read.schema(_ROUNDS).json(storage.literal(folder) + "/round=*.json")


def _drop_staged(spark: SparkSession, settings: Settings, tables: dict[str, pg.TableProgress]) -> None:
    """Delete what was staged for commits that are made, or earlier ones."""
    gone = []
    for fqn, table in tables.items():
        home = f"{tg.location(settings.target, *split_fqn(fqn))}/_staging"
        gone += [f"{home}/{n}" for n in storage.list_names(spark, home) if n.isdigit() and int(n) >> tg.ATTEMPT_BITS <= table.batch]
    storage.delete_all(spark, gone)


def vacuum(spark: SparkSession, settings: Settings, keep_commits: int | None = None, tables: list[str] | None = None) -> None:
    """Delete files of tables (of all, if none are named) that none of their newest ``keep_commits`` commits needs."""
    keep = settings.keep_commits if keep_commits is None else keep_commits
    for fqn in settings.tables if tables is None else tables:
        kept = pg.recent_tables(spark, settings.target, fqn, keep)
        if kept:
            # Older attempts that failed go, too; the newest batch may still have another writer.
            runs = {d.version for t in kept for d in t.deltas}
            tg.vacuum(spark, tg.location(settings.target, *split_fqn(fqn)), [t.live for t in kept], kept[0].batch, runs)


def read_target(spark: SparkSession, settings: Settings, fqn: str, state: pg.Progress | None = None) -> DataFrame:
    """Rows of a target table as of the newest commit, or of ``state``.

    The reader keeps the version that it was planned with: later rounds neither change it nor
    take its files away for ``keep_commits`` commits; after that it fails. Where runs of changes
    lie on top of the buckets, both are merged without a shuffle; only that makes catalog entries.
    """
    t = pg.load_table(spark, settings.target, fqn) if state is None else state.tables[fqn]
    if t.dropped or t.meta is None:
        raise ValueError(f"table {fqn} does not exist in the target")
    base = tg.location(settings.target, *split_fqn(fqn))
    if t.deltas:
        return _current(spark, base, t.meta, t, None, "read")
    return tg.read_live(spark, base, t.meta, t.buckets, t.live, bucketed=False)


def replicate(spark: SparkSession, settings: Settings, mode: str = "all", rounds: int = 1) -> list[RoundResult]:
    """Snapshot, then incremental rounds, as the mode says.

    A finished snapshot is not loaded again. Rounds end early when no newer
    checkpoint is published.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    state = pg.load(spark, settings.target, settings.tables)
    if mode == "incremental-only" and not state.snapshot_finished and pg.newest_batch(spark, settings.target) is None:
        # The tables are taken as loaded by other means.
        state.snapshot_finished = True
    if mode != "incremental-only" and not state.snapshot_finished:
        state = snapshot_load(spark, settings, state)
    out: list[RoundResult] = []
    if mode == "snapshot-only":
        return out
    if not state.snapshot_finished:
        raise ValueError("snapshot is not finished; run all mode before incremental")
    for _ in range(rounds):
        result, state = apply_round(spark, settings, state)
        if result.action != "run":
            break
        out.append(result)
    return out
