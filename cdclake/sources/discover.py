"""Which change files are new: schema epochs, index files, cursors, ranges.

Rows here are descriptors of schemas, streams and ranges. Data files are never
listed; they follow from the index and the cursor of their stream.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.functions.names import file_index, file_name, is_date_dir, stream_part
from cdclake.sources import storage
from cdclake.sources.local import no_rows

_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
STREAM = ["db", "table", "version", "partition"]
# Files per intermediate row of a range expansion.
EXPAND_STEP = 4096


def read_index_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, text)`` of index files."""
    if not paths:
        return no_rows(spark, "path string, text string")
    return spark.read.text([storage.literal(p) for p in paths], wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def index_listing(spark: SparkSession, root: str, tables: dict[str, dict[int, dict[int, str]]]) -> list[str]:
    """Index files of table versions, without dates before the active one.

    ``tables`` maps a table to its versions, and each of those to the date at which the cursor
    of each partition stands. Two patterns per table tell all its index files, however many
    dates there are; only folders of dates and partitions are listed, never the data files in
    them, and all tables side by side. Dates that are done are told by their paths and not
    read. A stream without an index file has produced nothing yet and simply is not found.
    """
    def listed(item: tuple[str, dict[int, dict[int, str]]]) -> list[str]:
        fqn, versions = item
        if not versions:
            return []
        base = f"{root}/increment/" + "/".join(fqn.split(".", 1))
        home = storage.literal(base)
        these = "{" + ",".join(str(v) for v in sorted(versions)) + "}"
        found = []
        for depth in (1, 2):  # dates, or partitions and dates
            for path, _ in storage.glob(spark, f"{home}/{these}{'/*' * depth}/meta/CDC.index"):
                version, *part, date = path.split("/")[-3 - depth:-2]
                if not _DATE.match(date) or (part and not part[0].isdigit()):
                    raise ValueError(f"neither a date nor a partition: {path}")
                if date >= versions[int(version)].get(int(part[0]) if part else 0, ""):
                    found.append(path)
        return found

    with ThreadPoolExecutor(32) as pool:
        return [p for paths in pool.map(listed, tables.items()) for p in paths]


def index_rows(texts: DataFrame) -> DataFrame:
    """Newest visible file per stream and date of ``(path, text)`` index files.

    Names that are not plain numbered files fail the job; those written across
    nodes are such names.
    """
    path, name = F.col("path"), F.regexp_replace("text", r"^\s+|\s+$", "")
    idx = file_index(name)
    fail = F.raise_error(F.concat(F.lit("unsupported index file "), path, F.lit(": "), name))
    rows = texts.select(
        *[stream_part(path, p).alias(p) for p in ("db", "table", "version", "partition", "date")],
        F.when(idx.isNotNull() & ~name.contains("/"), idx).otherwise(fail).alias("idx"),
        F.length(F.regexp_extract(name, r"CDC([0-9]+)\.csv$", 1)).cast("bigint").alias("width"),
    )
    return rows.groupBy(*STREAM, "date").agg(F.max("idx").alias("idx"), F.max("width").alias("width"))


def round_gate(stored: Column, published: Column) -> Column:
    """Whether a round may run: only a checkpoint beyond the stored one does."""
    return (
        F.when(published.isNull(), "absent")
        .when(published < stored, "behind")
        .when(published == stored, "stuck")
        .otherwise("run")
    )


def classify_epochs(epochs: DataFrame, watermarks: DataFrame, checkpoint_ts: int) -> DataFrame:
    """Mark schema epochs stale, baseline, current or pending.

    ``watermarks(db, table, watermark)`` holds the applied version of each
    table, 0 or absent when none is. With a watermark its epoch must exist.
    """
    w = F.coalesce("watermark", F.lit(0).cast("decimal(20,0)"))
    cp = F.lit(checkpoint_ts).cast("decimal(20,0)")
    rows = epochs.join(watermarks, ["db", "table"], "left").withColumn("watermark", w)
    covered = (F.col("watermark") == 0) & (F.col("version") <= cp)
    tables = rows.groupBy("db", "table").agg(
        F.max(F.when(covered, F.col("version"))).alias("baseline"),
        F.bool_or((F.col("watermark") == 0) | (F.col("version") == F.col("watermark"))).alias("found"),
    )
    status = (
        F.when(~F.col("found"), F.raise_error(F.concat(F.lit("schema file of the applied version not found: "), F.col("db"), F.lit("."), F.col("table"))))
        .when(F.col("watermark") > 0, F.when(F.col("version") < F.col("watermark"), "stale").when(F.col("version") == F.col("watermark"), "current").otherwise("pending"))
        .when(F.col("version") > cp, "pending")
        .when(F.col("version") == F.col("baseline"), "baseline")
        .otherwise("stale")
    )
    return rows.join(tables, ["db", "table"]).withColumn("status", status).drop("baseline", "found")


def prune_dates(streams: DataFrame, cursors: DataFrame) -> DataFrame:
    """Date directories of streams from the active date of the cursor on.

    Names that are no dates are not date directories and are dropped.
    """
    active = cursors.groupBy(*STREAM).agg(F.max("date").alias("active_date"))
    kept = streams.where(is_date_dir(F.col("date"))).join(active, STREAM, "left")
    return kept.where(F.col("date") >= F.coalesce("active_date", F.lit(""))).drop("active_date")


def pending_ranges(index: DataFrame, cursors: DataFrame) -> DataFrame:
    """File ranges between the cursor and the index of every stream and date.

    ``cursors(db, table, version, partition, date, file_index)`` holds one row
    per stream; a later date starts at file 1.
    """
    c = cursors.select(*STREAM, F.col("date").alias("active_date"), "file_index")
    consumed = F.when(F.col("date") == F.col("active_date"), F.col("file_index")).otherwise(0)
    rows = index.join(c, STREAM, "left").where(F.col("date") >= F.coalesce("active_date", F.lit("")))
    return rows.withColumn("start_idx", consumed + 1).where("idx >= start_idx").select(
        *STREAM, "date", "start_idx", F.col("idx").alias("end_idx"), "width")


def ranges_without_schema(ranges: DataFrame, epochs: DataFrame) -> DataFrame:
    """Ranges whose table version has no schema file; must be empty."""
    return ranges.join(epochs.select("db", "table", "version"), ["db", "table", "version"], "left_anti")


def count_files(ranges: DataFrame, keys: list[str] = ("db", "table")) -> DataFrame:
    """Number of data files in ranges; schema entries (kind 0) do not count."""
    n = F.when((F.col("kind") == 1) & (F.col("end_idx") >= F.col("start_idx")), F.col("end_idx") - F.col("start_idx") + 1).otherwise(0)
    return ranges.groupBy(*keys).agg(F.sum(n).alias("n_files"))


def replay_order(ranges: DataFrame) -> DataFrame:
    """Order of replay within a table: version, schema before data, partition, date.

    ``first_position`` is the place of the range's first file among all files of
    its table. It comes from one running sum over ranges, never over files.
    """
    n = F.when(F.col("kind") == 1, F.greatest(F.col("end_idx") - F.col("start_idx") + 1, F.lit(0))).otherwise(1)
    before = Window.partitionBy("db", "table").orderBy("version", "kind", "partition", "date").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select(*ranges.columns, (F.coalesce(F.sum(n).over(before), F.lit(0)) + 1).alias("first_position"))


def expand_ranges(ranges: DataFrame) -> DataFrame:
    """One row per data file of a range, with its name.

    A long range is cut into steps first, so that no single row carries it all.
    """
    step = F.lit(EXPAND_STEP).cast("bigint")
    steps = ranges.where("end_idx >= start_idx").withColumn("step_idx", F.explode(F.sequence("start_idx", "end_idx", step)))
    last = F.least(F.col("step_idx") + step - 1, F.col("end_idx"))
    files = steps.withColumn("idx", F.explode(F.sequence(F.col("step_idx"), last))).drop("step_idx")
    return files.withColumn("file", file_name(F.col("idx"), F.col("width").cast("int")))


def number_globs(start: int, end: int, width: int) -> list[str]:
    """Few patterns that together match the numbers start..end, zero-padded to a width, and nothing else.

    Walks the decimal trie of the numbers: the patterns are its largest subtrees within the
    range, so there are at most 18 for each digit in which the ends differ.
    """
    out = []
    while start <= end:
        # The largest block 10**k that begins here and ends within the range.
        k = 0
        while start % 10 ** (k + 1) == 0 and start + 10 ** (k + 1) - 1 <= end:
            k += 1
        last = min(start // 10**k + 9 - start // 10**k % 10, (end + 1) // 10**k - 1)
        head, low, high = start // 10 ** (k + 1), start // 10**k % 10, last % 10
        digits = max(0, width - k - 1)
        prefix = f"{head:0{digits}d}" if head or digits else ""
        out.append(prefix + (str(low) if low == high else f"[{low}-{high}]") + "[0-9]" * k)
        start = (last + 1) * 10**k
    return out


def range_globs(root: str, rng) -> list[str]:
    """Patterns of the data files of one pending range (a descriptor on the driver)."""
    part = f"{rng['partition']}/" if rng["partition"] else ""
    base = storage.literal(f"{root}/increment/{rng['db']}/{rng['table']}/{int(rng['version'])}/{part}{rng['date']}")
    out, start = [], rng["start_idx"]
    while start <= rng["end_idx"]:  # numbers that outgrow the width have as many digits as they need
        digits = max(rng["width"], len(str(start)))
        end = min(rng["end_idx"], 10**digits - 1)
        out += [f"{base}/CDC{x}.csv" for x in number_globs(start, end, digits)]
        start = end + 1
    return out


def check_files(spark: SparkSession, globs: list[str], expected: int) -> None:
    """Fail unless the patterns match as many files, empty ones too, as their ranges have."""
    with ThreadPoolExecutor(32) as pool:
        there = sum(pool.map(lambda g: storage.count(spark, g), globs))
    if there != expected:
        raise FileNotFoundError(f"{expected - there} of {expected} change files are missing: {globs[:3]} ...")
