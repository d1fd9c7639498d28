"""Target tables: Parquet, hash-bucketed by primary key, one folder per version.

``<root>/<db>/<table>/cdclake_version=<n>/`` holds the bucket files written by
one attempt to commit; the progress row says which version is current for each
bucket. A version's number is of its attempt alone, so writers never meet in a
folder, and one that loses the race for a commit has spoiled nothing.
Because the layout is Spark's own bucketing, a merge never shuffles the target:
the changes are shuffled once, to the same buckets, and joined in place. Only
buckets that hold changed keys are read and written again.

``cdclake_delta=<n>/`` holds a run of changes, the newest one per key with its flag, in the
same buckets and order. Reads merge the runs and the buckets, again without a shuffle.
"""

from __future__ import annotations

import contextlib
import hashlib
import re
import secrets
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdclake.functions.names import escape_text
from cdclake.functions.types import TableMeta, quote
from cdclake.sources import storage
from cdclake.sources.local import no_rows

VERSION, DELTA = "cdclake_version", "cdclake_delta"
_SCAN_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"
_FILE_BUCKET = re.compile(r"_([0-9]+)([.]c[0-9]+)?[.][^/]*$")
# Source bytes per bucket: a bucket is one sort-merge task, which may spill.
BYTES_PER_BUCKET = 256 << 20
MIN_BUCKETS = 8
# Text of gzip files is several times larger. What a table really takes is measured later, and splits its buckets.
GZIP_RATIO = 4
# Stored bytes per bucket from which buckets are split.
SPLIT_BYTES = 128 << 20


def bucket_count(source_bytes: int, shuffle_partitions: int = 1) -> int:
    """Number of buckets for a table of that many bytes of text.

    Large tables get a multiple of the shuffle partitions, so that rows that
    were shuffled by key need no second shuffle into buckets.
    """
    n = max(MIN_BUCKETS, -(-source_bytes // BYTES_PER_BUCKET))
    return -(-n // shuffle_partitions) * shuffle_partitions if n > shuffle_partitions else n


@contextlib.contextmanager
def sorted_buckets(spark: SparkSession):
    """Let scans of single-file buckets report their order.

    Bucket files are sorted by key, so the merge join then needs no sort of the
    target. Spark checks itself that each bucket is one file.
    """
    with _ordered["lock"]:
        if not _ordered["depth"]:
            _ordered["before"] = spark.conf.get(_SCAN_ORDER)
            spark.conf.set(_SCAN_ORDER, "true")
        _ordered["depth"] += 1
    try:
        yield
    finally:
        with _ordered["lock"]:
            _ordered["depth"] -= 1
            if not _ordered["depth"]:
                spark.conf.set(_SCAN_ORDER, _ordered["before"])


# Rounds of several threads share the session's setting.
_ordered: dict = {"lock": threading.Lock(), "depth": 0, "before": None}


def bucket_of(pk: list[str], buckets: int):
    """Bucket of a row, by the hash that bucketed tables are written with."""
    return F.pmod(F.hash(*[F.col(quote(k)) for k in pk]), F.lit(buckets))


def location(root: str, db: str, table: str) -> str:
    # Catalog tables can't lie in folders whose names look like patterns.
    safe = lambda name: re.sub(r"[\[\]{}*?]", lambda m: f"%{ord(m[0]):02X}", escape_text(name))
    return f"{root}/{safe(db)}/{safe(table)}"


def _handle(path: str) -> str:
    """Catalog name of a folder; needed because bucketing is table metadata."""
    return "cdclake_" + hashlib.sha256(path.encode()).hexdigest()[:24]


#: Low bits of a version tell attempts at one batch apart.
ATTEMPT_BITS = 31


def new_version(batch: int) -> int:
    """A number for what one attempt at a batch writes."""
    return batch << ATTEMPT_BITS | secrets.randbits(ATTEMPT_BITS)


def write_bucketed(spark: SparkSession, df: DataFrame, path: str, pk: list[str], buckets: int) -> None:
    """Write rows, already distributed by key, as bucket files under ``path``, a new folder."""
    name = _handle(path + "#write")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format("parquet").mode("errorifexists").bucketBy(buckets, *pk).sortBy(*pk).option("path", path).saveAsTable(name)
    # The table is external: its files stay.
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_version(
    spark: SparkSession, df: DataFrame, base: str, version: int, pk: list[str], buckets: int, distributed: bool = False,
) -> None:
    """Write one version. Rows that are not bucketed yet are shuffled by key."""
    rows = df if distributed else df.repartition(buckets, *[F.col(quote(k)) for k in pk])
    write_bucketed(spark, rows, f"{base}/{VERSION}={version}", pk, buckets)


# Catalog entries made here, by folder and purpose.
_handles: dict[tuple[str, str], set[str]] = {}


def release(spark: SparkSession, path: str, purpose: str) -> None:
    """Drop the catalog entries made for a purpose below a folder."""
    for key in [k for k in list(_handles) if k[1] == purpose and (k[0] + "/").startswith(path + "/")]:
        for name in _handles.pop(key):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _open(
    spark: SparkSession, path: str, columns: str, partitions: list[int], pk: list[str], buckets: int, purpose: str, by: str = VERSION,
) -> str:
    """Catalog entry for a bucketed folder, partitioned by version if asked to.

    With ``buckets=0`` the files are taken as they are.
    """
    name = _handle(f"{path}#{columns}#{pk}#{buckets}#{by}{partitions}#{purpose}")
    _handles.setdefault((path, purpose), set()).add(name)
    if spark.catalog.tableExists(name):
        spark.catalog.refreshTable(name)  # files may have been replaced
        return name
    keys = ", ".join(quote(k) for k in pk)
    extra, part = (f", {by} bigint", f"PARTITIONED BY ({by})") if partitions else ("", "")
    where = path.replace("'", "\\'")
    clustered = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS" if buckets else ""
    spark.sql(f"CREATE TABLE {name} ({columns}{extra}) USING parquet {part} {clustered} LOCATION '{where}'")
    if partitions:
        adds = " ".join(f"PARTITION ({by}={v}) LOCATION '{where}/{by}={v}'" for v in partitions)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {adds}")
    return name


def read_bucketed(
    spark: SparkSession, path: str, columns: str, pk: list[str], buckets: int, purpose: str = "read",
) -> DataFrame:
    """A folder written by :func:`write_bucketed`."""
    return spark.table(_open(spark, path, columns, [], pk, buckets, purpose))


def buckets_in(spark: SparkSession, path: str) -> list[int]:
    """Buckets that a folder written by :func:`write_bucketed` has rows of."""
    found = (_FILE_BUCKET.search(n) for n in storage.list_names(spark, path) if n.startswith("part-"))
    return sorted({int(m.group(1)) for m in found if m})


def read_live(
    spark: SparkSession, base: str, meta: TableMeta, buckets: int, live: list[int], only: list[int] | None = None,
    bucketed: bool = True, purpose: str = "read",
) -> DataFrame:
    """Current rows of a table, or of some of its buckets.

    A bucketed scan has one task per bucket, even for buckets left out;
    ``bucketed=False`` plans tasks for the files that are read instead.

    A row counts when its version is the live one of its bucket, so files that
    a later commit replaced never show, deleted or not.
    """
    pk = list(meta.pk)
    wanted = range(buckets) if only is None else only
    versions = sorted({live[b] for b in wanted if live[b] >= 0})
    if not versions:
        return no_rows(spark, meta.ddl())
    if bucketed:
        df = spark.table(_open(spark, base, meta.ddl(), versions, pk, buckets, purpose))
    else:
        # The files are listed now: a file that goes later fails the reader.
        reader = spark.read.schema(f"{meta.ddl()}, {VERSION} bigint").option("basePath", base).option("ignoreMissingFiles", False)
        df = reader.parquet(*[storage.literal(f"{base}/{VERSION}={v}") for v in versions])
    df = _only(df, only)
    if len(versions) > 1 or only is not None:
        # One constant, however many buckets there are.
        table = F.split(F.lit(",".join(map(str, live))), ",").cast("array<bigint>")
        df = df.where(F.element_at(table, (bucket_of(pk, buckets) + 1).cast("int")) == F.col(VERSION))
    return df.select(*[F.col(quote(n)) for n in meta.names])


def _only(df: DataFrame, buckets: list[int] | None) -> DataFrame:
    """Rows of some buckets; evaluated on file names while files are listed."""
    if buckets is None:
        return df
    return df.where(f"cast(regexp_extract(_metadata.file_name, '{_FILE_BUCKET.pattern}', 1) as int) IN ({', '.join(map(str, buckets))})")


def read_deltas(
    spark: SparkSession, base: str, meta: TableMeta, buckets: int, runs: list[int], only: list[int] | None = None, purpose: str = "read",
) -> DataFrame:
    """The newest change per key of several runs, oldest run first: (cdc_flag, columns).

    All runs are partitions of one bucketed table, so a bucket's runs meet in one task
    and are ranked there: an exchange is needed as little as for a single run.
    """
    pk = list(meta.pk)
    df = _only(spark.table(_open(spark, base, f"cdc_flag string, {meta.ddl()}", runs, pk, buckets, purpose, DELTA)), only)
    if len(runs) > 1:
        age = F.array_position(F.lit(runs).cast("array<bigint>"), F.col(DELTA))
        w = Window.partitionBy(*[F.col(quote(k)) for k in pk]).orderBy(age.desc())
        df = df.withColumn("cdc_rank", F.row_number().over(w)).where("cdc_rank = 1")
    return df.select("cdc_flag", *[F.col(quote(n)) for n in meta.names])


def stored_bytes(spark: SparkSession, base: str, live: list[int]) -> int:
    """Bytes of the live bucket files of a table."""
    size = 0
    for version in {v for v in live if v >= 0}:
        for path, n in storage.glob(spark, f"{storage.literal(base)}/{VERSION}={version}/part-*"):
            m = _FILE_BUCKET.search(path)
            size += n if m and live[int(m.group(1))] == version else 0
    return size


def folder_bytes(spark: SparkSession, path: str) -> int:
    return sum(n for _, n in storage.glob(spark, f"{storage.literal(path)}/part-*"))


def vacuum(spark: SparkSession, base: str, kept: list[list[int]], before: int, runs: set[int] = frozenset()) -> None:
    """Delete what none of the kept commits (their live versions per bucket, and their runs) needs: whole versions, then stale buckets.

    Versions of batch ``before`` or later stay: an attempt may be at work there.
    """
    needed = {(b, v) for live in kept for b, v in enumerate(live)}
    versions, gone = {v for _, v in needed}, []
    for name in storage.list_names(spark, base):
        kind, _, number = name.partition("=")
        if kind not in (VERSION, DELTA) or int(number) >> ATTEMPT_BITS >= before:
            continue
        version = int(number)
        if version not in (versions if kind == VERSION else runs):
            gone.append(f"{base}/{name}")
        elif kind == VERSION:
            for file in storage.list_names(spark, f"{base}/{name}"):
                m = _FILE_BUCKET.search(file)
                if file.startswith("part-") and m and (int(m.group(1)), version) not in needed:
                    gone.append(f"{base}/{name}/{file}")
    storage.delete_all(spark, gone)
