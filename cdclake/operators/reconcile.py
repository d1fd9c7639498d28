"""Compare source and target: counts per table, rows per key, assertions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.functions.names import clean_name
from cdclake.functions.types import quote

MISSING = "MISSING"


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; all tables are counted in one job, reading no columns."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, counts)


def duplicate_names(names: DataFrame, column: str = "table", case_sensitive: bool = False) -> DataFrame:
    """Names that become equal once they are normalized."""
    key = clean_name(F.col(quote(column)), case_sensitive)
    return names.groupBy(key.alias("key")).agg(F.count("*").alias("n_names")).where("n_names > 1")


def compare_counts(source: DataFrame, target: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Counts of both sides per normalized name, ``MISSING`` where there is none.

    ``source`` and ``target`` hold ``table`` and ``n_rows``.
    """
    key = clean_name(F.col("table"), case_sensitive)
    a = source.select(key.alias("table"), F.col("n_rows").cast("string").alias("source_rows"))
    b = target.select(key.alias("table"), F.col("n_rows").cast("string").alias("target_rows"))
    return a.join(b, "table", "full_outer").select(
        "table",
        F.coalesce("source_rows", F.lit(MISSING)).alias("source_rows"),
        F.coalesce("target_rows", F.lit(MISSING)).alias("target_rows"),
    ).withColumn("differs", F.col("source_rows") != F.col("target_rows"))


def keyed_diff(source: DataFrame, target: DataFrame, pk: list[str], columns: list[str] | None = None) -> DataFrame:
    """Keys that are missing or extra in the target, or whose values differ.

    Values are compared null-safe and exactly. Two tables bucketed by the key
    are compared without a shuffle.
    """
    names = columns or [c for c in source.columns if c not in pk]
    side = lambda df, p: df.select(
        F.lit(True).alias(p), *[F.col(quote(k)).alias(f"{p}k{i}") for i, k in enumerate(pk)],
        *[F.col(quote(c)).alias(f"{p}{i}") for i, c in enumerate(names)])
    on = functools.reduce(Column.__and__, [F.col(f"ak{i}") == F.col(f"bk{i}") for i in range(len(pk))])
    j = side(source, "a").join(side(target, "b"), on, "full_outer")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    unequal = [~F.col(f"a{i}").eqNullSafe(F.col(f"b{i}")) for i in range(len(names))]
    changed = F.array_compact(F.array(*[F.when(u, F.lit(c)) for u, c in zip(unequal, names)]))
    kind = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    differs = ~both | functools.reduce(Column.__or__, unequal, F.lit(False))
    return j.where(differs).select(
        *[F.coalesce(f"ak{i}", f"bk{i}").alias(k) for i, k in enumerate(pk)],
        kind.alias("kind"), F.when(both, F.array_join(changed, ",")).otherwise("").alias("changed"))


def bucket_digests(df: DataFrame, pk: list[str], buckets: int) -> DataFrame:
    """(bucket, n_rows, total, mixed): digests of the rows of each hash bucket of the key, whatever their order.

    Nulls are hashed as such, so that a value doesn't pass for its neighbour's.
    """
    cells = [x for c in df.columns for x in (F.col(quote(c)), F.col(quote(c)).isNull())]
    rows = df.select(
        F.pmod(F.hash(*[F.col(quote(k)) for k in pk]), F.lit(buckets)).alias("bucket"), F.xxhash64(*cells).alias("one"), F.xxhash64(F.lit(1), *cells).alias("two"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n_rows"), F.sum(F.col("one").cast("decimal(38,0)")).alias("total"), F.bit_xor("two").alias("mixed"))


def differing_buckets(source: DataFrame, target: DataFrame) -> list[int]:
    """Buckets whose digests are not the same on both sides; one number per bucket at most."""
    b = target.select("bucket", *[F.col(c).alias(f"t_{c}") for c in ("n_rows", "total", "mixed")])
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ("n_rows", "total", "mixed")])
    return sorted(r[0] for r in source.join(b, "bucket", "full_outer").where(~same).select("bucket").collect())


def digest_diff(source: DataFrame, target: DataFrame, pk: list[str], buckets: int = 1024) -> DataFrame:
    """``keyed_diff`` of two tables of the same columns: only rows of buckets whose digests differ are joined."""
    names = source.columns
    target = target.select(*[F.col(quote(n)) for n in names])
    some = differing_buckets(bucket_digests(source, pk, buckets), bucket_digests(target, pk, buckets))
    keep = F.pmod(F.hash(*[F.col(quote(k)) for k in pk]), F.lit(buckets)).isin(some)
    return keyed_diff(source.where(keep), target.where(keep), pk)


def assertions(df: DataFrame, **checks: Column) -> DataFrame:
    """Point assertions over a table in one pass: each check is an aggregate."""
    return df.agg(*[c.alias(n) for n, c in checks.items()])


def value_where(condition: Column, value: Column, missing) -> Column:
    """Largest value among matching rows, ``missing`` when none matches."""
    return F.coalesce(F.max(F.when(condition, value)), F.lit(missing))


def rows_where(condition: Column) -> Column:
    """Number of matching rows."""
    return F.sum(F.when(condition, 1).otherwise(0))
