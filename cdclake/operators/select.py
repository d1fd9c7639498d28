"""Which tables and which columns take part."""

from __future__ import annotations

import dataclasses
import fnmatch
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.functions.types import TableMeta, quote


@dataclass(frozen=True)
class ColumnSelector:
    """Ordered rule: tables it applies to, and column patterns.

    The first rule that matches a table decides. Inside it the last matching
    pattern decides a column: ``name`` or ``*`` keeps, ``!name`` leaves out.
    """

    matcher: tuple[str, ...]
    columns: tuple[str, ...]

    def __post_init__(self):
        if not self.matcher:
            raise ValueError("a column selector needs a matcher")
        if not self.columns:
            raise ValueError("a column selector needs columns")


def select_meta(meta: TableMeta, selectors: list[ColumnSelector]) -> TableMeta:
    """The table with the columns its rule keeps; the key must stay whole."""
    fqn = f"{meta.db}.{meta.table}".lower()
    rule = next((s for s in selectors if any(fnmatch.fnmatchcase(fqn, m.lower()) for m in s.matcher)), None)
    if rule is None:
        return meta
    kept = []
    for c in meta.columns:
        keep = False
        for pattern in rule.columns:
            negative, name = pattern.startswith("!"), pattern.lstrip("!")
            if fnmatch.fnmatchcase(c.name.lower(), name.lower()):
                keep = not negative
        if keep:
            kept.append(c)
    lost = [k for k in meta.pk if k not in {c.name for c in kept}]
    if lost:
        raise ValueError(f"{fqn}: key column {lost[0]} must stay selected")
    return dataclasses.replace(meta, columns=tuple(kept))


def select_columns(df: DataFrame, meta: TableMeta, selectors: list[ColumnSelector]) -> DataFrame:
    """Projection to the selected columns, before any decoding or shuffle."""
    return df.select(*[F.col(quote(n)) for n in select_meta(meta, selectors).names])


def allowed_tables(df: DataFrame, tables: DataFrame, on: list[str] = ("db", "table")) -> DataFrame:
    """Rows of configured tables only."""
    return df.join(tables.select(*on), list(on), "left_semi")


def table_set_differences(configured: DataFrame, stored: DataFrame, key: str = "table") -> DataFrame:
    """Tables on one side only; the two sets must be equal, so no row may come."""
    missing = configured.select(key).distinct().join(stored, [key], "left_anti").withColumn("problem", F.lit("not stored"))
    extra = stored.select(key).distinct().join(configured, [key], "left_anti").withColumn("problem", F.lit("not configured"))
    return missing.unionByName(extra)
