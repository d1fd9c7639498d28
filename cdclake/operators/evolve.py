"""Schema evolution: from a DDL query and two table versions to one projection.

The next version's column list is known, so only what it cannot show is taken
from the query text: renames, and columns that were dropped and added again
under one name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta, TableMeta, decode_value, lossless, quote

# Action numbers of schema files.
CREATE_SCHEMA, DROP_SCHEMA, CREATE_TABLE, DROP_TABLE, TRUNCATE_TABLE, RENAME_TABLE = 1, 2, 3, 4, 11, 14

# Reasons why a row cannot take the new schema; raised if the row survives.
ERROR_COLUMN = "cdc_evolve_error"

_IDENT = r"(`(?:[^`]|``)+`|[\w$]+)"
_ALTER = r"(?is)^\s*alter\s+table\b"
_RENAME_COLUMN = r"(?i)\brename\s+column\s+" + _IDENT + r"\s+to\s+" + _IDENT
_CHANGE_COLUMN = r"(?i)\bchange\s+(?:column\s+)?(?:if\s+exists\s+)?" + _IDENT + r"\s+" + _IDENT
_DROP_COLUMN = r"(?i)\bdrop\s+(?:column\s+)?(?:if\s+exists\s+)?(?!(?:column|if|index|key|primary|foreign|constraint|check|default|not|partition)\b)" + _IDENT
_RENAME_TABLE = r"(?i)\brename\s+(?!column\b|index\b|key\b)(?:to\s+|as\s+|=\s*)?[`\w]"
_QUOTED = r"'(?:[^'\\]|''|\\.)*'|\"(?:[^\"\\]|\"\"|\\.)*\"|/\*.*?\*/|--[^\n]*"
_NOW = r"(?i)^(?:current_timestamp|now|localtime|localtimestamp)(?:\s*\(\s*\d*\s*\))?$"


class UnsupportedChange(ValueError):
    """A schema change that cannot be applied; the watermark must not move."""


@dataclass(frozen=True)
class Evolution:
    """How rows of one table version become rows of the next.

    ``kind`` is alter, none, truncate or drop. ``source`` maps each next column
    to the previous one it comes from, or None when it is new.
    """

    kind: str
    next: TableMeta
    prev: TableMeta | None = None
    source: dict[str, str | None] = field(default_factory=dict)

    @property
    def dropped(self) -> list[str]:
        used = {s.lower() for s in self.source.values() if s}
        return [c.name for c in self.prev.columns if c.name.lower() not in used] if self.prev else []

    @property
    def added(self) -> list[ColumnMeta]:
        return [c for c in self.next.columns if self.source.get(c.name) is None]

    def rewrites(self) -> bool:
        """True when stored rows must be written anew.

        Dropping columns and adding nullable ones without default is left to
        the reader, which matches columns by name.
        """
        if self.kind != "alter":
            return False
        prev = {c.name.lower(): c for c in self.prev.columns}
        for c in self.next.columns:
            src = self.source[c.name]
            if src is None:
                if c.default is not None or not c.nullable:
                    return True
                continue
            before = prev[src.lower()]
            tightened = before.nullable and not c.nullable
            if src.lower() != c.name.lower() or before.spark_type != c.spark_type or tightened or _narrower(before, c):
                return True
        return False


def _narrower(before: ColumnMeta, after: ColumnMeta) -> bool:
    return bool(
        after.tp in ("char", "varchar") and after.precision
        and (before.tp not in ("char", "varchar") or not before.precision or int(after.precision) < int(before.precision))
    )


def _name(ident: str) -> str:
    return ident[1:-1].replace("``", "`") if ident.startswith("`") else ident


def _mask(query: str) -> tuple[str, list[str]]:
    """Query with quoted names numbered, so that no name reads as a clause."""
    names: list[str] = []

    def number(m: re.Match) -> str:
        names.append(_name(m.group(0)))
        return f"`{len(names) - 1}`"

    return re.sub(r"`(?:[^`]|``)+`", number, query), names


def _renames(query: str, prev: TableMeta, name) -> dict[str, str]:
    """New name (lower case) to previous name, over all clauses of a query."""
    pairs = [
        (m.start(), name(m.group(1)), name(m.group(2)))
        for pattern in (_RENAME_COLUMN, _CHANGE_COLUMN)
        for m in re.finditer(pattern, query)
    ]
    known = {c.name.lower(): c.name for c in prev.columns}
    out: dict[str, str] = {}
    for _, old, new in sorted(pairs):
        # Names refer to the table as it was; or to an earlier clause's result.
        origin = known.get(old.lower()) or out.pop(old.lower(), None)
        if origin is None:
            raise UnsupportedChange(f"column {old} not found")
        out[new.lower()] = origin
    return out


def plan_evolution(prev: TableMeta | None, nxt: TableMeta, action: int, query: str) -> Evolution:
    """Plan the change to the next version; ``UnsupportedChange`` if there is none."""
    if action == TRUNCATE_TABLE:
        return Evolution("truncate", nxt, prev)
    if action == DROP_TABLE:
        return Evolution("drop", nxt, prev)
    if action in (CREATE_TABLE, CREATE_SCHEMA) and query.strip():
        raise UnsupportedChange("create DDL inside a change stream")
    if action == RENAME_TABLE:
        raise UnsupportedChange("rename table is not supported")
    if action == DROP_SCHEMA or not query.strip():
        return Evolution("none", nxt, prev)
    bare = re.sub(_QUOTED, "''", query, flags=re.S)
    if not re.match(_ALTER, bare):
        raise UnsupportedChange(f"unsupported DDL query: {query}")
    bare, names = _mask(bare)
    name = lambda ident: names[int(ident[1:-1])] if ident.startswith("`") else ident
    clauses = re.sub(r"(?is)^\s*alter\s+table\s+(?:`(?:[^`]|``)+`|[\w$]+)(?:\s*\.\s*(?:`(?:[^`]|``)+`|[\w$]+))?", "", bare, count=1)
    if re.search(_RENAME_TABLE, clauses):
        raise UnsupportedChange("rename table is not supported")
    if prev is None:
        raise UnsupportedChange("no previous schema to alter")
    renamed = _renames(clauses, prev, name)
    moved = {o.lower() for o in renamed.values()}
    dropped = {name(m.group(1)).lower() for m in re.finditer(_DROP_COLUMN, clauses)}
    known = {c.name.lower(): c.name for c in prev.columns}
    source: dict[str, str | None] = {}
    for c in nxt.columns:
        low = c.name.lower()
        if low in renamed:
            source[c.name] = renamed[low]
        elif low in known and low not in moved and low not in dropped:
            source[c.name] = known[low]
        else:
            source[c.name] = None
    plan = Evolution("alter", nxt, prev, source)
    missing = [n for n in renamed if n not in {c.name.lower() for c in nxt.columns}]
    if missing:
        raise UnsupportedChange(f"renamed column {missing[0]} not found in the next schema")
    gone = [n for n in plan.dropped if n.lower() not in dropped]
    if gone:
        # The query does not say that it drops them: a rename was missed.
        raise UnsupportedChange(f"column {gone[0]} vanished without a DROP clause: {query}")
    if source and all(v == k for k, v in source.items()) and prev.columns == nxt.columns:
        return Evolution("none", nxt, prev)
    return plan


def default_value(c: ColumnMeta) -> Column:
    """Value that existing rows take in an added column."""
    if c.default is None:
        return F.lit(None).cast(c.spark_type)
    if re.match(_NOW, c.default) and c.spark_type in ("timestamp", "timestamp_ntz", "date"):
        return F.current_timestamp().cast(c.spark_type)
    text = c.default
    if c.spark_type == "boolean":
        text = {"true": "1", "false": "0"}.get(text.lower(), text)
    if c.spark_type == "binary":
        return F.lit(text).cast("binary")
    return decode_value(F.lit(text), c.spark_type)


def _converted(before: ColumnMeta, after: ColumnMeta) -> tuple[Column, Column]:
    """New value of a kept column, and whether the old one does not fit."""
    old = F.col(quote(before.name))
    a, b = before.spark_type, after.spark_type
    if a == b:
        new, bad = old, F.lit(False)
    elif a == "binary" or b == "binary":
        new = old.cast(b)
        bad = old.isNotNull() & (new.isNull() | ~new.cast(a).eqNullSafe(old))
    else:
        new = old.try_cast(b)
        bad = F.lit(False) if lossless(a, b) else old.isNotNull() & ~new.try_cast(a).eqNullSafe(old)
    if _narrower(before, after):
        bad = bad | (F.char_length(new) > int(after.precision))
    return new, F.coalesce(bad, F.lit(False))


def evolve(df: DataFrame, plan: Evolution) -> DataFrame:
    """Rows of the next version, in its column order, as one projection.

    Columns outside the schema (the change envelope) pass through. Rows that do
    not fit are marked in ``cdc_evolve_error``; :func:`assert_evolved` raises.
    """
    if plan.kind in ("none", "drop"):
        return df
    if plan.kind == "truncate":
        return df.limit(0)
    own = {c.name.lower() for c in plan.prev.columns} | {ERROR_COLUMN}
    rest = [c for c in df.columns if c.lower() not in own]
    prev = {c.name.lower(): c for c in plan.prev.columns}
    out, errors = [], [F.col(ERROR_COLUMN)] if ERROR_COLUMN in df.columns else []
    for c in plan.next.columns:
        src = plan.source[c.name]
        if src is None:
            value, bad = default_value(c), F.lit(not c.nullable and c.default is None)
        else:
            value, bad = _converted(prev[src.lower()], c)
            if prev[src.lower()].nullable and not c.nullable:
                bad = bad | F.col(quote(src)).isNull()
        out.append(value.alias(c.name))
        errors.append(F.when(bad, F.lit(f"column {c.name} does not fit the new schema")))
    return df.select(*[F.col(quote(r)) for r in rest], *out, F.coalesce(*errors).alias(ERROR_COLUMN))


def assert_evolved(df: DataFrame) -> DataFrame:
    """Fail on rows that did not fit, and drop the mark."""
    if ERROR_COLUMN not in df.columns:
        return df
    err = F.col(ERROR_COLUMN)
    return df.where(F.when(err.isNull(), F.lit(True)).otherwise(F.raise_error(err).cast("boolean"))).drop(ERROR_COLUMN)


def schema_diff(prev: DataFrame, nxt: DataFrame, keys: list[str] = ("db", "table")) -> DataFrame:
    """Column differences between two catalogs, names compared without case."""
    attrs = ["name", "tp", "precision", "scale", "nullable", "default_value"]
    side = lambda df, p: df.select(
        *[F.col(k).alias(f"{p}_{k}") for k in keys], F.lower("name").alias(f"{p}_key"),
        *[F.col(quote(a)).alias(f"{p}_{a}") for a in attrs])
    a, b = side(prev, "a"), side(nxt, "b")
    on = [F.col(f"a_{k}") == F.col(f"b_{k}") for k in keys] + [F.col("a_key") == F.col("b_key")]
    j = a.join(b, on, "full_outer")
    differs = lambda *cols: ~F.struct(*[F.col(f"a_{c}") for c in cols]).eqNullSafe(F.struct(*[F.col(f"b_{c}") for c in cols]))
    changes = F.array_compact(F.array(
        F.when(F.col("a_key").isNull(), "added"),
        F.when(F.col("b_key").isNull(), "dropped"),
        *[
            F.when(F.col("a_key").isNotNull() & F.col("b_key").isNotNull() & cond, name)
            for name, cond in (
                ("type", differs("tp", "precision", "scale")),
                ("nullability", differs("nullable")),
                ("default", differs("default_value")),
            )
        ],
    ))
    return j.select(
        *[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys],
        F.coalesce("b_name", "a_name").alias("name"),
        F.explode(changes).alias("change"),
    )


def classify_ddl(df: DataFrame, query: str = "query", action: str = "action") -> DataFrame:
    """What the replay of a DDL row does: its ``kind``, by action and text."""
    bare = F.regexp_replace(F.regexp_replace(query, "(?s)" + _QUOTED, "''"), "`(?:[^`]|``)+`", "`x`")
    clauses = F.regexp_replace(bare, r"(?is)^\s*alter\s+table\s+(?:`(?:[^`]|``)+`|[\w$]+)(?:\s*\.\s*(?:`(?:[^`]|``)+`|[\w$]+))?", "")
    a = F.col(action)
    column_change = clauses.rlike(r"(?i)\b(?:rename\s+column|change|modify|alter\s+(?:column\s+)?[`\w$]+\s+(?:set|drop))\b")
    add_column = clauses.rlike(r"(?i)\badd\s+(?:column\b|(?!index\b|key\b|unique\b|primary\b|constraint\b|foreign\b|fulltext\b|spatial\b|check\b|partition\b)[`\w$])")
    kind = (
        F.when(a == TRUNCATE_TABLE, "truncate")
        .when(a == DROP_TABLE, "drop")
        .when(a.isin(CREATE_TABLE, CREATE_SCHEMA) & (F.trim(query) != ""), "error")
        .when(a == RENAME_TABLE, "error")
        .when(a == DROP_SCHEMA, "none")
        .when(F.trim(query) == "", "none")
        .when(~bare.rlike(_ALTER), "error")
        .when(clauses.rlike(_RENAME_TABLE), "error")
        .when(column_change | add_column | clauses.rlike(_DROP_COLUMN), "alter")
        .otherwise("none")
    )
    return df.withColumn("kind", kind)
