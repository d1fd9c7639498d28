"""Source column types, their Spark types, and typed decoding of text fields.

Every decoder is a Catalyst expression. A text that cannot be decoded is never
turned into a silent null: it fails the job, or is reported in a column.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Source type -> Spark type (SQL spelling).
SPARK_TYPES = {
    "tinyint": "tinyint",
    "smallint": "smallint",
    "mediumint": "int",
    "int": "int",
    "bigint": "bigint",
    "tinyint unsigned": "smallint",
    "smallint unsigned": "int",
    "mediumint unsigned": "int",
    "int unsigned": "bigint",
    "bigint unsigned": "decimal(20,0)",
    "float": "float",
    "float unsigned": "float",
    "double": "double",
    "double unsigned": "double",
    "bool": "boolean",
    "boolean": "boolean",
    "bit": "decimal(20,0)",
    "year": "smallint",
    "date": "date",
    "datetime": "timestamp_ntz",
    "timestamp": "timestamp",
    "time": "interval hour to second",
    "char": "string",
    "varchar": "string",
    "tinytext": "string",
    "text": "string",
    "mediumtext": "string",
    "longtext": "string",
    "enum": "string",
    "set": "string",
    "json": "string",
    "vector": "string",
    "binary": "binary",
    "varbinary": "binary",
    "tinyblob": "binary",
    "blob": "binary",
    "mediumblob": "binary",
    "longblob": "binary",
}

# Types whose Spark type depends on precision and scale.
DECIMAL_TYPES = ["decimal", "numeric", "decimal unsigned", "numeric unsigned"]
MAX_DECIMAL_PRECISION = 38

# Integer types in widening order, for the lossless-cast test.
_INT_RANK = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}
_INT_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


@dataclass(frozen=True)
class ColumnMeta:
    """One source column. ``default_kind`` is none, literal or expression."""

    name: str
    tp: str
    precision: str = ""
    scale: str = ""
    nullable: bool = True
    is_pk: bool = False
    default: str | None = None
    default_kind: str = "none"

    @property
    def spark_type(self) -> str:
        return spark_type(self.tp, self.precision, self.scale)


@dataclass(frozen=True)
class TableMeta:
    """Ordered columns and ordered primary key of one table version."""

    db: str
    table: str
    columns: tuple[ColumnMeta, ...] = field(default_factory=tuple)
    pk: tuple[str, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def ddl(self) -> str:
        """Spark column list of the table."""
        return ", ".join(f"{quote(c.name)} {c.spark_type}" for c in self.columns)

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> TableMeta:
        d = json.loads(text)
        return TableMeta(
            d["db"], d["table"], tuple(ColumnMeta(**c) for c in d["columns"]), tuple(d["pk"])
        )


def quote(name: str) -> str:
    """Backtick-quote a column name for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"


def spark_type(tp: str, precision: str | int | None = "", scale: str | int | None = "") -> str:
    """Spark SQL type of a source type; ``ValueError`` when it is unknown."""
    key = tp.strip().lower()
    if key in DECIMAL_TYPES:
        p = int(precision) if precision not in ("", None) else 10
        s = int(scale) if scale not in ("", None) else 0
        return "string" if p > MAX_DECIMAL_PRECISION else f"decimal({p},{s})"
    if key not in SPARK_TYPES:
        raise ValueError(f"unsupported source type {tp!r}")
    return SPARK_TYPES[key]


def type_map(columns: DataFrame, tp: str = "tp", precision: str = "precision", scale: str = "scale") -> DataFrame:
    """Add ``spark_type`` to a column catalog; unknown types fail the job.

    The mapping is a constant map literal inside the projection, so a catalog of
    any size is mapped without a join.
    """
    lookup = F.create_map(*[F.lit(x) for kv in SPARK_TYPES.items() for x in kv])
    key = F.lower(F.trim(F.col(tp)))
    p = F.coalesce(F.expr(f"try_cast({quote(precision)} as int)"), F.lit(10))
    s = F.coalesce(F.expr(f"try_cast({quote(scale)} as int)"), F.lit(0))
    decimal = F.when(p > MAX_DECIMAL_PRECISION, F.lit("string")).otherwise(
        F.concat(F.lit("decimal("), p.cast("string"), F.lit(","), s.cast("string"), F.lit(")"))
    )
    mapped = F.when(key.isin(DECIMAL_TYPES), decimal).otherwise(F.try_element_at(lookup, key))
    return columns.withColumn(
        "spark_type",
        F.when(mapped.isNull(), F.raise_error(F.concat(F.lit("unsupported source type "), F.col(tp)))).otherwise(mapped),
    )


def decode_value(raw: Column, target: str) -> Column:
    """Decode text to a Spark type; null where the text does not fit."""
    if target == "string":
        return raw
    if target == "binary":
        return F.unhex(raw)
    if target == "timestamp":
        # The source writes UTC; pin it so that the session zone has no say.
        return F.concat(raw, F.lit("Z")).try_cast("timestamp")
    return raw.try_cast(target)


def decode_columns(df: DataFrame, columns: list[ColumnMeta], on_error: str = "raise", keep: list[str] = ()) -> DataFrame:
    """Turn text columns into typed ones, in the order of ``columns``.

    ``on_error="raise"`` fails on the first undecodable text;
    ``on_error="report"`` adds ``decode_errors``, the names of such columns.
    """
    out, errors = [], []
    for c in columns:
        raw = F.col(quote(c.name))
        value = decode_value(raw, c.spark_type)
        bad = raw.isNotNull() & value.isNull()
        if on_error == "raise" and c.spark_type != "string":
            message = F.concat(F.lit(f"column {c.name}: not a {c.spark_type}: "), raw)
            # The failure is evaluated only where the decoding gave nothing.
            value = F.coalesce(value, F.when(raw.isNotNull(), F.raise_error(message).cast(c.spark_type)))
        elif c.spark_type != "string":
            errors.append(F.when(bad, F.lit(c.name)))
        out.append(value.alias(c.name))
    if on_error == "report":
        found = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
        out.append(found.alias("decode_errors"))
    return df.select(*[F.col(quote(k)) for k in keep], *out)


def encode_value(col: Column, tp: str) -> Column:
    """Text of a typed value in the export dialect (inverse of decoding)."""
    if tp == "binary":
        return F.hex(col)
    if tp == "boolean":
        return col.cast("int").cast("string")
    if tp == "timestamp":
        return F.to_timestamp_ntz(F.to_utc_timestamp(col, F.current_timezone()).cast("string")).cast("string")
    if tp == "interval hour to second":
        # INTERVAL '-12:34:56.5' HOUR TO SECOND -> -12:34:56.5
        return F.regexp_extract(col.cast("string"), r"'([^']*)'", 1)
    return col.cast("string")


def lossless(old: str, new: str) -> bool:
    """True when every value of ``old`` has an equal value in ``new``."""
    if old == new or (new == "string" and old not in ("binary", "float", "double")):
        return True
    if old in _INT_RANK and new in _INT_RANK:
        return _INT_RANK[old] <= _INT_RANK[new]
    if old in _INT_RANK and new.startswith("decimal"):
        p, s = (int(x) for x in new[8:-1].split(","))
        return p - s >= _INT_DIGITS[old]
    if old.startswith("decimal") and new.startswith("decimal"):
        (p1, s1), (p2, s2) = ([int(x) for x in t[8:-1].split(",")] for t in (old, new))
        return s2 >= s1 and p2 - s2 >= p1 - s1
    return (old, new) in {("float", "double"), ("date", "timestamp_ntz"), ("smallint", "float"), ("tinyint", "float"), ("int", "double"), ("smallint", "double"), ("tinyint", "double")}
