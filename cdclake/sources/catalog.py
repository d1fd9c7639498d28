"""Column catalogs from ``CREATE TABLE`` files and from schema files.

Both kinds of file become rows of ``(path, text)``; all the rest is column
expressions over that text, so thousands of tables are one narrow Spark job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions import ddl
from cdclake.functions.names import DATABASE_FILE_SUFFIX, SCHEMA_FILE_SUFFIX, schema_version, unescape_name
from cdclake.functions.types import ColumnMeta, TableMeta
from cdclake.sources import storage
from cdclake.sources.local import no_rows

# Spellings of one source type.
TYPE_ALIASES = {
    "integer": "int",
    "dec": "decimal",
    "fixed": "decimal",
    "numeric": "decimal",
    "real": "double",
    "boolean": "bool",
}
# Lengths that come with a type instead of being written.
IMPLIED_LENGTHS = {
    "tinyblob": "255",
    "blob": "65535",
    "mediumblob": "16777215",
    "longblob": "67108864",
    "char": "1",
    "binary": "1",
    "bit": "1",
    "decimal": "10",
    "datetime": "0",
    "timestamp": "0",
    "time": "0",
}

CATALOG_COLUMNS = [
    "db", "table", "ordinal", "name", "tp", "precision", "scale", "nullable", "is_pk", "pk_ordinal",
    "default_value", "default_kind", "generated", "elems",
]

_NAME = r"^(?:`((?:[^`]|``)+)`|([A-Za-z0-9_$]+))\s+"
_ARGS = r"^[A-Za-z]+\s*\(((?:'(?:[^']|'')*'|[^')])*)\)"
_QUOTED = r"'(?:[^'\\]++|''|\\.)*'"
_BREAKS = r"[\t\n\x0B\f\r]"
_KEY_CLAUSE = r"(?i)^(?:constraint\s+\S+\s+)?primary\s+key"
_NOT_COLUMNS = (
    r"(?i)^(?:(?:primary|unique|foreign|fulltext|spatial|check|constraint|partition|create|set|insert|drop|use)\b"
    r"|(?:key|index)\s+[`(\w]|[)(/;-]|$)"
)


# --------------------------------------------------------------------------
# Files
# --------------------------------------------------------------------------

def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, length)`` of all files below ``root``; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")


def snapshot_files(files: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Data files of a snapshot listing with their decoded table names.

    Names that are not ``<db>.<table>[.<n>].csv[.gz]`` are no data files. With
    ``tables(db, table)``, only files of configured tables are kept.
    """
    # Files of an export lie in a folder that is named like a data file.
    name = F.regexp_extract("path", r"([^/]*)(?:/part-[^/]*)?$", 1)
    parts = F.regexp_extract(name, r"^([^.]+)\.([^.]+)(?:\..*)?\.csv(?:\.gz)?$", 1), F.regexp_extract(
        name, r"^([^.]+)\.([^.]+)(?:\..*)?\.csv(?:\.gz)?$", 2)
    found = files.select(
        unescape_name(parts[0]).alias("db"), unescape_name(parts[1]).alias("table"), "path", "length",
        name.endswith(".gz").alias("gzip"),
    ).where("db is not null and table is not null")
    return found if tables is None else found.join(tables, ["db", "table"], "left_semi")


def snapshot_databases(files: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Databases that have a database file (and a configured table)."""
    escaped = F.regexp_extract("path", r"([^/]*)" + DATABASE_FILE_SUFFIX.replace(".", r"\.") + "$", 1)
    found = files.select(unescape_name(escaped).alias("db")).where("db is not null").distinct()
    return found if tables is None else found.join(tables.select("db"), ["db"], "left_semi")


def has_files(spark: SparkSession, path: str) -> bool:
    """True when a folder holds any object; tells a half-written snapshot."""
    return bool(storage.list_names(spark, path))


def snapshot_commit_ts(texts: DataFrame) -> DataFrame:
    """Snapshot timestamp of every ``(path, text)`` metadata file.

    A file without a ``Pos:`` line, or with a zero or unreadable one, fails.
    """
    first = F.regexp_extract("text", r"(?m)^[ \t\r\f]*Pos:[ \t\r\f]*([^\n]*?)[ \t\r\f]*$", 1)
    pos = F.when(first.rlike("^[0-9]+$"), first).try_cast("decimal(20,0)")
    fail = F.raise_error(F.concat(F.lit("snapshot metadata holds no usable Pos: "), F.col("path")))
    return texts.select("path", F.when(pos > 0, pos).otherwise(fail).alias("commit_ts"))


def read_snapshot_commit_ts(spark: SparkSession, root: str) -> int:
    texts = spark.read.text(f"{root}/snapshot/metadata", wholetext=True)
    return int(snapshot_commit_ts(texts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))).first()[1])


def checkpoint_of(texts: DataFrame) -> DataFrame:
    """Checkpoint of every ``(path, text)`` increment metadata file."""
    value = F.get_json_object("text", "$['checkpoint-ts']").try_cast("decimal(20,0)")
    fail = F.raise_error(F.concat(F.lit("unreadable increment metadata "), F.col("path")))
    return texts.select("path", F.when(value.isNotNull(), value).otherwise(fail).alias("checkpoint_ts"))


def read_checkpoint(spark: SparkSession, root: str) -> int | None:
    """Published checkpoint, or None when there is none yet."""
    path = f"{root}/increment/metadata"
    if not storage.exists(spark, path):
        return None
    texts = spark.read.text(path, wholetext=True)
    return int(checkpoint_of(texts.select(F.lit(path).alias("path"), F.col("value").alias("text"))).first()[1])


# --------------------------------------------------------------------------
# CREATE TABLE files
# --------------------------------------------------------------------------

def read_ddl_texts(spark: SparkSession, root: str) -> DataFrame:
    """``(db, table, text)`` of all table schema files of a snapshot."""
    texts = spark.read.text(f"{root}/snapshot/*{SCHEMA_FILE_SUFFIX}", wholetext=True)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)-schema\.sql$", 1)
    # The path column is percent-encoded as a URI once more.
    stem = F.replace(stem, F.lit("%25"), F.lit("%"))
    return texts.select(
        unescape_name(F.substring_index(stem, ".", 1)).alias("db"),
        unescape_name(F.regexp_extract(stem, r"^[^.]*\.(.*)$", 1)).alias("table"),
        F.col("value").alias("text"),
    ).where("table is not null")


def _unquote_ident(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, "^`|`$", ""), F.lit("``"), F.lit("`"))


_HEAD = rf"(?is)create\s+(?:temporary\s+)?table\s+(?:if\s+not\s+exists\s+)?(?:`(?:[^`]|``)*+`|[^\s`(.]+)(?:\.(?:`(?:[^`]|``)*+`|[^\s`(]+))?\s*\(([0-9]+)\)"


def ddl_columns(texts: DataFrame, keep_generated: bool = False) -> DataFrame:
    """Column catalog of ``(db, table, text)`` rows with ``CREATE TABLE`` texts in any layout.

    The body is cut at its own commas, not at those within quotes and brackets, which may nest
    to any depth. What is neither a column nor a known clause fails. Generated columns are
    absent from snapshots and are dropped here too.

    A text is small and its parsing is long, so texts are dealt out by table first: otherwise
    a file that is read as one split, with all its texts, would be parsed by a single task.
    """
    texts = texts.select("db", "table", "text").repartition("db", "table")
    whole = texts.select("db", "table", ddl.outline(F.col("text")).alias("whole"))
    body = ddl.let(F.regexp_extract("whole.flat", _HEAD, 1), lambda number: F.when(number != "", F.get("whole.groups", number.cast("int"))))
    no_table = F.raise_error(F.concat(F.lit("no CREATE TABLE text of "), "db", F.lit("."), "table")).cast("string")
    texts = whole.select("db", "table", ddl.outline(ddl.let(body, lambda b: F.when(F.trim(F.coalesce(b, F.lit(""))) == "", no_table).otherwise(b))).alias("body"))
    on_a_line = lambda x: F.trim(F.regexp_replace(x, _BREAKS, " "))
    texts = texts.select("db", "table", "body.groups", F.transform(ddl.at_commas(F.col("body.flat")), on_a_line).alias("pieces"))
    # Groups are put back only where they are read: a piece and its outline begin alike.
    whole_line = lambda x: on_a_line(ddl.restored(x, F.col("groups")))
    # Key columns of the table-level clause, in order; prefix lengths removed.
    keys = F.transform(F.filter("pieces", lambda x: x.rlike(_KEY_CLAUSE)), whole_line)
    bare = F.regexp_replace(F.array_join(keys, ","), _QUOTED, "''")
    clause = F.regexp_extract(bare, r"(?i)primary\s+key\s*(?:`[^`]*`\s*)?(?:using\s+\w+\s*)?\(((?:`(?:[^`]|``)*`|\([0-9]+\)|[^()])*)\)", 1)
    idents = F.regexp_extract_all(clause, F.lit(r"(`(?:[^`]|``)+`|[A-Za-z_$][A-Za-z0-9_$]*)(?:\s*\([0-9]+\))?(?:\s+(?i:asc|desc))?"), 1)
    table_pk = F.transform(idents, lambda x: F.lower(_unquote_ident(x)))
    # Per text, before its lines are rows: beside them it would be taken from all pieces again for each line.
    texts = texts.select("db", "table", "groups", "pieces", table_pk.alias("table_pk"))
    # No text is without pieces. A plain explode would have Spark test that below, where it takes the outline apart again and again.
    lines = texts.select("db", "table", "groups", "table_pk", F.posexplode_outer("pieces").alias("line_no", "flat"))
    line = whole_line(F.col("flat"))
    odd = F.raise_error(F.concat(F.lit("not understood in CREATE TABLE of "), "db", F.lit("."), "table", F.lit(": "), line)).cast("boolean")
    lines = lines.where(F.when(F.col("flat").rlike(_NOT_COLUMNS), False).when(F.col("flat").rlike(_NAME), True).otherwise(odd))

    # A line begins with the same name as its outline, as that has no brackets of its own.
    lead = F.regexp_extract("flat", _NAME, 0)
    after = lambda x: F.substr(x, F.length(lead) + 1)
    rest = after(F.col("flat"))
    word = F.lower(F.regexp_extract(rest, "^([A-Za-z]+)", 1))
    alias = F.create_map(*[F.lit(x) for kv in TYPE_ALIASES.items() for x in kv])
    args = F.trim(F.regexp_extract(after(line), _ARGS, 1))
    # Brackets in what follows the type are numbers here: words in expressions are no clauses.
    tail = F.regexp_replace(rest, r"^[A-Za-z]+ *(?:\([0-9]+\))? *", "")
    flags = F.regexp_replace(tail, _QUOTED, "''")
    parsed = lines.select(
        "db", "table", "table_pk", "line_no",
        F.when(lead.startswith("`"), _unquote_ident(F.rtrim(lead))).otherwise(F.rtrim(lead)).alias("name"),
        F.coalesce(F.try_element_at(alias, word), word).alias("base"),
        args.alias("args"), tail.alias("tail"), flags.alias("flags"), "groups",
        F.col("flat").rlike(r"(?i)\bas\b").alias("has_as"),
    )
    default = F.regexp_extract("tail", r"(?i)\bdefault\s+(" + _QUOTED + r"|\([0-9]+\)|[A-Za-z_]\w*\s*\([0-9]+\)|[^\s,]+)", 1)
    default = F.when(F.col("flags").rlike(r"(?i)\bdefault\b") & ~F.lower(default).isin("null", ""), default)
    # A column of its own, as it is used many times below.
    parsed = parsed.withColumn("written", ddl.restored(default, F.col("groups")))

    base, args, flags = F.col("base"), F.col("args"), F.col("flags")
    # FLOAT(p) with more than 24 bits is a double.
    base = F.when((base == "float") & (args.try_cast("int") > 24), "double").otherwise(base)
    unsigned = flags.rlike(r"(?i)\b(?:unsigned|zerofill)\b") & ~base.isin("bit", "year")
    sized = ~base.isin("enum", "set", "tinyblob", "blob", "mediumblob", "longblob")
    implied = F.create_map(*[F.lit(x) for kv in IMPLIED_LENGTHS.items() for x in kv])
    size = F.split(args, r"\s*,\s*")
    precision = F.when(sized & (args != ""), size[0]).otherwise(F.coalesce(F.try_element_at(implied, base), F.lit("")))
    scale = F.when(sized & (F.size(size) > 1), F.try_element_at(size, F.lit(2))).when(base == "decimal", "0").otherwise("")
    generated_at = F.col("has_as") & flags.rlike(r"(?i)(?:\bgenerated\s+always\s+as\b|(?:^|\s)as\s*\()")
    inline_pk = flags.rlike(r"(?i)\bprimary\s+key\b") & ~generated_at
    in_table_pk = F.array_position("table_pk", F.lower("name"))
    is_pk = inline_pk | (in_table_pk > 0)

    default = F.col("written")
    quoted = default.startswith("'")
    literal = F.when(quoted, F.replace(F.regexp_replace(default, "^'|'$", ""), F.lit("''"), F.lit("'"))).otherwise(default)
    kind = (
        F.when(default.isNull() | generated_at, "none")
        .when(quoted | default.rlike(r"^[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?$") | F.lower(default).isin("true", "false"), "literal")
        .otherwise("expression")
    )
    elems = F.when(base.isin("enum", "set"), F.transform(
        F.regexp_extract_all(args, F.lit("'((?:[^']|'')*)'"), 1), lambda e: F.replace(e, F.lit("''"), F.lit("'"))))
    rows = parsed.select(
        "db", "table",
        F.col("line_no").cast("bigint").alias("ordinal"), "name",
        F.when(unsigned, F.concat(base, F.lit(" unsigned"))).otherwise(base).alias("tp"),
        precision.alias("precision"), scale.alias("scale"),
        (~(flags.rlike(r"(?i)\bnot\s+null\b") | is_pk)).alias("nullable"),
        is_pk.alias("is_pk"),
        # Inline keys come before those of the table-level clause.
        F.when(inline_pk, F.lit(0)).otherwise(in_table_pk).cast("bigint").alias("pk_ordinal"),
        F.when(kind != "none", literal).alias("default_value"), kind.alias("default_kind"),
        F.when(~generated_at, "").when(flags.rlike(r"(?i)\bstored\b"), "stored").otherwise("virtual").alias("generated"),
        elems.alias("elems"),
    )
    return rows if keep_generated else rows.where("generated = ''")


# --------------------------------------------------------------------------
# Schema files of the change stream
# --------------------------------------------------------------------------

_SCHEMA_FILE = T.StructType([
    T.StructField("Schema", T.StringType()),
    T.StructField("Table", T.StringType()),
    T.StructField("TableVersion", T.DecimalType(20, 0)),
    T.StructField("Query", T.StringType()),
    T.StructField("Type", T.IntegerType()),
    T.StructField("TableColumns", T.ArrayType(T.StructType([
        T.StructField("ColumnName", T.StringType()),
        T.StructField("ColumnType", T.StringType()),
        T.StructField("ColumnPrecision", T.StringType()),
        T.StructField("ColumnLength", T.StringType()),
        T.StructField("ColumnScale", T.StringType()),
        T.StructField("ColumnNullable", T.StringType()),
        T.StructField("ColumnIsPk", T.StringType()),
        T.StructField("ColumnDefault", T.StringType()),
    ]))),
])


_FILE_VERSION = re.compile(r"/schema_([0-9]+)_[^/]*$")


def read_schema_texts(
    spark: SparkSession, root: str, tables: list[str] | None = None, applied: dict[str, int] | None = None,
) -> DataFrame:
    """``(path, text)`` of the schema files of the given tables, or of all.

    Files older than a table's ``applied`` version are told by their names and not read.
    """
    base = storage.literal(f"{root}/increment")
    found = []
    if tables:
        for t in tables:
            db, table = t.split(".", 1)
            oldest = (applied or {}).get(t, 0)
            for path, _ in storage.glob(spark, f"{base}/{storage.literal(db)}/{storage.literal(table)}/meta/schema_*.json"):
                version = _FILE_VERSION.search(path)
                if version is None or int(version[1]) >= oldest:
                    found.append(path)
    else:
        found = [path for path, _ in storage.glob(spark, f"{base}/*/*/meta/schema_*.json")]
    if not found:
        return no_rows(spark, "path string, text string")
    return spark.read.text([storage.literal(p) for p in found], wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def schema_epochs(texts: DataFrame) -> DataFrame:
    """Table versions of ``(path, text)`` schema files, with parsed content."""
    parsed = texts.select("path", schema_version(F.col("path")).alias("version"), F.from_json("text", _SCHEMA_FILE).alias("f"))
    fail = F.raise_error(F.concat(F.lit("invalid schema file "), F.col("path")))
    return parsed.select(
        F.col("f.Schema").alias("db"), F.col("f.Table").alias("table"),
        F.when(F.col("version").isNotNull() & F.col("f.Table").isNotNull(), F.col("version")).otherwise(fail).alias("version"),
        F.coalesce("f.Query", F.lit("")).alias("query"),
        F.coalesce("f.Type", F.lit(0)).alias("action"),
        "path", F.col("f.TableColumns").alias("columns"),
    )


def epoch_columns(epochs: DataFrame) -> DataFrame:
    """Column catalog of schema epochs, one row per column and version."""
    c = epochs.select("db", "table", "version", F.posexplode("columns").alias("ordinal", "c"))
    return c.select(
        "db", "table", "version", F.col("ordinal").cast("bigint").alias("ordinal"),
        F.col("c.ColumnName").alias("name"), F.lower("c.ColumnType").alias("tp"),
        F.coalesce("c.ColumnPrecision", "c.ColumnLength", F.lit("")).alias("precision"),
        F.coalesce("c.ColumnScale", F.lit("")).alias("scale"),
        (F.coalesce("c.ColumnNullable", F.lit("true")) != "false").alias("nullable"),
        (F.coalesce("c.ColumnIsPk", F.lit("false")) == "true").alias("is_pk"),
        F.col("c.ColumnDefault").alias("default_value"),
    )


# --------------------------------------------------------------------------
# Admission
# --------------------------------------------------------------------------

def pk_admission(columns: DataFrame, keys: list[str] = ("db", "table")) -> DataFrame:
    """Tables with the number of their key columns; none means rejected."""
    return columns.groupBy(*keys).agg(F.count_if("is_pk").alias("n_pk")).withColumn("admitted", F.col("n_pk") > 0)


def stored_generated(query: Column) -> Column:
    """True when a DDL text defines a STORED generated column, however deep its expression nests."""
    return F.exists(ddl.levels(query), lambda x: x.rlike(r"(?is)\bas\s*\(\)[^,()]*\bstored\b"))


def generated_report(texts: DataFrame) -> DataFrame:
    """Generated columns per ``(db, table, text)`` and whether increments run.

    Virtual columns are only dropped; stored ones would shift the positions of
    change rows and reject the table.
    """
    return texts.select("db", "table", "text").transform(lambda t: ddl_columns(t, True)).groupBy("db", "table").agg(
        F.count_if(F.col("generated") == "virtual").alias("n_virtual"),
        F.count_if(F.col("generated") == "stored").alias("n_stored"),
        F.count_if(F.col("generated") == "").alias("n_plain"),
    ).withColumn("incremental_ok", F.col("n_stored") == 0)


def table_metas(columns: DataFrame, pk_order: str = "pk_ordinal") -> list[TableMeta]:
    """Catalog rows as driver objects. One row per column: catalog-sized only."""
    by_table: dict[tuple, list] = {}
    for r in sorted(columns.collect(), key=lambda r: (r["db"], r["table"], r["ordinal"])):
        by_table.setdefault((r["db"], r["table"]), []).append(r)
    out = []
    for (db, table), rows in by_table.items():
        kind = lambda r: r["default_kind"] if "default_kind" in r else ("none" if r["default_value"] is None else "literal")
        cols = tuple(
            ColumnMeta(r["name"], r["tp"], r["precision"] or "", r["scale"] or "", r["nullable"], r["is_pk"], r["default_value"], kind(r))
            for r in rows
        )
        keyed = sorted((r for r in rows if r["is_pk"]), key=lambda r: (r[pk_order] if pk_order in r else 0, r["ordinal"]))
        out.append(TableMeta(db, table, cols, tuple(r["name"] for r in keyed)))
    return out
