"""Snapshot and change files in the CSV dialect of the contract.

Comma separated, ``"`` quoted, no header, ``\\N`` is null, an empty field is an
empty string, binaries are hexadecimal.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.names import escape_text
from cdclake.functions.types import ColumnMeta, TableMeta, decode_columns, encode_value, quote
from cdclake.sources import storage

NULL_TEXT = "\\N"
# A text no field holds; keeps Spark from taking anything for null by itself.
_NO_NULL = "\x01\x02\x01"

# Envelope columns of a change row, in front of the table's own columns.
ENVELOPE = ["cdc_flag", "cdc_table", "cdc_schema", "cdc_commit_ts"]
# Where the row came from; orders rows that share a commit timestamp.
POSITION = ["cdc_version", "cdc_partition", "cdc_date", "cdc_file_idx", "cdc_block", "cdc_row"]


#: Row ends that a source can declare.
LINE_ENDS = ("\n", "\r\n")


def _null_rule(c: Column) -> Column:
    return F.when(c.isNull(), "").when(c == NULL_TEXT, None).otherwise(c)


def _reader(spark: SparkSession, names: list[str], escape: str, multiline: bool, line_sep: str):
    if line_sep not in LINE_ENDS:
        raise ValueError(f"a source's row end is one of {LINE_ENDS}, not {line_sep!r}")
    reader = (
        spark.read.schema(", ".join(f"{quote(n)} string" for n in names))
        .option("sep", ",").option("quote", '"').option("escape", escape)
        .option("nullValue", _NO_NULL).option("emptyValue", "")
        .option("multiLine", multiline).option("mode", "FAILFAST")
        # A row of the wrong width must fail even if few columns are selected.
        .option("columnPruning", False)
    )
    # Without this the parser guesses the row end of each file, and rewrites line ends in values.
    return reader.option("lineSep", line_sep)


def _row_end(last: Column, line_sep: str) -> Column:
    """The last field of a row; rows that end otherwise than declared fail.

    With rows that end in ``\\n``, a last field with ``\\r`` at its end is what a row ending in
    ``\\r\\n`` looks like. A source whose last column holds such values declares ``\\r\\n`` rows.
    """
    if line_sep != "\n":
        return last
    wrong = F.raise_error(F.lit("rows end in CR LF, but LF is declared: set line_sep to '\\r\\n'")).cast("string")
    return F.when(last.endswith("\r"), wrong).otherwise(last)


def read_csv_text(
    spark: SparkSession, paths: str | list[str], names: list[str],
    escape: str = '"', multiline: bool = True, line_sep: str = "\n",
) -> DataFrame:
    """All fields as text with the dialect's rule for null and empty.

    ``line_sep`` declares how rows end; values keep their line ends as they are.
    ``escape="\\\\"`` reads backslash escapes instead of doubled quotes.
    ``multiline=False`` lets Spark split files that hold no embedded newline.
    """
    raw = _reader(spark, names, escape, multiline, line_sep).csv(paths)
    fields = [F.col(quote(n)) for n in names]
    fields[-1] = _row_end(fields[-1], line_sep)
    return raw.select(*[_null_rule(c).alias(n) for c, n in zip(fields, names)])


def read_snapshot(
    spark: SparkSession, paths: str | list[str], meta: TableMeta, on_error: str = "raise",
    partitions: int | None = None, **csv_options,
) -> DataFrame:
    """Typed rows of all snapshot files of one table, plain or gzip, in one scan.

    Compressed and multi-line files cannot be split; ``partitions`` spreads the
    rows of a few large ones before the decoding.
    """
    text = read_csv_text(spark, paths, meta.names, **csv_options)
    if partitions:
        text = text.repartition(partitions)
    return decode_columns(text, list(meta.columns), on_error)


def _position(path: Column, version: int | None) -> list[Column]:
    """Version, partition, date and index of a row's file.

    Runs for every row, so it cuts the path at slashes instead of matching it.
    """
    up = lambda n: F.substring_index(F.substring_index(path, "/", -n), "/", 1)
    partitioned = up(4).rlike("^[0-9]+$") if version is None else up(4) == str(version)
    file = F.substring_index(path, "/", -1)
    return [
        (F.when(partitioned, up(4)).otherwise(up(3)).try_cast("decimal(20,0)") if version is None else F.lit(version).cast("decimal(20,0)")).alias("cdc_version"),
        F.coalesce(F.when(partitioned, up(3)).try_cast("bigint"), F.lit(0).cast("bigint")).alias("cdc_partition"),
        up(2).alias("cdc_date"),
        F.substring(file, F.lit(4), F.length(file) - 7).try_cast("bigint").alias("cdc_file_idx"),
    ]


def read_changes(
    spark: SparkSession, paths: str | list[str], columns: list[ColumnMeta], on_error: str = "raise",
    escape: str = '"', multiline: bool = True, line_sep: str = "\n", version: int | None = None,
    after: int | None = None,
) -> DataFrame:
    """Typed change rows with their envelope and position.

    Columns are taken by position. The position (file path, block, running row
    number) makes the newest of several changes with one timestamp well defined.
    Pass the table ``version`` where it is known. Rows committed up to ``after``
    are dropped as text, before anything is decoded or numbered.
    """
    names = ENVELOPE + [c.name for c in columns]
    text_names = ["c_flag", "c_table", "c_schema", "c_ts"] + [f"c{i}" for i in range(len(columns))]
    raw = _reader(spark, text_names, escape, multiline, line_sep).csv(paths)
    if after is not None:
        raw = raw.where(F.col("c_ts").cast("decimal(20,0)") > F.lit(after).cast("decimal(20,0)"))
    place = _position(F.col("_metadata.file_path"), version)
    placed = raw.select(
        *[_null_rule(_row_end(F.col(t), line_sep) if t == text_names[-1] else F.col(t)).alias(n) for t, n in zip(text_names, names)],
        *place,
        F.col("_metadata.file_block_start").alias("cdc_block"),
        F.monotonically_increasing_id().alias("cdc_row"),
    )
    typed = placed.withColumn("cdc_commit_ts", F.col("cdc_commit_ts").cast("decimal(20,0)"))
    return decode_columns(typed, columns, on_error, keep=ENVELOPE + POSITION)


def to_csv_text(df: DataFrame, tp_of: dict[str, str] | None = None) -> DataFrame:
    """Typed columns as dialect text, null as ``\\N``."""
    types = tp_of or {}
    out = []
    for f in df.schema.fields:
        text = encode_value(F.col(quote(f.name)), types.get(f.name, f.dataType.simpleString()))
        out.append(F.coalesce(text, F.lit(NULL_TEXT)).alias(f.name))
    return df.select(*out)


def _write_parts(spark: SparkSession, text: DataFrame, tmp: str, compression: str) -> list[str]:
    """Write dialect files with Spark; names of the part files, in order."""
    (
        text.write.mode("overwrite")
        .option("sep", ",").option("quote", '"').option("escape", '"').option("quoteAll", True)
        .option("emptyValue", '""').option("lineSep", "\n").option("compression", compression)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(tmp)
    )
    return [n for n in storage.list_names(spark, tmp) if n.startswith("part-")]


def write_snapshot(
    spark: SparkSession, df: DataFrame, root: str, meta: TableMeta, commit_ts: int,
    compression: str = "none", ddl: str | None = None,
) -> None:
    """Export a table as header-less files, plus schema and metadata; again and again, if wanted.

    Spark writes into a folder of its own, named like a data file of the table, and nothing is
    renamed. The metadata file names the folders that count, and is written last.

    ``\\N`` as a text value cannot be told from null in this dialect.
    """
    snap = f"{root}/snapshot"
    db, table = escape_text(meta.db), escape_text(meta.table)
    suffix = ".csv.gz" if compression == "gzip" else ".csv"
    folder = f"{db}.{table}.{uuid.uuid4().hex}{suffix}"
    text = to_csv_text(df.select(*[quote(n) for n in meta.names]))
    _write_parts(spark, text, f"{snap}/{folder}", compression)
    storage.write_text(spark, f"{snap}/{db}-schema-create.sql", f"CREATE DATABASE `{meta.db}`;\n")
    storage.write_text(spark, f"{snap}/{db}.{table}-schema.sql", ddl or create_table_text(meta))
    others = [n for n in _published(spark, root) if not n.startswith(f"{db}.{table}.")]
    data = "".join(f"Data: {n}\n" for n in sorted([*others, folder]))
    # From here on readers take the new folder.
    storage.write_text(spark, f"{snap}/metadata", f"Started dump\nPos: {commit_ts}\n{data}Finished dump\n")
    stem = storage.literal(f"{snap}/{db}.{table}")
    old = [path for p in (f"{stem}.csv*", f"{stem}.*.csv*") for path, _ in storage.glob(spark, p)]
    storage.delete_all(spark, [path for path in old if path.rsplit("/", 1)[-1] != folder])


def _published(spark: SparkSession, root: str) -> list[str]:
    """Folders that the metadata of a snapshot names; none in a snapshot of plain files."""
    path = f"{root}/snapshot/metadata"
    if not storage.exists(spark, path):
        return []
    return [line[6:] for line in storage.read_text(spark, path).splitlines() if line.startswith("Data: ")]


def snapshot_paths(spark: SparkSession, root: str, meta: TableMeta) -> list[tuple[str, int]]:
    """``(path, length)`` of a table's data files: those in the folder that the metadata names, else those named after the table."""
    db, table = escape_text(meta.db), escape_text(meta.table)
    mine = [n for n in _published(spark, root) if n.startswith(f"{db}.{table}.")]
    if mine:
        return storage.glob(spark, storage.literal(f"{root}/snapshot/{mine[-1]}") + "/part-*")
    stem = storage.literal(f"{root}/snapshot/{db}.{table}")
    return [x for p in (f"{stem}.csv", f"{stem}.csv.gz", f"{stem}.*.csv", f"{stem}.*.csv.gz") for x in storage.glob(spark, p)]


def create_table_text(meta: TableMeta) -> str:
    """``CREATE TABLE`` text, one column per line."""
    lines = []
    for c in meta.columns:
        base, _, unsigned = c.tp.partition(" ")
        size = c.precision + ("," + c.scale if c.scale else "")
        keep_size = base in ("decimal", "numeric", "char", "varchar", "binary", "varbinary", "datetime", "timestamp", "time", "bit")
        line = f"  {quote(c.name)} {base}" + (f"({size})" if size and keep_size else "")
        line += f" {unsigned}" if unsigned else ""
        line += "" if c.nullable else " NOT NULL"
        if c.default_kind == "literal":
            line += " DEFAULT '" + (c.default or "").replace("'", "''") + "'"
        elif c.default_kind == "expression":
            line += f" DEFAULT {c.default}"
        lines.append(line)
    lines.append("  PRIMARY KEY (" + ",".join(quote(k) for k in meta.pk) + ")")
    return f"CREATE TABLE {quote(meta.table)} (\n" + ",\n".join(lines) + "\n);\n"


def write_schema_epoch(
    spark: SparkSession, root: str, meta: TableMeta, version: int, query: str = "", action: int = 0,
) -> str:
    """Write the schema file of a table version; returns its path."""
    columns = []
    for c in meta.columns:
        col = {"ColumnName": c.name, "ColumnType": c.tp.upper(), "ColumnNullable": str(c.nullable).lower()}
        if c.precision:
            col["ColumnPrecision"] = c.precision
        if c.scale:
            col["ColumnScale"] = c.scale
        if c.is_pk:
            col["ColumnIsPk"] = "true"
        if c.default is not None:
            col["ColumnDefault"] = c.default
        columns.append(col)
    body = {
        "Schema": meta.db, "Table": meta.table, "TableVersion": version, "Query": query, "Type": action,
        "TableColumnsTotal": str(len(columns)), "TableColumns": columns,
    }
    path = f"{root}/increment/{meta.db}/{meta.table}/meta/schema_{version}_{len(columns):010d}.json"
    storage.write_text(spark, path, json.dumps(body))
    return path


def column_from_schema_file(c) -> ColumnMeta:
    """One column of a parsed schema file."""
    return ColumnMeta(
        c["ColumnName"], c["ColumnType"].lower(), c["ColumnPrecision"] or c["ColumnLength"] or "", c["ColumnScale"] or "",
        (c["ColumnNullable"] or "true") != "false", (c["ColumnIsPk"] or "false") == "true", c["ColumnDefault"],
        "none" if c["ColumnDefault"] is None else "literal",
    )


def write_change_files(
    spark: SparkSession, changes: DataFrame, root: str, meta: TableMeta, version: int, date: str,
    partition: int | None = None, first_index: int = 1, width: int = 15,
) -> int:
    """Write change rows as one stream's numbered files, then its index.

    ``changes`` holds the envelope and the table's columns; returns the newest
    index. Rows of one key must sit in one partition, in commit order.
    """
    stream = f"{root}/increment/{meta.db}/{meta.table}/{version}/" + (f"{partition}/" if partition is not None else "") + date
    tmp = f"{stream}/_tmp_{uuid.uuid4().hex}"
    text = to_csv_text(changes.select(*[quote(n) for n in ENVELOPE + meta.names]))
    parts = _write_parts(spark, text, tmp, "none")
    last = first_index - 1 + len(parts)
    storage.move_all(spark, [(f"{tmp}/{name}", f"{stream}/CDC{first_index + i:0{width}d}.csv") for i, name in enumerate(parts)])
    storage.delete(spark, tmp)
    if last >= first_index:
        # The index follows the files it makes visible.
        storage.write_text(spark, f"{stream}/meta/CDC.index", f"CDC{last:0{width}d}.csv\n")
    return last


def write_checkpoint(spark: SparkSession, root: str, checkpoint_ts: int) -> None:
    """Publish the global checkpoint, after all files below it are visible."""
    storage.write_text(spark, f"{root}/increment/metadata", json.dumps({"checkpoint-ts": checkpoint_ts}))
