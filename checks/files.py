"""Snapshot and change files: written from the tables, read back, decoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.types import ColumnMeta, TableMeta, decode_columns, encode_value
from cdclake.sources import csvio, storage
from checks.common import CHECKPOINT, ORDER_CHANGES_SQL, ORDER_COLUMNS, ORDERS_META, order_changes, table

CUSTOMER_META = TableMeta(
    "shop.eu", "customer",
    (
        ColumnMeta("c_custkey", "bigint", nullable=False, is_pk=True),
        ColumnMeta("c_name", "varchar", "25"),
        ColumnMeta("c_nationkey", "int"),
        ColumnMeta("c_acctbal", "double"),
        ColumnMeta("c_mktsegment", "enum"),
    ),
    ("c_custkey",),
)

DOCUMENTS_META = TableMeta(
    "web", "documents",
    (
        ColumnMeta("doc_id", "bigint", nullable=False, is_pk=True),
        ColumnMeta("text", "longtext"),
        ColumnMeta("lang", "char", "2"),
        ColumnMeta("source", "varchar", "64"),
        ColumnMeta("n_chars", "bigint"),
    ),
    ("doc_id",),
)


def q_snapshot_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = storage.scratch_dir(spark)
    csvio.write_snapshot(spark, table(spark, sf_dir, "customer"), root, CUSTOMER_META, 1, "gzip")
    return csvio.read_snapshot(spark, f"{root}/snapshot/shop%2Eeu.customer.*.csv.gz", CUSTOMER_META, line_sep="\n")


def q_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text with quotes, commas and line breaks through the CSV dialect."""
    root = storage.scratch_dir(spark)
    csvio.write_snapshot(spark, table(spark, sf_dir, "documents"), root, DOCUMENTS_META, 1)
    return csvio.read_snapshot(spark, f"{root}/snapshot/web.documents.*.csv", DOCUMENTS_META, line_sep="\n")


def change_source(spark: SparkSession, sf_dir: str) -> str:
    root = storage.scratch_dir(spark)
    csvio.write_change_files(spark, order_changes(table(spark, sf_dir, "orders")), root, ORDERS_META, 100, "2026-07-01")
    return root


def q_cdc_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned_changes(spark, change_source(spark, sf_dir))


def scanned_changes(spark: SparkSession, root: str) -> DataFrame:
    rows = csvio.read_changes(spark, f"{root}/increment/shop/orders/100/2026-07-01/CDC*.csv", list(ORDERS_META.columns), line_sep="\n", after=CHECKPOINT)
    return rows.select(
        F.col("cdc_flag").alias("flag"), F.col("cdc_commit_ts").cast("bigint").alias("ts"),
        F.col("cdc_version").cast("bigint").alias("version"), "cdc_date", *ORDER_COLUMNS,
    )


TYPED = [
    ColumnMeta("k", "bigint unsigned"),
    ColumnMeta("t", "tinyint"),
    ColumnMeta("d", "decimal", "12", "2"),
    ColumnMeta("f", "double"),
    ColumnMeta("b", "bool"),
    ColumnMeta("day", "date"),
    ColumnMeta("at", "datetime", "6"),
    ColumnMeta("utc", "timestamp", "6"),
    ColumnMeta("tm", "time", "6"),
    ColumnMeta("bin", "varbinary", "64"),
]


def q_typed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of many types decoded; texts that do not fit are reported."""
    k = F.col("o_orderkey")
    text = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("1844674407370"), F.lpad((k % 10_000).cast("string"), 7, "0")).alias("k"),
        (k % 200).cast("string").alias("t"),
        F.concat((k % 1000).cast("string"), F.lit("."), F.lpad((k % 100).cast("string"), 2, "0")).alias("d"),
        F.col("o_totalprice").cast("string").alias("f"),
        F.when(k % 3 == 0, "1").when(k % 3 == 1, "0").alias("b"),
        F.when(k % 50 == 0, "1999-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("utc"),
        F.concat((k % 800 + 10).cast("string"), F.lit(":00:01.5")).alias("tm"),
        F.hex("o_orderpriority").alias("bin"),
        k.cast("string").alias("o_orderkey"),
    )
    out = decode_columns(text, [*TYPED, ColumnMeta("o_orderkey", "bigint")], on_error="report")
    return out.select(
        "o_orderkey",
        F.col("k").cast("string").alias("k"),
        F.col("t").cast("string").alias("t"),
        F.col("d").cast("string").alias("d"),
        "f", F.col("b").cast("string").alias("b"),
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.date_format("utc", "yyyy-MM-dd HH:mm:ss").alias("utc"),
        encode_value(F.col("tm"), "interval hour to second").alias("tm"),
        F.col("bin").cast("string").alias("bin"),
        F.array_join("decode_errors", ",").alias("errors"),
    )


#: Line ends within values, and how the last field of a row is written, with its value.
_INNER = ["\r", "\n", "\r\n", "", "\n\r"]
_LAST = [('"{v}"', "v"), ("{v}", "v"), ("\\N", None), ('"\\N"', None), ('""', ""), ("", "")]


def q_csv_line_ends(spark, sf_dir):
    """A row per customer in files of either row end, with every kind of line end in values and of last field."""
    k, name = F.col("c_custkey"), F.col("c_name")
    pick = lambda of, by: F.element_at(F.array(*[F.lit(x) for x in of]), (by % len(of) + 1).cast("int"))
    line = F.concat(k.cast("string"), F.lit(',"a'), pick(_INNER, k), name, F.lit('",'), F.replace(pick([x for x, _ in _LAST], F.floor(k / 5)), F.lit("{v}"), name))
    parts = []
    for label, end in (("lf", "\n"), ("crlf", "\r\n")):
        root = f"{storage.scratch_dir(spark)}/{label}"
        table(spark, sf_dir, "customer").select(line.alias("value")).write.option("lineSep", end).text(root)
        parts.append(csvio.read_csv_text(spark, root, ["k", "v", "last"], line_sep=end).withColumn("rows_end", F.lit(label)))
    return parts[0].unionByName(parts[1])


QUERIES = {
    "snapshot_csv_scan": q_snapshot_csv_scan,
    "export_roundtrip": q_export_roundtrip,
    "cdc_csv_scan": q_cdc_csv_scan,
    "typed_decode": q_typed_decode,
    "csv_line_ends": q_csv_line_ends,
}

ORACLES = {
    "csv_line_ends": """
        SELECT CAST(c_custkey AS VARCHAR) AS k, 'a' || CASE c_custkey % 5 WHEN 0 THEN chr(13) WHEN 1 THEN chr(10) WHEN 2 THEN chr(13) || chr(10) WHEN 3 THEN '' ELSE chr(10) || chr(13) END || c_name AS v,
               CASE WHEN (c_custkey // 5) % 6 IN (0, 1) THEN c_name WHEN (c_custkey // 5) % 6 IN (4, 5) THEN '' END AS last, rows_end
        FROM customer, (VALUES ('lf'), ('crlf')) e(rows_end)""",
    "snapshot_csv_scan": "SELECT * FROM customer",
    "export_roundtrip": "SELECT * FROM documents",
    "cdc_csv_scan": f"""
        WITH ch AS ({ORDER_CHANGES_SQL})
        SELECT flag, ts, CAST(100 AS BIGINT) AS version, '2026-07-01' AS cdc_date, {', '.join(ORDER_COLUMNS)}
        FROM ch WHERE ts > {CHECKPOINT}""",
    "typed_decode": """
        SELECT o_orderkey,
               '1844674407370' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 7, '0') AS k,
               CASE WHEN o_orderkey % 200 < 128 THEN CAST(o_orderkey % 200 AS VARCHAR) END AS t,
               (o_orderkey % 1000) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS d,
               o_totalprice AS f,
               CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS b,
               CASE WHEN o_orderkey % 50 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS at,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS utc,
               (o_orderkey % 800 + 10) || ':00:01.5' AS tm,
               o_orderpriority AS bin,
               concat_ws(',', CASE WHEN o_orderkey % 200 >= 128 THEN 't' END,
                              CASE WHEN o_orderkey % 50 = 0 THEN 'day' END) AS errors
        FROM orders""",
}
