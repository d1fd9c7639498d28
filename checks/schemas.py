"""Catalog operators over file names and file contents derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions.names import escape_name
from cdclake.sources import catalog
from checks.common import table


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing: data files, schema files and others, named after customers."""
    k = F.col("c_custkey")
    stem = F.concat(escape_name(F.concat(F.lit("s."), F.lower("c_mktsegment"))), F.lit("."), escape_name(F.col("c_name")))
    name = (
        F.when(k % 5 == 0, F.concat(stem, F.lit(".000001.csv.gz")))
        .when(k % 5 == 1, F.concat(stem, F.lit(".000001.csv")))
        .when(k % 5 == 2, F.concat(stem, F.lit("-schema.sql")))
        .when(k % 5 == 3, F.concat(escape_name(F.concat(F.lit("s."), F.lower("c_mktsegment"))), F.lit("-schema-create.sql")))
        .otherwise("notes.csv"))
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("s3://b/snapshot/"), name).alias("path"), k.alias("length"))


def _configured(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_nationkey < 20").select(
        F.concat(F.lit("s."), F.lower("c_mktsegment")).alias("db"), F.col("c_name").alias("table"))


def q_snapshot_files(spark, sf_dir):
    return catalog.snapshot_files(_files(spark, sf_dir), _configured(spark, sf_dir)).select("db", "table", "length", "gzip")


def q_snapshot_databases(spark, sf_dir):
    return catalog.snapshot_databases(_files(spark, sf_dir), _configured(spark, sf_dir))


def q_snapshot_tso(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    texts = table(spark, sf_dir, "orders").select(k.alias("path"), F.concat(
        F.lit("Started dump at: x\nSHOW MASTER STATUS:\n\tLog: l\n\tPos: 4669241150"), k, F.lit(" \n\tGTID:\nFinished")).alias("text"))
    return catalog.snapshot_commit_ts(texts).select("path", F.col("commit_ts").cast("bigint").alias("commit_ts"))


def q_cdc_checkpoint(spark, sf_dir):
    k = F.col("o_orderkey").cast("string")
    texts = table(spark, sf_dir, "orders").select(k.alias("path"), F.concat(F.lit('{"checkpoint-ts":4669241150'), k, F.lit("}")).alias("text"))
    return catalog.checkpoint_of(texts).select("path", F.col("checkpoint_ts").cast("bigint").alias("checkpoint_ts"))


def _ddl_texts(spark, sf_dir):
    """One CREATE TABLE text per part."""
    k = F.col("p_partkey")
    text = F.concat(
        F.lit("-- exported\nCREATE TABLE `t"), k.cast("string"), F.lit("` (\n  `id` bigint"),
        F.when(k % 2 == 0, " unsigned").otherwise(""), F.lit(" NOT NULL,\n  `n` varchar("), F.col("p_size").cast("string"),
        F.lit(") DEFAULT '"), F.col("p_type"), F.lit("' COMMENT 'x, PRIMARY KEY (`n`)',\n  `price` decimal(12,2) DEFAULT NULL,\n  `at` datetime(3) DEFAULT CURRENT_TIMESTAMP(3),\n"),
        F.when(k % 3 == 0, "  `dear` double GENERATED ALWAYS AS (`price` * 1.19) VIRTUAL,\n").otherwise(""),
        F.when(k % 7 == 0, "  `tag` char(3) GENERATED ALWAYS AS (left(`n`, 3)) STORED NOT NULL,\n").otherwise(""),
        F.when(k % 5 == 0, "  KEY `k` (`n`)\n").otherwise("  PRIMARY KEY (`n`,`id`)\n"), F.lit(") ENGINE=InnoDB;\n"))
    # In three layouts: a column per line, all in one line, several per line.
    text = F.when(k % 11 == 0, F.replace(F.replace(text, F.lit("-- exported\n"), F.lit("")), F.lit("\n"), F.lit(" "))).when(k % 11 == 1, F.replace(text, F.lit(",\n  `price`"), F.lit(", `price`"))).otherwise(text)
    return table(spark, sf_dir, "part").select(F.lit("shop").alias("db"), F.concat(F.lit("t"), k.cast("string")).alias("table"), text.alias("text"))


def q_ddl_columns(spark, sf_dir):
    return catalog.ddl_columns(_ddl_texts(spark, sf_dir)).select(
        "db", "table", "name", "tp", "precision", "scale", "nullable", "is_pk", F.coalesce("default_value", F.lit("-")).alias("default_value"), "default_kind")


def q_pk_admission(spark, sf_dir):
    return catalog.pk_admission(catalog.ddl_columns(_ddl_texts(spark, sf_dir)))


def q_generated_columns(spark, sf_dir):
    return catalog.generated_report(_ddl_texts(spark, sf_dir))


def _schema_texts(spark, sf_dir):
    """One schema file per order, two or three columns each."""
    k = F.col("o_orderkey").cast("string")
    third = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(',{"ColumnName":"c'), k, F.lit('","ColumnType":"INT UNSIGNED","ColumnDefault":7}'))).otherwise("")
    text = F.concat(
        F.lit('{"Schema":"db","Table":"t","Version":1,"TableVersion":'), k, F.lit(',"Query":"ALTER TABLE t ADD COLUMN c'), k,
        F.lit(' INT","Type":5,"TableColumns":[{"ColumnName":"id","ColumnType":"BIGINT","ColumnNullable":"false","ColumnIsPk":"true"},'
              '{"ColumnName":"d","ColumnType":"DECIMAL","ColumnPrecision":"12","ColumnScale":"2"}'), third, F.lit("]}"))
    path = F.concat(F.lit("s3://b/increment/db/t/meta/schema_"), k, F.lit("_0123456789.json"))
    return table(spark, sf_dir, "orders").select(path.alias("path"), text.alias("text"))


def q_schema_epochs(spark, sf_dir):
    cols = catalog.epoch_columns(catalog.schema_epochs(_schema_texts(spark, sf_dir)))
    return cols.select("db", "table", F.col("version").cast("bigint").alias("version"), "ordinal", "name", "tp", "precision", "scale", "nullable", "is_pk",
                       F.coalesce("default_value", F.lit("-")).alias("default_value"))


QUERIES = {
    "snapshot_files": q_snapshot_files,
    "snapshot_databases": q_snapshot_databases,
    "snapshot_tso": q_snapshot_tso,
    "cdc_checkpoint": q_cdc_checkpoint,
    "ddl_columns": q_ddl_columns,
    "pk_admission": q_pk_admission,
    "generated_columns": q_generated_columns,
    "schema_epochs": q_schema_epochs,
}

_DDL_SQL = """
  SELECT 'shop' AS db, 't' || p_partkey AS "table", * EXCLUDE (keep) FROM part, LATERAL (VALUES
    ('id', CASE WHEN p_partkey % 2 = 0 THEN 'bigint unsigned' ELSE 'bigint' END, '', '', false, p_partkey % 5 <> 0, '-', 'none', ''),
    ('n', 'varchar', CAST(p_size AS VARCHAR), '', p_partkey % 5 = 0, p_partkey % 5 <> 0, p_type, 'literal', ''),
    ('price', 'decimal', '12', '2', true, false, '-', 'none', ''),
    ('at', 'datetime', '3', '', true, false, 'CURRENT_TIMESTAMP(3)', 'expression', ''),
    ('dear', 'double', '', '', true, false, '-', 'none', CASE WHEN p_partkey % 3 = 0 THEN 'virtual' END),
    ('tag', 'char', '3', '', false, false, '-', 'none', CASE WHEN p_partkey % 7 = 0 THEN 'stored' END)
  ) c(name, tp, precision, scale, nullable, is_pk, default_value, default_kind, generated), (SELECT 1 AS keep)
  WHERE generated IS NOT NULL"""

ORACLES = {
    "snapshot_files": """
        SELECT 's.' || lower(c_mktsegment) AS db, c_name AS "table", c_custkey AS length, c_custkey % 5 = 0 AS gzip
        FROM customer WHERE c_custkey % 5 < 2 AND c_nationkey < 20""",
    "snapshot_databases": """
        SELECT DISTINCT 's.' || lower(c_mktsegment) AS db FROM customer WHERE c_custkey % 5 = 3
          AND c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_nationkey < 20)""",
    "snapshot_tso": "SELECT CAST(o_orderkey AS VARCHAR) AS path, CAST('4669241150' || o_orderkey AS BIGINT) AS commit_ts FROM orders",
    "cdc_checkpoint": "SELECT CAST(o_orderkey AS VARCHAR) AS path, CAST('4669241150' || o_orderkey AS BIGINT) AS checkpoint_ts FROM orders",
    "ddl_columns": f"""
        SELECT db, "table", name, tp, precision, scale, nullable, is_pk, default_value, default_kind FROM ({_DDL_SQL}) WHERE generated = ''""",
    "pk_admission": f"""
        SELECT db, "table", count(*) FILTER (is_pk) AS n_pk, count(*) FILTER (is_pk) > 0 AS admitted FROM ({_DDL_SQL}) WHERE generated = '' GROUP BY ALL""",
    "generated_columns": f"""
        SELECT db, "table", count(*) FILTER (generated = 'virtual') AS n_virtual, count(*) FILTER (generated = 'stored') AS n_stored,
               count(*) FILTER (generated = '') AS n_plain, count(*) FILTER (generated = 'stored') = 0 AS incremental_ok
        FROM ({_DDL_SQL}) GROUP BY ALL""",
    "schema_epochs": """
        SELECT 'db' AS db, 't' AS "table", o_orderkey AS version, CAST(ordinal AS BIGINT) AS ordinal,
               CASE WHEN name = 'c' THEN 'c' || o_orderkey ELSE name END AS name, tp, precision, scale, nullable, is_pk, default_value
        FROM orders, (VALUES (0, 'id', 'bigint', '', '', false, true, '-'), (1, 'd', 'decimal', '12', '2', true, false, '-'),
                             (2, 'c', 'int unsigned', '', '', true, false, '7')) c(ordinal, name, tp, precision, scale, nullable, is_pk, default_value)
        WHERE ordinal < 2 OR o_orderkey % 2 = 0""",
}
