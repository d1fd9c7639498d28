"""Scratch tables, input columns and Arrow batches shared by the operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands for a null id inside operators: it sorts after every other id.
NO_ID = 2**63 - 1

#: Texts of a batch are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared folder of the session. Where the session names none, one is set if all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends here, and a lost executor loses nothing."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_value(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text) go on, so that other columns never clash; a null text is an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


#: What a worker keeps between tasks, by operator, and how to let go of it.
_kept: dict[str, Callable[[], None]] = {}


def working(operator: str, release: Callable[[], None] | None = None) -> None:
    """Called at a task's begin: a worker is reused by other operators' tasks, and what those keep goes first."""
    for other, let_go in list(_kept.items()):
        if other != operator:
            let_go()
            del _kept[other]
    if release is not None:
        _kept[operator] = release


def small_batches(spark: SparkSession, rows: int = 400) -> None:
    """Long texts need small Arrow batches; a smaller setting of the user stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text begins (one more entry than texts)."""
    column = pc.fill_null(column, "").cast(pa.large_utf8())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def with_row(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of a row in one struct beside the named ones, so that none clashes."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *(v.alias(k) for k, v in columns.items()))


def row_schema(docs: DataFrame, rest: str) -> T.StructType:
    """Schema of the struct that ``with_row`` makes, and more columns."""
    return T.StructType([T.StructField("row", docs.schema), *T.StructType.fromDDL(rest).fields])
