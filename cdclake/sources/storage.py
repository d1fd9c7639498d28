"""Small files and renames through the Hadoop file system of the session.

Only metadata of bounded size passes here; rows are read and written by Spark.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small metadata file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small metadata file, replacing what is there."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def literal(path: str) -> str:
    """A path for readers that take patterns, in which every character stands for itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly under ``path``; empty when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """``(path, length)`` of everything a glob pattern matches."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return [] if found is None else [(s.getPath().toString(), s.getLen()) for s in found]


def count(spark: SparkSession, pattern: str) -> int:
    """How many files and folders a glob pattern matches; none of them comes here."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return 0 if found is None else len(found)


def move(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs(spark, src)
    d = spark._jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"cannot rename {src} to {dst}")


def move_all(spark: SparkSession, pairs: list[tuple[str, str]], parallel: int = 32) -> None:
    """Rename many files side by side."""
    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(lambda p: move(spark, *p), pairs))


def delete_all(spark: SparkSession, paths: list[str], parallel: int = 32) -> None:
    """Delete many files or folders side by side."""
    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(lambda p: delete(spark, p), paths))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder, which the session must name."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/cdclake-{uuid.uuid4().hex}"
