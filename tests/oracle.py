"""Compare a query with its SQL equivalent, without regard to row order."""

import glob
import math
import os

import duckdb
import pyarrow as pa

KINDS = {"int": "int", "uint": "int", "float": "float", "double": "float", "string": "str", "large_string": "str",
         "bool": "bool", "timestamp": "ts", "decimal128": "dec", "date32": "date", "binary": "bin"}


def kind(t: pa.DataType) -> str:
    name = str(t).split("[")[0].split("(")[0].rstrip("0123456789") or str(t)
    return KINDS.get(name, KINDS.get(str(t).split("(")[0], str(t)))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def rows(t: pa.Table):
    t = t.select(sorted(t.column_names))
    out = []
    for row in zip(*[c.to_pylist() for c in t.columns]):
        out.append(tuple("NaN" if isinstance(v, float) and math.isnan(v) else v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v for v in row))
    return sorted(out, key=repr)


def compare(spark, con, sf_dir, query, sql):
    got = query(spark, sf_dir).toArrow()
    want = con.sql(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    for n in got.column_names:
        assert kind(got.schema.field(n).type) == kind(want.schema.field(n).type), (n, got.schema.field(n).type, want.schema.field(n).type)
        assert kind(got.schema.field(n).type) != "dec", n
    a, b = rows(got), rows(want)
    assert len(a) == len(b), (len(a), len(b))
    assert len(a) > 0
    for x, y in zip(a, b):
        assert x == y, (sorted(got.column_names), x, y)
