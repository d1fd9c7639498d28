"""Names, timestamps, types and redaction over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.functions import names
from cdclake.functions.redact import redact_json, redact_text
from cdclake.functions.types import SPARK_TYPES, type_map
from checks.common import table


def _odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with characters that need escaping, from part names."""
    k = F.col("p_partkey")
    name = (
        F.when(k % 4 == 0, F.concat("p_name", F.lit("-schema.")))
        .when(k % 4 == 1, F.concat(F.lit("a%2E*"), "p_name"))
        .when(k % 4 == 2, F.concat("p_name", F.lit('/"?\\|<:>+')))
        .otherwise(F.replace("p_name", F.lit(" "), F.lit("_"))))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


def q_name_escape(spark, sf_dir):
    df = _odd_names(spark, sf_dir).withColumn("escaped", names.escape_name(F.col("name")))
    return df.withColumn("same", names.unescape_name(F.col("escaped")) == F.col("name"))


def q_ident_normalize(spark, sf_dir):
    return _odd_names(spark, sf_dir).select("p_partkey", names.fold_ident(F.col("name")).alias("ident"))


def q_tso_to_ts(spark, sf_dir):
    ts = F.col("o_orderkey") * 262144 * 1000 + F.lit(466924115091783691)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(names.commit_time(ts.cast("decimal(20,0)")), "yyyy-MM-dd HH:mm:ss.SSS").alias("at"))


_TYPES = [*SPARK_TYPES, "decimal", "NUMERIC unsigned"]


def q_type_map(spark, sf_dir):
    """A catalog with one column per order, over all source types."""
    k = F.col("o_orderkey")
    tp = F.element_at(F.array(*[F.lit(t) for t in _TYPES]), (k % len(_TYPES) + 1).cast("int"))
    cols = table(spark, sf_dir, "orders").select("o_orderkey", tp.alias("tp"), (k % 60 + 5).cast("string").alias("precision"), F.when(k % 2 == 0, "3").otherwise("").alias("scale"))
    return type_map(cols)


def q_redact_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", redact_text(F.col("text")).alias("text"))


def _page_text(spark, sf_dir):
    """Page URLs with user information and secrets put in, also in a URL within a query, then the whole page."""
    p = F.col("page_id").cast("string")
    inner = F.url_encode(F.concat(F.lit("https://in.example/?next="), F.url_encode(F.concat(F.lit("http://x/?my_token=k"), p)), F.lit("&n="), p))
    secret = F.concat(
        F.lit("GET "), F.regexp_replace("url", "://", "://user:pw@"), F.lit(" AND https://h.example/x?API-Key=k"), p, F.lit("&ok="), p,
        F.lit("&to="), inner,
        F.lit('#top password="p '), p, F.lit('" tokens=1 X-Api-Key: abc'), p, F.lit(";\n"), "html")
    return table(spark, sf_dir, "pages").select("page_id", secret.alias("text"))


def q_redact_pages(spark, sf_dir):
    return _page_text(spark, sf_dir).select("page_id", redact_text(F.col("text")).alias("text"))


#: Levels of objects around the event's properties.
DEPTH = 12


def q_redact_props(spark, sf_dir):
    """Event properties, with secrets put in: at many levels, beside repeated keys, and under keys with escapes."""
    e = F.col("event_id").cast("string")
    inner = F.concat(
        F.lit('{"props": '), "props", F.lit(', "Access_Token": "t'), e, F.lit('", "list": [1, {"pass-word": "x"}, {"PassWd": {"a": '), e,
        F.lit('}}, "cookie: c'), e, F.lit('"], "note": "user '), "event_type", F.lit(' password=p'), e, F.lit('", "k": 1, "k": 2, "tok\\nen": "x'), e, F.lit('"}'))
    props = F.when(F.col("event_id") % 3 == 0, F.col("props")).otherwise(F.concat(F.lit('{"in": ' * DEPTH), inner, F.lit("}" * DEPTH)))
    return table(spark, sf_dir, "events").select("event_id", redact_json(props).alias("props"))


QUERIES = {
    "name_escape": q_name_escape,
    "ident_normalize": q_ident_normalize,
    "tso_to_ts": q_tso_to_ts,
    "type_map": q_type_map,
    "redact_text": q_redact_text,
    "redact_pages": q_redact_pages,
    "redact_props": q_redact_props,
}

_ODD = r"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || '-schema.' WHEN 1 THEN 'a%2E*' || p_name
             WHEN 2 THEN p_name || '/"?\|<:>+' ELSE replace(p_name, ' ', '_') END AS name FROM part"""


def _escape_sql(expr: str) -> str:
    out = f"replace({expr}, '%', '%25')"
    out = f"replace({out}, '-schema', '%2Dschema')"
    for ch in '"*./:<>?\\|':
        out = f"replace({out}, '{ch}', '%{ord(ch):02X}')"
    return out


#: The only secrets in the given documents; pages have none.
_TOKENS = "regexp_replace(text, '(token = )\"[0-9a-f]{40}\"', '\\1<redacted>', 'gi')"
_types_sql = "CASE o_orderkey % {n} ".format(n=len(_TYPES)) + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TYPES)) + " END"
_spark_sql = "CASE o_orderkey % {n} ".format(n=len(_TYPES)) + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(SPARK_TYPES.values())) + (
    " ELSE CASE WHEN o_orderkey % 60 + 5 > 38 THEN 'string' ELSE 'decimal(' || (o_orderkey % 60 + 5) || ',' || CASE WHEN o_orderkey % 2 = 0 THEN '3' ELSE '0' END || ')' END END")

ORACLES = {
    "name_escape": f"SELECT p_partkey, name, {_escape_sql('name')} AS escaped, true AS same FROM ({_ODD})",
    "ident_normalize": f"SELECT p_partkey, CASE WHEN regexp_full_match(name, '[A-Za-z_][A-Za-z0-9_$]*') THEN upper(name) ELSE name END AS ident FROM ({_ODD})",
    "tso_to_ts": """
        SELECT o_orderkey, strftime(epoch_ms((o_orderkey * 262144000 + 466924115091783691) >> 18), '%Y-%m-%d %H:%M:%S.%g') AS at FROM orders""",
    "type_map": f"""
        SELECT o_orderkey, {_types_sql} AS tp, CAST(o_orderkey % 60 + 5 AS VARCHAR) AS precision,
               CASE WHEN o_orderkey % 2 = 0 THEN '3' ELSE '' END AS scale, {_spark_sql} AS spark_type FROM orders""",
    "redact_text": f"SELECT doc_id, {_TOKENS} AS text FROM documents",
    "redact_pages": """
        SELECT page_id, 'GET ' || replace(url, '://', '://%3Credacted%3E@') || ' AND https://h.example/x?API-Key=<redacted>&ok=' || page_id
               || '&to=https%3A%2F%2Fin.example%2F%3Fnext%3Dhttp%253A%252F%252Fx%252F%253Fmy_token%253D%25253Credacted%25253E%26n%3D' || page_id
               || '#top password=<redacted> tokens=1 X-Api-Key: <redacted>;' || chr(10) || html AS text FROM pages""",
    "redact_props": f"""
        SELECT event_id, CASE WHEN event_id % 3 = 0 THEN replace(props, ' ', '') ELSE '{'{"in":' * DEPTH}' ||
          '{{"Access_Token":"<redacted>","k":2,"list":[1,{{"pass-word":"<redacted>"}},{{"PassWd":"<redacted>"}},"cookie: <redacted>"],"note":"user '
          || event_type || ' password=<redacted>","props":' || replace(props, ' ', '') || ',"tok\\nen":"<redacted>"}}' || '{"}" * DEPTH}' END AS props FROM events""",
}
