"""Value round trip of every source type through the file dialect."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdclake.functions import types as ty
from cdclake.functions.types import ColumnMeta, TableMeta
from cdclake.sources import csvio, storage

MATRIX = TableMeta("m", "types", (
    ColumnMeta("id", "bigint", nullable=False, is_pk=True),
    ColumnMeta("c_boolean", "bool"),
    ColumnMeta("c_tinyint", "tinyint"), ColumnMeta("c_tinyint_u", "tinyint unsigned"),
    ColumnMeta("c_smallint", "smallint"), ColumnMeta("c_smallint_u", "smallint unsigned"),
    ColumnMeta("c_mediumint", "mediumint"), ColumnMeta("c_mediumint_u", "mediumint unsigned"),
    ColumnMeta("c_int", "int"), ColumnMeta("c_int_u", "int unsigned"),
    ColumnMeta("c_bigint", "bigint"), ColumnMeta("c_bigint_u", "bigint unsigned"),
    ColumnMeta("c_decimal", "decimal", "10", "0"), ColumnMeta("c_decimal_38_30", "decimal", "38", "30"),
    ColumnMeta("c_numeric", "numeric", "30", "10"), ColumnMeta("c_decimal_65", "decimal unsigned", "65", "30"),
    ColumnMeta("c_float", "float"), ColumnMeta("c_double", "double"),
    ColumnMeta("c_date", "date"), ColumnMeta("c_datetime", "datetime", "6"), ColumnMeta("c_timestamp", "timestamp", "6"),
    ColumnMeta("c_time", "time", "6"), ColumnMeta("c_year", "year"), ColumnMeta("c_bit", "bit", "12"),
    ColumnMeta("c_char", "char", "16"), ColumnMeta("c_varchar", "varchar", "255"), ColumnMeta("c_longtext", "longtext"),
    ColumnMeta("c_enum", "enum"), ColumnMeta("c_set", "set"), ColumnMeta("c_json", "json"), ColumnMeta("c_vector", "vector"),
    ColumnMeta("c_binary", "binary", "16"), ColumnMeta("c_blob", "blob", "65535"),
), ("id",))

# One text per column; \N is null and an empty field an empty text.
ROWS = [
    ["1", "1", "-9", "201", "-20202", "50505", "-700007", "15000051", "-2000000002", "3000000003", "-4000000000000000004",
     "18446744073709551615", "1234567890", "12345678.123456789012345678901234567890", "12345678901234567890.1234567890", "7" * 35 + "." + "1" * 30,
     "3.14", "2.718281828459045", "2026-06-04", "2026-06-04 12:34:56.123456", "2026-06-04 12:34:56.123456", "23:59:59.123456", "2026", "7",
     "char-value", "varchar \"quoted\", with comma", "long\ntext \\ with backslash", "medium", "a,b", '{"k": "v"}', "[0.1,0.2,0.3]",
     "00112233445566778899AABBCCDDEEFF", "0203"],
    ["2"] + ["\\N"] * 23 + ["", "", "", "\\N", "\\N", "\\N", "\\N", "00" * 16, ""],
    ["3", "0", "-128", "0", "-32768", "0", "-8388608", "0", "-2147483648", "0", "-9223372036854775808", "0", "-9999999999",
     "-99999999." + "9" * 30, "-99999999999999999999.9999999999", "0", "-3.402823466E38", "-1.7976931348623157E308", "1000-01-01",
     "1000-01-01 00:00:00.000001", "1970-01-01 00:00:02.000001", "-838:59:59", "1970", "0", " " * 16, "row", "x", "small", "", "null", "[1,2,3]", "FF" * 16, "CAFEBABE"],
    ["4", "1", "127", "255", "32767", "65535", "8388607", "16777215", "2147483647", "4294967295", "9223372036854775807", "18446744073709551615",
     "9999999999", "99999999." + "9" * 30, "99999999999999999999.9999999999", "9" * 35, "3.402823466E38", "1.7976931348623157E308", "9999-12-31",
     "9999-12-31 23:59:59.999999", "2038-01-19 03:14:07.999999", "838:59:58.999999", "2155", "4095", "1234567890abcdef", "x" * 255, "l" * 1024, "large",
     "a", "[]", "[-0.5,0,0.5]", "FF" * 16, "FF" * 1024],
]


def decoded(spark, on_error="raise"):
    df = spark.createDataFrame([[None if v == "\\N" else v for v in r] for r in ROWS], ", ".join(f"{n} string" for n in MATRIX.names))
    return ty.decode_columns(df, list(MATRIX.columns), on_error)


def test_values(spark):
    df = decoded(spark).select("*", ty.encode_value(F.col("c_time"), "interval hour to second").alias("time_text")).drop("c_time")
    r1, r2, r3, r4 = df.orderBy("id").collect()
    assert r1["c_boolean"] is True and r1["c_bigint_u"] == Decimal(18446744073709551615)
    assert r1["c_decimal_38_30"] == Decimal("12345678.123456789012345678901234567890")
    assert r1["c_decimal_65"] == "7" * 35 + "." + "1" * 30
    assert r1["c_datetime"] == dt.datetime(2026, 6, 4, 12, 34, 56, 123456) and r1["c_date"] == dt.date(2026, 6, 4)
    assert bytes(r1["c_binary"]).hex() == "00112233445566778899aabbccddeeff"
    assert all(r2[c] is None for c in ("c_boolean", "c_int", "c_double", "c_date", "c_timestamp", "c_enum", "c_vector", "time_text"))
    assert (r2["c_char"], r2["c_longtext"], bytes(r2["c_blob"])) == ("", "", b"")
    assert (r3["c_tinyint"], r3["c_bigint"], r3["c_char"], r3["time_text"]) == (-128, -9223372036854775808, " " * 16, "-838:59:59")
    assert (r4["c_tinyint_u"], r4["c_int_u"], r4["c_year"], r4["time_text"]) == (255, 4294967295, 2155, "838:59:58.999999")
    assert r4["c_datetime"] == dt.datetime(9999, 12, 31, 23, 59, 59, 999999) and len(r4["c_blob"]) == 1024


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_file_round_trip(spark, compression):
    df = decoded(spark)
    root = storage.scratch_dir(spark)
    csvio.write_snapshot(spark, df, root, MATRIX, 5, compression)
    back = csvio.read_snapshot(spark, f"{root}/snapshot/m.types.*.csv*", MATRIX, line_sep="\n")
    text = lambda d: sorted(map(repr, d.withColumn("c_time", F.col("c_time").cast("string")).collect()))
    assert back.dtypes == df.dtypes and text(back) == text(df)


def test_session_zone_has_no_say(spark):
    df = spark.createDataFrame([("2026-06-04 12:34:56",)], "t string")
    read = lambda: ty.decode_columns(df, [ColumnMeta("t", "timestamp", "6")]).select(F.unix_seconds("t"), ty.encode_value(F.col("t"), "timestamp")).first()
    want = tuple(read())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(read()) == want == (1780576496, "2026-06-04 12:34:56")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_text_is_never_silently_null(spark):
    cols = [ColumnMeta("a", "tinyint"), ColumnMeta("b", "blob", "65535"), ColumnMeta("c", "date")]
    df = spark.createDataFrame([("128", "xyz", "2026-02-30"), ("1", "00", None)], "a string, b string, c string")
    assert [r["decode_errors"] for r in ty.decode_columns(df, cols, "report").collect()] == [["a", "b", "c"], []]
    with pytest.raises(Exception, match="column a: not a tinyint: 128"):
        ty.decode_columns(df.select("a"), cols[:1]).collect()


def test_type_names(spark):
    assert ty.spark_type("DECIMAL", 39, 0) == "string" and ty.spark_type("decimal", "", "") == "decimal(10,0)"
    with pytest.raises(ValueError, match="unsupported source type"):
        ty.spark_type("geometry")
    with pytest.raises(Exception, match="unsupported source type geometry"):
        ty.type_map(spark.createDataFrame([("geometry", "", "")], "tp string, precision string, scale string")).collect()
    assert ty.lossless("int", "decimal(10,0)") and not ty.lossless("int", "decimal(9,0)") and not ty.lossless("string", "int")


def test_csv_contract(spark):
    root = storage.scratch_dir(spark)
    storage.write_text(spark, f"{root}/a.csv", 'x,,"",\\N,"say ""hi"""\r\n"multi\nline",b,c,"\\N",\\t\r\n')
    rows = csvio.read_csv_text(spark, f"{root}/a.csv", list("abcde"), line_sep="\r\n").collect()
    assert tuple(rows[0]) == ("x", "", "", None, 'say "hi"')
    assert tuple(rows[1]) == ("multi\nline", "b", "c", None, "\\t")
    with pytest.raises(Exception, match="CR LF|(?i:malformed)"):
        csvio.read_csv_text(spark, f"{root}/a.csv", list("abcde")).collect()
    with pytest.raises(ValueError, match="row end"):
        csvio.read_csv_text(spark, f"{root}/a.csv", list("abcde"), line_sep=None)
    storage.write_text(spark, f"{root}/b.csv", '"a\\"b","c"\n')
    assert tuple(csvio.read_csv_text(spark, f"{root}/b.csv", ["a", "b"], escape="\\").first()) == ('a"b', "c")
    for text in ("1,2\n", "1,2,3,4\n"):
        storage.write_text(spark, f"{root}/c.csv", text)
        with pytest.raises(Exception, match="(?i)malformed"):
            csvio.read_csv_text(spark, f"{root}/c.csv", ["a", "b", "c"]).select("a").collect()
