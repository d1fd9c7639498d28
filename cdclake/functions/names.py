"""Names, paths and cursor keys as Column functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of object names that are percent-escaped in file
# names, besides control characters, % itself and the hyphen before "schema".
ESCAPED = '"*./:<>?\\|'

SCHEMA_FILE_SUFFIX = "-schema.sql"
DATABASE_FILE_SUFFIX = "-schema-create.sql"


def _pct(code: int) -> str:
    return f"%{code:02X}"


def escape_name(name: Column) -> Column:
    """Object name as it appears in a snapshot file name.

    ``%`` goes first, so that the escapes added later are not escaped again.
    """
    out = F.replace(name, F.lit("%"), F.lit("%25"))
    out = F.regexp_replace(out, r"-(?i:(?=schema))", "%2D")
    for ch in ESCAPED:
        out = F.replace(out, F.lit(ch), F.lit(_pct(ord(ch))))
    # Control characters are rare: touch them only where one is present.
    rare = out
    for code in range(0x20):
        rare = F.replace(rare, F.lit(chr(code)), F.lit(_pct(code)))
    return F.when(out.rlike(r"[\x00-\x1f]"), rare).otherwise(out)


def escape_text(name: str) -> str:
    """:func:`escape_name` of a name on the driver."""
    return re.sub(rf"[\x00-\x1f%{re.escape(ESCAPED)}]|-(?=(?i:schema))", lambda m: _pct(ord(m.group(0))), name)


def unescape_name(escaped: Column) -> Column:
    """Inverse of :func:`escape_name`; null for malformed or empty text."""
    # A path keeps its plus signs, unlike a form-encoded query.
    text = F.try_url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))
    return F.when(text != "", text)


def fold_ident(name: Column) -> Column:
    """Regular identifiers fold to upper case, all others stay as they are."""
    return F.when(name.rlike(r"\A[A-Za-z_][A-Za-z0-9_$]*\z"), F.upper(name)).otherwise(name)


def clean_name(name: Column, case_sensitive: bool = False) -> Column:
    """Table name for comparing catalogs: trim, unquote, upper-case."""
    text = F.regexp_replace(name, r"\r$", "")
    text = F.regexp_replace(text, r"^[ \t\n\f\r\x0B]+|[ \t\n\f\r\x0B]+$", "")
    text = F.regexp_replace(text, '^"|"$', "")
    text = F.replace(text, F.lit('""'), F.lit('"'))
    return text if case_sensitive else F.translate(text, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def split_table_name(fqn: Column) -> tuple[Column, Column]:
    """``db.table`` cut at the first dot; nulls where there is no dot."""
    at = F.instr(fqn, ".")
    return (
        F.when(at > 0, F.substring_index(fqn, ".", 1)),
        F.when(at > 0, F.substring(fqn, at + 1, F.length(fqn))),
    )


def schema_version(path: Column) -> Column:
    """Table version of a schema file path; null when it is not one."""
    digits = F.regexp_extract(path, r"(?:^|/)schema_([0-9]+)_[^/]*\.json$", 1)
    return F.when(digits != "", digits).try_cast("decimal(20,0)")


def file_index(name: Column) -> Column:
    """Number of a data file; null when the name is not of that form."""
    digits = F.regexp_extract(name, r"(?:^|/)CDC([0-9]+)\.csv$", 1)
    return F.when(digits != "", digits).try_cast("bigint")


def file_name(idx: Column, width: Column | int) -> Column:
    """Name of data file ``idx``, zero-padded as the index file pads it."""
    text = idx.cast("string")
    width = F.lit(width) if isinstance(width, int) else width
    return F.concat(F.lit("CDC"), F.lpad(text, F.greatest(width, F.length(text)), F.lit("0")), F.lit(".csv"))


def cursor_key(version: Column, partition: Column) -> Column:
    """Key of a stream cursor, ``<version>/<partition>/CDC``."""
    return F.concat_ws("/", version.cast("string"), partition.cast("string"), F.lit("CDC"))


def parse_cursor_key(key: Column) -> tuple[Column, Column]:
    """Version and partition of a cursor key; malformed keys fail the job."""
    parts = F.split(key, "/")
    version = F.try_element_at(parts, F.lit(1)).try_cast("decimal(20,0)")
    partition = F.try_element_at(parts, F.lit(2)).try_cast("bigint")
    good = (F.size(parts) == 3) & (F.try_element_at(parts, F.lit(3)) == "CDC") & version.isNotNull() & partition.isNotNull()
    fail = F.raise_error(F.concat(F.lit("invalid cursor key "), key))
    return F.when(good, version).otherwise(fail), F.when(good, partition).otherwise(fail)


def stream_part(path: Column, part: str) -> Column:
    """db, table, version, partition or date of a path below ``increment/``.

    A stream without a partition level has partition 0.
    """
    i = ["db", "table", "version", "partition", "date"].index(part) + 1
    text = F.regexp_extract(path, r"/increment/([^/]+)/([^/]+)/([0-9]+)/(?:([0-9]+)/)?([0-9]{4}-[0-9]{2}-[0-9]{2})/", i)
    if part in ("db", "table"):
        return unescape_name(text)
    if part == "version":
        return text.try_cast("decimal(20,0)")
    if part == "partition":
        return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))
    return text


def is_date_dir(name: Column) -> Column:
    """True for a valid ``yyyy-MM-dd`` directory name."""
    shape = name.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    return F.coalesce(shape & name.try_cast("date").isNotNull(), F.lit(False))


def commit_time(commit_ts: Column) -> Column:
    """Wall clock of a commit timestamp (physical milliseconds above 18 bits)."""
    return F.timestamp_millis(F.shiftright(commit_ts.cast("bigint"), 18))
