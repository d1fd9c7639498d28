"""Quality rules with limits that follow the data: mergeable quantile sketches per language and source.

**Measures** of a text: characters in words, symbols, repeated lines, words in repeated
five-word windows. **Base rules** are fixed: under ``MIN_WORDS`` words, or over a fifth
of the words in repeated windows.

**Sketch.** A value is rounded down to its ``DIGITS`` leading binary digits, and a sketch
is the number of texts per rounded value: at most 2**DIGITS values per power of two
whatever the number of texts, an error under 1 / 2**(DIGITS - 1) of the value, and
merging is adding, in any order. Each (language, source) has one per measure.

**Limits.** All come from the sketches. A sketch's limit lies above its upper quantile
(each measure's own) by the distance of that to the median, and by one rounding step at
least. A group's limit is drawn towards that of its language's merged sketch, and this
towards that of all texts, as if ``PULL`` texts had been seen there: with n texts of its
own the group counts n / (n + ``PULL``), at every size. A group in which something is
usual keeps it.

Null texts have no words. A null language or source counts as an empty name. Repeated
rows count as often as they occur and get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common, words

MIN_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20
#: Fixed value: what counts as a symbol.
SYMBOLS = "#*$%&|<>"
DIGITS, PULL = 6, 100
#: Measures (per mille, or hundredths of a character) with the per mille of texts below their upper quantile.
#: A thousand characters more make a few symbols in a short text no high rate.
MEASURES = {
    "symbols": ("1000 * n_symbols div (1000 + word_chars)", 850),
    "lines": ("1000 * n_dup_lines div greatest(1, n_lines)", 990),
    "repeats": ("1000 * n_repeat_words div greatest(1, n_words)", 990),
    "length": ("100 * word_chars div greatest(1, n_words)", 950),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_NO_BREAK = np.zeros(256, bool)
_NO_BREAK[0x0A] = True


def _repeated(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items with their text: whether an equal one is in the text, and whether an equal one came before."""
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    same = (t[1:] == t[:-1]) & (h[1:] == h[:-1])
    twice, later = np.zeros(len(text), bool), np.zeros(len(text), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    later[order[1:][same]] = True
    return twice, later


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text in ``data``."""
    n = len(offsets) - 1
    w = words.split(data, offsets)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
    text = w.text
    hashes, at = words.grams(w, WINDOW)
    twice, _ = _repeated(text[at], hashes)
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    lines = words.split(data, offsets, _NO_BREAK)
    full = np.searchsorted(w.starts, lines.ends) > np.searchsorted(w.starts, lines.starts)
    line_text, line_hash = lines.text[full], lines.hashes[full]
    _, later = _repeated(line_text, line_hash)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    return {
        "n_words": np.diff(w.first),
        "word_chars": np.bincount(text, begins[w.ends] - begins[w.starts], n).astype(np.int64),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": np.bincount(line_text[later], minlength=n),
        "n_repeat_words": np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=n),
        "n_lines": np.bincount(line_text, minlength=n),
    }


def measured(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Each row (as a struct ``row``) with lang, source, counts and base_failed."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.working("quality")
        for batch in batches:
            for part in common.slices(batch):
                m = measure(*common.utf8(part.column("text")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "lang", "source")), *(pa.array(m[c]) for c in COUNTS)], ["row", "lang", "source", *COUNTS])

    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = common.with_row(docs, text=name(text_col), lang=name(lang_col), source=name(source_col))
    rows = own.mapInArrow(run, common.row_schema(docs, "lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)))
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def rounded(value: Column) -> Column:
    """A value's leading binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def limits(rows: DataFrame) -> DataFrame:
    """(lang, source, one limit per measure) from texts that pass the base rules."""
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), rounded(F.expr(f"CAST({e} AS BIGINT)")).alias("value")) for m, (e, _) in MEASURES.items())))
    sketch = rows.where(~F.col("base_failed")).select("lang", "source", values.alias("v")).groupBy("lang", "source", "v.measure", "v.value").agg(F.count("*").alias("n"))
    sketch = common.written(sketch, common.scratch(rows.sparkSession))  # small: bounded per group

    def level(keys: list[str], name: str) -> DataFrame:
        """The limit and the number of texts of the sketches merged by ``keys``."""
        merged = sketch.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
        part = "PARTITION BY " + ", ".join([*keys, "measure"])
        ranked = merged.selectExpr("*", f"sum(n) OVER ({part} ORDER BY value) AS upto", f"sum(n) OVER ({part}) AS all")
        tail = F.create_map(*(F.lit(x) for m, (_, u) in MEASURES.items() for x in (m, u)))[F.col("measure")]
        at = lambda mille: F.min(F.when(1000 * F.col("upto") >= mille * F.col("all"), F.col("value")))
        levels = ranked.groupBy(*keys, "measure").agg(F.max("all").alias(f"{name}_n"), at(F.lit(500)).alias("middle"), at(tail).alias("upper"))
        step = F.greatest(F.lit(1), F.call_function("shiftright", F.col("upper"), F.lit(DIGITS - 1)))
        return levels.select(*keys, "measure", f"{name}_n", (F.col("upper") + F.greatest(F.col("upper") - F.col("middle"), step)).alias(name))

    found = level(["lang", "source"], "own").join(level(["lang"], "wide"), ["lang", "measure"]).join(level([], "whole"), "measure")
    found = found.withColumn("base", F.expr(f"(wide_n * wide + {PULL} * whole) div (wide_n + {PULL})"))
    drawn = F.expr(f"(own_n * own + {PULL} * base) div (own_n + {PULL})")
    return found.groupBy("lang", "source").agg(*(F.max(F.when(F.col("measure") == m, drawn)).alias(f"max_{m}") for m in MEASURES))


def _verdict(rows: DataFrame, caps: DataFrame) -> DataFrame:
    verdict = ~F.col("base_failed")
    for m, (e, _) in MEASURES.items():
        verdict &= F.coalesce(F.expr(f"CAST({e} AS BIGINT)") <= F.col(f"max_{m}"), F.lit(True))
    return rows.join(caps, ["lang", "source"], "left").withColumn("kept", verdict)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Each row's counts with base_failed and kept."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(F.col(c).alias(a) for c, a in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    rows = measured(own).select("row.doc_id", "lang", "source", *COUNTS, "base_failed")
    rows = common.written(rows, common.scratch(docs.sparkSession))
    return _verdict(rows, limits(rows)).select("doc_id", *COUNTS[:5], "base_failed", "kept")


def passing(docs: DataFrame, **columns: str) -> DataFrame:
    """The rows that are kept, with all their columns."""
    rows = measured(docs, **columns)
    return _verdict(rows, limits(rows.drop("row"))).where("kept").select("row.*")


_IN_TEXT = "regexp_replace(text, '[#*$%&|<>]', '', 'g')"
_VALUES = {m: e.replace(" div ", " // ") for m, (e, _) in MEASURES.items()}


def _level_sql(keys: str, name: str) -> str:
    by = f"{keys}, measure" if keys else "measure"
    tail = " ".join(f"WHEN '{m}' THEN {u}" for m, (_, u) in MEASURES.items())
    return f"""{name}_q AS (
      SELECT {by}, max(total) AS n, min(value) FILTER (2 * upto >= total) AS middle, min(value) FILTER (1000 * upto >= CASE measure {tail} END * total) AS upper
      FROM (SELECT {by}, value, sum(n) OVER (PARTITION BY {by} ORDER BY value) AS upto, sum(n) OVER (PARTITION BY {by}) AS total
            FROM (SELECT {by}, value, count(*) AS n FROM vals GROUP BY {by}, value)) GROUP BY {by}),
    {name} AS (SELECT {by}, n, upper + greatest(upper - middle, 1, upper >> {DIGITS - 1}) AS cap FROM {name}_q)"""


#: The same in SQL; windows are compared as texts.
ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM hit, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length({_IN_TEXT}) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM m),
raw AS ({" UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, CAST({e} AS BIGINT) AS v FROM b WHERE NOT base_failed" for m, e in _VALUES.items())}),
vals AS (SELECT lang, source, measure, (v >> greatest(length(bin(v)) - {DIGITS}, 0)) << greatest(length(bin(v)) - {DIGITS}, 0) AS value FROM raw),
{_level_sql("lang, source", "own")},
{_level_sql("lang", "wide")},
{_level_sql("", "whole")},
caps AS (SELECT own.lang, own.source, own.measure,
                (own.n * own.cap + {PULL} * ((wide.n * wide.cap + {PULL} * whole.cap) // (wide.n + {PULL}))) // (own.n + {PULL}) AS cap
         FROM own JOIN wide ON own.lang = wide.lang AND own.measure = wide.measure JOIN whole ON own.measure = whole.measure),
lim AS (SELECT lang, source, {", ".join(f"max(cap) FILTER (measure = '{m}') AS max_{m}" for m in MEASURES)} FROM caps GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"coalesce(CAST({e} AS BIGINT) <= max_{m}, true)" for m, e in _VALUES.items())} AS kept
FROM b LEFT JOIN lim ON b.lang = lim.lang AND b.source = lim.source
"""
