"""The outline of a DDL text: brackets of any depth, quotes and comments, as Column functions.

A text is cut at its outer brackets and every bracket group is put aside, leaving ``(k)`` for
the one at place k; so commas and words that are left are the text's own. One expression finds
groups that nest up to ``_NESTED`` deep. A text with deeper ones, or with an open bracket, is
cut at every bracket, and one pass keeps the depth as a running sum, so nothing limits how deep
groups nest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Quoted texts, each one token whatever is in them, escaped line ends too.
QUOTED = r"'(?:[^'\\]++|''|\\[\s\S])*+'|`(?:[^`]++|``)*+`|\"(?:[^\"\\]++|\"\"|\\[\s\S])*+\""
_COMMENT = r"/\*(?!!)(?s:.*?)\*/|(?:--(?=\s|$)|#)[^\n]*"
TOKEN = rf"{QUOTED}|{_COMMENT}|[()]|[^()'`\"/#-]++|[\s\S]"
_RUN = rf"(?:{QUOTED}|[^()'`\"]++|['`\"])++"
#: Levels of brackets that one expression finds; each adds to its length.
_NESTED = 6
_GROUP = rf"\((?:{_RUN})?+\)"
for _ in range(_NESTED - 1):
    _GROUP = rf"\((?:{_RUN}|{_GROUP})*+\)"
#: A comment, or (in group 1) all up to the next one.
_UNCOMMENTED = rf"{_COMMENT}|((?:{QUOTED}|[^'`\"/#-]++|(?!{_COMMENT})[\s\S])++)"


def tokens(text: Column) -> Column:
    """Brackets, quoted texts, and what is between them; comments are blanks."""
    found = F.regexp_extract_all(text, F.lit(TOKEN), 0)
    return F.transform(found, lambda t: F.when(t.rlike(rf"^(?:{_COMMENT})$"), " ").otherwise(t))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value taken once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def uncommented(text: Column) -> Column:
    """The text with a blank for each comment."""
    kept = F.transform(F.regexp_extract_all(text, F.lit(_UNCOMMENTED), 1), lambda t: F.when(t == "", " ").otherwise(t))
    return F.when(text.rlike(r"/\*|--|#"), F.array_join(kept, "")).otherwise(text)


def _running(parts: Column) -> Column:
    """The outline of parts of which some are single brackets."""
    start = F.struct(F.lit("").alias("flat"), F.lit("").alias("inner"), F.array().cast("array<string>").alias("groups"), F.lit(0).alias("depth"))

    def step(s: Column, t: Column) -> Column:
        opens, closes = t == "(", (t == ")") & (s["depth"] > 0)
        top = s["depth"] == 0
        ends = closes & (s["depth"] == 1)
        number = F.concat(F.lit("("), F.size(s["groups"]).cast("string"), F.lit(")"))
        return F.struct(
            F.when(ends, F.concat(s["flat"], number)).when(top & ~opens, F.concat(s["flat"], t)).otherwise(s["flat"]).alias("flat"),
            F.when(top | ends, "").otherwise(F.concat(s["inner"], t)).alias("inner"),
            F.when(ends, F.array_append(s["groups"], s["inner"])).otherwise(s["groups"]).alias("groups"),
            (s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).alias("depth"))

    return F.aggregate(parts, start, step, lambda s: F.struct(s["flat"], s["groups"]))


def outline(text: Column) -> Column:
    """struct(flat, groups): the text without comments, its bracket groups numbered, and the groups at their numbers."""

    def of(clean: Column) -> Column:
        is_group = lambda p: p.startswith("(")
        flat = lambda parts: F.array_join(F.transform(parts, lambda p, i: F.when(is_group(p), F.concat(F.lit("("), i.cast("string"), F.lit(")"))).otherwise(p)), "")
        groups = lambda parts: F.transform(parts, lambda p: F.when(is_group(p), F.substring(p, F.lit(2), F.length(p) - 2)))
        by_bracket = F.regexp_extract_all(clean, F.lit(rf"{_RUN}|[()]"), 0)
        return let(F.regexp_extract_all(clean, F.lit(rf"{_GROUP}|{_RUN}|[()]"), 0), lambda parts: F.when(
            F.array_contains(parts, "("), _running(by_bracket)).otherwise(F.struct(flat(parts).alias("flat"), groups(parts).alias("groups"))))

    return let(text, lambda t: let(uncommented(t), of))


def restored(flat: Column, groups: Column) -> Column:
    """A part of an outline with its groups put back."""
    parts = F.regexp_extract_all(flat, F.lit(rf"\([0-9]+\)|(?:{QUOTED}|[^('`\"]++|(?!\([0-9]+\))[\s\S])++"), 0)
    back = F.transform(parts, lambda t: F.when(
        t.rlike(r"^\([0-9]+\)$"), F.concat(F.lit("("), F.get(groups, F.substring(t, F.lit(2), F.length(t) - 2).cast("int")), F.lit(")"))).otherwise(t))
    return F.when(flat.contains("("), F.array_join(back, "")).otherwise(flat)


def at_commas(flat: Column) -> Column:
    """Parts of an outline between its commas."""
    return F.regexp_extract_all(flat, F.lit(rf"(?:{QUOTED}|[^,'`\"]++|['`\"])++"), 0)


def levels(text: Column) -> Column:
    """What is in each bracket group, at any depth, and the text itself; nested groups are ``()``, quoted texts ``''``."""
    start = F.struct(F.array(F.lit("")).alias("open"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, t: Column) -> Column:
        n = F.size(s["open"])
        last, outer = F.element_at(s["open"], -1), F.slice(s["open"], F.lit(1), F.greatest(n - 1, F.lit(0)))
        closes = (t == ")") & (n > 1)
        plain = F.when(t.rlike(r"^['\"]"), "''").when(t.startswith("`"), "``").otherwise(t)
        before = F.when(closes, F.slice(s["open"], F.lit(1), F.greatest(n - 2, F.lit(0)))).otherwise(outer)
        grown = F.when(closes, F.concat(F.get(s["open"], n - 2), F.lit("()"))).otherwise(F.concat(last, plain))
        return F.struct(
            F.when(t == "(", F.array_append(s["open"], F.lit(""))).otherwise(F.array_append(before, grown)).alias("open"),
            F.when(closes, F.array_append(s["done"], last)).otherwise(s["done"]).alias("done"))

    return F.aggregate(tokens(text), start, step, lambda s: F.concat(s["done"], s["open"]))
