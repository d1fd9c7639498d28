"""Secret redaction in free text and in JSON.

Columns are tested on the JVM; only values that can hide a secret go, in Arrow
batches, to the functions below, which follow nested URLs and JSON to any depth.
"""

from __future__ import annotations

import functools
import json
import re
import string
from urllib.parse import quote_plus, unquote_plus

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "<redacted>"
REDACTED_IN_URL = "%3Credacted%3E"

# Names in front of a secret in `name = value` text.
SECRET_NAMES = [
    "authorization",
    "proxy-authorization",
    "www-authenticate",
    "x-api-key",
    "api[-_]?key",
    "access[-_]?key",
    "access[-_]?token",
    "refresh[-_]?token",
    "token",
    "secret(?:[-_]?access[-_]?key)?",
    "password",
    "passwd",
    "private[-_]?key",
    "session(?:id)?",
    "cookie",
    "set-cookie",
    "signature",
    "credential",
]
# Parts of a key, reduced to letters and digits, that make its value a secret.
SECRET_KEY_PARTS = [
    "authorization",
    "wwwauthenticate",
    "cookie",
    "token",
    "apikey",
    "accesskey",
    "secret",
    "password",
    "passwd",
    "privatekey",
    "credential",
    "signature",
    "session",
]

# Every name above contains one of these.
_HINTS = ["auth", "key", "token", "secret", "passw", "session", "cookie", "signature", "credential"]

_NAME = re.compile(r"(?<![0-9A-Za-z_])(?:" + "|".join(SECRET_NAMES) + ")", re.IGNORECASE | re.ASCII)
_BLANK = "\t\n\f\r "
_WORD = frozenset(string.ascii_letters + string.digits + "_")
_SCHEME = frozenset(string.ascii_letters + string.digits + "+.-")
_URL_STOP = re.compile(r"""[\t\n\f\r "'<>\\]""")
_VALUE_STOP = re.compile(r"[\t\n\f\r ,&;}\]]")
_QUOTE_STOP = re.compile(r"""["'\r\n]""")
_BAD_ESCAPE = re.compile(r"%(?![0-9A-Fa-f]{2})")


@functools.lru_cache(1 << 16)
def is_secret_key(key: str) -> bool:
    """True when a key, reduced to letters and digits, contains a secret part."""
    reduced = re.sub("[^a-z0-9]", "", key.lower())
    return any(part in reduced for part in SECRET_KEY_PARTS)


def _value_end(text: str, at: int) -> int:
    """End of the value that begins at a place: a quoted text closed on its line, or a run up to a delimiter."""
    if text[at:at + 1] in ("'", '"'):
        close = _QUOTE_STOP.search(text, at + 1)
        if close and close[0] in "'\"":
            return close.end()
    stop = _VALUE_STOP.search(text, at)
    return stop.start() if stop else len(text)


def _pairs(text: str) -> str:
    """Values after a secret's name and ``:`` or ``=``."""
    out, done = [], 0
    for m in _NAME.finditer(text):
        if m.start() < done:
            continue
        at = m.end()
        at += text[at:at + 1] in ("'", '"') and at < len(text)
        while at < len(text) and text[at] in _BLANK:
            at += 1
        if text[at:at + 1] not in (":", "=") or at == len(text):
            continue
        at += 1
        while at < len(text) and text[at] in _BLANK:
            at += 1
        end = _value_end(text, at)
        if end > at:
            out += [text[done:at], REDACTED]
            done = end
    return "".join([*out, text[done:]])


def _query_pair(pair: str) -> str:
    key, equals, value = pair.partition("=")
    if not equals:
        return pair
    plain = lambda x: x if _BAD_ESCAPE.search(x) else unquote_plus(x)
    if is_secret_key(plain(key)):
        return f"{key}={REDACTED_IN_URL}"
    seen = plain(value)
    clean = clean_text(seen)
    return pair if clean == seen else f"{key}=" + quote_plus(clean, safe="*").replace("~", "%7E")


def _url(scheme: str, rest: str) -> str:
    """One URL without user information and without secret query values."""
    base, mark, fragment = rest.partition("#")
    head, question, query = base.partition("?")
    authority, slash, path = head.partition("/")
    if "@" in authority:
        authority = REDACTED_IN_URL + authority[authority.rindex("@"):]
    query = "&".join(map(_query_pair, query.split("&"))) if question else ""
    return f"{scheme}://{authority}{slash}{path}{question}{query}{mark}{fragment}"


def _urls(text: str) -> str:
    out, done, at = [], 0, text.find("://")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _SCHEME:
            begin -= 1
        while begin < at and not (text[begin] in string.ascii_letters and (begin == 0 or text[begin - 1] not in _WORD)):
            begin += 1
        stop = _URL_STOP.search(text, at + 3)
        end = stop.start() if stop else len(text)
        if begin < at and end > at + 3:
            out += [text[done:begin], _url(text[begin:at], text[at + 3:end])]
            done = end
        at = text.find("://", max(end, at + 3))
    return "".join([*out, text[done:]])


def clean_text(text: str) -> str:
    """Text without secrets: URLs first, to any depth of URLs in query values, then pairs.

    Other parts of a URL stay as they are. A URL nested too deep to be followed counts as a secret.
    """
    try:
        return _pairs(_urls(text))
    except RecursionError:
        return REDACTED


_word = json.encoder.encode_basestring


class _Literal(str):
    """A number, true, false or null, kept as it is written."""


_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null))')


def parse_json(text: str):
    """Objects as dicts (of equal keys the last counts), arrays as lists; any depth. ValueError if it isn't JSON."""
    holder: list = []
    stack: list = [holder]  # containers that are open
    keys: list = [None]  # for each, the key that waits for its value; None in an array
    want = "value"
    at = 0
    while len(text[at:at + 64].strip(" \t\n\r")) or text[at:].strip(" \t\n\r"):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError("not JSON")
        at = m.end()
        sign, quoted, literal = m.groups()
        if sign in ("}", "]"):
            top = stack[-1]
            if len(stack) == 1 or isinstance(top, dict) != (sign == "}") or want not in ("next", "first"):
                raise ValueError("not JSON")
            stack.pop()
            keys.pop()
            want = "next"
        elif sign == ",":
            if want != "next" or len(stack) == 1:
                raise ValueError("not JSON")
            want = "key" if isinstance(stack[-1], dict) else "value"
        elif sign == ":":
            if want != "colon":
                raise ValueError("not JSON")
            want = "value"
        elif want in ("key", "first") and isinstance(stack[-1], dict):
            if quoted is None:
                raise ValueError("not JSON")
            keys[-1] = json.loads(quoted)
            want = "colon"
        elif want in ("value", "first"):
            value = {} if sign == "{" else [] if sign == "[" else json.loads(quoted) if quoted else _Literal(literal)
            if isinstance(stack[-1], dict):
                stack[-1][keys[-1]] = value
            else:
                stack[-1].append(value)
            want = "next"
            if sign:
                stack.append(value)
                keys.append(None)
                want = "first"
        else:
            raise ValueError("not JSON")
    if len(stack) != 1 or len(holder) != 1:
        raise ValueError("not JSON")
    return holder[0]


def _no_constant(word: str):
    raise ValueError(f"not JSON: {word}")


def _written(v) -> str:
    """A value as compact text, by recursion."""
    if isinstance(v, dict):
        return "{" + ",".join(f'{_word(k)}:{_word(REDACTED) if is_secret_key(k) else _written(v[k])}' for k in sorted(v)) + "}"
    if isinstance(v, list):
        return "[" + ",".join(map(_written, v)) + "]"
    if isinstance(v, str):
        return v if isinstance(v, _Literal) else _word(clean_text(v))
    return "null" if v is None else "true" if v else "false"


def _written_deep(root) -> str:
    """The same without recursion."""
    out: list[str] = []
    todo: list = [("value", root)]
    while todo:
        kind, v = todo.pop()
        if kind == "text":
            out.append(v)
        elif isinstance(v, dict):
            parts = [("text", "{")]
            for i, k in enumerate(sorted(v)):
                parts += [("text", "," * (i > 0) + _word(k) + ":"), ("text", _word(REDACTED)) if is_secret_key(k) else ("value", v[k])]
            todo += reversed([*parts, ("text", "}")])
        elif isinstance(v, list):
            parts = [("text", "[")]
            for i, x in enumerate(v):
                parts += [("text", "," * (i > 0)), ("value", x)]
            todo += reversed([*parts, ("text", "]")])
        else:
            out.append(_written(v))
    return "".join(out)


def clean_json(text: str) -> str:
    """JSON without the values of secret keys at any depth, compact and with sorted keys; other texts as texts.

    Numbers stay as they are written, and of equal keys the last counts. What the standard reader
    can't nest is read and written without recursion.
    """
    try:
        return _written(json.loads(text, object_pairs_hook=dict, parse_int=_Literal, parse_float=_Literal, parse_constant=_no_constant))
    except RecursionError:
        pass
    except ValueError:
        return clean_text(text)
    try:
        return _written_deep(parse_json(text))
    except ValueError:
        return clean_text(text)


def _per_batch(clean):
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else clean(t) for t in texts.to_pylist()], pa.string())

    return run


def redact_text(text: Column) -> Column:
    """Text without secrets. Texts in which nothing can match never leave the JVM."""
    # The lower-case text is computed once, as the only element of an array.
    hinted = F.exists(F.array(F.lower(text)), lambda low: functools.reduce(Column.__or__, [low.contains(h) for h in _HINTS]))
    may_hide = hinted | (text.contains("://") & (text.contains("@") | text.contains("?")))
    return F.coalesce(_per_batch(clean_text)(F.when(may_hide, text)), text)


def redact_json(text: Column) -> Column:
    """JSON text with the values of secret keys replaced at every level, however deep.

    String values are redacted as text; what is no JSON is redacted as a whole text. All values
    take one way, so a value's form doesn't depend on what else it holds.
    """
    return _per_batch(clean_json)(text)
