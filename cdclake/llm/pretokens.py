"""Where byte-level BPE begins a new pre-token, for whole slices of texts at once.

The published pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
decides at most three characters ahead and one back, so its matches are found from
the classes of neighbouring characters. A special string splits a text beforehand.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from typing import NamedTuple

import numpy as np

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
#: The characters of \\s in the pattern, and its contractions.
BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


@functools.cache
def classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            table[c] = LETTER if kind == "L" else NUMBER
    table[BLANKS] = BLANK
    table[0x20] = SPACE
    return table


def begins(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Flags of the characters that begin a pre-token; ``first`` flags those that begin a text."""
    n = len(points)
    if n == 0:
        return np.zeros(0, bool)
    kind = classes()[points]
    blank = kind >= SPACE
    before = np.empty(n, np.uint8)
    before[0] = OTHER
    before[1:] = kind[:-1]
    # A character after another of its class goes on; after U+0020 any that isn't blank does.
    starts = first | ((kind != before) & ~blank & (before != SPACE)) | (blank & (before < SPACE))
    # The last blank before other characters stands apart from the blanks before it.
    last = blank.copy()
    last[:-1] &= ~blank[1:] & ~first[1:]
    last[-1] = False
    starts |= last
    # A contraction begins where its apostrophe does.
    quote = np.flatnonzero((points == 0x27) & starts)
    for tail in CONTRACTIONS:
        k = len(tail)
        at = quote[quote + k < n]
        for j, c in enumerate(tail, 1):
            at = at[(points[at + j] == ord(c)) & ~first[at + j]]
        starts[at + 1] = False
        after = at[at + k + 1 < n] + k + 1
        starts[after] = True
    return starts


class Vocabulary(NamedTuple):
    """Tokens of a byte-level BPE file: ids by bytes, bytes by id, and merge results by pair."""

    ids: dict[bytes, int]
    tokens: list[bytes]
    single: list[int]  # id of each byte
    merges: dict[tuple[int, int], tuple[int, int]]  # pair of ids -> (rank, id)
    special: dict[bytes, int]
    ending: list[int] | None = None  # id of each byte at the end of a word, where the file marks ends


def _byte_letters() -> dict[str, int]:
    """The letters by which such files write bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    kinds = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if any((d["pre_tokenizer"] or {}).get(k) != v for k, v in kinds.items()) or d["normalizer"] or d["model"].get("ignore_merges"):
        raise ValueError(f"{path} isn't a plain byte-level BPE")
    letters = _byte_letters()
    special = {t["content"].encode(): t["id"] for t in d["added_tokens"]}
    ids = {bytes(letters[c] for c in t): i for t, i in d["model"]["vocab"].items() if t.encode() not in special}
    tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
    for t, i in [*ids.items(), *special.items()]:
        tokens[i] = t
    merges = {}
    for rank, m in enumerate(d["model"]["merges"]):
        a, b = (bytes(letters[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m))
        merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
    return Vocabulary(ids, tokens, [ids[bytes([b])] for b in range(256)], merges, special)


@functools.cache
def word_vocabulary(path: str) -> Vocabulary:
    """Merges of a BPE file that marks the ends of words; its tokens have no bytes here."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    model, mark = d["model"], d["model"]["end_of_word_suffix"]
    ids, letters = model["vocab"], {b: c for c, b in _byte_letters().items()}
    merges = {}
    for rank, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
    special = {t["content"].encode(): t["id"] for t in d["added_tokens"]}
    return Vocabulary({}, [], [ids[letters[b]] for b in range(256)], merges, special, [ids[letters[b] + mark] for b in range(256)])


class Pieces(NamedTuple):
    data: np.ndarray  # bytes
    starts: np.ndarray  # byte positions at which a pre-token or a special string begins, ascending
    special: np.ndarray  # id of the special token at each, or -1
    first: np.ndarray  # index of each text's first one; one more entry than texts


def pieces(data: np.ndarray, offsets: np.ndarray, special: dict[bytes, int]) -> Pieces:
    """Pre-tokens of all texts, which lie in ``data`` one after another."""
    raw = data.tobytes()
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    byte_of = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    marks: dict[int, int] = {}
    inner: list[tuple[int, int]] = []
    for text, number in special.items():  # none is part of another in the files used
        at = raw.find(text)
        while at >= 0:
            k = int(np.searchsorted(offsets, at, side="right"))
            if at + len(text) <= offsets[k]:
                marks[at] = number
                inner.append((at, at + len(text)))
                first[[at, at + len(text)]] = True
                at += len(text) - 1
            at = raw.find(text, at + 1)
    starts = byte_of[begins(points, first[byte_of])]
    if inner:
        begin, end = np.array(sorted(inner)).T
        k = np.searchsorted(begin, starts, side="right") - 1
        starts = starts[(k < 0) | (starts == begin[k]) | (starts >= end[k])]
    ids = np.full(len(starts), -1)
    for at, number in marks.items():
        ids[np.searchsorted(starts, at)] = number
    return Pieces(data, starts, ids, np.searchsorted(starts, offsets))
