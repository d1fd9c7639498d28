"""Exact substring deduplication by content-defined chunks looked up in indexed blocks, in place of relative Lempel-Ziv parsing.

A word goes if a window of ``window`` words that covers it also starts earlier: in a
document with a smaller id, or before in the same one.

**Blocks.** Each window has an anchor: the first of its ``gram``-word sequences whose hash is
least. Equal windows have equal anchors, so all places at which a window can have an
earlier copy lie in one block of the reference, the one that holds its anchor's hash.
A block is a sorted index of all documents' factors with its anchors, and every
document meets every block in which any part of it could be found.

**Factors.** A document is cut without looking at a block: a factor takes in windows as long
as they have the same anchor; it is no longest match. A factor that occurs earlier in its block as a whole is a duplicate
span. So shared passages become spans factor by factor, and copies are never paired.

**Boundaries.** Where an anchor has several different factors, as at both ends of a shared
passage, a match may begin or end within a factor. Of each such factor the earliest
occurrence is looked at window by window; the others are whole duplicates of it.

Factors and windows are compared by 64-bit hashes of the words' hashes. Equal ones
within a slice of texts are settled there, so a passage that a third of all documents
share is sent once per slice. What is settled goes on as runs of windows, one per stretch
of a document, spread by document and place, so no copy of a passage meets another. A
sorted block is read as a stream, in constant memory.

A null text has no words. A null id counts as larger than all others. Rows that share
an id are one document as to which comes first, each with its own words: of windows
with equal id and position none is earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common, words

WINDOW, GRAM = 20, 5
_ODD = np.uint64(0x9E3779B97F4A7C15)  # a multiplier that mixes

_KEYED = pa.schema([("block", pa.int64()), ("factor", pa.int64()), ("id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("settled", pa.bool_())])
_SPANS = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("settled", pa.bool_())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} { {'int64': 'long', 'int32': 'int', 'bool': 'boolean'}[str(f.type)]}" for f in schema)


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Index of the first least hash of each ``width`` consecutive ones."""
    best, have = np.arange(len(hashes)), 1
    while have < width:
        step = min(have, width - have)
        a, b = best[:-step], best[step:]
        best = np.where(hashes[b] < hashes[a], b, a)
        have += step
    return best


def factors(w: words.Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """The greedy parse of all texts: (text, first window, number of windows, anchor hash, factor hash)."""
    none = np.zeros(0, np.int64)
    width = window - gram + 1
    if len(w.hashes) < window:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    at = np.arange(len(w.hashes) - gram + 1)
    grams = words.range_hashes(w.hashes, at, at + gram)
    anchor = _least(grams, width)
    start = np.arange(len(anchor))
    text = w.text[:len(anchor)]
    inside = np.flatnonzero(start + window <= w.first[1:][text])
    if not len(inside):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor, start, text = anchor[inside], start[inside], text[inside]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(start)))
    first = start[begin]
    return text[begin], first - w.first[text[begin]], n, grams[anchor[begin]], words.range_hashes(w.hashes, first, first + n + window - 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _later(key: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Flags of the items of which an equal one comes earlier."""
    order = np.lexsort((starts, ids, key))
    k, i, s = key[order], ids[order], starts[order]
    new = np.append(True, k[1:] != k[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    out = np.zeros(len(k), bool)
    out[order] = (i != i[head]) | (s != s[head])
    return out


def _keyed(block: np.ndarray, factor: np.ndarray, ids: np.ndarray, own: np.ndarray, start: np.ndarray, n: np.ndarray, settled: np.ndarray) -> pa.RecordBatch:
    """Rows for the blocks; settled ones that follow on each other in a document become one, in a block of its own."""
    begins = np.ones(len(start), bool)
    begins[1:] = ~settled[1:] | ~settled[:-1] | (ids[1:] != ids[:-1]) | (own[1:] != own[:-1]) | (start[1:] != start[:-1] + n[:-1])
    at = np.flatnonzero(begins)
    n = np.add.reduceat(n, at) if len(at) else n
    block, factor, ids, own, start, settled = (c[at] for c in (block, factor, ids, own, start, settled))
    apart = (own ^ ids).view(np.uint64) * _ODD ^ start.astype(np.uint64) * _ODD
    block, factor = np.where(settled, apart, block), np.where(settled, np.uint64(0), factor)
    return pa.RecordBatch.from_arrays([_signed(block), _signed(factor), pa.array(ids), pa.array(own), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(settled)], schema=_KEYED)


def _parse(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """All factors of all texts, keyed by their anchor; those with an earlier copy in the slice are settled."""
    common.working("substring")
    for batch in batches:
        for part in common.slices(batch):
            text, first, n, anchor, factor = factors(words.split(*common.utf8(part.column("text"))), window, gram)
            if not len(text):
                continue
            ids, own = part.column("id").to_numpy()[text], part.column("text_hash").to_numpy()[text]
            yield _keyed(anchor, factor, ids, own, first, n, _later(factor, ids, first))


def _look_up(batches: Iterator[pa.RecordBatch], extra: int) -> Iterator[pa.RecordBatch]:
    """A block in order of (block, settled, factor, id, start): duplicate spans, and factors whose windows must be looked at."""
    last: dict = {"block": None}  # of the row before: its anchor, factor and that factor's first place
    held = None  # the first factor of its anchor: it matters only if another follows

    for batch in batches:
        block, factor, ids, own, start, n, settled = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        m = len(block)
        if not m:
            continue
        open_ = ~settled
        new_block = np.ones(m, bool)
        new_block[1:] = (block[1:] != block[:-1]) | (settled[1:] != settled[:-1])
        new_factor = new_block.copy()
        new_factor[1:] |= factor[1:] != factor[:-1]
        goes_on = last["block"] is not None and open_[0] and block[0] == last["block"]
        if goes_on:
            new_block[0] = False
            new_factor[0] = factor[0] != last["factor"]
        head = np.maximum.accumulate(np.where(new_factor, np.arange(m), -1))
        head_id, head_start = np.where(head >= 0, ids[head], last.get("id", 0)), np.where(head >= 0, start[head], last.get("start", 0))
        later = open_ & ((ids != head_id) | (start != head_start))
        whole = settled | later
        # Earliest places of factors whose anchor has several factors. A block's number grows with each new one.
        number = np.cumsum(new_block)
        kinds = np.bincount(number[new_factor], minlength=number[-1] + 1)
        if goes_on:
            kinds[0] += 1 + (last["several"] > 0)
        several = (kinds > 1)[number]
        look = open_ & ~later & several
        out = [(ids[whole], own[whole], start[whole], n[whole] + extra, True), (ids[look], own[look], start[look], n[look], False)]
        if held is not None:
            if goes_on and several[0]:
                out.append((*held, False))
                held = None
            elif not goes_on or new_block[1:].any():
                held = None
        tail = number == number[-1]
        if open_[-1]:
            if not several[-1]:
                fresh = tail & open_ & ~later
                if fresh.any():
                    rows = tuple(c[fresh] for c in (ids, own, start, n))
                    held = rows if held is None else tuple(np.append(a, b) for a, b in zip(held, rows))
            last = {"block": block[-1], "factor": factor[-1], "id": head_id[-1], "start": head_start[-1], "several": int(several[-1])}
        else:
            last, held = {"block": None}, None
        for i, o, s, c, done in out:
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(o), pa.array(s), pa.array(c), pa.array(np.full(len(i), done))], schema=_SPANS)


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Windows of the factors to be looked at, by hash; those with an earlier copy in the slice are settled."""
    for batch in batches:
        for part in common.slices(batch):
            w = words.split(*common.utf8(part.column("text")))
            lists = part.column("look")
            k = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            first, n = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            text = np.repeat(k, n)
            start = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = w.first[text] + start
            h = words.range_hashes(w.hashes, at, at + window)
            ids, own = part.column("id").to_numpy()[text], part.column("text_hash").to_numpy()[text]
            yield _keyed(h, h, ids, own, start, np.ones(len(h), np.int64), _later(h, ids, start))


_ORDER = ["block", "settled", "factor", "id", "start"]


def spans(docs: DataFrame, window: int, gram: int, folder: str) -> DataFrame:
    """(id, text_hash, start, n): all duplicate spans, which may overlap; ``docs`` has (id, text_hash, text)."""
    found = docs.mapInArrow(lambda b: _parse(b, window, gram), _ddl(_KEYED))
    met = common.written(found.repartition("block").sortWithinPartitions(*_ORDER).mapInArrow(lambda b: _look_up(b, window - 1), _ddl(_SPANS)), f"{folder}/factors")
    look = met.where("NOT settled").groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("look"))
    by_window = docs.join(look, ["id", "text_hash"]).select("id", "text_hash", "text", "look").mapInArrow(lambda b: _windows(b, window), _ddl(_KEYED))
    late = by_window.repartition("block").sortWithinPartitions(*_ORDER).mapInArrow(lambda b: _look_up(b, window - 1), _ddl(_SPANS))
    return met.where("settled").unionByName(late.where("settled")).drop("settled")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.slices(batch):
            counts, removed, kept = [], [], []
            texts = part.column("text").cast(pa.binary()).to_pylist()
            for text, own in zip(texts, part.column("spans").to_pylist()):
                every = text.split()
                if own:
                    edge = np.zeros(len(every) + 1, np.int64)
                    np.add.at(edge, [s["start"] for s in own], 1)
                    np.add.at(edge, [s["start"] + s["n"] for s in own], -1)
                    some = [every[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
                else:
                    some = every
                counts.append(len(every))
                removed.append(len(every) - len(some))
                kept.append(b" ".join(some).decode())
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["row", "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row (as a struct ``row``) with n_words, n_removed and ``kept``, the words that stay, joined by a space."""
    spark = docs.sparkSession
    common.small_batches(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = common.with_row(docs, id=common.id_key(id_col), text_hash=F.xxhash64(text), text=text)
    found = spans(own.drop("row"), window, gram, common.scratch(spark))
    by_doc = found.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    # The text goes through this join within its row only.
    out = own.drop("text").join(by_doc, ["id", "text_hash"], "left")
    out = out.select("row", F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")).alias("text"), "spans")
    return out.mapInArrow(_kept, common.row_schema(docs, "n_words long, n_removed long, kept string"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row."""
    out = remove_repeats(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    return out.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def rewritten(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """All rows with all columns; the text (and its size) changes only where words go."""
    out = remove_repeats(docs, id_col=id_col, text_col=text_col)
    changed = {text_col: F.col("kept"), size_col: F.length("kept")}
    own = lambda c: F.col("row").getField(c)
    types = dict(docs.dtypes)
    return out.select(*(F.when(F.col("n_removed") > 0, changed[c].cast(types[c])).otherwise(own(c)).alias(c) if c in changed else own(c).alias(c) for c in docs.columns))
