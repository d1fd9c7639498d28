"""Toxicity by logistic regression over hashed word n-grams and skip-grams, fitted by FTRL-proximal.

**Features.** Words are runs of letters, A-Z lowered. Single words, pairs of neighbours
and pairs with one word between are hashed to ``2**bits`` places; a text has a place or
hasn't, however often. Ids, labels, language and source are not looked at.

**Fit.** FTRL-proximal has a learning rate per coordinate and an L1 term that leaves most
weights at exactly zero, so the weights that are sent to all tasks are few; ``2**bits``
bounds them at any size of corpus. It learns from at most ``SAMPLE`` labelled rows
(those whose id hashes lowest), taken in one fixed order by one task.

Null and empty texts score by the bias alone. Rows without a label, null labels and
rows kept out of the fit never reach it; a document that occurs twice is learnt once.
Without any label the score is 0 for all.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common, words

BITS = 20
#: Labelled rows to learn from, at most.
SAMPLE = 16_000
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 8.0, 0.1, 5
#: A score from here on is a prediction.
CUT = 0.5

_APART = np.ones(256, bool)
_APART[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every word, pair and skip pair; places repeat as often as they occur."""
    w = words.split(words.LOWER[data], offsets, _APART)
    text = w.text
    out = [(text, w.hashes)]
    for gap, salt in ((1, 0x51ED270B0A1F39C1), (2, 0x6C8E9CF570932BD5)):
        same = text[gap:] == text[:-gap] if len(text) > gap else np.zeros(0, bool)
        pair = words.mix(w.hashes[:-gap] * np.uint64(salt) + w.hashes[gap:]) if len(text) > gap else w.hashes[:0]
        out.append((text[:len(same)][same], pair[same]))
    where, hashes = (np.concatenate(x) for x in zip(*out))
    return where, (hashes >> np.uint64(64 - bits)).astype(np.int64)


class Ftrl:
    """The per-coordinate state of FTRL-proximal; place 0 also takes the bias, without L1."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 0, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = sigmoid(w.sum()) - label
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def _fit(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Weights that aren't zero, from rows (doc_id, label, places) in order."""
    common.working("toxicity")
    seen, rows = set(), []
    for batch in batches:
        for doc, label, raw in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), batch.column("places").to_pylist()):
            if doc not in seen:
                seen.add(doc)
                rows.append((label, np.frombuffer(raw, np.int32)))
    model = Ftrl(1 << bits)
    for _ in range(EPOCHS):
        for label, at in rows:
            model.learn(at, label)
    at = np.arange(1 << bits)
    weights = model.weights(at)
    kept = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(weights[kept])], ["place", "weight"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights learnt from ``labels`` (doc_id, label): at most ``sample`` of them, and never over ``2**bits`` weights."""
    spark = docs.sparkSession
    common.small_batches(spark)
    order = F.xxhash64("doc_id")
    own = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("label").cast("int")).alias("label"))
    # Its size is bounded by the parameter: 12 bytes a row.
    chosen = F.broadcast(own.orderBy(order, "doc_id").limit(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                where, places = features(*common.utf8(part.column("text")), bits)
                both = np.unique(where << bits | places)
                where, places = both >> bits, (both & ((1 << bits) - 1)).astype(np.int32)
                cuts = np.searchsorted(where, np.arange(part.num_rows + 1)).tolist()
                own = [np.append(np.int32(0), x[x > 0]).tobytes() for x in (places[a:b] for a, b in zip(cuts, cuts[1:]))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(own, pa.binary())], ["doc_id", "label", "places"])

    rows = common.texts(docs).join(chosen, "doc_id").select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, places binary")
    found = rows.repartition(1).sortWithinPartitions(order, "doc_id", "places").mapInArrow(functools.partial(_fit, bits=bits), "place long, weight double").toArrow()
    return found["place"].to_numpy(), found["weight"].to_numpy()


def _scores(part: pa.RecordBatch, table: np.ndarray, bits: int) -> np.ndarray:
    if not table.any():
        return np.zeros(part.num_rows)
    where, at = features(*common.utf8(part.column("text")), bits)
    some = np.flatnonzero((table[at] != 0) & (at > 0))
    both = np.unique(where[some] << bits | at[some])
    total = np.bincount(both >> bits, table[both & ((1 << bits) - 1)], part.num_rows) + table[0]
    return np.array([sigmoid(x) for x in total.tolist()])


def _table(model: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    table = np.zeros(1 << bits)
    table[model[0]] = model[1]
    return table


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of each row."""
    spark = docs.sparkSession
    common.small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.working("toxicity")
        table = _table(sent.value, bits)
        for batch in batches:
            for part in common.slices(batch):
                s = _scores(part, table, bits)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s), pa.array(s >= CUT).cast(pa.int32())], ["doc_id", "score", "predicted"])

    return common.texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int")


def clean(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bits: int = BITS, text_col: str = "text") -> DataFrame:
    """The rows that aren't predicted toxic, with all their columns."""
    spark = docs.sparkSession
    common.small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.working("toxicity")
        table = _table(sent.value, bits)
        for batch in batches:
            for part in common.slices(batch):
                keep = _scores(part, table, bits) < CUT
                yield part.select(["row"]).filter(pa.array(keep))

    own = common.with_row(docs, text=F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return own.mapInArrow(run, common.row_schema(docs, "")).select("row.*")


def held_out(column: str = "doc_id"):
    """Whether a document is kept out of the fit: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(docs: DataFrame, source: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of ``docs``, learnt from labelled rows of ``source`` that aren't held out."""
    return score(docs, learnt(source, labels, sample)).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def learnt(source: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The model of labelled rows of ``source`` that aren't held out."""
    return fit(source, labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label")).where(~held_out()), sample)
