"""Media columns: WAV bytes, short-time Fourier transforms, and spectral-peak pair fingerprints.

A payload is stored losslessly as 8-bit mono samples of a WAV file and read back by the
``wave`` module. Of the power spectrum of overlapping frames, the bins that are the
largest of their neighbourhood in time and frequency are peaks. Each peak is paired
with every peak of its target zone: the next ``REACH`` frames, after its own, within
``BAND`` bins above and below. A pair is coded by its two frequencies and its distance,
and kept with the frame at which it begins: arrays ``times`` and ``codes`` of equal length.

Null texts count as empty, and an empty payload is padded like any other; texts of any
length are transformed whole, in blocks of frames; equal payloads have equal features.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common

PAD, RATE = 64, 8000
FRAME, HOP = 256, 128
#: Neighbourhood of a peak in frames and in frequency bins, each way; frames transformed at once.
AROUND_T, AROUND_F, BLOCK = 2, 4, 4096
#: Target zone of a peak: frames ahead (under 256), and bins each way.
REACH, BAND = 16, 8

_TAPER = np.hanning(FRAME + 1)[:-1]


def payload(text: bytes) -> bytes:
    """The text with bytes 0 up to a positive multiple of ``PAD``."""
    return text + bytes(-len(text) % PAD if text else PAD)


def to_wav(samples: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(samples)
    return out.getvalue()


def from_wav(data: bytes) -> bytes:
    with wave.open(io.BytesIO(data), "rb") as r:
        if r.getnchannels() != 1 or r.getsampwidth() != 1:
            raise ValueError("not 8-bit mono")
        return r.readframes(r.getnframes())


def _peaks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frame, bin) of all peaks in order; blocks overlap by the neighbourhood, so their edges don't show."""
    n = 1 + max(0, -(-(len(x) - FRAME) // HOP))
    x = np.append(x, np.zeros((n - 1) * HOP + FRAME - len(x)))
    found_t, found_f = [], []
    for begin in range(0, n, BLOCK):
        lo, hi = max(0, begin - AROUND_T), min(n, begin + BLOCK + AROUND_T)
        frames = np.lib.stride_tricks.sliding_window_view(x[lo * HOP:(hi - 1) * HOP + FRAME], FRAME)[::HOP]
        power = np.round(np.log2(1 + np.abs(np.fft.rfft(frames * _TAPER)) ** 2), 3)
        wide = np.pad(power, ((AROUND_T, AROUND_T), (AROUND_F, AROUND_F)), constant_values=-1)
        rows = np.max([wide[i:i + len(power)] for i in range(2 * AROUND_T + 1)], axis=0)
        best = np.max([rows[:, i:i + power.shape[1]] for i in range(2 * AROUND_F + 1)], axis=0)
        t, f = np.nonzero((power >= best) & (power > 0))
        own = (t + lo >= begin) & (t + lo < begin + BLOCK)
        found_t.append(t[own] + lo)
        found_f.append(f[own])
    return np.concatenate(found_t), np.concatenate(found_f)


def fingerprint(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``times`` (frames) and ``codes`` of all peak pairs; code = f1 * 2**16 + f2 * 2**8 + distance."""
    x = np.frombuffer(samples, np.uint8).astype(float) - 128
    t, f = _peaks(x)
    place = t << 8 | f  # ascending; a frame has under 256 bins
    times, codes = [], []
    for ahead in range(1, REACH + 1):
        row = (t + ahead) << 8
        begin, end = np.searchsorted(place, row | np.maximum(f - BAND, 0)), np.searchsorted(place, row | (f + BAND), "right")
        n = end - begin
        one = np.repeat(np.arange(len(t)), n)
        two = np.arange(n.sum()) + np.repeat(begin - np.cumsum(n) + n, n)
        times.append(t[one])
        codes.append(f[one] << 16 | f[two] << 8 | ahead)
    times, codes = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((codes, times))
    return times[order].astype(np.int32), codes[order].astype(np.int32)


def stored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each text as a WAV file in a binary column."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([to_wav(payload(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    return common.texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def features(media: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload and media digests, times, codes) of rows (doc_id, n_bytes, media) as ``stored`` makes them."""
    common.small_batches(media.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "media"):
                files = part.column("media").to_pylist()
                samples = [from_wav(x) for x in files]
                found = [fingerprint(x) for x in samples]
                sha = lambda many: pa.array([hashlib.sha256(x).hexdigest() for x in many], pa.string())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("n_bytes"), pa.array([len(x) for x in samples], pa.int64()), sha(samples),
                    pa.array([zlib.crc32(x[-PAD:]) for x in samples], pa.int64()), pa.array([len(x) for x in files], pa.int64()), sha(files),
                    *(pa.array([x[i] for x in found], pa.list_(pa.int32())) for i in (0, 1))],
                    ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "times", "codes"])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, times array<int>, codes array<int>")


def digest(docs: DataFrame, **columns: str) -> DataFrame:
    """The features with the fingerprint as a short text (number of pairs, and a digest of all times and codes) and as arrays."""
    found = features(stored(docs, **columns))
    whole = F.concat_ws(" ", F.array_join("times", ","), F.array_join("codes", ","))
    return found.select(*found.columns[:7], F.concat(F.size("codes").cast("string"), F.lit(":"), F.md5(whole.cast("binary"))).alias("feature"), "times", "codes")
