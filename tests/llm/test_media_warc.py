import base64
import glob
import gzip
import hashlib
import io
import random
import time
import wave
import zlib

import numpy as np
import pytest

from cdclake.llm import common, media, warc
from tests.llm.cases import documents, frame, rows_of


def test_media(spark):
    rows = documents(7) + [(20000, "x" * 64), (20001, "x" * 65), (20002, "x" * 64)]
    got = media.digest(frame(spark, rows)).collect()
    by_text, want = {}, []
    for d, t in rows:
        p = (t or "").encode()
        p += bytes(max(64, -(-len(p) // 64) * 64) - len(p))
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setparams((1, 1, 8000, 0, "NONE", "not compressed"))
            w.writeframes(p)
        f = out.getvalue()
        want.append((d, len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(f), hashlib.sha256(f).hexdigest()))
    assert rows_of(media.digest(frame(spark, rows)).drop("feature", "times", "codes")) == sorted(want, key=repr)
    for r in got:
        by_text.setdefault(r.payload_sha256, set()).add(r.feature)
    assert all(len(x) == 1 for x in by_text.values())
    long = {r.feature for r in got if r.n_bytes >= 512}
    assert len(long) > 0.85 * len({r.payload_sha256 for r in got if r.n_bytes >= 512})  # near copies may share all their peaks
    assert media.digest(frame(spark, [])).count() == 0


def test_fingerprint_finds_tones_and_shifts_with_time(monkeypatch):
    t = np.arange(6400)
    tone = lambda f: np.round(100 * np.sin(2 * np.pi * f * t / 256)) + 128
    x = np.concatenate([tone(20)[:3200], tone(60)[:3200]]).astype(np.uint8).tobytes()
    times, codes = media.fingerprint(x)
    assert len(times) == len(codes) and {20, 60} <= set((codes >> 16).tolist())
    later, _ = media.fingerprint(bytes([128]) * media.HOP * 8 + x)
    assert later.max() - times.max() == 8
    monkeypatch.setattr(media, "BLOCK", 7)  # blocks leave no trace
    again = media.fingerprint(x)
    assert (again[0] == times).all() and (again[1] == codes).all()


def test_pairs_are_the_whole_zone():
    x = random.Random(5).randbytes(20000) + b"ab" * 600
    t, f = media._peaks(np.frombuffer(x, np.uint8).astype(float) - 128)
    peaks = list(zip(t.tolist(), f.tolist()))
    want = sorted((a, p << 16 | q << 8 | (b - a)) for a, p in peaks for b, q in peaks if 1 <= b - a <= media.REACH and abs(q - p) <= media.BAND)
    times, codes = media.fingerprint(x)
    assert list(zip(times.tolist(), codes.tolist())) == want and len(want) > 1000
    assert [len(c) for c in media.fingerprint(bytes([128]) * 64)] == [0, 0]


def _pages():
    rows = [(i, f"http://h/{i}", f"<p>page {i % 7}</p>" * (i % 7 + 1) if i % 3 else f"<p>own {i} é</p>") for i in range(60)]
    return rows + [(100, None, None), (101, "u", ""), (None, "u", "no id"), (None, "u", "<p>page 1</p>" * 2), (102, "u", "twice"), (102, "u", "twice"), (50, "u", "twice"), (103, "u\r\nX: y", "W" * 200000)]


def test_warc_round_trip(spark):
    rows = _pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).selectExpr("*", "'x' AS value", "1 AS digest", "2 AS refers_to")
    most, want = {}, []
    for p, _, h in rows:
        most[h or ""] = max(most.get(h or "", -1), -1 if p is None else p)
    for p, _, h in rows:
        raw = (h or "").encode()
        revisit = p is not None and p < most[h or ""]
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", most[h or ""] if revisit else None))
    assert rows_of(warc.round_trip(df)) == sorted(want, key=repr)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_files_are_plain_gzip_series(spark):
    folder = common.scratch(spark)
    warc.write(spark.createDataFrame(_pages(), "page_id long, url string, html string").repartition(1), folder)
    (path,) = glob.glob(f"{folder.removeprefix('file:')}/part-*")
    text = gzip.open(path).read()
    assert text.count(b"WARC/1.1\r\n") == len(_pages()) and text.endswith(b"\r\n\r\n")
    found = warc.read(spark, folder)
    assert found.where("gap").count() == 0
    stored = {r.page_id: bytes(r.payload) for r in found.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert stored[103] == b"W" * 200000 and stored[101] == b""


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    records = [warc.record(i, "u", f"payload {i} ".encode() * 50) for i in range(8)]
    parts = [warc._member(x) for x in records] if packed else records
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    whole = b"".join(parts)
    assert [(r.offset, r.length) for r in warc.salvage(whole)] == [(a, b - a) for a, b in zip(starts, starts[1:])]
    broken = bytearray(whole)
    for k in (2, 3, 7):  # one byte each in the middle
        broken[(starts[k] + starts[k + 1]) // 2] ^= 0x55
    found = list(warc.salvage(b"junk" + bytes(broken)))
    gaps = [(r.offset, r.length) for r in found if r.headers is None]
    assert gaps == [(0, 4), (starts[2] + 4, starts[4] - starts[2]), (starts[7] + 4, starts[8] - starts[7])]
    assert [r.headers["x-page-id"] for r in found if r.headers] == ["0", "1", "4", "5", "6"]
    cut = list(warc.salvage(whole[:starts[5] + 10]))
    assert [r.headers is None for r in cut] == [False] * 5 + [True]
    assert list(warc.salvage(b"")) == [] and [r.length for r in warc.salvage(b"\x1f\x8b\x08\x00")] == [4]


def _seconds(data):
    begin = time.perf_counter()
    found = list(warc.salvage(data))
    return time.perf_counter() - begin, found


def test_salvage_takes_linear_time():
    member = [warc._member(warc.record(i, "u", random.Random(i).randbytes(3000).hex().encode())) for i in range(16)]
    few, found = _seconds(b"".join(member * 125))
    many, more = _seconds(b"".join(member * 1000))
    assert len(found) == 2000 and len(more) == 16000 and not any(r.headers is None for r in more)
    assert many < 30 * few + 1  # eight times the records


@pytest.mark.parametrize("junk", [warc.MAGIC, b"WARC/", b"WARC/1.1\r\n", warc.MAGIC + b"\x08" + b"n" * 7, b"\x1f\x8b\x08\x1c"])
def test_salvage_passes_junk_in_linear_time(junk):
    good = warc._member(warc.record(1, "u", b"after"))
    few, _ = _seconds(junk * (100_000 // len(junk)) + good)
    noise = junk * (1_600_000 // len(junk))
    many, found = _seconds(noise + b"\0" + good)
    assert [(r.offset, r.headers is None) for r in found] == [(0, True), (len(noise) + 1, False)]
    assert many < 60 * few + 1  # sixteen times the bytes


def test_headers_may_be_folded_and_named_members_are_read():
    folded = warc.record(1, "u", b"x").replace(b"Content-Type: text/html", b"Content-Type: text/html;\r\n charset=utf-8")
    (one,) = warc.salvage(folded)
    assert one.headers["content-type"] == "text/html; charset=utf-8"
    out = io.BytesIO()
    with gzip.GzipFile("name.warc", "wb", fileobj=out) as g:
        g.write(folded)
    assert [r.block for r in warc.salvage(out.getvalue() * 3)] == [b"x"] * 3
    assert [r.headers for r in warc.salvage(b"WARC/1.1\r\nno header\r\nContent-Length: 0\r\n\r\n\r\n\r\n")] == [None]
    assert [r.headers for r in warc.salvage(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc")] == [None]
