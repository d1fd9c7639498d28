import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cdclake.llm import bpe, common, pack, token_counts
from cdclake.llm.pretokens import vocabulary
from cdclake.llm.queries import vocabulary_file
from tests.llm.cases import ODD, documents, frame, rows_of

import pyarrow as pa

BYTES, WORDS = vocabulary_file("byte_bpe_50k.json"), vocabulary_file("word_bpe_49k.json")
MIXED = st.lists(st.one_of(st.text(max_size=12), st.sampled_from(["'s", "'ll", " ", "\n", "  ", "the", "ab" * 9, "<|endoftext|>", "é", "1"])), max_size=12).map("".join)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


def _ids(library, path, texts):
    return [e.ids for e in library[path].encode_batch(texts, add_special_tokens=False)]


def _texts():
    return ODD + [t or "" for _, t in documents(n=10)]


def test_transducer_counts_as_the_library(library):
    machine = token_counts.Transducer(vocabulary(BYTES))
    assert machine.count(*common.utf8(pa.array(_texts()))).tolist() == [len(x) for x in _ids(library, BYTES, _texts())]


def test_transducer_chunks_and_flushes(library):
    """Any chunk size gives the same counts, also when states are forgotten between slices."""
    want = [len(x) for x in _ids(library, BYTES, _texts())]
    for chunk in (1, 7, 50):
        machine = token_counts.Transducer(vocabulary(BYTES), max_states=10)
        for _ in range(2):
            data, offsets = common.utf8(pa.array(_texts()[:20]))
            p = token_counts.pieces(data, offsets, {})
            changes = machine.changes(data, p.starts, chunk)
            whole = machine.changes(data, p.starts, len(data))
            assert (changes == whole).all()
            assert machine.count(data, offsets).tolist() == want[:20]
    assert len(machine.states) > 10


def test_chunk_maps_compose(library):
    """Pre-tokens of many chunks, also where every assumed entry is wrong: rounds don't grow in proportion."""
    rounds = {}
    for n in (2000, 20000):
        texts = ["a" * n, "ab" * (n // 2) + " x", "x" + "-" * n, "abcdefghijk" * (n // 11), "é" * n, "=" * 191 + "a" * n + " " * n, "theinternational" * (n // 16)]
        want = [len(x) for x in _ids(library, BYTES, texts)]
        for chunk in (5, 37, 192):
            machine = token_counts.Transducer(vocabulary(BYTES))
            follow, calls = machine.follow, []
            machine.follow = lambda *args: calls.append(len(args[2])) or follow(*args)
            data, offsets = common.utf8(pa.array(texts))
            counts = machine.changes(data, token_counts.pieces(data, offsets, {}).starts, chunk)
            assert np.add.reduceat(counts, offsets[:-1]).tolist() == want
            rounds[n, chunk] = len(calls)
    assert any(x > 3 for x in rounds.values())  # some entries were wrong
    assert all(rounds[20000, c] <= rounds[2000, c] + 8 for c in (5, 37, 192)), rounds


@settings(max_examples=60, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=5))
def test_any_text(texts):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(BYTES)
    data, offsets = common.utf8(pa.array(texts))
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.byte_pairs(BYTES).encode(data, offsets)] == want
    assert token_counts.transducer(BYTES).count(data, offsets).tolist() == [len(x) for x in want]


def test_long_and_side_by_side_trees_agree():
    coder = bpe.BytePairs(vocabulary(BYTES))
    for text in (b"internationalisation", b"aaaaaaaaaaaaaaaaaaaaaaaaa", b"x", "żółć".encode() * 30):
        symbols = coder.single[np.frombuffer(text, np.uint8)]
        width = 1 << (len(symbols) - 1).bit_length()
        row = np.full((1, width), -1)
        row[0, :len(symbols)] = symbols
        assert [x for x in coder.merge(row)[0].tolist() if x >= 0] == coder.merge_long(symbols.tolist())


def test_count_tokens(spark, library):
    rows = documents() + list(enumerate(ODD, 20000))
    got = rows_of(token_counts.count_tokens(frame(spark, rows), BYTES))
    want = [(d, len((t or "").encode()), len(x), len(x) > 1024) for (d, t), x in zip(rows, _ids(library, BYTES, [t or "" for _, t in rows]))]
    assert got == sorted(want, key=repr)


def test_round_trip_encode_decode(spark, library):
    rows = documents(2) + list(enumerate(ODD, 20000))
    ids = _ids(library, BYTES, [t or "" for _, t in rows])
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = [(d, len(x), sha(np.array(x, "<u4").tobytes()), sha(library[BYTES].decode(x, skip_special_tokens=False).encode())) for (d, _), x in zip(rows, ids)]
    df = frame(spark, rows)
    assert rows_of(bpe.round_trip(df, BYTES)) == sorted(want, key=repr)
    encoded = bpe.encode(df, BYTES)
    assert rows_of(encoded.select("doc_id", "ids")) == sorted(((d, x) for (d, _), x in zip(rows, ids)), key=repr)
    assert rows_of(bpe.decode(encoded, BYTES)) == sorted(((d, t or "") for d, t in rows), key=repr)


def test_pack(spark, library):
    rows = documents(3) + list(enumerate(ODD, 20000))
    ids = [x + [0] for x in _ids(library, WORDS, [t or "" for _, t in rows])]
    size = 256
    got = pack.pack(frame(spark, rows), WORDS, size=size, open_bins=8).toPandas()
    want = sorted((repr(d), k, s, min(size, len(x) - s), zlib.crc32(np.array(x[s:s + size], "<u4").tobytes())) for (d, _), x in zip(rows, ids) for k, s in enumerate(range(0, len(x), size)))
    name = lambda d: repr(None if d != d else int(d))
    assert sorted((name(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    got = got.sort_values(["sequence_id", "offset"])
    by = got.groupby("sequence_id").length
    assert (got.offset == by.cumsum() - got.length).all() and by.sum().max() <= size
    assert by.ngroups <= 1.05 * sum(map(len, ids)) / size + 2


def test_best_fit_takes_the_fullest_bin_and_closes_the_fullest():
    bins = pack.BestFit(10, 2)
    assert bins.add(6, "a") == [] and bins.add(7, "b") == []
    assert bins.add(3, "c") == [["b", "c"]]  # 7 + 3 fits best and is full
    bins.add(8, "d")
    assert bins.add(5, "e") == [["d"]]  # no room, none free: the fullest closes
    assert sorted(bins.rest()) == [["a"], ["e"]]


def test_empty_tables(spark):
    empty = frame(spark, [])
    for df in (pack.pack(empty, WORDS), token_counts.count_tokens(empty, BYTES), bpe.round_trip(empty, BYTES), bpe.decode(bpe.encode(empty, BYTES), BYTES)):
        assert df.count() == 0
