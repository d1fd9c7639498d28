"""Byte-pair encoding by segment trees over the ranks of neighbouring pairs, and decoding.

A tree's leaf j holds (rank, j) of the pair that begins at symbol j; each node holds
the lesser of its children, so the root names the leftmost pair of the lowest rank.
A merge changes three leaves, each carried up in logarithmic time, until the root has
no pair. The trees of many pre-tokens of like length are worked on side by side.

Null texts count as empty; texts of any length are encoded whole; repeated rows stay.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cdclake.llm import common
from cdclake.llm.pretokens import Vocabulary, pieces, vocabulary

NONE = np.int64(2**62)
#: Pre-tokens that a worker remembers at most; then it starts anew.
KNOWN = 600_000
#: Symbols in all trees that are worked on side by side.
TOGETHER = 1 << 16


SLOT_BITS = 19


def _slot(key: np.ndarray, half: int) -> np.ndarray:
    """One of the two places of each key in a table of two halves."""
    mixed = key.astype(np.uint64) * np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[half])
    return (mixed >> np.uint64(65 - SLOT_BITS)).astype(np.int64) + (half << SLOT_BITS - 1)


def _slots(keys: np.ndarray) -> np.ndarray:
    """A table with the index of each key at one of its two places; elsewhere some index."""
    table, places = {}, [_slot(keys, 0).tolist(), _slot(keys, 1).tolist()]
    for k in range(len(keys)):
        half, item = 0, k
        for _ in range(500):
            at = places[half][item]
            item, table[at] = table.get(at, -1), item
            if item < 0:
                break
            half = 1 - (places[1][item] == at)
        else:
            raise ValueError("no place for a pair")
    out = np.zeros(1 << SLOT_BITS, np.int64)
    out[list(table)] = list(table.values())
    return out


class BytePairs:
    def __init__(self, vocab: Vocabulary):
        v = self.vocab = vocab
        pairs = np.array([(a << 32 | b, rank, made) for (a, b), (rank, made) in v.merges.items()], np.int64)
        pairs = pairs[np.argsort(pairs[:, 0])]
        self.keys, self.ranks, self.made = np.ascontiguousarray(pairs.T)
        self.slots = _slots(self.keys)
        self.single = np.array(v.single, np.int64)
        self.ending = None if v.ending is None else np.array(v.ending, np.int64)
        self.sizes = np.array([len(t) for t in v.tokens], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(v.tokens), np.uint8)
        self.known: dict[bytes, bytes] = {}
        self.special = {t: np.uint32(i).tobytes() for t, i in v.special.items()}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs (NONE where they don't merge) and what they merge to."""
        key = left << 32 | right
        at = self.slots.take(_slot(key, 0))
        other = np.flatnonzero(self.keys.take(at) != key)
        at[other] = self.slots.take(_slot(key[other], 1))
        hit = self.keys.take(at) == key
        return np.where(hit, self.ranks.take(at), NONE), self.made.take(at)

    def merge(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of ids, padded by -1 to a power of two, after all merges; merged ones become -1.

        All arrays are flat; ``row`` is where a lane's symbols begin, and twice that where its tree does.
        """
        lanes, width = symbols.shape
        place, shift = np.arange(width), np.int64(max(1, width.bit_length()))
        follow = np.tile(np.append(place[1:], width), lanes)
        before = np.tile(place - 1, lanes)
        tree = np.full((lanes, 2 * width), NONE)
        if width > 1:
            ranks, _ = self.lookup(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
            ranks = ranks.reshape(lanes, width - 1)
            tree[:, width:-1] = np.where(ranks < NONE, ranks << shift | place[:-1], NONE)
        level = width
        while level > 1:
            level //= 2
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
        symbols, tree, mask = symbols.ravel(), tree.ravel(), (1 << shift) - 1

        def rank(row: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
            ranks, _ = self.lookup(symbols.take(row + at), symbols.take(row + to))
            return np.where(ranks < NONE, ranks << shift | at, NONE)

        row = np.arange(lanes) * width
        root = tree.take(2 * row + 1)
        while True:
            some = root < NONE
            row, root = row[some], root[some]
            if not len(row):
                break
            at = root & mask
            here, gone = row + at, follow.take(row + at)
            made = self.lookup(symbols.take(here), symbols.take(row + gone))[1]
            symbols[here] = made
            symbols[row + gone] = -1
            after = follow.take(row + gone)
            follow[here] = after
            inner = np.flatnonzero(after < width)
            before[row[inner] + after[inner]] = at[inner]
            tree[2 * row + width + gone] = NONE
            value = np.full(len(row), NONE)
            value[inner] = rank(row[inner], at[inner], after[inner])
            tree[2 * row + width + at] = value
            left = before.take(here)
            first = left < 0
            left[first] = at[first]
            value[~first] = rank(row[~first], left[~first], at[~first])
            tree[2 * row + width + left] = value
            # The three leaves' paths to the root, level by level.
            base = np.concatenate([2 * row] * 3)
            node = np.concatenate([gone, at, left]) + width
            for _ in range(width.bit_length() - 1):
                node >>= 1
                child = base + 2 * node
                tree[base + node] = np.minimum(tree.take(child), tree.take(child + 1))
            root = tree.take(2 * row + 1)
        return symbols.reshape(lanes, width)

    def merge_long(self, symbols: list[int]) -> list[int]:
        """The same for one long sequence, with one tree in plain Python."""
        n, merges = len(symbols), self.vocab.merges
        width = 1 << (n - 1).bit_length()
        none = (1 << 62, 0)
        tree = [none] * (2 * width)
        for j in range(n - 1):
            if m := merges.get((symbols[j], symbols[j + 1])):
                tree[width + j] = (m[0], j)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        follow, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(j: int, value: tuple[int, int]) -> None:
            k = width + j
            tree[k] = value
            while k > 1:
                k >>= 1
                best = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == best:
                    return
                tree[k] = best

        while tree[1] < none:
            j = tree[1][1]
            gone = follow[j]
            symbols[j] = merges[symbols[j], symbols[gone]][1]
            symbols[gone] = -1
            after = follow[j] = follow[gone]
            put(gone, none)
            m = None
            if after < n:
                before[after] = j
                m = merges.get((symbols[j], symbols[after]))
            put(j, (m[0], j) if m else none)
            if (left := before[j]) >= 0:
                m = merges.get((symbols[left], symbols[j]))
                put(left, (m[0], left) if m else none)
        return [s for s in symbols if s >= 0]

    def learn(self, tokens: list[bytes]) -> None:
        """Encode pre-tokens and remember their ids as little-endian 32-bit numbers."""
        by_width: dict[int, list[bytes]] = {}
        for t in tokens:
            by_width.setdefault(1 << max(0, len(t) - 1).bit_length(), []).append(t)
        for width, group in by_width.items():
            if width > 256 and len(group) < 16:
                for t in group:
                    symbols = self.single[np.frombuffer(t, np.uint8)]
                    if self.ending is not None:
                        symbols[-1] = self.ending[t[-1]]
                    self.known[t] = np.array(self.merge_long(symbols.tolist()), "<u4").tobytes()
                continue
            step = max(1, TOGETHER // width)
            for i in range(0, len(group), step):
                some = group[i:i + step]
                sizes = np.array([len(t) for t in some])
                inside = np.arange(width) < sizes[:, None]
                symbols = np.full(inside.shape, -1, np.int64)
                symbols[inside] = self.single[np.frombuffer(b"".join(some), np.uint8)]
                if self.ending is not None:
                    symbols[np.arange(len(some)), sizes - 1] = self.ending[[t[-1] for t in some]]
                symbols = self.merge(symbols)
                kept = symbols >= 0
                ends = np.cumsum(kept.sum(1)) * 4
                flat = symbols[kept].astype("<u4").tobytes()
                self.known.update((t, flat[a:b]) for t, a, b in zip(some, [0, *ends.tolist()], ends.tolist()))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of each text in ``data``."""
        p = pieces(data, offsets, self.vocab.special)
        raw, cuts = data.tobytes(), [*p.starts.tolist(), len(data)]
        tokens = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(self.known) > KNOWN:
            self.known.clear()
        self.learn(list(set(tokens).difference(self.known, self.special)))
        known = self.known | self.special if (p.special >= 0).any() else self.known
        get, first = known.__getitem__, p.first.tolist()
        return [b"".join(map(get, tokens[a:b])) for a, b in zip(first, first[1:])]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids; what isn't UTF-8 is replaced as decoders do."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.begin[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.bytes[at].tobytes().decode("utf-8", "replace").encode()


@functools.cache
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(vocabulary(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of each row."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                ids = [np.frombuffer(x, "<u4") for x in byte_pairs(path).encode(*common.utf8(part.column("text")))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return common.texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); a null list is an empty one."""
    common.small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [byte_pairs(path).decode(np.array(x or [], np.int64)).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, and its ids decoded again."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.working("bpe", byte_pairs.cache_clear)
        coder = byte_pairs(path)
        for batch in batches:
            for part in common.slices(batch):
                ids = coder.encode(*common.utf8(part.column("text")))
                decoded = [coder.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return common.texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
