"""Best-fit packing of token sequences, online and in bounded space.

Each task packs the pieces of its rows as they come. A fixed number of bins is open;
a bitset has a bit for each free space that some open bin has, so the bin that a piece
fills best is the lowest set bit from the piece's length up. When all bins are open
and none has room, the fullest closes. Bins that are still open at a task's end are
packed once more, as wholes, with those of neighbouring tasks.

Null texts count as empty (one token, the end mark); repeated rows are packed as often
as they occur; no piece is dropped or shortened.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common
from cdclake.llm.bpe import BytePairs
from cdclake.llm.pretokens import word_vocabulary

SIZE = 2048
OPEN_BINS = 512
#: Words, and parts of words, whose ids a worker remembers at most; then it starts anew.
KNOWN_WORDS, KNOWN_PARTS = 600_000, 600_000
#: The words' pattern in that file, for characters on which both pattern languages agree.
MATCHES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
PLAIN = re.compile("[!-~\u00c0-\u012f\u0131-\u024f]+")
TASKS_TOGETHER = 32


class BestFit:
    """Bins of ``size``, of which at most ``open_bins`` are open."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.limit, self.open, self.bits = size, open_bins, 0, 0
        self.by_free: list[list[list]] = [[] for _ in range(size + 1)]

    def add(self, length: int, item) -> list[list]:
        """Put an item in; the bins that close by it, each a list of items."""
        closed = []
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            content = self._take(free)
        else:
            if self.open == self.limit:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, content = self.size, []
        content.append(item)
        free -= length
        if free:
            self.by_free[free].append(content)
            self.bits |= 1 << free
            self.open += 1
        else:
            closed.append(content)
        return closed

    def _take(self, free: int) -> list:
        content = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return content

    def rest(self) -> list[list]:
        return [content for same in self.by_free for content in same]


@functools.cache
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class WordIds:
    """Token ids of texts, word by word, for the word-end BPE file: its matches never span white space.

    Words of Latin letters, digits and ASCII signs are merged here, many side by side;
    all others go to the tokenizers library.
    """

    def __init__(self, path: str, end_id: int):
        self.library, self.pairs, self.known = _library(path), BytePairs(word_vocabulary(path)), {}
        self.end = np.uint32(end_id).tobytes()

    def _learn(self, words: list[bytes]) -> None:
        plain, odd = {}, []
        for w in words:
            text = w.decode("utf-8")
            if PLAIN.fullmatch(text) and "<|" not in text:
                plain[w] = [x.encode() for x in MATCHES.findall(text.lower())]
            else:
                odd.append((w, text))
        pairs = self.pairs
        if len(pairs.known) > KNOWN_PARTS:
            pairs.known.clear()
        pairs.learn(list(set().union(*plain.values()).difference(pairs.known)))
        self.known.update((w, b"".join([pairs.known[x] for x in own])) for w, own in plain.items())
        if odd:
            found = self.library.encode_batch_fast([text for _, text in odd], add_special_tokens=False)
            self.known.update((w, np.array(e.ids, "<u4").tobytes()) for (w, _), e in zip(odd, found))

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the end mark."""
        words = [t.split() for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        self._learn(list(set().union(*words).difference(self.known)))
        get = self.known.__getitem__
        return [b"".join(map(get, w)) + self.end for w in words]


_OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, open boolean"


def _rows(bins: list[tuple[int, list, bool]], schema: list[str], arrow: pa.Schema) -> pa.RecordBatch:
    out = [[] for _ in schema]
    for number, content, is_open in bins:
        at = 0
        for item in content:
            for column, v in zip(out, (*item, number, at, is_open)):
                column.append(v)
            at += item[3]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, arrow)], schema=arrow)


_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("bin", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])


def pack(docs: DataFrame, path: str, size: int = SIZE, open_bins: int = OPEN_BINS, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    spark = docs.sparkSession
    common.small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.working("pack", _release)
        task, made = TaskContext.get().partitionId(), 0
        ids, bins = _words(path, end_id), BestFit(size, open_bins)
        ready: list[tuple[int, list, bool]] = []

        def close(contents: list[list], is_open: bool = False) -> None:
            nonlocal made
            for content in contents:
                ready.append((task << 32 | made, content, is_open))
                made += 1

        for batch in batches:
            for part in common.slices(batch):
                data, offsets = common.utf8(part.column("text"))
                raw, cuts = data.tobytes(), offsets.tolist()
                for doc, own in zip(part.column("doc_id").to_pylist(), ids.of([raw[a:b] for a, b in zip(cuts, cuts[1:])])):
                    n = len(own) // 4
                    for k, start in enumerate(range(0, n, size)):
                        length = min(size, n - start)
                        close(bins.add(length, (doc, k, start, length, zlib.crc32(own[4 * start:4 * (start + length)]))))
                if ready:
                    yield _rows(ready, _ARROW.names, _ARROW)
                    ready.clear()
        close(bins.rest(), True)
        if ready:
            yield _rows(ready, _ARROW.names, _ARROW)

    pieces = common.written(common.texts(docs, id_col, text_col).mapInArrow(run, _OUT), common.scratch(spark))
    left = pieces.where("open").groupBy("bin").agg(F.sum("length").alias("used"))
    group = F.floor(F.shiftright("bin", 32) / TASKS_TOGETHER)
    moved = left.repartition(group).sortWithinPartitions("bin").mapInArrow(functools.partial(_repack, size=size, open_bins=open_bins), "bin long, to long, shift long")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    stay = pieces.where(~F.col("open")).select(*columns, F.col("bin").alias("sequence_id"), "offset")
    move = pieces.where("open").join(moved, "bin").select(*columns, F.col("to").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"))
    return stay.unionByName(move)


def _repack(batches: Iterator[pa.RecordBatch], size: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    """New places of bins left open; a new bin has the number of its first one."""
    bins = BestFit(size, open_bins)

    def rows(contents: list[list]) -> pa.RecordBatch:
        out: list[tuple[int, int, int]] = []
        for content in contents:
            at = 0
            for old, used in content:
                out.append((old, content[0][0], at))
                at += used
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["bin", "to", "shift"])

    for batch in batches:
        closed = []
        for old, used in zip(batch.column("bin").to_pylist(), batch.column("used").to_pylist()):
            closed += bins.add(used, (old, used))
        yield rows(closed)
    yield rows(bins.rest())


def _release() -> None:
    for cached in (_words, _library, word_vocabulary):
        cached.cache_clear()


@functools.cache
def _words(path: str, end_id: int) -> WordIds:
    return WordIds(path, end_id)
