"""Token counts by a finite-state transducer instead of by encoding.

**Tokens.** If t is the last token of a prefix, the tokens before it are those of the
prefix without t; and a sequence of tokens is the one that BPE gives exactly if each
neighbouring pair is. So the last token of each longer prefix follows from the last
tokens at the places where it can begin.

**States.** A state is what may still matter: for each place from which the bytes so far
begin a longer vocabulary entry, that entry's node in the trie, the last token before
it, and the count there relative to the count now. Both parts are bounded by the
longest entry, so there are finitely many states. The transition by a byte carries by
how many the token count changes (a merge can take counts back). Transitions are
compiled when first met, and flushed when the table is full.

**Chunks.** The bytes of many texts are cut into chunks, which are followed side by side,
one byte each per step. A chunk that begins a pre-token has a known entry state; of each
other one a map {entry state: exit state} is built over the states that can reach it: first
that after up to ``CHUNK`` bytes before it, then every exit of its predecessor's map. A
log-step scan composes the maps from the known entries on and gives all true entries; while
one of them isn't in its chunk's map, the maps of that pre-token take in one more exit each,
and that entry itself goes to more and more chunks ahead. So the number of rounds depends on
how many states alternate and the logarithm of a pre-token's length.
Counts are written along the composed path.

Null texts count as empty; repeated rows stay; every text is counted whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cdclake.llm import common
from cdclake.llm.pretokens import Vocabulary, pieces, vocabulary

CHUNK = 192
MAX_STATES = 1 << 17
FEW_LONGER = 24
NEVER = (1 << 30,)


class Transducer:
    """Transitions of one vocabulary, compiled as needed."""

    def __init__(self, vocab: Vocabulary, max_states: int = MAX_STATES):
        self.vocab, self.max_states = vocab, max_states
        self.trie: list[dict[int, int]] = [{}]
        self.entry: list[int] = [-1]
        for token, number in vocab.ids.items():
            node = 0
            for b in token:
                node = self.trie[node].setdefault(b, len(self.trie))
                if node == len(self.trie):
                    self.trie.append({})
                    self.entry.append(-1)
            self.entry[node] = number
        parts = {made: (rank, *pair) for pair, (rank, made) in vocab.merges.items()}
        self.left_edge: list[list[tuple[int, float]]] = []
        self.right_edge: list[list[tuple[int, float]]] = []
        for t in range(len(vocab.tokens)):  # (part, rank at which it merges into the next), inner parts last
            for edges, side in ((self.left_edge, 1), (self.right_edge, 2)):
                edge, part, until = [], t, NEVER[0]
                while True:
                    edge.append((part, until))
                    if part not in parts:
                        break
                    until, part = parts[part][0], parts[part][side]
                edges.append(edge[::-1])
        below: list[list[int]] = [[] for _ in self.trie]  # longer entries under each node, where they are few
        for node in range(len(self.trie) - 1, -1, -1):  # children come after their parents
            for child in self.trie[node].values():
                below[node] += [self.entry[child]] * (self.entry[child] >= 0) + below[child]
        self.below = [x if len(x) <= FEW_LONGER else None for x in below]
        self.alike: dict[tuple[int, int], int | None] = {}
        self.groups: dict[tuple, int] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states but the first, which stands before a pre-token."""
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.table = np.full(1 << 18, -1, np.int32)  # at 256 * state + byte: 256 * next state + change + 128

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether BPE leaves the tokens a and b as they are when one follows the other."""
        left, right, i, j = self.right_edge[a], self.left_edge[b], 0, 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            rank = self.vocab.merges.get((x, y), NEVER)[0]
            if rank < x_until and rank <= y_until:
                return False
            if x_until == y_until == NEVER[0]:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def stand_in(self, node: int, token: int) -> int | None:
        """The first token met that goes with the same longer entries under the node; none where it goes with none."""
        longer = self.below[node]
        if token < 0 or longer is None:
            return token
        if (node, token) not in self.alike:
            fits = tuple(self.stay_apart(token, t) for t in longer)
            self.alike[node, token] = self.groups.setdefault((node, fits), token) if any(fits) else None
        return self.alike[node, token]

    def compile(self, state: int, byte: int) -> None:
        kept, last, change = [], -1, 0
        for node, token, count in self.states[state]:
            child = self.trie[node].get(byte)
            if child is None:
                continue
            made = self.entry[child]
            if last < 0 and made >= 0 and (token < 0 or self.stay_apart(token, made)):
                last, change = made, count + 1
            if self.trie[child] and (token := self.stand_in(child, token)) is not None:
                kept.append((child, token, count))
        key = (*((node, token, count - change) for node, token, count in kept), (0, last, 0))
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            if number * 256 == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        self.table[state * 256 + byte] = number * 256 + change + 128

    def follow(self, data: np.ndarray, resets: np.ndarray, begin: np.ndarray, end: np.ndarray, entry: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Exit states of the chunks ``data[begin:end]``; the change by each byte goes to ``counts``."""
        order = np.argsort(begin - end, kind="stable")  # longest first
        at, stop, state = begin[order], end[order], entry[order]  # states are kept times 256
        left = len(order)
        while left:
            while left and at[left - 1] >= stop[left - 1]:
                left -= 1
            if not left:
                break
            here, now = at[:left], state[:left]
            byte = data[here]
            now[resets[here]] = 0
            cell = now + byte
            to = self.table.take(cell)
            if to.min() < 0:
                for c in np.unique(cell[to < 0]).tolist():
                    self.compile(c >> 8, c & 255)
                to = self.table.take(cell)
            counts[here] = (to & 255) - 128
            state[:left] = to & ~255
            at[:left] += 1
        out = np.empty(len(order), np.int64)
        out[order] = state
        return out

    def changes(self, data: np.ndarray, starts: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """The change of the token count by each byte of a text whose pre-tokens begin at ``starts``."""
        counts = np.zeros(len(data), np.int32)
        if not len(data):
            return counts
        resets = np.zeros(len(data), bool)
        resets[starts] = True
        begin = np.arange(0, len(data), chunk)
        end = np.append(begin[1:], len(data))
        # Entries: known where a chunk begins a pre-token, else assumed from the bytes since the last begin nearby.
        reach = starts[np.searchsorted(starts, begin, side="right") - 1]
        warm = np.maximum(reach, begin - chunk)
        entry = self.follow(data, resets, warm, begin, np.zeros(len(begin), np.int64), np.zeros(len(data), np.int32))
        exits = self.follow(data, resets, begin, end, entry, counts)
        known = resets[begin]
        if ((entry[1:] == exits[:-1]) | known[1:]).all():
            return counts
        true = self.compose(data, resets, begin, end, known, entry, exits)
        wrong = np.flatnonzero(true != entry)
        self.follow(data, resets, begin[wrong], end[wrong], true[wrong], counts)
        return counts

    def compose(self, data: np.ndarray, resets: np.ndarray, begin: np.ndarray, end: np.ndarray, known: np.ndarray, entry: np.ndarray, exits: np.ndarray) -> np.ndarray:
        """The true entry of each chunk. Maps are kept as sorted keys (chunk, entry) with their exits."""
        bits, m = 40, len(begin)
        key, out, unused = np.arange(m) << bits | entry, exits, np.zeros(len(data), np.int32)
        run, inner, reach = np.cumsum(known), np.append(~known[1:], False), 1
        run_end = np.searchsorted(run, run, side="right")
        while True:
            order = np.argsort(key, kind="stable")
            key, out = key[order], out[order]
            chunk = key >> bits
            goes_on, to = inner[chunk], (chunk + 1) << bits | out
            at = np.minimum(np.searchsorted(key, to), len(key) - 1)
            there = goes_on & (key[at] == to)
            # The scan: step t composes maps over 2**t chunks.
            jump = np.append(np.where(there, at, len(key)), len(key))
            reached = np.append(known[chunk], False)
            while jump.min() < len(key):
                reached[jump[reached]] = True
                jump = jump[jump]
            reached = reached[:-1]
            lost = reached & goes_on & ~there
            if not lost.any():
                true = np.empty(m, np.int64)
                true[chunk[reached]] = key[reached] & ((1 << bits) - 1)
                return true
            open_ = np.isin(run[chunk], run[chunk[lost]])
            # What is lost also goes to chunks further on: a state that many chunks keep is then there at once.
            reach = min(reach * 4, m)
            first = chunk[lost] + 1
            n = np.minimum(run_end[first] - first, reach)
            ahead = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            fresh = np.setdiff1d(np.append(to[open_ & goes_on & ~there], ahead << bits | np.repeat(out[lost], n)), key)
            c = fresh >> bits
            more = self.follow(data, resets, begin[c], end[c], fresh & ((1 << bits) - 1), unused)
            key, out = np.append(key, fresh), np.append(out, more)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text in ``data``."""
        if len(self.states) > self.max_states:
            self.reset()
        p = pieces(data, offsets, self.vocab.special)
        counts = self.changes(data, p.starts)
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        marked = np.flatnonzero(p.special >= 0)
        ends = np.append(p.starts[1:], len(data))
        per_text = sums[offsets[1:]] - sums[offsets[:-1]]
        if len(marked):
            own = sums[ends[marked]] - sums[p.starts[marked]]
            np.add.at(per_text, np.searchsorted(offsets, p.starts[marked], side="right") - 1, 1 - own)
        return per_text


@functools.cache
def transducer(path: str) -> Transducer:
    return Transducer(vocabulary(path))


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, in one pass without a shuffle."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.working("token_counts", transducer.cache_clear)
        machine = transducer(path)
        for batch in batches:
            for part in common.slices(batch):
                data, offsets = common.utf8(part.column("text"))
                n = machine.count(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pc.greater(pa.array(n), limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return common.texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
