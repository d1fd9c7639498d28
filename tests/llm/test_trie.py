import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cdclake.llm import trie
from tests.llm.cases import rows_of

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    return df.select("*", *(F.lit(1).alias(c) for c in ("conv", "key", "keys", "words", "depth", "n", "prefix", "own")))


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), text))
    own = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for x in members:
        if x:
            children.setdefault(x[:-1], []).append(x)
    out = []
    leaves, saved = {}, {}
    for x in sorted(members, key=len, reverse=True):
        below = children.get(x, [])
        leaves[x] = sum(leaves[y] for y in below) if below else 1
        words = len((x[-1][1] if x else "").encode().split())
        saved[x] = (len(members[x]) - 1) * words + sum(saved[y] for y in below)
        ends = ",".join(str(c) for c in sorted(members[x]) if len(built[c]) == len(x))
        out.append((min(members[x]), len(x), min(members[x[:-1]]) if x else None, len(members[x]), len(below), leaves[x], saved[x], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed, n=150, longest=14):
    r = random.Random(seed)
    shared = [[(r.choice(["user", "assistant"]), " ".join(r.choice("abcdef") for _ in range(r.randint(0, 5)))) for _ in range(longest)] for _ in range(6)]
    rows = []
    for _ in range(n):
        c = r.randrange(0, 400)
        seq = list(r.choice(shared)[:r.randint(0, longest)])
        seq += [("user", r.choice("xyz"))] * r.choice([0, 0, 1, 2])
        rows += [(c, k, *x) for k, x in enumerate(seq)]
    return rows


@pytest.mark.parametrize("block", [4, 1, 3, 100])
def test_trie(spark, block):
    rows = conversations(1) + [(20, 0, "user", "a"), (21, None, None, None), (21, None, None, None), (21, 5, "user", "b\x0bc\x1cd"), (None, 1, "user", "lost"), (40, 2, None, "q"), (40, 2, "", "q"),
                               (61, 0, "user", "only"), (10**12, 1, "system", "x " * 5000), (7, 3, "ab", "c"), (7, 3, "a", "bc")]
    got = trie.trie(frame(spark, rows), block)
    assert got.columns == COLUMNS
    want = sorted(brute(rows), key=repr)
    assert rows_of(got) == want and max(r[1] for r in want) > 12


def test_trie_of_copies_and_one_long_conversation(spark):
    """Most conversations are one, and one has many turns; batches of a few rows."""
    rows = [(20 * i, k, "user", f"t{k}") for i in range(200) for k in range(5)] + [(20 * i + 9000, k, "user", f"t{k if k < 2 else -i}") for i in range(60) for k in range(3)]
    rows += [(90000, k, "user", f"word {k}") for k in range(700)] + [(90001, k, "user", f"word {k}") for k in range(690)]
    want = sorted(brute(rows), key=repr)
    assert rows_of(trie.trie(frame(spark, rows))) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    few = rows[:400]
    got = rows_of(trie.trie(frame(spark, few)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    assert got == sorted(brute(few), key=repr)


def test_trie_of_nothing(spark):
    assert trie.trie(frame(spark, [])).count() == 0 and trie.trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(1, 40)}
    c = next(c for c in h if h[c] and c % 20)
    rows = [(c, 0, "user", "dropped")]  # its base is absent: no turn is left
    assert rows_of(trie.trie(frame(spark, rows))) == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
