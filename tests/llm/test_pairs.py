import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cdclake.llm import common, components, jaccard, substring
from tests.llm.cases import documents, frame, rows_of

LAST = 2**63 - 1


def brute_substring(rows, window=20):
    docs = [(LAST if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in docs:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, (LAST + 1, 0)), (i, p))
    out = []
    for (i, w), (own, _) in zip(docs, rows):
        gone = {j for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < (i, p) for j in range(p, p + window)}
        out.append((own, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return out


@pytest.mark.parametrize("batch", [1000, 5, 1])
def test_substring(spark, batch):
    """Batches of any size give the same, so blocks are read rightly across their borders."""
    rows = documents(8, n=100 if batch > 1 else 25)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    got = rows_of(substring.digest(frame(spark, rows)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    want = sorted(((d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute_substring(rows)), key=repr)
    assert got == want and sum(r[2] for r in want) > 1000


def test_substring_periodic_and_rewritten(spark):
    rows = [(1, "a " * 60), (2, "a b " * 40), (3, " ".join(f"x{i}" for i in range(50))), (4, "new  words\n" + " ".join(f"x{i}" for i in range(5, 40)) + " end"), (5, "kept  as\tis"), (6, None)]
    df = frame(spark, rows)
    want = {d: k if g else None for d, _, g, k in brute_substring(rows)}
    out = {r.doc_id: r for r in substring.rewritten(df).collect()}
    assert substring.rewritten(df).schema.simpleString() == df.schema.simpleString()
    for d, t in rows:
        assert out[d].text == (t if want[d] is None else want[d]) and out[d].n_chars == (None if t is None else len(out[d].text))
    assert substring.digest(frame(spark, [])).count() == 0


def brute_components(rows, gram=3, percent=90):
    """(id, set size, least id, component) of each row; rows link by their sets alone, whatever their ids."""
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    sets, parent, index = [], [], {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, t) in enumerate(rows):
        w = (t or "").encode().translate(low).split()
        s = frozenset(tuple(w[k:k + gram]) for k in range(len(w) - gram + 1)) or frozenset([tuple(w)] * bool(w))
        sets.append((LAST if i is None else i, s))
        parent.append(k)
        common_ = {}
        for x in s:
            for j in index.get(x, ()):
                common_[j] = common_.get(j, 0) + 1
            index.setdefault(x, []).append(k)
        for j, c in common_.items():
            if 100 * c >= percent * (len(s) + len(sets[j][1]) - c):
                parent[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), LAST), i)
    value = lambda x: None if x == LAST else x
    return [(value(i), len(s), value(least[root(k)]), root(k)) for k, (i, s) in enumerate(sets)]


def brute_jaccard(rows, gram=3, percent=90):
    return [x[:3] for x in brute_components(rows, gram, percent)]


def assert_one_per_group(rows, kept, gram=3, percent=90):
    """Of each component one row stays, and that is one of those with its smallest id."""
    groups = {}
    for r, (i, _, least, root) in zip(rows, brute_components(rows, gram, percent)):
        if i == least:
            groups.setdefault(root, set()).add(tuple(r))
    left = [tuple(r) for r in kept]
    for some in sorted(groups.values(), key=len):
        mine = [r for r in left if r in some]
        assert mine, some
        left.remove(mine[0])
    assert left == []


def near(seed, groups=40):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, d = [], 0
    for _ in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.randint(1, 150))]
        for _ in range(r.choice([1, 2, 3, 8, 25])):
            x = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
                x[r.randrange(len(x))] = r.choice(vocabulary)
            x = x[:max(1, int(len(x) * 0.93))] if r.random() < 0.3 else x
            rows.append((d * 7 % 1009, " ".join(x).upper() if r.random() < 0.2 else " ".join(x)))
            d += 1
    return rows + [(5000, None), (5001, ""), (None, rows[0][1]), (None, "zz"), (6001, "zz"), (6002, "ZZ"), (6003, "é É"), (6004, "é É"), (6005, "é é"), rows[3], (rows[4][0], "other")]


@pytest.mark.parametrize(("gram", "percent"), [(3, 90), (5, 80)])
def test_jaccard(spark, gram, percent):
    rows = near(9) + documents(10, n=30)
    got = rows_of(jaccard.join(frame(spark, rows), gram, percent))
    assert got == sorted(brute_jaccard(rows, gram, percent), key=repr)


def test_jaccard_small_batches(spark):
    rows = near(11, 25)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    got = rows_of(jaccard.join(frame(spark, rows)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    assert got == sorted(brute_jaccard(rows), key=repr)


def test_one_per_group(spark):
    rows = [(None if k == 5 else 1000 * k + 1, t) for k, (_, t) in enumerate(near(12, 20))]
    rows += [rows[7], (rows[7][0], rows[7][1])]
    df = frame(spark, rows).withColumns({c: F.lit(1) for c in ("kept_id", "kept_text", "t", "a", "b", "row")})
    assert_one_per_group(rows, rows_of(jaccard.one_per_group(df).select("doc_id", "text")))
    assert jaccard.one_per_group(df).columns == df.columns
    assert jaccard.join(frame(spark, [])).count() == 0 and jaccard.one_per_group(frame(spark, [])).count() == 0


def test_parities_never_reject_links(spark):
    """Pairs around the limit: what the parities tell is never more than what differs."""
    r = random.Random(14)
    rows = []
    for d in range(120):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([12, 60, 200, 900]))]
        for _ in range(3):
            x = list(base)
            for _ in range(len(x) * r.choice([4, 9, 13, 17]) // 1000):
                x[r.randrange(len(x))] = f"v{r.randrange(9000)}"
            rows.append((len(rows), " ".join(x)))
    want = brute_jaccard(rows)
    assert rows_of(jaccard.join(frame(spark, rows))) == sorted(want, key=repr) and 20 < sum(d != c for d, _, c in want) < 235


def test_ids_do_not_link_texts(spark):
    """Rows without an id, and rows that repeat an id, link by their texts only."""
    text = lambda x: " ".join(f"{x}{i}" for i in range(30))
    rows = [(None, text("a")), (None, text("b")), (None, text("c")), (None, None), (3, text("a")), (4, text("b")),
            (5, text("d")), (5, text("e")), (6, text("d")), (7, text("e").upper()), (7, text("e").upper()), (8, text("f"))]
    df = frame(spark, rows)
    got = rows_of(jaccard.join(df))
    assert got == sorted([(None, 28, 3), (None, 28, 4), (None, 28, None), (None, 0, None), (3, 28, 3), (4, 28, 4), (5, 28, 5), (5, 28, 5), (6, 28, 5), (7, 28, 5), (7, 28, 5), (8, 28, 8)], key=repr)
    kept = rows_of(corpus_pipeline.near_copies(spark, df, "").select("doc_id", "text"))
    assert kept == sorted([rows[k] for k in (2, 3, 4, 5, 6, 7, 11)], key=repr)
    rows = [(1000 * k + 1, t) for k, (_, t) in enumerate(near(12, 20))]  # every id once: as with merged ids
    assert rows_of(jaccard.join(frame(spark, rows))) == sorted(brute_jaccard(rows), key=repr)


def test_components(spark):
    r = random.Random(13)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20] + [(500, 500 + i) for i in range(40)] + [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(150)] + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = rows_of(components.components(spark.createDataFrame(edges, "a long, b long"), common.scratch(spark)))
    assert got == sorted(((x, root(x)) for x in parent), key=repr)
