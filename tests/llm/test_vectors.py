import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdclake.llm import cluster, embed
from tests.llm.cases import rows_of

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, parts=3, kind="float"):
    """(vec_id, embedding) rows with other columns, some named like those that operators make."""
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(parts)
    return df.select("vec_id", "embedding", *(F.lit(1).alias(c) for c in ("label", "id", "node", "n", "key", "keys", "vector", "cluster", "distance", "row")))


def floats(x):
    return [float(v) for v in np.float32(x)]


def brute_links(rows, cosine=0.95):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    big = 2**63 - 1
    ids = [big if i is None else i for i, _ in rows]
    ok = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for length in {len(rows[k][1]) for k in ok}:
        at = [k for k in ok if len(rows[k][1]) == length]
        u = embed.unit(np.array([rows[k][1] for k in at], np.float64))
        for p, q in zip(*np.nonzero(np.triu(u @ u.T >= cosine, 1))):
            a, b = at[p], at[q]
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    least = {}
    for k in range(len(rows)):
        least[root(k)] = min(least.get(root(k), big + 1), ids[k])
    return [(i, links[k], None if least[root(k)] == big else least[root(k)], ids[k] == least[root(k)]) for k, (i, _) in enumerate(rows)]


def groups_of(seed, dims=64, groups=60, noise=(0.0, 0.05, 0.1, 0.2)):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = r.standard_normal(dims)
        s = r.choice(noise)
        for _ in range(r.choice([1, 1, 2, 5, 30])):
            rows.append((len(rows) * 7 % 100003, floats(centre + s * r.standard_normal(dims))))
    return rows


ODD = [(900001, None), (900002, []), (900003, [0.0] * 64), (900004, [1.0, None] * 32), (900005, [1.0, NAN] * 32), (900006, [INF] + [1.0] * 63),
       (900007, [1.0, 2.0]), (900008, [2.0, 4.0]), (None, [5.0, 1.0]), (None, [5.0, 1.0]), (900009, [1.0]), (900010, [3.0]), (900011, [-3.0]), (900012, [0.0, 0.0])]


def test_links_are_those_of_all_pairs(spark):
    rows = groups_of(1) + ODD
    rows += [rows[5], rows[5], (rows[6][0], rows[9][1])]
    want = sorted(brute_links(rows), key=repr)
    got = rows_of(embed.link(frame(spark, rows)))
    assert sum(r[1] > 0 for r in want) > 300 and len(got) == len(want)
    # Pairs near the least cosine may be missed; none is made up.
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sum(min(a[1], b[1]) for a, b in zip(got, want)) >= 0.98 * sum(r[1] for r in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want))


def test_links_of_clear_copies_are_exact(spark, monkeypatch):
    """Near copies well above the least cosine; stripes of few classes, groups of few pairs."""
    rows = groups_of(2, groups=40, noise=(0.0, 0.02, 0.05)) + ODD
    want = sorted(brute_links(rows), key=repr)
    assert rows_of(embed.link(frame(spark, rows))) == want
    monkeypatch.setattr(embed, "TILE", 4)
    monkeypatch.setattr(embed, "PAIRS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    got = rows_of(embed.link(frame(spark, rows)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    assert got == want


def test_recall_at_the_least_cosine(spark):
    """Pairs of a cosine just above the least one: the calibrated count and tables find nearly all."""
    r = np.random.default_rng(3)
    rows = []
    for k in range(1500):
        a, b = r.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        c = 0.9502
        rows += [(2 * k, [float(x) for x in a]), (2 * k + 1, [float(x) for x in c * a + np.sqrt(1 - c * c) * b])]
    got = embed.link(frame(spark, rows, kind="double")).agg(F.sum("n_links")).first()[0]
    assert 0.95 * 3000 <= got <= 3000


def test_links_of_no_rows(spark):
    assert embed.link(frame(spark, [])).count() == 0
    assert rows_of(embed.link(frame(spark, ODD[:2]))) == [(900001, 0, 900001, True), (900002, 0, 900002, True)]
    tiny = [(1, [1e-300] * 64), (2, [1e300] * 64), (3, [-1e300] * 64), (4, [5e-324] * 64)]
    assert rows_of(embed.link(frame(spark, tiny, kind="double"))) == [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 2, 1, False)]


def test_windows_count_collisions():
    r = np.random.default_rng(4)
    unit_of = np.repeat([0, 1, 2], [5, 1, 9])
    sizes, local = np.array([5, 1, 9]), np.concatenate([np.arange(5), [0], np.arange(9)])
    values = r.standard_normal((15, 6))
    got = embed.collisions(unit_of, values, np.array([0, 25, 26]), sizes, local, 0.7)
    for u, (at, n, base) in enumerate(((0, 5, 0), (5, 1, 25), (6, 9, 26))):
        for i in range(n):
            for j in range(n):
                want = (abs(values[at + i] - values[at + j]) <= 0.7).sum() if i < j else 0
                assert got[base + i * n + j] == want
    assert embed.least_count() < embed.PROJECTIONS and embed.shape(10**9)[0] > embed.shape(10**4)[0]


def brute_clusters(rows, k=16, rounds=3, seed=1, dims=64):
    own = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(own, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, x)), n) for n, x in enumerate(c)) for _, v in own]

    for _ in range(rounds):
        at = assigned()
        for n in range(len(c)):
            mine = [v for (_, v), (_, m) in zip(own, at) if m == n]
            if mine:
                c[n] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assigned()
    total = sum(d for d, _ in at)
    per = {n: sum(d for d, m in at if m == n) for n in range(len(c))}
    fit = lambda x: x if x < 2**63 else None
    return [(i, n, fit(d), fit(per[n]), fit(total), hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(own, at)]


@pytest.mark.parametrize("k", [16, 3, 1])
def test_clusters(spark, k):
    rows = groups_of(5, groups=30, noise=(0.0, 0.3)) + ODD
    rows += [rows[3], rows[3], (None, rows[8][1]), (None, rows[20][1])]
    assert rows_of(cluster.cluster(frame(spark, rows), k)) == sorted(brute_clusters(rows, k), key=repr)


def test_clusters_of_few_equal_and_large_vectors(spark):
    r = random.Random(6)
    same = [(i, [0.25] * 64) for i in range(40)]  # all centroids are equal: the smallest number takes all
    assert rows_of(cluster.cluster(frame(spark, same))) == sorted(brute_clusters(same), key=repr)
    few = [(i, [r.uniform(-1, 1) for _ in range(64)]) for i in range(3)]
    assert rows_of(cluster.cluster(frame(spark, few, kind="double"))) == sorted(brute_clusters(few), key=repr)
    large = few + [(9, [3e7 * (-1) ** i for i in range(64)]), (10, [2.5e7] * 64), (11, [1e30] + [0.0] * 63)] + [(20 + i, [r.uniform(-9, 9) for _ in range(64)]) for i in range(30)]
    got = rows_of(cluster.cluster(frame(spark, large, kind="double"), 4))
    assert got == sorted(brute_clusters(large, 4), key=repr)
    assert cluster.cluster(frame(spark, [])).count() == 0 and cluster.cluster(frame(spark, ODD[:4])).count() == 1


def test_tree_prunes_and_keeps_ties():
    r = np.random.default_rng(7)
    for k in (1, 2, 3, 4, 5, 16, 200):
        c = np.repeat(r.integers(-3, 4, (max(1, k // 2), 8)), 2, axis=0)[:k] if k < 200 else r.integers(-900, 900, (k, 8))
        x = np.concatenate([r.integers(-4, 5, (300, 8)), c])
        tree = cluster.build(c)
        who, best, taken = cluster.nearest(tree, c, x)
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (who == d.argmin(1)).all() and (best == d.min(1)).all()
        if k == 200:
            assert taken < 0.9 * len(x) * k
    assert cluster._parts(-(2**130) - 5) == [-5, 0, 0, -(2**10)]
    assert cluster.integers(pa.array([[1.5, -0.001]], pa.list_(pa.float64())), 2).tolist() == [[96, -1]]
