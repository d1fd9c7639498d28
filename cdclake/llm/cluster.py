"""Centroid clustering in exact integers, with a vantage-point tree over the centroids.

Each component becomes floor(64 * x). The first centroids are the kept vectors with the
smallest SHA-256 of "<seed>:<id>"; each round assigns every vector to its nearest
centroid (squared Euclidean distance, ties to the smaller number) and moves each
centroid to floor(sum / count) of its vectors; empty ones stay where they are.

A tree over the centroids is rebuilt and sent to the tasks each round. An inner node has
a centroid as its vantage point and the range of distances from it on either side; leaves
hold a few centroids. Per vector the node with the least bound is opened next, until no
bound is within the best distance. The radius is inclusive, and widened by the rounding
of square roots, so a centroid at exactly the best distance is always looked at and the
smaller number wins. Distances themselves are integers. All vectors of a batch take their
steps side by side; each follows its own order of nodes.

Sums are made per task and combined by Spark, so what reaches the driver is one row per
cluster and component, whatever the number of vectors; no task holds a cluster.

Kept are vectors of exactly ``dims`` components, none null or not finite; others have no
row in the result, whatever their id. A null id is hashed as an empty text. Ties of the
hash (repeated ids) go to the lesser vector. With fewer kept vectors than centroids there
are fewer centroids, and without any there are no rows. Components of any size are exact
(beyond 2**27 in Python's integers); a distance or sum of distances that no long can hold
is null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common
from cdclake.sources.local import local_rows

K, ROUNDS, SEED, DIMS, SCALE = 16, 3, 1, 64, 64
#: Centroids of a leaf; values up to which 64-bit integers hold every sum; bits of a part of a sum.
LEAF, SMALL, PART_BITS = 3, 1 << 27, 40
#: Room for the rounding of square roots and sums in bounds.
SLACK = 1e-9
_LONGS = 2**63 - 1


class Node(NamedTuple):
    """A leaf has members and no children; bounds are the distances from the parent's vantage point."""

    members: np.ndarray  # one vantage point, or the centroids of a leaf
    inside: int
    outside: int
    low: float
    high: float


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return (d * d).sum(axis=-1)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def build(centroids: np.ndarray) -> list[Node]:
    """Nodes of the tree, the root first."""
    nodes: list[Node] = []

    def add(members: np.ndarray, low: float, high: float) -> int:
        at = len(nodes)
        nodes.append(Node(members, -1, -1, low, high))
        if len(members) > LEAF:
            # The member farthest from the first one spreads the others most.
            vantage = members[int(np.argmax(_root(_squares(centroids[members], centroids[members[0]]))))]
            rest = members[members != vantage]
            far = _root(_squares(centroids[rest], centroids[vantage]))
            order = np.argsort(far, kind="stable")
            half = len(rest) // 2
            sides = [(rest[s], far[s].min(), far[s].max()) for s in (order[:half], order[half:])]
            children = [add(*side) for side in sides]
            nodes[at] = Node(np.array([vantage]), *children, low, high)
        return at

    if len(centroids):
        add(np.arange(len(centroids)), 0.0, np.inf)
    return nodes


def nearest(tree: list[Node], centroids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row, its squared distance, and how many distances that took."""
    n = len(x)
    best, who = np.full(n, -1, x.dtype), np.zeros(n, np.int64)
    bound = np.full((n, len(tree)), np.inf)
    bound[:, 0] = 0
    rows, taken = np.arange(n), 0
    while len(rows):
        node = bound[rows].argmin(axis=1)
        low = bound[rows, node]
        unset = best[rows] < 0
        reach = np.where(unset, np.inf, _root(np.where(unset, 0, best[rows])) * (1 + SLACK) + SLACK)
        open_ = (low <= reach) & (low < np.inf)
        rows, node = rows[open_], node[open_]
        bound[rows, node] = np.inf
        for k in np.unique(node):
            at, t = rows[node == k], tree[k]
            for m in t.members:
                d = _squares(x[at], centroids[m])
                taken += len(at)
                better = (best[at] < 0) | (d < best[at]) | ((d == best[at]) & (m < who[at]))
                best[at[better]], who[at[better]] = d[better], m
            if t.inside >= 0:
                far = _root(d)
                for child in (t.inside, t.outside):
                    c = tree[child]
                    bound[at, child] = np.maximum(0, np.maximum(far - c.high, c.low - far) - SLACK * (1 + far))
    return who, best, taken


def integers(values: pa.Array, dims: int) -> np.ndarray:
    """floor(64 * x) of all components, a row per vector; of Python's integers where any is large."""
    exact = values.flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        x = np.floor(exact * SCALE).reshape(-1, dims)
    if not len(x) or np.abs(x).max() < SMALL:
        return x.astype(np.int64)
    # 64 times a double can overflow, its integer can't.
    return np.array([int(v) * SCALE if abs(v) >= 2**53 else int(np.floor(v * SCALE)) for v in exact], dtype=object).reshape(-1, dims)


def _fit(tree_centroids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Centroids in the integers that the rows are in."""
    big = x.dtype == object or tree_centroids.dtype == object
    return tree_centroids.astype(object) if big else tree_centroids


def _assigned(batch: pa.RecordBatch, tree: list[Node], centroids: np.ndarray, dims: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, 4096):
        x = integers(batch.column("vector").slice(at, 4096), dims)
        c = _fit(centroids, x)
        x = x.astype(object) if c.dtype == object else x
        who, best, _ = nearest(tree, c, x)
        yield at, x, who, best


def _parts(value: int) -> list[int]:
    """A whole number in parts of a fixed number of bits, least first, each with its sign."""
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << PART_BITS) - 1)))
        value >>= PART_BITS
    return out


def _sums(batches: Iterator[pa.RecordBatch], tree: list[Node], centroids: np.ndarray, dims: int) -> Iterator[pa.RecordBatch]:
    """Of one task: (cluster, component, part, value) of its sums; component -1 is the count."""
    common.working("cluster")
    sums = np.zeros((len(centroids), dims), object)
    counts = np.zeros(len(centroids), np.int64)
    for batch in batches:
        for _, x, who, _ in _assigned(batch, tree, centroids, dims):
            counts += np.bincount(who, minlength=len(counts))
            order = np.argsort(who, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(who[order]) > 0)) if len(order) else order
            if len(starts):
                sums[who[order][starts]] += np.add.reduceat(x[order], starts, axis=0)
    rows = [(k, -1, 0, int(n)) for k, n in enumerate(counts) if n]
    rows += [(k, j, p, v) for k, n in enumerate(counts) if n for j in range(dims) for p, v in enumerate(_parts(int(sums[k, j])))]
    cluster, component, part, value = zip(*rows) if rows else ((), (), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(component, pa.int32()), pa.array(part, pa.int32()), pa.array(value, pa.int64())],
                                     ["cluster", "component", "part", "value"])


def _moved(centroids: np.ndarray, vectors: DataFrame, dims: int) -> np.ndarray:
    """Centroids after one round; at most one row per cluster, component and part comes to the driver."""
    tree = vectors.sparkSession.sparkContext.broadcast((build(centroids), centroids))
    found = vectors.select("vector").mapInArrow(lambda b: _sums(b, *tree.value, dims), "cluster int, component int, part int, value long")
    totals: dict[tuple[int, int], int] = {}
    for r in found.groupBy("cluster", "component", "part").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        key = r["cluster"], r["component"]
        totals[key] = totals.get(key, 0) + (int(r["value"]) << (PART_BITS * r["part"]))
    tree.unpersist()
    out = [[totals.get((k, j), 0) // totals[k, -1] for j in range(dims)] if (k, -1) in totals else [int(v) for v in c] for k, c in enumerate(centroids)]
    return _array(out, dims)


def _array(rows: list[list[int]], dims: int) -> np.ndarray:
    big = any(abs(v) >= SMALL for r in rows for v in r)
    return np.array(rows, dtype=object if big else np.int64).reshape(-1, dims)


def _long(values: np.ndarray) -> pa.Array:
    if values.dtype == object:
        return pa.array([int(v) if v <= _LONGS else None for v in values], pa.int64())
    return pa.array(values, pa.int64())


def _final(batches: Iterator[pa.RecordBatch], tree: list[Node], centroids: np.ndarray, dims: int) -> Iterator[pa.RecordBatch]:
    common.working("cluster")
    for batch in batches:
        for at, x, who, best in _assigned(batch, tree, centroids, dims):
            part = batch.slice(at, len(x))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(who.astype(np.int32)), _long(best)], ["id", "cluster", "distance"])


def kept(vectors: DataFrame, dims: int = DIMS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vector) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where((F.size(v) == dims) & finite).select(F.col(id_col).cast("long").alias("id"), v.alias("vector"))


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS) -> np.ndarray:
    """Centroids after all rounds, from a table (id, vector)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()  # k rows
    chosen = pa.array([list(r["vector"]) for r in first], pa.list_(pa.float64()))
    centroids = integers(chosen, dims) if first else np.zeros((0, dims), np.int64)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(centroids, vectors, dims)
    return centroids


def cluster(
    vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each kept vector."""
    spark = vectors.sparkSession
    folder = common.scratch(spark)
    rows = common.written(kept(vectors, dims, id_col, vec_col), f"{folder}/kept")
    centroids = fit(rows, k, rounds, seed, dims)
    tree = spark.sparkContext.broadcast((build(centroids), centroids))
    found = common.written(rows.mapInArrow(lambda b: _final(b, *tree.value, dims), "id long, cluster int, distance long"), f"{folder}/assigned")
    # One row per cluster.
    per = {r["cluster"]: int(r["sum"]) if r["n"] == r["known"] and r["sum"] <= _LONGS else None for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("n"), F.count("distance").alias("known")).collect()}
    total = sum(per.values()) if None not in per.values() else None
    total = total if total is not None and total <= _LONGS else None
    digest = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    about = local_rows(spark, [dict(cluster=c, cluster_inertia=per[c], centroid_sha256=digest[c]) for c in sorted(per)], "cluster int, cluster_inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(about), "cluster")  # k rows at most
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


#: The same in SQL: every vector against every centroid, one step per round.
def oracle(k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS) -> str:
    def assigned(step: int) -> str:
        return f"""
      d{step} AS (SELECT v.vec_id, c.cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
        FROM comps v JOIN c{step} c USING (i) GROUP BY ALL),
      a{step} AS MATERIALIZED (SELECT vec_id, cluster, distance FROM d{step} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""

    steps = []
    for r in range(rounds):
        steps.append(assigned(r) + f""",
      m{r} AS (SELECT cluster, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM a{r} JOIN comps USING (vec_id) GROUP BY ALL),
      c{r + 1} AS MATERIALIZED (SELECT c.cluster, c.i, CASE WHEN n IS NULL THEN c.x WHEN s >= 0 THEN CAST(s // n AS BIGINT) ELSE CAST(-((n - 1 - s) // n) AS BIGINT) END AS x
        FROM c{r} c LEFT JOIN m{r} USING (cluster, i))""")
    return f"""
    WITH kept AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {dims}
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
      comps AS MATERIALIZED (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM kept),
      first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster FROM kept QUALIFY cluster < {k}),
      c0 AS MATERIALIZED (SELECT cluster, i, x FROM first JOIN comps USING (vec_id)),
      {','.join(steps)},
      {assigned(rounds)},
      s AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
    SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
      CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM a{rounds} JOIN s USING (cluster)"""
