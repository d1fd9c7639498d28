"""Near-duplicate vectors by counting collisions of one-dimensional projections.

1. **Classes.** Equal vectors are one class; copies are counted, never paired.
2. **Blocks.** A vector's place in one of ``tables`` tables is where ``depth`` bundles of
   random projections each sort it to an extreme end: which projection of the bundle has its
   largest absolute value, and with which sign. Vectors of one place are a block. Depth
   grows with the logarithm of the number of classes, and so does the number of tables that
   keeps the recall, so that blocks of unlike vectors stay small at every size.
3. **Counts.** Within blocks, ``projections`` further projections are sorted one by one; each
   vector is the centre of a window in each order, and every pair's windows that collide are
   counted. Pairs that pass a count calibrated for the recall at the least cosine (binomial)
   are verified by their cosine in double precision. A pair that shares several tables is
   counted in the first of them only.
4. **Links.** What leaves a block is the number of links of each vector and a forest of its
   links, never the pairs. Components of the forests of all blocks name the groups.

A block of more than ``TILE`` classes is dealt into stripes by hash, and each two stripes
meet in a task, so no task holds more than two stripes and none is left out. Only vectors
whose place another class shares are ever shuffled with their components.

Recall is aimed at for pairs of exactly the least cosine, and higher above it: ``recall`` for
the tables and for the counts each (0.99: 0.98 together). Nothing below the cosine is linked.

Vectors that are null, empty or zero, or hold null or non-finite components link with
nothing, nor do vectors of different length. Rows that repeat an id are vectors of their own.
A null id counts as larger than all others; a component is named by its smallest id, or null,
and a row is kept when its id is its component's. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common, words
from cdclake.llm.components import components

COSINE, RECALL = 0.95, 0.99
#: Projections of a bundle; projections whose windows are counted; half a window in standard deviations of a linked pair.
BUNDLE, PROJECTIONS, WINDOW = 32, 32, 2.0
#: Classes of a stripe; pairs of a block counted at once.
TILE, PAIRS = 1024, 4 << 20
SEED = 20260701


def agreement(cosine: float, bundle: int = BUNDLE, trials: int = 20_000) -> float:
    """How often two vectors of this cosine lie at the same end of the same projection of a bundle."""
    r = np.random.default_rng(SEED)
    x = r.standard_normal((trials, bundle))
    y = cosine * x + math.sqrt(1 - cosine * cosine) * r.standard_normal((trials, bundle))
    a, b, i = np.abs(x).argmax(1), np.abs(y).argmax(1), np.arange(trials)
    return float(((a == b) & (x[i, a] * y[i, b] > 0)).mean())


def shape(classes: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bundles of a table, and the tables that a pair of this cosine needs to share one with this probability."""
    depth = max(1, math.ceil(math.log(max(2, classes)) / math.log(2 * BUNDLE)))
    return depth, math.ceil(math.log(1 - recall) / math.log(1 - agreement(cosine) ** depth))


def least_count(projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The most collisions that a linked pair reaches with this probability."""
    p = math.erf(window / math.sqrt(2))
    share, count = 0.0, projections
    while count > 0:
        share += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if share >= recall:
            break
        count -= 1
    return count


def _directions(dims: int, n: int, part: int) -> np.ndarray:
    return np.random.default_rng([SEED, dims, part]).standard_normal((dims, n))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) for each length of vector in a batch."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.append(0, np.cumsum(lengths))[:-1]
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[starts[rows][:, None] + np.arange(n)]


def _places(batches: Iterator[pa.RecordBatch], depth: int, tables: int) -> Iterator[pa.RecordBatch]:
    """The block of each vector in each table."""
    common.working("embed")
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        out = np.zeros((batch.num_rows, tables), np.int64)
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            for rows, x in _by_length(part.column("vector")):
                dims = x.shape[1]
                if dims not in known:
                    a = _directions(dims, tables * depth * BUNDLE, 0)
                    known[dims] = a / np.sqrt((a * a).sum(axis=0))  # a longer one would win more vectors
                p = (unit(x) @ known[dims]).reshape(len(rows), tables, depth, BUNDLE)
                end = np.abs(p).argmax(axis=3)
                code = 2 * end + (np.take_along_axis(p, end[..., None], 3)[..., 0] > 0)
                key = np.full((len(rows), tables), dims, np.uint64)
                for level in range(depth):
                    key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + code[:, :, level].astype(np.uint64) + np.uint64(1))
                out[at + rows] = key.view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, tables, dtype=np.int32)), pa.array(out.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), batch.column("vector"), lists], ["node", "n", "vector", "keys"])


def collisions(unit_of: np.ndarray, values: np.ndarray, base: np.ndarray, sizes: np.ndarray, local: np.ndarray, window: float) -> np.ndarray:
    """How many windows of each pair collide: one counter per pair of places of a unit.

    ``values`` holds a column per projection. Each is sorted once for all units, which
    are set apart by more than the values' range; a row's window is then a run of the order.
    """
    counts = np.zeros(int((sizes.astype(np.int64) ** 2).sum()), np.uint8)
    apart = 4 * (np.abs(values).max() + window) if values.size else 1.0
    for column in values.T:
        order = np.lexsort((column, unit_of))
        line = column[order] + unit_of[order] * apart
        far = np.searchsorted(line, line + window, "right") - np.arange(len(line)) - 1
        first = np.repeat(np.arange(len(line)), far)
        second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(far) - far, far)
        a, b = order[first], order[second]
        low, high = np.minimum(local[a], local[b]), np.maximum(local[a], local[b])
        counts[base[unit_of[a]] + low * sizes[unit_of[a]] + high] += 1  # each pair once in a column
    return counts


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least place that each place reaches by links."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            break
    return label


def _compared(units: list[pa.Table], cosine: float, count: int, window: float) -> pa.RecordBatch | None:
    """Links of whole units: per class their number and a root of its forest."""
    rows = pa.concat_tables(units).combine_chunks()
    node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
    table, stripe = rows["table"].to_numpy(), rows["stripe"].to_numpy()
    split = rows["one"].to_numpy() != rows["two"].to_numpy()
    sizes = np.array([u.num_rows for u in units])
    unit_of = np.repeat(np.arange(len(units)), sizes)
    starts = np.cumsum(sizes) - sizes
    local = np.arange(len(node)) - starts[unit_of]
    column = rows["vector"].chunk(0)
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)
    keys = rows["keys"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)
    u = unit(x)
    squares = sizes.astype(np.int64) ** 2
    base = np.cumsum(squares) - squares
    found = np.flatnonzero(collisions(unit_of, u @ _directions(x.shape[1], PROJECTIONS, 1), base, sizes, local, window) >= count)
    links, ends = np.zeros(len(node), np.int64), []
    for at in range(0, len(found), 1 << 17):
        pair = found[at:at + (1 << 17)]
        k = np.searchsorted(base, pair, "right") - 1
        a, b = starts[k] + (pair - base[k]) // sizes[k], starts[k] + (pair - base[k]) % sizes[k]
        own = ~split[a] | (stripe[a] != stripe[b])
        a, b = a[own], b[own]
        # The first table that both share counts the pair.
        earlier = ((keys[a] == keys[b]) & (np.arange(keys.shape[1]) < table[a][:, None])).any(axis=1)
        a, b = a[~earlier], b[~earlier]
        like = np.einsum("ij,ij->i", u[a], u[b]) >= cosine
        a, b = a[like], b[like]
        np.add.at(links, a, n[b])
        np.add.at(links, b, n[a])
        ends.append((a, b))
    if not links.any():
        return None
    root = _forest(np.concatenate([a for a, _ in ends]), np.concatenate([b for _, b in ends]), len(node))
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])], ["node", "links", "root"])


_UNIT = ["dims", "table", "key", "one", "two"]


def _blocks(batches: Iterator[pa.RecordBatch], cosine: float, count: int, window: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit; whole units of one length of vector are compared together."""
    held: list[pa.Table] = []  # rows of the unit that is still being read
    ready: list[pa.Table] = []
    last, work = None, 0

    def end_unit():
        nonlocal work
        if held:
            rows = pa.concat_tables(held)
            held.clear()
            if rows.num_rows > 1:
                ready.append(rows)
                work += rows.num_rows**2

    def compared():
        nonlocal work
        if ready:
            out = _compared(ready, cosine, count, window)
            ready.clear()
            work = 0
            if out is not None:
                yield out

    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _UNIT], axis=1)
        cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            name = tuple(names[a])
            if name != last:
                end_unit()
                if work >= PAIRS or (last is not None and last[0] != name[0]):
                    yield from compared()
                last = name
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    end_unit()
    yield from compared()


def link(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each vector."""
    spark = vectors.sparkSession
    folder = common.scratch(spark)
    v = F.col(vec_col).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(common.id_key(id_col).alias("id"), F.when(v.isNotNull() & whole, v).alias("vector"))
    rows = rows.select("id", "vector", F.xxhash64(F.lit(1), "vector").alias("h1"), F.xxhash64(F.lit(2), "vector").alias("h2"))
    full = F.col("vector").isNotNull()

    classes = rows.where(full).groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.first("vector").alias("vector"))
    classes = common.written(classes.select(F.monotonically_increasing_id().alias("node"), "*"), f"{folder}/classes")
    depth, tables = shape(classes.count(), cosine, recall)
    schema = "node long, n long, vector array<double>, keys array<long>"
    placed = common.written(classes.select("node", "n", "vector").mapInArrow(lambda b: _places(b, depth, tables), schema), f"{folder}/placed")

    # Only places that several classes share go on.
    slim = placed.select("node", F.size("vector").alias("dims"), F.posexplode("keys").alias("table", "key"))
    place = ["dims", "table", "key"]
    shared = slim.groupBy(*place).agg(F.count("*").alias("m")).where("m > 1")
    stripes = F.ceil(F.col("m") / TILE).cast("int")
    slim = slim.join(shared, place).withColumn("stripes", stripes).withColumn("stripe", F.pmod(F.xxhash64("node"), F.col("stripes")).cast("int"))
    slim = slim.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)))
    slim = slim.select("node", *place, "stripe", F.least("stripe", "other").alias("one"), F.greatest("stripe", "other").alias("two"))
    units = slim.join(placed, "node").select(*_UNIT, "stripe", "node", "n", "vector", "keys")
    units = units.repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    count, window = least_count(recall=recall), WINDOW * math.sqrt(2 - 2 * cosine)
    found = common.written(units.mapInArrow(lambda b: _blocks(b, cosine, count, window), "node long, links long, root long"), f"{folder}/links")

    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), f"{folder}/components").select(F.col("id").alias("node"), "component")
    named = classes.select("node", "h1", "h2", "n", "id").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("id").alias("least"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = named.join(least, "component").join(links, "node", "left")
    named = named.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "least")

    out = rows.where(full).select("id", "h1", "h2").join(named, ["h1", "h2"]).select("id", "n_links", "least")
    out = out.unionByName(rows.where(~full).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("least")))
    return out.select(common.id_value("id").alias("vec_id"), "n_links", common.id_value("least").alias("component_id"), (F.col("id") == F.col("least")).alias("kept"))


#: Every pair, in SQL.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
  reach(id, least) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT links.b, reach.least FROM reach JOIN links ON links.a = reach.id)
SELECT e.vec_id, CAST((SELECT count(*) FROM links WHERE a = e.vec_id) AS BIGINT) AS n_links, r.least AS component_id, e.vec_id = r.least AS kept
FROM embeddings e JOIN (SELECT id, min(least) AS least FROM reach GROUP BY id) r ON r.id = e.vec_id
"""
