"""Trie of conversation prefixes by fixed-length block hashing.

Every conversation is rebuilt first: the first h turns of the conversation that begins its
group of ``GROUP``, then its own turns after its first h (h = crc32 of the decimal id,
modulo ``BORROWED``). Turns are in order of turn (null first), then role, then the turn's
digest; null roles and texts are empty.

1. **Blocks.** A conversation's turns are cut into blocks of ``BLOCK`` turns. A turn's key
   digests all turns up to it, so the last key of a block digests the blocks so far. The
   last block holds what is left, and may be empty.
2. **Groups.** Conversations are grouped by the last keys of their blocks: conversations
   with equal blocks are one class, combined before the shuffle. From here on work follows
   classes, not conversations.
3. **Boundaries.** Where one class alone follows a block, its turns are nodes as they stand.
   Only where siblings diverge are classes cut at turn boundaries and grouped by key.
4. **Subtrees.** Each leaf has the path of its smallest conversation, so leaf paths are no
   longer than the input. A node is owned by the smallest of the leaf paths through it;
   what a path owns is its lower end. A node's sum is then what its owner owns at or below
   it, and all that the other leaf paths through it own: no ancestor is paired with a node.
5. **Ends.** Ids of the conversations that end at a node are hashed as a sorted stream.

A common first turn, or one conversation copied in a third of the table, is one class per
block; its ids meet again only in the stream of ends, which keeps one hash state. A
conversation's turns are chained as a stream, too. Texts are never shuffled, only their
digests and numbers of words.

Rows without a conv_id belong to no conversation. Repeated rows are turns of their own. A
conversation that has no turn left is a member of the root and ends there. Without any
conversation there is no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm import common
from cdclake.sources.local import local_rows

BLOCK, GROUP, BORROWED = 4, 20, 4
ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a batch that tasks give out.
ROWS = 4096


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, words) of each turn; the digest is of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    own = conversations.where("conv_id is not null")
    return own.select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def rebuilt(own: DataFrame, group: int = GROUP, borrowed: int = BORROWED) -> DataFrame:
    """Turns of the rebuilt conversations: the borrowed ones (place 0 and on), and all own ones, of which the first ``skip`` don't count."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    skip = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(borrowed)).cast("int")
    first = own.withColumn("place", F.row_number().over(Window.partitionBy("conv").orderBy(*order)) - 1).where(F.col("place") < borrowed - 1)
    wanting = own.select("conv").distinct().select("conv", skip.alias("skip"), (F.col("conv") - F.col("conv") % group).alias("base"))
    given = wanting.join(first.select(F.col("conv").alias("base"), "place", "digest", "words"), "base").where("place < skip")
    given = given.select("conv", F.lit(False).alias("own"), F.lit(0).alias("skip"), F.col("place").cast("long").alias("turn"), F.lit("").alias("role"), "digest", "words")
    return given.unionByName(own.select("conv", F.lit(True).alias("own"), skip.alias("skip"), F.col("turn").cast("long").alias("turn"), "role", "digest", "words"))


def _chained(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the conversations, from their turns in order."""
    common.working("trie")
    out: list[tuple] = []
    conv, key, left, at, keys, words = None, ROOT, 0, 0, [], []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["conv", "start", "prefix", "last", "keys", "words"])

    prefix = ROOT
    for batch in batches:
        for c, own, skip, digest, n in zip(*(batch.column(x).to_pylist() for x in ("conv", "own", "skip", "digest", "words"))):
            if c != conv:
                if conv is not None:
                    out.append((conv, at - len(keys), prefix, True, keys, words))
                conv, key, prefix, left, at, keys, words = c, ROOT, ROOT, None, 0, [], []
            if own:
                left = skip if left is None else left
                if left:
                    left -= 1
                    continue
            key = hashlib.blake2b(key + digest, digest_size=16).digest()
            keys.append(key)
            words.append(n)
            at += 1
            if len(keys) == block:
                out.append((conv, at - block, prefix, False, keys, words))
                prefix, keys, words = key, [], []
            if len(out) >= ROWS:
                yield batch_of(out)
                out = []
    if conv is not None:
        out.append((conv, at - len(keys), prefix, True, keys, words))
    if out:
        yield batch_of(out)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the joined ids of each key, from rows sorted by key and id."""
    key, state, done = None, None, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.binary()), pa.array([s for _, s in rows])], ["key", "ends_sha256"])

    for batch in batches:
        if not batch.num_rows:
            continue
        column, ids = batch.column("key"), batch.column("conv").to_numpy()
        names = np.array(column.to_pylist(), dtype=object)
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            joined = ",".join(map(str, ids[a:b].tolist())).encode()
            if names[a] == key:
                state.update(b"," + joined)
                continue
            if key is not None:
                done.append((key, state.hexdigest()))
            key, state = names[a], hashlib.sha256(joined)
        if len(done) >= ROWS:
            yield batch_of(done)
            done = []
    if key is not None:
        done.append((key, state.hexdigest()))
    if done:
        yield batch_of(done)


def _boundaries(classes: DataFrame) -> DataFrame:
    """The turn boundaries of classes of blocks: (key, depth, parent, n, conv, words)."""
    cut = classes.select("n", "conv", "prefix", "start", "keys", F.posexplode("keys").alias("at", "key"), "words")
    return cut.select(
        "key", (F.col("start") + F.col("at") + 1).alias("depth"), F.when(F.col("at") == 0, F.col("prefix")).otherwise(F.try_element_at("keys", F.col("at"))).alias("parent"),
        "n", "conv", F.element_at("words", F.col("at") + 1).alias("words"))


def nodes_of(blocks: DataFrame) -> DataFrame:
    """All nodes below the root, each once."""
    full = blocks.where(F.size("keys") > 0).withColumn("key", F.element_at("keys", -1))
    classes = full.groupBy("key").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("prefix").alias("prefix"), F.first("start").alias("start"), F.first("keys").alias("keys"), F.first("words").alias("words"))
    # A prefix that one class alone follows: none of its boundaries is shared.
    alone = classes.groupBy("prefix").agg(F.count("*").alias("m"), F.first(F.struct("key", "n", "conv", "start", "keys", "words")).alias("c")).where("m = 1")
    settled = _boundaries(alone.select("prefix", "c.*"))
    diverged = _boundaries(classes.join(alone.select("c.key"), "key", "left_anti"))
    diverged = diverged.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.sum("n").alias("n"), F.min("conv").alias("conv"), F.first("words").alias("words"))
    return settled.unionByName(diverged)


def trie(conversations: DataFrame, block: int = BLOCK, group: int = GROUP, borrowed: int = BORROWED) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    folder = common.scratch(spark)
    rows = rebuilt(turns(conversations), group, borrowed)
    rows = rows.repartition("conv").sortWithinPartitions("conv", "own", F.col("turn").asc_nulls_first(), "role", "digest").select("conv", "own", "skip", "digest", "words")
    schema = "conv long, start long, prefix binary, last boolean, keys array<binary>, words array<long>"
    blocks = common.written(rows.mapInArrow(lambda b: _chained(b, block), schema), f"{folder}/blocks")
    nodes = common.written(nodes_of(blocks), f"{folder}/nodes")
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))

    # Leaf paths, and what each owns.
    leaves = nodes.join(children, "key", "left_anti").select("conv")
    paths = common.written(blocks.join(leaves, "conv").select(F.col("conv").alias("rep"), F.explode("keys").alias("key")), f"{folder}/paths")
    seen = paths.groupBy("key").agg(F.count("*").alias("n_leaves"), F.min("rep").alias("owner"))
    owned = nodes.join(seen, "key").select("key", "n_leaves", "owner", "depth", ((F.col("n") - 1) * F.col("words")).alias("saved"))
    below = Window.partitionBy("owner").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = common.written(owned.withColumn("below", F.sum("saved").over(below)), f"{folder}/owned")
    totals = common.written(owned.groupBy("owner").agg(F.sum("saved").alias("total")), f"{folder}/totals")
    through = paths.join(totals.withColumnRenamed("owner", "rep"), "rep").groupBy("key").agg(F.sum("total").alias("through"))
    sums = owned.join(totals, "owner").join(through, "key").select("key", "n_leaves", (F.col("below") + F.col("through") - F.col("total")).alias("saved_tokens"))

    ends = blocks.where("last").select(F.when(F.size("keys") > 0, F.element_at("keys", -1)).otherwise(F.col("prefix")).alias("key"), "conv")
    ends = ends.repartition("key").sortWithinPartitions("key", "conv").mapInArrow(_ends, "key binary, ends_sha256 string")

    # The root is a row of totals: nothing is joined with all there is.
    whole = blocks.where("last").agg(F.count("*").alias("n"), F.min("conv").alias("conv")).first()
    if not whole["n"]:
        roots = []
    else:
        n_children = nodes.where(F.col("parent") == F.lit(ROOT)).count()
        roots = [dict(depth=0, n=whole["n"], conv=whole["conv"], n_leaves=leaves.count() if n_children else 1,
                      saved_tokens=totals.agg(F.sum("total")).first()[0] or 0)]
    root = local_rows(spark, roots, "depth long, n long, conv long, n_leaves long, saved_tokens long")
    root = root.select("*", F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"))
    every = nodes.drop("words").join(sums, "key").unionByName(root).join(children, "key", "left").join(ends, "key", "left")
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    top = F.when(F.col("parent") == F.lit(ROOT), F.lit(whole["conv"]).cast("long"))
    return every.join(parents, "parent", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce("parent_conv", top).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


_TURN = "sha256(length(role) || ':' || role || txt)"
#: The same in SQL: prefixes as joined digests, subtrees by all pairs of a node and its ancestors.
ORACLE = rf"""
WITH t AS (SELECT c, role, txt, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, {_TURN}) - 1 AS rn
    FROM (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt FROM conversations WHERE conv_id IS NOT NULL)),
  convs AS (SELECT c, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda acc, b: list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(acc, b)), 4294967295), 4294967295) % {BORROWED} AS h
    FROM (SELECT DISTINCT c FROM t)),
  rebuilt AS (SELECT convs.c, 0 AS own, rn, role, txt FROM convs JOIN t ON t.c = convs.c - convs.c % {GROUP} AND rn < h
    UNION ALL SELECT c, 1, rn, role, txt FROM convs JOIN t USING (c) WHERE rn >= h),
  seq AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, rn) AS d, {_TURN} AS dig, len(regexp_extract_all(txt, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt),
  path AS MATERIALIZED (SELECT c, d, string_agg(dig, '') OVER (PARTITION BY c ORDER BY d) AS key, words FROM seq UNION ALL SELECT c, 0, '', 0 FROM convs),
  nodes AS MATERIALIZED (SELECT key, d, min(c) AS conv_id, count(*) AS n, any_value(words) AS w, if(d = 0, NULL, left(key, 64 * (d - 1))) AS parent FROM path GROUP BY key, d),
  kids AS (SELECT parent AS key, count(*) AS n_children FROM nodes GROUP BY parent),
  sums AS (SELECT p.key, sum((n - 1) * w) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
    FROM nodes LEFT JOIN kids USING (key) JOIN path p ON p.c = nodes.conv_id AND p.d <= nodes.d GROUP BY p.key),
  ends AS (SELECT key, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha FROM (SELECT c, arg_max(key, d) AS key FROM path GROUP BY c) GROUP BY key)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.key LEFT JOIN kids ON n.key = kids.key JOIN sums ON n.key = sums.key LEFT JOIN ends ON n.key = ends.key
"""
