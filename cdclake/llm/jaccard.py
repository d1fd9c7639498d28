"""Similar documents by Jaccard over word n-grams, with a token-group matrix.

A document's set is its distinct ``gram``-word shingles, as 64-bit hashes. Two link when
100 * common >= percent * union. The result has no pairs of a group of copies, but no
link between different sets is lost: components are exact.

1. **Classes.** Documents with equal sets are one class, of which one text goes on. The
   graph's nodes are the classes; ids are attached to its components afterwards.
2. **Order.** All tokens have one order: rare before frequent, by a sketch of fixed size
   that counts tokens by bucket, then by hash. The sketch only decides how much work
   there is. Sets that link have a token in common among the first (1 - percent/100) of
   each, so only these are shuffled, and tokens that no two classes share go at once.
3. **Groups.** Along each token the other documents are compared with ``LEADERS`` leaders; the
   links that hold partition the documents into groups of similar ones. Where opening
   what is left would take over ``WORK`` pairs per row, other leaders follow.
4. **Matrix.** The union of a group's tokens is stored per set size: (token, group, size,
   best position). For a query group and another, a shared token bounds the overlap of
   any two members by what follows its position in both; only group pairs that can still
   qualify are opened, and only members within the bound become pairs.
5. **Parities.** Every set has ``8 * 64`` bits, each the parity of the tokens that fall on
   it. A token in one of two sets alone flips one bit, so the bits in which they differ are
   no more than the tokens in which they do. A group has the bits that any and that all of
   its members have, which bound all its pairs with another group at once. The joins take no
   pair that differs in too many: near copies that just don't link, and texts that share a
   passage only, are never rows, however many there are. Of two groups that are opened the
   smaller one's members come first. What is left is compared by first tokens, then by texts.
6. The links of all steps give the components. Once their ids are written, the tables of all
   steps are deleted.

Ids: rows are linked by their texts alone, so rows that repeat an id, or have none, link as
their texts do. A null id counts as larger than all others; a component is named by its
smallest id, or null. Texts without words have an empty set and no link. Repeated rows are in
one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdclake.llm import common, words
from cdclake.llm.components import components
from cdclake.sources import storage

GRAM, PERCENT = 3, 90
#: Buckets of the frequency sketch, and the share of documents from which a token is called frequent.
SKETCH_BITS, FREQUENT = 20, 1 / 4000
#: Member pairs that may be opened per row of shared tokens before more leaders are tried.
WORK = 4
#: Leaders of a token in one round.
LEADERS = 8
#: Words of a set's parities.
PARITIES = 8


def shingles(data: np.ndarray, offsets: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of all texts, by text and hash."""
    w = words.split(words.LOWER[data], offsets)
    hashes, at = words.grams(w, gram)
    text = w.text[at]
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < gram))
    if len(short):
        hashes = np.append(hashes, words.range_hashes(w.hashes, w.first[short], w.first[short + 1]))
        text = np.append(text, short)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Sketch of one task: counts of the buckets in which the task has frequent tokens."""
    common.working("jaccard")
    counts, docs = np.zeros(1 << SKETCH_BITS, np.int64), 0
    for batch in batches:
        for part in common.slices(batch):
            counts += np.bincount(_bucket(shingles(*common.utf8(part.column("text")), gram)[1]), minlength=len(counts))
            docs += part.num_rows
    some = np.flatnonzero(counts >= max(8, counts.mean() * 2, docs * FREQUENT))
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["bucket", "n"])


def frequent(docs: DataFrame, gram: int) -> np.ndarray:
    """How frequent each bucket's tokens are: 0 for most, else 1 + the binary logarithm of the count. One byte a bucket."""
    found = docs.select("text").mapInArrow(lambda b: _counted(b, gram), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    levels = found.select("bucket", (1 + F.floor(F.log2("n"))).cast("byte").alias("level")).toArrow()  # 2**SKETCH_BITS rows at most
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    out[levels["bucket"].to_numpy()] = levels["level"].to_numpy()
    return out


def _set_rows(batches: Iterator[pa.RecordBatch], gram: int, percent: int, level: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per text: size and digest of its set, and its first tokens in the common order."""
    for batch in batches:
        for part in common.slices(batch):
            text, tokens = shingles(*common.utf8(part.column("text")), gram)
            m = part.num_rows
            first = np.searchsorted(text, np.arange(m + 1))
            n = np.diff(first)
            full = np.flatnonzero(n)
            one, two = np.zeros(m, np.uint64), np.zeros(m, np.uint64)
            if len(full):
                one[full] = np.add.reduceat(words.mix(tokens), first[full])
                two[full] = np.add.reduceat(words.mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first[full])
            bit = text * (64 * PARITIES) + (words.mix(tokens ^ np.uint64(0x5BD1E995)) & np.uint64(64 * PARITIES - 1)).astype(np.int64)
            odd = (np.bincount(bit, minlength=m * 64 * PARITIES) & 1).astype(np.uint8)
            bits = pa.FixedSizeListArray.from_arrays(pa.array(np.packbits(odd, bitorder="little").view(np.int64)), PARITIES).cast(pa.list_(pa.int64()))
            order = np.lexsort((tokens, level[_bucket(tokens)], text))
            take = n - (percent * n + 99) // 100 + (n > 0)
            place = np.arange(len(text)) - np.repeat(first[:-1], n)
            chosen = tokens[order][place < np.repeat(take, n)].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(take)).astype(np.int32)), pa.array(chosen))
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("t"), pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), lists, bits], ["id", "t", "n", "h1", "h2", "tokens", "bits"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted tokens that occur more than once; one row is held back between batches."""
    held: pa.RecordBatch | None = None  # the last row, if its token hasn't been seen twice yet
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        token = batch.column("token").to_numpy()
        same = token[1:] == token[:-1]
        twice = np.zeros(len(token), bool)
        twice[1:] |= same
        twice[:-1] |= same
        if last is not None and token[0] == last:
            twice[0] = True
            if held is not None:
                yield held
        held = None if twice[-1] else batch.slice(batch.num_rows - 1)
        last = token[-1]
        if twice.any():
            yield batch.filter(pa.array(twice))


def _verified(batches: Iterator[pa.RecordBatch], gram: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) that link, from rows with both texts."""
    for batch in batches:
        for outer in common.slices(batch, "text_a"):
            for part in common.slices(outer, "text_b"):
                ta, a = shingles(*common.utf8(part.column("text_a")), gram)
                tb, b = shingles(*common.utf8(part.column("text_b")), gram)
                row, token = np.concatenate([ta, tb]), np.concatenate([a, b])
                order = np.lexsort((token, row))
                row, token = row[order], token[order]
                common_ = np.bincount(row[1:][(row[1:] == row[:-1]) & (token[1:] == token[:-1])], minlength=part.num_rows)
                union = np.bincount(row, minlength=part.num_rows) - common_
                yield part.select(["a", "b"]).filter(pa.array((100 * common_ >= percent * union) & (union > 0)))


def _can_link(n1: Column, p1: Column, n2: Column, p2: Column, percent: int) -> Column:
    """Whether sets of these sizes can link if their first common token has these positions."""
    most = F.least(n1 - p1, n2 - p2)
    return (most * (100 + percent) >= percent * (n1 + n2)) & (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))


def _near(any1: Column, all1: Column, n1: Column, any2: Column, all2: Column, n2: Column, percent: int) -> Column:
    """Whether sets of two groups can link by their parities: of sets that link, no more tokens are in one alone."""
    word = lambda c, k: F.get(c, F.lit(k))
    sure = [word(all1, k).bitwiseAND(F.bitwise_not(word(any2, k))).bitwiseOR(word(all2, k).bitwiseAND(F.bitwise_not(word(any1, k)))) for k in range(PARITIES)]
    return sum((F.bit_count(x) for x in sure), F.lit(0)) * (100 + percent) <= (100 - percent) * (n1 + n2)


def _pairs(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    pairs = pairs.distinct()
    return pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")


def _work(placed: DataFrame) -> int:
    """Pairs of rows that share a token but no group, counted without making them."""
    per = placed.groupBy("token", "g").agg(F.count("*").alias("m")).groupBy("token").agg(F.sum("m").alias("s"), F.sum(F.col("m") * F.col("m")).alias("q"))
    return per.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0] or 0


def _opened(placed: DataFrame, heads: DataFrame, percent: int, folder: str) -> DataFrame:
    """Member pairs (a, b) of the group pairs that the matrix leaves."""
    c = F.col
    several = placed.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("token")
    members = placed.join(several, "token").join(heads.select("id", "bits"), "id")
    members = common.written(members.select("token", "g", "n", "id", "pos", "bits"), f"{folder}/members")
    bits = [F.get("bits", F.lit(k)) for k in range(PARITIES)]
    matrix = members.groupBy("token", "g", "n").agg(
        F.min("pos").alias("pos"), F.count("*").alias("m"), F.array(*[F.bit_or(b) for b in bits]).alias("any"), F.array(*[F.bit_and(b) for b in bits]).alias("all"))
    # In a group of one any is all.
    matrix = common.written(matrix.withColumn("all", F.when(c("m") > 1, c("all"))), f"{folder}/matrix")
    one, two = (matrix.withColumn("all", F.coalesce("all", "any")).alias(x) for x in "xy")
    open_ = one.join(two, (c("x.token") == c("y.token")) & (c("x.g") < c("y.g")) & _can_link(c("x.n"), c("x.pos"), c("y.n"), c("y.pos"), percent)
                     & _near(c("x.any"), c("x.all"), c("x.n"), c("y.any"), c("y.all"), c("y.n"), percent))
    small = c("x.m") <= c("y.m")
    open_ = open_.select(c("x.token").alias("token"), *[F.when(when, c(f"x.{k}")).otherwise(c(f"y.{k}")).alias(f"{k}{i}") for i, when in ((1, small), (2, ~small)) for k in "gn"])
    left = members.select("token", c("g").alias("g1"), c("n").alias("n1"), c("id").alias("a"), c("pos").alias("p1"), c("bits").alias("bits1"))
    right = members.select("token", c("g").alias("g2"), c("n").alias("n2"), c("id").alias("b"), c("pos").alias("p2"), c("bits").alias("bits2"))
    half = open_.join(left, ["token", "g1", "n1"]).alias("l")
    on = [c(f"l.{k}") == c(f"r.{k}") for k in ("token", "g2", "n2")]
    fit = _can_link(c("l.n1"), c("p1"), c("r.n2"), c("p2"), percent) & _near(c("bits1"), c("bits1"), c("l.n1"), c("bits2"), c("bits2"), c("r.n2"), percent)
    return half.join(right.alias("r"), [*on, fit]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _links(pairs: DataFrame, heads: DataFrame, texts: DataFrame, gram: int, percent: int, folder: str) -> DataFrame:
    """The pairs (a, b) that link. Their first tokens bound the overlap: of two sets, the one whose
    last first-token comes earlier has all of its common tokens among those, or behind them."""
    for side in ("a", "b"):
        pairs = pairs.join(heads.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("tokens").alias(f"t_{side}"), F.col("bits").alias(f"bits_{side}")), side)
    n_a, n_b = F.col("n_a"), F.col("n_b")
    most = F.size(F.array_intersect("t_a", "t_b")) + F.greatest(n_a - F.size("t_a"), n_b - F.size("t_b"))
    fit = _near(F.col("bits_a"), F.col("bits_a"), n_a, F.col("bits_b"), F.col("bits_b"), n_b, percent) & (most * (100 + percent) >= percent * (n_a + n_b)) & (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
    pairs = common.written(pairs.where(fit).select("a", "b").distinct(), f"{folder}/bounded")
    with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
    return common.written(with_b.mapInArrow(lambda x: _verified(x, gram, percent), "a long, b long"), f"{folder}/verified")


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _linked(docs: DataFrame, gram: int, percent: int, id_col: str, text_col: str, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The set of each row (id, t, n, h1, h2; ``t`` is the text's hash), the classes (node, h1, h2, n,
    and id and t of their first row), and the links (a, b) between nodes."""
    spark = docs.sparkSession
    common.small_batches(spark)
    own = docs.select(common.id_key(id_col).alias("id"), _text(text_col).alias("text")).withColumn("t", F.xxhash64("text"))
    level = spark.sparkContext.broadcast(frequent(own, gram))
    sets = common.written(own.mapInArrow(lambda b: _set_rows(b, gram, percent, level.value), "id long, t long, n long, h1 long, h2 long, tokens array<long>, bits array<long>"), f"{folder}/sets")

    # Classes of equal sets; their members need no comparison. Nodes are numbered once, as the table is written.
    classes = sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "t", "tokens", "bits")).alias("first"))
    classes = common.written(classes.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "n", "first.*"), f"{folder}/classes")

    # First tokens that two or more classes share.
    nodes = classes.select(F.col("node").alias("id"), "n", "tokens", "bits")
    rows = nodes.select("id", "n", F.posexplode("tokens").alias("pos", "token"))
    shared = rows.repartition("token").sortWithinPartitions("token").mapInArrow(_shared, "id long, n long, pos int, token long")
    shared = common.written(shared, f"{folder}/shared")
    ids = shared.select("id").distinct()
    firsts = classes.join(ids.withColumnRenamed("id", "node"), "node", "left_semi").select("node", "id", "t")
    texts = common.written(own.join(firsts, ["id", "t"]).select(F.col("node").alias("id"), "text"), f"{folder}/texts")
    heads = common.written(nodes.join(ids, "id", "left_semi"), f"{folder}/heads")

    # Groups: along each token, all against a few leaders; other leaders where too much would be left to open.
    links, tried, step, before = None, None, 0, float("inf")
    placed = shared.withColumn("g", F.col("id"))
    while True:
        at = f"{folder}/{step}"
        by = [F.col("id") if not (step or k) else F.xxhash64("id", F.lit(step * LEADERS + k)) for k in range(LEADERS)]
        leaders = placed.groupBy("token").agg(*[F.min(F.struct(x.alias("by"), "id", "n", "pos", "g")).alias(f"l{k}") for k, x in enumerate(by)])
        leaders = leaders.select("token", F.explode(F.array_distinct(F.array(*[F.col(f"l{k}").dropFields("by") for k in range(LEADERS)]))).alias("l"))
        stars = placed.join(leaders, "token").where((F.col("g") != F.col("l.g")) & _can_link(F.col("n"), F.col("pos"), F.col("l.n"), F.col("l.pos"), percent))
        stars = _pairs(stars.select(F.least("l.id", "id").alias("a"), F.greatest("l.id", "id").alias("b")), tried)
        stars = common.written(stars, f"{at}/stars")
        found = _links(stars, heads, texts, gram, percent, at)
        some = found.limit(1).count()
        links = found if links is None else common.written(links.unionByName(found), f"{at}/links")
        tried = stars if tried is None else common.written(tried.unionByName(stars), f"{at}/tried")
        placed = shared.join(components(links, f"{at}/groups"), "id", "left").select("token", "id", "n", "pos", F.coalesce("component", "id").alias("g"))
        placed = common.written(placed, f"{at}/placed")
        work = _work(placed)
        step += 1
        if not some or work <= WORK * placed.count() or work > before * 3 / 4:
            break
        before = work

    pairs = _pairs(_opened(placed, heads, percent, folder), tried)
    more = _links(common.written(pairs, f"{folder}/pairs"), heads, texts, gram, percent, f"{folder}/more")

    return sets, classes.drop("tokens", "bits"), links.unionByName(more)


def _firsts(found: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that have links, with their component; and the first row (id, t) of each such component."""
    own = found.join(classes.select(F.col("node").alias("at"), F.struct("id", "t").alias("first")), F.col("id") == F.col("at"))
    return own.select(F.col("at").alias("node"), "component"), own.groupBy("component").agg(F.min("first").alias("first"))


def join(docs: DataFrame, gram: int = GRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row."""
    spark = docs.sparkSession
    folder = common.scratch(spark)
    work = f"{folder}/work"
    sets, classes, links = _linked(docs, gram, percent, id_col, text_col, work)
    key = ["h1", "h2", "n"]
    nodes, firsts = _firsts(components(links, f"{work}/components"), classes)
    named = nodes.join(firsts, "component").select("node", F.col("first.id").alias("least"))
    named = classes.join(named, "node", "left").select(*key, F.coalesce("least", "id").alias("component"))
    out = sets.where("n > 0").join(named, key).select("id", "n", "component")
    out = out.unionByName(sets.where("n = 0").select("id", "n", F.col("id").alias("component")))
    out = common.written(out.select(common.id_value("id").alias("doc_id"), F.col("n").alias("n_shingles"), common.id_value("component").alias("component_id")), f"{folder}/result")
    storage.delete(spark, work)
    return out


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, percent: int = PERCENT) -> DataFrame:
    """One row per component: that of the smallest id (of equal ids, of the lesser hash of its text), with all columns."""
    spark = docs.sparkSession
    folder = common.scratch(spark)
    work = f"{folder}/work"
    sets, classes, links = _linked(docs, gram, percent, id_col, text_col, work)
    nodes, firsts = _firsts(components(links, f"{work}/components"), classes)
    kept = firsts.select("first.*").unionByName(classes.join(nodes, "node", "left_anti").select("id", "t")).unionByName(sets.where("n = 0").select("id", "t"))
    kept = common.written(kept, f"{folder}/kept")
    storage.delete(spark, work)
    # All columns of a row travel in one, so that none clashes; rows that repeat an id and a text are one.
    keyed = common.with_row(docs, id=common.id_key(id_col), t=F.xxhash64(_text(text_col)))
    return keyed.join(kept, ["id", "t"], "left_semi").dropDuplicates(["id", "t"]).select("row.*")
