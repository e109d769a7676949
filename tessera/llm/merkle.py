"""Merkle manifest of a dataset, with proofs by nested-interval labels.

A row's leaf is a hash of its columns. Leaves of a language are numbered in order, and each node of its tree is labelled
with the interval of leaf numbers that it covers: at level L, [k 2^L, (k + 1) 2^L), cut off at the number of leaves.
LEVELS levels are built at once, in blocks of 2^LEVELS nodes, and labels lie in buckets of a level and of the parent's
interval. A containment join with the bucket of each level attaches a node's parents and their children; the child whose
interval is the parent's without that of the node's ancestor is the sibling. Proofs of a bucket of levels are made for its
lowest nodes alone and handed down by block, so rows are LEVELS for each leaf, however deep the tree. A second tree of the
same form stands on the roots of the languages. All steps are DataFrame functions, and no group holds more than a block.

Defined results: a null column is hashed as `-`, unlike an empty text; a null language is a tree of its own, first in
order; a null doc_id is first in its tree and never tampered with; rows with one doc_id go by their leaf, and rows alike
in all are leaves of their own; a null n_chars stays null when tampered with, so is verified; an empty table gives an
empty result. Other columns are ignored. A long text costs its bytes, twice where it is tampered with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import is_small, read, sized_join, stash, unstash

#: Levels of a tree that are built and joined at once.
LEVELS = 6
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def field(value: Column) -> Column:
    """A column as it is hashed: UTF-8 bytes, a colon and the value; - if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def node_hash(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaves(documents: DataFrame, tamper_every: int = 7) -> DataFrame:
    """doc_id, g (the tree), leaf, told (the leaf of the row as tampered with, else null), salt (which tells rows alike apart)."""
    d = documents.select(*(F.col(f"`{c}`") for c in FIELDS))
    whole = node_hash(*(field(F.col(c)) for c in FIELDS))
    more = node_hash(*(field(F.col(c) + 1 if c == "n_chars" else F.col(c)) for c in FIELDS))
    hit = F.crc32(F.col("doc_id").cast("string")) % tamper_every == 0
    g = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    return d.select(F.col("doc_id").cast("long").alias("doc_id"), g.alias("g"), whole.alias("leaf"), F.when(hit, more).alias("told"), F.xxhash64(F.monotonically_increasing_id()).alias("salt"))

def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds at, the place of a row in its tree g from 0, and size, the rows of the tree.

    Ranges of (g, order) are sorted apart and their counts summed, so a tree is never in one task.
    """
    placed = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order).withColumn("id", F.monotonically_increasing_id())
    placed = stash(placed, "placed").withColumn("part", F.shiftright("id", 33))
    counts = placed.groupBy("g", "part").agg(F.count("*").alias("c"), F.min("id").alias("first"))
    whole = Window.partitionBy("g")  # a row for each range
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("g", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("base"), F.sum("c").over(whole).alias("size"))
    return sized_join(placed, counts, ["g", "part"], "inner").withColumn("at", F.col("id") + F.col("base")).drop("id", "part", "base")


def level_above(h: Column) -> Column:
    """The hashes of each two consecutive ones; of a last one alone its own."""
    run = F.sequence(F.lit(0), ((F.size(h) - 1) / 2).cast("int"))
    return F.transform(run, lambda i: node_hash(F.get(h, 2 * i), F.coalesce(F.get(h, 2 * i + 1), F.lit(""))))


def build(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes of a level (g, size, at, hash) -> g, size, block and the hashes of levels level .. level + LEVELS: h0, h1, ...

    size is the tree's number of leaves. A level is empty where the tree ends below it.
    """
    base = F.transform(F.sort_array(F.collect_list(F.struct("at", "hash"))), lambda x: x["hash"])
    got = nodes.groupBy("g", "size", F.shiftright("at", LEVELS).alias("block")).agg(base.alias("h0"))  # a block at most
    for k in range(LEVELS):
        got = got.withColumn(f"h{k + 1}", F.when(F.col("size") > 1 << (level + k), level_above(F.col(f"h{k}"))).otherwise(F.array().cast("array<string>")))
    return got


def labels(built: DataFrame, level: int) -> DataFrame:
    """The nodes of a bucket of levels below its top: g, level, lo, hi (leaves lo .. hi - 1), hash."""

    def of(k: int) -> Column:
        lo = lambda i: F.shiftleft(F.shiftleft(F.col("block"), LEVELS - k) + i, level + k)
        return F.transform(f"h{k}", lambda x, i: F.struct(F.lit(level + k).alias("level"), lo(i).alias("lo"), x.alias("hash")))

    rows = built.select("g", "size", F.explode(F.flatten(F.array(*(of(k) for k in range(LEVELS))))).alias("n")).select("g", "size", "n.*")
    return rows.select("g", "level", "lo", F.least(F.col("lo") + F.expr("shiftleft(1L, level)"), "size").alias("hi"), "hash")


def siblings(built: DataFrame, level: int) -> DataFrame:
    """g, at, path: for each lowest node of a bucket its sibling at every level: (level, left, hash), hash null if it has none."""
    nodes = labels(built, level).withColumn("bucket", F.expr("shiftright(lo, level + 1)"))
    low = built.select("g", "size", F.explode(F.expr(f"sequence(shiftleft(block, {LEVELS}), shiftleft(block, {LEVELS}) + size(h0) - 1)")).alias("at"))
    steps = F.filter(F.array(*(F.lit(level + k) for k in range(LEVELS))), lambda x: F.col("size") > F.call_function("shiftleft", F.lit(1).cast("long"), x))
    low = low.select("g", "size", "at", F.explode(steps).alias("level"))
    own = F.expr(f"shiftleft(shiftright(at, level - {level}), level)")
    low = low.withColumn("a", own).withColumn("b", F.least(F.col("a") + F.expr("shiftleft(1L, level)"), "size"))
    low = low.withColumn("bucket", F.expr("shiftright(a, level + 1)"))
    top = F.expr("shiftleft(bucket, level + 1)")
    low = low.withColumns({"pa": top, "pb": F.least(top + F.expr("shiftleft(2L, level)"), "size")}).drop("size")
    x, y = low.alias("x"), nodes.alias("y")
    same = (F.col("x.g") == F.col("y.g")) & (F.col("x.level") == F.col("y.level")) & (F.col("x.bucket") == F.col("y.bucket"))
    within = (F.col("y.lo") >= F.col("x.pa")) & (F.col("y.hi") <= F.col("x.pb"))
    apart = (F.col("y.hi") <= F.col("x.a")) | (F.col("y.lo") >= F.col("x.b"))
    met = x.join(y, same & within & apart, "left")
    step = F.struct(F.col("x.level").alias("level"), (F.col("y.lo") < F.col("x.a")).alias("left"), F.col("y.hash").alias("hash"))
    return met.groupBy(F.col("x.g").alias("g"), F.col("x.at").alias("at")).agg(F.sort_array(F.collect_list(step)).alias("path"))


def proofs(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves of trees (g, size, at, hash) -> rows g, root; and g, at, path: siblings from the leaf up to below the root."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    roots, found, level = None, [], 0
    while True:
        built = stash(build(nodes, level), "blocks")
        top = F.coalesce(*(F.get(f"h{k}", F.lit(0)) for k in range(LEVELS, -1, -1)))
        ends = built.filter(F.col("size") <= 1 << (level + LEVELS)).select("g", top.alias("root"))
        roots = ends if roots is None else roots.unionByName(ends)
        found.append(siblings(built, level))
        nodes = built.filter(F.col("size") > 1 << (level + LEVELS)).select("g", "size", F.col("block").alias("at"), F.get(f"h{LEVELS}", F.lit(0)).alias("hash"))
        level += LEVELS
        if largest <= 1 << level:
            break
    path = found.pop()
    while found:
        lower, upper = found.pop(), stash(path, "proofs")
        above = upper.select("g", F.col("at").alias("block"), F.col("path").alias("above"))
        joined = sized_join(lower.withColumn("block", F.shiftright("at", LEVELS)), above, ["g", "block"], "left")
        nothing = F.array().cast(dict(upper.dtypes)["path"])
        path = joined.select("g", "at", F.concat("path", F.coalesce("above", nothing)).alias("path"))
    return roots, path


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def up(own: Column, x: Column) -> Column:
        return F.when(x["hash"].isNull(), node_hash(own)).when(x["left"], node_hash(x["hash"], own)).otherwise(node_hash(own, x["hash"]))

    return F.aggregate(path, start, up)


def manifest(documents: DataFrame, tamper_every: int = 7) -> DataFrame:
    """documents -> doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    found = stash(leaves(documents, tamper_every), "leaves")
    rows = stash(ranked(found, ["doc_id", "leaf", "salt"]).drop("salt"), "ranked")
    unstash(found)
    roots, path = proofs(rows.select("g", "size", "at", F.col("leaf").alias("hash")))
    # the tree on top: its leaves are the roots of the languages
    subroots = stash(roots, "subroots")
    tops = stash(ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("of"), F.col("root").alias("hash")), ["of"]), "tops")
    root, high = proofs(tops.select("g", "size", "at", "hash"))
    high = tops.join(high, ["g", "at"], "left").join(root, "g").select(F.col("of").alias("g"), F.col("hash").alias("subroot"), "root", F.col("path").alias("high"))
    high = stash(high, "high")
    kind = dict(high.dtypes)["high"]
    rows = rows.join(path, ["g", "at"], "left")
    # a row for each language; where they are many, each language's rows are dealt by their place as well
    if is_small(high):
        rows = rows.join(F.broadcast(high), "g")
    else:
        salted = high.withColumn("s", F.explode(F.expr(f"sequence(0, {1 << LEVELS} - 1)")))
        rows = rows.withColumn("s", (F.col("at") % (1 << LEVELS)).cast("int")).join(salted, ["g", "s"])
    none = F.array().cast(kind)
    rows = rows.withColumn("path", F.concat(F.coalesce("path", none), F.coalesce("high", none)))
    hashes = F.array_join(F.transform("path", lambda x: F.coalesce(x["hash"], F.lit(""))), "")
    rows = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(hashes, 256).alias("proof_sha256"), folded(F.coalesce("told", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(read(spark, sf_dir, "documents"))
