"""Mixing sources to target weights by hash-threshold histograms.

A source's target over its size gives whole copies of each document plus a rest. The rest is met by taking the
documents whose hash lies below a threshold: tokens are summed by source and hash bucket, the bucket where the budget
runs out is found, and only that bucket is refined. The document at the threshold does not fit; what is left of the
budget goes, in the same way, to documents after it that are small enough (nested thresholds), PASSES times.
No sort over documents, and a rerun decides alike.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source of its own, last in order;
rows alike in doc_id and text are numbered, so that as many of them are taken as fit, whichever; an empty table gives
an empty result; if all sizes are 0, all targets are 0. Only doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import is_small, read, row_name, sized_join, stash

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BITS, LEVELS, PASSES = 10, 6, 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> with target: shares by repeating weights, stopped at cap x size, the excess reshared.

    With water level w, a target is least(cap x size, w x weight). Sources sorted by cap x size / weight are stopped
    in that order, so running sums over that order give the level in one pass. A source count is small: one window.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = (F.row_number().over(order) - 1) % len(weights)
    s = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), place + 1))
    s = s.withColumn("full", F.col("source_size") * float(cap)).withColumn("stop", F.col("full") / F.col("weight"))
    up = Window.orderBy("stop", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # if those before this one are stopped, the rest would share so much a unit of weight
    s = s.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(up), F.lit(0.0)))
                     / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(up), F.lit(0.0))))
    # the level holds for the first that is not stopped; of sources that stop alike, a later one's counts the earlier as stopped
    s = s.withColumn("place", F.row_number().over(Window.orderBy("stop", F.col("source").isNull(), "source")))
    s = s.withColumn("water", F.min(F.when(F.col("stop") > F.col("level"), F.struct("place", "level"))).over(every)["level"])
    target = F.when(F.col("water").isNull(), F.col("full")).otherwise(F.least("full", F.col("water") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """rows (sid, h, size), budgets (sid, budget) -> (sid, cut, used): the first `used` <= budget tokens have h < cut.

    h is a 60-bit hash. Each level sums tokens in 2**BITS buckets of the boundary bucket alone.
    """
    edge = budgets.select("sid", "budget", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("used"))
    few = is_small(edge)  # of each level's, which has the same sources
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        side = F.broadcast(edge.drop("n")) if few else edge.drop("n").hint("merge")
        here = rows.join(side, "sid")
        if level:
            here = here.filter(F.shiftright("h", shift + BITS) == F.shiftright("low", shift + BITS))
        bucket = F.shiftright("h", shift)
        sums = here.groupBy("sid", bucket.alias("b")).agg(F.sum("size").alias("t"), F.count("*").alias("n"))
        sums = sums.join(side, "sid")
        w = Window.partitionBy("sid").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
        run = sums.withColumn("upto", F.col("used") + F.sum("t").over(w))
        over = run.filter(F.col("upto") > F.col("budget"))
        # the first bucket that goes over the budget is the boundary; without one, all rows fit
        cut = over.groupBy("sid").agg(F.min_by(F.struct("b", F.col("upto") - F.col("t"), "n"), "b").alias("x"))
        cut = cut.select("sid", F.shiftleft("x.b", shift).alias("cut"), F.col("x.col2").alias("found"), F.col("x.n").alias("n"))
        edge = stash(
            edge.drop("n").join(cut, "sid", "left").select(
                "sid", "budget",
                F.coalesce("cut", F.lit(1 << 60) if level == 0 else F.col("low")).alias("low"),
                F.coalesce("found", F.lit(None).cast("long") if level == 0 else F.col("used")).alias("used"),
                F.coalesce("n", F.lit(0)).alias("n"),
            ), "edge")
        if (edge.agg(F.max("n")).first()[0] or 0) <= 1:
            break
    return edge.select("sid", F.col("low").alias("cut"), "used")


def repeated_names(names: DataFrame) -> DataFrame:
    """(name) of several rows -> names that occur more than once."""
    return stash(names.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name"), "repeated")


def numbered(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Numbers the rows of equal keys from 0; a key's rows stay in their partitions, whose counts are summed."""
    placed = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.col(key).alias("key"), F.monotonically_increasing_id().alias("at"))
    placed = stash(placed, "placed").withColumn("part", F.shiftright("at", 33))
    here = placed.withColumn("inner", F.row_number().over(Window.partitionBy("part", "key").orderBy("at")) - 1)
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = placed.groupBy("part", "key").agg(F.count("*").alias("c")).select("part", "key", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    return here.join(counts, ["part", "key"]).select("row.*", (F.col("inner") + F.col("base")).alias(out))


def hashed(rows: DataFrame, name: str, seed: str, repeated: DataFrame) -> DataFrame:
    """Adds __h, a 60-bit hash of a row's name and, where the name is repeated, of its number among those rows."""
    h = lambda k: F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(name), k), 4)
    none = F.lit(0).cast("long")
    if repeated.isEmpty():
        return rows.withColumn("__h", h(none))
    marked = sized_join(rows, repeated.select(F.col("name").alias(name), F.lit(True).alias("__again")), name, "left")
    single = marked.filter("__again IS NULL").drop("__again").withColumn("__h", h(none))
    again = numbered(marked.filter("__again").drop("__again"), name, "__k")
    return single.unionByName(again.withColumn("__h", h(F.col("__k"))).drop("__k"))


def with_keys(documents: DataFrame, seed: str, repeated: DataFrame | None = None) -> DataFrame:
    """Adds __size (words), __h (60-bit hash of doc_id and text) and __sid (of the source)."""
    repeated = repeated or repeated_names(documents.select(row_name().alias("name")))
    rows = documents.withColumns({"__name": row_name(), "__size": word_count(F.col("text")), "__sid": source_key()})
    return hashed(rows, "__name", seed, repeated).drop("__name")


def source_key() -> Column:
    return F.xxhash64(F.lit("source"), F.col("source").isNull(), "source")


def sized(documents: DataFrame, seed: str) -> tuple[DataFrame, DataFrame]:
    """A row for each document: doc_id, source, __size, __sid, __h; and the names of repeated rows."""
    d = documents.select("doc_id", "source", row_name().alias("name"), word_count(F.col("text")).alias("__size"), source_key().alias("__sid"))
    d = stash(d, "sized")
    repeated = repeated_names(d.select("name"))
    if repeated.isEmpty():
        return hashed(d, "name", seed, repeated), repeated
    return stash(hashed(d, "name", seed, repeated), "sized", (d,)), repeated


def mixing_plan(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MAX_REPEAT) -> DataFrame:
    """Rows of sized -> a row for each source: __sid, __source_size, __target, __whole copies, and its nested thresholds."""
    d = sizes.select("source", F.col("__size").alias("size"), F.col("__h").alias("h"), F.col("__sid").alias("sid"))
    sizes = d.groupBy("sid").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = targets(sizes.select("source", "source_size"), weights, cap).withColumn("sid", source_key())
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = stash(plan.withColumn("whole", F.least(whole, F.lit(int(cap))).cast("long")), "plan")
    left = plan.select("sid", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"))
    cuts, open_ = [], None
    for k in range(PASSES):
        rows = d.filter("size > 0").select("sid", "h", "size")
        if cuts:  # after the last threshold, and small enough for what is left
            rows = sized_join(rows, open_, "sid", "inner").filter("h > cut AND size <= room").select("sid", "h", "size")
        found = thresholds(rows, left)
        used = F.coalesce("used", F.lit(0)) if cuts else F.col("used")
        done = left.join(found, "sid").withColumn("used", used)
        done = stash(done.withColumn("room", F.when(F.col("used").isNull(), 0.0).otherwise(F.col("budget") - F.col("used"))), "cut")
        cuts.append(done.select("sid", F.col("cut").alias(f"__cut{k}"), F.col("budget").alias(f"__room{k}")))
        open_ = done.select("sid", "cut", "room")
        left = done.select("sid", F.col("room").alias("budget"))
    for c in cuts:
        plan = plan.join(c, "sid", "left")
    names = {k: f"__{k}" for k in ("sid", "source_size", "target", "whole")}
    return stash(plan.drop("source", "weight").withColumnsRenamed(names), "plan")


def copies(cap: float = MAX_REPEAT) -> Column:
    """Copies the mix takes of a row of with_keys joined to its plan."""
    h, size, take = F.col("__h"), F.col("__size"), F.col("__h") < F.col("__cut0")
    for k in range(1, PASSES):
        take = take | ((h > F.col(f"__cut{k - 1}")) & (h < F.col(f"__cut{k}")) & (size <= F.col(f"__room{k}")))
    return F.col("__whole") + F.when(take & (F.col("__whole") < int(cap)), 1).otherwise(0)


def mix_documents(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MAX_REPEAT, seed: str = "mix") -> DataFrame:
    """The mix: each document as often as it is taken, with all its columns."""
    sizes, repeated = sized(documents, seed)
    plan = mixing_plan(sizes, weights, cap)
    rows = documents.select("doc_id", "source", "text", F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"))
    out = sized_join(with_keys(rows, seed, repeated).drop("doc_id", "source", "text"), plan, "__sid", "inner")
    times = F.when(F.col("__size") > 0, copies(cap)).otherwise(0).cast("int")
    return out.select("row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MAX_REPEAT, seed: str = "mix") -> DataFrame:
    """documents -> doc_id, size, source_size, target, taken."""
    sizes, _ = sized(documents, seed)
    out = sized_join(sizes, mixing_plan(sizes, weights, cap), "__sid", "inner")
    return out.select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        (F.col("__size") * copies(cap)).alias("taken"))


def mix_targets(spark, sf_dir: str) -> DataFrame:
    """What mix tells before it chooses documents: target in millionths, rounded."""
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round(F.col("target") * 1e6).cast("long").alias("target_1e6"))


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))
