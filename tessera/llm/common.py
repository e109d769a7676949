"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes a side may have to be broadcast; beyond them joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 24 << 20
#: Bits of a bitmap of keys: the least and the most powers of two, 32 MB at most however many keys there are.
BITMAP_BITS = (20, 28)
#: A key is hot when it holds more than this share of the rows, so hot keys number at most 1 / share.
HOT_SHARE = 1 / 2000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a temporary one only where it is unset and all is on one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tessera-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str = "stash", done: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors.

    The query's shuffle files go once it has ended, and so do the stashes `done`, which only df was made from.
    """
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = shared_path(spark, name), spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(cleanup, before) if before is not None else spark.conf.unset(cleanup)
    out = spark.read.schema(df.schema).parquet(path)
    out.stash_path = path
    unstash(*done)
    return out


def unstash(*stashes: DataFrame) -> None:
    """Delete stashes that nothing reads any more."""
    for x in stashes:
        drop_path(x.sparkSession, x.stash_path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours in the shared store, through Hadoop's file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def row_name() -> Column:
    """A name of 128 bits of a row by its doc_id and text; rows alike in both share it."""
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit("b"), "doc_id", "text").alias("b"))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row, about."""
    total = F.lit(16).cast("long")
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + 8
        elif isinstance(kind, T.ArrayType):
            inner = kind.elementType
            width = lambda t: 8 + 72 * isinstance(t, T.StringType)  # noqa: E731  a string in a struct: a hash in hex, about
            each = sum(width(x.dataType) for x in inner.fields) if isinstance(inner, T.StructType) else 32 if isinstance(inner, T.StringType) else 8
            total = total + F.greatest(F.size(c), F.lit(0)) * each + 8
        else:
            total = total + (8 * len(kind.fields) if isinstance(kind, T.StructType) else 8)
    return total


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    rows, size = df.select(row_bytes(df).alias("n")).limit(max_rows + 1).agg(F.count("*"), F.sum("n")).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def sized_join(left: DataFrame, right: DataFrame, on, how: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast `right` if its rows and bytes are counted as few, else a shuffle join (AQE splits skewed keys)."""
    return left.join(F.broadcast(right) if is_small(right, max_rows) else right.hint("merge"), on, how)


class Bitmap:
    """A bitmap of hashed keys (a column of longs), broadcast in pieces: rows whose bit is unset have none of the keys; the others may."""

    def __init__(self, keys: DataFrame, key: Column):
        self.bits = max(BITMAP_BITS[0], min(BITMAP_BITS[1], (16 * keys.count()).bit_length()))
        b = keys.select(self._bit(key).alias("b"))
        self.pieces = stash(b.groupBy(F.bitmap_bucket_number("b").alias("__piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("__bits")), "bitmap")

    def _bit(self, key: Column) -> Column:
        return F.shiftrightunsigned(key, 64 - self.bits) + 1  # Spark numbers bits from 1

    def mark(self, rows: DataFrame, key: Column, name: str = "may") -> DataFrame:
        """rows with a boolean column that tells whether they may hold one of the keys. No row passes through Python."""
        bit = self._bit(key)
        rows = rows.withColumns({"__piece": F.bitmap_bucket_number(bit), "__at": F.bitmap_bit_position(bit)})
        rows = rows.join(F.broadcast(self.pieces), "__piece", "left")
        byte = "cast(conv(hex(substring(__bits, cast(__at div 8 AS int) + 1, 1)), 16, 10) AS int)"
        held = F.expr(f"shiftright({byte}, cast(__at % 8 AS int)) & 1 = 1")
        return rows.withColumn(name, F.coalesce(held, F.lit(False))).drop("__piece", "__at", "__bits")

    def split(self, rows: DataFrame, key: str, may: bool = True) -> DataFrame:
        """Rows that may hold one of the keys; or, with may=False, those that cannot."""
        return self.mark(rows, F.col(key), "__may").filter(F.col("__may") == may).drop("__may")


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int):
    """What runs in here sends at most so many rows at a time to Python, so that batches of long rows take little memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Returns freed memory of a Python worker, which Spark keeps for later tasks, to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def hot_safe_left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on one key when a few keys may hold most rows of `left`; keys of `right` are unique.

    Keys above HOT_SHARE of the rows, at most 1 / HOT_SHARE of them, are joined by broadcast, the rest by shuffle. Rows
    with a null key have no match and take part in no join.
    """
    if is_small(right):
        return left.join(F.broadcast(right), key, "left")
    lone = left.filter(F.col(key).isNull())
    for f in right.drop(key).schema.fields:
        lone = lone.withColumn(f.name, F.lit(None).cast(f.dataType))
    left = left.filter(F.col(key).isNotNull())
    counts = left.groupBy(key).agg(F.count("*").alias("__n"))
    total = left.count()
    hot = counts.filter(F.col("__n") > max(1, total * HOT_SHARE)).select(key, F.lit(True).alias("__hot"))
    hot = stash(hot, "hot")
    marked = left.join(F.broadcast(hot), key, "left")
    hot_right = right.join(F.broadcast(hot), key, "left_semi")
    warm = marked.filter(F.col("__hot")).drop("__hot").join(F.broadcast(hot_right), key, "left")
    cold = marked.filter(F.col("__hot").isNull()).drop("__hot").join(right, key, "left")
    return warm.unionByName(cold).unionByName(lone)


def deal_blocks(rows: DataFrame, key: str, node: str, block: int) -> DataFrame:
    """Deal rows (key, node, home, ...) out so that each pair of a home and another row of its key meets in one group.

    Groups are (key, i, j). A key of more than `block` rows is cut into blocks by a hash of the node: homes of block i
    meet all rows of block j, so no group holds more than about two blocks. Groups lie whole and sorted in partitions.
    Where `cut` is true homes meet the other rows alone, among which they are again; else they meet all rows.
    """
    hot = stash(rows.groupBy(key).agg(F.count("*").alias("__n")).filter(F.col("__n") > block), "hot_keys")
    none = F.lit(0)
    if hot.isEmpty():
        dealt = rows.select(none.alias("i"), none.alias("j"), F.lit(False).alias("cut"), "*")
    else:
        marked = sized_join(rows, hot, key, "left")
        cool = marked.filter("__n IS NULL").drop("__n").select(none.alias("i"), none.alias("j"), F.lit(False).alias("cut"), "*")
        k = F.ceil(F.col("__n") / block).cast("int")
        warm = marked.filter("__n IS NOT NULL").withColumn("__k", k).withColumn("__own", F.pmod(F.xxhash64(node), F.col("__k")).cast("int"))
        every = F.explode(F.expr("sequence(0, __k - 1)"))
        homes = warm.filter("home").select("*", F.col("__own").alias("i"), every.alias("j"))
        others = warm.withColumn("home", F.lit(False)).select("*", every.alias("i"), F.col("__own").alias("j"))
        dealt = cool.unionByName(homes.unionByName(others).drop("__n", "__k", "__own").withColumn("cut", F.lit(True)))
    return dealt.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j")


def whole_groups(batches, keys: list[str]):
    """From batches sorted by keys, frames that hold whole groups, with the bounds of the groups in each."""
    kept = None
    for b in itertools.chain(batches, [None]):
        if b is not None:
            kept = b if kept is None else pd.concat([kept, b], ignore_index=True)
        if kept is None or not len(kept):
            continue
        key = kept[keys].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(kept)]])
        if b is not None:  # the last group may go on
            bounds = bounds[:-1]
        if len(bounds) > 1:
            yield kept.iloc[: bounds[-1]], bounds
        kept = kept.iloc[bounds[-1] :].reset_index(drop=True) if b is not None else None
    give_back()


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root the least node reachable; lone nodes are absent.

    Alternating large-star and small-star steps; each is a pre-aggregated minimum and a join, so no neighbour
    list is ever gathered. Raises if max_rounds do not suffice.
    """
    e = stash(edges.filter("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        both = e.unionByName(e.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(low.hint("merge"), "u").selectExpr("v AS u", "m AS v").filter("u <> v").distinct()
        large = stash(large, "large", (e,))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low.hint("merge"), "u").selectExpr("v AS u", "m AS v").filter("u <> v")
            .unionByName(low.selectExpr("u", "m AS v")).distinct()
        )
        e = stash(small, "small", (large,))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.selectExpr("u AS node", "v AS root").unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
