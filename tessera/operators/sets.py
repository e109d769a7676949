"""Set algebra on peptides: subtraction, exclusivity, membership flags, support."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ranking import row_numbers
from tessera.sources.scratch import materialized

#: Rows and bytes a side may have to be broadcast; beyond them joins shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 64 << 20


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether rows and their bytes, both counted, are few; a count ends at the first row too many."""
    width = F.lit(16 + 8 * len(df.columns))
    for f in df.schema.fields:
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
    rows, size = df.select(width.cast("long").alias("n")).limit(max_rows + 1).agg(F.count("*"), F.sum("n")).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows that it is small."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def subtract(df: DataFrame, other: DataFrame, key: str = "sequence") -> DataFrame:
    """Rows of df whose key is not in other. Null keys of df are kept; Spark picks broadcast or shuffle by size."""
    return df.join(other.select(key).distinct(), key, "left_anti")


def subtract_reference(df: DataFrame, other: DataFrame, key: str = "sequence") -> DataFrame:
    """subtract, for many rows and a reference set of which few rows are: only what may match is shuffled.

    A small reference is broadcast, a larger one as a bitmap of its keys, as long as that has a bit in sixteen set at most.
    Rows without their bit are kept where they lie; df is evaluated once for them and once for the rest, which meets the
    reference in an exact join. A reference too large for a bitmap is joined as it is.
    """
    keys = materialized(other.select(key).distinct(), "reference")
    if is_small(keys):
        return df.join(F.broadcast(keys), key, "left_anti")
    if (bits := KeyBitmap.bits_for(keys.count())) is None:
        return df.join(keys.hint("merge"), key, "left_anti")
    marked = KeyBitmap(keys, key, bits).mark(df, key, "__may")
    exact = marked.filter("__may").join(keys.hint("merge"), key, "left_anti")
    return marked.filter("NOT __may").unionByName(exact).select(*df.columns)


class KeyBitmap:
    """A bitmap of hashed keys, 32 MB at most, broadcast in pieces: a row whose bit is unset has none of the keys."""

    LEAST, MOST = 20, 28

    @classmethod
    def bits_for(cls, keys: int) -> int | None:
        """The power of two of a bitmap with 16 bits a key or more; None if that is too large."""
        bits = max(cls.LEAST, (16 * keys - 1).bit_length())
        return bits if bits <= cls.MOST else None

    def __init__(self, keys: DataFrame, key: str, bits: int):
        self.bits = bits
        at = keys.select(self._bit(key).alias("b"))
        pieces = at.groupBy(F.bitmap_bucket_number("b").alias("__piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("__set"))
        self.pieces = materialized(pieces, "bitmap")

    def _bit(self, key: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.col(f"`{key}`")), 64 - self.bits) + 1  # Spark numbers bits from 1

    def mark(self, rows: DataFrame, key: str, out: str) -> DataFrame:
        """rows and whether each may have one of the keys; a null key has none."""
        at = F.bitmap_bit_position(self._bit(key))
        rows = rows.withColumns({"__piece": F.bitmap_bucket_number(self._bit(key)), "__at": at}).join(F.broadcast(self.pieces), "__piece", "left")
        byte = F.conv(F.hex(F.substring("__set", (F.floor(F.col("__at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        held = F.getbit(byte, (F.col("__at") % 8).cast("int")) == 1
        known = F.col(f"`{key}`").isNotNull() & F.coalesce(held, F.lit(False))
        return rows.withColumn(out, known).drop("__piece", "__at", "__set")


def restrict(df: DataFrame, other: DataFrame, key: str = "sequence") -> DataFrame:
    """Rows of df whose key is in other."""
    return df.join(other.select(key), key, "left_semi")


def exclusive(df: DataFrame, group: str, key: str = "sequence") -> DataFrame:
    """Rows whose key occurs in one group alone: one pre-aggregated pass in place of a subtraction for each pair of groups."""
    only = df.groupBy(key).agg(F.min(group).alias("__a"), F.max(group).alias("__b")).filter("__a = __b").select(key)
    return df.join(only, key, "left_semi")


def intersect(df: DataFrame, other: DataFrame, key: str = "sequence") -> DataFrame:
    """Different keys that both have."""
    return df.select(key).intersect(other.select(key))


def files_in_metadata(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """Files, or rows with a filename, that the metadata knows."""
    return restrict(files, metadata, "filename")


def one_disease(table: DataFrame, disease_no: str) -> DataFrame:
    """Rows of one disease of a served table; as it is partitioned by disease, only that partition is read."""
    return table.filter(F.col("disease_no") == disease_no)


def flag_members(df: DataFrame, members: DataFrame, key: str | list[str], flag: str) -> DataFrame:
    """Adds flag: 1 if the key is in members, else 0."""
    keys = [key] if isinstance(key, str) else key
    marks = members.select(*keys).distinct().withColumn(flag, F.lit(1))
    return df.join(marks, key, "left").withColumn(flag, F.coalesce(flag, F.lit(0)))


def minimum_support(df: DataFrame, by: str, more_than: int) -> DataFrame:
    """Rows of groups that have more than so many rows; rows with a null group are dropped."""
    enough = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("__n")).filter(F.col("__n") > more_than).select(by)
    return df.join(enough, by, "left_semi")


def exactly_one(df: DataFrame, what: str = "selection") -> DataFrame:
    """df, if it has one row; else a ValueError."""
    n = df.limit(2).count()
    if n != 1:
        raise ValueError(f"{what}: expected one match, found {'none' if n == 0 else 'several'}")
    return df


def distinct_counts(df: DataFrame, key: str | list[str], counted: str, out: str) -> DataFrame:
    """key, out: the number of different values of a key's rows; a null counts as a value.

    Two aggregates: different (key, value) first, then their count. Each sums before its shuffle, so a hot key is
    as many rows as it has values, dealt over all tasks, and then a row a task.
    """
    keys = [key] if isinstance(key, str) else key
    return df.select(*keys, F.col(counted).alias("__value")).distinct().groupBy(*keys).agg(F.count("*").alias(out))


def distinct_counts_to_rows(df: DataFrame, key: str | list[str], counted: str, out: str) -> DataFrame:
    """Adds the number of different values of a key's rows. A plain join, whose hot keys AQE splits; null keys get null."""
    return df.join(distinct_counts(df, key, counted, out), key, "left")


def values_with_all(df: DataFrame, column: str, first: str = "All") -> DataFrame:
    """Sorted different values of a column, after a first choice: place, value."""
    found = df.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    ranked = row_numbers(found, [F.col("value")], "place").select("place", "value")
    return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("place"), F.lit(first).alias("value")).unionByName(ranked)
