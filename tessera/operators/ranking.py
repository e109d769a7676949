"""Ranks, codes, row numbers and top-N coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import materialized


def disease_catalog(metadata: DataFrame, control: str = "None") -> DataFrame:
    """disease, total_unique_sequences, disease_no: D1.. by falling total, then name; the control keeps its own name.

    Diseases are few, so the window runs over a small aggregate.
    """
    totals = metadata.groupBy("disease").agg(F.sum("unique_sequences").alias("total_unique_sequences"))
    is_control = F.col("disease") == control
    w = Window.partitionBy(is_control).orderBy(F.desc("total_unique_sequences"), "disease")
    return totals.withColumn("disease_no", F.when(is_control, F.lit(control)).otherwise(F.concat(F.lit("D"), F.row_number().over(w).cast("string"))))


def patient_codes(metadata: DataFrame, key: str) -> DataFrame:
    """key, patient: P<k> by the rank of different keys in binary order."""
    keys = metadata.select(key).filter(F.col(key).isNotNull()).distinct()
    return row_numbers(keys, [F.col(key)], "__code").select(key, F.concat(F.lit("P"), F.col("__code").cast("string")).alias("patient"))


def row_numbers(df: DataFrame, order: list, out: str = "row_id") -> DataFrame:
    """Dense 1..N over a total order, without a one-task window: ranges are sorted apart and offset by their counts.

    The sorted ranges are written once, so that counts and numbers tell of the same ranges. A column `out` is replaced.
    """
    names = [c for c in df.columns if c != out]
    # in each partition the low 33 bits count its rows, the others are its number
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.monotonically_increasing_id().alias("at"))
    placed = materialized(placed, "row_numbers").select("row", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("n"))
    counts = placed.groupBy("part").agg(F.count("*").alias("c"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    counts = counts.select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    return placed.join(F.broadcast(counts), "part").select("row.*", (F.col("n") + F.col("base") + 1).alias(out))


def peptide_frequency(pairs: DataFrame, n_antibodies: int | None = None) -> DataFrame:
    """(sequence, antibody_id) -> sequence, n_abs, percent of all antibodies, rounded to 6 places."""
    total = n_antibodies if n_antibodies is not None else pairs.select(F.count_distinct("antibody_id")).first()[0]
    n = F.count("*")
    return pairs.groupBy("sequence").agg(n.alias("n_abs"), F.round(n / F.lit(max(total, 1)) * 100, 6).alias("percent"))


#: Letters by which a boundary class is refined at a time.
PREFIX_STEP = 3


class TopSelection:
    """Which peptides are among the N most frequent, ties in order of sequence, for several N, without a sort of all peptides.

    A histogram of counts tells the class in which a rank falls; classes above it are in. The class itself is refined by
    prefixes of its sequences, of which one has the boundary each time, until a prefix is in as a whole.
    """

    def __init__(self, frequency: DataFrame, sizes: list[int]):
        """frequency: sequence, n_abs, one row each, read several times."""
        self.sizes = sorted(sizes)
        classes = frequency.groupBy("n_abs").agg(F.count("*").alias("n"))  # n different counts take n * n / 2 rows at least
        down = Window.orderBy(F.desc("n_abs")).rowsBetween(Window.unboundedPreceding, 0)
        classes = classes.withColumn("upto", F.sum("n").over(down))
        asked = F.explode(F.array(*(F.lit(n).cast("long") for n in self.sizes))).alias("size")
        met = classes.select("*", asked).filter("upto >= size").groupBy("size").agg(F.max_by(F.struct("n_abs", "n", "upto"), "n_abs").alias("c"))
        #: size -> (count of its class, letters compared, what they are at most); no letters: the whole class is in.
        self.cuts = {r["size"]: (r["c"]["n_abs"], 0, "") for r in met.collect()}
        still_open = {r["size"]: (r["size"] - r["c"]["upto"] + r["c"]["n"], "") for r in met.collect() if r["size"] < r["c"]["upto"]}
        while still_open:
            still_open = self._refined(frequency, still_open)

    def _refined(self, frequency: DataFrame, still_open: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
        """size -> (rank left, prefix) with longer prefixes; closes those of which the rank is the prefix's last."""
        rows = [(size, self.cuts[size][0], rank, prefix) for size, (rank, prefix) in still_open.items()]
        asked = frequency.sparkSession.createDataFrame(rows, "size long, n_abs long, rank long, prefix string")
        met = frequency.join(F.broadcast(asked), "n_abs").filter(F.startswith("sequence", "prefix"))
        longer = F.substring("sequence", F.lit(1), F.length("prefix") + PREFIX_STEP).alias("longer")
        counts = met.groupBy("size", "rank", longer).agg(F.count("*").alias("n"))
        up = Window.partitionBy("size").orderBy("longer").rowsBetween(Window.unboundedPreceding, 0)  # 21^3 prefixes at most
        over = counts.withColumn("upto", F.sum("n").over(up)).filter("upto >= rank")
        left = {}
        for r in over.groupBy("size").agg(F.min_by(F.struct("longer", "n", "upto", "rank"), "longer").alias("c")).collect():
            size, c = r["size"], r["c"]
            if c["upto"] == c["rank"]:
                self.cuts[size] = self.cuts[size][0], len(still_open[size][1]) + PREFIX_STEP, c["longer"]
            else:
                left[size] = c["rank"] - c["upto"] + c["n"], c["longer"]
        return left

    def least(self) -> Column:
        """The least of the sizes that a peptide is within; null if none."""
        out = F.lit(None).cast("long")
        for size in reversed(self.sizes):
            count, letters, most = self.cuts.get(size, (0, 0, ""))  # a size beyond all peptides takes them all
            inside = F.col("n_abs") > count
            last = F.col("n_abs") == count
            inside = inside | (last & (F.substring("sequence", 1, letters) <= most) if letters else last)
            out = F.when(inside, F.lit(size).cast("long")).otherwise(out)
        return out


def stored_frequency(pairs: DataFrame) -> DataFrame:
    return materialized(pairs.groupBy("sequence").agg(F.count("*").alias("n_abs")), "frequency")


#: Peptides of a size that are broadcast in coverage.
NEAR_ROWS = 100_000


def coverage(pairs: DataFrame, sizes: list[int]) -> DataFrame:
    """Antibodies hit by the N most frequent peptides, for every N at once: n_peptides, n_antibodies, percent.

    Each antibody keeps the least N that one of its peptides is within, and those are counted against all N in one pass.
    Pairs are written once. The most frequent peptides are broadcast, so pairs stay where they lie; antibodies that have
    none of them alone meet all others.
    """
    from tessera.operators import sets

    pairs = materialized(pairs.filter("sequence IS NOT NULL").select("antibody_id", "sequence"), "pairs")
    frequency = stored_frequency(pairs)
    within = frequency.select("sequence", TopSelection(frequency, sizes).least().alias("within"))
    near = F.broadcast(within.filter(F.col("within") <= max((n for n in sizes if n <= NEAR_ROWS), default=0)))
    best = materialized(pairs.join(near, "sequence", "left").groupBy("antibody_id").agg(F.min("within").alias("within")), "nearest")
    others = pairs.join(best.filter("within IS NULL").select("antibody_id"), "antibody_id", "left_semi")
    others = within.join(sets.small(others), "sequence").groupBy("antibody_id").agg(F.min("within").alias("within"))
    best = best.filter("within IS NOT NULL").unionByName(others)
    hits = best.agg(F.count("*").alias("total"), *(F.count_if(F.col("within") <= n).alias(f"n{n}") for n in sizes))
    rows = F.explode(F.array(*(F.struct(F.lit(n).cast("long").alias("n_peptides"), F.col(f"n{n}").alias("n_antibodies")) for n in sizes)))
    return hits.select("total", rows.alias("r")).select("r.*", F.round(F.col("r.n_antibodies") / F.col("total") * 100, 3).alias("percent"))


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    return df.orderBy(*order).limit(n)


def by_number_in_name(files: DataFrame, column: str = "filename") -> DataFrame:
    """Files by the number after D in their name, highest first."""
    number = F.regexp_extract(column, r"D(\d+)", 1).cast("long")
    return files.withColumn("number", number).orderBy(F.desc_nulls_last("number"), column)
