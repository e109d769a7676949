"""Questions to a served peptide table: facet filter, summary card, hierarchies, isotype table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.sequence import uniqueness

#: The isotype domain.
ISOTYPES = ["Bulk", "IGHA", "IGHD", "IGHE", "IGHG", "IGHM"]
FACET_COLUMNS = ["sequence", "bsource", "btype", "isotype", "n_patient", "n_antibody", "length_aa", "cdr3"]


def facet_predicate(
    unique: str = "Yes", cdr3: str = "Yes", n_patient: tuple[int, int] | None = None, n_antibody: tuple[int, int] | None = None,
    bsource: str = "All", btype: str = "All", isotype: str = "All",
) -> Column:
    """Conjunction of seven facets. Ranges are inclusive; None is no bound. All asks nothing."""
    n = F.col("n_antibody")
    asked = [
        {"Yes": n == 1, "No": n > 1, "Either": n >= 1}[unique],
        {"Yes": F.col("cdr3") == 1, "No": F.col("cdr3") == 0, "Either": F.col("cdr3").isin(0, 1)}[cdr3],
    ]
    asked += [F.col(c).between(*r) for c, r in (("n_patient", n_patient), ("n_antibody", n_antibody)) if r]
    asked += [F.col(c) == v for c, v in (("bsource", bsource), ("btype", btype), ("isotype", isotype)) if v != "All"]
    out = asked[0]
    for a in asked[1:]:
        out = out & a
    return out


def facet_query(table: DataFrame, **facets) -> DataFrame:
    """Rows of the table that meet all facets, duplicates kept."""
    return table.filter(facet_predicate(**facets)).select(*FACET_COLUMNS)


def summary_card(rows: DataFrame) -> DataFrame:
    """Counts of rows, and of different peptides, which are fewer where a peptide is in several files."""
    return rows.agg(
        F.count("*").alias("n_rows"), F.count_distinct("sequence").alias("n_sequences"), F.count_if(F.col("n_antibody") == 1).alias("n_unique"), F.count_if(F.col("n_antibody") > 1).alias("n_non_unique"),
        F.count_if(F.col("cdr3") == 1).alias("n_cdr3"), F.count_if(F.col("cdr3") == 0).alias("n_non_cdr3"))


def facet_cells(served: DataFrame) -> DataFrame:
    """The served table counted by all facets: a row for each combination, n rows of it, and its largest measures.

    Cards, trees and ranges of choices are sums and maxima over these few rows, which are written beside the table.
    """
    n = F.col("n_antibody")
    return served.groupBy("disease_no", "bsource", "btype", "isotype", uniqueness(n).alias("uniqueness"), "cdr3").agg(
        F.count("*").alias("n"), F.max(n).alias("max_antibody"), F.max("n_patient").alias("max_patient"))


def cells_card(cells: DataFrame) -> DataFrame:
    """summary_card but for different peptides, which cells cannot tell."""
    n_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    kind, cdr3 = F.col("uniqueness"), F.col("cdr3")
    return cells.agg(
        n_if(F.lit(True)).alias("n_rows"), n_if(kind == "Unique").alias("n_unique"), n_if(kind == "non-Unique").alias("n_non_unique"),
        n_if(cdr3 == 1).alias("n_cdr3"), n_if(cdr3 == 0).alias("n_non_cdr3"))


def _weight(rows: DataFrame) -> Column:
    """Rows that a row stands for."""
    return F.col("n") if {"n", "uniqueness"} <= {*rows.columns} else F.lit(1).cast("long")


def hierarchy_counts(rows: DataFrame, upper: str, lower: str, root: str = "Total") -> DataFrame:
    """label, parent, value of a two-level tree, of rows or cells: a rollup gives all three levels in one pass. A null group is called NA."""
    named = rows.select(F.coalesce(upper, F.lit("NA")).alias("u"), F.coalesce(lower, F.lit("NA")).alias("l"), _weight(rows).alias("n"))
    got = named.rollup("u", "l").agg(F.sum("n").alias("value"), F.grouping_id().alias("level"))
    label = F.when(F.col("level") == 3, F.lit(root)).when(F.col("level") == 1, F.col("u")).otherwise(F.concat_ws(":", "u", "l"))
    parent = F.when(F.col("level") == 3, F.lit("")).when(F.col("level") == 1, F.lit(root)).otherwise(F.col("u"))
    return got.select(label.alias("label"), parent.alias("parent"), "value")


def isotype_uniqueness(rows: DataFrame, root: str = "Total") -> DataFrame:
    """label, parent, value, of rows or cells: a root, isotypes and, in each, unique and other peptides; all twelve leaves, 0 where none."""
    spark = rows.sparkSession
    kind = F.col("uniqueness") if "uniqueness" in rows.columns else uniqueness(F.col("n_antibody"))
    counts = rows.groupBy("isotype", kind.alias("kind")).agg(F.sum(_weight(rows)).alias("value"))
    grid = spark.range(1).select(F.explode(F.array(*map(F.lit, ISOTYPES))).alias("isotype")).select(
        "isotype", F.explode(F.array(F.lit("Unique"), F.lit("non-Unique"))).alias("kind"))
    leaves = grid.join(counts, ["isotype", "kind"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    got = leaves.rollup("isotype", "kind").agg(F.sum("value").alias("value"), F.grouping_id().alias("level"))
    label = F.when(F.col("level") == 3, F.lit(root)).when(F.col("level") == 1, F.col("isotype")).otherwise(F.concat_ws(":", "isotype", "kind"))
    parent = F.when(F.col("level") == 3, F.lit("")).when(F.col("level") == 1, F.lit(root)).otherwise(F.col("isotype"))
    return got.select(label.alias("label"), parent.alias("parent"), "value")


def peptide_flags(served: DataFrame, by: str = "disease_no", **kept: Column) -> DataFrame:
    """A row for each (by, sequence): flags, with a bit for each isotype among its rows, and further aggregates.

    Bits are or-ed before the shuffle, so whatever is counted by isotype afterwards needs no distinct and no copy of the rows.
    """
    bit = F.lit(0)
    for k, isotype in enumerate(ISOTYPES):
        bit = F.when(F.col("isotype") == isotype, 1 << k).otherwise(bit)
    return served.groupBy(by, "sequence").agg(F.bit_or(bit).alias("flags"), *(c.alias(n) for n, c in kept.items()))


def has_isotype(isotype: str) -> Column:
    return F.col("flags").bitwiseAND(1 << ISOTYPES.index(isotype)) != 0


def isotype_table(served: DataFrame, by: str = "disease_no") -> DataFrame:
    """Different peptides by disease and isotype, wide, 0 where none. Rows without a peptide count for none."""
    flags = peptide_flags(served.filter("sequence IS NOT NULL"), by)
    return flags.groupBy(by).agg(*(F.count_if(has_isotype(i)).alias(i) for i in ISOTYPES))


def catalog_with_isotypes(catalog: DataFrame, isotypes: DataFrame, on: str = "disease_no") -> DataFrame:
    """Catalog rows with the isotype columns; diseases without a table get 0."""
    return catalog.join(isotypes, on, "left").na.fill(0, ISOTYPES)


def stage_counts(**stages: DataFrame) -> DataFrame:
    """stage, n_rows, n_sequences of each named stage."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.count("*").alias("n_rows"), F.count_distinct("sequence").alias("n_sequences")).select(F.lit(name).alias("stage"), "*")
        out = row if out is None else out.unionByName(row)
    return out
