"""The domain's inputs as they are derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.sequence import patient_key, residues_only
from tessera.operators.ranking import patient_codes


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer parts than the cluster has cores is dealt out first, as digestion multiplies its rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def antibodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as antibodies: the text's residues are the sequence, its source the disease."""
    d = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))
    third = F.col("doc_id") % 3
    # of a generator's column no filter goes below it, where the residues would be worked out a second time
    d = d.select("*", F.explode(F.array(residues_only(F.col("text")))).alias("sequence_alignment_aa")).filter("sequence_alignment_aa <> ''")
    return d.select(
        F.col("doc_id").alias("antibody_no"), "sequence_alignment_aa",
        F.concat(F.lit("IGHV"), (F.col("doc_id") % 7).cast("string"), F.lit("*0"), (F.col("doc_id") % 4).cast("string")).alias("v_call"),
        F.concat(F.lit("IGHJ"), (F.col("doc_id") % 5).cast("string")).alias("j_call"),
        F.substring("sequence_alignment_aa", 20, 30).alias("cdr3_aa"),
        F.concat_ws("_", "source", "lang", third.cast("string")).alias("filename"),
        F.when(F.col("source") == "src0", "None").otherwise(F.col("source")).alias("disease"),
        F.col("lang").alias("bsource"), F.concat(F.lit("T"), third.cast("string")).alias("btype"),
        F.element_at(F.array(F.lit("Bulk"), F.lit("IGHG"), F.lit("IGHM")), (third + 1).cast("int")).alias("isotype"),
        F.col("source").alias("author"), third.cast("string").alias("subject"))


def metadata(spark: SparkSession, sf_dir: str, stored: DataFrame | None = None) -> DataFrame:
    """A row for each file; from `stored` antibodies, if they have been written."""
    keys = ["filename", "disease", "bsource", "btype", "isotype", "author", "subject"]
    m = (stored or antibodies(spark, sf_dir)).groupBy(*keys).agg(F.count("*").alias("unique_sequences"))
    m = m.withColumn("patient_key", patient_key(F.col("author"), F.col("subject")))
    return m.join(patient_codes(m, "patient_key"), "patient_key", "left")


def proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """benchmark as the standard proteome."""
    b = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name = F.concat(F.lit("sp|B"), F.col("item_id").cast("string"), F.lit("|ITEM_"), F.col("item_id").cast("string"))
    return b.select(name.alias("name"), residues_only(F.col("text")).alias("sequence")).filter("sequence <> ''")
