"""Incremental build: new antibody files are digested as they come, each once, in place of a hand-kept ledger.

The checkpoint remembers what was read. A batch's peptides are written to partitions named for the batch, which a
rerun of it overwrites, so a restart adds nothing twice. Exclusivity between diseases can be revoked by later files,
so it is a batch job over all that was gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.sequence import peptides


def digest_new_files(
    spark: SparkSession, source: str, schema: str, standard: DataFrame, out: str, checkpoint: str, rule: str = "trypsin", files_per_batch: int = 1000,
) -> None:
    """Parquet antibodies (sequence_alignment_aa, disease, filename) from a folder -> peptides by disease, all there is now."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select("disease", "filename", "sequence_alignment_aa").filter("sequence_alignment_aa <> ''").distinct()
        found = peptides(rows, "sequence_alignment_aa", ["disease", "filename"], rule, 1, 3).distinct()
        found = found.join(standard, "sequence", "left_anti").withColumn("batch", F.lit(number))
        found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "disease").parquet(out)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
