"""Writers: CSV, served tables by disease, FASTA, and names of exports."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, gzip: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header in every file, so appended files read back alike."""
    df.write.mode(mode).option("header", "true").option("compression", "gzip" if gzip else "none").csv(path)


def write_served(df: DataFrame, path: str, by: str = "disease_no", lookup: str = "sequence") -> None:
    """Parquet partitioned by disease; only the partitions that df holds are replaced, so reruns add no rows twice.

    Rows are dealt by disease first, so a disease has few files; large diseases are split again. Files are in order of the
    look-up column, if df has it, with a Bloom filter on it, so that a search for one value skips row groups and pages.
    """
    rows, found = df.hint("rebalance", by), lookup in df.columns
    # a writer of several partitions sorts by them anyway
    writer = (rows.sortWithinPartitions(by, lookup) if found else rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if found:
        writer = writer.option(f"parquet.bloom.filter.enabled#{lookup}", "true")
    writer.partitionBy(by).parquet(path)


def write_bucketed(df: DataFrame, path: str, by: str = "sequence", buckets: int | None = None) -> DataFrame:
    """Parquet bucketed and sorted by a column, a file a bucket, as a table: groupings and joins on it need no exchange.

    For rows of which no value of the column holds many, as a bucket is a task; aggregate others first. Without a number
    of buckets they are as many as shuffles have partitions. The table is external; `open_bucketed` opens its path again.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, by).write.format("parquet").bucketBy(buckets, by).sortBy(by)
    writer.mode("overwrite").option("path", path).option("compression", "zstd").saveAsTable(bucketed_name(path))
    return df.sparkSession.table(bucketed_name(path))


def bucketed_name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def open_bucketed(spark: SparkSession, path: str, by: str, buckets: int) -> DataFrame:
    """What write_bucketed wrote, in a session whose catalog does not know it."""
    name = bucketed_name(path)
    if not spark.catalog.tableExists(name):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def wrapped(sequence: Column, width: int) -> Column:
    return F.regexp_replace(sequence, f"(.{{{width}}})(?=.)", "$1\n")


def fasta_lines(df: DataFrame, header: str, sequence: str, width: int = 80) -> DataFrame:
    """One text value a record: >header, line feed, wrapped sequence."""
    return df.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), wrapped(F.col(sequence), width)).alias("value"))


def concatenated(*parts: DataFrame) -> DataFrame:
    """FASTA records of several sources, one after the other: value, part."""
    out = None
    for k, p in enumerate(parts):
        p = p.select("value", F.lit(k).alias("part"))
        out = p if out is None else out.unionByName(p)
    return out


def write_fasta(records: DataFrame, path: str) -> None:
    """Records (value) as text files; with a column part, in its order over files."""
    if "part" in records.columns:
        # ranges of a part and a hash: a large source goes to several files
        records = records.withColumn("h", F.xxhash64("value")).repartitionByRange("part", "h").sortWithinPartitions("part", "h")
    records.select("value").write.mode("overwrite").text(path)


def export_name(disease: str, kind: str, day: date | None = None) -> str:
    """<disease>_filtered_<date>.csv, <disease>_<date>.fasta or <disease>_plus_<date>.fasta."""
    day = (day or date.today()).isoformat()
    return {"csv": f"{disease}_filtered_{day}.csv", "fasta": f"{disease}_{day}.fasta", "plus": f"{disease}_plus_{day}.fasta"}[kind]
