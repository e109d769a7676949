"""Readers: manifests, repertoire data units, their metadata headers, FASTA, digest text, listings."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns that a data unit must have.
UNIT_COLUMNS = ["sequence_alignment_aa", "v_call", "d_call", "j_call", "cdr1_aa", "cdr2_aa", "cdr3_aa"]
_METADATA_LINE = r'^"?\{'


def parse_manifest(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines `wget <url>` -> url, filename, study, isotype. Other lines give no row."""
    url = F.regexp_extract(F.col(line), r"^\s*wget\s+(\S+)", 1)
    parts = F.split("url", "/")
    rows = lines.select(url.alias("url")).filter("url <> ''")
    rows = rows.withColumn("filename", F.element_at(parts, -1))
    # .../<study>/csv/<run>_<chain>_<isotype>.csv.gz
    study = F.when(F.size(parts) >= 3, F.element_at(parts, -3))
    return rows.select("url", "filename", study.alias("study"), F.regexp_extract("filename", r"_([^_.]+)\.csv\.gz$", 1).alias("isotype"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_manifest(spark.read.text(path))


def unquoted_json(line: Column) -> Column:
    """A quoted JSON metadata line as JSON: NaN to null, outer quotes off, doubled quotes single."""
    bare = F.regexp_replace(F.regexp_replace(line, r'^"|"$', ""), '""', '"')
    return F.regexp_replace(bare, r":\s*NaN\b", ": null")


def read_unit_metadata(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """filename, path and the wanted keys (text) of each unit's metadata line; keys a file lacks are null, lists are joined."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).filter(F.col("value").rlike(_METADATA_LINE))
    found = F.from_json(unquoted_json(F.col("value")), T.MapType(T.StringType(), T.StringType()))
    rows = lines.select(F.col("_metadata.file_name").alias("filename"), F.col("_metadata.file_path").alias("path"), found.alias("m"))
    as_list = lambda c: F.from_json(c, T.ArrayType(T.StringType()))
    value = lambda k: F.when(F.startswith(F.col("m")[k], F.lit("[")), F.concat_ws(", ", as_list(F.col("m")[k]))).otherwise(F.col("m")[k])
    return rows.select("filename", "path", *(value(k).alias(k) for k in keys))


def read_units(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of data units (columns as text, filename and path): the metadata line is skipped and the next is the header.

    Files may order or add columns: each file's header is found first, by its path, and a value is taken by its place there.
    A header is one row a file, as a listing of the files is, so rows meet it by broadcast.
    Null and empty sequences are dropped, as an anti join never matches a null.
    """
    columns = columns or UNIT_COLUMNS
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.select(F.col("_metadata.file_name").alias("filename"), F.col("_metadata.file_path").alias("path"), "value").filter(~F.col("value").rlike(_METADATA_LINE))
    is_header = F.col("value").contains(columns[0])
    names = F.transform(F.split("value", ","), lambda x: F.trim(F.regexp_replace(x, '^"|"$', "")))
    headers = lines.filter(is_header).groupBy("path").agg(F.first(names).alias("names"))
    rows = lines.filter(~is_header).join(F.broadcast(headers), "path")  # one row a file, as in any listing
    cell = F.split("value", r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    rows = rows.withColumn("cells", F.transform(cell, lambda x: F.regexp_replace(x, '^"|"$', "")))
    at = lambda c: F.array_position("names", c).cast("int")
    value = lambda c: F.when(at(c) > 0, F.nullif(F.try_element_at("cells", at(c)), F.lit("")))
    out = rows.select(*(value(c).alias(c) for c in columns), "filename", "path")
    return out.filter(F.col(columns[0]).isNotNull())


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, columns: list[str] | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header, plain or gzip; inferred without a schema."""
    reader = spark.read.option("header", "true").option("sep", sep)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)
    return df.select(*columns) if columns else df


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """FASTA -> name, sequence. Records begin with > at a line's start; a sequence's white space is dropped."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^>|\r", "").alias("r"))
    name = F.trim(F.substring_index("r", "\n", 1))
    body = F.when(F.instr("r", "\n") > 0, F.expr("substring(r, instr(r, '\n') + 1)")).otherwise("")
    return records.filter(F.trim("r") != "").select(name.alias("name"), F.regexp_replace(body, r"\s+", "").alias("sequence"))


def read_digest_text(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Delimited digest output -> Protein_Name, Sequence."""
    return read_csv(spark, path, "Protein_Name string, Sequence string", sep=sep)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, filename, size of all files below a folder that match; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("size"))


def as_text(df: DataFrame) -> DataFrame:
    """All columns cast to text."""
    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))


def union_filled(*tables: DataFrame) -> DataFrame:
    """All rows of the tables by column name, null where a table lacks a column."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def file_report(spark: SparkSession, path: str, fmt: str = "parquet", glob: str = "*") -> DataFrame:
    """filename, path, status of each file: read, empty (readable, without a row) or unreadable (which a file broken half-way is)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)

    @F.pandas_udf("string")
    def status(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        def of(name: str, content: bytes) -> str:
            try:
                if fmt == "parquet":
                    rows = pq.ParquetFile(pa.BufferReader(content)).read().num_rows
                else:
                    data = gzip.decompress(content) if name.endswith(".gz") else content
                    rows = len(data.split(b"\n", 2)[1:]) and data.split(b"\n", 2)[1].strip()
            except (OSError, EOFError, zlib.error, pa.ArrowException):
                return "unreadable"
            return "read" if rows else "empty"

        for names, contents in batches:
            yield pd.Series([of(n, c) for n, c in zip(names, contents)], dtype=object)

    return files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path", status("path", "content").alias("status"))


def read_tolerant(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """Rows of all readable files, with filename, and the names of unreadable files, none of whose rows are taken."""
    report = file_report(spark, path, fmt, glob)
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("ignoreCorruptFiles", "true")
    reader = reader.option("header", "true") if fmt == "csv" else reader
    rows = reader.format(fmt).load(path).withColumn("filename", F.col("_metadata.file_name"))
    broken = report.filter("status = 'unreadable'")
    place = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z0-9]+:/+", "/")
    rows = rows.withColumn("__path", place).join(broken.select(F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("__path")), "__path", "left_anti").drop("__path")
    return rows, broken.select("filename")
