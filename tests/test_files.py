from __future__ import annotations

import gzip
from datetime import date

from tessera.sources import files, sinks


def _unit(path, metadata, header, rows):
    with gzip.open(path, "wt") as f:
        f.write("\n".join([metadata, header, *rows]) + "\n")


def test_units_and_metadata(spark, tmp_path):
    _unit(tmp_path / "r1_Heavy_IGHG.csv.gz", '"{""Disease"": ""None"", ""Subject"": NaN, ""Age"": [""1"", ""2""], ""Unique sequences"": 3}"',
          "v_call,sequence_alignment_aa,d_call,j_call,cdr1_aa,cdr2_aa,cdr3_aa,more", ["IGHV1*01,QVQ,D,J,A,B,C,x", "IGHV2,,D,J,A,B,C,x", '"IG,HV3",EVQ,,J,A,B,C,x'])
    _unit(tmp_path / "r2_Heavy_Bulk.csv.gz", '"{""Disease"": ""Flu"", ""Subject"": ""S1""}"', ",".join(files.UNIT_COLUMNS), ["AAA,V,D,J,1,2,3"])
    rows = {r["sequence_alignment_aa"]: r for r in files.read_units(spark, str(tmp_path)).collect()}
    assert set(rows) == {"QVQ", "EVQ", "AAA"}
    assert rows["EVQ"]["v_call"] == "IG,HV3" and rows["EVQ"]["d_call"] is None and rows["AAA"]["filename"] == "r2_Heavy_Bulk.csv.gz"
    meta = {r["filename"]: r for r in files.read_unit_metadata(spark, str(tmp_path), ["Disease", "Subject", "Age", "Unique sequences"]).collect()}
    assert meta["r1_Heavy_IGHG.csv.gz"]["Subject"] is None and meta["r1_Heavy_IGHG.csv.gz"]["Age"] == "1, 2"
    assert meta["r1_Heavy_IGHG.csv.gz"]["Unique sequences"] == "3" and meta["r2_Heavy_Bulk.csv.gz"]["Age"] is None


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_bytes(b">sp|P1|A x > y\r\nAC\r\nDE\r\n>B\nFG\n\n>C")
    got = {r["name"]: r["sequence"] for r in files.read_fasta(spark, str(tmp_path / "a.fasta")).collect()}
    assert got == {"sp|P1|A x > y": "ACDE", "B": "FG", "C": ""}
    df = spark.createDataFrame([("h", "A" * 61), ("i", "C" * 60)], "h string, s string")
    lines = {r["value"] for r in sinks.fasta_lines(df, "h", "s", 60).collect()}
    assert lines == {">h\n" + "A" * 60 + "\nA", ">i\n" + "C" * 60}


def test_manifest(spark):
    df = spark.createDataFrame([("wget https://x.org/Study_1/csv/run1_Heavy_IGHG.csv.gz",), ("# no",), (None,)], "value string")
    assert [tuple(r) for r in files.parse_manifest(df).collect()] == [
        ("https://x.org/Study_1/csv/run1_Heavy_IGHG.csv.gz", "run1_Heavy_IGHG.csv.gz", "Study_1", "IGHG")]


def test_served_partitions_and_append(spark, tmp_path):
    df = spark.createDataFrame([("D1", 1), ("D2", 2)], "disease_no string, x int")
    sinks.write_served(df, str(tmp_path / "t"))
    sinks.write_served(df.filter("disease_no = 'D1'").selectExpr("disease_no", "x + 10 AS x"), str(tmp_path / "t"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).select("disease_no", "x").collect()} == {("D1", 11), ("D2", 2)}
    for _ in range(2):
        sinks.write_csv(df, str(tmp_path / "c"), gzip=True, mode="append")
    assert files.read_csv(spark, str(tmp_path / "c")).count() == 4
    assert files.read_csv(spark, str(tmp_path / "c"), columns=["x"]).columns == ["x"]


def test_tolerant_scan_and_listing(spark, tmp_path):
    spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(str(tmp_path / "in"))
    (tmp_path / "in" / "bad.parquet").write_bytes(b"PAR1 this is no file PAR1")
    rows, skipped = files.read_tolerant(spark, str(tmp_path / "in"), "x int", glob="*.parquet")
    assert rows.count() == 1 and [r["filename"] for r in skipped.collect()] == ["bad.parquet"]
    assert files.list_files(spark, str(tmp_path / "in"), "bad*").count() == 1


def test_units_of_one_name_in_two_folders(spark, tmp_path):
    for folder, header, row in (("a", "v_call,sequence_alignment_aa", "V1,QVQ"), ("b", "sequence_alignment_aa,v_call", "EVQ,V2")):
        (tmp_path / folder).mkdir()
        _unit(tmp_path / folder / "r.csv.gz", '"{""Disease"": ""' + folder + '""}"', header, [row])
    got = {(r["sequence_alignment_aa"], r["v_call"]) for r in files.read_units(spark, str(tmp_path), ["sequence_alignment_aa", "v_call"]).collect()}
    assert got == {("QVQ", "V1"), ("EVQ", "V2")}


def test_report_tells_empty_from_unreadable(spark, tmp_path):
    whole = gzip.compress("\n".join(["x,y", *(f"{k},{k * 7919 % 100003}" for k in range(20_000))]).encode())
    (tmp_path / "whole.csv.gz").write_bytes(whole)
    (tmp_path / "half.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "none.csv.gz").write_bytes(gzip.compress(b"x,y\n"))
    assert {r["filename"]: r["status"] for r in files.file_report(spark, str(tmp_path), "csv").collect()} == {"whole.csv.gz": "read", "half.csv.gz": "unreadable", "none.csv.gz": "empty"}
    rows, skipped = files.read_tolerant(spark, str(tmp_path), "x int, y int", "csv")
    assert rows.count() == 20_000 and [r["filename"] for r in skipped.collect()] == ["half.csv.gz"]


def test_export_names():
    day = date(2024, 9, 1)
    assert [sinks.export_name("Flu", k, day) for k in ("csv", "fasta", "plus")] == ["Flu_filtered_2024-09-01.csv", "Flu_2024-09-01.fasta", "Flu_plus_2024-09-01.fasta"]


def test_served_look_ups_skip_row_groups(spark, tmp_path):
    """Files are in order of the sequence and have Bloom filters on it."""
    import duckdb
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(400_000).select(F.concat(F.lit("P"), F.sha2(F.col("id").cast("string"), 256)).alias("sequence"), F.lit("D1").alias("disease_no"), "id")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        sinks.write_served(df, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wanted, absent = df.filter("id = 77").first()["sequence"], "P" + "0" * 64
    parts = [str(p) for p in (tmp_path / "t").rglob("*.parquet")]
    for p in parts:
        x = pq.read_table(p, columns=["sequence"])["sequence"].to_pylist()
        assert x == sorted(x)
    probe = lambda v: [r[0] for p in parts for r in duckdb.sql(f"SELECT bloom_filter_excludes FROM parquet_bloom_probe('{p}', 'sequence', '{v}')").fetchall()]
    assert all(probe(absent)) and not all(probe(wanted))
    assert spark.read.parquet(str(tmp_path / "t")).filter(F.col("sequence") == wanted).count() == 1
