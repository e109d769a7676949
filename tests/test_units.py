from __future__ import annotations

import gzip
import json
import os
import random

import pytest

from tessera.sources import files, units

HEAD = '"{""Disease"": ""Flu"", ""Subject"": NaN, ""Age"": [""1"", ""2""], ""Unique sequences"": 3, ""Open"": true}"'


def _unit(path, metadata=HEAD, header="v_call,sequence_alignment_aa,d_call,more", rows=("IGHV1*01,QVQ,D,x", "IGHV2,,D,x", '"IG,HV3",EVQ,,x'), cut=None):
    os.makedirs(path.parent, exist_ok=True)
    whole = gzip.compress("\n".join([metadata, header, *rows, ""]).encode())
    path.write_bytes(whole[:cut] if cut else whole)


def test_rows_metadata_and_outcomes(spark, tmp_path):
    _unit(tmp_path / "a" / "r1.csv.gz")
    _unit(tmp_path / "b" / "r1.csv.gz", '"{""Disease"": ""HIV""}"', "sequence_alignment_aa,v_call", ["AAA,V", "too,many,cells", "CCC,V"])
    (tmp_path / "b" / "_r.csv.gz").write_bytes(b"not listed")
    df = units.scan_units(spark, str(tmp_path), ["sequence_alignment_aa", "v_call", "d_call"], ["Disease", "Subject", "Age", "Unique sequences", "Open"])
    rows = {r["sequence_alignment_aa"]: r for r in df.filter("outcome IS NULL").collect()}
    assert set(rows) == {"QVQ", "EVQ", "AAA", "CCC"}
    assert rows["EVQ"]["v_call"] == "IG,HV3" and rows["EVQ"]["d_call"] is None and rows["AAA"]["d_call"] is None and rows["AAA"]["filename"] == "r1.csv.gz"
    assert rows["QVQ"]["metadata"] == {"Disease": "Flu", "Subject": None, "Age": "1, 2", "Unique sequences": "3", "Open": "true"}
    report = {r["path"].split("/")[-2]: (r["outcome"], r["n_rows"], r["n_odd"]) for r in df.filter("outcome IS NOT NULL").collect()}
    assert report == {"a": ("read", 2, 0), "b": ("read", 2, 1)}
    old = files.read_units(spark, str(tmp_path / "a"), ["sequence_alignment_aa", "v_call"])
    assert {tuple(r) for r in old.select("sequence_alignment_aa", "v_call").collect()} == {("QVQ", "IGHV1*01"), ("EVQ", "IG,HV3")}


def test_broken_files_end_in_an_error_row(spark, tmp_path):
    rng = random.Random(1)
    rows = ["".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(60)) + ",V" for _ in range(200_000)]
    _unit(tmp_path / "whole.csv.gz", header="sequence_alignment_aa,v_call", rows=rows)
    size = os.path.getsize(tmp_path / "whole.csv.gz")
    _unit(tmp_path / "half.csv.gz", header="sequence_alignment_aa,v_call", rows=rows, cut=size * 3 // 4)
    _unit(tmp_path / "odd.csv.gz", "no json", "sequence_alignment_aa,v_call", rows[:3])
    _unit(tmp_path / "bare.csv.gz", header="", rows=[])
    (tmp_path / "void.csv.gz").write_bytes(b"")
    (tmp_path / "noise.csv.gz").write_bytes(b"\x1f\x8b" + rng.randbytes(500))
    found, report = units.read_units_tolerant(spark, str(tmp_path), ["sequence_alignment_aa", "v_call"], ["Disease"])
    assert found.count() == 200_000 and {r["filename"] for r in found.select("filename").distinct().collect()} == {"whole.csv.gz"}
    outcome = {r["filename"]: r for r in report.collect()}
    assert set(outcome) == {"whole.csv.gz", "half.csv.gz", "odd.csv.gz", "bare.csv.gz", "void.csv.gz", "noise.csv.gz"}
    assert [k for k, r in outcome.items() if r["outcome"] == "read"] == ["whole.csv.gz"]
    assert 0 < outcome["half.csv.gz"]["n_rows"] < 200_000  # it was streamed, block by block, and its rows are not taken


def test_files_share_tasks_by_size(tmp_path):
    for k in range(10):
        (tmp_path / f"{k}.gz").write_bytes(b"x" * 100)
    reader = units.UnitReader({"path": str(tmp_path), "columns": json.dumps(["a"]), "keys": "[]", "taskbytes": "250"})
    parts = reader.partitions()
    assert sorted(len(p.paths) for p in parts) == [2] * 5 and sum((p.paths for p in parts), []) == [str(tmp_path / f"{k}.gz") for k in range(10)]


def test_no_files(spark, tmp_path):
    found, report = units.read_units_tolerant(spark, str(tmp_path), ["sequence_alignment_aa"])
    assert found.count() == 0 and report.count() == 0


@pytest.mark.parametrize("line,want", [('"{""a"": NaN, ""b"": ""x NaN""}"', {"a": None, "b": "x NaN"}), ('{"a": 1.5}', {"a": "1.5"})])
def test_metadata_lines(line, want):
    assert units.metadata_of(line) == want
