from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import facets
from tessera.sources.ledger import Ledger


def _ledger(spark, path):
    return Ledger(spark, str(path), "filename string, x int")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_units_are_done_once_over_failures(spark, tmp_path):
    listing = spark.createDataFrame([(c,) for c in "abcd"], "filename string")
    data = spark.createDataFrame([(c, k) for c in "abc" for k in range(3)], "filename string, x int")  # d has no rows
    asked = []

    def work(units):
        asked.append(sorted(r["filename"] for r in units.collect()))
        return data.join(units, "filename", "left_semi"), units.filter(F.col("filename").isin("a", "d") if len(asked) == 1 else F.lit(True))

    assert _ledger(spark, tmp_path / "l").run(listing, work).isEmpty()
    assert asked == [["a", "b", "c", "d"], ["b", "c"]]
    again = _ledger(spark, tmp_path / "l")
    assert again.run(listing, work).isEmpty() and len(asked) == 2
    assert _rows(again.rows()) == _rows(data) and _rows(again.done()) == [("a",), ("b",), ("c",), ("d",)]


def test_a_crash_leaves_nothing_that_counts(spark, tmp_path):
    """An attempt that fails as it is written, after some of its files; and one whose commit is lost."""
    listing = spark.createDataFrame([("a",), ("b",)], "filename string")
    ledger = _ledger(spark, tmp_path / "l")

    def broken(units):
        return units.withColumn("x", F.when(F.col("filename") == "b", F.raise_error(F.lit("crash")).cast("int")).otherwise(1)), units

    with pytest.raises(Exception, match="crash"):
        ledger.run(listing, broken)
    assert ledger.rows().isEmpty() and ledger.done().isEmpty()
    ledger.attempt(listing, lambda units: (units.withColumn("x", F.lit(1)), units))
    (folder,) = (p for p in (tmp_path / "l").iterdir() if (p / "_SUCCESS").exists())
    (folder / "_SUCCESS").unlink()
    assert _ledger(spark, tmp_path / "l").run(listing, lambda units: (units.withColumn("x", F.lit(2)), units)).isEmpty()
    assert _rows(ledger.rows()) == [("a", 2), ("b", 2)] and not folder.exists()


def test_cells_answer_what_rows_do(spark):
    rows = [("D1", s, b, t, i, n, n + 1, n % 2) for s, b, t, i, n in [("A", "x", "t", "IGHG", 1), ("A", "x", "u", "IGHG", 1), ("B", None, "t", "Bulk", 3), ("C", "y", None, "odd", 2), ("D", "x", "t", None, 1)]]
    served = spark.createDataFrame(rows, "disease_no string, sequence string, bsource string, btype string, isotype string, n_antibody int, n_patient int, cdr3 int")
    cells = facets.facet_cells(served)
    for f in (lambda d: facets.hierarchy_counts(d, "bsource", "btype"), facets.isotype_uniqueness):
        assert sorted(map(tuple, f(cells).collect())) == sorted(map(tuple, f(served).collect()))
    assert facets.cells_card(cells).first().asDict() == facets.summary_card(served).drop("n_sequences").first().asDict()
    assert facets.cells_card(cells.limit(0)).first()["n_rows"] == 0


def test_rows_of_one_unit_are_not_one_task(spark, tmp_path):
    """A join that deals by unit would bring all rows of a unit to one task, and so to one file."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ledger = Ledger(spark, str(tmp_path / "one"), "filename string, x long")
        rows = spark.range(0, 4000, 1, 4).selectExpr("'f' AS filename", "id AS x")
        units = spark.createDataFrame([("f",)], "filename string")
        assert ledger.run(units, lambda left: (rows, left)).isEmpty()
        got = ledger.rows()
        assert got.count() == 4000 and got.selectExpr("input_file_name() AS f").distinct().count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
