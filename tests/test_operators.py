from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import facets, ranking, sets
from tessera.plans import jobs
from tessera.sources import sinks


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_set_operators(spark):
    df = spark.createDataFrame([("A", "D1"), ("A", "D2"), ("B", "D1"), ("B", "D1"), ("C", "D2")], "sequence string, disease string")
    assert {r["sequence"] for r in sets.exclusive(df, "disease").collect()} == {"B", "C"}
    other = spark.createDataFrame([("B",), (None,)], "sequence string")
    assert {r["sequence"] for r in sets.subtract(df, other).collect()} == {"A", "C"}
    assert {(r["sequence"], r["m"]) for r in sets.flag_members(df, other, "sequence", "m").collect()} == {("A", 0), ("B", 1), ("C", 0)}
    with pytest.raises(ValueError, match="several"):
        sets.exactly_one(df)
    with pytest.raises(ValueError, match="none"):
        sets.exactly_one(df.limit(0))


def test_minimum_support_is_exclusive_and_drops_null(spark):
    df = spark.range(205).select(F.when(F.col("id") < 100, "p100").when(F.col("id") < 201, "p101").alias("patient"))
    assert {r["patient"] for r in sets.minimum_support(df, "patient", 100).collect()} == {"p101"}


def test_patients_of_a_peptide_count_null(spark):
    df = spark.createDataFrame([("A", "P1"), ("A", None), ("A", "P1"), ("B", "P1")], "sequence string, patient string")
    assert {(r["sequence"], r["n"]) for r in sets.distinct_counts_to_rows(df, "sequence", "patient", "n").collect()} == {("A", 2), ("B", 1)}


def test_catalog_ties_and_control(spark):
    m = spark.createDataFrame([("b", 5), ("a", 5), ("None", 99), ("c", 7)], "disease string, unique_sequences long")
    assert {(r["disease"], r["disease_no"]) for r in ranking.disease_catalog(m).collect()} == {("c", "D1"), ("a", "D2"), ("b", "D3"), ("None", "None")}


def test_row_numbers_are_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    assert [(r["x"], r["row_id"]) for r in ranking.row_numbers(df, [F.col("x")]).orderBy("x").collect()] == [(i, i + 1) for i in range(1000)]


@pytest.mark.parametrize("partitions", ["2", "7", "32"])
def test_row_numbers_keep_wide_rows(spark, partitions):
    """Columns beside the order make the counts' plan unlike the rows'; ids must be 1..N all the same."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(60_000).select((F.col("id") * 7919 % 60_000).alias("x"), *(F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias(f"c{k}") for k in range(3)), F.lit(0).alias("part"), F.lit(1).alias("row"))
        got = ranking.row_numbers(df, [F.col("x")])
        assert got.columns == [*df.columns, "row_id"]
        assert got.agg(F.count("*"), F.count_distinct("row_id"), F.count_if(F.col("row_id") == F.col("x") + 1)).first()[:] == (60_000, 60_000, 60_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_retry_runs_what_the_ledger_lacks(spark):
    done, asked = ["a"], []

    def process(units):
        names = sorted(r["filename"] for r in units.collect())
        asked.append(names)
        done.extend(names[:1])

    left = jobs.process_with_retry(spark.createDataFrame([(c,) for c in "abc"], "filename string"), lambda: spark.createDataFrame([(d,) for d in done], "filename string"), process, 3)
    assert asked == [["b", "c"], ["c"]] and left.isEmpty()


def test_patients_of_a_disease_are_those_of_the_metadata(spark):
    peptides = spark.createDataFrame([("D1", "A", "P1", "IGHG", 1, 1)], "disease_no string, sequence string, patient string, isotype string, n_antibody int, n_patient int")
    antibodies = spark.createDataFrame([("D1", "AAA")], "disease_no string, sequence_alignment_aa string")
    catalog = spark.createDataFrame([("Flu", "D1")], "disease string, disease_no string")
    meta = spark.createDataFrame([("Flu", "P1"), ("Flu", "P2"), ("Flu", None), ("Flu", None)], "disease string, patient string")
    assert jobs.disease_summary(peptides, antibodies, catalog, meta).first()["n_patient"] == 3


def test_one_disease_reads_one_partition(spark, tmp_path):
    from tessera.sources import sinks

    df = spark.createDataFrame([("D1", 1), ("D2", 2)], "disease_no string, x int")
    sinks.write_served(df, str(tmp_path / "t"))
    one = sets.one_disease(spark.read.parquet(str(tmp_path / "t")), "D1")
    assert "PartitionFilters: [isnotnull(disease_no" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1


def test_coverage_grows_with_n(spark):
    pairs = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "2"), ("C", "3")], "sequence string, antibody_id string")
    got = {r["n_peptides"]: (r["n_antibodies"], r["percent"]) for r in ranking.coverage(pairs, [1, 2, 10]).collect()}
    assert got == {1: (2, 66.667), 2: (2, 66.667), 10: (3, 100.0)}


def test_facets_and_grid(spark):
    df = spark.createDataFrame(
        [("A", "en", "T1", "IGHG", 1, 1, 4, 1), ("B", "en", "T2", "Bulk", 2, 3, 5, 0), ("C", "de", "T1", "odd", 1, 1, 5, 0)],
        "sequence string, bsource string, btype string, isotype string, n_patient int, n_antibody int, length_aa int, cdr3 int")
    assert [r["sequence"] for r in facets.facet_query(df).collect()] == ["A"]
    assert {r["sequence"] for r in facets.facet_query(df, unique="Either", cdr3="No", n_antibody=(1, 3)).collect()} == {"B", "C"}
    grid = facets.isotype_uniqueness(df)
    assert grid.count() == 19 and grid.filter("label = 'IGHA:Unique'").first()["value"] == 0
    assert [tuple(r) for r in grid.filter("parent = ''").collect()] == [("Total", "", 2)]  # of known isotypes
    tree = {(r["label"], r["parent"]): r["value"] for r in facets.hierarchy_counts(df, "bsource", "btype").collect()}
    assert tree[("Total", "")] == 3 and tree[("en", "Total")] == 2 and tree[("de:T1", "de")] == 1
    wide = facets.isotype_table(df.withColumn("disease_no", F.lit("D1"))).first()
    assert (wide["IGHG"], wide["IGHA"]) == (1, 0)


def test_subtractions_commute(spark):
    df = spark.createDataFrame([(c, d) for c, d in zip("ABCDEF", "112233")], "sequence string, disease string")
    x = spark.createDataFrame([("A",), ("C",)], "sequence string")
    y = spark.createDataFrame([("D",)], "sequence string")
    assert _rows(sets.subtract(sets.subtract(df, x), y)) == _rows(sets.subtract(sets.subtract(df, y), x))


def test_archived_build(spark):
    digest = spark.createDataFrame([("f__x__1", "AAAK"), ("f__x__1", "STD"), ("g__2", "CCCK")], "Protein_Name string, Sequence string")
    std = spark.createDataFrame([("STD",)], "sequence string")
    units = spark.createDataFrame([("f", "BP", "P1"), ("g", "BP", None)], "data_id string, bioproject string, patient_id string")
    ab = spark.createDataFrame([(1, "IGHV1*02"), (2, "IGHV2")], "antibody_id long, v_call string")
    assert _rows(jobs.archived_build(digest, std, units, ab, 0)) == [("AAAK", "f", 1, "BP", "P1", "IGHV1")]


def test_patients_and_isotypes_need_no_window_and_no_copies(spark):
    """Plans of the builds: distinct patients by two aggregates, isotypes by bits."""
    keys = "disease string, sequence string"
    stats = spark.createDataFrame([("Flu", "A", 1, 1)], f"{keys}, n_antibody long, length_aa int")
    by_file = spark.createDataFrame([("Flu", "A", "f1"), ("Flu", "A", "f2")], f"{keys}, filename string")
    meta = spark.createDataFrame([("f1", "P1", "b", "t", "IGHG"), ("f2", None, "b", "t", "Bulk")], "filename string, patient string, bsource string, btype string, isotype string")
    catalog = spark.createDataFrame([("Flu", "D1")], "disease string, disease_no string")
    table = jobs.peptide_table(stats, by_file, spark.createDataFrame([], keys), meta, catalog)
    assert {(r["filename"], r["n_patient"], r["cdr3"]) for r in table.collect()} == {("f1", 2, 0), ("f2", 2, 0)}
    antibodies = spark.createDataFrame([("D1", "AAA")], "disease_no string, sequence_alignment_aa string")
    summary = jobs.disease_summary(table, antibodies, catalog, meta.withColumn("disease", F.lit("Flu")))
    row = summary.first()
    assert (row["no"], row["file_db"], row["n_peptide"], row["n_peptide_ighg"], row["n_peptide_bulk"], row["n_peptide_ighm"]) == (1, "D1_Flu", 1, 1, 1, 0)
    for df in (table, facets.isotype_table(table)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Expand" not in plan
    # n_antibody alone is counted by distinct values, of one column
    assert "Expand" not in summary._jdf.queryExecution().executedPlan().toString()


def test_bucketed_peptide_files_need_no_exchange(spark, tmp_path):
    """The served table off rows bucketed by sequence: equal to plain Python, a third of the antibodies hold one peptide; exchanges are the CDR3 side's."""
    import random

    rng = random.Random(4)
    digested = [(rng.choice(["Flu", "HIV", "None", None]), f"ab{k}", rng.choice(["AAAK", "HOTK"]) if k % 3 else f"P{rng.randint(1, 40)}K", rng.sample(["f1", "f2", "f3"], rng.randint(1, 3))) for k in range(600)]
    digested = [(d if s != "HOTK" else "Flu", a, s, f) for d, a, s, f in digested] + [(None, "odd", "HOTK", ["f1"]), ("Flu", "odd2", "P1K", [])]
    df = spark.createDataFrame(digested, "disease string, antibody_id string, sequence string, filenames array<string>")
    df = df.filter(F.size("filenames") > 0)
    meta = spark.createDataFrame([("f1", "P1", "b", "t", "IGHG"), ("f2", "P1", "b", "t", "Bulk"), ("f3", None, "b", "t", "Bulk")], "filename string, patient string, bsource string, btype string, isotype string")
    catalog = spark.createDataFrame([("Flu", "D1"), ("HIV", "D2")], "disease string, disease_no string")
    cdr3 = spark.createDataFrame([("Flu", "HOTK"), ("HIV", "HOTK"), ("HIV", "P2K"), (None, "P3K")], "disease string, sequence string")
    path = str(tmp_path / "files")
    files = sinks.write_bucketed(jobs.peptide_files(df), path, buckets=3)
    stats = jobs.file_statistics(files)
    assert _rows(stats) == _rows(jobs.specific_statistics(df))
    table = jobs.peptide_table(stats, files, cdr3, meta, catalog)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1, plan  # of the CDR3 peptides
    patient, want = {"f1": "P1", "f2": "P1", "f3": None}, set()
    for s in {r[2] for r in digested}:
        rows = [r for r in digested if r[2] == s and r[0] is not None and r[3]]
        if len({r[0] for r in rows}) == 1 and rows[0][0] != "None":
            d, held = rows[0][0], {f for r in rows for f in r[3]}
            mark = int((d, s) in {("Flu", "HOTK"), ("HIV", "HOTK"), ("HIV", "P2K")})
            want |= {({"Flu": "D1", "HIV": "D2"}[d], s, f, len({patient[x] for x in held}), len(rows), len(s), mark) for f in held}
    got = table.select("disease_no", "sequence", "filename", "n_patient", "n_antibody", "length_aa", "cdr3").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) and any(r[1] == "HOTK" for r in want)
    # a session that does not know the table opens its path again; a rewrite replaces it
    spark.sql(f"DROP TABLE {sinks.bucketed_name(path)}")
    again = sinks.open_bucketed(spark, path, "sequence", 3)
    assert _rows(again) == _rows(jobs.peptide_files(df))
    assert "Exchange" not in again.groupBy("sequence").count()._jdf.queryExecution().executedPlan().toString()
    assert sinks.write_bucketed(jobs.peptide_files(df.limit(0)), path, buckets=3).count() == 0
    spark.sql(f"DROP TABLE {sinks.bucketed_name(path)}")


def test_isotypes_of_odd_rows(spark):
    rows = [("D1", "A", "IGHG"), ("D1", "A", "IGHG"), ("D1", "B", None), ("D1", None, "IGHA"), ("D2", "A", "odd"), (None, "C", "Bulk")]
    got = {r["disease_no"]: r.asDict() for r in facets.isotype_table(spark.createDataFrame(rows, "disease_no string, sequence string, isotype string")).collect()}
    assert {k: (r["IGHG"], r["IGHA"], r["Bulk"]) for k, r in got.items()} == {"D1": (1, 0, 0), "D2": (0, 0, 0), None: (0, 0, 1)}


@pytest.mark.parametrize("step", [1, 3])
def test_top_selection_against_a_sort(spark, monkeypatch, step):
    import random

    monkeypatch.setattr(ranking, "PREFIX_STEP", step)
    rng = random.Random(step)
    rows = list({("".join(rng.choice("ABC") for _ in range(rng.randint(1, 7))), n) for n in (1, 1, 1, 2, 5) for _ in range(200)})
    rows = [(s, n) for s, n in {s: n for s, n in rows}.items()]
    df = spark.createDataFrame(rows, "sequence string, n_abs long").repartition(3)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    sizes = [1, 2, 17, 100, len(rows) - 1, len(rows), len(rows) + 5, 10**9]
    got = {r["sequence"]: r["top"] for r in df.select("sequence", ranking.TopSelection(df, sizes).least().alias("top")).collect()}
    assert got == {s: min(n for n in sizes if n > k) for k, (s, _) in enumerate(order)}
    assert df.limit(0).select(ranking.TopSelection(df.limit(0), [5]).least().alias("top")).count() == 0


def test_large_reference_shuffles_what_may_match(spark, monkeypatch):
    monkeypatch.setattr(sets, "is_small", lambda *a: False)
    df = spark.range(20_000).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("sequence"), "id", F.lit(1).alias("__note"))
    df = df.unionByName(spark.createDataFrame([(None, -1, 1)], "sequence string, id long, `__note` int"))
    other = df.filter("id % 50 = 0").select("sequence").unionByName(spark.createDataFrame([(None,)], "sequence string"))
    got = sets.subtract_reference(df, other)
    assert got.columns == df.columns and got.count() == 20_001 - 400 and got.filter("id % 50 = 0").count() == 0 and got.filter("sequence IS NULL").count() == 1
    bitmap = sets.KeyBitmap(other, "sequence", 20)
    assert bitmap.mark(df, "sequence", "may").filter("may").count() < 400 + 60
    monkeypatch.setattr(sets.KeyBitmap, "MOST", 3)
    assert sets.subtract_reference(df, other).count() == 20_001 - 400


def test_small_counts_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert sets.is_small(wide) and not sets.is_small(wide, max_bytes=50_000) and not sets.is_small(wide, max_rows=99)


def _digest(spark, seed=5):
    import random

    rng = random.Random(seed)
    rows = [(rng.choice(["Flu", "HIV", "None", None]), f"ab{k}", rng.choice(["AAAK", "HOTK"]) if k % 3 == 0 else f"P{rng.randint(1, 60)}K", rng.sample(["f1", "f2", "f3", "f4"], rng.randint(1, 4))) for k in range(300)]
    rows = [("Flu" if s == "HOTK" else d, "ab_" + f"{k:064x}", s, f) for k, (d, _, s, f) in enumerate(rows)] + [("Flu", "ab_" + "f" * 64, "HOTK", ["f1"])]
    return spark.createDataFrame(rows, "disease string, antibody_id string, sequence string, filenames array<string>")


def test_specific_table_has_one_exchange_of_rows(spark):
    """Equal to the table off peptides by file; a build's rows are dealt once, by sequence, besides the CDR3 peptides."""
    df = _digest(spark)
    meta = spark.createDataFrame([("f1", "P1", "b", "t", "IGHG"), ("f2", "P1", "b", "t", "Bulk"), ("f3", None, "b", "t", "Bulk")], "filename string, patient string, bsource string, btype string, isotype string")
    catalog = spark.createDataFrame([("Flu", "D1"), ("HIV", "D2")], "disease string, disease_no string")
    cdr3 = spark.createDataFrame([("Flu", "HOTK"), ("HIV", "HOTK"), ("HIV", "P2K"), (None, "P3K")], "disease string, sequence string")
    files = jobs.peptide_files(df)
    want, got = jobs.peptide_table(jobs.file_statistics(files), files, cdr3, meta, catalog), jobs.specific_table(df, cdr3, meta, catalog)
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    assert got.columns == want.columns and _rows(got) == _rows(want) and got.count() > 0
    assert got.filter("sequence = 'HOTK' AND n_patient = 2").count() == 4  # P1 and none, of four files


def test_specific_pairs_and_stages_in_one_pass(spark):
    pairs = _digest(spark).select("disease", "antibody_id", "sequence")
    got = jobs.specific_pairs(pairs)
    want = jobs.disease_specific(pairs, pairs.filter("disease = 'None'").select("sequence"))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert _rows(got) == _rows(want.select(*got.columns)) and got.count() > 0
    known = pairs.filter("disease <> 'None'")
    stages = facets.stage_counts(digested=known, exclusive=sets.exclusive(known, "disease"), specific=want)
    assert jobs.specific_counts(pairs)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert _rows(jobs.specific_counts(pairs)) == _rows(stages)
    assert [r["n_rows"] for r in jobs.specific_counts(pairs.limit(0)).collect()] == [0, 0, 0]


def test_coverage_looks_further_where_frequent_peptides_miss(spark, monkeypatch):
    import random

    rng = random.Random(3)
    rows = list({(f"P{int(rng.paretovariate(0.5)) % 300}", str(rng.randint(1, 80))) for _ in range(500)}) + [("RARE", "alone"), (None, "none")]
    pairs = spark.createDataFrame(rows, "sequence string, antibody_id string")
    want = {r["n_peptides"]: r["n_antibodies"] for r in ranking.coverage(pairs, [1, 5, 20, 50, 100_000]).collect()}
    rank = {}
    for s, _ in rows:
        rank[s] = rank.get(s, 0) - 1
    order = {s: k for k, s in enumerate(sorted((s for s in rank if s), key=lambda s: (rank[s], s)))}
    assert want == {n: len({a for s, a in rows if s and order[s] < n}) for n in want}
    monkeypatch.setattr(ranking, "NEAR_ROWS", 5)
    assert {r["n_peptides"]: r["n_antibodies"] for r in ranking.coverage(pairs, [1, 5, 20, 50, 100_000]).collect()} == want
