from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import sequence as S


def _fragments(spark, seq, rule, missed=0):
    df = spark.createDataFrame([(seq,)], "s string")
    return S.with_peptides(df, "s", rule, missed).first()["peptides"]


@pytest.mark.parametrize(("seq", "rule", "expected"), [
    ("AAKPBKCCR", "simple", ["AAKPBK", "CCR"]),
    ("AAKPBKCCR", "trypsin", ["AAKPBK", "CCR"]),
    ("DKDAWKPCRKRRHMRPX", "simple", ["DK", "DAWKPCR", "K", "R", "HMRPX"]),
    ("DKDAWKPCRKRRHMRPX", "trypsin", ["DKDAWK", "PCRK", "R", "RHMR", "PX"]),
    ("AAA", "trypsin", ["AAA"]),
    ("", "simple", []),
    (None, "simple", []),
])
def test_digestion_goldens(spark, seq, rule, expected):
    assert _fragments(spark, seq, rule) == expected


def test_missed_cleavages_are_neighbours(spark):
    assert _fragments(spark, "AAKCCRDD", "simple", 1) == ["AAK", "CCR", "DD", "AAKCCR", "CCRDD"]
    assert _fragments(spark, "AAKCCRDD", "simple", 2)[-1] == "AAKCCRDD"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ACDKPRWMHY", max_size=40), min_size=1, max_size=20))
def test_fragments_join_to_the_sequence(spark, seqs):
    df = spark.createDataFrame([(s,) for s in seqs], "s string")
    for rule in ("simple", "trypsin"):
        for row in df.select("s", F.split("s", S.CUT_RULES[rule]).alias("f")).collect():
            assert "".join(row["f"]) == row["s"]


def test_mass_and_names(spark):
    df = spark.createDataFrame([("GG", "sp|P1|NAME_HUMAN text", "NP_1.2 text", "IGHV1*01", "a__b__12")], "s string, u string, r string, v string, c string")
    file, number = S.name_parts(F.col("c"))
    row = df.select(
        S.peptide_mass(F.col("s")).alias("mass"), S.accession_between_pipes(F.col("u")).alias("u"), S.accession_first_word(F.col("r")).alias("r"),
        S.gene_of_allele(F.col("v")).alias("v"), file.alias("file"), number.alias("number"), S.patient_key(F.lit("A"), F.lit(None).cast("string")).alias("p"),
        S.partition_name(F.lit("D1"), F.lit("SARS-COV 2")).alias("part"), S.with_thousands(F.lit(1234567)).alias("n"), S.residues_only(F.lit("aßbJk")).alias("res"),
    ).first()
    assert row["mass"] == pytest.approx(2 * 57.02146 + 18.01056)
    assert (row["u"], row["r"], row["v"], row["file"], row["number"]) == ("P1", "NP_1.2", "IGHV1", "a", 12)
    assert (row["p"], row["part"], row["n"], row["res"]) == ("A_NA", "D1_SARS_COV_2", "1,234,567", "AK")


@pytest.mark.parametrize("kind", ["monoisotopic", "average"])
@pytest.mark.parametrize("missed", [0, 1, 2])
def test_peptides_by_mass(spark, kind, missed):
    """Against plain Python; the window is applied within the generator, and the fragments are worked out once."""
    import random

    rng = random.Random(missed)
    rows = [(k, "".join(rng.choice("ACDEFGHIKLMNPQRSTVWYX") for _ in range(rng.choice([0, 3, 60])))) for k in range(60)] + [(60, None)]
    masses, water = S.MASSES[kind]
    want = set()
    for k, s in rows:
        parts = [p for p in re.split(r"(?<=[KR])(?=[^P])", s or "") if p]
        for m in range(missed + 1):
            for i in range(len(parts) - m):
                peptide = "".join(parts[i : i + m + 1])
                mass = water + sum(masses.get(c, 0) for c in peptide)
                if 400 <= mass <= 2000:
                    want.add((k, peptide, round(mass, 6)))
    got = S.peptides_by_mass(spark.createDataFrame(rows, "id int, s string"), "s", ["id"], 400, 2000, "simple", missed, kind)
    found = [(r["id"], r["sequence"], round(r["mass"], 6)) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1 and "Filter" not in plan


def test_masses_of_an_antibody_are_summed_exactly(spark, tmp_path):
    """Sums that end in half a hundredth go up, in whatever order doubles would have been added."""
    from tessera.plans import registry

    texts = ["IQALHKESLCR", "QVLKFCSYKIQTNK", "NGFTKYMYVVRYEIHCK", "AAQKVFCNK"]
    rows = [(k, x, "en", "src1") for k, x in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.o76_o78_missed_by_mass(spark, str(tmp_path))
    units = {r: round(m * 100_000) for r, m in S.RESIDUE_MASS.items()}
    want = []
    for k, x in enumerate(texts):
        parts = re.split(r"(?<=[KR])(?=[^P])", x)
        weights = [1_801_056 + sum(units[c] for c in p) for p in dict.fromkeys(parts + [a + b for a, b in zip(parts, parts[1:])])]
        inside = [w for w in weights if 40_000_000 <= w <= 600_000_000]
        assert sum(inside) % 1000 == 500
        want.append((k, len(inside), sum(inside) // 1000 + 1))
    assert sorted(map(tuple, got.collect())) == want
    assert dict(got.dtypes) == {"antibody_no": "bigint", "n_peptides": "bigint", "mass_1e2": "bigint"}
