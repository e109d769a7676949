"""Amino-acid sequence functions: digestion, masses, substitutions and name parsing, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The twenty standard residues and their monoisotopic masses in dalton, and water's.
RESIDUE_MASS = {
    "A": 71.03711, "C": 103.00919, "D": 115.02694, "E": 129.04259, "F": 147.06841,
    "G": 57.02146, "H": 137.05891, "I": 113.08406, "K": 128.09496, "L": 113.08406,
    "M": 131.04049, "N": 114.04293, "P": 97.05276, "Q": 128.05858, "R": 156.10111,
    "S": 87.03203, "T": 101.04768, "V": 99.06841, "W": 186.07931, "Y": 163.06333,
}
WATER_MASS = 18.01056
# The same residues' average masses, and water's.
AVERAGE_MASS = {
    "A": 71.0788, "C": 103.1388, "D": 115.0886, "E": 129.1155, "F": 147.1766,
    "G": 57.0519, "H": 137.1411, "I": 113.1594, "K": 128.1741, "L": 113.1594,
    "M": 131.1926, "N": 114.1038, "P": 97.1167, "Q": 128.1307, "R": 156.1875,
    "S": 87.0782, "T": 101.1051, "V": 99.1326, "W": 186.2132, "Y": 163.1760,
}
AVERAGE_WATER = 18.01528
MASSES = {"monoisotopic": (RESIDUE_MASS, WATER_MASS), "average": (AVERAGE_MASS, AVERAGE_WATER)}
#: Where a sequence is cut. simple: after K or R, not before P. trypsin: with the enzyme's known exceptions.
CUT_RULES = {
    "simple": r"(?<=[KR])(?=[^P])",
    "trypsin": r"(?<=[KR])(?=[^P])(?<![CD]K(?=D))(?<!CK(?=[HY]))(?<!CR(?=K))(?<!RR(?=[HR]))|(?<=WK)(?=P)|(?<=MR)(?=P)",
}


def residues_only(text: Column) -> Column:
    """Standard residues of a text, upper case; others are dropped first, so no letter grows when upper-cased."""
    letters = "".join(RESIDUE_MASS)
    return F.upper(F.regexp_replace(text, f"[^{letters}{letters.lower()}]+", ""))


def with_peptides(df: DataFrame, sequence: str, rule: str = "trypsin", missed: int = 1, out: str = "peptides") -> DataFrame:
    """Adds the different peptides of each sequence, with up to `missed` cuts left out. Null or empty gives none.

    The fragments are a column of their own, so they are split once and not for each peptide.
    """
    pieces = F.filter(F.split(F.coalesce(F.col(sequence), F.lit("")), CUT_RULES[rule]), lambda x: x != "")
    df = df.withColumn("__fragments", pieces)
    f = F.col("__fragments")

    def joined(m: int) -> Column:
        return F.transform(F.slice(f, 1, F.greatest(F.size(f) - m, F.lit(0))), lambda x, i: F.concat(x, *(F.get(f, i + k) for k in range(1, m + 1))))

    runs = [f, *map(joined, range(1, missed + 1))]
    return df.withColumn(out, F.array_distinct(F.concat(*runs))).drop("__fragments")


def peptides(df: DataFrame, sequence: str, keep: list[str], rule: str = "trypsin", missed: int = 1, longer_than: int = 0) -> DataFrame:
    """Rows (keep..., sequence): one for each different peptide of each row, longer than `longer_than`."""
    df = with_peptides(df, sequence, rule, missed, "__peptides")
    df = df.select(*keep, F.explode(F.filter("__peptides", lambda x: F.length(x) > longer_than)).alias("__peptide"))
    return df.select(*keep, F.col("__peptide").alias("sequence"))


def residues_mass(sequence: Column, kind: str = "monoisotopic") -> Column:
    """Mass of a sequence's residues, without water; letters other than the standard residues weigh nothing."""
    size, total = F.length(sequence), F.lit(0.0)
    for residue, mass in MASSES[kind][0].items():
        total = total + (size - F.length(F.replace(sequence, F.lit(residue), F.lit("")))) * F.lit(mass)
    return total


def peptide_mass(sequence: Column, kind: str = "monoisotopic") -> Column:
    return residues_mass(sequence, kind) + F.lit(MASSES[kind][1])


def mass_units(mass: Column) -> Column:
    """A mass in whole hundred-thousandths, the places that residues have: their sums are exact in any order, those of doubles are not."""
    return F.round(mass * 100000).cast("long")


def peptides_by_mass(
    df: DataFrame, sequence: str, keep: list[str], low: float, high: float, rule: str = "trypsin", missed: int = 0, kind: str = "monoisotopic",
) -> DataFrame:
    """Rows (keep..., sequence, mass): the different peptides of each row whose mass is low to high, with up to `missed` cuts left out.

    A fragment is weighed once. A peptide of several weighs what they do, and peptides outside the window never become rows.
    Masses are rounded to the five places that residues have, so that a peptide weighs the same however it is cut.
    """
    pieces = F.filter(F.split(F.coalesce(F.col(sequence), F.lit("")), CUT_RULES[rule]), lambda x: x != "")
    df = df.withColumn("__fragments", F.transform(pieces, lambda x: F.struct(x.alias("sequence"), residues_mass(x, kind).alias("mass"))))
    f = F.col("__fragments")

    def run(m: int) -> Column:
        """Peptides of m + 1 adjacent fragments."""
        if not m:
            return F.transform(f, lambda x: F.struct(x["sequence"].alias("sequence"), F.round(x["mass"] + F.lit(MASSES[kind][1]), 5).alias("mass")))

        def at(i: Column) -> Column:
            parts = [F.get(f, i + k) for k in range(m + 1)]
            mass = F.lit(MASSES[kind][1])
            for x in parts:
                mass = mass + x["mass"]
            return F.struct(F.concat(*(x["sequence"] for x in parts)).alias("sequence"), F.round(mass, 5).alias("mass"))

        return F.transform(F.slice(f, 1, F.greatest(F.size(f) - m, F.lit(0))), lambda _, i: at(i))

    df = df.withColumn("__found", F.array_distinct(F.concat(*map(run, range(missed + 1)))))
    # the array is filtered within the generator: of a column, Spark would infer a filter and work the array out twice
    inside = F.filter("__found", lambda x: x["mass"].between(low, high))
    return df.select(*keep, F.explode(inside).alias("__peptide")).select(*keep, "__peptide.sequence", "__peptide.mass")


def leucine_for_isoleucine(sequence: Column) -> Column:
    return F.translate(sequence, "I", "L")


def accession_between_pipes(name: Column) -> Column:
    """Text between a header's last two pipes; a header without is left as it is."""
    return F.regexp_replace(name, r"^.*\|(.*?)\|.*$", "$1")


def accession_first_word(name: Column) -> Column:
    return F.regexp_extract(name, r"^(\S+)", 1)


def gene_of_allele(call: Column) -> Column:
    """Gene name of an allele call: all from the star on goes."""
    return F.regexp_replace(call, r"\*.*", "")


def name_parts(name: Column) -> tuple[Column, Column]:
    """File and number of a composite name <file>__<number>; the file ends at the first __, the number follows the last."""
    return F.regexp_replace(name, r"__.*$", ""), F.regexp_replace(name, r"^.*__", "").cast("long")


def composite_name(*parts: Column) -> Column:
    return F.concat_ws("__", *parts)


def without_data_suffix(filename: Column) -> Column:
    return F.regexp_replace(filename, r"\.csv\.gz$", "")


def patient_key(author: Column, subject: Column) -> Column:
    """author_subject; a null part reads NA."""
    return F.concat_ws("_", F.coalesce(author, F.lit("NA")), F.coalesce(subject, F.lit("NA")))


def partition_name(disease_no: Column, disease: Column) -> Column:
    return F.concat_ws("_", disease_no, F.regexp_replace(disease, "[^A-Za-z0-9]", "_"))


def list_text(values: Column) -> Column:
    return F.concat_ws(", ", values)


def uniqueness(n_antibody: Column) -> Column:
    return F.when(n_antibody == 1, "Unique").otherwise("non-Unique")


def peptide_header(number: Column, disease: Column, bsource: Column, btype: Column, isotype: Column, n_antibody: Column) -> Column:
    return F.concat_ws(
        "|", F.lit("OAS"), F.concat(F.lit("pep_"), number.cast("string")), disease, bsource, btype, isotype,
        F.concat(F.lit("Nab_"), n_antibody.cast("string")))


def indexed_header(number: Column) -> Column:
    return F.concat(F.lit("sp|OAS_antibody_pep_"), number.cast("string"), F.lit("|"))


def with_thousands(n: Column) -> Column:
    return F.format_number(n, 0)
