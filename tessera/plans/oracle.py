"""SQL for the same results, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from tessera.functions.sequence import RESIDUE_MASS, WATER_MASS

_LETTERS = "".join(RESIDUE_MASS)


def residues(column: str) -> str:
    return f"upper(regexp_replace({column}, '[^{_LETTERS}{_LETTERS.lower()}]', '', 'g'))"


def simple_fragments(s: str) -> str:
    return f"list_filter(string_split(replace(replace(replace({s},'K','K|'),'R','R|'),'|P','P'),'|'), lambda x: x <> '')"


def trypsin_fragments(s: str) -> str:
    """Every K and R is cut, then the exceptions are mended; a mended letter may begin the next, so each is run again."""
    cut = f"replace(replace({s},'K','K|'),'R','R|')"
    for pattern, to in (
        ("(^|[^W])K\\|P", "\\1KP"), ("(^|[^M])R\\|P", "\\1RP"), ("([CD])K\\|D", "\\1KD"), ("CK\\|([HY])", "CK\\1"),
        ("CR\\|K", "CRK"), ("R(\\|?)R\\|([HR])", "R\\1R\\2"),
    ):
        for _ in range(4):
            cut = f"regexp_replace({cut}, '{pattern}', '{to}', 'g')"
    return f"list_filter(string_split({cut}, '|'), lambda x: x <> '')"


PEPTIDES = "list_distinct(list_concat(f, list_transform(range(1, len(f)), lambda i: f[i] || f[i + 1])))"
MASS = f"CAST({WATER_MASS} AS DOUBLE)" + "".join(f" + (length(sequence) - length(replace(sequence, '{r}', ''))) * CAST({m} AS DOUBLE)" for r, m in RESIDUE_MASS.items())



def base(fragments: Callable[[str], str]) -> str:
    """The tables of the build, with the digest of a cut rule."""
    return f"""
ab AS (SELECT doc_id AS antibody_no, seq AS sequence_alignment_aa,
    'IGHV' || (doc_id % 7) || '*0' || (doc_id % 4) AS v_call, 'IGHJ' || (doc_id % 5) AS j_call, substring(seq, 20, 30) AS cdr3_aa,
    concat_ws('_', source, lang, CAST(doc_id % 3 AS VARCHAR)) AS filename,
    CASE WHEN source = 'src0' THEN 'None' ELSE source END AS disease, lang AS bsource, 'T' || (doc_id % 3) AS btype,
    CASE doc_id % 3 WHEN 0 THEN 'Bulk' WHEN 1 THEN 'IGHG' ELSE 'IGHM' END AS isotype, source AS author, CAST(doc_id % 3 AS VARCHAR) AS subject
  FROM (SELECT *, {residues('text')} AS seq FROM documents) WHERE seq <> ''),
meta0 AS (SELECT filename, disease, bsource, btype, isotype, author, subject, count(*) AS unique_sequences,
    coalesce(author, 'NA') || '_' || coalesce(subject, 'NA') AS patient_key FROM ab GROUP BY ALL),
codes AS (SELECT patient_key, 'P' || row_number() OVER (ORDER BY patient_key) AS patient FROM (SELECT DISTINCT patient_key FROM meta0)),
meta AS (SELECT * FROM meta0 JOIN codes USING (patient_key)),
totals AS (SELECT disease, CAST(sum(unique_sequences) AS BIGINT) AS total_unique_sequences FROM meta GROUP BY 1),
cat AS (SELECT disease, total_unique_sequences, CASE WHEN disease = 'None' THEN 'None' ELSE 'D' || row_number() OVER
    (PARTITION BY disease = 'None' ORDER BY total_unique_sequences DESC, disease) END AS disease_no FROM totals),
prot AS (SELECT 'sp|B' || item_id || '|ITEM_' || item_id AS name, {residues('text')} AS sequence FROM benchmark WHERE {residues('text')} <> ''),
std AS (SELECT DISTINCT sequence FROM (SELECT unnest({PEPTIDES}) AS sequence FROM (SELECT {fragments('sequence')} AS f FROM prot)) WHERE length(sequence) > 1),
ids AS (SELECT DISTINCT disease, sequence_alignment_aa, 'ab_' || sha256(sequence_alignment_aa) AS antibody_id FROM ab),
pep_ab AS (SELECT * FROM (SELECT disease, antibody_id, unnest({PEPTIDES}) AS sequence FROM (SELECT disease, antibody_id, {fragments('sequence_alignment_aa')} AS f FROM ids))
    WHERE length(sequence) > 3 AND sequence NOT IN (SELECT sequence FROM std)),
pep_file AS (SELECT DISTINCT * FROM (SELECT disease, filename, unnest({PEPTIDES}) AS sequence FROM
    (SELECT disease, filename, {fragments('sequence_alignment_aa')} AS f FROM (SELECT DISTINCT disease, filename, sequence_alignment_aa FROM ab)))
    WHERE length(sequence) > 3 AND sequence NOT IN (SELECT sequence FROM std)),
control AS (SELECT DISTINCT sequence FROM pep_file WHERE disease = 'None'),
own AS (SELECT sequence FROM pep_ab WHERE disease <> 'None' GROUP BY 1 HAVING count(DISTINCT disease) = 1),
specific AS (SELECT disease, antibody_id, sequence FROM pep_ab WHERE disease <> 'None' AND sequence IN (SELECT sequence FROM own)
    AND sequence NOT IN (SELECT sequence FROM control)),
cdr3 AS (SELECT DISTINCT disease, sequence FROM (SELECT disease, unnest({PEPTIDES}) AS sequence FROM
    (SELECT disease, {fragments('cdr3_aa')} AS f FROM (SELECT DISTINCT disease, cdr3_aa FROM ab WHERE cdr3_aa <> '')))),
stats AS (SELECT disease, sequence, count(*) AS n_antibody, length(sequence) AS length_aa,
    CASE WHEN EXISTS (SELECT 1 FROM cdr3 c WHERE c.disease = s.disease AND c.sequence = s.sequence) THEN 1 ELSE 0 END AS cdr3
    FROM specific s GROUP BY 1, 2),
rows0 AS (SELECT p.disease, p.sequence, p.filename, s.n_antibody, s.length_aa, s.cdr3, m.patient, m.bsource, m.btype, m.isotype
    FROM pep_file p JOIN stats s USING (disease, sequence) LEFT JOIN meta m ON p.filename = m.filename),
pats AS (SELECT disease, sequence, count(DISTINCT patient) + max(CASE WHEN patient IS NULL THEN 1 ELSE 0 END) AS n_patient FROM rows0 GROUP BY 1, 2),
datdb AS (SELECT disease_no, sequence, filename, patient, bsource, btype, isotype, n_patient, n_antibody, length_aa, cdr3
    FROM rows0 JOIN pats USING (disease, sequence) JOIN cat USING (disease)),
abdb AS (SELECT DISTINCT sequence_alignment_aa, v_call, j_call, cdr3_aa, filename, disease_no FROM ab JOIN cat USING (disease)),
isos AS (SELECT disease_no, {", ".join(f"count(DISTINCT CASE WHEN isotype = '{i}' THEN sequence END) AS {chr(34)}{i}{chr(34)}" for i in ('Bulk', 'IGHA', 'IGHD', 'IGHE', 'IGHG', 'IGHM'))}
    FROM datdb GROUP BY 1)
"""


BASE = base(simple_fragments)


def over_base(select: str, fragments: Callable[[str], str] = simple_fragments) -> str:
    return f"WITH {base(fragments)} {select}"
