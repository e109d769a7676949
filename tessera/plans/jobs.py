"""Jobs a user calls: from antibodies, metadata and proteomes to served tables and exports.

antibodies: sequence_alignment_aa, v_call, j_call, cdr3_aa, filename, disease; metadata: filename, disease, bsource,
btype, isotype, patient, unique_sequences; proteins: name, sequence.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import sequence as S
from tessera.operators import facets, ranking, sets
from tessera.operators.facets import ISOTYPES
from tessera.sources import sinks
from tessera.sources.scratch import materialized


def standard_peptides(proteins: DataFrame, rule: str = "trypsin", longer_than: int = 1) -> DataFrame:
    """Different peptides of proteins."""
    return S.peptides(proteins, "sequence", [], rule, 1, longer_than).distinct()


def antibody_ids(antibodies: DataFrame) -> DataFrame:
    """Different (disease, sequence) with antibody_id, which depends on the sequence alone."""
    return with_antibody_id(antibodies.select("disease", "sequence_alignment_aa").distinct())


def with_antibody_id(antibodies: DataFrame) -> DataFrame:
    """disease, sequence_alignment_aa, antibody_id of rows that have a sequence."""
    rows = antibodies.select("disease", "sequence_alignment_aa").filter("sequence_alignment_aa <> ''")
    return rows.withColumn("antibody_id", F.concat(F.lit("ab_"), F.sha2("sequence_alignment_aa", 256)))


def digest(antibodies: DataFrame, standard: DataFrame, rule: str = "trypsin") -> DataFrame:
    """disease, antibody_id, sequence, filenames: peptides over 3 long that no standard protein has, of each different antibody.

    Each antibody is digested once; rows by antibody and rows by file are both read off the result.
    """
    rows = antibodies.filter("sequence_alignment_aa <> ''").groupBy("disease", "sequence_alignment_aa").agg(F.collect_set("filename").alias("filenames"))
    rows = rows.withColumn("antibody_id", F.concat(F.lit("ab_"), F.sha2("sequence_alignment_aa", 256)))
    return sets.subtract_reference(S.peptides(rows, "sequence_alignment_aa", ["disease", "antibody_id", "filenames"], rule, 1, 3), standard)


def digest_by_antibody(antibodies: DataFrame, standard: DataFrame, rule: str = "trypsin") -> DataFrame:
    """disease, antibody_id, sequence: peptides over 3 long that no standard protein has."""
    pairs = S.peptides(antibody_ids(antibodies), "sequence_alignment_aa", ["disease", "antibody_id"], rule, 1, 3)
    return sets.subtract_reference(pairs, standard)


def by_file(digested: DataFrame) -> DataFrame:
    """disease, filename, sequence of a digest."""
    return digested.select("disease", "sequence", F.explode("filenames").alias("filename")).distinct()


def digest_by_file(antibodies: DataFrame, standard: DataFrame, rule: str = "trypsin") -> DataFrame:
    """disease, filename, sequence: as above, by file."""
    rows = antibodies.select("disease", "filename", "sequence_alignment_aa").distinct()
    return sets.subtract_reference(S.peptides(rows, "sequence_alignment_aa", ["disease", "filename"], rule, 1, 3).distinct(), standard)


def control_peptides(by_file: DataFrame, control: str = "None") -> DataFrame:
    return by_file.filter(F.col("disease") == control).select("sequence").distinct()


def disease_specific(pairs: DataFrame, control: DataFrame, none: str = "None") -> DataFrame:
    """Rows of diseases whose peptide no other disease and no control has. Other diseases are taken unfiltered."""
    return sets.subtract(sets.exclusive(pairs.filter(F.col("disease") != none), "disease"), control)


def specific_rows(rows: DataFrame, control: str = "None") -> DataFrame:
    """Rows whose peptide one disease alone has, and not the control: what disease_specific keeps, with one exchange.

    Rows go by sequence once, and the first and last disease of a peptide are told beside them. A window keeps a few
    thousand rows of a peptide in memory, others on disk.
    """
    w = Window.partitionBy("sequence")
    known = rows.filter(F.col("disease").isNotNull() & F.col("sequence").isNotNull())
    known = known.withColumns({"__first": F.min("disease").over(w), "__last": F.max("disease").over(w)})
    return known.filter((F.col("__first") == F.col("__last")) & (F.col("__first") != control)).drop("__first", "__last")


def specific_pairs(pairs: DataFrame, control: str = "None") -> DataFrame:
    """specific_rows of (disease, antibody_id, sequence); an id goes through the exchange as the 32 bytes of its hash."""
    packed = pairs.select("disease", F.unhex(F.substring("antibody_id", 4, 64)).alias("__id"), "sequence")
    return specific_rows(packed, control).select("disease", F.concat(F.lit("ab_"), F.lower(F.hex("__id"))).alias("antibody_id"), "sequence")


def specific_counts(pairs: DataFrame, control: str = "None") -> DataFrame:
    """stage, n_rows, n_sequences of the pairs of diseases, of those that one disease alone has, and of the specific ones.

    A peptide is one row, of one aggregate that sums before its exchange, and all stages are read off that.
    """
    ill = F.col("disease") != control
    known = pairs.filter(F.col("disease").isNotNull()).groupBy("sequence").agg(
        F.count_if(ill).alias("n"), F.min(F.when(ill, F.col("disease"))).alias("a"), F.max(F.when(ill, F.col("disease"))).alias("b"), F.bool_or(~ill).alias("held"))
    stages = {"digested": F.lit(True), "exclusive": F.col("a") == F.col("b"), "specific": (F.col("a") == F.col("b")) & ~F.col("held")}
    known = known.filter("n > 0 AND sequence IS NOT NULL").agg(
        *(F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(f"{s}_n") for s, c in stages.items()), *(F.count_if(c).alias(s) for s, c in stages.items()))
    rows = F.explode(F.array(*(F.struct(F.lit(s).alias("stage"), F.col(f"{s}_n").alias("n_rows"), F.col(s).alias("n_sequences")) for s in stages)))
    return known.select(rows.alias("r")).select("r.*")


def specific_files(digested: DataFrame, metadata: DataFrame, control: str = "None") -> DataFrame:
    """disease, sequence, filename, n_antibody, n_patient: a row for each specific peptide of a digest and file.

    Rows go by sequence once, and are sorted once, by patient and file in a peptide: where either changes it counts. Hot
    peptides are as many rows there as antibodies have them, of which a window keeps a few thousand in memory.
    """
    rows = digested.filter(F.col("disease").isNotNull()).select("disease", "sequence", F.posexplode("filenames").alias("pos", "filename"))
    rows = rows.select("disease", "sequence", "filename", (F.col("pos") == 0).cast("int").alias("__one")).repartition("sequence")
    # a null patient is one patient; names of files and these keys are never null, so the row before the first differs
    key = F.coalesce(F.concat(F.lit("="), "patient"), F.lit("")).alias("__key")
    rows = rows.join(sets.small(metadata.select("filename", key)), "filename", "left").withColumn("__key", F.coalesce("__key", F.lit("")))
    w = Window.partitionBy("sequence")
    by_place = w.orderBy("__key", "filename")
    new = lambda c: ~F.col(c).eqNullSafe(F.lag(c).over(by_place))
    rows = rows.withColumns({"__file": new("filename"), "__patient": new("__key").cast("int")})
    rows = rows.withColumns({"__first": F.min("disease").over(w), "__last": F.max("disease").over(w),
                             "n_antibody": F.sum("__one").over(w), "n_patient": F.sum("__patient").over(w)})
    rows = rows.filter((F.col("__first") == F.col("__last")) & (F.col("__first") != control) & F.col("__file"))
    return rows.select("disease", "sequence", "filename", "n_antibody", "n_patient")


def specific_table(digested: DataFrame, cdr3: DataFrame, metadata: DataFrame, catalog: DataFrame) -> DataFrame:
    """The served peptide table as peptide_table gives it, off a digest with one exchange of its rows."""
    rows = specific_files(digested, metadata)
    marks = cdr3.groupBy("sequence").agg(F.collect_set("disease").alias("__diseases"))  # as many as diseases, at most
    rows = rows.join(marks, "sequence", "left").withColumn("cdr3", F.coalesce(F.array_contains("__diseases", F.col("disease")), F.lit(False)).cast("int"))
    rows = rows.join(sets.small(metadata.select("filename", "patient", "bsource", "btype", "isotype")), "filename", "left")
    rows = rows.join(sets.small(catalog.select("disease", "disease_no")), "disease")
    return rows.select("disease_no", "sequence", "filename", "patient", "bsource", "btype", "isotype", "n_patient", "n_antibody", F.length("sequence").alias("length_aa"), "cdr3")


def cdr3_peptides(antibodies: DataFrame, rule: str = "trypsin") -> DataFrame:
    """disease, sequence: peptides of different CDR3 regions, of any length."""
    rows = antibodies.select("disease", "cdr3_aa").filter("cdr3_aa <> ''").distinct()
    return S.peptides(rows, "cdr3_aa", ["disease"], rule).distinct()


def specific_statistics(pairs: DataFrame, control: str = "None") -> DataFrame:
    """disease, sequence, n_antibody, length_aa of peptides that one disease alone has, and not the control: one aggregate.

    Counts are summed before the shuffle, so a hot peptide is a row a task.
    """
    known = pairs.filter(F.col("disease").isNotNull())
    found = known.groupBy("sequence").agg(F.min("disease").alias("disease"), F.max("disease").alias("last"), F.count("*").alias("n_antibody"))
    found = found.filter((F.col("disease") == F.col("last")) & (F.col("disease") != control))
    return found.select("disease", "sequence", "n_antibody", F.length("sequence").alias("length_aa"))


def peptide_files(digested: DataFrame) -> DataFrame:
    """disease, sequence, filename, n_antibody: a row for each peptide and file of a digest.

    An antibody of several files counts in the first of its row, so the numbers of a peptide's files sum up to its
    antibodies. A hot peptide is as many rows as files have it, so these rows can be bucketed by sequence.
    """
    rows = digested.select("disease", "sequence", F.posexplode("filenames").alias("pos", "filename"))
    return rows.groupBy("disease", "sequence", "filename").agg(F.count_if(F.col("pos") == 0).alias("n_antibody"))


def file_statistics(files: DataFrame, control: str = "None") -> DataFrame:
    """specific_statistics of what peptide_files gave; needs no exchange where the rows are bucketed by sequence."""
    known = files.filter(F.col("disease").isNotNull())
    found = known.groupBy("sequence").agg(F.min("disease").alias("disease"), F.max("disease").alias("last"), F.sum("n_antibody").alias("n_antibody"))
    found = found.filter((F.col("disease") == F.col("last")) & (F.col("disease") != control))
    return found.select("disease", "sequence", "n_antibody", F.length("sequence").alias("length_aa"))


def surviving_rows(stats: DataFrame, files: DataFrame, metadata: DataFrame, catalog: DataFrame, *columns: str) -> DataFrame:
    """A row for each surviving peptide and file: disease, disease_no, sequence, filename, columns of the metadata, and those of stats.

    The statistics are of surviving peptides, so their join keeps what a semi join would. These have one disease each, so
    the sequence alone is the key, and rows bucketed by it need no exchange.
    """
    rows = files.filter(F.col("disease").isNotNull()).select("disease", "sequence", "filename").join(stats.drop("disease"), "sequence")
    rows = rows.join(sets.small(metadata.select("filename", *columns)), "filename", "left")
    return rows.join(sets.small(catalog.select("disease", "disease_no")), "disease")


def peptide_table(stats: DataFrame, files: DataFrame, cdr3: DataFrame, metadata: DataFrame, catalog: DataFrame) -> DataFrame:
    """Served peptide table, a row for each peptide and file, from statistics of the surviving peptides and rows by file.

    Patients are counted and CDR3 peptides marked where a peptide is one row, before the join with its files. Where files
    are bucketed by sequence, the CDR3 peptides alone have exchanges.
    """
    known = files.filter(F.col("disease").isNotNull())
    patients = known.select("sequence", "filename").join(sets.small(metadata.select("filename", "patient")), "filename", "left")
    marks = cdr3.groupBy("sequence").agg(F.collect_set("disease").alias("__diseases"))  # as many as diseases, at most
    stats = stats.join(marks, "sequence", "left").withColumn("cdr3", F.coalesce(F.array_contains("__diseases", F.col("disease")), F.lit(False)).cast("int"))
    stats = stats.drop("__diseases").join(sets.distinct_counts(patients, "sequence", "patient", "n_patient"), "sequence")
    rows = surviving_rows(stats, files, metadata, catalog, "patient", "bsource", "btype", "isotype")
    return rows.select("disease_no", "sequence", "filename", "patient", "bsource", "btype", "isotype", "n_patient", F.col("n_antibody"), "length_aa", "cdr3")


def antibody_table(antibodies: DataFrame, catalog: DataFrame) -> DataFrame:
    """Served antibody table: different rows."""
    rows = antibodies.select("disease", "sequence_alignment_aa", "v_call", "j_call", "cdr3_aa", "filename").distinct()
    return rows.join(sets.small(catalog.select("disease", "disease_no")), "disease").drop("disease")


def disease_summary(peptides: DataFrame, antibodies: DataFrame, catalog: DataFrame, metadata: DataFrame) -> DataFrame:
    """A row of counts for each disease with a peptide table, numbered No, with the name of its partition, File_db.

    Patients are those of the metadata, a null one counted once. Peptides are brought to a row each, with a bit for each
    isotype and for either uniqueness, and counted by bits: no aggregate is over distinct values.
    """
    n = F.col("n_antibody")
    p = facets.peptide_flags(
        peptides, n_antibody=F.max(n), n_patient=F.max("n_patient"), one=F.bool_or(n == 1), more=F.bool_or(n > 1)).filter("sequence IS NOT NULL")
    p = p.groupBy("disease_no").agg(
        F.count("*").alias("n_peptide"), F.max("n_antibody").alias("max_antibody"), F.max("n_patient").alias("max_patient"),
        F.count_if("one").alias("n_peptide_unique"), F.count_if("more").alias("n_peptide_non_unique"),
        *(F.count_if(facets.has_isotype(i)).alias(f"n_peptide_{i.lower()}") for i in ISOTYPES))
    a = antibodies.groupBy("disease_no").agg(F.count_distinct(F.unhex(F.sha2("sequence_alignment_aa", 256))).alias("n_antibody"))
    m = sets.distinct_counts(metadata, "disease", "patient", "n_patient")
    found = catalog.select("disease", "disease_no").join(m, "disease", "left").join(p, "disease_no").join(a, "disease_no", "left")
    number = F.regexp_extract("disease_no", r"(\d+)$", 1).cast("long")
    return found.select(number.alias("no"), S.partition_name(F.col("disease_no"), F.col("disease")).alias("file_db"), "*")


def largest_measures(summary: DataFrame, disease_no: str, default: int = 10) -> DataFrame:
    """Upper ends of a disease's sliders; the default where it has none."""
    got = summary.filter(F.col("disease_no") == disease_no)
    return got.agg(*(F.coalesce(F.max(c), F.lit(default)).alias(c) for c in ("max_antibody", "max_patient")))


def archived_build(digest: DataFrame, standard: DataFrame, units: DataFrame, antibodies: DataFrame, more_than: int = 100) -> DataFrame:
    """Digest text (Protein_Name, Sequence) -> sequence, data_id, antibody_id, bioproject, patient_id, v_call.

    Peptides of standard proteins go, names are split, patients with few rows go, and genes are attached.
    """
    data, number = S.name_parts(F.col("Protein_Name"))
    rows = sets.subtract(digest.withColumnRenamed("Sequence", "sequence"), standard).select("sequence", data.alias("data_id"), number.alias("antibody_id"))
    rows = rows.join(sets.small(units.select("data_id", "bioproject", "patient_id")), "data_id", "left")
    rows = sets.minimum_support(materialized(rows, "archived"), "patient_id", more_than)
    genes = antibodies.select("antibody_id", S.gene_of_allele(F.col("v_call")).alias("v_call"))
    return rows.join(genes, "antibody_id").select("sequence", "data_id", "antibody_id", "bioproject", "patient_id", "v_call")


def top_peptide_database(pairs: DataFrame, n: int) -> DataFrame:
    """header, sequence of the n most frequent peptides, I read as L, numbered by falling frequency. Only those n are sorted."""
    frequency = ranking.stored_frequency(pairs)
    chosen = frequency.filter(ranking.TopSelection(frequency, [n]).least().isNotNull())
    top = ranking.row_numbers(chosen, [F.desc("n_abs"), F.col("sequence")], "rank")
    return top.select(S.indexed_header(F.col("rank")).alias("header"), S.leucine_for_isoleucine(F.col("sequence")).alias("sequence"))


def unprocessed(listing: DataFrame, ledger: DataFrame, key: str = "filename") -> DataFrame:
    """Listed units that the ledger lacks: what a retry runs."""
    return listing.join(ledger.select(key), key, "left_anti")


def process_with_retry(listing: DataFrame, ledger: Callable[[], DataFrame], process: Callable[[DataFrame], None], passes: int = 2, key: str = "filename") -> DataFrame:
    """Runs `process` on the units that the ledger lacks, and again on those it still lacks; gives what is left then.

    process adds the units it got done to the ledger, which is read anew for each pass.
    """
    for _ in range(passes):
        left = unprocessed(listing, ledger(), key)
        if left.isEmpty():
            break
        process(left)
    return unprocessed(listing, ledger(), key)


def proteome(uniprot: DataFrame, refseq: DataFrame) -> DataFrame:
    """accession, name, sequence of two FASTA sources, whose headers name a protein by different rules."""
    a = uniprot.select(S.accession_between_pipes(F.col("name")).alias("accession"), "name", "sequence")
    return a.unionByName(refseq.select(S.accession_first_word(F.col("name")).alias("accession"), "name", "sequence"))


def facet_job(served: DataFrame, catalog: DataFrame, disease: str, out: str, background: DataFrame, day: date | None = None, **asked) -> dict[str, DataFrame | str]:
    """What a user asks of one disease: rows, summary card, both trees, and three exports below `out`.

    served is partitioned by disease_no, of which one partition is read; background holds FASTA records (value, part).
    Exports are folders: csv of the rows, fasta of their peptides, and plus, the same with the background after it.
    """
    chosen = sets.exactly_one(catalog.filter(F.col("disease") == disease), disease).first()
    rows = materialized(facets.facet_query(sets.one_disease(served, chosen["disease_no"]), **asked), "facet_rows")
    numbered = ranking.row_numbers(rows, [F.col(c) for c in facets.FACET_COLUMNS], "number")
    header = S.peptide_header(F.col("number"), F.lit(disease), F.col("bsource"), F.col("btype"), F.col("isotype"), F.col("n_antibody"))
    records = sinks.fasta_lines(numbered.select(header.alias("header"), "sequence"), "header", "sequence")
    path = {kind: f"{out}/{sinks.export_name(disease, kind, day)}" for kind in ("csv", "fasta", "plus")}
    sinks.write_csv(rows, path["csv"])
    sinks.write_fasta(records, path["fasta"])
    sinks.write_fasta(sinks.concatenated(records, background), path["plus"])
    return {"rows": rows, "card": facets.summary_card(rows), "sources": facets.hierarchy_counts(rows, "bsource", "btype", disease),
            "isotypes": facets.isotype_uniqueness(rows, disease)} | path
