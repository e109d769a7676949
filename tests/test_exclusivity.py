from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.plans import jobs
from tessera.streaming import exclusivity
from tessera.streaming.exclusivity import ExclusivePeptides, KeyedRuns, follow


def _batches(n: int, rows: int) -> list[list[tuple]]:
    rng = random.Random(n)
    peptide = ["".join(rng.choice("ACDEFGHILMNPQSTVWY") for _ in range(rng.randint(3, 6))) + rng.choice("KR") for _ in range(60)]
    made = [[(rng.choice(["Flu", "HIV", "None", "Zika", None]), "".join(rng.choice(peptide) for _ in range(rng.randint(1, 3)))) for _ in range(rows)] for _ in range(n)]
    for a, b in zip(made, made[1:]):
        b += rng.sample(a, 3)  # antibodies that came before
    return made


def _job(spark, rows, standard):
    """The batch job over all that has come."""
    ab = spark.createDataFrame(rows, "disease string, sequence_alignment_aa string")
    return {tuple(r) for r in jobs.specific_statistics(jobs.digest_by_antibody(ab, standard, "simple")).select("disease", "sequence", "n_antibody").collect()}


@pytest.fixture(scope="module")
def standard(spark):
    return spark.createDataFrame([("AAAAK",), (None,)], "sequence string")


def test_each_batch_equals_the_batch_job(spark, standard, tmp_path):
    """Seven batches: runs are merged at 2, 4 and 6; a second object over the same folder goes on where the first was."""
    path, so_far, before, revoked = str(tmp_path / "state"), [], set(), 0
    for k, rows in enumerate(_batches(7, 12)):
        state = ExclusivePeptides(spark, path, buckets=3)
        so_far += rows
        state.absorb(k, spark.createDataFrame(rows, "disease string, sequence_alignment_aa string"), standard, "simple")
        want = _job(spark, so_far, standard)
        assert {tuple(r) for r in state.served().collect()} == want
        now = {r[:2] for r in want}
        changes = {tuple(r) for r in state.changes(k).collect()}
        assert changes == {(*r, "gained") for r in now - before} | {(*r, "revoked") for r in before - now}
        revoked += len(before - now)
        before = now
    assert revoked > 5 and state.peptides.runs() == [(0, 3), (4, 5), (6, 6)] == state.peptides.committed()


@pytest.mark.parametrize("fails", ["antibodies", "peptides", "changes", "compact"])
def test_a_crash_between_writes_repeats_nothing(spark, standard, tmp_path, monkeypatch, fails):
    batches, path = _batches(3, 10), str(tmp_path / "state")
    frames = [spark.createDataFrame(b, "disease string, sequence_alignment_aa string") for b in batches]

    class Crash(Exception):
        pass

    for k, df in enumerate(frames):
        state = ExclusivePeptides(spark, path, buckets=2)
        write = KeyedRuns.write

        def failing(self, rows, run, dealt=False):
            if fails == "compact" and dealt:
                raise Crash
            write(self, rows, run, dealt)
            if self.path.endswith(fails):
                raise Crash

        with monkeypatch.context() as m:
            m.setattr(KeyedRuns, "write", failing)
            if fails == "changes":
                m.setattr(KeyedRuns, "lookup", lambda *a: (_ for _ in ()).throw(Crash()))
            if fails != "compact" or k == 1:
                with pytest.raises(Crash):
                    state.absorb(k, df, standard, "simple")
        for _ in range(2):  # again, and once more after it is done
            ExclusivePeptides(spark, path, buckets=2).absorb(k, df, standard, "simple")
    assert {tuple(r) for r in ExclusivePeptides(spark, path, buckets=2).served().collect()} == _job(spark, sum(batches, []), standard)


def test_state_is_joined_without_a_shuffle(spark, standard, tmp_path):
    state = ExclusivePeptides(spark, str(tmp_path / "state"), buckets=4)
    for k, rows in enumerate(_batches(3, 40)):
        state.absorb(k, spark.createDataFrame(rows, "disease string, sequence_alignment_aa string"), standard, "simple")
    runs = state.peptides
    assert runs.runs() == [(0, 1), (2, 2)]
    for df in (runs.lookup(runs.table((2, 2)), [(0, 1)]), runs.current()):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_stream_takes_each_file_once(spark, standard, tmp_path):
    batches, state = _batches(3, 12), ExclusivePeptides(spark, str(tmp_path / "state"), buckets=2)
    schema = "disease string, sequence_alignment_aa string"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):
            follow(spark, str(tmp_path / "in"), schema, standard, state, str(tmp_path / "checkpoint"), "simple")
    assert {tuple(r) for r in state.served().collect()} == _job(spark, sum(batches, []), standard)


def test_empty_state(spark, tmp_path, standard):
    state = ExclusivePeptides(spark, str(tmp_path / "state"))
    assert state.served().count() == 0
    state.absorb(0, spark.createDataFrame([(None, "AAAK"), ("Flu", ""), ("Flu", None)], "disease string, sequence_alignment_aa string"), standard, "simple")
    assert state.served().count() == 0 and state.changes(0).filter(F.col("change").isNotNull()).count() == 0


def test_a_batch_deals_sequences_and_peptides_once(spark, tmp_path, monkeypatch):
    """Peptides of a run have the exchange to their buckets alone, not a second one to be summed."""
    plans, write = [], exclusivity.KeyedRuns.write
    monkeypatch.setattr(exclusivity.KeyedRuns, "write", lambda self, rows, run, dealt=False: (plans.append((self.keys, dealt, rows._jdf.queryExecution().executedPlan().toString())), write(self, rows, run, dealt)))
    state = exclusivity.ExclusivePeptides(spark, str(tmp_path / "dealt"), buckets=2)
    standard = spark.createDataFrame([("STDK",)], "sequence string")
    state.absorb(0, spark.createDataFrame([("Flu", "AAAAKCCCCK"), ("Flu", "AAAAKCCCCK"), ("HIV", "CCCCKDDDDK")], "disease string, sequence_alignment_aa string"), standard, "simple")
    (plan,) = [p for keys, dealt, p in plans if keys == ["sequence"] and dealt]
    assert plan.count("Exchange hashpartitioning(sequence") == 2  # the other is of the proteome
    assert {(r["disease"], r["sequence"], r["n_antibody"]) for r in state.served().collect()} == {("Flu", "AAAAK", 1), ("Flu", "AAAAKCCCCK", 1), ("HIV", "DDDDK", 1), ("HIV", "CCCCKDDDDK", 1)}
