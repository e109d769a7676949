"""Exclusivity between diseases while files keep coming, with the peptides that each batch revokes.

A peptide's state is mergeable: its first and last disease in order, and its number of antibodies. It is exclusive if
both are one disease and not the control. A later batch can only take that away, or bring a new peptide in, so a batch
touches the keys that it holds and no others. State is kept as runs, each a table bucketed by its key that covers a range
of batches: a batch adds a run, and runs of equal width are merged, so n batches leave about log2(n) runs and a row is
written as often. Look-ups and merges join tables of one bucketing, without a shuffle of the state.

The ledger is the data: a run counts once its folder is committed, a batch once its changes are. Whatever a crash leaves
half done is done again under the same names, and what is committed is not written twice.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.sequence import peptides
from tessera.operators import sets
from tessera.plans import jobs
from tessera.sources.scratch import COMPACT

#: How two values of a key become one; either may be null.
MERGE = {
    "min": F.least,
    "max": F.greatest,
    "sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
}


class KeyedRuns:
    """Rows (keys, values) gathered from numbered batches, of which no batch has a key twice.

    `buckets` is for good: choose it so that a bucket of all keys fits a task, as a table of 10^9 peptides in 2,000 does.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], values: dict[str, str], buckets: int):
        self.spark, self.path, self.keys, self.values, self.buckets = spark, path, keys, values, buckets
        self.name = "runs_" + hashlib.sha256(path.encode()).hexdigest()[:16]

    def _folder(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def exists(self, path: str) -> bool:
        fs, at = self._folder(path)
        return fs.exists(at)

    def place(self, run: tuple[int, int]) -> str:
        return f"{self.path}/{run[0]}-{run[1]}"

    def committed(self) -> list[tuple[int, int]]:
        """All runs whose write has ended."""
        fs, at = self._folder(self.path)
        names = [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []
        found = [tuple(map(int, n.split("-"))) for n in names if re.fullmatch(r"\d+-\d+", n)]
        return sorted(r for r in found if self.exists(f"{self.place(r)}/_SUCCESS"))

    def runs(self, before: int | None = None) -> list[tuple[int, int]]:
        """The runs that hold all batches, or those before one, each batch once."""
        found = [r for r in self.committed() if before is None or r[1] < before]
        return [r for r in found if not any(s != r and s[0] <= r[0] and r[1] <= s[1] for s in found)]

    def table(self, run: tuple[int, int]) -> DataFrame:
        name = f"{self.name}_{run[0]}_{run[1]}"
        if not self.spark.catalog.tableExists(name):
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(self.place(run)).schema.fields)
            by = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.place(run)}'")
        return self.spark.table(name)

    def write(self, rows: DataFrame, run: tuple[int, int], dealt: bool = False) -> None:
        """rows as a run; nothing if it is committed. dealt: partitions are buckets already."""
        if run in self.committed():
            return
        self.drop(run)
        rows = rows if dealt else rows.repartition(self.buckets, *self.keys)
        writer = rows.select(*self.keys, *self.values).write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.format("parquet").options(**COMPACT).option("path", self.place(run)).saveAsTable(f"{self.name}_{run[0]}_{run[1]}")

    def drop(self, run: tuple[int, int]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{run[0]}_{run[1]}")
        fs, at = self._folder(self.place(run))
        fs.delete(at, True)

    def _merged(self, a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        b = b.withColumnsRenamed({v: f"__{v}" for v in self.values})
        values = (MERGE[rule](F.col(v), F.col(f"__{v}")).alias(v) for v, rule in self.values.items())
        return a.join(b.hint("merge"), self.keys, how).select(*self.keys, *values)

    def lookup(self, keys: DataFrame, runs: list[tuple[int, int]]) -> DataFrame:
        """What the runs hold of these keys, which are dealt like a run; nulls for new ones."""
        start = keys.select(*self.keys, *(F.lit(None).cast("long" if rule == "sum" else "string").alias(v) for v, rule in self.values.items()))
        return reduce(lambda out, r: self._merged(out, self.table(r), "left"), runs, start)

    def lacking(self, rows: DataFrame, runs: list[tuple[int, int]]) -> DataFrame:
        """Rows whose key is in none of the runs."""
        return reduce(lambda out, r: out.join(self.table(r).select(*self.keys).hint("merge"), self.keys, "left_anti"), runs, rows)

    def current(self) -> DataFrame | None:
        """All keys with their merged values; read it before the next batch, which may replace its runs."""
        tables = [self.table(r) for r in self.runs()]
        return reduce(lambda a, b: self._merged(a, b, "full_outer"), tables) if tables else None

    def compact(self) -> None:
        """Merge the last runs while the last is as wide as the one before it, and delete what wider runs cover."""
        while len(found := self.runs()) > 1 and found[-1][1] - found[-1][0] >= found[-2][1] - found[-2][0]:
            a, b = found[-2:]
            self.write(self._merged(self.table(a), self.table(b), "full_outer"), (a[0], b[1]), dealt=True)
        kept = self.runs()
        for r in self.committed():
            if r not in kept:
                self.drop(r)


class ExclusivePeptides:
    """Peptides that one disease alone has, and not the control, over all batches so far.

    Rows with a null disease are of no disease; null and empty sequences have no peptides. An antibody that an earlier batch
    of its disease had is not counted again.
    """

    def __init__(self, spark: SparkSession, path: str, control: str = "None", buckets: int = 32):
        self.spark, self.path, self.control = spark, path, control
        self.antibodies = KeyedRuns(spark, f"{path}/antibodies", ["disease", "antibody_id"], {}, buckets)
        self.peptides = KeyedRuns(spark, f"{path}/peptides", ["sequence"], {"first": "min", "last": "max", "n_antibody": "sum"}, buckets)

    def _exclusive(self, first: Column, last: Column) -> Column:
        return F.coalesce((first == last) & (first != self.control), F.lit(False))

    def absorb(self, number: int, antibodies: DataFrame, standard: DataFrame, rule: str = "trypsin") -> None:
        """Batch `number`, from 0 on: antibodies (disease, sequence_alignment_aa) and the proteome's peptides.

        Its changes are written to changes/batch=<number>: disease, sequence, change (gained or revoked).
        """
        changes, run = f"{self.path}/changes/batch={number}", (number, number)
        if not self.peptides.exists(f"{changes}/_SUCCESS"):
            rows = jobs.with_antibody_id(antibodies.filter(F.col("disease").isNotNull()))
            self.antibodies.write(rows.select("disease", "antibody_id").distinct(), run)
            # sequences and peptides are dealt as their runs are, once each
            dealt = rows.repartition(self.antibodies.buckets, "disease", "antibody_id").dropDuplicates(["disease", "antibody_id"])
            new = self.antibodies.lacking(dealt, self.antibodies.runs(number))
            found = sets.subtract(peptides(new, "sequence_alignment_aa", ["disease"], rule, 1, 3), standard)
            found = found.repartition(self.peptides.buckets, "sequence").groupBy("sequence")
            self.peptides.write(found.agg(F.min("disease").alias("first"), F.max("disease").alias("last"), F.count("*").alias("n_antibody")), run, dealt=True)
            delta = self.peptides.table(run)
            was = self.peptides.lookup(delta, self.peptides.runs(number)).withColumnsRenamed({"first": "was_first", "last": "was_last"})
            met = was.drop("n_antibody").join(delta.hint("merge"), "sequence")
            before = self._exclusive(F.col("was_first"), F.col("was_last"))
            after = self._exclusive(F.least("first", "was_first"), F.greatest("last", "was_last"))
            change = F.when(after & ~before, "gained").when(before & ~after, "revoked")
            met = met.select(F.coalesce("was_first", "first").alias("disease"), "sequence", change.alias("change")).filter("change IS NOT NULL")
            met.write.mode("overwrite").options(**COMPACT).parquet(changes)
        for runs in (self.antibodies, self.peptides):
            runs.compact()

    def served(self) -> DataFrame:
        """disease, sequence, n_antibody of the exclusive peptides now."""
        rows = self.peptides.current()
        if rows is None:
            return self.spark.createDataFrame([], "disease string, sequence string, n_antibody long")
        return rows.filter(self._exclusive(F.col("first"), F.col("last"))).select(F.col("first").alias("disease"), "sequence", "n_antibody")

    def changes(self, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/changes/batch={number}")


def follow(
    spark: SparkSession, source: str, schema: str, standard: DataFrame, state: ExclusivePeptides, checkpoint: str, rule: str = "trypsin", files_per_batch: int = 1000,
) -> None:
    """Parquet antibodies from a folder into the state, all there is now; each file once, over restarts."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(lambda batch, number: state.absorb(number, batch, standard, rule))
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
