"""Work by units whose ledger is the committed data, so that a crash between data and ledger cannot be.

An attempt writes the rows of its units and a marker for each unit that is done in one folder, which counts once Spark
has committed it. What is done is read off the markers; folders of attempts that broke off are no one's and are deleted
by the next. Readers see rows of committed attempts alone, and of a unit the rows of the one attempt that marked it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import sets

MARK = "__done"


class Ledger:
    """`path` is a folder of this ledger alone; schema is that of the rows, among them the key of a unit."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "filename"):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key

    def _attempts(self, committed: bool) -> list[str]:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [x.getPath() for x in fs.listStatus(at) if x.isDirectory()] if fs.exists(at) else []
        done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return [p.toString() for p in found if fs.exists(done(p, "_SUCCESS")) == committed]

    def _all(self) -> DataFrame:
        paths = self._attempts(True)
        schema = f"{self.schema}, `{MARK}` boolean"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def done(self) -> DataFrame:
        """The key of each unit that is done."""
        return self._all().filter(F.col(MARK)).select(self.key).distinct()

    def rows(self) -> DataFrame:
        """The rows of all units that are done."""
        return self._all().filter(~F.col(MARK)).drop(MARK)

    def left(self, listing: DataFrame) -> DataFrame:
        return listing.join(self.done(), self.key, "left_anti")

    def clear(self) -> None:
        """Delete what attempts left that broke off."""
        for p in self._attempts(False):
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def attempt(self, units: DataFrame, work: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> None:
        """work gives the rows of the units and the keys of those that got done; rows of others are left out."""
        rows, finished = work(units)
        finished = finished.select(self.key).distinct()
        marks = finished.withColumn(MARK, F.lit(True))
        # few units are broadcast; dealt by unit, all rows of one would be a task's
        kept = rows.join(sets.small(finished), self.key, "left_semi").withColumn(MARK, F.lit(False))
        kept.unionByName(marks, allowMissingColumns=True).write.parquet(f"{self.path}/{uuid.uuid4().hex}")

    def run(self, listing: DataFrame, work: Callable[[DataFrame], tuple[DataFrame, DataFrame]], passes: int = 2) -> DataFrame:
        """Attempts on what is left, so many times at most; gives what is left then."""
        self.clear()
        for _ in range(passes):
            units = self.left(listing)
            if units.isEmpty():
                break
            self.attempt(units, work)
        return self.left(listing)
