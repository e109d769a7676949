"""Data units as a data source: metadata line, header and rows of each file in one pass.

A unit is text, gzip or not: a JSON line in quotes, a CSV header and rows. `spark.read.format("repertoire_units")` gives the
wanted columns as text, the file's name and path, the wanted metadata, and in a last row of each file its outcome. Files
are streamed, so a file may be larger than a worker's memory, and a file that breaks off gives an error row and no exception.
Small files share a task. Paths are opened by Arrow's file systems: local and shared folders, s3://, gs:// and hdfs://.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pc
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.sources.files import UNIT_COLUMNS
from tessera.sources.scratch import materialized

#: Bytes of files that share a task, and of text that is parsed at a time.
TASK_BYTES, BLOCK_BYTES = 128 << 20, 4 << 20
BROKEN = (OSError, EOFError, zlib.error, ValueError, pa.ArrowException)


def metadata_of(line: str) -> dict[str, str | None]:
    """The JSON of a metadata line, as text: outer quotes off, doubled quotes single, NaN as null, lists joined."""
    bare = re.sub(r'^"|"$', "", line.strip()).replace('""', '"')
    found = json.loads(re.sub(r":\s*NaN\b", ": null", bare))
    if not isinstance(found, dict):
        raise ValueError("no metadata")
    text = lambda v: v if isinstance(v, str) else json.dumps(v)
    return {k: None if v is None else ", ".join(map(text, v)) if isinstance(v, list) else text(v) for k, v in found.items()}


@dataclass
class UnitFiles(InputPartition):
    paths: list[str]


class UnitReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.suffix = options["path"], options.get("suffix", ".gz")
        self.columns, self.keys = (json.loads(options[k]) for k in ("columns", "keys"))
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))

    def schema(self) -> pa.Schema:
        return unit_schema(self.columns)

    def partitions(self) -> list[InputPartition]:
        """Files below the path, from their listing alone, dealt out by size."""
        fs, at = pfs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (pfs.LocalFileSystem(), self.root)
        found = fs.get_file_info(pfs.FileSelector(at, recursive=True))
        files = sorted((f for f in found if f.type == pfs.FileType.File and f.base_name.endswith(self.suffix) and f.base_name[0] not in "._"), key=lambda f: (-f.size, f.path))
        groups: list[tuple[int, list[str]]] = []
        for f in files:
            if groups and groups[-1][0] + f.size <= self.task_bytes:
                groups[-1][1].append(f.path)
                groups[-1] = groups[-1][0] + f.size, groups[-1][1]
            else:
                groups.append((f.size, [f.path]))
        return [UnitFiles(paths) for _, paths in groups] or [UnitFiles([])]

    def read(self, partition: UnitFiles) -> Iterator[pa.RecordBatch]:
        fs = pfs.FileSystem.from_uri(self.root)[0] if "://" in self.root or self.root.startswith("file:") else pfs.LocalFileSystem()
        for path in partition.paths:
            yield from self.unit(fs, path)

    def unit(self, fs: pfs.FileSystem, path: str) -> Iterator[pa.RecordBatch]:
        """The rows of a file, then its outcome: `read`, or what went wrong."""
        rows, odd, about, outcome = 0, [0], {}, "read"

        def skip(_):
            odd[0] += 1
            return "skip"

        try:
            with fs.open_input_stream(path, compression=None) as raw, io.BufferedReader(_Stream(raw), 1 << 20) as plain:
                text = gzip.GzipFile(fileobj=plain) if plain.peek(2)[:2] == b"\x1f\x8b" else plain
                found = metadata_of(text.readline().decode())
                about = {k: found.get(k) for k in self.keys}
                convert = pc.ConvertOptions(
                    column_types=dict.fromkeys(self.columns, pa.string()), include_columns=self.columns, include_missing_columns=True,
                    strings_can_be_null=True, quoted_strings_can_be_null=True, null_values=[""])
                for b in pc.open_csv(text, pc.ReadOptions(block_size=BLOCK_BYTES), pc.ParseOptions(invalid_row_handler=skip), convert):
                    b = b.filter(pa.compute.is_valid(b[self.columns[0]]))  # an anti join never matches a null
                    rows += len(b)
                    if len(b):
                        yield self._batch(b.columns, path, len(b), about, None, None, None)
        except BROKEN as e:
            outcome = f"{type(e).__name__}: {e}"[:300]
        yield self._batch([pa.nulls(1, pa.string())] * len(self.columns), path, 1, about, outcome, rows, odd[0])

    def _batch(self, columns: list, path: str, n: int, about: dict, outcome: str | None, rows: int | None, odd: int | None) -> pa.RecordBatch:
        schema = self.schema()
        same = [path.rsplit("/", 1)[-1], path, [*about.items()], outcome, rows, odd]
        rest = [pa.array([v] * n, f.type) for v, f in zip(same, list(schema)[len(columns) :])]
        return pa.RecordBatch.from_arrays([*columns, *rest], schema=schema)


class _Stream(io.RawIOBase):
    """An Arrow stream as Python's readers want it."""

    def __init__(self, stream: pa.NativeFile):
        self.stream = stream

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        found = self.stream.read(len(into))
        into[: len(found)] = found
        return len(found)


def unit_schema(columns: list[str]) -> pa.Schema:
    text = [(c, pa.string()) for c in (*columns, "filename", "path")]
    return pa.schema([*text, ("metadata", pa.map_(pa.string(), pa.string())), ("outcome", pa.string()), ("n_rows", pa.int64()), ("n_odd", pa.int64())])


class UnitSource(DataSource):
    """Options: path; columns and keys as JSON lists; suffix of file names; taskBytes."""

    @classmethod
    def name(cls) -> str:
        return "repertoire_units"

    def schema(self) -> str:
        columns = json.loads(self.options["columns"])
        return ", ".join(f"`{c}` string" for c in (*columns, "filename", "path")) + ", metadata map<string, string>, outcome string, n_rows long, n_odd long"

    def reader(self, schema) -> UnitReader:
        return UnitReader({k.lower(): v for k, v in self.options.items()})


def scan_units(spark: SparkSession, path: str, columns: list[str] | None = None, keys: list[str] = (), **options: str) -> DataFrame:
    """Rows of units with their metadata, and a row for each file that tells its outcome (read, or an error), rows and odd lines.

    Rows without a value in the first column are dropped. Lines with too many or too few cells are counted and skipped.
    """
    spark.dataSource.register(UnitSource)
    reader = spark.read.format("repertoire_units").option("columns", json.dumps(list(columns or UNIT_COLUMNS))).option("keys", json.dumps(list(keys)))
    return reader.options(**options).load(path)


def read_units_tolerant(spark: SparkSession, path: str, columns: list[str] | None = None, keys: list[str] = (), **options: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that could be read to their end; and filename, path, outcome, n_rows, n_odd of all files.

    Files are read once and written; of a file that broke off no row is taken.
    """
    found = materialized(scan_units(spark, path, columns, keys, **options), "units")
    report = found.filter("outcome IS NOT NULL").select("filename", "path", "outcome", "n_rows", "n_odd", "metadata")
    broken = report.filter("outcome <> 'read'").select("path")
    rows = found.filter("outcome IS NULL").drop("outcome", "n_rows", "n_odd")
    return rows.join(broken, "path", "left_anti").select(*(c for c in rows.columns)), report


def metadata_columns(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The wanted metadata as columns."""
    return rows.select("*", *(F.col("metadata")[k].alias(k) for k in keys)).drop("metadata")
