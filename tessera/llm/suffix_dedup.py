"""Repeated byte strings across documents by a logarithmic family of sparse suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else. Suffixes are sampled: of each LENGTH
window the least hash among its GRAM-byte strings is its anchor (leftmost on ties), so equal windows have equal anchors
at equal places. An anchor's suffix enters the index with its first LEAD bytes, by which arrays are sorted, and the hash
of its first GRAM bytes, which orders suffixes of one lead; the windows it stands for are a run.

Index family: each batch of documents (about BATCH_BYTES, within LEAST_BATCHES and MOST_BATCHES of them) gets its sorted
array, is merge-scanned against every existing level (a merge join in byte order of the leads) and against itself, and is
added; levels of equal size merge into one of the next size, so a corpus of n batches keeps log2(n) levels and each
suffix is rewritten log2(n) times. Levels are bucketed Parquet tables in the shared folder. A scan tells which suffixes share
GRAM bytes with another; whole windows are compared next.

The suffixes whose leading bytes were met again are compared as a whole (their runs' bytes, hashed). Where all are
alike, all their windows repeat. Where not, each different context is taken once and cut into NODE windows, whose
common bytes must repeat, and then into single windows, whose bytes must. Hot passages are counted by partial sums
and different contexts, never as pairs. Hashes that decide have 128 bits. Of a long text CHUNK bytes are in hand at once;
a run that is cut there is two runs.

Defined results: null and empty texts have no bytes; documents shorter than LENGTH lose nothing; repeated rows repeat
each other; a null doc_id is kept; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Bitmap, drop_path, read, row_name, shared_path, sized_join, stash, unstash

LENGTH, GRAM, LEAD, NODE = 400, 100, 24, 16
BATCH_BYTES, LEAST_BATCHES, MOST_BATCHES = 256 << 20, 4, 16
#: Bytes of a text that are in hand at once.
CHUNK = 1 << 20
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


@lru_cache(4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(base, -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, b, np.uint64))]) for b in (np.uint64(base), inverse))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(3).integers(1, 1 << 63, (len(_BASES), 256), dtype=np.uint64)


class Rolling:
    """Hashes of any substrings of one text: mod 2**64, one for each base."""

    def __init__(self, text: bytes):
        data, self.n = np.frombuffer(text, np.uint8), len(text)
        size = 1 << max(12, self.n.bit_length())
        self.sums, self.back = [], []
        for base, values in zip(_BASES, _byte_values()):
            up, down = _powers(int(base), size)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[data] * up[: self.n], dtype=np.uint64)]))
            self.back.append(down)

    def of(self, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        h = (self.sums[k][end] - self.sums[k][start]) * self.back[k][start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(29))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def anchors(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """lead, key, place, o1, o2, and two hashes of the context, of each anchor; windows start at place - o, o1 <= o <= o2."""
    width = LENGTH - GRAM + 1
    for at in range(0, len(text) - LENGTH + 1, CHUNK):
        piece = text[at : at + CHUNK + LENGTH - 1]  # of all windows that start in the chunk
        roll = Rolling(piece)
        start = np.arange(len(piece) - GRAM + 1)
        h = roll.of(start, start + GRAM, 0)
        h = (h & ~np.uint64((1 << 22) - 1)) | start.astype(np.uint64)
        place = (sliding_least(h, width) & np.uint64((1 << 22) - 1)).astype(np.int64)  # of each window's anchor
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        m = place[first]
        lead = np.frombuffer(piece, np.uint8)[m[:, None] + np.arange(LEAD)]
        yield lead, roll.of(m, m + GRAM, 0), m + at, m - last, m - first, roll.of(first, last + LENGTH, 0), roll.of(first, last + LENGTH, 1)


SUFFIX = "r1 long, r2 long, lead binary, key long, at long, o1 int, o2 int, c1 long, c2 long"


def suffixes(documents: DataFrame) -> DataFrame:
    """(r1, r2, text) -> r1, r2, lead, key, at, o1, o2, c1, c2: the sampled suffixes."""
    names = [x.split()[0] for x in SUFFIX.split(", ")]

    def table(held: list) -> pa.RecordBatch:
        r1, r2, lead, key, at, o1, o2, c1, c2 = map(np.concatenate, zip(*held))
        lead = pa.FixedSizeBinaryArray.from_buffers(pa.binary(LEAD), len(lead), [None, pa.py_buffer(np.ascontiguousarray(lead))]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(r1), pa.array(r2), lead, pa.array(key.view(np.int64)), pa.array(at), pa.array(o1.astype(np.int32)),
                                           pa.array(o2.astype(np.int32)), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size = [], 0
            for r1, r2, text in zip(b["r1"].to_pylist(), b["r2"].to_pylist(), b["text"]):
                for found in anchors(text.as_py() or b""):
                    n = len(found[0])
                    held.append((np.full(n, r1), np.full(n, r2), *found))
                    size += n
                    if size > 100_000:
                        yield table(held)
                        held, size = [], 0
            if held:
                yield table(held)

    return documents.mapInArrow(run, SUFFIX)


class IndexFamily:
    """Levels of sorted suffix arrays: leading bytes, hash, and how many suffixes have them; level k holds 2**k batches.

    Levels are tables bucketed and sorted by what orders suffixes, all into as many buckets, so that a batch is shuffled
    once, when it comes, and scans of levels shuffle nothing. Where the suffixes lie is kept by batch, in what suffixes()
    gave, and looked up by what was met.
    """

    def __init__(self, spark):
        self.spark, self.levels, self.paths = spark, {}, {}
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # as a grouping deals rows out

    def _write(self, rows: DataFrame, on: list[str]) -> str:
        path = shared_path(self.spark, "suffixes")
        name = path.rpartition("/")[2].replace("-", "_")
        rows.write.option("compression", "zstd").option("path", path).bucketBy(self.buckets, *on).sortBy(*on).saveAsTable(name, format="parquet")
        self.paths[name] = path
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        drop_path(self.spark, self.paths.pop(name))

    def add(self, batch: DataFrame) -> DataFrame:
        """Scan a batch, of the columns that order its suffixes, against all levels and itself, then add it; gives what was met."""
        on = batch.columns
        name = self._write(batch.groupBy(*on).agg(F.count("*").alias("n")), on)
        new = self.spark.table(name)
        met = new.filter("n > 1").select(*on)
        for level in self.levels.values():
            met = met.unionByName(new.select(*on).join(self.spark.table(level).hint("merge"), on, "left_semi"))
        met = stash(met.distinct(), "met")
        size, names = 0, [name]
        while size in self.levels:  # as a binary counter carries
            names.append(self.levels.pop(size))
            size += 1
        if len(names) > 1:
            rows = reduce(DataFrame.unionByName, map(self.spark.table, names))
            name = self._write(rows.groupBy(*on).agg(F.sum("n").alias("n")), on)
            for old in names:
                self._drop(old)
        self.levels[size] = name
        return met

    def drop(self) -> None:
        for name in self.levels.values():
            self._drop(name)
        self.levels = {}


def only_met(entries: DataFrame, met: DataFrame) -> DataFrame:
    """Suffixes whose key was met. A bitmap keeps most others out of the shuffle."""
    return Bitmap(met, F.col("key")).split(entries, "key").join(met.hint("merge"), "key", "left_semi")


def _contexts(batches: Iterator[pa.RecordBatch], places) -> Iterator[pa.RecordBatch]:
    """Rows (kid, n, o, h1, h2) of hashed parts of contexts; places gives offsets o, starts and ends."""
    names = ["kid", "n", "o", "h1", "h2"]
    for b in batches:
        held = []
        for row in b.to_pylist():
            roll = Rolling(row["context"])
            o, start, end = places(row)
            h1, h2 = (roll.of(start, end, k).view(np.int64) for k in (0, 1))
            held.append((*(np.full(len(o), row[c]) for c in names[:2]), o, h1, h2))
        for at in range(0, len(held), 500):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held[at : at + 500])], names)


def _nodes(row: dict) -> tuple[np.ndarray, ...]:
    """The bytes that all windows of a node have in common; a context holds them even if its run cuts the node."""
    j = np.arange(row["o1"] // NODE, row["o2"] // NODE + 1)
    return j, row["o2"] - j * NODE, row["o2"] - (j * NODE + NODE - 1) + LENGTH


def _windows(row: dict) -> tuple[np.ndarray, ...]:
    o = np.concatenate([np.arange(max(j * NODE, row["o1"]), min(j * NODE + NODE - 1, row["o2"]) + 1) for j in row["nodes"]])
    return o, row["o2"] - o, row["o2"] - o + LENGTH


def _again(rows: DataFrame) -> DataFrame:
    """Of rows (kid, n, o, h1, h2), those whose bytes two suffixes or more have: kid, o."""
    on = ["h1", "h2"]  # of bytes that hold an anchor at a place, so both follow
    twice = rows.groupBy(*on).agg(F.sum("n").alias("all")).filter("all > 1").drop("all")
    return rows.join(twice.hint("merge"), on, "left_semi").select("kid", "o")


def repeated_windows(entries: DataFrame, documents: DataFrame) -> DataFrame:
    """Met suffixes (a stash) and documents (r1, r2, text) -> r1, r2, spans: bytes low .. high - 1 of each hold repeated strings alone."""
    kind = ["key", "o1", "o2", "c1", "c2"]
    kinds = entries.groupBy(*kind).agg(F.count("*").alias("n"), F.min(F.struct("r1", "r2", "at")).alias("one"))
    kinds = stash(kinds.withColumn("kid", F.monotonically_increasing_id()), "kinds")
    mixed = stash(kinds.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("key"), "mixed")
    alike = kinds.join(mixed.hint("merge"), "key", "left_anti").filter("n > 1").selectExpr("kid", "o1 AS low", "o2 AS high")

    one = kinds.join(mixed.hint("merge"), "key", "left_semi").select("kid", "n", "o1", "o2", "one.*")
    wanted = stash(one.groupBy("r1", "r2").agg(F.collect_list(F.struct("kid", "n", "o1", "o2", "at")).alias("w")), "wanted")
    named = Bitmap(wanted, F.col("r1")).split(documents, "r1")
    texts = sized_join(named, wanted, ["r1", "r2"], "inner").select("text", F.explode("w").alias("w")).select("text", "w.*")
    context = F.expr(f"substring(text, cast(at - o2 + 1 AS int), o2 - o1 + {LENGTH})")
    contexts = stash(texts.select("kid", "n", "o1", "o2", context.alias("context")), "contexts")
    if contexts.count() != wanted.agg(F.sum(F.size("w"))).first()[0]:  # rows alike in doc_id and text
        contexts = stash(contexts.dropDuplicates(["kid"]), "contexts", (contexts,))
    unstash(wanted)

    schema = "kid long, n long, o long, h1 long, h2 long"
    nodes = stash(contexts.mapInArrow(lambda b: _contexts(b, _nodes), schema), "nodes")
    open_ = _again(nodes).groupBy("kid").agg(F.collect_list("o").alias("nodes"))
    windows = contexts.join(open_.hint("merge"), "kid").mapInArrow(lambda b: _contexts(b, _windows), schema)
    w = Window.partitionBy("kid").orderBy("o")
    runs = _again(windows).withColumn("run", F.col("o") - F.row_number().over(w)).groupBy("kid", "run").agg(F.min("o").alias("low"), F.max("o").alias("high"))
    runs = runs.select("kid", F.col("low").cast("int"), F.col("high").cast("int")).unionByName(alike)
    runs = runs.groupBy("kid").agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    found = stash(kinds.join(runs, "kid").select(*kind, "runs"), "runs", (nodes, contexts, mixed, kinds))
    spans = entries.join(found.hint("merge"), kind).select("r1", "r2", "at", F.explode("runs").alias("r"))
    spans = spans.select("r1", "r2", (F.col("at") - F.col("r.high")).alias("low"), (F.col("at") - F.col("r.low") + LENGTH).alias("high"))
    return stash(spans.groupBy("r1", "r2").agg(F.collect_set(F.struct("low", "high")).alias("spans")), "spans", (entries, found))


def batches_by_size(documents: DataFrame) -> int:
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return int(max(LEAST_BATCHES, min(MOST_BATCHES, -(-size // BATCH_BYTES))))


def strip_repeats(documents: DataFrame, batches: int | None = None) -> DataFrame:
    """documents -> doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) of every document."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    docs = documents.select("doc_id", row_name().alias("rid"), text.alias("text")).select("doc_id", F.col("rid.a").alias("r1"), F.col("rid.b").alias("r2"), "text")
    entries = stash(suffixes(docs.select("r1", "r2", "text")), "entries")
    batches = batches or batches_by_size(docs)
    family, met = IndexFamily(spark), []
    for k in range(batches):
        met.append(family.add(entries.filter(F.pmod("r2", F.lit(batches)) == k).select("lead", "key")))
    family.drop()
    keys = stash(reduce(DataFrame.unionByName, met).select("key").distinct(), "met_keys", tuple(met))
    hit = stash(only_met(entries.drop("lead"), keys), "hit", (entries, keys))
    spans = repeated_windows(hit, docs.select("r1", "r2", "text"))

    def cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            for at in range(0, len(b), 512):
                part, out = b.slice(at, 512), []
                for text, spans in zip(part["text"], part["spans"].to_pylist()):
                    text, kept, pos, n = text.as_py(), [], 0, 0
                    merged: list[list[int]] = []
                    for low, high in sorted((s["low"], s["high"]) for s in spans or ()):
                        if merged and low <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], high)
                        else:
                            merged.append([low, high])
                    for low, high in merged:
                        kept.append(text[pos:low])
                        pos, n = high, n + high - low
                    kept.append(text[pos:])
                    out.append((len(text), n, len(merged), b"".join(kept)))
                a, c, d, e = zip(*out)
                yield pa.RecordBatch.from_arrays([part["doc_id"], *(pa.array(x, pa.int64()) for x in (a, c, d)), pa.array(e, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    # documents without repeats, as a bitmap tells, are in no shuffle
    marked = Bitmap(spans, F.col("r1")).mark(docs, F.col("r1"))
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    joined = sized_join(marked.filter("may"), spans, ["r1", "r2"], "left").select("doc_id", "text", "spans")
    joined = joined.unionByName(marked.filter("NOT may").select("doc_id", "text", none.alias("spans")))
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = strip_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
