"""Embedding near-duplicates by cross-polytope hashing.

A table's hash of a unit vector is the nearest signed axis after fast Hadamard rotations (three rounds of random signs
and a Walsh-Hadamard transform), for FUNCTIONS rotations together. A vector is at home in one bucket of each of
TABLES tables and, by multiprobe, also goes to the PROBES - 1 next likely ones. Homes meet all rows of their bucket;
each such pair of equal labels is verified by its cosine in double precision. All vectors are indexed.

Vectors do not travel to all those buckets. What does is a sketch of BITS signs of random projections: where no row of a
bucket has a sketch at most MOST_APART bits off, no vector of it can link but with a chance below one in ten million, as
a pair at MIN_COSINE differs in 15 of 128 bits on average. Rows that have such a partner are marked by a bit for each of
their buckets, and only these are sent again, with vectors, to be verified. No pair is ever a row.

Equal vectors of a label are one class before hashing and count as links of each other. A hot bucket is cut into
blocks that meet pair by pair. A group gives counts and the edges of a spanning forest, never its pairs; a pair that
meets in several buckets counts in the first alone, which the hashes both rows carry tell.

Recall over pairs of cosine 0.93 in 64 dimensions, with the values below, is measured in tests/llm.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label,
link with nothing; vectors of different lengths do not link; a repeated vec_id is a vector each time; a null vec_id is
a component_id only if there is no other; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, deal_blocks, hot_safe_left_join, read, sized_join, stash, whole_groups

MIN_COSINE = 0.93
TABLES, FUNCTIONS, PROBES, SEED = 6, 2, 4, 5
BITS, MOST_APART = 128, 36
BLOCK = 1024
#: Pairs of sketches compared at a time in a task.
PAIRS_AT_ONCE = 1 << 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of rows, whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x


def hashes(unit: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Codes of shape (rows, TABLES, PROBES): the home bucket first, then the next likely ones."""
    n, dim = unit.shape
    size = max(2, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = unit
    keep = min(PROBES, 2 * size)
    out = np.zeros((n, TABLES, PROBES), np.int64)
    for t in range(TABLES):
        code, loss = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for f in range(FUNCTIONS):
            rng = np.random.default_rng([seed, size, t, f])
            x = padded
            for _ in range(3):
                x = hadamard(x * rng.choice([-1.0, 1.0], size)) / np.sqrt(size)
            # an axis e is missed by so much: the squared distance to it, over that to the nearest
            signed = np.concatenate([x, -x], axis=1)
            near = np.argsort(-signed, axis=1, kind="stable")[:, :keep]
            best = np.take_along_axis(signed, near, axis=1)
            lost = best[:, :1] - best
            code = (code[:, :, None] * (2 * size) + near[:, None, :]).reshape(n, -1)
            loss = (loss[:, :, None] + lost[:, None, :]).reshape(n, -1)
            first = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
            code, loss = np.take_along_axis(code, first, axis=1), np.take_along_axis(loss, first, axis=1)
        out[:, t, : code.shape[1]] = code
        out[:, t, code.shape[1] :] = code[:, :1]
    return out


def meet(vec: np.ndarray, home: np.ndarray, other: np.ndarray, node: np.ndarray, count: np.ndarray, codes: np.ndarray, table: int, least: float):
    """Links of one group's homes and others: how many vectors each row gains, and forest edges, as places in the group.

    A pair counts only in the first table where one's home is among the other's probes, and in the lesser of the two
    homes' buckets if both would do.
    """
    h, e = np.flatnonzero(home), np.flatnonzero(other)
    gained, root = np.zeros(len(node), np.int64), np.arange(len(node))
    near = vec[h] @ vec[e].T >= least
    near &= node[h][:, None] != node[e][None, :]
    if not near.any():
        return gained, root
    a, b = np.nonzero(near)
    a, b = h[a], e[b]
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        ab = (codes[x][:, :, :1] == codes[y]).any(axis=2)  # home of x among the probes of y
        ba = (codes[y][:, :, :1] == codes[x]).any(axis=2)
        first = (ab | ba).argmax(axis=1)
        k = np.arange(len(x))
        hx, hy = codes[x, table, 0], codes[y, table, 0]
        same = hx == hy
        own = np.where(same, node[x] < node[y], np.where(ba[k, table], hx < hy, True))
        good = (first == table) & own
        np.add.at(gained, x[good], count[y[good]])
        np.add.at(gained, y[good], count[x[good]])
    while True:
        old = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        if (old == root).all():
            return gained, root


def classes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, key) and classes of equal vectors (key, label, embedding, n, first, cid); key is null if invalid."""
    finite = F.expr("NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')) AND exists(embedding, x -> x <> 0)")
    valid = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    key = F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("array<string>")), 256)
    rows = stash(embeddings.select("vec_id", "label", "embedding", F.when(valid, key).alias("key")), "vectors")
    found = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.first(F.col("label").cast("string")).alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("first"))
    return rows.select("vec_id", "key"), stash(found.withColumn("cid", F.monotonically_increasing_id()), "vector_classes")


def sketches(unit: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Signs of BITS random projections of each row, as words of 64 bits."""
    planes = np.random.default_rng([seed, unit.shape[1], BITS]).standard_normal((unit.shape[1], BITS))
    return np.packbits(unit @ planes >= 0, axis=1).view(np.uint64)


def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of vectors of one length: the slice, its vectors as given, at length one, and their codes."""
    for b in batches:
        for at in range(0, len(b), 512):
            part = b.slice(at, 512)
            sizes = np.array([len(v) for v in part["embedding"]])
            for dim in np.unique(sizes):
                p = part.take(pa.array(np.flatnonzero(sizes == dim)))
                x = p["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                yield p, x, unit(x), hashes(unit(x))


def bucketed(rows: DataFrame) -> DataFrame:
    """Rows (label, dim, table, code, ...) with names of their buckets: those that clash in one hash are told apart by the other."""
    key = ["label", "dim", "table", "code"]
    return rows.withColumns({"bucket": F.xxhash64(*key), "bucket2": F.xxhash64(F.lit("b"), *key)}).drop("label", "dim", "code")


def promising(found: DataFrame) -> DataFrame:
    """Classes -> rows (cid, places): a bit for each bucket, table * PROBES + probe, in which a class has a partner by sketch."""
    words = [f"s{i}" for i in range(BITS // 64)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, _, x, codes in coded(batches):
            # a probe that is the home again is left out
            new = np.ones(codes.shape, bool)
            new[:, :, 1:] = codes[:, :, 1:] != codes[:, :, :1]
            row, table, probe = np.nonzero(new)
            take, signs = pa.array(row), sketches(x).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [p["label"].take(take), pa.array(np.full(len(row), x.shape[1])), pa.array(table), pa.array(codes[new]), pa.array((table * PROBES + probe).astype(np.int32)),
                 p["cid"].take(take)] + [pa.array(signs[row, i]) for i in range(len(words))], ["label", "dim", "table", "code", "place", "cid", *words])

    rows = found.select("label", "cid", "embedding").mapInArrow(
        spread, "label string, dim long, table long, code long, place int, cid long, " + ", ".join(f"{w} long" for w in words))
    rows = bucketed(rows).withColumn("home", F.col("place") % PROBES == 0).drop("bucket2", "table")

    def meet_sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, bounds in whole_groups(batches, ["bucket", "i", "j"]):
            node, signs = g["cid"].to_numpy(), g[words].to_numpy().view(np.uint64)
            start, size = (np.repeat(x, np.diff(bounds)) for x in (bounds[:-1], np.diff(bounds)))
            homes = np.flatnonzero(g["home"].to_numpy() & (size > 1))
            slices = np.cumsum(size[homes]) // PAIRS_AT_ONCE
            alive = np.zeros(len(g), bool)
            for k in np.unique(slices):
                h = homes[slices == k]
                n = size[h]
                a = np.repeat(h, n)
                b = np.arange(len(a)) + np.repeat(start[h] - (np.cumsum(n) - n), n)
                apart = np.zeros(len(a), np.uint8)
                for i in range(len(words)):
                    apart += np.bitwise_count(signs[a, i] ^ signs[b, i])
                near = (apart <= MOST_APART) & (node[a] != node[b])
                alive[a[near]] = alive[b[near]] = True
            yield pd.DataFrame({"cid": node[alive], "place": g["place"].to_numpy()[alive]})

    met = deal_blocks(rows, "bucket", "cid", BLOCK).mapInPandas(meet_sketches, "cid long, place int")
    return met.groupBy("cid").agg(F.expr("bit_or(shiftleft(1L, place))").alias("places"))


def links(found: DataFrame, least: float = MIN_COSINE) -> DataFrame:
    """Classes with places -> rows (cid, root, gained): counts of vectors linked, and edges cid - root of forests."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "dim", "table", "code", "home", "cid", "n", "vec", "codes"]
        for p, vecs, x, codes in coded(batches):
            told = p["places"].to_numpy()[:, None] >> np.arange(TABLES * PROBES) & 1
            row, table, probe = np.nonzero(told.reshape(codes.shape))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                p["label"].take(take), pa.array(np.full(len(row), x.shape[1])), pa.array(table), pa.array(codes[row, table, probe]), pa.array(probe == 0), p["cid"].take(take),
                p["n"].take(take), pa.array([v.tobytes() for v in vecs], pa.binary()).take(take), pa.array([c.tobytes() for c in codes], pa.binary()).take(take)], names)

    kind = "<f4" if found.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = bucketed(found.select("label", "cid", "n", "embedding", "places").mapInArrow(
        spread, "label string, dim long, table long, code long, home boolean, cid long, n long, vec binary, codes binary"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, bounds in whole_groups(batches, ["bucket", "i", "j"]):
            home, node, count, table, second, cut = (g[c].to_numpy() for c in ("home", "cid", "n", "table", "bucket2", "cut"))
            vec, codes = g["vec"].to_numpy(), g["codes"].to_numpy()
            homes = np.add.reduceat(home.astype(int), bounds[:-1])
            out = []
            for k in np.flatnonzero((np.diff(bounds) > 1) & (homes > 0)):
                at = np.arange(bounds[k], bounds[k + 1])
                for part in [at] if (second[at] == second[at[0]]).all() else [at[second[at] == s] for s in np.unique(second[at])]:
                    x = unit(np.frombuffer(b"".join(vec[part]), kind).reshape(len(part), -1))
                    c = np.frombuffer(b"".join(codes[part]), np.int64).reshape(-1, TABLES, PROBES)
                    gained, root = meet(x, home[part], ~home[part] | ~cut[part], node[part], count[part], c, int(table[part[0]]), least)
                    told = np.flatnonzero((gained > 0) | (root != np.arange(len(part))))
                    if len(told):
                        out.append((node[part][told], node[part][root[told]], gained[told]))
            yield pd.DataFrame(dict(zip(("cid", "root", "gained"), map(np.concatenate, zip(*out)))) if out else {"cid": [], "root": [], "gained": []}).astype("int64")

    return deal_blocks(rows, "bucket", "cid", BLOCK).mapInPandas(compare, "cid long, root long, gained long")


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled by a power of two first, which rounds nothing, so that no square overflows."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(embeddings: DataFrame, least: float = MIN_COSINE) -> DataFrame:
    """embeddings(vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    rows, found = classes(embeddings)
    marked = stash(promising(found), "promising")
    met = stash(links(sized_join(found, marked, "cid", "inner"), least), "met")
    gained = met.groupBy("cid").agg(F.sum("gained").alias("gained"))
    roots = components(met.selectExpr("cid AS a", "root AS b")).withColumnRenamed("node", "cid")
    c = found.select("key", "cid", "n", "first").join(gained, "cid", "left").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least_id = c.groupBy("root").agg(F.min("first").alias("component_id"))
    c = stash(c.join(least_id, "root").select("key", (F.col("n") - 1 + F.coalesce("gained", F.lit(0))).alias("n_links"), "component_id"), "vector_links")
    out = hot_safe_left_join(rows, c, "key")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
