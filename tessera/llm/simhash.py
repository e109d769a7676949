"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of a perfect Hamming code of length 31 (covering radius 1). Two fingerprints at 3 or fewer
differing bits differ in at most 1 bit in one of two disjoint 31-bit blocks. A fingerprint is at home at the one anchor
within radius 1 of its block and is copied to every anchor within radius 1 + 1 = 2 of it (1 or 16); then of two that
differ by at most 1 bit in a block, the one is among the copies at the other's home. Homes and copies are compared
there on all 64 bits, so no pair is missed.

Equal fingerprints are one class before comparing. A hot anchor is cut into blocks of homes and blocks of copies, each
pair of blocks a group of its own. A group gives the edges of a spanning forest, never all its pairs.

Defined results: a null, empty or blank text has fingerprint zero and links like any other; repeated rows are one
class; a null doc_id never is a component_id unless its component has no other; an empty table gives an empty result.
Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Bitmap, components, deal_blocks, hot_safe_left_join, read, row_name, sized_join, stash, whole_groups
from tessera.llm.near_copies import near_copy_groups

SHINGLE_WORDS, SEED, MAX_DIFF = 3, 42, 3
#: Rows of one anchor beyond which it is cut into blocks of about so many.
BLOCK = 1024
CODE_BITS = 31


def fingerprint(text: bytes) -> int:
    import xxhash

    words = text.lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    k = min(SHINGLE_WORDS, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, bits, n = xxhash.xxh64_digest, np.zeros(64, np.int64), len(words) - k + 1
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        h = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist())])
        bits += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big", signed=True)


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, rid (a name of both), fp (64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py() or b"") for t in b["text"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["rid"], pa.array(fps, pa.int64())], ["doc_id", "rid", "fp"])

    rows = documents.select(F.col("doc_id").cast("long"), row_name().alias("rid"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, rid struct<a:long,b:long>, fp long")


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each copy: index of the fingerprint, anchor, and whether it is at home there."""
    place = np.arange(1, CODE_BITS + 1)
    pairs = {s: [1 << (i - 1) | 1 << ((i ^ s) - 1) for i in place if i < i ^ s] for s in place}
    table = np.array([[0] * 15] + [pairs[s] for s in place], np.int64)
    index, anchor, home = [], [], []
    for block in (0, 1):
        x = (fps.astype(np.uint64) >> np.uint64(CODE_BITS * block)).astype(np.int64) & ((1 << CODE_BITS) - 1)
        syndrome = np.bitwise_xor.reduce(((x[:, None] >> (place - 1)) & 1) * place, axis=1)
        base = np.int64(block) << CODE_BITS
        index.append(np.arange(len(x)))
        anchor.append(base | x ^ np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0))
        home.append(np.ones(len(x), bool))
        off = np.flatnonzero(syndrome)
        index.append(np.repeat(off, 15))
        anchor.append(base | (x[off][:, None] ^ table[syndrome[off]]).ravel())
        home.append(np.zeros(15 * len(off), bool))
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def forest(home: np.ndarray, every: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, root) of the components of the links between home and every."""
    nodes, at = np.unique(np.concatenate([home, every]), return_inverse=True)
    h, e = at[: len(home)], at[len(home) :]
    near = np.bitwise_count(home[:, None].view(np.uint64) ^ every[None, :].view(np.uint64)) <= MAX_DIFF
    if not (near & (home[:, None] != every[None, :])).any():
        return []
    label = np.arange(len(nodes))
    while True:
        old = label.copy()
        np.minimum.at(label, h, np.where(near, label[e][None, :], len(nodes)).min(axis=1))
        np.minimum.at(label, e, np.where(near, label[h][:, None], len(nodes)).min(axis=0))
        if (old == label).all():
            return [(int(nodes[i]), int(nodes[r])) for i, r in enumerate(label) if i != r]


def links(fps: DataFrame) -> DataFrame:
    """(fp) distinct -> a, b: spanning links of the graph of fingerprints at MAX_DIFF bits or fewer."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b["fp"].to_numpy(zero_copy_only=False)
            for at in range(0, len(x), 4096):
                i, anchor, home = anchors(x[at : at + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(x[at : at + 4096][i]), pa.array(home)], ["anchor", "fp", "home"])

    copies = fps.mapInArrow(copy, "anchor long, fp long, home boolean")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, bounds in whole_groups(batches, ["anchor", "i", "j"]):
            fp, home, cut = (rows[c].to_numpy() for c in ("fp", "home", "cut"))
            homes = np.add.reduceat(home.astype(int), bounds[:-1])
            edges = []
            for g in np.flatnonzero((np.diff(bounds) > 1) & (homes > 0)):
                x, y = fp[bounds[g] : bounds[g + 1]], home[bounds[g] : bounds[g + 1]]
                edges += forest(x[y], x[~y] if cut[bounds[g]] else x)
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return deal_blocks(copies, "anchor", "fp", BLOCK).mapInPandas(compare, "a long, b long")


def simhash_groups(documents: DataFrame) -> DataFrame:
    """documents -> doc_id, rid, fingerprint, component_id, root (a name of the component, unlike its id never shared)."""
    docs = stash(fingerprints(documents), "fingerprints")
    fps = stash(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(fps.select("fp"))).withColumnRenamed("node", "fp")
    joined = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stash(joined.join(least, "root").select("fp", "component_id", "root"), "named", (fps,))
    out = hot_safe_left_join(docs, named, "fp")
    return out.select("doc_id", "rid", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each component of near copies, that of the smallest doc_id, with all its columns.

    SimHash's links propose near copies, a prefix filter (near_copies.py) those that 64 bits miss, and an exact five-word
    Jaccard similarity decides on both. Of rows alike in doc_id and text one stays. Texts of which none is dropped, as a bitmap of the dropped ones tells, are not shuffled.
    """
    found = near_copy_groups(documents, fingerprint, links)
    groups = stash(found, "near_copies", found.made_from)
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("rid").alias("rid"))
    size = groups.groupBy("rid").agg(F.count("*").alias("n"))
    # of each name with a row to drop: whether one row of it stays
    names = sized_join(size, first.select("rid", F.lit(True).alias("stays")), "rid", "left")
    touched = names.filter("stays IS NULL OR n > 1").select("rid", F.coalesce("stays", F.lit(False)).alias("stays"))
    touched = stash(touched, "touched", (groups,))
    columns = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(row_name().alias("rid"), F.struct(*columns).alias("row"))
    rows = Bitmap(touched, F.col("rid.a")).mark(rows, F.col("rid.a"))
    met = sized_join(rows.filter("may"), touched, "rid", "left").select("rid", "row", "stays")
    single = met.filter("stays").dropDuplicates(["rid"])
    out = rows.filter("NOT may").select("row").unionByName(met.filter("stays IS NULL").select("row")).unionByName(single.select("row"))
    return out.select("row.*")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
