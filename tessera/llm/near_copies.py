"""Near copies of documents: all pairs whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Every filter is a bound, so no pair is missed. With all shingles in one order, of two such sets of n and m shingles the
first n - ceil(0.8 n) + 1 of the one and the like of the other share a member (prefix filter). The order is by hash, but
frequent shingles, which are counted first, come last: a passage that many documents share is in the prefix of hardly
any. Sizes differ by at most a quarter, and the bits that differ in the two parity bitmaps are at most the shingles that
only one of them has; a bitmap has a bit for each shingle or more, and is folded in halves to compare it with a shorter
one. What passes links candidates, as do the fingerprints that simhash.py finds near, where it is given; in each component of candidates all pairs are compared on their whole sets.

Equal sets are one class before comparing. Of the shingles that hold the same classes one is looked at. A hot shingle,
and a large component of candidates, is cut into blocks; groups give edges of a spanning forest, never all pairs.

Defined results: words are split at ASCII white space, A-Z lower-cased; a text of fewer than five words is one shingle;
null, empty and blank texts are one class. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Bitmap, components, deal_blocks, give_back, hot_safe_left_join, is_small, row_name, sized_join, stash, unstash, whole_groups

#: Least similarity, as a fraction.
SHINGLE_WORDS, SEED, PART, OF = 5, 42, 4, 5
LEAST_BITS = 512
#: Rows of one shingle or component beyond which it is cut into blocks of about so many.
BLOCK = 512
#: Shingles that are compared at once within a group.
COLUMNS = 4096
#: Shingles of a slice of documents; those that more than one document in FREQUENT_OF has count as frequent, in steps of
#: powers of two if they are told of more than BLOCK times. At most FREQUENT_MOST, the most frequent, are put last; which they are changes no result.
SLICE_WORDS, FREQUENT_OF, FREQUENT_MOST = 250_000, 250, 200_000
CACHE_WORDS = 200_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return h


class Shingler:
    """Hashes of the shingles of many texts at once; remembers the hashes of words."""

    def __init__(self):
        self.words = WordHashes()

    def shingles(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the shingles of each text, one text after the other, and where each text's end."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        # bytes: A-Z and ASCII white space alone; shorter texts are filled up with a word that no text has
        split = [w if len(w := t.lower().split()) >= SHINGLE_WORDS or not w else w + [b""] * (SHINGLE_WORDS - len(w)) for t in texts]
        size = np.fromiter(map(len, split), np.int64, len(split))
        out = h = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.uint64, int(size.sum()))
        for k in range(1, SHINGLE_WORDS):
            out = (out[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[k:]) * np.uint64(0xC2B2AE3D27D4EB4F)
            out ^= out >> np.uint64(31)
        count = np.maximum(size - SHINGLE_WORDS + 1, 0)
        ends = np.cumsum(count)
        skipped = np.cumsum(size) - size - (ends - count)  # windows over two texts, before each text
        return out[np.arange(int(count.sum())) + np.repeat(skipped, count)].view(np.int64), ends

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The different shingles of each text, sorted."""
        flat, ends = self.shingles(texts)
        return [np.unique(flat[i:j]) for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of batches (with a binary text) of about SLICE_WORDS words."""
    for b in batches:
        texts = [t.as_py() or b"" for t in b["text"]]
        upto = np.cumsum([len(t) // 6 for t in texts])
        at = 0
        while at < len(b):
            to = max(at + 1, int(np.searchsorted(upto, SLICE_WORDS + (upto[at - 1] if at else 0), "right")))
            yield b.slice(at, to - at), texts[at:to]
            at = to
        del texts
        give_back()


def frequent(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and how frequent each is, as the power of two of its count.

    A slice of documents tells of the shingles that more than one in FREQUENT_OF of its documents has, so the rows to sum
    are few, and so are the shingles that stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for part, texts in sliced(batches):
            h, n = np.unique(shingler.shingles(texts)[0], return_counts=True)
            often = n > max(2, len(texts) // FREQUENT_OF)
            yield pa.RecordBatch.from_arrays([pa.array(h[often]), pa.array(n[often])], ["shingle", "n"])

    counts = documents.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = stash(counts, "frequent")
    least = counts.filter(F.col("n") > BLOCK).orderBy(F.desc("n")).limit(FREQUENT_MOST)
    found = least.toArrow()
    unstash(counts)
    h, n = found["shingle"].to_numpy(), found["n"].to_numpy()
    order = np.argsort(h)
    return h[order], np.log2(np.maximum(n[order], 1)).astype(np.int64)


def sketches(documents: DataFrame, fingerprint: Callable[[bytes], int] | None = None) -> DataFrame:
    """documents -> doc_id, rid, set (hash of the set), n, bits (parity bitmap), prefix and fp (of one document of a set in a slice)."""
    often = documents.sparkSession.sparkContext.broadcast(frequent(documents))  # 3 MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler, (late, how) = Shingler(), often.value
        for b, texts in sliced(batches):
            sets = shingler.sets(texts)
            flat, count = np.concatenate(sets), np.array([len(x) for x in sets], np.int64)
            at = np.searchsorted(late, flat)
            at[at == len(late)] = 0
            rank = np.where(late[at] == flat, how[at], 0) if len(late) else np.zeros(len(flat), np.int64)
            names, bits, prefixes, fps, met = [], [], [], [], set()
            for s, r, text in zip(sets, np.split(rank, np.cumsum(count)[:-1]), texts):
                names.append(int.from_bytes(xxhash.xxh64_digest(s.tobytes(), SEED), "big", signed=True))
                size = max(LEAST_BITS, 1 << (len(s) - 1).bit_length())
                bits.append(np.packbits((np.bincount(s & (size - 1), minlength=size) & 1).astype(bool)).tobytes())
                first = s if not r.any() else s[np.argsort(r, kind="stable")]
                prefixes.append(first[: 0 if names[-1] in met else len(s) - -(-PART * len(s) // OF) + 1])
                fps.append(None if fingerprint is None or names[-1] in met else fingerprint(text))
                met.add(names[-1])
            cut = np.cumsum([0] + [len(p) for p in prefixes])
            prefix = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.concatenate(prefixes)))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["rid"], pa.array(names, pa.int64()), pa.array(count, pa.int32()), pa.array(bits, pa.binary()), prefix, pa.array(fps, pa.int64())],
                                             ["doc_id", "rid", "set", "n", "bits", "prefix", "fp"])

    rows = documents.select(F.col("doc_id").cast("long"), row_name().alias("rid"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, rid struct<a:long,b:long>, set long, n int, bits binary, prefix array<long>, fp long")


def forest(a: np.ndarray, b: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Edges (node, root) of the components of the links between nodes a and b where near is true."""
    if not (near & (a[:, None] != b[None, :])).any():
        return []
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        old = label.copy()
        np.minimum.at(label, x, np.where(near, label[y][None, :], len(nodes)).min(axis=1))
        np.minimum.at(label, y, np.where(near, label[x][:, None], len(nodes)).min(axis=0))
        if (old == label).all():
            return [(int(nodes[i]), int(nodes[r])) for i, r in enumerate(label) if i != r]


def bitmaps(bits: list[bytes], words: int) -> np.ndarray:
    """Bitmaps of one length, folded to so many words of 64 bits."""
    x = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)
    return np.bitwise_xor.reduce(x.reshape(len(bits), -1, words), axis=1)


def maybe_near(bits: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that sizes and bitmaps allow to be near: at most (n + m) (1 - s) / (1 + s) shingles are in one set alone."""
    n, m = sizes[a][:, None], sizes[b][None, :]
    words = np.array([len(x) // 8 for x in bits])
    out = np.zeros((len(a), len(b)), bool)
    for v in np.unique(words[a]):
        for w in np.unique(words[b]):
            if not w <= 2 * v <= 4 * w:  # sizes differ by more than a quarter
                continue
            i, j, least = np.flatnonzero(words[a] == v), np.flatnonzero(words[b] == w), int(min(v, w))
            x, y = bitmaps(list(bits[a[i]]), least), bitmaps(list(bits[b[j]]), least)
            differ = np.zeros((len(i), len(j)), np.int32)
            for k in range(least):
                differ += np.bitwise_count(x[:, k][:, None] ^ y[:, k][None, :])
            out[np.ix_(i, j)] = differ * (OF + PART) <= (n[i] + m[:, j]) * (OF - PART)
    return out & (OF * n >= PART * m) & (OF * m >= PART * n)


def near(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Pairs of rows and columns, places in sets, whose similarity is PART / OF or more."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    _, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1  # shingles of one set alone are in no intersection
    common = count[inverse] > 1
    owner, term = np.repeat(np.arange(len(sets)), sizes)[common], number[inverse[common]]
    by_term = np.argsort(term, kind="stable")
    owner, term = owner[by_term], term[by_term]
    both = np.zeros((len(rows), len(columns)), np.float32)
    for at in range(0, int(term[-1]) + 1 if len(term) else 0, COLUMNS):
        i, j = np.searchsorted(term, [at, at + COLUMNS])
        has = np.zeros((len(sets), min(COLUMNS, int(term[-1]) + 1 - at)), np.float32)
        has[owner[i:j], term[i:j] - at] = 1
        both += has[rows] @ has[columns].T
    return both * (OF + PART) >= PART * (sizes[rows][:, None] + sizes[columns][None, :])


def compared(groups: DataFrame, key: str, link) -> DataFrame:
    """Links a, b of each group of deal_blocks: link(rows of the group, places a, places b) is a matrix."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, bounds in whole_groups(batches, [key, "i", "j"]):
            name, home, cut = (rows[c].to_numpy() for c in ("set", "home", "cut"))
            edges = []
            for g in np.flatnonzero(np.diff(bounds) > 1):
                at = np.arange(bounds[g], bounds[g + 1])
                a, b = (at[home[at]], at[~home[at]]) if cut[at[0]] else (at, at)
                if len(a) and len(b):
                    edges += forest(name[a], name[b], link(rows.iloc[at[0] : at[-1] + 1], a - at[0], b - at[0]))
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return groups.mapInPandas(compare, "a long, b long")


def candidates(docs: DataFrame) -> DataFrame:
    """Sketches -> a, b: spanning links of the sets that share a shingle of both prefixes and may be near."""
    entries = docs.select("set", F.explode("prefix").alias("shingle"))
    # most shingles are met once: their hashes alone are counted, and a bitmap keeps most of the others from the shuffle
    again = stash(entries.groupBy("shingle").agg(F.count("*").alias("k")).filter("k > 1").select("shingle"), "again")
    entries = stash(Bitmap(again, F.col("shingle")).split(entries, "shingle").distinct(), "entries", (again,))
    held = entries.groupBy("shingle").agg(F.count("*").alias("k"), *(F.sum(F.xxhash64(F.lit(x), "set").cast("decimal(38,0)")).alias(f"names{x}") for x in (0, 1)))
    kept = stash(held.filter("k > 1").groupBy("k", "names0", "names1").agg(F.min("shingle").alias("shingle")).select("shingle"), "shingles")
    entries = stash(sized_join(entries, kept, "shingle", "left_semi"), "kept_entries", (entries, kept))
    wanted = stash(entries.select("set").distinct(), "wanted")
    named = Bitmap(wanted, F.col("set")).split(docs.select("set", "n", "bits"), "set").dropDuplicates(["set"])
    rows = stash(sized_join(entries, named, "set", "inner").withColumn("home", F.lit(True)), "groups", (entries, wanted))

    def link(rows: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return maybe_near(rows["bits"].to_numpy(), rows["n"].to_numpy(np.int64), a, b)

    return compared(deal_blocks(rows, "shingle", "set", BLOCK), "shingle", link)


def fingerprint_candidates(docs: DataFrame, near_fingerprints: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sketches -> a, b: links of the sets whose fingerprints are equal or near."""
    marks = docs.filter("fp IS NOT NULL").select("set", "fp")
    first = stash(marks.groupBy("fp").agg(F.min("set").alias("first")), "fingerprints")
    few = is_small(first)
    side = lambda x: F.broadcast(x) if few else x.hint("merge")  # noqa: E731  x: first, its columns renamed
    equal = marks.join(side(first), "fp").filter("set <> first").select(F.col("set").alias("a"), F.col("first").alias("b"))
    found = near_fingerprints(first.select("fp"))
    for end in ("a", "b"):
        found = found.join(side(first.select(F.col("fp").alias(end), F.col("first").alias(f"set_{end}"))), end)
    return equal.unionByName(found.select(F.col("set_a").alias("a"), F.col("set_b").alias("b")))


def links(documents: DataFrame, docs: DataFrame, classes: DataFrame, near_fingerprints: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """a, b: spanning links of the graph of the sets of similarity PART / OF or more, among the candidates of both kinds."""
    proposed = candidates(docs)
    if near_fingerprints is not None:
        proposed = fingerprint_candidates(docs, near_fingerprints).unionByName(proposed)
    roots = stash(components(proposed).withColumnRenamed("node", "set"), "candidates")
    members = stash(sized_join(classes.select("set", "rid"), roots, "set", "inner"), "members", (roots,))
    named = documents.select(row_name().alias("rid"), F.col("text").cast("binary").alias("text"))
    named = Bitmap(members, F.col("rid.a")).split(named, "rid.a")
    texts = sized_join(named, members, "rid", "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for b, texts in sliced(batches):
            sets = [x.tobytes() for x in shingler.sets(texts)]
            yield pa.RecordBatch.from_arrays([b["root"], b["set"], pa.array(sets, pa.binary())], ["root", "set", "members"])

    rows = texts.select("root", "set", "text").mapInArrow(run, "root long, set long, members binary").dropDuplicates(["set"])
    rows = stash(rows.withColumn("home", F.lit(True)), "sets", (members,))

    def link(rows: pd.DataFrame, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return near([np.frombuffer(s, np.int64) for s in rows["members"]], a, b)

    return compared(deal_blocks(rows, "root", "set", BLOCK), "root", link)


def near_copy_groups(
    documents: DataFrame, fingerprint: Callable[[bytes], int] | None = None, near_fingerprints: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """documents -> doc_id, rid, component_id (least doc_id), root (a name of the component, unlike its id never shared)."""
    docs = stash(sketches(documents, fingerprint), "sketches")
    classes = stash(docs.groupBy("set").agg(F.min("doc_id").alias("first"), F.min("rid").alias("rid")), "classes")
    roots = components(links(documents, docs, classes, near_fingerprints)).withColumnRenamed("node", "set")
    joined = sized_join(classes.select("set", "first"), roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stash(joined.join(least, "root").select("set", "component_id", "root"), "named", (classes,))
    out = hot_safe_left_join(docs.select("doc_id", "rid", "set"), named, "set").select("doc_id", "rid", "component_id", "root")
    out.made_from = (docs, named)
    return out
