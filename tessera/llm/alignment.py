"""Cross-tokenizer alignment by external spill counting.

A text is encoded by two tokenizers; the byte offsets where tokens of both end cut it into groups, and each token of one side
is linked with each of the other in its group. Neither tokenizer joins anything across a single space between two other
characters, so long texts are cut there. Offsets, groups and links of a batch of documents are numpy arrays.

Documents are dealt with in batches. A batch's pair-document records are sorted by radix (a hash of the first side's id), then by
pair, first side first, and written as a zstd run: for each radix its pairs with their numbers of documents, and beside
them the records themselves. Runs of a radix are merged by a k-way heap, FAN at a time, until one is left, which counts each
pair over all documents; as its order is first side first, the highest count of an id is known when the id's last pair has
gone by. Counts go back the same way: each run looks its pairs up in the run it was merged into. So what meets in a task
is at most FAN runs of a radix, however frequent a token is; a batch's records meet the counts of its own pairs alone.

Defined results: null and empty texts, and texts whose joined token bytes on either side differ from a space and the text, have no
tokens: zeros, and '' for groups_sha256. Strings of special tokens are plain text. Repeated rows are documents of their own, a
null doc_id is kept; an empty table gives an empty result. Other columns are ignored. A long text is encoded a segment at a time.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, read, small_batches, stash, unstash

#: The first side by two libraries: the second is faster, and slow only in long runs without or of white space.
TOKENIZER_A, RANKS_A, TOKENIZER_B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Characters of a batch, and of what is encoded at a time; documents of a batch.
BATCH_CHARS, SEGMENT_CHARS, BATCH_DOCS = 4 << 20, 1 << 20, 1 << 15
RADICES, FAN = 32, 256
#: A key is a radix, the first side's id, so many bits of the second's, and so many of the document's number in its batch.
SIDE_BITS, DOC_BITS = 20, 15
#: Links of a group that are spread out one by one; larger groups go by their different ids.
GROUP_LINKS = 4096
#: Rows of runs or batches in hand at a time.
ROWS = 8
_CUT = re.compile(r"(?<=\S) (?=\S)")
_LONG_RUN = re.compile(r"\S{1000}|\s{1000}")
RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
#: A row for each batch: its documents, the runs of its radices, and the records (documents and times of each pair) in their order.
BATCHES = """batch long, doc_ids array<long>, sums binary, digests array<string>, runs array<struct<radix: int, pairs: binary, n: binary>>, records binary, times binary"""
_RUNS = "run long, radix int, pairs binary, n binary"
_COUNTS = "run long, radix int, counts binary, best binary"


def pack(x: np.ndarray) -> bytes:
    """Numbers from 0 in the narrowest type, compressed."""
    kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype("u1")
    return bytes([kind.itemsize]) + zstandard.compress(x.astype(kind).tobytes(), 1)


def unpack(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x[1:]), f"<u{x[0]}").astype(np.int64)


def steps(pairs: np.ndarray) -> bytes:
    """Rising numbers by their differences."""
    return pack(np.diff(pairs, prepend=0))


def segments(text: str, size: int) -> Iterator[str]:
    """A text cut at such spaces into parts of about `size` characters."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Sides:
    """Both tokenizers, the bytes of their tokens, and the ids as they are written between marks."""

    def __init__(self, path_a: str, path_b: str, ranks_a: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.quick = self._quick(ranks_a) if ranks_a else None
        letter = byte_of_letter()
        vocab = self.a.get_vocab()
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            bytes_a[k] = bytes(letter[c] for c in token)
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(names)]
        self.bytes = [pa.array(x, pa.large_binary()) for x in (bytes_a, bytes_b)]
        self.size = [np.array([*map(len, x)], np.int64) for x in (bytes_a, bytes_b)]
        # an id and what follows it: another of its side, the other side, the next group, or nothing
        self.second = 4 * len(bytes_a)
        self.written = pa.array([f"{k}{m}" for n in (len(bytes_a), len(bytes_b)) for k in range(n) for m in (",", "|", ";", "")], pa.large_string())

    @staticmethod
    def _quick(path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(x): int(k) for x, k in map(bytes.split, f)}
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[list[int]]]:
        """Ids of both sides. The first has a space put before each text, the second puts one there."""
        if self.quick:
            first = [self.quick.encode_ordinary(" " + t) if not _LONG_RUN.search(t) else self.a.encode(" " + t, add_special_tokens=False).ids for t in texts]
        else:
            first = [x.ids for x in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return [first, self.b.encode(texts, num_threads=1)]

    def spelt(self, side: int, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens, joined."""
        return joined(self.bytes[side], ids)[0]


@lru_cache(1)
def sides(path_a: str | None, path_b: str | None) -> Sides:
    """Without paths the tokenizers are looked for on the machine that encodes."""
    ranks = None
    if path_a is None or path_b is None:
        import public_tokenizers

        ranks = public_tokenizers.path(RANKS_A) if path_a is None else None
        path_a, path_b = path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)
    return Sides(path_a, path_b, ranks)


def joined(words: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words[at], one after the other, and where each begins and the last ends."""
    got = words.take(pa.array(at))
    _, offsets, data = got.buffers()
    if not len(got):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[got.offset : got.offset + len(got) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8), offsets - offsets[0]


class Batch:
    """Documents of a batch."""

    def __init__(self, by: Sides):
        self.by, self.ids, self.size = by, [], 0
        self.waiting: list[tuple[int, str]] = []
        self.held = 0
        #: Of each side: ids and the documents they are of, in parts.
        self.tokens: list[list[np.ndarray]] = [[], []]
        self.docs: list[list[np.ndarray]] = [[], []]
        self.bad: set[int] = set()

    def add(self, doc_id: int | None, text: str | None) -> None:
        self.ids.append(doc_id)
        for part in segments(text, SEGMENT_CHARS) if text else ():
            self.waiting.append((len(self.ids) - 1, part))
            self.held += len(part)
            self.size += len(part)
            if self.held >= SEGMENT_CHARS:
                self.drain()

    def drain(self) -> None:
        """Encode what waits. A document of which a side spells other bytes than its text is bad."""
        of, texts = [d for d, _ in self.waiting], [t for _, t in self.waiting]
        whole = [(" " + t).encode() for t in texts]
        ends = np.cumsum([0, *map(len, whole)])
        text = np.frombuffer(b"".join(whole), np.uint8)
        for side, ids in enumerate(self.by.encode(texts) if texts else ()):
            n = [*map(len, ids)]
            flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(n))
            lengths = self.by.size[side][flat]
            spelt, cuts = self.by.spelt(side, flat), np.cumsum([0, *n])
            upto = np.concatenate([[0], np.cumsum(lengths)])[cuts]
            if len(spelt) != len(text) or (upto != ends).any() or (spelt != text).any():
                self.bad |= {d for k, d in enumerate(of) if not np.array_equal(spelt[upto[k] : upto[k + 1]], text[ends[k] : ends[k + 1]])}
            self.tokens[side].append(flat)
            self.docs[side].append(np.repeat(np.array(of, np.int64), n))
        self.waiting, self.held = [], 0

    def row(self, batch: int) -> tuple:
        """As in BATCHES."""
        self.drain()
        docs = len(self.ids)
        good = np.ones(docs, bool)
        good[list(self.bad)] = False
        token, doc, end = [], [], []
        for side in (0, 1):
            t, d = (np.concatenate([np.zeros(0, np.int64), *x[side]]) for x in (self.tokens, self.docs))
            t, d = t[good[d]], d[good[d]]
            token.append(t)
            doc.append(d)
            end.append(np.cumsum(self.by.size[side][t]))
        # offsets where tokens of both sides end, and the group of each token
        both = np.zeros(int(end[0][-1]) + 1 if len(end[0]) else 1, np.int64)
        both[end[0]] = 1
        common = end[1][both[end[1]] == 1]
        both[:] = 0
        both[common] = 1
        before = np.cumsum(both) - both
        group = [before[e] for e in end]
        n = [np.bincount(g, minlength=len(common)) for g in group]
        of = doc[1][both[end[1]] == 1]  # the document of each group
        sums = np.zeros((4, docs), np.int64)
        for k, x in enumerate((n[0], n[1], np.ones(len(common), np.int64), n[0] * n[1])):
            np.add.at(sums[k], of, x)
        keys, times = self._records(token, group, n, of)
        entry = np.flatnonzero(np.diff(keys >> DOC_BITS, prepend=-1))
        pairs = keys[entry] >> DOC_BITS
        held = np.diff(np.append(entry, len(keys)))
        radix, pairs = pairs >> (2 * SIDE_BITS), pairs & ((1 << (2 * SIDE_BITS)) - 1)
        cuts = np.flatnonzero(np.diff(radix, prepend=-1))
        runs = [{"radix": int(radix[i]), "pairs": steps(pairs[i:j]), "n": pack(held[i:j])} for i, j in zip(cuts, [*cuts[1:], len(radix)])]
        return batch, self.ids, pack(sums.ravel()), self._digests(token, group, n, of, docs), runs, pack(keys & ((1 << DOC_BITS) - 1)), pack(times)

    @staticmethod
    def _records(token: list, group: list, n: list, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different (radix, pair, document), sorted, and how often each is linked."""
        large = n[0] * n[1] > GROUP_LINKS
        each = np.where(large, 0, n[1])[group[0]]
        first = np.repeat(token[0], each)
        start = (np.cumsum(n[1]) - n[1])[group[0]]
        second = token[1][np.repeat(start - (np.cumsum(each) - each), each) + np.arange(len(first))]
        keys = key_of(first, second, np.repeat(of[group[0]], each))
        keys.sort()
        cut = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, times = keys[cut], np.diff(np.append(cut, len(keys)))
        if large.any():  # all pairs of the different ids of both sides
            more: Counter[int] = Counter()
            for g in np.flatnonzero(large):
                (x, p), (y, q) = (np.unique(t[np.searchsorted(s, g) : np.searchsorted(s, g, "right")], return_counts=True) for t, s in zip(token, group))
                for a, c in zip(x, p):
                    more.update(dict(zip(key_of(np.full(len(y), a), y, np.full(len(y), of[g])).tolist(), (c * q).tolist())))
            keys = np.concatenate([keys, np.fromiter(more.keys(), np.int64, len(more))])
            times = np.concatenate([times, np.fromiter(more.values(), np.int64, len(more))])
            keys, back = np.unique(keys, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, back, times)
            times = total
        return keys, times

    def _digests(self, token: list, group: list, n: list, of: np.ndarray, docs: int) -> list[str]:
        """SHA-256 of each document's groups as text."""
        total = len(token[0]) + len(token[1])
        code = np.zeros(total, np.int64)
        start = [np.cumsum(x) - x for x in n]
        last_of_doc = np.append(of[1:] != of[:-1], True) if len(of) else np.zeros(0, bool)
        for side in (0, 1):
            g = group[side]
            inner = np.arange(len(g)) - start[side][g]
            at_side = start[0][g] + start[1][g] + inner + (n[0][g] if side else 0)
            last = inner == n[side][g] - 1
            mark = np.where(last, (1 if side == 0 else np.where(last_of_doc[g], 3, 2)), 0)
            code[at_side] = side * self.by.second + 4 * token[side] + mark
        text, offsets = joined(self.by.written, code)
        size = np.bincount(of, weights=n[0] + n[1], minlength=docs).astype(np.int64) if len(of) else np.zeros(docs, np.int64)
        upto = np.concatenate([[0], np.cumsum(size)])
        text = text.tobytes()
        return [hashlib.sha256(text[offsets[i] : offsets[j]]).hexdigest() if j > i else "" for i, j in zip(upto[:-1], upto[1:])]


def key_of(first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return ((((radix_of(first) << SIDE_BITS) | first) << SIDE_BITS | second) << DOC_BITS) | doc


def radix_of(first: np.ndarray) -> np.ndarray:
    return ((first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % RADICES


def _table(rows: list[tuple], like: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
             "array<struct<radix: int, pairs: binary, n: binary>>": pa.list_(pa.struct([("radix", pa.int32()), ("pairs", pa.binary()), ("n", pa.binary())]))}
    fields = [f.strip().split(" ", 1) for f in re.split(r", (?![^<]*>)", like)]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def batches_of(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """documents -> BATCHES."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = sides(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        now = Batch(by)
        for b in arrow:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                now.add(doc_id, text)
                if now.size >= BATCH_CHARS or len(now.ids) >= BATCH_DOCS:
                    yield _table([now.row(number)], BATCHES)
                    number, now = number + 1, Batch(by)
        if now.ids:
            yield _table([now.row(number)], BATCHES)
        give_back()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, BATCHES)


def _groups(arrow: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows sorted by keys, a group at a time."""
    rows = (dict(zip(b.schema.names, r)) for b in arrow for r in zip(*(c.to_pylist() for c in b.columns)))
    return groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def merged(runs: DataFrame, groups: int) -> DataFrame:
    """Runs of each radix merged by a k-way heap into one for each of so many groups."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (into, radix), rows in _groups(arrow, ["into", "radix"]):
            opened = [zip(np.cumsum(unpack(r["pairs"])).tolist(), unpack(r["n"]).tolist()) for r in rows]
            pairs, counts, last = [], [], -1
            for pair, n in heapq.merge(*opened):
                if pair == last:
                    counts[-1] += n
                else:
                    pairs.append(pair)
                    counts.append(n)
                    last = pair
            yield _table([(into, radix, steps(np.array(pairs, np.int64)), pack(np.array(counts, np.int64)))], _RUNS)
        give_back()

    dealt = runs.withColumn("into", into_of(groups)).repartition("into", "radix").sortWithinPartitions("into", "radix")
    return dealt.mapInArrow(run, _RUNS)


def into_of(groups: int):
    return F.pmod(F.xxhash64("run"), F.lit(groups).cast("long"))


def counted(top: DataFrame) -> DataFrame:
    """The one run of each radix -> run, radix, pairs, counts, best: whether a pair's count is its first side's highest."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow:
            for r in b.to_pylist():
                pairs, counts = np.cumsum(unpack(r["pairs"])), unpack(r["n"])
                starts = np.flatnonzero(np.diff(pairs >> SIDE_BITS, prepend=-1))
                highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(pairs))))
                yield _table([(r["run"], r["radix"], r["pairs"], r["n"], pack((counts == highest).astype(np.int64)))], f"{_RUNS}, best binary")
        give_back()

    return top.mapInArrow(run, f"{_RUNS}, best binary").withColumnRenamed("n", "counts")


def handed_down(runs: DataFrame, above: DataFrame, groups: int) -> DataFrame:
    """The counts of each run's own pairs, from the runs they were merged into."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow:
            for r in b.to_pylist():
                at = np.searchsorted(np.cumsum(unpack(r["all_pairs"])), np.cumsum(unpack(r["pairs"])))
                yield _table([(r["run"], r["radix"], r["pairs"], pack(unpack(r["counts"])[at]), pack(unpack(r["best"])[at]))], "run long, radix int, pairs binary, counts binary, best binary")
        give_back()

    up = above.select(F.col("run").alias("into"), "radix", F.col("pairs").alias("all_pairs"), "counts", "best")
    met = runs.select("run", "radix", "pairs", into_of(groups).alias("into")).join(up, ["into", "radix"])
    return met.mapInArrow(run, "run long, radix int, pairs binary, counts binary, best binary")


def scored(batches: DataFrame, counts: DataFrame) -> DataFrame:
    """Batches and the counts of their pairs -> a row for each document."""
    ddl = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow:
            for r in b.to_pylist():
                docs = len(r["doc_ids"])
                sums = unpack(r["sums"]).reshape(4, docs)
                of, times = unpack(r["records"]), unpack(r["times"])
                n, seen, best = ([unpack(x) for x in c] for c in ([x["n"] for x in r["runs"]], [x["counts"] for x in r["found"] or []], [x["best"] for x in r["found"] or []]))
                each = np.concatenate(n or [np.zeros(0, np.int64)])
                count, top = (np.repeat(np.concatenate(x or [np.zeros(0, np.int64)]), each) for x in (seen, best))
                n_best, count_sum = np.zeros((2, docs), np.int64)
                np.add.at(n_best, of, times * top)
                np.add.at(count_sum, of, times * count)
                yield _table(list(zip(r["doc_ids"], *sums.tolist(), n_best.tolist(), count_sum.tolist(), r["digests"])), ddl)
        give_back()

    # a batch has a row for each radix at most
    found = counts.groupBy(F.col("run").alias("batch")).agg(F.sort_array(F.collect_list(F.struct("radix", "counts", "best"))).alias("found"))
    own = batches.select("batch", "doc_ids", "sums", "digests", F.transform("runs", lambda x: F.struct(x["n"].alias("n"))).alias("runs"), "records", "times")
    return own.join(found, "batch", "left").mapInArrow(run, ddl)


def align(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> tuple[DataFrame, DataFrame]:
    """documents -> the columns of RESULT; and all pairs: a_id, b_id, n_docs, best."""
    spark = documents.sparkSession
    with small_batches(spark, 256):
        batches = stash(batches_of(documents, path_a, path_b), "batches")
    with small_batches(spark, ROWS):
        first = batches.select(F.col("batch").alias("run"), F.explode("runs").alias("r")).select("run", "r.*")
        levels, n = [(first, 0)], batches.count()
        while n > 1 or len(levels) == 1:
            n = -(-n // FAN) or 1
            levels.append((stash(merged(levels[-1][0], n), "runs"), n))
        top = stash(counted(levels[-1][0]), "counted")
        counts = top
        for k in range(len(levels) - 2, -1, -1):
            counts = stash(handed_down(levels[k][0], counts, levels[k + 1][1]), "counts", (counts,) if counts is not top else ())
        rows = stash(scored(batches, counts), "aligned", (batches, counts, *(x for x, _ in levels[1:])))
    return rows.select(*RESULT), pair_table(top)


def pair_table(top: DataFrame) -> DataFrame:
    """Counted runs -> a_id, b_id, n_docs, best."""
    ddl = "a_id long, b_id long, n_docs long, best boolean"

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow:
            for r in b.to_pylist():
                pairs = np.cumsum(unpack(r["pairs"]))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pairs >> SIDE_BITS, pairs & ((1 << SIDE_BITS) - 1), unpack(r["counts"]), unpack(r["best"]) == 1)], ["a_id", "b_id", "n_docs", "best"])

    return top.mapInArrow(run, ddl)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align(read(spark, sf_dir, "documents"))[0]
