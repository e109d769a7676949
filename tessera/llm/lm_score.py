"""Stupid-backoff language-model scores, computed relationally.

Counts are those of all other documents (leave one out): S(w | v) is c(v w) / c(v) if other documents have v w,
else ALPHA times S(w) = c(w) / N, and ALPHA / (N + 1) more for a word that no other document has; so on for longer
n-grams. A document's score is the sum of its words' natural logarithms.

Documents are packed in batches of bounded size, a row each. A batch explodes into its different n-grams with counts,
as hashes of HASH_BITS bits, sorted, delta coded and cut by hash range: rows (part, batch). Each part sums counts over
all batches and answers each batch with the totals of those n-grams that others have too. The answers are joined to the
batches, which score their documents. A frequent n-gram is one entry a batch, so no key is hot, and nothing but sums
passes the driver. HASH_BITS bits make two n-grams of a corpus of 10**13 words clash once in thousands.

Words are split at ASCII white space, A-Z lower-cased. ORDER is 3 here; it is a parameter.

Defined results: null, empty or blank texts have 0 words and score 0; repeated rows are documents each, so see each other's
counts; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import read, stash

ORDER, ALPHA, HASH_BITS = 3, 0.4, 56
BATCH_BYTES, BATCH_DOCS = 4 << 20, 10_000
#: Entries that a part of the hash range holds, about.
PART_ENTRIES = 2_000_000
CACHE_WORDS = 200_000
_ZSTD = "zstd"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word, 1)
        return h


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted integers as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), _ZSTD, asbytes=True)


def unpack_sorted(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 8 * n, _ZSTD), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_ints(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<u4").tobytes(), _ZSTD, asbytes=True)


def unpack_ints(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(blob, 4 * n, _ZSTD), "<u4").astype(np.int64)


def batches_of(documents: DataFrame) -> DataFrame:
    """documents -> batch, docs: rows of up to BATCH_BYTES of text (a longer document is a batch of its own)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, k, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def row() -> pa.RecordBatch:
            out = io.BytesIO()
            table = pa.Table.from_batches(held)
            with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=_ZSTD)) as w:
                w.write_table(table.combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([base + k]), pa.array([out.getvalue()], pa.binary())], ["batch", "docs"])

        for b in found:
            sizes = np.cumsum([len(x) if x is not None else 0 for x in b["text"].to_pylist()])
            at = 0
            while at < len(b):
                room = BATCH_BYTES - size + (sizes[at - 1] if at else 0)
                to = min(int(np.searchsorted(sizes, room, "right")), at + BATCH_DOCS, len(b))
                if to <= at and not held:
                    to = at + 1
                if to > at:
                    held.append(b.slice(at, to - at))
                    size += int(sizes[to - 1] - (sizes[at - 1] if at else 0))
                at = max(at, to)
                if at < len(b) or sum(map(len, held)) >= BATCH_DOCS:
                    yield row()
                    k, held, size = k + 1, [], 0
        if held:
            yield row()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "batch long, docs binary")


class Batch:
    """The n-grams of a batch: for each order, the index of each word's n-gram among the batch's sorted hashes."""

    def __init__(self, docs: bytes, order: int, words: WordHashes):
        if len(words) > CACHE_WORDS:
            words.clear()
        table = pa.ipc.open_stream(docs).read_all()
        self.doc_id = table["doc_id"]
        split = [(t.as_py() or b"").lower().split() for c in table["text"].chunks for t in c]
        self.size = np.array([len(x) for x in split], np.int64)
        self.first = np.cumsum(self.size) - self.size
        h = np.fromiter((words[w] for x in split for w in x), np.uint64, int(self.size.sum()))
        self.doc = np.repeat(np.arange(len(split)), self.size)
        place = np.arange(len(h)) - self.first[self.doc]
        grams, self.at, gram = [], [], h
        for n in range(1, order + 1):
            if n > 1:  # hash of a longer n-gram from that of the shorter one before and the word
                before = np.concatenate([np.zeros(1, np.uint64), gram[:-1]])[: len(h)]
                gram = (before * np.uint64(0x9E3779B97F4A7C15) ^ h) * np.uint64(0xC2B2AE3D27D4EB4F)
                gram ^= gram >> np.uint64(31)
            self.at.append(np.flatnonzero(place >= n - 1))
            grams.append(gram[self.at[-1]] >> np.uint64(64 - HASH_BITS))
        self.hashes, inverse, self.count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
        self.index = np.split(inverse, np.cumsum([len(x) for x in self.at])[:-1])

    def scores(self, total: np.ndarray, n_all: int) -> np.ndarray:
        """Sum of log scores of each document, by the corpus's counts of the batch's n-grams and its number of words."""
        others = []
        for n, (at, index) in enumerate(zip(self.at, self.index)):
            key = self.doc[at] * len(self.hashes) + index
            _, back, own = np.unique(key, return_inverse=True, return_counts=True)
            c = np.zeros(len(self.doc), np.int64)
            c[at] = total[index] - own[back]
            others.append(c)
        left = n_all - self.size[self.doc]
        log = np.log(np.maximum(others[0], 1)) - np.log(np.maximum(left, 1))
        log = np.where(others[0] > 0, log, math.log(ALPHA) - np.log(left + 1.0))
        place = np.arange(len(self.doc)) - self.first[self.doc]
        for n in range(2, len(others) + 1):
            # what came before, counted in other documents; at least as often as the whole
            before = np.concatenate([[1], others[n - 2][:-1]])[: len(self.doc)]
            own = np.log(np.maximum(others[n - 1], 1)) - np.log(np.maximum(before, 1))
            log = np.where(place < n - 1, log, np.where(others[n - 1] > 0, own, math.log(ALPHA) + log))
        out = np.zeros(len(self.size))
        np.add.at(out, self.doc, log)
        return out


def exploded(packed: DataFrame, order: int, parts: int) -> DataFrame:
    """Batches -> rows (part, batch): the batch's n-grams of a part of the hash range, sorted, with their counts.

    Only parts that hold n-grams are rows, and the first, which tells the batch's words; so rows never outnumber the
    n-grams by more than the batches.
    """

    def explode(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for row in ((i, d) for b in found for i, d in zip(b["batch"].to_pylist(), b["docs"])):
            batch = Batch(row[1].as_py(), order, words)
            edges = np.searchsorted(batch.hashes, (np.arange(1, parts, dtype=object) * (1 << HASH_BITS) // parts).astype(np.uint64))
            cut = np.concatenate([[0], edges, [len(batch.hashes)]])
            some = np.flatnonzero((np.diff(cut) > 0) | (np.arange(parts) == 0))
            out = [(p, row[0], int(cut[p + 1] - cut[p]), int(batch.size.sum()) if p == 0 else 0, pack_sorted(batch.hashes[cut[p] : cut[p + 1]]), pack_ints(batch.count[cut[p] : cut[p + 1]])) for p in some]
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:4]), *(pa.array(c, pa.binary()) for c in cols[4:])],
                                             ["part", "batch", "n", "words", "hashes", "counts"])

    return packed.mapInArrow(explode, "part int, batch long, n long, words long, hashes binary, counts binary")


def score_documents(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """documents -> doc_id, n_words, score, score_per_word (null without words)."""
    packed = stash(batches_of(documents), "lm_batches")
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size * order // (6 * PART_ENTRIES)))

    def answer(group: pa.Table) -> pa.Table:
        sizes = group["n"].to_pylist()
        h = np.concatenate([unpack_sorted(b.as_py(), n) for b, n in zip(group["hashes"], sizes)])
        c = np.concatenate([unpack_ints(b.as_py(), n) for b, n in zip(group["counts"], sizes)])
        order_ = np.argsort(h)
        new = np.ones(len(h), bool)
        new[1:] = h[order_][1:] != h[order_][:-1]
        if len(h):
            sums = np.add.reduceat(c[order_], np.flatnonzero(new))
            extra = np.empty(len(h), np.int64)
            extra[order_] = sums[np.cumsum(new) - 1]
            extra -= c
        else:
            extra = c
        ends = np.cumsum(sizes)
        blobs = [pack_ints(extra[e - n : e]) for e, n in zip(ends, sizes)]
        return pa.table({"part": group["part"], "batch": group["batch"], "n": group["n"], "words": group["words"], "extra": pa.array(blobs, pa.binary())})

    entries = exploded(packed, order, parts)
    answers = stash(entries.groupBy("part").applyInArrow(answer, "part int, batch long, n long, words long, extra binary"), "lm_answers")
    n_all = answers.agg(F.sum("words")).first()[0] or 0

    def score(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, extra = WordHashes(), []
        for b in found:
            for part, n, blob in zip(b["part"].to_pylist(), b["n"].to_pylist(), b["blob"]):
                if part < parts:
                    extra.append(unpack_ints(blob.as_py(), n))
                    continue
                batch = Batch(blob.as_py(), order, words)
                total = batch.count + np.concatenate(extra)
                extra = []
                sums = batch.scores(total, n_all)
                per = np.where(batch.size > 0, sums / np.maximum(batch.size, 1), np.nan)
                yield pa.RecordBatch.from_arrays([batch.doc_id.combine_chunks(), pa.array(batch.size), pa.array(sums), pa.array(per, mask=batch.size == 0)], ["doc_id", "n_words", "score", "score_per_word"])

    # a batch's answers in order of parts, then its documents
    rows = answers.select("batch", "part", "n", F.col("extra").alias("blob")).unionByName(
        packed.select("batch", F.lit(parts).alias("part"), F.lit(0).cast("long").alias("n"), F.col("docs").alias("blob")))
    rows = rows.repartition("batch").sortWithinPartitions("batch", "part")
    return rows.mapInArrow(score, "doc_id long, n_words long, score double, score_per_word double")


def op6_lm_score(spark, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
