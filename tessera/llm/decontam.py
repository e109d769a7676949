"""Benchmark decontamination: BM25 inverted index of the items with block-max WAND, then overlap checks.

Items are put in classes by length; a class of items of up to L words is searched with passages of 2 L words that begin
every L words, so an item lies whole in at least one passage. BM25 scores count each word of a passage once and are
divided by the item's score against itself. As in block-max WAND, a passage is dropped when the maxima of its words
cannot reach MIN_SCORE, then blocks of items are dropped by their own maxima, and only what is left is scored. All items at
MIN_SCORE or above are retrieved, then checked: a leak holds MIN_OVERLAP of the question's words and MIN_ANSWER of the
answer's, and MIN_OVERLAP of the item's five-word shingles. With `edited` these overlaps may instead hold in order, by
longest common subsequences, so that items with single words changed are leaks too; op10 and the pipeline ask for that. An item's last sentence is its answer and the rest the
question; an item of one sentence has its last third as answer.

The index is collected and broadcast in shards of at most MAX_POSTINGS postings by count (an item larger than that is
a shard of its own), one at a time in the driver; beyond one shard the documents are scanned once a shard.

Defined results: null or empty texts hold and are no leaks; an item with a null item_id is searched for like any other and
reported with a null; an item of fewer than five words is one shingle; repeated items are reported each, repeated documents likewise; empty tables give an empty result. Of documents only doc_id and
text are read, of items item_id and text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, read, stash

K1, B = 1.2, 0.75
MIN_SCORE, MIN_OVERLAP, MIN_ANSWER = 0.6, 0.8, 0.5
SHINGLE_WORDS, BLOCK_ITEMS, LEAST_CLASS = 5, 16, 32
MAX_POSTINGS = 500_000
LEAK_FIELDS = ["item_id", "bm25", "item_overlap", "question_overlap", "answer_overlap", "first_word"]
LEAK = "array<struct<item_id:bigint,bm25:double,item_overlap:double,question_overlap:double,answer_overlap:double,first_word:bigint>>"
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def question_answer(text: str) -> tuple[list[str], list[str]]:
    parts = [w for s in _SENTENCE.split(text) if (w := words_of(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = words_of(text)
    at = len(words) - max(1, len(words) // 3)
    return words[:at], words[at:]


def shingles(words: list[str], k: int = SHINGLE_WORDS) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def common_in_order(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence; a row of the table is the bits of a number."""
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    every = (1 << len(a)) - 1
    row = every
    for w in b:
        if met := row & places.get(w, 0):
            row = (row + met | row - met) & every
    return len(a) - row.bit_count()


def holds_in_order(question: list[str], answer: list[str], passage: list[str]) -> bool:
    """Whether the passage holds MIN_OVERLAP of the question and MIN_ANSWER of the answer in order, the one before the other."""
    least = MIN_OVERLAP * len(question), MIN_ANSWER * len(answer)
    return (common_in_order(question, passage) >= least[0] and common_in_order(answer, passage) >= least[1]
            and common_in_order(question + answer, passage) >= sum(least))


class Index:
    """Inverted index of one length class of items, with the maxima that block-max WAND needs."""

    def __init__(self, length: int, items: pd.DataFrame, postings: pd.DataFrame):
        self.length = length
        self.items = items.sort_values("item_no").reset_index(drop=True)
        place = dict(zip(self.items["item_no"], range(len(self.items))))
        p = postings.assign(place=postings["item_no"].map(place)).sort_values(["term", "place"])
        terms, first = np.unique(p["term"].to_numpy(object), return_index=True)
        self.terms = dict(zip(terms.tolist(), range(len(terms))))
        self.first = np.append(first, len(p))
        self.place, self.impact = p["place"].to_numpy(np.int64), p["impact"].to_numpy(float)
        self.most = np.maximum.reduceat(self.impact, first) if len(p) else np.zeros(0)
        # block maxima of each term, in the order of its postings
        block = self.place // BLOCK_ITEMS
        new = np.ones(len(p), bool)
        new[1:] = (block[1:] != block[:-1]) | (np.isin(np.arange(1, len(p)), first))
        at = np.flatnonzero(new)
        self.block, self.block_most = block[at], np.maximum.reduceat(self.impact, at) if len(p) else np.zeros(0)
        self.block_first = np.searchsorted(at, self.first)
        self.n_blocks = -(-len(self.items) // BLOCK_ITEMS)
        self.texts = [(question_answer(t), words_of(t)) for t in self.items["text"]]
        self.shingles = [shingles(w) for _, w in self.texts]

    def _spread(self, first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = first[terms + 1] - first[terms]
        return np.repeat(first[terms] - np.cumsum(size) + size, size) + np.arange(size.sum()), size

    def retrieve(self, ids: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(text, first word of the passage, item, score) of every score of MIN_SCORE or more.

        ids are this index's term numbers, -1 for others, of texts of the given sizes one after the other.
        """
        length, n_terms, least = self.length, len(self.most), MIN_SCORE - 1e-9
        n_pass = np.maximum(1, -(-(sizes - length) // length))
        first_pass = np.cumsum(n_pass) - n_pass
        text = np.repeat(np.arange(len(sizes)), sizes)
        step = (np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // length
        # a word lies in the passage that begins in its step and in the one before
        here, before = step < n_pass[text], step > 0
        known = ids >= 0
        a, b = known & here, known & before
        w = np.concatenate([first_pass[text[a]] + step[a], first_pass[text[b]] + step[b] - 1])
        t = np.concatenate([ids[a], ids[b]])
        total = int(n_pass.sum())
        ok = (np.bincount(w, self.most[t], total) >= least)[w]
        if not ok.any():
            return
        w, t = np.divmod(np.unique(w[ok] * n_terms + t[ok]), n_terms)  # each word of a passage once
        ok = (np.bincount(w, self.most[t], total) >= least)[w]
        w, t = w[ok], t[ok]
        if not len(w):
            return
        names, w = np.unique(w, return_inverse=True)
        at, size = self._spread(self.block_first, t)
        bound = np.bincount(np.repeat(w, size) * self.n_blocks + self.block[at], self.block_most[at], len(names) * self.n_blocks)
        good = bound.reshape(len(names), self.n_blocks) >= least
        ok = good.any(axis=1)[w]
        w, t = w[ok], t[ok]
        at, size = self._spread(self.first, t)
        w = np.repeat(w, size)
        ok = good[w, self.place[at] // BLOCK_ITEMS]
        w, at = w[ok], at[ok]
        pair, back = np.unique(w * len(self.items) + self.place[at], return_inverse=True)
        score = np.bincount(back, self.impact[at])
        for k in np.flatnonzero(score >= least):
            p, i = divmod(int(pair[k]), len(self.items))
            p = int(names[p])
            x = int(np.searchsorted(first_pass, p, "right")) - 1
            yield x, (p - int(first_pass[x])) * length, i, float(score[k])

    def leaks(self, texts: list[list[str]], ids: np.ndarray, sizes: np.ndarray, edited: bool = False) -> Iterator[tuple]:
        """(text, leak) of each item that a text holds, its best passage."""
        best: dict[tuple[int, int], tuple] = {}
        for x, start, i, score in self.retrieve(ids, sizes):
            passage = texts[x][start : start + 2 * self.length]
            own, had = self.shingles[i], set(passage)
            k = min(SHINGLE_WORDS, len(self.texts[i][1]))
            overlap = len(own & shingles(passage, k)) / len(own)
            (question, answer), _ = self.texts[i]
            q, a = (sum(w in had for w in y) / len(y) if y else 1.0 for y in (question, answer))
            if q < MIN_OVERLAP or a < MIN_ANSWER or overlap <= best.get((x, i), (0, 0, -1))[2]:
                continue
            if overlap >= MIN_OVERLAP or edited and holds_in_order(question, answer, passage):
                name = self.items["item_id"][i]
                best[x, i] = (None if name is None else int(name), score, overlap, q, a, start)
        for (x, _), leak in best.items():
            yield x, leak


class Finder:
    """Finds leaks of a shard's indexes, many texts at a time; words are numbered once for all length classes."""

    def __init__(self, shard: list[Index]):
        self.shard = shard
        self.numbers = {w: k for k, w in enumerate({w for index in shard for w in index.terms})}
        self.tables = []
        for index in shard:
            table = np.full(len(self.numbers) + 1, -1)  # the last for words of no index
            for w, k in index.terms.items():
                table[self.numbers[w]] = k
            self.tables.append(table)

    def find(self, texts: list[str | None], edited: bool = False) -> list[list[dict]]:
        words = [words_of(t) for t in texts]
        sizes = np.array([len(x) for x in words], np.int64)
        get, none = self.numbers.get, repeat(len(self.numbers))
        ids = np.fromiter(chain.from_iterable(map(get, x, none) for x in words), np.int64, int(sizes.sum()))
        out: list[list[dict]] = [[] for _ in texts]
        for index, table in zip(self.shard, self.tables):
            for x, leak in index.leaks(words, table[ids], sizes, edited):
                out[x].append(dict(zip(LEAK_FIELDS, leak)))
        return out


def build(items: DataFrame) -> Iterator[list[Index]]:
    """Shards of the items' index, one at a time; each shard is a list of length classes."""

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(n, w, len(words)) for n, t in zip(b["item_no"], b["text"]) for words in [words_of(t)] for w in words]
            yield pd.DataFrame(rows, columns=["item_no", "term", "length"])

    # a name of its own for each row, as item ids may repeat
    # ids as text, as pandas has no null among whole numbers
    named = stash(items.filter("text IS NOT NULL").select(
        F.monotonically_increasing_id().alias("item_no"), F.col("item_id").cast("long").cast("string").alias("item_id"), "text"), "items")
    terms = named.select("item_no", "text").mapInPandas(tokens, "item_no long, term string, length long")
    tf = stash(terms.groupBy("item_no", "term").agg(F.count("*").alias("tf"), F.first("length").alias("length")), "tf")
    per_item = tf.groupBy("item_no").agg(F.first("length").alias("length"), F.count("*").alias("terms"))
    n, mean, total = per_item.agg(F.count("*"), F.avg("length"), F.sum("terms")).first()
    if not n:
        return
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / mean))
    scored = tf.join(df, "term").withColumn("impact", impact)
    whole = scored.groupBy("item_no").agg(F.sum("impact").alias("whole"))
    n_shards = -(-total // MAX_POSTINGS)
    shard = F.pmod(F.xxhash64("item_no"), F.lit(n_shards))
    scored = stash(scored.join(whole, "item_no").select("item_no", "term", "length", (F.col("impact") / F.col("whole")).alias("impact"), shard.alias("shard")), "postings")
    for k in range(n_shards):
        p = scored.filter(F.col("shard") == k).toPandas()
        t = named.filter(shard == k).toPandas()
        if len(p):
            level = np.ceil(np.log2(np.maximum(p["length"] / LEAST_CLASS, 1))).astype(int)
            yield [Index(LEAST_CLASS << x, t[t["item_no"].isin(p["item_no"][level == x])], p[level == x]) for x in sorted(set(level))]


def leak_finder(spark, shard: list[Index], edited: bool):
    """A function of a text column to its leaks."""
    model = spark.sparkContext.broadcast(shard)

    @F.pandas_udf(LEAK)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(model.value)
        for b in batches:
            yield pd.Series([x for at in range(0, len(b), 32) for x in finder.find(b.iloc[at : at + 32].tolist(), edited)], dtype=object)
            del b
            give_back()

    return find


def find_leaks(documents: DataFrame, items: DataFrame, edited: bool = False) -> DataFrame:
    """One row for each document and item it leaks: doc_id, item_id, bm25, overlaps, first_word of the passage."""
    spark, found = documents.sparkSession, None
    for shard in build(items):
        part = documents.select("doc_id", leak_finder(spark, shard, edited)(F.col("text")).alias("leak"))
        part = part.select("doc_id", F.inline("leak"))
        found = part if found is None else found.unionByName(part)
    return found if found is not None else documents.limit(0).select("doc_id", F.inline(F.array().cast(LEAK)))


def drop_leaks(documents: DataFrame, items: DataFrame, edited: bool = False) -> DataFrame:
    """documents that leak no item, all columns kept."""
    for shard in build(items):
        leaks = leak_finder(documents.sparkSession, shard, edited)(F.col("text"))
        rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"), leaks.alias("leaks"))
        documents = rows.filter("size(leaks) = 0").select("row.*")
    return documents


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), edited=True)
