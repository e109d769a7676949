"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's character n-grams (3 to 5, with its two ends marked) are hashed into buckets that hold vectors. A window of
WINDOW words is the average of its n-grams' vectors, put through a linear softmax. A document is scored by its windows,
softmax-pooled at training so that few toxic words in a long text count, and by the highest window when scoring.
All windows of the whole text count. Misspellings share most n-grams with the words they were made from.

Training takes labelled documents whose crc32(doc_id as text) mod 5 is not 0 and that have up to TRAIN_LONGEST characters,
of each label up to TRAIN_CHARS characters of text in expectation (chosen by hash), so the sample, which is trained on
the driver, is bounded. Gradients are added up over blocks of documents, so what an epoch holds does not grow with it.

Defined results: null, empty and blank texts score by the bias alone; repeated rows score alike; repeated label rows
count once each; null labels are not learnt from; without both labels every score is the share of toxic labels (0 with
no labels); an empty table gives an empty result. Columns lang and source are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, read, sized_join, small_batches, stash

WINDOW, BUCKETS, DIM, GRAMS = 3, 1 << 16, 16, (3, 4, 5)
TRAIN_CHARS = {1: 4_000_000, 0: 6_000_000}
TRAIN_LONGEST = 1_000_000
EPOCHS, RATE, DECAY, SEED = 80, 0.1, 1e-4, 7
#: Tokens of a block of training documents, about, and words whose n-grams are hashed at once.
BLOCK_TOKENS, BLOCK_WORDS = 1 << 16, 10_000
#: Words whose features are remembered in a worker.
CACHE_WORDS = 200_000
#: Rows that go to Python at a time in the stage, whose rows are carried along.
BATCH_DOCS = 1536


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all words, and how many each word has. Words are UTF-8; n-grams are of bytes."""
    flat = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words])
    start = np.cumsum(size) - size
    at = np.arange(len(flat)) - np.repeat(start, size)
    left = np.repeat(size, size) - at
    index, bucket = [], []
    word = np.repeat(np.arange(len(words)), size)
    for n in GRAMS:
        ok = np.flatnonzero(left >= n)
        h = np.full(len(ok), n, np.uint64)
        for k in range(n):
            h = (h ^ flat[ok + k]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        index.append(word[ok])
        bucket.append((h % np.uint64(BUCKETS)).astype(np.int64))
    index, bucket = np.concatenate(index), np.concatenate(bucket)
    order = np.argsort(index, kind="stable")
    return bucket[order], np.bincount(index, minlength=len(words))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def add_gradient(per_word: np.ndarray, tokens: np.ndarray, size: np.ndarray, labels: np.ndarray, weight: np.ndarray,
                 of_word: np.ndarray, count: np.ndarray, sharp: float, bias: float) -> float:
    """Adds the gradient of a block of documents to that of each word's n-grams, and gives the bias's."""
    start = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
    first = np.maximum(np.arange(len(tokens)) - (WINDOW - 1), start[doc])  # a window ends at each token
    grams_to = np.concatenate([[0], np.cumsum(count[tokens])])
    width = np.maximum(grams_to[1:] - grams_to[first], 1)
    upto = np.concatenate([[0], np.cumsum(of_word[tokens])])
    z = (upto[1:] - upto[first]) / width
    a = np.exp(np.minimum(sharp * (z - np.maximum.reduceat(z, start)[doc]), 0))
    a /= np.add.reduceat(a, start)[doc]
    pooled = np.add.reduceat(a * z, start) + bias
    err = weight * (1 / (1 + np.exp(-pooled)) - labels)
    dz = err[doc] * a / width
    edge = np.bincount(first, dz, len(tokens) + 1)
    edge[1:] -= dz  # a window adds to its tokens, first to here
    per_word += np.bincount(tokens, np.cumsum(edge)[:-1], len(count))
    return float(err.sum())


def train(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of each bucket (its vector through the softmax, toxic less clean) and the bias. Full-batch Adagrad."""
    ids: dict[bytes, int] = {}
    docs = [np.array([ids.setdefault(w, len(ids)) for w in words_of(t)] or [ids.setdefault(b"", len(ids))], np.int32) for t in texts]
    words = list(ids)
    parts = [tuple(x.astype(np.int32) for x in word_grams(words[at : at + BLOCK_WORDS])) for at in range(0, len(words), BLOCK_WORDS)]
    del ids, words
    size = np.array([len(d) for d in docs])
    tokens = np.concatenate(docs)
    start = np.cumsum(size) - size
    blocks = np.searchsorted(np.cumsum(size), np.arange(BLOCK_TOKENS, len(tokens) + BLOCK_TOKENS, BLOCK_TOKENS))
    blocks = np.unique(np.concatenate([[0], np.minimum(blocks + 1, len(docs))]))
    del docs
    count = np.concatenate([n for _, n in parts])
    upto = np.cumsum([0] + [len(n) for _, n in parts])
    rng = np.random.default_rng(SEED)
    vec = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, DIM).astype(np.float32), 0.0
    g2v, g2o, g2b = np.full((BUCKETS, DIM), 1e-6, np.float32), np.full(DIM, 1e-6, np.float32), 1e-6
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    weight = (weight + 1) / 2 / len(labels)  # halfway to balanced
    for epoch in range(EPOCHS):
        sharp = 0.2 + 6 * epoch / EPOCHS
        score = vec @ out
        of_word = np.zeros(len(count))
        for at, (bucket, n) in zip(upto, parts):
            if (n > 0).any():
                of_word[at : at + len(n)][n > 0] = np.add.reduceat(score[bucket], (np.cumsum(n) - n)[n > 0])
        per_word, gb = np.zeros(len(count)), 0.0
        for i, j in zip(blocks[:-1], blocks[1:]):
            part = tokens[start[i] : start[i] + size[i:j].sum()]
            gb += add_gradient(per_word, part, size[i:j], labels[i:j], weight[i:j], of_word, count, sharp, bias)
        delta = np.zeros(BUCKETS)
        for at, (bucket, n) in zip(upto, parts):
            np.add.at(delta, bucket, np.repeat(per_word[at : at + len(n)], n))
        delta = delta.astype(np.float32)
        gv, go = np.outer(delta, out) + DECAY / len(labels) * vec, delta @ vec
        g2v, g2o, g2b = g2v + gv * gv, g2o + go * go, g2b + gb * gb
        vec -= RATE * gv / np.sqrt(g2v)
        out -= RATE * go / np.sqrt(g2o)
        bias -= RATE * gb / np.sqrt(g2b)
    return (vec @ out).astype(np.float64), float(bias)


class Scorer:
    """Scores texts with a trained model; remembers the words it has met."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.ids, self.score, self.grams = weights, bias, {}, np.zeros(0), np.zeros(0)

    def best(self, texts: list[bytes]) -> list[float]:
        """The highest window of each text, as a logit."""
        split = [words_of(t) for t in texts]
        if new := {w for words in split for w in words if w not in self.ids}:
            if len(self.ids) + len(new) > CACHE_WORDS:  # the memory is cleared, so all are new
                new = {w for words in split for w in words}
                self.ids = {}
                self.score, self.grams = np.zeros(0), np.zeros(0)
            new = list(new)
            for at in range(0, len(new), 50_000):
                bucket, count = word_grams(new[at : at + 50_000])
                upto, ends = np.concatenate([[0], np.cumsum(self.weights[bucket])]), np.cumsum(count)
                self.score = np.concatenate([self.score, upto[ends] - upto[ends - count]])
                self.grams = np.concatenate([self.grams, count])
            self.ids.update(zip(new, range(len(self.ids), len(self.ids) + len(new))))
        out = []
        for words in split:
            if not words:
                out.append(self.bias)
                continue
            at = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
            s, g = (np.concatenate([[0], np.cumsum(x[at])]) for x in (self.score, self.grams))
            end = np.arange(1, len(words) + 1)
            first = np.maximum(end - WINDOW, 0)
            out.append(float(((s[end] - s[first]) / np.maximum(g[end] - g[first], 1)).max()) + self.bias)
        return out


def calibrate(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels to documents' highest windows."""
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + c, -30, 30)))
        r, v = p - labels, p * (1 - p) + 1e-9
        grad = np.array([(r * z).sum() + 0.1 * (a - 1), r.sum()])
        hess = np.array([[(v * z * z).sum() + 0.1, (v * z).sum()], [(v * z).sum(), v.sum()]])
        step = np.linalg.solve(hess, grad)
        a, c = a - step[0], c - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(max(a, 0.05)), float(c)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(documents: DataFrame, labels: DataFrame, chars: dict[int, int] = TRAIN_CHARS, longest: int = TRAIN_LONGEST) -> DataFrame:
    """text, toxic: documents to learn from, of each label up to `chars` characters in expectation, chosen by hash."""
    y = labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1)).filter(~held_out(F.col("doc_id")))
    d = documents.select("doc_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) <= longest)
    sized = d.select("doc_id", F.length("text").alias("size")).join(y, "doc_id").groupBy("toxic").agg(F.sum("size").alias("size"))
    keep = F.lit(False)
    for r in sized.collect():
        share = min(1.0, chars[r["toxic"]] / max(1, r["size"] or 0))
        keep = keep | ((F.col("toxic") == r["toxic"]) & (F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))))
    chosen = stash(y.filter(keep), "train_ids")
    return sized_join(d, chosen, "doc_id", "inner").select(F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"), "toxic").orderBy(F.xxhash64("text"), "toxic")


def toxicity_scorer(documents: DataFrame, labels: DataFrame):
    """Learn from labelled documents; gives a function of a text column (binary) to a score column."""
    sample = training_sample(documents, labels).toArrow()
    texts, y = sample["text"].to_pylist(), np.array(sample["toxic"].to_pylist(), float)
    del sample
    pa.default_memory_pool().release_unused()
    if len(set(y.tolist())) == 2:
        weights, bias = train(texts, y)
        scorer = Scorer(weights, bias)
        slope, offset = calibrate(np.array([z for at in range(0, len(texts), 256) for z in scorer.best(texts[at : at + 256])]), y)
        weights, bias = weights * slope, bias * slope + offset
    else:
        share = float(y.mean()) if len(y) else 0.0
        weights, bias = np.zeros(BUCKETS), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    del texts
    give_back()
    model = documents.sparkSession.sparkContext.broadcast((weights, bias))  # BUCKETS doubles: 512 kB

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(*model.value)
        for b in batches:
            z = [x for at in range(0, len(b), 256) for x in scorer.best([t or b"" for t in b.iloc[at : at + 256]])]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(z, float), -50, 50))))
            del b
            give_back()
        del scorer
        give_back()

    return score


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents -> doc_id, held_out, score, predicted."""
    score = toxicity_scorer(documents, labels)(F.col("text").cast("binary"))
    out = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents without those predicted toxic, all columns kept; written to the shared folder (a stash)."""
    score = toxicity_scorer(documents, labels)(F.col("text").cast("binary"))
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row"), score.alias("toxicity"))
    with small_batches(documents.sparkSession, BATCH_DOCS):
        return stash(rows.filter("toxicity < 0.5").select("row.*"), "not_toxic")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
