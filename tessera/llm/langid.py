"""Language identification by hyperdimensional profiles.

Each letter has a random vector of DIM signs, drawn from its code point. An n-gram is bound by multiplying its letters'
vectors, each permuted (rolled) by its place; a text is the bundle (sum) of its n-grams' vectors, and a language the
bundle of its documents' unit bundles. A document takes the language of the highest cosine.

Letters are lower-cased; every run of other characters becomes one space, also a letter. A text of n different n-grams
costs n bindings, whatever its length.

Learning uses documents with a language whose crc32(doc_id as text) mod 4 is not 2, up to TRAIN_DOCS of each language
in expectation, chosen by hash. Languages are summed in Spark; only one vector a language reaches the driver.

Defined results: a null text or one without a letter gives `und` and score 0; with nothing learnt every text does;
repeated rows are judged alike; an empty table gives an empty result. score is the cosine, 0 if below.
Of documents only doc_id, text and (to learn) lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import read

DIM, GRAM, SEED = 1024, 3, 11
TRAIN_DOCS = 3000
#: n-grams whose bound vectors a worker remembers (DIM bytes each).
CACHE_GRAMS = 30_000
#: Code points, space included, are held in 21 bits each.
_BITS = 21


def letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng([SEED, code]).choice(np.array([-1, 1], np.int8), DIM)


def grams_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of a text, as packed code points, and their counts; none without a letter."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    used, at = np.unique(code, return_inverse=True)
    letter = np.array([chr(c).isalpha() for c in used], bool)
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.where(letter, used, 32)[at].astype(np.int64)
    code = np.concatenate([[32], code, [32]])
    code = code[np.concatenate([[True], (code[1:] != 32) | (code[:-1] != 32)])]
    if len(code) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed = np.zeros(len(code) - GRAM + 1, np.int64)
    for k in range(GRAM):
        packed = packed << _BITS | code[k : len(code) - GRAM + 1 + k]
    return np.unique(packed, return_counts=True)


class Encoder:
    """Bundles of texts; bound vectors of n-grams are kept in one table of CACHE_GRAMS rows."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.known, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.table, self.used = np.zeros((1024, DIM), np.int8), 0

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            self.letters[code] = letter_vector(code)
        return self.letters[code]

    def bind(self, gram: int) -> np.ndarray:
        out = np.ones(DIM, np.int8)
        for k in range(GRAM):
            code = gram >> (_BITS * (GRAM - 1 - k)) & ((1 << _BITS) - 1)
            out = out * np.roll(self._letter(code), GRAM - 1 - k)
        return out

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Rows of the table for sorted different n-grams, at most CACHE_GRAMS of them."""
        at = np.searchsorted(self.known, grams)
        hit = at < len(self.known)
        hit[hit] = self.known[at[hit]] == grams[hit]
        if not hit.all():
            new = grams[~hit]
            if self.used + len(new) > CACHE_GRAMS:
                self._clear()
                new = grams
            while self.used + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for i, g in enumerate(new.tolist()):
                self.table[self.used + i] = self.bind(g)
            known = np.concatenate([self.known, new])
            row = np.concatenate([self.row, np.arange(self.used, self.used + len(new))])
            order = np.argsort(known)
            self.known, self.row, self.used = known[order], row[order], self.used + len(new)
            at = np.searchsorted(self.known, grams)
        return self.row[at]

    def bundle(self, text: str) -> np.ndarray | None:
        grams, counts = grams_of(text)
        if not len(grams):
            return None
        total = np.zeros(DIM, np.float32)
        for at in range(0, len(grams), 2048):  # bounds what is gathered at once
            part = self.table_rows(grams[at : at + 2048])
            total += counts[at : at + 2048].astype(np.float32) @ part
        return total

    def table_rows(self, grams: np.ndarray) -> np.ndarray:
        row = self.rows(grams)
        return self.table[row].astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(documents: DataFrame, per_lang: int = TRAIN_DOCS) -> dict[str, np.ndarray]:
    """Unit prototypes by language."""
    d = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    keep = F.lit(False)
    for lang, n in ((r["lang"], r["count"]) for r in d.groupBy("lang").count().collect()):
        share = min(1.0, per_lang / n)
        chosen = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
        keep = keep | ((F.col("lang") == lang) & chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sums = Encoder(), {}
        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"]):
                if (v := enc.bundle(text.as_py())) is not None and (n := np.linalg.norm(v)):
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64) / n
        langs = [x for x in sums for _ in range(DIM)]
        dims = np.tile(np.arange(DIM, dtype=np.int32), len(sums))
        flat = np.concatenate([*sums.values()]) if sums else np.zeros(0)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(dims), pa.array(flat)], ["lang", "dim", "x"])

    rows = d.filter(keep).select("lang", "text").mapInArrow(run, "lang string, dim int, x double")
    # rounded, so that the order of summing cannot change a rerun
    rows = rows.groupBy("lang", "dim").agg(F.sum(F.round("x", 6).cast("decimal(28,6)")).cast("double").alias("x"))
    out: dict[str, np.ndarray] = {}
    for r in rows.collect():
        out.setdefault(r["lang"], np.zeros(DIM))[r["dim"]] = r["x"]
    return {k: (v / n).astype(np.float32) for k, v in sorted(out.items()) if (n := np.linalg.norm(v))}


def identify(documents: DataFrame, prototypes: dict[str, np.ndarray] | None = None) -> DataFrame:
    """documents -> doc_id, held_out, lang_pred, score."""
    prototypes = learn(documents) if prototypes is None else prototypes
    names = list(prototypes)
    model = documents.sparkSession.sparkContext.broadcast(np.stack([prototypes[k] for k in names]) if names else None)  # DIM floats a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, langs = Encoder(), model.value
        for b in batches:
            pred, score = [], []
            for t in b["text"]:
                v = enc.bundle(t.as_py() or "") if langs is not None else None
                norm = 0 if v is None else np.linalg.norm(v)
                cos = langs @ v / norm if norm else None
                pred.append("und" if v is None else names[int(cos.argmax())] if norm else names[0])
                score.append(float(min(1, max(0, cos.max()))) if norm else 0.0)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
