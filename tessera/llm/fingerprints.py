"""Document fingerprints by prefix polynomial hashes.

PrefixHashes holds, for each length k, the hash of a text's first k code points: the sum of code point j, plus 1, times BASE^j,
modulo a Mersenne prime. A difference of two of them, divided by a power of BASE, is the hash of the span between, so any two
spans are compared at once, and a binary search over lengths finds how far two texts agree from given places. The array of a
text that is put together from parts of others follows from theirs, without a look at the letters.

A fingerprint is text: length, hash of the whole, and for each width in WIDTHS a sketch of the spans of that width: the
least span hash of each of SLOTS classes, of which eight bits are kept. The likeness of two fingerprints is the share of
their spans that both have, 2 J / (1 + J) for a similarity J of the two sets, as the classes estimate it: that of the long
spans, or of the short ones where a text is shorter than SHORT. It is 1 if and only if lengths and whole hashes are equal.

Texts are shuffled once, by ranges of descending doc_id; a document's successor is the next row of its range. The last
row of a range meets the first of the next in a second step, of one row a range.

Defined results: a null text is as an empty one, and empty texts are alike; a text shorter than a span is a span of its own;
a null doc_id comes last, and rows of one doc_id go by their text's hash; a lone document follows itself; an empty table
gives an empty result. Other columns are ignored. A task holds 8 bytes for each code point of three texts, besides the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import give_back, read, small_batches, stash

MOD, BASE = (1 << 61) - 1, 1_000_003_000_000_021
UNBASE = pow(BASE, -1, MOD)
WIDTHS, SLOTS, SHORT = (16, 4), 64, 64
#: Code points hashed at a time; bytes of text of a range; rows of a batch.
SLICE, RANGE_BYTES, BATCH_DOCS = 1 << 15, 32 << 20, 128
_U = np.uint64
_M, _M30, _M31 = _U(MOD), _U((1 << 30) - 1), _U((1 << 31) - 1)
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("agree_edited", pa.int64()), ("agree_next", pa.int64()),
    ("seam", pa.string()), ("part", pa.int32()), ("text", pa.string())])
RESULT = SCHEMA.names[:9]
_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, agree_edited long, agree_next long, seam string, part int, text string"


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo MOD, for any 64 bits."""
    x = (x & _M) + (x >> _U(61))
    return np.where(x >= _M, x - _M, x)


def mul(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """Products modulo MOD of numbers below it, by halves of 31 and 30 bits."""
    al, ah, bl, bh = a & _M31, a >> _U(31), b & _M31, b >> _U(31)
    mid = ah * bl + al * bh
    return _fold(((ah * bh) << _U(1)) + (mid >> _U(30)) + ((mid & _M30) << _U(31)) + al * bl)


def running(x: np.ndarray) -> np.ndarray:
    """Running sums modulo MOD of at most SLICE numbers."""
    high, low = np.cumsum(x >> _U(31)), np.cumsum(x & _M31)
    return _fold((high >> _U(30)) + ((high & _M30) << _U(31)) + low)


def powers(base: int) -> np.ndarray:
    out = np.ones(1, _U)
    while len(out) < SLICE:
        out = np.concatenate([out, mul(out, _U(pow(base, len(out), MOD)))])
    return out


_POWERS, _UNPOWERS = powers(BASE), powers(UNBASE)


class PrefixHashes:
    """Hashes of all prefixes of a text."""

    def __init__(self, text: str = "", prefix: np.ndarray | None = None):
        if prefix is None:
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
            prefix = np.zeros(len(points) + 1, _U)
            for at in range(0, len(points), SLICE):
                here = points[at : at + SLICE].astype(_U) + _U(1)  # so that no code point is as nothing
                sums = running(mul(here, _POWERS[: len(here)]))
                sums = mul(sums, _U(pow(BASE, at, MOD))) if at else sums
                prefix[at + 1 : at + 1 + len(sums)] = _fold(sums + prefix[at])
        self.prefix = prefix

    def __len__(self) -> int:
        return len(self.prefix) - 1

    def span(self, start: int, end: int) -> int:
        """Hash of a span, the same wherever it lies."""
        return (int(self.prefix[end]) - int(self.prefix[start])) * pow(UNBASE, start, MOD) % MOD

    def same(self, start: int, other: PrefixHashes, at: int, length: int) -> bool:
        return self.span(start, start + length) == other.span(at, at + length)

    def agreement(self, start: int, other: PrefixHashes, at: int) -> int:
        """The longest common extension: how many code points from start on are those of the other from `at` on."""
        low, high = 0, min(len(self) - start, len(other) - at)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(start, other, at, mid) else (low, mid - 1)
        return low

    def joined(self, length: int, other: PrefixHashes, more: int) -> PrefixHashes:
        """Of the first `length` code points followed by the first `more` of another."""
        rest = _fold(mul(other.prefix[1 : more + 1], _U(pow(BASE, length, MOD))) + self.prefix[length])
        return PrefixHashes(prefix=np.concatenate([self.prefix[: length + 1], rest]))

    def spans(self, width: int) -> Iterator[np.ndarray]:
        """Hashes of all spans of a width, a slice at a time; of a shorter text its own."""
        n = len(self)
        if 0 < n < width:
            yield self.prefix[n:]
        for at in range(0, n - width + 1, SLICE):
            count = min(SLICE, n - width + 1 - at)
            found = _fold(self.prefix[at + width : at + width + count] + (_M - self.prefix[at : at + count]))
            found = mul(found, _UNPOWERS[:count])
            yield mul(found, _U(pow(UNBASE, at, MOD))) if at else found

    def sketch(self, width: int) -> str:
        """Two digits a slot: eight bits of the least hash of its class; dots for a class without spans."""
        none = _U(0xFFFFFFFFFFFFFFFF)
        least = np.full(SLOTS, none)
        for x in self.spans(width):
            x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
            x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
            x ^= x >> _U(32)
            np.minimum.at(least, (x % _U(SLOTS)).astype(np.int64), x // _U(SLOTS))
        digits = (least & _U(255)).astype(np.uint8).tobytes().hex()
        return "".join(".." if e else digits[2 * k : 2 * k + 2] for k, e in enumerate(least == none))

    @cached_property
    def fingerprint(self) -> str:
        return f"{len(self):x}-{int(self.prefix[-1]):016x}-" + "-".join(map(self.sketch, WIDTHS))


def likeness(a: str, b: str) -> float:
    """0 to 1: the share of spans that two fingerprints' texts have in common."""
    x, y = a.split("-"), b.split("-")
    if x[:2] == y[:2]:
        return 1.0
    long_ = min(int(x[0], 16), int(y[0], 16)) >= SHORT
    u, v = (np.frombuffer(z[2 if long_ else 3].encode(), "<u2") for z in (x, y))
    met = (u != 0x2E2E) | (v != 0x2E2E)
    if not met.any():
        return 0.0
    by_chance = 1 / 256
    j = max(0.0, (float((u == v)[met].mean()) - by_chance) / (1 - by_chance))
    return min(2 * j / (1 + j), 1 - 1e-9)


def _row(doc_id: int | None, text: str, own: PrefixHashes, after: str, other: PrefixHashes) -> tuple:
    """A document's result, given the one that follows it."""
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    hashes = own.joined(len(text) - half, other, min(half, len(after)))
    near = [likeness(own.fingerprint, x.fingerprint) for x in (hashes, other)]
    agree = [own.agreement(0, x, 0) for x in (hashes, other)]
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own.fingerprint, hashes.fingerprint, *near, *agree, None, None, None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA)


def _along_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (doc_id, text, part) -> results of all but the last row, and the texts of the first and the last."""
    before = part = None
    bare = [None] * 8
    for b in batches:
        out = []
        for doc_id, text, part in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["part"].to_pylist()):
            own = PrefixHashes(text)
            out.append(_row(*before, text, own) if before else (doc_id, *bare, "first", part, text))
            before = doc_id, text, own
        if out:
            yield _batch(out)
    if before:
        yield _batch([(before[0], *bare, "last", part, before[1])])
    give_back()


def _over_seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, after) -> results."""
    for b in batches:
        rows = [_row(i, x, PrefixHashes(x), y, PrefixHashes(y)) for i, x, y in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["after"].to_pylist())]
        if rows:
            yield _batch(rows)
    give_back()


def fingerprint_edits(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """documents -> doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, agree_edited, agree_next.

    The edited text has the last half of its code points replaced by the first of the next document, in descending
    doc_id. near_ is the likeness of fingerprints; agree_ counts the code points from the start that are the same.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(max(1, -(-size // range_bytes), min(d.sparkSession.sparkContext.defaultParallelism, size >> 20)))
    # rows alike in both may lie in any order, so that a number tells them apart
    d = d.withColumns({"tie": F.xxhash64("text"), "salt": F.xxhash64(F.monotonically_increasing_id())})
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("salt")]
    d = d.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))
    with small_batches(d.sparkSession, BATCH_DOCS):
        found = stash(d.mapInArrow(_along_ranges, _DDL), "fingerprints")
        first, last = (found.filter(F.col("seam") == s) for s in ("first", "last"))
        by = Window.orderBy("part")  # a row for each range
        ends = last.select("part", F.lead("part").over(by).alias("then"), F.min("part").over(Window.partitionBy()).alias("least"))
        ends = ends.select("part", F.coalesce("then", "least").alias("then"))
        pairs = last.join(ends, "part").select("doc_id", "text", F.col("then").alias("part"))
        pairs = pairs.join(first.select("part", F.col("text").alias("after")), "part").select("doc_id", "text", "after")
        seams = stash(pairs.mapInArrow(_over_seams, _DDL), "seams")
    return found.filter("seam IS NULL").select(*RESULT).unionByName(seams.select(*RESULT))


def op11_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))


def edited_texts(spark, sf_dir: str) -> DataFrame:
    """What SQL can tell of the fingerprinted documents: which text each was edited to, and how far it agrees with it."""
    return op11_document_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256", "agree_next")
