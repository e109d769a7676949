"""op11 against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import fingerprints
from tessera.llm.fingerprints import BASE, MOD, PrefixHashes, likeness


def _hash(text: str) -> int:
    return sum((ord(c) + 1) * pow(BASE, k, MOD) for k, c in enumerate(text)) % MOD


def _agree(a: str, b: str) -> int:
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("piece", [3, 7, 1 << 15])
def test_prefix_hashes(monkeypatch, piece):
    """Spans, extensions, texts put together and sketches, wherever slices end."""
    rng, whole = random.Random(2), PrefixHashes("".join(map(chr, range(200, 500)))).fingerprint
    monkeypatch.setattr(fingerprints, "SLICE", piece)
    texts = ["", "a", "é𝄞\x00b", *("".join(rng.choice("ab") for _ in range(rng.randint(1, 90))) for _ in range(40))]
    for s, t in zip(texts, texts[1:] + texts[:1]):
        p, q = PrefixHashes(s), PrefixHashes(t)
        for _ in range(30):
            i, j = rng.randint(0, len(s)), rng.randint(0, len(t))
            k = rng.randint(i, len(s))
            assert p.span(i, k) == _hash(s[i:k])
            assert p.agreement(i, q, j) == _agree(s[i:], t[j:])
            both = p.joined(i, q, j)
            assert both.span(0, len(both)) == _hash(s[:i] + t[:j]) and both.fingerprint == PrefixHashes(s[:i] + t[:j]).fingerprint
        for width in (1, 4, 16):
            spans = [int(x) for part in p.spans(width) for x in part]
            assert spans == ([_hash(s[i : i + width]) for i in range(len(s) - width + 1)] or [_hash(s)] * bool(s))
    assert PrefixHashes("".join(map(chr, range(200, 500)))).fingerprint == whole


def test_likeness_follows_what_texts_share():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    error = []
    for _ in range(60):
        a, b = (" ".join(rng.choice(words) for _ in range(400)) for _ in range(2))
        share = rng.random()
        mixed = a[: int(len(a) * share)] + b[: len(a) - int(len(a) * share)]
        x, y = PrefixHashes(a).fingerprint, PrefixHashes(mixed).fingerprint
        assert 0 <= likeness(x, y) == likeness(y, x) < 1
        error.append(abs(likeness(x, y) - share))
        assert likeness(x, PrefixHashes(b).fingerprint) < 0.1 and likeness(x, PrefixHashes("new " + a).fingerprint) > 0.9
        assert likeness(x, x) == 1
    assert sum(error) / len(error) < 0.08 and max(error) < 0.3
    empty = PrefixHashes("").fingerprint
    assert likeness(empty, empty) == 1 and likeness(empty, PrefixHashes("a").fingerprint) == 0
    assert likeness(PrefixHashes("short words are alike").fingerprint, PrefixHashes("short words as of now").fingerprint) > 0.2


def _want(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text), with no two rows of one doc_id and different texts."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, s), (_, t) in zip(rows, rows[1:] + rows[:1]):
        half = len(s) // 2
        edited = s[: len(s) - half] + t[:half]
        f, g, h = (PrefixHashes(x).fingerprint for x in (s, edited, t))
        out.append((i, len(s), hashlib.sha256(edited.encode()).hexdigest(), f, g, likeness(f, g), likeness(f, h), _agree(s, edited), _agree(s, t)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("range_bytes", [1 << 25, 700])
def test_edits_against_plain_python(spark, range_bytes):
    """In one range and in many, of which some hold a row."""
    rng = random.Random(1)
    rows = [(k * 3, "".join(rng.choice("ab é𝄞") for _ in range(rng.choice([0, 1, 2, 5, 80])))) for k in range(150)]
    rows += [(-5, "x" * 100_000), (1, None), (2, ""), (None, "no id"), (1301, "same text"), (1302, "same text"), (1303, "same text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("part", "seam", "after", "tie", "n_chars", "then")}).repartition(3)
    got = fingerprints.fingerprint_edits(df, range_bytes)
    assert got.columns == fingerprints.RESULT
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _want(rows)


def test_edits_of_odd_rows(odd_docs, no_docs):
    rows = fingerprints.fingerprint_edits(odd_docs).collect()
    assert len(rows) == 10 and fingerprints.fingerprint_edits(no_docs).count() == 0
    assert {r["fingerprint"] for r in rows if r["doc_id"] == 1} == {PrefixHashes("The quick brown fox jumps over the lazy dog and runs away").fingerprint}
    (alone,) = fingerprints.fingerprint_edits(odd_docs.filter("doc_id = 8")).collect()
    assert alone["near_next"] == 1 and alone["agree_next"] == 7 and alone["n_chars"] == 7
