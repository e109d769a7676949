"""op12 against plain Python, which encodes whole texts."""

from __future__ import annotations

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")


def _tokens(texts: list[str | None]) -> list[tuple[list, list] | None]:
    """(id, bytes) of both sides; None where there are none."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(alignment.TOKENIZER_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.TOKENIZER_B))
    letters, out = alignment.byte_of_letter(), []
    for t in texts:
        if not t:
            out.append(None)
            continue
        x = a.encode(" " + t, add_special_tokens=False)
        xs = [(k, bytes(letters[c] for c in w)) for k, w in zip(x.ids, x.tokens)]
        ys = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in b.encode(t)]
        same = all(b"".join(w for _, w in s) == (" " + t).encode() for s in (xs, ys))
        out.append((xs, ys) if same else None)
    return out


def _ends(side: list) -> list[int]:
    at, out = 0, []
    for _, w in side:
        at += len(w)
        out.append(at)
    return out


def _want(rows: list[tuple]) -> tuple[list[tuple], dict]:
    found, docs = [], defaultdict(set)
    for d, tokens in enumerate(_tokens([t for _, t in rows])):
        groups = []
        if tokens:
            cut = sorted({*_ends(tokens[0])} & {*_ends(tokens[1])})
            groups = [([], []) for _ in cut]
            for side in (0, 1):
                for (k, _), end in zip(tokens[side], _ends(tokens[side])):
                    groups[bisect.bisect_left(cut, end)][side].append(k)
        links = Counter((p, q) for x, y in groups for p in x for q in y)
        for pair in links:
            docs[pair].add(d)
        found.append((groups, links))
    high = defaultdict(int)
    for (p, _), s in docs.items():
        high[p] = max(high[p], len(s))
    out = []
    for (doc_id, _), (groups, links) in zip(rows, found):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()), sum(n for k, n in links.items() if len(docs[k]) == high[k[0]]),
            sum(n * len(docs[k]) for k, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr), {k: (len(s), len(s) == high[k[0]]) for k, s in docs.items()}


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "two  spaces", "tab\tand\n\nlines \n end", "a b c", "x▁y", "<s> </s> <unk> <|endoftext|> <0x41>", "café Å ﬁ ①", "مرحبا 中文 \U0001f600",
    "a\x1c b \x1d", "　wide", "it's we'll I'D", "1234567 89", "!!! ...,;", "a\x00b c", "x​ y", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "́ combining", "a\r\nb", "é x", "﻿bom",
]


@pytest.mark.parametrize("seed", [1, 2])
def test_pieces_give_what_whole_texts_give(spark, monkeypatch, seed):
    """Runs are merged by threes and batches are small, so that counts go up and down several levels."""
    monkeypatch.setattr(alignment, "FAN", 3)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 300)
    monkeypatch.setattr(alignment, "SEGMENT_CHARS", 60)
    monkeypatch.setattr(alignment, "GROUP_LINKS", 3 if seed == 1 else 4096)
    rng = random.Random(seed)
    words = ["the", "of", "Zusammenhang", "déjà", "x1", "http://a.org/b?c=1", "中", "\n", "  ", "don't", "ﬁne", "\t", "UPPER", " ", "0.5%", "unbelievable", "-", "<s>", "▁"]
    texts = [*ODD, *("".join(rng.choice(words) + rng.choice(["", " ", " ", " ", "  "]) for _ in range(rng.randint(1, 40))) for _ in range(120))]
    texts += ["the same text of all"] * 40 + ["x" * 1500 + " long run" + " " * 1200 + "ab" * 700]
    rows = [(None if k % 31 == 3 else k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("batch", "run", "radix", "n_a", "pairs", "into")}).repartition(3)
    docs, pairs = alignment.align(df)
    want, counted = _want(rows)
    assert docs.columns == alignment.RESULT and sorted((tuple(r) for r in docs.collect()), key=repr) == want
    assert {(r["a_id"], r["b_id"]): (r["n_docs"], r["best"]) for r in pairs.collect()} == counted


def test_alignment_edges(odd_docs, no_docs, spark):
    docs, _ = alignment.align(odd_docs)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted((tuple(r) for r in docs.collect()), key=repr) == _want(rows)[0]
    for df in (no_docs, spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")):
        docs, pairs = alignment.align(df)
        assert pairs.count() == 0 and all(r["n_a"] == 0 and r["groups_sha256"] == "" for r in docs.collect()) and docs.count() == df.count()


def test_what_is_packed_is_unpacked():
    import numpy as np

    for x in ([], [0], [255, 256], [1 << 40, 0, 7]):
        assert alignment.unpack(alignment.pack(np.array(x, np.int64))).tolist() == x
    assert " ".join(alignment.segments("a b\nc  d e ", 1)) == "a b\nc  d e " and [*alignment.segments("a b\nc  d e ", 2)] == ["a b\nc  d", "e "]
    assert [*alignment.segments("aa bb cc dd", 3)] == ["aa bb", "cc dd"] and [*alignment.segments("abcdef", 2)] == ["abcdef"]
