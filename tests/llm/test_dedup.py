from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tessera.llm import embedding_dedup, near_copies, simhash, suffix_dedup
from tessera.llm.common import components


def _groups(n: int, linked) -> list[int]:
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(i):
                if label[i] != label[j] and linked(i, j):
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 60) if i % 7] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(500, 500)]
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if x != 500}


def test_anchors_cover_all_pairs():
    """Two 31-bit blocks that differ in one bit meet: the home of the one is among the copies of the other."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 62, 200, dtype=np.int64)
    i, anchor, home = simhash.anchors(x)
    homes = {(int(a), int(k)) for k, a, h in zip(i, anchor, home) if h}
    for bit in (0, 13, 30, 31, 45, 61):
        k, copies, _ = simhash.anchors(x ^ (1 << bit))
        block = bit // 31
        found = {(int(a), int(j)) for j, a in zip(k, copies)}
        assert all((a, j) in found for a, j in homes if a >> 31 == block)


def _simhash(text):
    words = [w.translate({k: k + 32 for k in range(65, 91)}) for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("block", [1024, 3])
def test_simhash_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # hot anchors are cut into blocks
    rng = random.Random(2)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 500)) for _ in range(200)) for _ in range(6)]
    texts = [" ".join(w if rng.random() > 0.01 else "x" for w in rng.choice(base).split()) for _ in range(60)] + [None, "", "one", "one two"]
    rows = simhash.simhash_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    fp = [_simhash(t) for t in texts]
    want = _groups(len(texts), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 3)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {k: (f"{fp[k]:016x}", want[k]) for k in range(len(texts))}


def test_simhash_edges(odd_docs, no_docs):
    rows = simhash.simhash_groups(odd_docs).collect()
    assert len(rows) == 10 and {r["component_id"] for r in rows if r["doc_id"] in (3, 4, 5)} == {3}
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and None in ids and 4 not in ids
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def _five(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("block", [512, 3])
def test_near_copies_against_brute_force(spark, monkeypatch, block):
    """Texts at a similarity about 0.8 of which most differ in more than 3 bits of op8's fingerprints."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 500)) for _ in range(n)) for n in (6, 30, 80, 200, 900)]
    line = " ".join(f"common{k}" for k in range(12))
    texts = []
    for k in range(90):
        words = base[k % 5].split()
        for _ in range(rng.choice([0, 1, 1, 2, 3]) if len(words) < 300 else rng.randint(0, 40)):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 9)}"
        texts.append(" ".join(words) + (f" {line}" if k % 3 == 0 else ""))
    texts += [None, "", " \t", "one", "One", "one two", "a b c d e", "a b c d e f"]
    sets = [_five(t) for t in texts]

    def linked(i, j):
        return sets[i] == sets[j] or bool(sets[i] & sets[j]) and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))

    want = _groups(len(texts), linked)
    assert 15 < len(set(want)) < 85
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_copies.near_copy_groups(docs).collect()} == dict(enumerate(want))
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()} == set(want)


@pytest.mark.parametrize("block", [1024, 7])
def test_embeddings_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 64))
    vec = [base[k % 12] + rng.normal(size=64) * rng.choice([0.0, 0.05, 0.2, 0.35]) for k in range(240)]
    rows = [(k, k % 3 if k % 50 else None, [float(np.float32(x)) for x in v]) for k, v in enumerate(vec)]
    rows += [(900, 1, None), (901, 1, [0.0] * 64), (902, 1, [float("nan")] * 64), (903, 1, [None, 1.0]), (904, 1, []), (905, 1, [1.0, 0.0]), (906, 1, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    x = np.array([r[2] for r in rows[:240]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cos = x @ x.T

    def linked(i, j):
        return rows[i][1] is not None and rows[i][1] == rows[j][1] and cos[i, j] >= 0.93

    want = sum(linked(i, j) for i in range(240) for j in range(240) if i != j)
    links = sum(got[i]["n_links"] for i in range(240))
    assert want >= links >= 0.98 * want
    if links == want:
        assert [got[i]["component_id"] for i in range(240)] == _groups(240, linked)
    assert [got[k]["n_links"] for k in range(900, 907)] == [0, 0, 0, 0, 0, 1, 1] and got[906]["component_id"] == 905
    assert all(got[k]["kept"] for k in range(900, 906)) and not got[906]["kept"]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_cross_polytope_recall():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r = rng.normal(size=a.shape)
    r -= (r * a).sum(1, keepdims=True) * a
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * r / np.linalg.norm(r, axis=1, keepdims=True)
    x, y = embedding_dedup.hashes(a), embedding_dedup.hashes(b)
    met = ((x[:, :, :1] == y) | (y[:, :, :1] == x)).any(axis=(1, 2))
    assert met.mean() >= 0.98


@pytest.mark.parametrize("dim", [2, 16, 64, 300])
def test_sketches_lose_no_pair_at_the_least_cosine(dim):
    rng = np.random.default_rng(dim)
    a = embedding_dedup.unit(rng.normal(size=(20_000, dim)))
    r = rng.normal(size=a.shape)
    r = embedding_dedup.unit(r - (r * a).sum(1, keepdims=True) * a)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * r
    apart = np.bitwise_count(embedding_dedup.sketches(a) ^ embedding_dedup.sketches(b)).sum(axis=1)
    assert apart.max() <= embedding_dedup.MOST_APART
    if dim >= 64:  # and vectors with nothing in common are told apart
        assert (np.bitwise_count(embedding_dedup.sketches(a) ^ embedding_dedup.sketches(r)).sum(axis=1) <= embedding_dedup.MOST_APART).mean() < 1e-3


def test_embeddings_exact_cosine_repeated_ids_and_clashing_columns(spark):
    """Vectors at a cosine of exactly 0.93, and just below; ids that repeat or are null; columns named as those inside."""
    at, below = [93.0, 36.0, 7.0, 2.0, 1.0, 1.0], [93.0, 36.0, 7.0, 2.0, 1.0, 1.0001]
    axis = [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    rows = [(1, 1, axis), (2, 1, at), (3, 2, axis), (4, 2, below), (5, 3, at), (5, 3, at), (None, 4, at), (None, 4, axis), (7, 5, axis), (None, 5, axis)]
    df = spark.createDataFrame([(*r, "x", "y", 0, 1) for r in rows], "vec_id long, label int, embedding array<double>, key string, cid string, n int, bucket int")
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    want = [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 1, 5, True), (5, 1, 5, True), (0, 1, None, False), (0, 1, None, False), (7, 1, 7, True), (0, 1, 7, False)]
    assert got == sorted(want, key=str)


def _strip(texts: list[bytes], length: int):
    n = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if n[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        yield len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_against_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (300, 399, 400, 401, 450, 900, 2000)]

    def noise():
        return "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 300)))

    texts = [noise() + "".join(rng.choice(passages) + noise() for _ in range(rng.randint(0, 4))) for _ in range(60)]
    texts += [passages[5] * 3, "ab" * 700, "a" * 401, "a" * 400, passages[4][:449], passages[6], passages[6], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.strip_repeats(docs).collect()}
    for k, want in enumerate(_strip([(t or "").encode() for t in texts], 400)):
        r = got[k]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) == want
    odd = suffix_dedup.strip_repeats(odd_docs).collect()
    assert len(odd) == 10 and suffix_dedup.strip_repeats(no_docs).count() == 0


def test_index_family_levels(spark):
    family = suffix_dedup.IndexFamily(spark)
    met = [sorted(r["key"] for r in family.add(spark.createDataFrame([(k,) for k in keys], "key long")).collect()) for keys in ([1, 1, 2], [2, 3], [3, 9], [9, 1, 7])]
    assert met == [[1], [2], [3], [1, 9]] and list(family.levels) == [2]


def test_near_duplicates_are_proposed_by_fingerprints(spark, monkeypatch):
    """Without the prefix filter near copies at 3 bits still go, as SimHash proposes them."""
    import random

    from tessera.llm import near_copies, simhash

    rng = random.Random(8)
    texts = []
    while len(texts) < 8:
        words = [f"w{rng.randint(0, 500)}" for _ in range(400)]
        other = words[:200] + ["changed"] + words[201:]
        pair = [" ".join(words), " ".join(other)]
        a, b = (simhash.fingerprint(t.encode()) for t in pair)
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= simhash.MAX_DIFF:
            texts += pair
    texts += ["only two", "two only"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(near_copies, "candidates", lambda docs: docs.sparkSession.createDataFrame([], "a long, b long"))
    assert {r["doc_id"] for r in simhash.drop_near_duplicates(docs).collect()} == {0, 2, 4, 6, 8, 9}
