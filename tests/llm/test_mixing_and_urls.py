from __future__ import annotations

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, url_filter


def _targets(sizes: list[int], weights=(1, 2, 3), cap=3) -> list[float]:
    """Water filling, by the book."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    stopped: set[int] = set()
    while True:
        left = sum(sizes) - sum(cap * sizes[k] for k in stopped)
        share = sum(w[k] for k in range(len(sizes)) if k not in stopped)
        over = {k for k in range(len(sizes)) if k not in stopped and left * w[k] / share > cap * sizes[k]}
        if not over:
            return [cap * s if k in stopped else left * w[k] / share for k, s in enumerate(sizes)]
        stopped |= over


TIED = [[5000, 10_000], [100] * 6, [100] * 7, [1000, 10, 300, 1000, 10, 300], [500, 1000]]


@pytest.mark.parametrize("sizes", [[100, 10, 1000], [5, 5, 5, 5], [1, 1, 1000], [0, 7, 30, 900, 2, 1], *TIED])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{k}", s) for k, s in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    for k, t in enumerate(_targets(sizes)):
        assert got[f"s{k}"] == pytest.approx(t, abs=1e-6)


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, "w " * rng.randint(0, 50), f"s{i % 5}") for i in range(3000)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    taken, by = defaultdict(int), {}
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    for r in rows:
        taken[(r["source_size"], r["target"])] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and again[r["doc_id"]] == r["taken"]
        by[r["source_size"]] = r["target"]
    for (_, target), t in taken.items():
        assert 0 <= target - t < 50  # less than the largest document
    assert len(by) == 5 and sum(by.values()) == pytest.approx(sum(by))  # no two sources are of one size here


def test_targets_of_many_tied_sources():
    """The level that targets picks, in plain Python, against water filling for lists of few different sizes."""
    for sizes in itertools.chain(*(itertools.product((0, 10, 20, 30), repeat=n) for n in range(1, 7))):
        w = [mixing.WEIGHTS[k % 3] for k in range(len(sizes))]
        up = sorted(range(len(sizes)), key=lambda k: (3 * sizes[k] / w[k], k))
        level = next((x for k, x in ((k, (sum(sizes) - 3 * sum(sizes[j] for j in up[:p])) / sum(w[j] for j in up[p:])) for p, k in enumerate(up)) if 3 * sizes[k] / w[k] > x), None)
        got = [3 * s if level is None else min(3 * s, level * w[k]) for k, s in enumerate(sizes)]
        assert got == pytest.approx(_targets(list(sizes)), abs=1e-9) and sum(got) == pytest.approx(sum(sizes))


@pytest.mark.parametrize("sizes", TIED)
def test_mix_of_tied_sources(spark, sizes):
    rows = [(f"{k}-{i}", f"s{k}", "w " * 5) for k, s in enumerate(sizes) for i in range(s // 5)]
    docs = spark.createDataFrame(rows, "doc_id string, source string, text string").repartition(5)
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs.withColumn("doc_id", F.xxhash64("doc_id"))).collect():
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["target"]] += r["taken"]
        target[r["target"]] = target.get(r["target"], 0) + 1
    assert sum(taken.values()) == pytest.approx(sum(sizes), abs=5 * len(sizes))
    assert mixing.mix_documents(docs).count() == pytest.approx(sum(sizes) / 5, abs=len(sizes))


def test_mix_of_rows_alike(spark):
    """Null doc_ids, with different texts and with the same: as many rows are taken as fit, in any layout of the rows."""
    docs = [(None, "a", f"w{k} x") for k in range(1000)] + [(None, "b", "same words")] * 1000 + [(k, "c", "w " * 40) for k in range(100)]
    found = []
    for parts in (1, 7):
        df = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(parts)
        rows = mixing.mix(df).collect()
        assert len(rows) == 2100 and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
        taken = defaultdict(int)
        for r in rows:
            taken[r["target"]] += r["taken"]
        assert all(0 <= t - n <= 40 for t, n in taken.items()) and len(taken) == 3
        found.append(sorted((r["doc_id"] or -1, r["target"], r["taken"]) for r in rows))
        assert mixing.mix_documents(df).count() == sum(r["taken"] // r["size"] for r in rows)
    assert found[0] == found[1]


def test_mix_edges(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 10 and all(r["taken"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    assert mixing.mix(no_docs).count() == 0
    mixed = mixing.mix_documents(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() > 0


def test_rules_and_segmentation(spark):
    urls = [
        ("https://WWW.Example.org/es/1?x=/fr/", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("http://a.org/x#y", "a.org", "/x", "org/", "allow"), ("http://a.com/fr/1", "a.com", "/fr/1", "com/fr/", "allow"),
        ("http://org", "org", "", None, None), ("http://notorg/x", "notorg", "/x", None, None), ("x", "", "", None, None), (None, "", "", None, None),
        ("http://b.com/de/7", "b.com", "/de/7", "com/de/", "block"), ("http://example.org/en/19", "example.org", "/en/19", "example.org/en/1", "block"),
    ]
    pages = spark.createDataFrame([(k, u[0], "<p>good page words</p><script>bad</script>") for k, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages).collect()}
    for k, (_, host, path, rule, say) in enumerate(urls):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)
        assert got[k]["verdict"] == say if say else got[k]["verdict"] in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    counts = {(0, 3): 50, (3, 4): 40, (7, 4): 30, (0, 7): 1}
    assert url_filter.segment("thegoodsite", counts, 1000) == ["the", "good", "site"]


def test_bayes_learns_from_ruled_pages(spark):
    rows = [(k, f"http://casino{k}.com/de/spam/{k}", "casino spam") for k in range(30)] + [(100 + k, f"http://garden{k}.com/fr/rose/{k}", "garden rose") for k in range(30)]
    rows += [(200, "http://casinospam.net/x", ""), (201, "http://gardenrose.net/x", "")]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[200], got[201]) == ("block", "allow")
