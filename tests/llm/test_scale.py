"""What must hold at any size: rows that grow with the input, bounds on what is in hand, names that clash."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam, lm_score, mixing, simhash, suffix_dedup, tokens, toxicity, url_filter
from tessera.llm.common import Bitmap, hot_safe_left_join


def _texts(n: int) -> list[str]:
    rng = random.Random(n)
    return [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(40)) for _ in range(n)]


def test_lm_rows_grow_with_the_corpus(spark, monkeypatch):
    """Batches and parts both grow with the input, their pairs do not."""
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 300)
    rows = []
    for n in (50, 200):
        docs = spark.createDataFrame(list(enumerate(_texts(n))), "doc_id long, text string")
        rows.append(lm_score.exploded(lm_score.batches_of(docs), 3, 20 * n).count())
    assert rows[0] > 1000 and rows[1] <= 4.4 * rows[0]


def test_anchors_of_a_text_cut_into_chunks(monkeypatch):
    """Each window has an anchor, the same for equal windows, wherever chunks end."""
    rng = random.Random(1)
    text = "".join(rng.choice("abcd ") for _ in range(3000)).encode()
    whole = {}
    for chunk in (1 << 20, 512, 1):
        if chunk == 1 and len(text) > 1500:
            text = text[:1500]
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        found = {}
        for lead, key, place, o1, o2, _, _ in suffix_dedup.anchors(text):
            for row in range(len(key)):
                assert bytes(lead[row]) == text[place[row] : place[row] + suffix_dedup.LEAD]
                for o in range(o1[row], o2[row] + 1):
                    found[int(place[row]) - o] = (int(key[row]), o)
        assert sorted(found) == list(range(len(text) - suffix_dedup.LENGTH + 1))
        whole = whole or found
        assert all(whole[k] == v for k, v in found.items())


def test_bitmap_and_null_keys(spark):
    rows = spark.range(1000).select(F.xxhash64("id").alias("h"), "id")
    keys = rows.filter("id % 10 = 0").select("h")
    b = Bitmap(keys, F.col("h"))
    may, not_ = b.split(rows, "h"), b.split(rows, "h", may=False)
    assert may.filter("id % 10 = 0").count() == 100 and may.count() + not_.count() == 1000 and not_.count() > 850
    assert b.mark(rows, F.col("h")).filter("may").count() == may.count()
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    got = hot_safe_left_join(left, spark.createDataFrame([("a", 7)], "k string, y int"), "k")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", 1, 7), (None, 2, None), ("b", 3, None)], key=repr)


@pytest.fixture(scope="module")
def clashing(spark):
    names = ["toxic", "row", "rid", "stays", "may", "leaks", "__target", "__size", "__h", "__sid", "__whole", "__cut0", "score", "size", "h"]
    rows = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(20)), "en", "a", 1) for k in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    return rows.withColumns({n: F.lit(n) for n in names})


def test_stages_keep_columns_of_any_name(spark, clashing):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 0), (3, 1)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    items = spark.createDataFrame([(1, "some item of a benchmark that no document holds at all")], "item_id long, text string").withColumn("term", F.lit(1))
    assert toxicity.score_toxicity(clashing, labels).count() == 6
    for out in (toxicity.drop_toxic(clashing, labels.limit(0)), simhash.drop_near_duplicates(clashing), decontam.drop_leaks(clashing, items, edited=True), mixing.mix_documents(clashing)):
        assert out.columns == clashing.columns and out.filter("toxic = 'toxic' AND `__target` = '__target' AND row = 'row'").count() == 6


def test_url_with_a_very_long_name(spark):
    """A name of many letters costs rows in proportion to its length, and judges like any other."""
    pages = [(k, f"http://casino{k}.com/de/spam/{k}", "casino spam") for k in range(5)] + [(10 + k, f"http://garden{k}.com/fr/rose/{k}", "garden rose") for k in range(5)]
    pages += [(99, "http://x.net/" + "casino" * 5000, ""), (99, "http://x.net/" + "casino" * 5000, ""), (100, "http://x.net/", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"word": F.lit("w"), "site": F.lit(1), "name": F.lit(2)})
    rows = url_filter.judge_urls(df).collect()
    assert len(rows) == 13 and [r["verdict"] for r in rows if r["page_id"] == 99] == ["block", "block"]


def test_reading_counts_leaves_ids_alone(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(_texts(50))), "doc_id long, text string")
    path = tokens.token_files(docs)[1]
    plan = spark.read.parquet(path).select("doc_id", "n_tokens").filter("doc_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1] and "EqualTo(doc_id,7)" in plan


def test_training_holds_the_grams_of_few_words_at_a_time(monkeypatch):
    """Besides the vectors, training holds four bytes for each n-gram of the vocabulary and what a block of words needs."""
    import tracemalloc

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(16)) for _ in range(40_000)]
    texts = [" ".join(words[at : at + 100]).encode() for at in range(0, len(words), 100)]
    grams = toxicity.word_grams([w.encode() for w in words])[1].sum()
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 1000)
    tracemalloc.start()
    toxicity.train(texts, toxicity.np.arange(len(texts)) % 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * 4 * toxicity.BUCKETS * toxicity.DIM + 8 * grams


def test_thresholds_count_their_small_side_once(spark, monkeypatch):
    from tessera.llm import common

    counted, is_small = [], common.is_small
    for module in (common, mixing):
        monkeypatch.setattr(module, "is_small", lambda *a: counted.append(1) or is_small(*a), raising=False)
    rows = spark.range(300).selectExpr("id % 2 AS sid", "shiftrightunsigned(xxhash64(id), 4) AS h", "cast(1 AS bigint) AS size")
    budgets = spark.createDataFrame([(0, 70.0), (1, 500.0)], "sid long, budget double")
    found = {r["sid"]: r for r in mixing.thresholds(rows, budgets).collect()}
    assert found[0]["used"] == 70 and rows.filter("sid = 0").filter(F.col("h") < found[0]["cut"]).count() == 70
    assert found[1]["used"] is None and found[1]["cut"] == 1 << 60
    assert len(counted) == 1
