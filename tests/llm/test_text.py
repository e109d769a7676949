from __future__ import annotations

import gc
import math
import random
import weakref
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera.llm import decontam, langid, lm_score, tokens, toxicity

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def test_word_encoder_equals_the_tokenizer():
    whole, words = tokenizers.Tokenizer.from_file(PATH), tokens.WordEncoder(PATH)
    rng = random.Random(0)
    texts = ["<|endoftext|> a<|endoftext|>b <|ENDOFTEXT|>, x.", "It's, don't. 'tis e'S", "İx ŉ. ß, É. éa, ́b á. ,. a.b, 12. ３. …, é, ½. ª ΣΑΣ.", "", " \n", "a" * 3000, "中文。, 中.  x"]
    texts += ["".join(rng.choice("aAéß,. '!#\n\t…1<|>") for _ in range(60)) for _ in range(300)]
    flat, counts = words.encode(pa.array(texts), 2)
    assert flat.tolist() == [i for t in texts for i in [*whole.encode(t, add_special_tokens=False).ids, 2]]
    assert counts.sum() == len(flat)


def test_token_files(spark, odd_docs, no_docs):
    whole = tokenizers.Tokenizer.from_file(PATH)
    got, path = tokens.token_files(odd_docs, PATH)
    rows = sorted(got.collect(), key=lambda r: r["start"])
    texts = sorted(((r["doc_id"], r["text"] or "") for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for r, (doc_id, text) in zip(rows, texts, strict=True):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    file = next(f for f in (path + "/").removeprefix("file:") and __import__("pathlib").Path(path.removeprefix("file:")).glob("*.parquet"))
    column = pq.ParquetFile(file).metadata.row_group(0).column(3)
    assert column.has_dictionary_page and column.has_offset_index
    assert tokens.token_files(no_docs, PATH)[0].count() == 0


def test_language(spark, odd_docs, no_docs):
    words = {"en": ["the", "and", "house", "which", "there"], "de": ["und", "nicht", "straße", "schön", "ich"], "fr": ["être", "où", "çà", "maison", "quelle"]}
    rng = random.Random(0)
    docs = spark.createDataFrame([(k, " ".join(rng.choice(words[lang]) for _ in range(20)), lang) for k in range(300) for lang in [list(words)[k % 3]]], "doc_id long, text string, lang string")
    rows = langid.identify(docs).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 40 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.99 * len(held)
    odd = {r["doc_id"]: r for r in langid.identify(odd_docs).collect()}
    assert all(odd[k]["lang_pred"] == "und" and odd[k]["score"] == 0 for k in (3, 4, 5, 8)) and odd[6]["lang_pred"] == "en"
    assert langid.identify(no_docs).count() == 0


def test_toxicity(spark, odd_docs, no_docs):
    rng = random.Random(0)
    clean = ["".join(rng.choice("abdefgh") for _ in range(5)) for _ in range(400)]
    bad = ["stupid", "moronic", "worthless"]
    rows, labels = [], []
    for k in range(600):
        words = [rng.choice(clean) for _ in range(rng.randint(10, 200))]
        if k % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    rows += [(1000, "abdef worthles gabde"), (1001, "ebbgd stupiid haged"), (1002, "abdef haged")]
    labels.append((1, None))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    held = [r for r in got.values() if r["held_out"] and r["doc_id"] < 600]
    assert len(held) > 60 and sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)
    assert (got[1000]["predicted"], got[1001]["predicted"], got[1002]["predicted"]) == (1, 1, 0)  # misspellings that no label showed
    odd = toxicity.score_toxicity(odd_docs, labels)
    assert odd.count() == 10 and odd.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    kept = toxicity.drop_toxic(odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() == 10


def test_lm_query_uses_contexts_of_two_words(spark, tmp_path):
    texts = ["a b c", "a b c", "x b d", "y b d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in lm_score.op6_lm_score(spark, str(tmp_path)).collect()}
    # others have 9 words, one "a", one "a b" and one "a b c": S(c | a b) is 1, by bigrams it would be 1 / 3
    assert got[0] == pytest.approx(math.log(1 / 9))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_against_counters(spark, monkeypatch, order):
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 300)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "The", "cat", "sat", "on", "mat", f"w{rng.randint(0, 99)}"]) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, "", " ", "once"]
    got = {r["doc_id"]: r for r in lm_score.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), order).collect()}
    docs = [(t or "").lower().split() for t in texts]
    grams = [Counter(tuple(d[i : i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1)) for d in docs]
    total = sum(grams, Counter())
    size = sum(map(len, docs))
    for k, d in enumerate(docs):
        def c(gram):
            return total[gram] - grams[k][gram]

        def s(i, n):
            gram = tuple(d[i - n + 1 : i + 1])
            if n == 1:
                return math.log(c(gram) / (size - len(d))) if c(gram) else math.log(0.4 / (size - len(d) + 1))
            return math.log(c(gram) / c(gram[:-1])) if c(gram) else math.log(0.4) + s(i, n - 1)

        assert got[k]["n_words"] == len(d)
        assert got[k]["score"] == pytest.approx(sum(s(i, min(order, i + 1)) for i in range(len(d))))
        assert (got[k]["score_per_word"] is None) == (not d)


def test_lm_edges(odd_docs, no_docs):
    assert lm_score.score_documents(odd_docs).count() == 10 and lm_score.score_documents(no_docs).count() == 0


def test_leaks_against_brute_force(spark, odd_docs, no_docs):
    rng = random.Random(5)

    def text(n):
        return " ".join(rng.choice("bcdfg") + rng.choice("aeiou") + rng.choice("lmnrst") + str(rng.randint(0, 60)) for _ in range(n))

    items = [(k, f"{text(rng.choice([3, 12, 30, 70, 200]))}. {text(8)}.") for k in range(80)] + [(80, None), (81, ""), (None, "zq zx zw of no document")]
    rows = []
    for k in range(150):
        parts = [text(rng.randint(0, 300))]
        if k % 3 == 0:
            words = items[k % 80][1].split()
            if k % 2:
                words[len(words) // 2] = "changed"
            parts += [" ".join(words), text(40)]
        rows.append((k, " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t in rows:
        have = decontam.shingles(decontam.words_of(t))
        for i, x in items[:80]:
            own = decontam.shingles(decontam.words_of(x))
            if len(own & have) / len(own) >= 0.8:
                want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()}
    assert got == want and len(want) >= 40
    kept = {r["doc_id"] for r in decontam.drop_leaks(docs, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}
    assert decontam.find_leaks(odd_docs, bench).count() == 0 and decontam.find_leaks(no_docs, bench).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0 and decontam.drop_leaks(odd_docs, bench.limit(0)).count() == 10


def test_index_in_shards(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_POSTINGS", 20)
    bench = spark.createDataFrame([(k, f"a{k} b{k} c{k} d{k} e{k} f{k}. g{k} h{k}.") for k in range(12)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"x y a{k} b{k} c{k} d{k} e{k} f{k} g{k} h{k} z") for k in range(12)], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench).collect()} == {(k, k) for k in range(12)}


def test_one_shard_at_a_time(spark, monkeypatch):
    """No shard is alive in the driver once it is broadcast and the next is asked for."""
    monkeypatch.setattr(decontam, "MAX_POSTINGS", 20)
    alive, most, made = weakref.WeakSet(), [], decontam.Index.__init__

    def init(self, *args):
        made(self, *args)
        gc.collect()
        alive.add(self)
        most.append(len(alive))

    monkeypatch.setattr(decontam.Index, "__init__", init)
    bench = spark.createDataFrame([(k, f"a{k} b{k} c{k} d{k} e{k} f{k}. g{k} h{k}.") for k in range(12)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    decontam.find_leaks(docs, bench)
    assert len(most) > 2 and max(most) <= 2


@pytest.mark.parametrize("changed", [[7], [5, 10], [2, 9]])
def test_edited_items_are_leaks(spark, tmp_path, changed):
    item = [f"q{k}" for k in range(12)] + [f"a{k}" for k in range(6)]
    words = ["other" if k in changed else w for k, w in enumerate(item)]
    rows = [(1, " ".join(["x", "y", *words, "z"])), (2, " ".join(reversed(item))), (3, " ".join(item[:9]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, f"{' '.join(item[:12])}. {' '.join(item[12:])}.")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [(r["doc_id"], r["item_id"]) for r in decontam.op10_decontaminate(spark, str(tmp_path)).collect()] == [(1, 5)]
    docs, bench = (spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("documents", "benchmark"))
    assert {r["doc_id"] for r in decontam.drop_leaks(docs, bench, edited=True).collect()} == {2, 3}


def test_items_without_an_id_are_searched_for(spark):
    rng = random.Random(4)
    item = " ".join(f"word{rng.randint(0, 500)}" for _ in range(40))
    docs = spark.createDataFrame([(1, f"before {item} after"), (2, "other words"), (None, item)], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (2**60 + 1, item)], "item_id long, text string")
    assert sorted(((r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, items).collect()), key=repr) == sorted([(1, None), (1, 2**60 + 1), (None, None), (None, 2**60 + 1)], key=repr)
    assert [r["doc_id"] for r in decontam.drop_leaks(docs, items.filter("item_id IS NULL")).collect()] == [2]
