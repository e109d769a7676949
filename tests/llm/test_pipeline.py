from __future__ import annotations

import random


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(0)
    words = ["".join(rng.choice("abdefgh") for _ in range(5)) for _ in range(2000)]

    def text(n=60):
        return " ".join(rng.choice(words) for _ in range(n))

    rows = [(k, text(), "en", f"s{k % 3}", 1) for k in range(200)]
    item = text(30)
    rows += [(300, f"{text()} stupid idiot {text(5)}", "en", "s0", 1), (301, rows[5][1], "en", "s1", 1), (302, f"{text()} {item} {text()}", "en", "s1", 1), (303, None, None, None, None)]
    labels = [(k, 1, 0) for k in range(150)]
    for k in range(400, 440):
        rows.append((k, f"{text(20)} {rng.choice(['stupid', 'idiot'])} {text(20)}", "en", "s2", 1))
        labels.append((k, 1, 1))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"] for r in docs.collect()}
    assert not kept["toxicity"] & {300, *range(400, 440)} and kept["toxicity"] >= {*range(200), 301, 302}
    assert kept["near_duplicates"] == kept["toxicity"] - {301}
    assert kept["decontamination"] == kept["near_duplicates"] - {302}
    assert kept["mixing"] == kept["token_output"] <= kept["decontamination"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()
