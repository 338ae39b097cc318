import random

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    word = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    texts = {1: " ".join(word[:60]), 2: " ".join(word[:60]), 3: " ".join(word[:59]) + " changed", 4: "!!! 123", 5: None,
             6: " ".join(word[100:160])}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    texts[7] = " ".join(word[200:230]) + " " + bench + " " + " ".join(word[230:260])
    for k in range(10, 16):
        texts[k] = f"This line stands in {k} documents of them all\n" + " ".join(word[200 + 10 * k:240 + 10 * k][:40]) + f" end{chr(100 + k)}"
    docs = spark.createDataFrame([(k, t, "en", "s", len(t) if t else None) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF).persist()
        seen[name] = {r.doc_id for r in out.select("doc_id").distinct().collect()}
        if name != "packing":
            assert out.columns == list(pipeline.COLUMNS)
            assert out.where(F.length("text") != F.col("n_chars")).count() == 0
        docs = out
    assert seen["language_id"] == set(texts) - {4, 5}
    assert seen["line_dedup"] == seen["language_id"]
    assert seen["near_dedup"] == seen["line_dedup"] - {2, 3}
    assert seen["decontamination"] == seen["near_dedup"] - {7} == seen["packing"]


def test_run_over_documents(spark):
    rows = pipeline.run(spark, SF).collect()
    assert rows and [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    whole = {}
    for r in rows:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert all(whole[r.doc_id] == r.doc_tokens for r in rows)


def test_language_id_decides(spark):
    rng = random.Random(3)
    junk = {k: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(300))
            for k, letters in ((-1, "abcdefghijklmnopqrstuvwxyz"), (-2, "bcdfghjklmnpqrstvwxz"), (-3, "日本語天地人山川"))}
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*pipeline.COLUMNS)
    extra = spark.createDataFrame([(k, t, None, "s", len(t)) for k, t in junk.items()], clean.schema)
    kept = {r.doc_id for r in pipeline.language_id(spark, clean.unionByName(extra), SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in clean.where(F.col("text").rlike("\\p{L}")).select("doc_id").collect()}
    unlabelled = extra.unionByName(spark.createDataFrame([(1, "some text", None, "s", 9), (2, "12 !!", None, "s", 5), (3, None, None, "s", None)], clean.schema))
    assert {r.doc_id for r in pipeline.language_id(spark, unlabelled, SF).collect()} == {-1, -2, -3, 1}
