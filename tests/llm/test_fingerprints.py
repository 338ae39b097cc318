import hashlib

import numpy as np
from pyspark.sql import functions as F

from listwise.llm import fingerprints as fp


def shingles(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def edited(text, after):
    k = len(text) // 3
    return text[:len(text) - k] + after[:k]


def test_exact_below_k(spark):
    rng = np.random.default_rng(3)
    texts = {i: " ".join(rng.choice(list("abcdé"), rng.integers(0, 40))) for i in range(0, 120, 3)}
    texts[200], texts[201], texts[202] = "", " \n ", "one two"
    rows = [(k, t or None, "s", "h") for k, t in texts.items()] + [(30, texts[30], "s", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sketch string, head string").repartition(5)
    got = {r.doc_id: r for r in fp.compare_edited(df).collect()}
    assert len(got) == len(texts)
    order = sorted(texts, reverse=True)
    for k, after in zip(order, order[1:] + order[:1]):
        new = edited(texts[k], texts[after])
        r = got[k]
        assert (r.n_chars, r.edited_sha256) == (len(texts[k]), hashlib.sha256(new.encode()).hexdigest())
        assert abs(r.near_edited - likeness(texts[k], new)) < 1e-9 and abs(r.near_next - likeness(texts[k], texts[after])) < 1e-9


def test_followers_over_many_partitions(spark):
    ids = [int(x) for x in np.random.default_rng(5).choice(10 ** 6, 500, replace=False)]
    keys = spark.createDataFrame([(i,) for i in ids] + [(None,), (ids[0],)], "v long").select(F.struct("v").alias("key")).repartition(7)
    got = {r.key.v: r.next.v for r in fp.followers(keys).collect()}
    order = sorted(ids, reverse=True) + [None]
    assert got == dict(zip(order, order[1:] + order[:1]))


def test_merge_and_estimates(spark):
    words = [f"w{i}" for i in range(6000)]
    parts = [(1, " ".join(words[:4000])), (1, " ".join(words[3000:])), (2, " ".join(words)), (3, " ".join(words[:3004]))]
    df = fp.sketched(spark.createDataFrame(parts, "k int, text string"), "text", "sketch")
    merged = fp.merged(df, ["k"])
    one, two, three = (r.sketch for r in merged.orderBy("k").collect())
    assert one == two
    row = spark.createDataFrame([(two, three)], "a array<bigint>, b array<bigint>").select(
        fp.resemblance(F.col("a"), F.col("b")).alias("r"), fp.containment(F.col("b"), F.col("a")).alias("c"),
        fp.distinct_count(F.col("a")).alias("n")).first()
    assert abs(row.r - 0.5) < 0.2 and row.c > 0.7 and abs(row.n - 5996) < 2500


def test_empty(spark):
    assert fp.compare_edited(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    alone = fp.compare_edited(spark.createDataFrame([(None, "a b c d e f g h")], "doc_id long, text string")).first()
    assert alone.doc_id is None and alone.near_next == 1.0
