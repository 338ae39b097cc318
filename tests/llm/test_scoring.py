import math
import zlib
from collections import Counter

import numpy as np

from listwise.llm import scoring


def split(text):
    return (text or "").encode().lower().split() + [None]


def model_by_hand(rows, weights):
    """Scores of the interpolated model with given weights, from plain counters."""
    train = [split(t) for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 10]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip([0, *t], t))
    n, v = sum(one.values()), len(one)
    out = []
    for _, text in rows:
        t, total = split(text), 0.0
        for a, w in zip([0, *t], t):
            c = len(train) if a == 0 else one[a]
            x = weights[min(int(math.log2(c)) + 1, scoring.BUCKETS - 1) if c else 0]
            total += math.log10((x[0] * two[a, w] / c if c else 0) + x[1] * one[w] / max(n, 1) + x[2] / (v + 1))
        out.append(total)
    return out


def corpus(spark):
    rows = [(r.doc_id, r.text[:3000]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    return rows + [(5000, None), (5001, ""), (5002, "a A"), (5002, "a A"), (None, "the of"), (5003, "newword " * 10)]


def test_against_counters(spark, monkeypatch):
    monkeypatch.setattr(scoring, "BUNDLE_BYTES", 20_000)
    weights = []
    real = scoring.learned
    monkeypatch.setattr(scoring, "learned", lambda h: weights.append(real(h)) or weights[0])
    rows = corpus(spark)
    df = spark.createDataFrame([r + (1, 1) for r in rows], "doc_id long, text string, batch int, score int").repartition(3)
    got = scoring.score_texts(df).collect()
    train = Counter(w for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 10 for w in split(t))
    n, v = sum(train.values()), len(train)
    want = {}
    for (k, t), score in zip(rows, model_by_hand(rows, weights[0])):
        base = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split(t))
        want[k] = (k is not None and zlib.crc32(str(k).encode()) % 10 == 0, len(split(t)), sum(train[w] > 0 for w in split(t)), n, base, score)
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-12) and math.isclose(r.score, w[5], rel_tol=1e-12)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_weights():
    rng = np.random.default_rng(1)
    # A third of the tokens come from each estimate: what explains a token is far likelier under it.
    two, one = 100, 90
    rows = np.array([(3, two, 0, 300), (3, 0, one, 300), (3, 0, 0, 300), (0, 0, one, 50)])
    weights = scoring.learned(rows)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 0] == 0 and weights[0, 1] > 0.7
    assert np.allclose(weights[3], 1 / 3, atol=0.05)
    assert np.allclose(scoring.learned(np.zeros((0, 4), int)).sum(axis=1), 1)
    ratio = np.exp(rng.uniform(-10, 10, 100))
    assert (np.abs(np.log(scoring._middle(scoring._cells(ratio)) / ratio)) <= scoring.CELL / 2 + 1e-9).all()


def test_no_training_rows(spark):
    key = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    row = scoring.score_texts(spark.createDataFrame([(key, "a b")], "doc_id long, text string")).first()
    assert row.held_out and (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isclose(row.base_score, 0.0, abs_tol=1e-9)
    assert scoring.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
