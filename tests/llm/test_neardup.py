import random

import numpy as np

from listwise.llm import neardup


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    parent = {k: k for k, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(s), root(k)) for k, s in sets}


def corpus(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, shared = [], " ".join(word() for _ in range(40))
    for _ in range(25):
        base = [word() for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 12))):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [shared + " " + " ".join(word() for _ in range(15)) for _ in range(60)]
    rows += ["", None, "One", "one", "ONE\ttwo", "one two", "é x", "É x", shared] + [shared] * 30
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


def test_against_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([r + (0, "c") for r in rows], "doc_id long, text string, rep int, component string").repartition(3)
    want = brute(rows)
    got = neardup.near_duplicates(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (8, "x"), (None, "only here")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in neardup.near_duplicates(df).collect())
    assert got == [("7", 2, "7", True), ("7", 2, "7", True), ("8", 1, "8", True), ("None", 0, "None", True), ("None", 1, "None", True),
                   ("None", 2, "7", False)]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_signature_estimates_resemblance():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2 ** 63, 3000).astype(np.uint64)
    rates = []
    for _ in range(30):
        pool = rng.integers(0, 2 ** 63, 1400).astype(np.uint64)
        a, b = neardup.signature(pool[:1200]), neardup.signature(pool[200:])
        rates.append((a == b).mean())
    assert abs(np.mean(rates) - 1000 / 1400) < 0.04
