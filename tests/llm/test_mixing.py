import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from listwise.llm import mixing as mx


def targets(sizes):
    """Targets by giving and resharing in rounds, from {source: size}."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, stopped, left = dict.fromkeys(order, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9:
        free = [s for s in order if s not in stopped]
        share = left / sum(weight[s] for s in free)
        left = 0.0
        for s in free:
            target[s] += share * weight[s]
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                stopped.add(s)
    return target


def documents(spark, rows):
    return spark.createDataFrame([(*r, "r", 1) for r in rows], "doc_id long, text string, source string, rank string, block int")


def odd_rows(seed=2):
    rng = random.Random(seed)
    rows = []
    for k, (source, n) in enumerate([("a", 200), ("b", 60), (None, 90), ("é", 3), ("c", 400), ("", 20), ("z", 1)]):
        for i in range(n):
            text = rng.choice([None, "", " \n", " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([1, 3, 70, 200, 900])))])
            rows.append((rng.choice([1000 * k + i, 1000 * k + i, 5, None]), text, source))
    return rows + [(77, "one two\tthree\x0bfour", "a")] * 50


def size_of(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def test_targets_shares_and_caps(spark):
    rows = odd_rows()
    got = mx.taken(mx.mix(documents(spark, rows).repartition(7))).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size_of(t)) for i, t, _ in rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    want = targets(sizes)
    by_target = defaultdict(lambda: [0, None])
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_target[(r.source_size, r.target)][0] += r.taken
    assert sorted(by_target) and len(by_target) == len(want)
    for source, target in want.items():
        (size, shown), (words, _) = min(by_target.items(), key=lambda x: (abs(x[0][0] - sizes[source]), abs(x[0][1] - target)))
        assert size == sizes[source] and abs(shown - target) < 1e-6 * max(1, target)
        assert abs(words - target) <= 2 * mx.BLOCK
        if abs(target - 3 * size) < 1e-6:
            assert words == 3 * size


def test_reruns_agree(spark):
    df = documents(spark, odd_rows(3))
    one, two = (sorted(map(tuple, mx.taken(mx.mix(df.repartition(n))).collect()), key=str) for n in (3, 11))
    assert one == two


def test_pieces_are_the_texts(spark):
    """Every slot holds the words of one block, and a source is gone through before any block comes again."""
    texts = {i: " ".join(f"{s}{i}w{k}" for k in range(n)) for i, (s, n) in enumerate([("p", 300), ("p", 5), ("p", 64), ("q", 700), ("q", 1)])}
    df = documents(spark, [(i, t, t[0]) for i, t in texts.items()])
    mix = mx.mix(df)
    sources = {r["rank"]: r for r in mix.sources.collect()}
    stream = {1: [w for i in (0, 1, 2) for w in texts[i].split()], 2: [w for i in (3, 4) for w in texts[i].split()]}
    slots = defaultdict(list)
    for r in mx.mixed_pieces(mix).orderBy("rank", "j", "place").collect():
        slots[r["rank"], r.j, r.block] += texts[r.doc_id].split()[r.from_word:r.from_word + r.words]
    for (rank, _, block), words in slots.items():
        assert words == stream[rank][block * mx.BLOCK:(block + 1) * mx.BLOCK]
    for rank, source in sources.items():
        taken = [b for (k, j, b) in sorted(slots) if k == rank]
        assert len(taken) == source.quota
        for at in range(0, len(taken), source.blocks):
            assert len(set(taken[at:at + source.blocks])) == len(taken[at:at + source.blocks])


def test_permutations(spark):
    rows = spark.createDataFrame([(n, e) for n in (1, 2, 3, 64, 1000) for e in range(3)], "n long, e int")
    rows = rows.withColumn("keys", mx.round_keys(F.lit(4), F.col("e"), F.col("n"))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    found = defaultdict(list)
    for r in rows.withColumn("p", mx.permuted(F.col("i"), F.col("n"), F.col("keys"))).orderBy("n", "e", "i").collect():
        found[r.n, r.e].append(r.p)
    assert all(sorted(p) == list(range(n)) for (n, _), p in found.items())
    assert len({tuple(found[1000, e]) for e in range(3)}) == 3 and found[1000, 0] != list(range(1000))
    # Neighbours land far apart.
    p = found[1000, 1]
    assert sum(abs(a - b) < 20 for a, b in zip(p, p[1:])) < 100


def test_draws_are_multinomial_and_settle(spark):
    sources = spark.createDataFrame([(1, 60000), (2, 20000), (3, 0), (4, 20000)], "rank long, quota long")
    counts = mx.drawn(sources, 100000, shard=1000)
    rows = counts.collect()
    per_shard = Counter()
    for r in rows:
        per_shard[r.shard] += r.n
    assert len(per_shard) == 100 and set(per_shard.values()) == {1000}
    for rank, p in ((1, 0.6), (2, 0.2), (4, 0.2)):
        ns = [r.n for r in rows if r["rank"] == rank]
        mean = sum(ns) / 100
        variance = sum((n - mean) ** 2 for n in ns) / 99
        assert abs(mean - 1000 * p) < 8 and 0.6 < variance / (1000 * p * (1 - p)) < 1.6
    slots = mx.settled(counts, sources, 100000).collect()
    numbers = defaultdict(list)
    for r in slots:
        numbers[r["rank"]].append(r.j)
    assert {k: sorted(v) for k, v in numbers.items()} == {1: list(range(60000)), 2: list(range(20000)), 4: list(range(20000))}
    assert Counter(r.shard for r in slots) == per_shard


def test_empty_blank_and_long(spark):
    schema = "doc_id long, text string, source string"
    assert mx.taken(mx.mix(spark.createDataFrame([], schema))).collect() == []
    blank = mx.taken(mx.mix(spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, " ", None)], schema))).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in blank] == [(0, 0, 0.0, 0)] * 3
    long = mx.taken(mx.mix(spark.createDataFrame([(1, "w " * 10 ** 6, "a"), (2, "v", "b")], schema))).collect()
    assert {(r.doc_id, r.size) for r in long} == {(1, 10 ** 6), (2, 1)} and {r.taken for r in long if r.doc_id == 2} == {3}
