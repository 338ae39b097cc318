"""Order statistics against brute force."""

import random
import statistics

import pytest

from pyspark.sql import functions as F

from listwise.operators import order_stats as O


def groups(seed=3):
    rng = random.Random(seed)
    out = {"hot": [rng.choice([rng.uniform(-5, 900), 10.0, 10.0, 250.25]) for _ in range(400)],
           "pair": [4.0, 2.0], "one": [7.5], "ties": [3.0] * 9 + [1.0], "niemann": [49.99, 219.99, 249.99, 249.99, 255.0]}
    return {**out, **{f"g{i}": [round(rng.lognormvariate(3, 2), 2) for _ in range(rng.randint(1, 30))] for i in range(20)}}


def frame(spark, data):
    return spark.createDataFrame([(k, v) for k, vs in data.items() for v in [*vs, None]], "k string, v double")


def test_median_min_max(spark):
    data = {**groups(), "empty": []}
    got = {r.k: r for r in O.group_median(frame(spark, data), ["k"], "v", "mid", "n", lowest="low", highest="high",
                                          newest={"last": "v"}).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k].n == len(vs)
        if vs:
            assert (got[k].mid, got[k].low, got[k].high, got[k].last) == (statistics.median(vs), min(vs), max(vs), max(vs))
        else:
            assert got[k].mid is None


def test_exclusive_quartiles(spark):
    data = groups()
    got = {r.k: r for r in O.exclusive_quartiles(frame(spark, data), ["k"], "v").collect()}
    for k, vs in data.items():
        if len(vs) < 2:
            assert got[k].p25 is None
            continue
        q = statistics.quantiles(vs, n=4)
        assert got[k].p25 == pytest.approx(q[0], abs=1e-9) and got[k].p75 == pytest.approx(q[2], abs=1e-9)
    assert got["niemann"].p25 == pytest.approx(134.99) and got["niemann"].p75 == pytest.approx(252.495)


def test_value_rank(spark):
    data = groups()
    df = frame(spark, data)
    flat = sorted(v for vs in data.values() for v in vs)
    for keys in (["k"], []):
        for r in O.with_value_rank(df, keys, "v").collect():
            pool = data[r.k] if keys else flat
            assert r["rank"] == (None if r.v is None else 1 + sum(x < r.v for x in pool))


def test_bins_never_step_down(spark):
    values = sorted(random.Random(1).uniform(-1e6, 1e6) for _ in range(5000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    bins = [r.b for r in df.select("i", O.value_bin(df["v"]).alias("b")).orderBy("i").collect()]
    assert bins == sorted(bins)


@pytest.mark.parametrize("copies", [1, 400])
def test_nan_is_no_value(spark, copies):
    """Whatever the size of the group."""
    df = spark.createDataFrame([("a", v) for v in [1.0, 2.0, 3.0] * copies + [float("nan")] * 2], "k string, v double")
    row = O.group_median(df, ["k"], "v").first()
    assert (row.n, row["median"]) == (3 * copies, 2.0)
    assert {(r.v, r["rank"]) for r in O.with_value_rank(df, ["k"], "v").where("v = 2.0").collect()} == {(2.0, copies + 1)}
    assert O.with_value_rank(df, [], "v").where("isnan(v) AND rank IS NOT NULL").count() == 0


def test_table_as_one_group(spark):
    df = frame(spark, {"a": [5.0, 1.0], "b": [3.0]})
    assert [(r.n, r["median"]) for r in O.group_median(df, [], "v").collect()] == [(3, 3.0)]
    assert O.group_median(df.limit(0), [], "v").count() == 0


def test_dense_bin_is_cut(spark, monkeypatch):
    """Distinct doubles inside a hundredth of a percent, which all fall into one bin or two; values far denser in one place; ties."""
    monkeypatch.setattr(O, "DENSE", 200)
    rng = random.Random(8)
    values = [100 + k * 1e-8 for k in range(4000)] + [100.002 + k * 1e-13 for k in range(3000)] + [100.001] * 500 + [-100 - k * 1e-8 for k in range(3000)]
    rng.shuffle(values)
    df = spark.createDataFrame([(None if k % 3 else "a", v) for k, v in enumerate(values)], "k string, v double").repartition(5)
    for key in (None, "a"):
        mine = sorted(v for k, v in enumerate(values) if (None if k % 3 else "a") == key)
        row = O.order_statistics(df, ["k"], "v", {"q1": lambda n: F.floor(n / 4), "lo": O.LOWER_MEDIAN, "hi": O.UPPER_MEDIAN, "top": O.LARGEST}, lowest="least", cuts=2).where(
            F.col("k").eqNullSafe(F.lit(key))).first()
        n = len(mine)
        assert (row.n, row.q1, row.lo, row.hi, row.top, row.least) == (n, mine[n // 4], mine[(n - 1) // 2], mine[n // 2], mine[-1], mine[0])
    ranks = {r.v: r.r for r in O.with_value_rank(df.drop("k"), [], "v", "r", cuts=2).collect()}
    below, seen = {}, 0
    for v in sorted(values):
        below.setdefault(v, seen + 1)
        seen += 1
    assert ranks == below


def test_ten_million_values_in_one_bin(spark):
    """The exact median of ten million distinct doubles inside 0.01 %, and no running sum over a million of them."""
    n = 10_000_000
    df = spark.range(n, numPartitions=16).select((100 + F.col("id") * 1e-9).alias("v"))
    counts = O._value_counts(df.select(F.col("v").alias("__v")), [])
    row = O.group_median(df, [], "v", cuts=2).first()
    want = sorted((100 + (n // 2 - 1) * 1e-9, 100 + n // 2 * 1e-9))
    assert row.n == n and row.median == sum(want) / 2
    bins = O._bin_offsets(counts, []).agg(F.max("__distinct").alias("most")).first().most
    assert bins > 1_000_000 and bins * 4 / min(O.PARTS, -(-bins * 4 // O.DENSE)) <= 4 * O.DENSE < 1_000_000
