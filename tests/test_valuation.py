"""Decision boundaries, guards, anomaly baselines and state changes."""

import datetime as dt
import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from listwise.operators.sequences import state_changes
from listwise.plans import groups as G
from listwise.plans import valuation as P

TODAY = dt.date(2024, 6, 30)


CASES = [
    (75.0, [100.0] * 3, {}, "BUY", "BUY_DISCOUNT_AT_OR_ABOVE_25", None),
    (75.01, [100.0] * 3, {}, "WATCH", "WATCH_DISCOUNT_10_TO_25", None),
    (90.0, [100.0] * 3, {}, "WATCH", "WATCH_DISCOUNT_10_TO_25", None),
    (90.01, [100.0] * 3, {}, "PASS", "PASS_DISCOUNT_BELOW_10", None),
    (100.0, [100.0] * 3, {}, "PASS", "PASS_AT_OR_ABOVE_MARKET", None),
    (10.0, [100.0] * 2, {}, "PASS", "INSUFFICIENT_EVIDENCE", None),
    (None, [100.0] * 3, {}, "PASS", "NO_ASKING_PRICE", None),
    (0.0, [100.0] * 3, {}, "PASS", "NO_ASKING_PRICE", None),
    (50.0, [100.0] * 3, {"active": False}, "PASS", "STALE_ASKING_PRICE", None),
    (50.0, [100.0] * 3, {"shipping": None}, "WATCH", "BUY_DISCOUNT_AT_OR_ABOVE_25", "DOWNGRADED_INCOMPLETE_COST"),
    (50.0, [100.0] * 3, {"newest": TODAY - dt.timedelta(365)}, "BUY", "BUY_DISCOUNT_AT_OR_ABOVE_25", None),
    (50.0, [100.0] * 3, {"newest": TODAY - dt.timedelta(366)}, "WATCH", "BUY_DISCOUNT_AT_OR_ABOVE_25", "DOWNGRADED_STALE_COMPS"),
    (50.0, [100.0] * 3, {"newest": None}, "WATCH", "BUY_DISCOUNT_AT_OR_ABOVE_25", "DOWNGRADED_STALE_COMPS"),
    (50.0, [100.0, 100.0, 250.0], {}, "BUY", "BUY_DISCOUNT_AT_OR_ABOVE_25", None),
    (50.0, [100.0, 100.0, 251.0], {}, "WATCH", "BUY_DISCOUNT_AT_OR_ABOVE_25", "DOWNGRADED_HIGH_DISPERSION"),
    (50.0, [100.0] * 3, {"uncertain": [20.0] * 4}, "REVIEW_REQUIRED", "UNCERTAIN_EVIDENCE_WOULD_CHANGE_THE_DECISION", None),
    (50.0, [100.0] * 3, {"uncertain": [99.0]}, "BUY", "BUY_DISCOUNT_AT_OR_ABOVE_25", None),
]


def test_decisions(spark):
    listings, comps, unsure = [], [], []
    for i, (price, totals, o, *_) in enumerate(CASES):
        newest = o.get("newest", TODAY)
        listings.append((i, f"s{i}", price, o.get("shipping", 0.0), o.get("active", True)))
        comps += [(f"s{i}", t, newest) for t in totals]
        unsure += [(f"s{i}", t, newest) for t in o.get("uncertain", ())]
    schema = "slab_key string, total_price double, sale_date date"
    df = spark.createDataFrame(listings, "i int, slab_key string, price double, shipping_cost double, active boolean")
    decided = P.decide(df, spark.createDataFrame(comps, schema), TODAY, uncertain=spark.createDataFrame(unsure, schema))
    got = {r.i: (r.decision, r.reason, r.downgrade_reason) for r in decided.collect()}
    for i, (price, totals, options, *expected) in enumerate(CASES):
        assert got[i] == tuple(expected), (price, totals, options)


def brute_baseline(members, i):
    """The definition: every other member, trimmed against the whole group's median."""
    totals = [p + (s or 0.0) for p, s in members]
    limit = 5.0 * statistics.median(totals)
    kept = [t for j, t in enumerate(totals) if j != i and t <= limit
            and not (members[j][0] >= 1000 and abs(members[j][0] - round(members[j][0] / 1000) * 1000) < 0.005)]
    if len(kept) < 2 or (min(kept) > 0 and max(kept) / min(kept) > 10):
        return None, len(members) - 1 - len(kept)
    return statistics.median(kept), len(members) - 1 - len(kept)


def test_leave_one_out_matches_pairing(spark):
    rng = random.Random(5)
    pool = [5.0, 9.0, 10.0, 10.0, 12.5, 30.0, 1000.0, 2000.0, 999.5, 75.25, 400.0]
    data = {f"g{i}": [(rng.choice(pool), rng.choice([None, 0.0, 3.5])) for _ in range(rng.randint(1, 9))] for i in range(60)}
    rows = [(g, f"{g}-{i}", p, s) for g, ms in data.items() for i, (p, s) in enumerate(ms)]
    df = spark.createDataFrame(rows, "slab_key string, item_id string, price double, shipping_cost double")
    got = {r.item_id: (r.baseline, r.trimmed) for r in G.leave_one_out_baseline(df).collect()}
    assert got == {f"{g}-{i}": brute_baseline(ms, i) for g, ms in data.items() for i in range(len(ms))}


def test_deeper_discounts_never_lose_a_buy(spark):
    rows = [(float(c), 100.0, "valued") for c in range(40, 140, 3)]
    df = spark.createDataFrame(rows, "total_cost double, benchmark_median double, population string")
    buys = [r.buy for r in P.what_if(df).orderBy("discount_pct").collect()]
    assert buys == sorted(buys)


def test_state_changes_cross_chunks(spark):
    rng = random.Random(2)
    rows = [("k", i, rng.choice("ab")) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t int, s string")
    got = {(r.t, r.previous.s) for r in state_changes(df, "k", ["t"], ["s"], F.floor(F.col("t") / 7)).collect()}
    assert got == {(b[1], a[2]) for a, b in itertools.pairwise(rows) if a[2] != b[2]}
