import datetime as dt
import glob
import os
import random

from pyspark.sql import functions as F

from listwise.operators import containment as C
from listwise.operators.sequences import falls_in_order
from listwise.plans import evidence as E
from listwise.streaming import feeds as S


def test_containing_pairs_against_all_pairs(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(150)] + ["", "a", "ab", "abc"]
    left = [(rng.choice([1, 2, None]), rng.choice([None, "x"]), t) for t in texts] + [(1, None, None)]
    right = [(rng.choice([1, 2, None]), rng.choice([None, "x"]), t) for t in rng.sample(texts, 80)] + [(None, None, None)]
    a = spark.createDataFrame(left, "y int, n string, l string")
    b = spark.createDataFrame(right, "y int, n string, r string")
    got = [tuple(r) for r in C.containing_pairs(a, b, ["y", "n"], "l", "r").collect()]
    want = {(y, n, s, t) for y, n, s in left for z, m, t in right if (y, n) == (z, m) and s and t and (s in t or t in s)}
    assert len(got) == len(set(got)) and set(got) == want


def test_number_less_titles_meet_few_candidates(spark):
    """Ten thousand names against ten thousand in one block: the index emits a small share of the pairs."""
    rng = random.Random(6)
    name = lambda: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(12))
    theirs = [name() for _ in range(10000)]
    ours = [t + "JR" if k % 5 == 0 else name() for k, t in enumerate(theirs)]
    a = spark.createDataFrame([(None, t) for t in ours], "k int, long string")
    b = spark.createDataFrame([(None, t) for t in theirs], "k int, short string")
    assert C.held_in(b, a, ["k"]).count() == 2000
    assert C.met_by_rarest(b, a, ["k"]).count() < 10 ** 8 / 100


def test_falls_in_order(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, float("nan"), 1.0 * rng.randint(0, 300)]), rng.choice([None, rng.random()])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "o double, v double").repartition(9)
    groups = {}
    for o, v in rows:
        if o is not None and o == o and v is not None:
            groups.setdefault(o, []).append(v)
    order = [groups[o] for o in sorted(groups)]
    want = (len(order), sum(max(a) > min(b) for a, b in zip(order, order[1:])))
    assert tuple(falls_in_order(df, "o", "v").first()) == want
    assert tuple(falls_in_order(df, "o", "o").first()) == (len({o for o, _ in rows if o is not None and o == o}), 0)
    assert tuple(falls_in_order(df.limit(0), "o", "v").first()) == (0, 0)
    # One group in one of several ranges.
    assert tuple(falls_in_order(df.where("o = 5"), "o", "v").first())[0] == (1 if 5.0 in groups else 0)


def feed_rows(*rows):
    at = dt.datetime(2024, 1, 1)
    return [(i, at + dt.timedelta(hours=h), s, state, bids, None if end is None else at + dt.timedelta(hours=end)) for i, h, s, state, bids, end in rows]


SCHEMA = "item_id string, observed_at timestamp, seq long, state string, bid_count int, end_time timestamp"


def land(spark, home, part, rows):
    spark.createDataFrame(feed_rows(*rows), SCHEMA).coalesce(1).write.parquet(f"{home}/in/part={part}")
    feed = spark.readStream.schema(SCHEMA).parquet(f"{home}/in/part=*")
    S.alert_stream(feed, f"{home}/store", f"{home}/check", F.to_date("observed_at"), buckets=64).awaitTermination()


def versions(home):
    return {tuple(int(x.split("=")[1]) for x in path.split(os.sep)[-2:]) for path in glob.glob(f"{home}/store/held/version=*/bucket=*")}


def test_alert_state_is_rewritten_by_bucket(spark, tmp_path):
    home = str(tmp_path)
    land(spark, home, 0, [(f"i{k}", 0, k, "active", k, 10 if k == 3 else None) for k in range(40)])
    first = versions(home)
    assert len(first) > 20 and {v for v, _ in first} == {0}
    land(spark, home, 1, [("i7", 1, 100, "ended", 7, None)])
    second = versions(home)
    # One item: one bucket of the second version, and only that one.
    assert {(v, b) for v, b in second if v == 1} == second - first and len(second - first) == 1
    alerts = S.read_alerts(spark, f"{home}/store").collect()
    assert [(r.item_id, r.state, r.previous_state, r.previous_count) for r in alerts] == [("i7", "ended", "active", 7)]
    # Its end passed, item 3 is forgotten; a late row neither alerts nor replaces; item 8 is still held.
    land(spark, home, 2, [("i8", 20, 200, "active", 9, None), ("i7", 0, 5, "active", 1, None)])
    land(spark, home, 3, [("i3", 21, 300, "ended", 3, None)])
    alerts = {(r.item_id, r.state, r.bid_count, r.previous_count) for r in S.read_alerts(spark, f"{home}/store").collect()}
    assert alerts == {("i7", "ended", 7, 7), ("i8", "active", 9, 8)}
    assert [r.item_id for r in spark.read.parquet(f"{home}/store/late").collect()] == ["i7"]
    # Superseded versions go: the bucket of item 7 has none of the first batch left.
    bucket = next(b for v, b in second - first)
    assert (0, bucket) not in versions(home)


def test_alert_batch_can_be_run_again(spark, tmp_path):
    """The state that a batch reads is the one from before it, even after it has written its own."""
    home = str(tmp_path)
    land(spark, home, 0, [("a", 0, 1, "active", 1, None), ("b", 0, 2, "active", 1, None)])
    land(spark, home, 1, [("a", 1, 3, "active", 2, None)])
    before = sorted(map(tuple, S.read_alerts(spark, f"{home}/store").collect()))
    # The commit of the second batch is lost, so the stream runs it again.
    for path in (f"{home}/check/commits/1", f"{home}/check/commits/.1.crc"):
        os.remove(path)
    feed = spark.readStream.schema(SCHEMA).parquet(f"{home}/in/part=*")
    S.alert_stream(feed, f"{home}/store", f"{home}/check", F.to_date("observed_at"), buckets=64).awaitTermination()
    assert sorted(map(tuple, S.read_alerts(spark, f"{home}/store").collect())) == before and len(before) == 1


def test_import_ties_and_classes(spark):
    fields = dict(year=2018, manufacturer="PANINI", set="PRIZM", subject="LUKA DONCIC", card_number="280", parallel=None, print_run=None,
                  psa_grade="10", grade_type="NUMERIC", qualifier=None, is_auto=0, auto_grade=None)
    schema = ("item_id string, year int, manufacturer string, set string, subject string, card_number string, parallel string, print_run int, "
              "psa_grade string, grade_type string, qualifier string, is_auto int, auto_grade string")
    make = lambda *ids, **over: spark.createDataFrame([(i, *(fields | over).values()) for i in ids], schema)
    title = "2018 Panini Prizm #280 Luka Doncic PSA 10"
    rows = spark.createDataFrame([(title,), ("2018 Panini Prizm Luka Doncic PSA 9",)], "raw_title string")
    pool = make("c", "a", "b").unionByName(make("x", card_number=None, subject=None, psa_grade="3"))
    got = {r.raw_title: r for r in E.attribute(rows, pool).collect()}
    assert got[title].attribution_error == "row matches 3 candidates ambiguously"
    assert [(a.item_id, a.copies) for a in got[title].ambiguous] == [("a", 3)]
    assert got["2018 Panini Prizm Luka Doncic PSA 9"].candidate_item_id == "x"
    members = E.ambiguous_candidates(E.attribute(rows, pool), pool).collect()
    assert sorted((r.raw_title, r.candidate_item_id) for r in members) == [(title, i) for i in "abc"]
    sold = spark.createDataFrame([(7, "s1", title, "5")] * 3 + [(7, "s1", title, "6"), (8, "s1", title, "5"), (9, None, None, None)],
                                 "item_id int, source_item_id string, raw_title string, sold_price string")
    sold = sold.withColumns({"shipping": F.lit(""), "currency": F.lit(""), "sale_date": F.lit("2024-01-01"), "source": F.lit("export")})
    stored = spark.createDataFrame([], "candidate_item_id string, source string, sale_key string")
    status = [r.status for r in E.import_ledger(sold, make("a"), stored).collect()]
    assert len(status) == 6 and status.count("added") == 1 and status.count("duplicate") == 4 and status.count("unattributed") == 1


def test_sales_are_forgotten_after_the_horizon(spark, tmp_path):
    """A sale seen again within a day is dropped; one seen again after the state has gone counts anew."""
    home, schema = str(tmp_path), "sale string, ts timestamp"
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    batches = [[("a", 0), ("b", 1), ("a", 2)], [("a", 10), ("c", 60)], [("c", 61), ("d", 100)], [("a", 110), ("c", 111), ("d", 112)]]
    for n, rows in enumerate(batches):
        spark.createDataFrame([(s, at(h)) for s, h in rows], schema).coalesce(1).write.parquet(f"{home}/in/part={n}")
        feed = spark.readStream.schema(schema).parquet(f"{home}/in/part=*")
        S.first_sales(feed, "sale", "ts", "1 day").writeStream.format("parquet").option("checkpointLocation", f"{home}/check").trigger(
            availableNow=True).start(f"{home}/out").awaitTermination()
    got = sorted((r.sale, (r.ts - at(0)).total_seconds() / 3600) for r in spark.read.schema(schema).parquet(f"{home}/out").collect())
    assert [s for s, _ in got].count("a") == 2 and ("a", 110) in got and ("c", 61) not in got and [s for s, _ in got].count("b") == 1


def test_candidate_pool_of_one_list(spark, tmp_path):
    from listwise.sources import exports as X
    (tmp_path / "pool.json").write_text('[{"item_id": "a", "year": 1990, "set": "BASE", "extra": [1]},\n {"item_id": "b"}, {"year": 3}, {"item_id": "b", "year": 2001}]')
    got = {r.item_id: (r.year, r.set, r.psa_grade) for r in X.read_candidates(spark, str(tmp_path / "pool.json")).collect()}
    assert got == {"a": (1990, "BASE", None), "b": (2001, None, None)}


def test_character_references(spark):
    from listwise.functions import text as T
    texts = {"a &eacute;&nbsp;b &amp;lt; &lt;c&gt; &hearts; &#39;x&#x27; &bogus; &amp": "a é b &lt; <c> ♥ 'x' &bogus; &amp", "&AMP;&copy;&NotEqualTilde;": "&©≂̸", "plain": "plain"}
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.unescape(F.col("t")).alias("u")).collect()
    assert {r.t: r.u for r in rows} == texts


def test_as_of_against_brute_force(spark):
    from listwise.operators.asof import as_of, validity
    rng = random.Random(11)
    left = [(k, rng.choice(["a", "b", "hot", "hot", None]), rng.choice([None, rng.randint(0, 400)])) for k in range(400)]
    right = [(rng.choice(["a", "hot", "hot", "hot", None]), rng.choice([None, rng.randint(0, 400)]), rng.choice([None, "x", "y", "z"])) for _ in range(300)]
    a = spark.createDataFrame(left, "id int, k string, t int")
    b = spark.createDataFrame(right, "k string, at int, v string")
    got = {r.id: r.now_v for r in as_of(a, b, "k", "t", "at", ["v"], lambda t: (t / 50).cast("int"), "now_").collect()}

    def order(v):
        return (v is not None, v or "")

    for i, k, t in left:
        known = [(at, order(v), v) for key, at, v in right if key == k and at is not None and t is not None and k is not None and at <= t]
        assert got[i] == (max(known)[2] if known else None), (i, k, t)
    spans = [tuple(r) for r in validity(b, "k", "at", "v", lambda t: (t / 50).cast("int")).collect()]
    for key in ("a", "hot"):
        by_time = {}
        for k, at, v in right:
            if k == key and at is not None:
                by_time[at] = max(by_time.get(at, (False, "")), order(v))
        want, last = [], object()
        for at in sorted(by_time):
            value = by_time[at][1] if by_time[at][0] else None
            if value != last:
                want.append([key, value, at, None])
                last = value
        for one, after in zip(want, want[1:]):
            one[3] = after[2]
        mine = [s[1:] for s in spans if s[0] == key]
        assert len(mine) == len(want) and set(mine) == {tuple(w[1:]) for w in want}


def test_greedy_cover_against_one_row_at_a_time(spark):
    from listwise.operators.selection import greedy_shortlist
    rng = random.Random(12)
    for quota, total in ((2, 12), (3, 40), (50, 200)):
        rows = [(f"i{k:03}", rng.choice([None, *range(60)]), float(rng.randint(0, 30)), *(rng.random() < p for p in (.05, .15, .3, .4))) for k in range(300)]
        names = ["qualifier", "auto", "numbered", "rookie"]
        df = spark.createDataFrame(rows, "item_id string, slab_key int, score double, qualifier boolean, auto boolean, numbered boolean, rookie boolean")
        seed = [r for r in rows if r[0] in ("i000", "i001")]
        seed = seed if seed[0][1] != seed[1][1] else seed[:1]
        chosen, groups, covered, order = [(r[0], "seed") for r in seed], {r[1] for r in seed}, dict.fromkeys(names, 0), sorted(rows, key=lambda r: (-r[2], r[0]))
        for r in seed:
            for n, on in zip(names, r[3:]):
                covered[n] += on
        for name in [*names, None]:
            for r in order:
                if len(chosen) >= total:
                    break
                if r[1] in groups or (name and (not r[3 + names.index(name)] or covered[name] >= quota)):
                    continue
                chosen.append((r[0], name or "fill"))
                groups.add(r[1])
                for n, on in zip(names, r[3:]):
                    covered[n] += on
        got = greedy_shortlist(df, {n: F.col(n) for n in names}, quota, total, [-F.col("score")], seed=df.where(F.col("item_id").isin([r[0] for r in seed])))
        assert sorted((r.item_id, r.round) for r in got.collect()) == sorted(chosen)


def test_only_moved_rows_are_decided_again(spark):
    from listwise.plans import audit as A
    fields = dict(year=2018, manufacturer="PANINI", set="PRIZM", subject="LUKA DONCIC", card_number="280", parallel=None, print_run=None,
                  psa_grade="10", grade_type="NUMERIC", qualifier=None, is_auto=0, auto_grade=None)
    schema = ("item_id string, year int, manufacturer string, set string, subject string, card_number string, parallel string, print_run int, "
              "psa_grade string, grade_type string, qualifier string, is_auto int, auto_grade string")
    pool = lambda **grades: spark.createDataFrame([(i, *(fields | {"psa_grade": g}).values()) for i, g in grades.items()], schema)
    titles = [(k, i, f"2018 Panini Prizm #280 Luka Doncic PSA {9 + k % 2}", "") for k, i in enumerate("aabbc" * 4)]
    rows = spark.createDataFrame(titles, "row_id int, candidate_item_id string, raw_title string, raw_text string")
    rows = rows.withColumns({n: F.lit(None).cast("string") for n in ("state", "reason_code", "reason", "digest")})
    before = pool(a="10", b="9", c="10")
    assert A.stale_rows(rows, before).count() == len(titles)
    first = A.reclassified(rows, before).persist()
    full = {r.row_id: (r.state, r.reason) for r in E.classify_comps(rows.select("row_id", "candidate_item_id", "raw_title", "raw_text"), before).collect()}
    assert {r.row_id: (r.state, r.reason) for r in first.collect()} == full and A.stale_rows(first, before).count() == 0
    moved = pool(a="10", b="10")  # one candidate has changed, one is gone
    assert {r.candidate_item_id for r in A.stale_rows(first, moved).collect()} == {"b"}
    second = {r.row_id: (r.state, r.reason) for r in A.reclassified(first, moved).collect()}
    again = {r.row_id: (r.state, r.reason) for r in E.classify_comps(rows.select("row_id", "candidate_item_id", "raw_title", "raw_text"), moved).collect()}
    assert second == full | again and any(second[k] != full[k] for k in full)
    assert A.stale_rows(first, before, version="2").count() == len(titles)


def test_caps_beyond_the_group_limit(spark):
    from listwise.operators.selection import cap_per_key
    df = spark.range(6000).selectExpr("CASE WHEN id % 10 < 7 THEN 'hot' WHEN id % 10 = 9 THEN NULL ELSE 'b' END AS k", "(id * 7919) % 6007 AS o").repartition(5)
    rows = [(r.k, r.o) for r in df.collect()]
    for limit in (5, 1500):
        want = sorted(sum((sorted((r for r in rows if r[0] == k))[:limit] for k in ("hot", "b")), []) + [r for r in rows if r[0] is None], key=str)
        assert sorted(((r.k, r.o) for r in cap_per_key(df, "k", limit, ["o"]).collect()), key=str) == want


def test_a_value_meets_few_depths_of_bands(spark):
    """A value goes to the depths its deepest band can have, not to all of them; the bands are those of splitting one by one."""
    from listwise.operators import selection as X

    values = [100 * 6000 ** (i / 3000) for i in range(3000)]
    df = spark.createDataFrame([(round(v, 2),) for v in values], "v double")
    least, greatest = X._depth_range(F.col("v"), 6000.0, 23, 1.0)
    assert df.select(F.max(greatest - least)).first()[0] <= 4

    def split(depth, node):
        edge = lambda k: round(100 * 6000.0 ** (k / 2.0 ** depth), 2)
        low, high = edge(node), edge(node + 1)
        n = sum(low <= round(v, 2) < high for v in values)
        if n > 40 and high - low > 1:
            return split(depth + 1, 2 * node) + split(depth + 1, 2 * node + 1)
        return [(low, high, n, n > 40)]

    got = X.geometric_bands(df, "v", 100, 600000, ceiling=40, min_width=1.0)
    assert sorted(tuple(r) for r in got.collect()) == sorted(split(0, 0))


def test_the_ledger_holds_no_attribution_in_its_plan(spark):
    schema = ("item_id string, year int, manufacturer string, set string, subject string, card_number string, parallel string, print_run int, "
              "psa_grade string, grade_type string, qualifier string, is_auto int, auto_grade string")
    pool = spark.createDataFrame([("a", 2018, "PANINI", "PRIZM", "LUKA DONCIC", "280", None, None, "10", "NUMERIC", None, 0, None)], schema)
    sold = spark.createDataFrame([(7, "s1", "2018 Panini Prizm #280 Luka Doncic PSA 10", "5", "", "", "2024-01-01", "export")],
                                 "item_id int, source_item_id string, raw_title string, sold_price string, shipping string, currency string, "
                                 "sale_date string, source string")
    stored = spark.createDataFrame([("a", "export", "s0")], "candidate_item_id string, source string, sale_key string")
    ledger = E.import_ledger(sold, pool, stored)
    assert len(ledger._jdf.queryExecution().optimizedPlan().toString()) < 20000
    assert [r.status for r in ledger.collect()] == ["added"]


def test_queries_of_candidates_in_one_file_are_spread(spark):
    """A query text costs far more than the reading of its candidate, so one small file must not be one task."""
    row = ("a", 2018, "PANINI", "PRIZM", "LUKA DONCIC", "280", None, None, "10", "NUMERIC", None, 0, None)
    pool = spark.createDataFrame([row] * 400, ("item_id string, year int, manufacturer string, set string, subject string, card_number string, "
                                               "parallel string, print_run int, psa_grade string, grade_type string, qualifier string, is_auto int, "
                                               "auto_grade string")).coalesce(1)
    tasks = E.research_queries(pool).groupBy(F.spark_partition_id().alias("task")).agg(F.count("search_query").alias("n")).collect()
    assert sum(r.n for r in tasks) == 400 and len(tasks) >= 8
    sent = E.research_queries(pool).where("sendable")._jdf.queryExecution().optimizedPlan().toString()
    assert sent.count("aggregate(") == 1
