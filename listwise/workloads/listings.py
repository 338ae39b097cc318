"""Payloads, upserts, selection and bands over line items, events and orders."""

import datetime as dt

from pyspark.sql import functions as F

from listwise.functions import keys as K
from listwise.functions import values as N
from listwise.operators import selection as X
from listwise.operators import sequences as Q
from listwise.session import own_dir
from listwise.sources import listings as S
from listwise.workloads import base as B
from listwise.workloads.registry import query

# A listing payload as the marketplace would send it, as JSON text.
PAYLOADS_SQL = f"""{B.ITEMS_SQL},
payloads AS (SELECT *, seller % 4 AS fmt, line % 4 AS ship, CASE WHEN seller % 9 = 0 THEN 'GBP' ELSE 'USD' END AS cur,
    day + INTERVAL 5 DAY AS ends FROM items WHERE status = 'O'),
flat AS (SELECT item_id, slab_key, day, ends, quantity,
    CASE WHEN fmt <> 0 THEN price END AS price, CASE WHEN ship = 1 THEN price / 10 END AS shipping_cost,
    ['AUCTION', 'AUCTION,FIXED_PRICE', 'FIXED_PRICE,BEST_OFFER', 'FIXED_PRICE'][fmt + 1] AS buying_option,
    CASE WHEN fmt < 2 THEN price / 2 END AS current_bid_price,
    ['NOT_RETURNED', 'KNOWN', 'CALCULATED_UNKNOWN', 'NOT_RETURNED'][ship + 1] AS shipping_state,
    ['AUCTION_ONLY', 'AUCTION_WITH_FIXED_PRICE_OPTION', 'FIXED_PRICE_ONLY', 'FIXED_PRICE_ONLY'][fmt + 1] AS sale_format,
    cur = 'USD' AND NOT (ship = 1 AND seller % 5 = 0) AS usd_proven, quantity <> 50 AS single_card,
    CASE WHEN seller % 10 <> 5 THEN 'seller' || seller END AS seller FROM payloads),
listing AS (SELECT *, CASE WHEN usd_proven AND sale_format = 'FIXED_PRICE_ONLY' AND shipping_state = 'KNOWN'
                      THEN price + shipping_cost END AS acquisition_total,
    CASE WHEN usd_proven AND shipping_state = 'KNOWN' THEN current_bid_price + shipping_cost END AS provisional_bid_total FROM flat)"""


def payload_text(spark, sf):
    df = B.items(spark, sf).where("status = 'O'")
    fmt, ship, cur = F.col("seller") % 4, F.col("line") % 4, F.when(F.col("seller") % 9 == 0, "GBP").otherwise("USD")
    money = lambda value, currency=cur: F.struct(value.cast("string").alias("value"), currency.alias("currency"))
    options = (F.when(fmt == 0, F.array(F.lit("AUCTION"))).when(fmt == 1, F.array(F.lit("AUCTION"), F.lit("FIXED_PRICE")))
               .when(fmt == 2, F.array(F.lit("FIXED_PRICE"), F.lit("BEST_OFFER"))).otherwise(F.array(F.lit("FIXED_PRICE"))))
    none = F.lit(None).cast("struct<value: string, currency: string>")
    shipping = (F.when(ship == 1, F.array(F.struct(F.lit("FIXED").alias("shippingCostType"), money(
        F.col("price") / 10, F.when(F.col("seller") % 5 == 0, "EUR").otherwise("USD")).alias("shippingCost"))))
        .when(ship == 2, F.array(F.struct(F.lit("CALCULATED").alias("shippingCostType"), money(F.lit("0.00"), F.lit("USD"))
                                          .alias("shippingCost"))))
        .when(ship == 3, F.array(F.struct(F.lit("FIXED").alias("shippingCostType"), none.alias("shippingCost")))))
    # An unknown-shipping option still states its currency.
    payload = F.struct(
        F.col("item_id").alias("itemId"), F.concat(F.lit("part "), F.col("slab_key").cast("string")).alias("title"),
        F.array(F.when(F.col("quantity") == 50, "261329").otherwise("261328")).alias("leafCategoryIds"),
        options.alias("buyingOptions"), money(F.col("price")).alias("price"),
        F.when(fmt < 2, money(F.col("price") / 2)).alias("currentBidPrice"), shipping.alias("shippingOptions"),
        F.date_format(F.col("day").cast("timestamp") + F.expr("INTERVAL 5 DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("itemEndDate"),
        F.col("quantity").alias("bidCount"),
        F.struct(F.when(F.col("seller") % 10 != 5, F.concat(F.lit("seller"), F.col("seller").cast("string"))).alias("username"),
                 F.lit("99.5").alias("feedbackPercentage"), F.col("quantity").cast("string").alias("feedbackScore")).alias("seller"))
    return df.select(F.to_json(payload).alias("raw"), F.col("day").cast("timestamp").alias("fetched_at"))


def listing_rows(spark, sf):
    parsed = S.parse_payloads(payload_text(spark, sf)).where("payload_state = 'read'")
    return S.flatten_listings(parsed, F.col("fetched_at"))


_FLAT = ["item_id", "price", "shipping_cost", "buying_option", "current_bid_price", "shipping_state", "sale_format",
         "usd_proven", "single_card", "seller", "acquisition_total", "provisional_bid_total"]


@query("payload_flatten", f"WITH {PAYLOADS_SQL} SELECT {', '.join(_FLAT)}, quantity AS bid_count, quantity AS seller_feedback_score FROM listing")
def payload_flatten(spark, sf):
    return listing_rows(spark, sf).select(*_FLAT, "bid_count", "seller_feedback_score")


@query("payload_files", f"WITH {PAYLOADS_SQL} SELECT {', '.join(_FLAT)} FROM listing")
def payload_files(spark, sf):
    """The same payloads as files of one JSON object a line, read with a stated schema."""
    path = own_dir(spark)
    payload_text(spark, sf).select("raw").write.text(path)
    read = S.read_payloads(spark, path)
    return S.flatten_listings(read, F.lit("2024-01-01").cast("timestamp")).select(*_FLAT)


@query("iso_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")
def iso_dates(spark, sf):
    """Dates out of the first ten characters of an instant; every seventh is no date."""
    text = F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("2024-13-45T00:00:00Z")
    return B.table(spark, sf, "orders").select("o_orderkey", N.iso_date(text).alias("day"))


@query("currency_proof", f"WITH {PAYLOADS_SQL} SELECT usd_proven, sale_format, shipping_state, count(*) AS listings FROM listing GROUP BY ALL")
def currency_proof(spark, sf):
    return listing_rows(spark, sf).groupBy("usd_proven", "sale_format", "shipping_state").agg(F.count(F.lit(1)).alias("listings"))


@query("buying_options", f"WITH {PAYLOADS_SQL} SELECT buying_option, count(*) AS listings FROM listing GROUP BY 1")
def buying_options(spark, sf):
    return listing_rows(spark, sf).groupBy("buying_option").agg(F.count(F.lit(1)).alias("listings"))


@query("crawl_quality", f"""WITH {PAYLOADS_SQL},
twice AS (SELECT * FROM listing UNION ALL SELECT * FROM listing WHERE single_card)
SELECT count(*) AS fetched_rows, count(DISTINCT item_id) AS distinct_items, count(*) FILTER (seller IS NULL) AS missing_seller,
  count(*) FILTER (seller LIKE 'seller9%') AS foreign_seller, count(*) FILTER (NOT single_card) AS wrong_category,
  count(*) - count(DISTINCT item_id) AS duplicates,
  CASE WHEN count(*) FILTER (seller IS NULL OR seller LIKE 'seller9%') = 0 THEN 'PASS' ELSE 'FAIL' END AS seller_check,
  CASE WHEN count(*) FILTER (NOT single_card) = 0 THEN 'PASS' ELSE 'FAIL' END AS category_check FROM twice""")
def crawl_quality(spark, sf):
    rows = listing_rows(spark, sf).select("item_id", "seller", "single_card")
    allow = rows.where(~F.col("seller").startswith("seller9")).select("seller").distinct()
    return S.crawl_quality(rows.unionAll(rows.where("single_card")), allow)


@query("auction_selection", f"""WITH {PAYLOADS_SQL},
r AS (SELECT item_id, ends, slab_key, CASE WHEN sale_format NOT LIKE 'AUCTION%' THEN 'not_an_auction'
        WHEN quantity = 1 THEN 'already_discovered' WHEN slab_key % 7 = 0 THEN 'identity_already_researched' END AS why FROM listing),
f AS (SELECT slab_key, min((ends, item_id)) AS first FROM r WHERE why IS NULL GROUP BY slab_key),
c AS (SELECT slab_key, first FROM f ORDER BY first LIMIT 60)
SELECT item_id, coalesce(why, CASE WHEN first IS NULL THEN 'over_candidate_cap' WHEN first = (ends, item_id) THEN 'selected'
       ELSE 'identity_already_researched' END) AS outcome FROM r LEFT JOIN c USING (slab_key)""")
def auction_selection(spark, sf):
    rows = listing_rows(spark, sf).withColumn("part", F.substring("title", 6, 20).cast("long"))
    known = rows.where("bid_count = 1").select("item_id")
    researched = rows.where("part % 7 = 0").select("part")
    return X.bounded_selection(
        rows.select("item_id", "end_time", "part", "sale_format", "current_bid_price"), known, researched, key="part", limit=60,
        eligible_reason=X.auction_reason(F.col("sale_format"), F.col("end_time"), F.col("current_bid_price")),
        order=["end_time", "item_id"]).select("item_id", "outcome")


@query("ending_window", f"""WITH {PAYLOADS_SQL} SELECT item_id FROM listing
WHERE ends BETWEEN TIMESTAMP '1998-03-10 00:00:00' + INTERVAL 12 HOUR AND TIMESTAMP '1998-03-10 00:00:00' + INTERVAL 36 HOUR""")
def ending_window(spark, sf):
    opens, closes = N.ending_window(F.lit(dt.datetime(1998, 3, 10)).cast("timestamp"))
    return listing_rows(spark, sf).where(F.col("end_time").between(opens, closes)).select("item_id")


@query("upsert_latest", """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def upsert_latest(spark, sf):
    events = B.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    old, new = events.where("ts < '2024-01-15'"), events.where("ts >= '2024-01-15'")
    return S.upsert_latest(old, new, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("upsert_unless_worse", """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'purchase' DESC, ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def upsert_unless_worse(spark, sf):
    events = B.table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return S.upsert_unless_worse(events, ["user_id"], F.col("event_type") == "purchase", ["ts", "event_id"]).drop("ts")


@query("insert_ignore", """WITH stored AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-03'),
n AS (SELECT user_id, event_type, count(*) AS c FROM events WHERE ts >= TIMESTAMP '2024-01-03' GROUP BY ALL)
SELECT CAST(sum(c) AS BIGINT) AS incoming, count(*) FILTER (s.user_id IS NULL) AS added,
       CAST(sum(c) AS BIGINT) - count(*) FILTER (s.user_id IS NULL) AS duplicates
FROM n LEFT JOIN stored s ON s.user_id = n.user_id AND s.event_type = n.event_type""")
def insert_ignore(spark, sf):
    events = B.table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return S.insert_ignore(events.where("ts < '2024-01-03'"), events.where("ts >= '2024-01-03'"),
                           ["user_id", "event_type"], ["ts", "event_id"])[1]


@query("scoped_stale_sweep", f"""WITH {PAYLOADS_SQL},
s AS (SELECT seller, CASE WHEN day < DATE '1999-01-01' AND seller IN ('seller1', 'seller2', 'seller3') THEN 0 ELSE 1 END AS active FROM listing)
SELECT seller, active, count(*) AS listings FROM s GROUP BY ALL""")
def scoped_stale_sweep(spark, sf):
    swept = S.sweep_stale(listing_rows(spark, sf), F.lit("1999-01-01").cast("timestamp"), ["seller1", "seller2", "seller3"])
    return swept.groupBy("seller", "active").agg(F.count(F.lit(1)).alias("listings"))


@query("dedupe_transactions", """WITH k AS (SELECT o_orderkey, o_custkey,
  CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS sid, CAST(round(o_totalprice) AS BIGINT) AS price,
  strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders, range(2) t(copy))
SELECT DISTINCT coalesce(sid, 'pr') || '-' || substr(sha1(concat_ws('|', coalesce(sid, 'order of ' || o_custkey), price, '', day)), 1, 10) AS sale FROM k""")
def dedupe_transactions(spark, sf):
    orders = B.table(spark, sf, "orders")
    once = orders.select(
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey").cast("string")).alias("sid"),
        F.concat(F.lit(" Order of "), F.col("o_custkey").cast("string")).alias("title"),
        F.floor(F.col("o_totalprice") + 0.5).alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return (once.unionAll(once).select(K.transaction_key(F.col("sid"), F.col("title"), F.col("price"), F.lit(None), F.col("day"))
                                       .alias("sale")).distinct())


@query("seller_cap", f"""WITH {B.LISTINGS_SQL}, r AS (SELECT item_id, seller, row_number() OVER (PARTITION BY seller ORDER BY day, item_id) AS k FROM listings)
SELECT item_id, seller FROM r WHERE k <= 10""")
def seller_cap(spark, sf):
    return X.cap_per_key(B.listings(spark, sf).select("item_id", "seller", "day"), "seller", 10, ["day", "item_id"]).drop("day")


@query("capped_sellers", f"WITH {B.LISTINGS_SQL} SELECT seller, count(*) AS rows FROM listings GROUP BY seller HAVING count(*) > 300")
def capped_sellers(spark, sf):
    return X.capped_keys(B.listings(spark, sf), "seller", 300)


_CATEGORY = "CASE WHEN discount >= 0.095 AND line = 7 THEN 'qualifier' WHEN line = 2 THEN 'auto' WHEN seller % 7 = 0 THEN 'numbered' WHEN line = 1 THEN 'rookie' END"


@query("stratified_shortlist", f"""WITH {B.LISTINGS_SQL},
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slab_key ORDER BY price DESC, item_id DESC) AS k FROM listings) WHERE k = 1),
c AS (SELECT *, {_CATEGORY} AS category FROM one),
q AS (SELECT item_id, category, price, row_number() OVER (PARTITION BY category ORDER BY price DESC, item_id) AS k FROM c WHERE category IS NOT NULL),
p AS (SELECT item_id, category, price, 'quota' AS stage FROM q WHERE k <= 12),
f AS (SELECT item_id, category, price, 'fill' AS stage FROM c WHERE item_id NOT IN (SELECT item_id FROM p) ORDER BY price DESC, item_id LIMIT 100)
SELECT item_id, category, stage FROM (SELECT * FROM p UNION ALL SELECT * FROM f) ORDER BY stage DESC, price DESC, item_id LIMIT 100""")
def stratified_shortlist(spark, sf):
    df = B.listings(spark, sf).select("item_id", "slab_key", "price", "line", "seller", "discount")
    return X.stratified_shortlist(df, {
        "qualifier": (F.col("discount") >= 0.095) & (F.col("line") == 7), "auto": F.col("line") == 2,
        "numbered": F.col("seller") % 7 == 0, "rookie": F.col("line") == 1}, 12, 100, "price").select("item_id", "category", "stage")


_TESTS = {"qualifier": "discount >= 0.095 AND line IN (1, 7)", "auto": "line IN (2, 5, 7)", "numbered": "seller % 7 = 0", "rookie": "line IN (1, 2)"}


def _round_sql(n, name, quota, total):
    """One round of the greedy cover after rounds 0 to n - 1, all of them in ``g<n - 1>``."""
    wanted = f"SELECT * FROM r WHERE {_TESTS[name]}" if name else "SELECT * FROM r"
    left = f"{quota} - (SELECT count(*) FROM g{n - 1} WHERE {_TESTS[name]})" if name else str(total)
    return f"""f{n} AS MATERIALIZED (SELECT * EXCLUDE k, row_number() OVER (ORDER BY price DESC, item_id) AS k FROM (
    SELECT *, row_number() OVER (PARTITION BY slab_key ORDER BY price DESC, item_id) AS k FROM ({wanted}) WHERE slab_key NOT IN (SELECT slab_key FROM g{n - 1})) WHERE k = 1),
  g{n} AS MATERIALIZED (SELECT * FROM g{n - 1} UNION ALL SELECT * EXCLUDE k, '{name or 'fill'}' FROM f{n}
    WHERE k <= {left} AND k <= {total} - (SELECT count(*) FROM g{n - 1}))"""


@query("greedy_shortlist", f"""WITH {B.LISTINGS_SQL},
r AS (SELECT item_id, slab_key, price, line, seller, discount FROM listings),
g0 AS (SELECT *, 'seed' AS round FROM r WHERE slab_key IN (5, 11) AND item_id IN (SELECT min(item_id) FROM r GROUP BY slab_key)),
{', '.join(_round_sql(n, name, 12, 60) for n, name in enumerate([*_TESTS, None], 1))}
SELECT item_id, round FROM g5""")
def greedy_shortlist(spark, sf):
    df = B.listings(spark, sf).select("item_id", "slab_key", "price", "line", "seller", "discount")
    first = df.where("slab_key IN (5, 11)").groupBy("slab_key").agg(F.min("item_id").alias("item_id"))
    seed = df.join(first.select("item_id"), "item_id", "left_semi").select(*df.columns)
    tests = {name: F.expr(test) for name, test in _TESTS.items()}
    return X.greedy_shortlist(df, tests, 12, 60, [-F.col("price")], seed=seed).select("item_id", "round")


@query("bands_fixed", f"""WITH {B.LISTINGS_SQL}
SELECT CASE WHEN price < 25 THEN '0-25' WHEN price < 100 THEN '25-100' WHEN price < 500 THEN '100-500'
            WHEN price < 5000 THEN '500-5000' ELSE '5000+' END AS band, count(*) AS listings FROM listings GROUP BY 1""")
def bands_fixed(spark, sf):
    return B.listings(spark, sf).groupBy(N.price_band(F.col("price")).alias("band")).agg(F.count(F.lit(1)).alias("listings"))


_BANDS = """RECURSIVE b AS (
  SELECT 0 AS depth, 0::BIGINT AS node, 100.0::DOUBLE AS low, 600000.0::DOUBLE AS high,
    (SELECT count(*) FROM orders WHERE o_totalprice >= 100 AND o_totalprice < 600000) AS n
  UNION ALL
  SELECT depth, node, low, high, (SELECT count(*) FROM orders WHERE o_totalprice >= k.low AND o_totalprice < k.high) AS n
  FROM (SELECT depth + 1 AS depth, node * 2 + c AS node, round(100 * pow(6000::DOUBLE, (node * 2 + c) / pow(2, depth + 1)), 2) AS low,
          round(100 * pow(6000::DOUBLE, (node * 2 + c + 1) / pow(2, depth + 1)), 2) AS high
        FROM b, (VALUES (0), (1)) t(c) WHERE n > 100 AND high - low > 1) k),
bands AS (SELECT * FROM b WHERE NOT (n > 100 AND high - low > 1))"""


@query("bands_geometric", f"WITH {_BANDS} SELECT low, high, n, n > 100 AS excluded FROM bands")
def bands_geometric(spark, sf):
    return X.geometric_bands(B.table(spark, sf, "orders"), "o_totalprice", 100, 600000, ceiling=100)


@query("strided", f"""WITH {_BANDS}, o AS (SELECT *, row_number() OVER (ORDER BY low) - 1 AS i, count(*) OVER () AS c FROM bands)
SELECT low, high, n FROM o WHERE c <= 10 OR i IN (SELECT floor(j * c / 10.0) FROM range(10) t(j), (SELECT any_value(c) AS c FROM o))""")
def strided(spark, sf):
    return X.strided(X.geometric_bands(B.table(spark, sf, "orders"), "o_totalprice", 100, 600000, ceiling=100), 10).drop("excluded")


@query("alerts", """WITH e AS (SELECT event_id, user_id, ts, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS bid_count, value FROM events),
p AS (SELECT *, lag(event_type) OVER w AS previous_type, lag(ts) OVER w AS previous_ts, lag(bid_count) OVER w AS previous_count,
             lag(event_id) OVER w AS pid FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, event_type, bid_count, previous_type, previous_ts, previous_count FROM p
WHERE pid IS NOT NULL AND (event_type <> previous_type OR bid_count <> previous_count)""")
def alerts(spark, sf):
    events = B.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type",
                                                 F.get_json_object("props", "$.k").cast("int").alias("bid_count"))
    changed = Q.state_changes(events, "user_id", ["ts", "event_id"], ["event_type", "bid_count"], F.to_date("ts"))
    return changed.select("user_id", "event_id", "event_type", "bid_count", F.col("previous.event_type").alias("previous_type"),
                          F.col("previous.ts").alias("previous_ts"), F.col("previous.bid_count").alias("previous_count"))


@query("strictest_tier", """SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, ts, event_id) AS k FROM events) WHERE k = 1""")
def strictest_tier(spark, sf):
    events = B.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", F.when(
        F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).otherwise(2).alias("tier"))
    return X.strictest_tier(events, "user_id", "tier", ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("latest_run", """WITH r AS (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY o_custkey)
SELECT o_custkey AS candidate_id, o_orderkey FROM orders JOIN r USING (o_custkey) WHERE o_orderdate = d""")
def latest_run(spark, sf):
    rows = B.table(spark, sf, "orders").select(F.col("o_custkey").alias("candidate_id"), "o_orderkey", F.col("o_orderdate").alias("run_id"))
    runs = rows.select("candidate_id", "run_id", F.col("run_id").alias("updated_at"))
    return X.latest_run_rows(rows, runs).drop("run_id")


@query("latest_non_empty", """SELECT user_id, event_id, rows FROM (SELECT user_id, event_id,
  CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE 1 END AS rows, row_number() OVER (PARTITION BY user_id
  ORDER BY event_type IN ('error', 'signup'), ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def latest_non_empty(spark, sf):
    attempts = B.table(spark, sf, "events").select(
        "user_id", "event_id", "ts", F.when(F.col("event_type").isin("error", "signup"), 0).otherwise(1).alias("rows"))
    return X.latest_non_empty(attempts, "user_id", "rows", ["ts", "event_id"]).drop("ts")


@query("priority_order", f"""WITH {B.LISTINGS_SQL}, g AS (SELECT slab_key, count(*) AS n, max(price) / min(price) AS spread FROM listings GROUP BY slab_key)
SELECT slab_key, spread, slab_key % 4 = 0 AS reusable FROM g ORDER BY reusable, spread DESC, slab_key""")
def priority_order(spark, sf):
    from listwise.plans.groups import price_spread
    groups = price_spread(B.listings(spark, sf)).withColumn("reusable", F.col("slab_key") % 4 == 0)
    return groups.orderBy("reusable", F.desc("spread"), "slab_key").select("slab_key", "spread", "reusable")
