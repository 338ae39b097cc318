"""Valuation and reporting over the line items."""

from pyspark.sql import functions as F

from listwise import fixed_values as V
from listwise.operators import order_stats as O
from listwise.plans import valuation as P
from listwise.plans.peers import cheapest_eligible
from listwise.workloads import base as B
from listwise.session import settle
from listwise.workloads.registry import query

DECISION_COLUMNS = ["item_id", "slab_key", "comp_count", "confidence", "total_cost", "cost_complete",
                    "median_total", "min_total", "max_total", "dispersion", "most_recent_sale",
                    "gross_gap", "gross_pct", "decision", "reason", "downgrade_reason"]
_COLUMNS_SQL = ", ".join(DECISION_COLUMNS)
BENCH = f"WITH {B.BASE_SQL}, {B.benchmark_sql('bench', 'accepted')}"
DECIDED = f"{BENCH}, {B.decided_sql('decided', 'bench')}"


# Sales in three currencies: only those in dollars are prices, all count as sales.
_USD = f"""WITH {B.BASE_SQL}, usd AS (SELECT * REPLACE (CASE WHEN seller % 9 > 1 THEN total_price END AS total_price) FROM accepted),
{B.benchmark_sql('bench', 'usd')}, {B.decided_sql('decided', 'bench')}"""


@query("decide", f"{_USD} SELECT {_COLUMNS_SQL} FROM decided")
def decide(spark, sf):
    comps = B.accepted(spark, sf).withColumn(
        "currency", F.when(F.col("seller") % 9 == 0, "GBP").when(F.col("seller") % 9 == 1, "EUR").otherwise("USD"))
    comps = comps.withColumn("converted_total", F.when(F.col("currency") == V.VALUATION_CURRENCY, F.col("total_price")))
    return P.decide(B.listings(spark, sf), comps, B.TODAY).select(*DECISION_COLUMNS)


BOTH = f"""{DECIDED}, touched AS (SELECT slab_key, count(*) AS uncertain_comp_count FROM uncertain GROUP BY slab_key),
pooled AS (SELECT slab_key, total_price, sale_date FROM accepted SEMI JOIN touched USING (slab_key)
           UNION ALL SELECT slab_key, total_price, sale_date FROM uncertain),
{B.benchmark_sql('bench2', 'pooled')}, {B.decided_sql('alt', 'bench2')}"""
REVIEWED = f"""{BOTH},
reviewed AS (
  SELECT d.* EXCLUDE (decision, reason), coalesce(uncertain_comp_count, 0) AS uncertain_comp_count,
         CASE WHEN uncertain_comp_count > 0 THEN d.decision END AS decision_without_uncertain,
         CASE WHEN uncertain_comp_count > 0 THEN a.decision END AS decision_with_uncertain,
         CASE WHEN uncertain_comp_count > 0 AND a.decision <> d.decision THEN 'REVIEW_REQUIRED'
              ELSE d.decision END AS decision,
         CASE WHEN uncertain_comp_count > 0 AND a.decision <> d.decision
              THEN 'UNCERTAIN_EVIDENCE_WOULD_CHANGE_THE_DECISION' ELSE d.reason END AS reason
  FROM decided d JOIN alt a USING (item_id) LEFT JOIN touched t ON t.slab_key = d.slab_key)"""
REPORT = f"""{REVIEWED},
report AS (
  SELECT r.*, CASE WHEN comp_count >= 3 THEN 'valued' WHEN comp_count > 0 THEN 'benchmark_only'
                   ELSE 'no_benchmark' END AS population,
         (total_cost / nullif(benchmark_median, 0) - 1) * 100 AS markup_percent,
         total_cost / nullif(benchmark_median, 0) AS cost_to_market_ratio
  FROM reviewed r),
banded AS (
  SELECT *, CASE WHEN markup_percent <= 0 THEN 'at or below market'
                 WHEN markup_percent <= 5 THEN 'above market 0-5%'
                 WHEN markup_percent <= 10 THEN 'above market 5-10%'
                 WHEN markup_percent <= 15 THEN 'above market 10-15%'
                 WHEN markup_percent <= 25 THEN 'above market 15-25%'
                 WHEN markup_percent <= 50 THEN 'above market 25-50%'
                 WHEN markup_percent > 50 THEN 'above market over 50%' END AS markup_band
  FROM report),
valued AS (SELECT * FROM banded WHERE population = 'valued')"""

UNSURE_COLUMNS = ["item_id", "decision", "reason", "uncertain_comp_count", "decision_without_uncertain",
                  "decision_with_uncertain"]


@query("decide_uncertain", f"{REVIEWED} SELECT {', '.join(UNSURE_COLUMNS)} FROM reviewed")
def decide_uncertain(spark, sf):
    return P.decide(B.listings(spark, sf), B.accepted(spark, sf), B.TODAY,
                    uncertain=B.uncertain(spark, sf)).select(*UNSURE_COLUMNS)


def report(spark, sf):
    return P.economic_report(B.listings(spark, sf), B.accepted(spark, sf), B.TODAY,
                             uncertain=B.uncertain(spark, sf))


REPORT_COLUMNS = ["item_id", "slab_key", "population", "total_cost", "comp_count", "benchmark_median",
                  "gross_gap", "gross_pct", "markup_percent", "cost_to_market_ratio", "markup_band",
                  "decision", "reason", "downgrade_reason"]


# Up to three runs of a listing, weeks apart; every fifth listing was never run.
_RUNS_SQL = """runs AS (SELECT item_id, day - 400 + CAST(60 * n AS INTEGER) AS ran, ['failed', 'no_results', 'completed'][(quantity + n) % 3 + 1] AS status
  FROM listings, range(3) AS t(n) WHERE quantity % 5 <> 0 AND n <= quantity % 3),
latest AS (SELECT item_id, max_by(status, ran) AS run_status FROM runs GROUP BY item_id),
in_force AS (SELECT r.item_id, max_by(r.status, ran) AS run_status_at_sale FROM runs r JOIN listings USING (item_id) JOIN bench USING (slab_key)
  WHERE ran <= most_recent_sale GROUP BY r.item_id)"""


def runs(spark, sf):
    df = B.listings(spark, sf).where("quantity % 5 <> 0").select("item_id", "day", "quantity", F.explode(F.sequence(F.lit(0), F.col("quantity") % 3)).alias("n"))
    status = F.get(F.array(*[F.lit(x) for x in ("failed", "no_results", "completed")]), (F.col("quantity") + F.col("n")) % 3)
    return df.select(F.col("item_id").alias("candidate_id"), status.alias("status"),
                     F.date_add("day", F.col("n") * 60 - 400).cast("timestamp").alias("updated_at"))


@query("economic_report", f"""{REPORT}, {_RUNS_SQL}
SELECT {', '.join(REPORT_COLUMNS)}, run_status, run_status_at_sale FROM banded LEFT JOIN latest USING (item_id) LEFT JOIN in_force USING (item_id)""")
def economic_report(spark, sf):
    full = P.economic_report(B.listings(spark, sf), B.accepted(spark, sf), B.TODAY, uncertain=B.uncertain(spark, sf), runs=runs(spark, sf))
    return full.select(*REPORT_COLUMNS, "run_status", "run_status_at_sale")


@query("what_if", f"""{REPORT},
shifted AS (SELECT d AS discount_pct, (benchmark_median - total_cost * (1 - d / 100)) / nullif(benchmark_median, 0) AS pct
            FROM valued, unnest([0, 5, 10, 15, 20, 25]) AS t(d))
SELECT discount_pct, CASE WHEN discount_pct = 0 THEN 'actual' ELSE discount_pct || '%' END AS label,
       count(*) FILTER (pct >= 0.25) AS buy, count(*) FILTER (pct >= 0.10 AND pct < 0.25) AS watch,
       count(*) FILTER (pct < 0.10 OR pct IS NULL) AS pass
FROM shifted GROUP BY discount_pct""")
def what_if(spark, sf):
    return P.what_if(report(spark, sf))


@query("headline", f"""{REPORT} SELECT count(*) AS candidates,
  count(*) FILTER (decision = 'BUY') AS buy, count(*) FILTER (decision = 'WATCH') AS watch,
  count(*) FILTER (decision = 'PASS') AS pass, count(*) FILTER (decision = 'REVIEW_REQUIRED') AS review_required,
  count(*) FILTER (population = 'valued') AS valued, count(*) FILTER (population = 'benchmark_only') AS benchmark_only,
  count(*) FILTER (population = 'no_benchmark') AS no_benchmark,
  count(*) FILTER (population <> 'valued') AS without_sufficient_benchmark,
  count(*) FILTER (population = 'valued' AND markup_band = 'above market over 50%') AS above_market_over_50pct,
  count(*) FILTER (population = 'valued' AND markup_band = 'at or below market') AS at_or_below_market
FROM banded""")
def headline(spark, sf):
    return P.headline(report(spark, sf))


@query("markup_bands", f"{REPORT} SELECT markup_band, count(*) AS listings FROM valued GROUP BY markup_band")
def markup_bands(spark, sf):
    return P.markup_bands(report(spark, sf))


@query("markup_quartiles", f"""{REPORT},
pos AS (SELECT markup_percent AS v, row_number() OVER (ORDER BY markup_percent) - 1 AS i, count(*) OVER () AS n
        FROM valued WHERE markup_percent IS NOT NULL)
SELECT 'valued' AS population, any_value(n) AS listings, max(v) FILTER (i = n // 4) AS q1_index,
       (max(v) FILTER (i = (n - 1) // 2) + max(v) FILTER (i = n // 2)) / 2 AS median_markup,
       max(v) FILTER (i = 3 * n // 4) AS q3_index
FROM pos""")
def markup_quartiles(spark, sf):
    return P.markup_quartiles(report(spark, sf))


@query("cohorts", f"""{REPORT},
labelled AS (SELECT CASE WHEN p_name LIKE 'red %' OR p_name LIKE 'blue %' THEN 'parallel/serial'
                         WHEN p_size % 5 = 0 THEN 'auto' WHEN p_type = 'PROMO' THEN 'qualifier' ELSE 'base' END AS cohort,
                    markup_percent FROM valued JOIN part ON p_partkey = slab_key),
{B.median_sql('med', 'labelled', 'cohort', 'markup_percent', 'median_markup_pct')}
SELECT cohort, count(*) AS valued, any_value(median_markup_pct) AS median_markup_pct,
       min(markup_percent) AS min_markup_pct, max(markup_percent) AS max_markup_pct
FROM labelled JOIN med USING (cohort) GROUP BY cohort""")
def cohorts(spark, sf):
    name, size = F.col("p_name"), F.col("p_size")
    part = B.table(spark, sf, "part").select(F.col("p_partkey").alias("slab_key"), P.cohort(
        F.when(name.startswith("red ") | name.startswith("blue "), F.upper(name)),
        F.lit(None).cast("int"), (size % 5 == 0).cast("int"), F.lit(None).cast("string"),
        F.when(F.col("p_type") == "PROMO", "OC")).alias("cohort"))
    return P.cohort_rollup(report(spark, sf).join(part, "slab_key"))


@query("ranked_by_markup", f"""{REPORT}
SELECT item_id, markup_percent, rank() OVER (ORDER BY markup_percent) AS markup_rank FROM valued""")
def ranked_by_markup(spark, sf):
    return P.ranked_by_markup(report(spark, sf)).select("item_id", "markup_percent", "markup_rank")


# Prices moved so close together that they share a few bins, which are cut by their own range.
_CLOSE = "100::DOUBLE + l_orderkey * 1e-9::DOUBLE + l_linenumber * 1e-13::DOUBLE"


@query("close_medians", f"""WITH v AS (SELECT l_returnflag AS flag, CAST({_CLOSE} AS DOUBLE) AS v FROM lineitem),
r AS (SELECT flag, v, row_number() OVER (PARTITION BY flag ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY flag) AS n FROM v)
SELECT flag, any_value(n) AS n, (max(v) FILTER (i = (n - 1) // 2) + max(v) FILTER (i = n // 2)) / 2 AS median, max(v) FILTER (i = n // 4) AS q1_index FROM r GROUP BY flag""")
def close_medians(spark, sf):
    value = F.lit(100.0) + F.col("l_orderkey") * F.lit(1e-9) + F.col("l_linenumber") * F.lit(1e-13)
    rows = B.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), value.alias("v"))
    stats = O.order_statistics(rows, ["flag"], "v", {"__lo": O.LOWER_MEDIAN, "__hi": O.UPPER_MEDIAN, "q1_index": lambda n: F.floor(n / 4)}, cuts=2)
    return stats.select("flag", "n", O.middle_of().alias("median"), "q1_index")


# By ratio and by markup the order is the same; by gap it is not.
@query("rank_monotonic", f"""{REPORT},
v AS (SELECT markup_percent, total_cost / nullif(benchmark_median, 0.0) AS ratio, gross_gap FROM valued),
o AS (SELECT 'cost_to_market_ratio' AS measure, ratio AS o, markup_percent AS m FROM v UNION ALL SELECT 'markup_percent', markup_percent, markup_percent FROM v
      UNION ALL SELECT 'gross_gap', gross_gap, markup_percent FROM v),
g AS (SELECT measure, o, min(m) AS low, max(m) AS high FROM o WHERE o IS NOT NULL AND m IS NOT NULL GROUP BY ALL),
p AS (SELECT measure, low, lag(high) OVER (PARTITION BY measure ORDER BY o) AS previous FROM g)
SELECT measure, count(*) AS rank_groups, count(*) FILTER (previous > low) AS steps_down FROM p GROUP BY measure""")
def rank_monotonic(spark, sf):
    rows = settle(report(spark, sf).select("population", "cost_to_market_ratio", "markup_percent", "gross_gap"))
    checks = [P.rank_is_monotonic(rows, measure).withColumn("measure", F.lit(measure))
              for measure in ("cost_to_market_ratio", "markup_percent", "gross_gap")]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


_MOVED = B.decided_sql("moved", "bench").replace("FROM listings l", "FROM at_peer l")


@query("rescored_at_peer", f"""{DECIDED},
best AS (SELECT slab_key, min(price + shipping_cost) AS cost FROM listings WHERE active AND shipping_cost IS NOT NULL GROUP BY slab_key),
peer AS (SELECT slab_key, cost, min(item_id) AS peer_item_id FROM best JOIN listings USING (slab_key) WHERE active AND price + shipping_cost = cost GROUP BY ALL),
at_peer AS (SELECT l.* REPLACE (cost AS price, 0.0::DOUBLE AS shipping_cost, true AS active), peer_item_id FROM listings l JOIN peer USING (slab_key)),
{_MOVED}
SELECT d.item_id, m.peer_item_id, d.decision, m.decision AS decision_at_peer, m.reason AS reason_at_peer,
  CASE WHEN m.item_id IS NULL THEN 'no_eligible_peer' WHEN m.comp_count < 3 THEN 'excluded_insufficient_or_unreliable_comps'
       WHEN m.pct >= 0.1 THEN 'below_market_10pct_or_more' WHEN m.pct > 0 THEN 'within_10pct_of_market' ELSE 'above_market' END AS outcome
FROM decided d LEFT JOIN moved m USING (item_id)""")
def rescored_at_peer(spark, sf):
    rows = B.listings(spark, sf)
    members = rows.withColumns({"acquisition_total": F.col("price") + F.col("shipping_cost"),
                                "reject_reason": F.when(~F.col("active"), "inactive").when(F.col("shipping_cost").isNull(), "shipping_unknown")})
    return P.rescored_at_peer(rows, B.accepted(spark, sf), cheapest_eligible(members), B.TODAY)


@query("consistency", f"""{REPORT} SELECT
  count(*) FILTER (population = 'valued' AND markup_band IS NOT NULL) = count(*) FILTER (population = 'valued') AS bands_total_valued,
  count(*) FILTER (decision IN ('BUY', 'WATCH', 'PASS', 'REVIEW_REQUIRED')) = count(*) AS decisions_total_candidates,
  count(*) FILTER (population IN ('valued', 'benchmark_only', 'no_benchmark')) = count(*) AS populations_total_candidates,
  count(*) FILTER (population = 'valued' AND active AND total_cost > 0 AND gross_gap IS NULL) = 0 AS valued_rows_have_a_gap,
  count(*) FILTER (population = 'benchmark_only' AND gross_gap IS NOT NULL) = 0 AS unvalued_rows_have_no_gap
FROM banded""")
def consistency(spark, sf):
    return P.check_report(report(spark, sf))


@query("shipping_diagnostic", f"""{BENCH},
priced AS (SELECT slab_key, sold_price, coalesce(shipping, 0.0) AS ship, sold_price + coalesce(shipping, 0.0) AS total
           FROM accepted WHERE sold_price IS NOT NULL),
{B.median_sql('ms', 'priced', 'slab_key', 'ship', 'median_comp_shipping')},
{B.median_sql('mi', 'priced', 'slab_key', 'sold_price', 'median_comp_item_price')},
{B.median_sql('mt', 'priced', 'slab_key', 'total', 'median_comp_total')},
g AS (SELECT item_id, price, shipping_cost, ms.median_comp_shipping, mi.median_comp_item_price, mt.median_comp_total,
             median_comp_total - (price + shipping_cost) AS total_cost_gap, median_comp_item_price - price AS igap
      FROM listings LEFT JOIN ms USING (slab_key) LEFT JOIN mi USING (slab_key) LEFT JOIN mt USING (slab_key)),
u AS (SELECT *, median_comp_total IS NOT NULL AND price IS NOT NULL AND shipping_cost IS NOT NULL AS usable FROM g),
s AS (SELECT item_id, usable, CASE WHEN usable THEN median_comp_shipping END AS median_comp_shipping, total_cost_gap,
             CASE WHEN usable THEN igap END AS item_price_only_gap,
             CASE WHEN usable THEN total_cost_gap - igap END AS shipping_contribution FROM u),
f AS (SELECT *, CASE WHEN total_cost_gap > 0 THEN shipping_contribution / total_cost_gap END AS shipping_share_of_gap FROM s)
SELECT item_id, median_comp_shipping, total_cost_gap, item_price_only_gap, shipping_contribution,
       shipping_share_of_gap, coalesce(shipping_share_of_gap >= 0.5, false) AS shipping_dominated,
       CASE WHEN NOT usable THEN 'no priced comps' WHEN total_cost_gap <= 0 THEN 'no discount to attribute'
            WHEN shipping_share_of_gap >= 0.5 THEN 'gap is mostly postage' ELSE 'gap is mostly the item' END AS shipping_note
FROM f""")
def shipping_diagnostic(spark, sf):
    return P.shipping_diagnostic(B.listings(spark, sf), B.accepted(spark, sf)).select(
        "item_id", "median_comp_shipping", "total_cost_gap", "item_price_only_gap", "shipping_contribution",
        "shipping_share_of_gap", "shipping_dominated", "shipping_note")


_QUARTILES = f"""arr AS (SELECT slab_key, list(total_price ORDER BY total_price) AS a, count(*) AS n
                 FROM accepted WHERE total_price IS NOT NULL GROUP BY slab_key),
pos AS (SELECT *, greatest(1, least(n - 1, (n + 1) // 4)) AS j1, greatest(1, least(n - 1, (n + 1) * 3 // 4)) AS j3 FROM arr),
quart AS (SELECT slab_key, n AS accepted_comps,
  CASE WHEN n >= 2 THEN (a[j1] * (4 - ((n + 1) - 4 * j1)) + a[j1 + 1] * ((n + 1) - 4 * j1)) / 4 END AS p25,
  (a[(n + 1) // 2] + a[n // 2 + 1]) / 2 AS median,
  CASE WHEN n >= 2 THEN (a[j3] * (4 - ((n + 1) * 3 - 4 * j3)) + a[j3 + 1] * ((n + 1) * 3 - 4 * j3)) / 4 END AS p75
  FROM pos)"""


@query("exclusive_quartiles", f"{BENCH}, {_QUARTILES} SELECT * FROM quart")
def exclusive_quartiles(spark, sf):
    return P.exclusive_quartiles(B.accepted(spark, sf).where("total_price IS NOT NULL"), ["slab_key"], "total_price", "accepted_comps")


@query("index_quartiles", f"""{BENCH}, {_QUARTILES}
SELECT slab_key, n, a[n // 4 + 1] AS q1_index, a[n // 2 + 1] AS upper_median, a[3 * n // 4 + 1] AS q3_index FROM arr""")
def index_quartiles(spark, sf):
    return O.index_quartiles(B.accepted(spark, sf).where("total_price IS NOT NULL"), ["slab_key"], "total_price")


@query("research_watch", f"""{BENCH}, {_QUARTILES},
c AS (SELECT item_id, coalesce(accepted_comps, 0) AS accepted_comps, p25, p75,
             CASE WHEN shipping_cost IS NULL THEN price / 2 ELSE price / 2 + shipping_cost END AS cost_floor,
             shipping_cost IS NOT NULL AS cost_floor_is_complete
      FROM listings LEFT JOIN quart USING (slab_key)),
h AS (SELECT *, CASE WHEN p25 > 0 THEN p75 / p25 END AS iqr_ratio,
             CASE WHEN p25 > 0 THEN (p25 - cost_floor) / p25 * 100 END AS headroom_pct FROM c),
e AS (SELECT *, CASE WHEN accepted_comps = 0 THEN 'no_accepted_comps'
    WHEN accepted_comps = 1 THEN 'only_1_accepted_comp'
    WHEN accepted_comps < 5 THEN 'only_' || accepted_comps || '_accepted_comps'
    WHEN iqr_ratio > 2 OR iqr_ratio IS NULL THEN 'comp_range_too_wide'
    WHEN cost_floor >= p25 THEN 'bid_already_at_or_above_conservative_valuation'
    WHEN headroom_pct < 25 THEN 'headroom_below_25pct' END AS exclusion_reason FROM h)
SELECT item_id, accepted_comps, p25, p75, cost_floor, cost_floor_is_complete, iqr_ratio, headroom_pct,
       exclusion_reason, exclusion_reason IS NULL AS research_watch FROM e""")
def research_watch(spark, sf):
    auctions = B.listings(spark, sf).withColumn("current_bid_price", F.col("price") / 2)
    return P.research_watch(auctions, B.accepted(spark, sf)).select(
        "item_id", "accepted_comps", "p25", "p75", "cost_floor", "cost_floor_is_complete", "iqr_ratio",
        "headroom_pct", "exclusion_reason", "research_watch")


@query("gap_distribution", f"""{DECIDED},
pos AS (SELECT gross_pct AS v, row_number() OVER (ORDER BY gross_pct) - 1 AS i, count(*) OVER () AS n
        FROM decided WHERE gross_pct IS NOT NULL),
q AS (SELECT name, q, n, (n - 1) * q AS p FROM (SELECT any_value(n) AS n FROM pos),
      (VALUES ('worst', 0.0::DOUBLE), ('p25', 0.25::DOUBLE), ('median', 0.5::DOUBLE), ('p75', 0.75::DOUBLE),
              ('p90', 0.9::DOUBLE), ('best', 1.0::DOUBLE)) t(name, q)),
v AS (SELECT name, lo.v + (hi.v - lo.v) * (p - floor(p)) AS x, q.n AS n
      FROM q JOIN pos lo ON lo.i = floor(p) JOIN pos hi ON hi.i = ceil(p))
SELECT 'priced' AS population, any_value(n) AS listings, max(x) FILTER (name = 'best') AS best, max(x) FILTER (name = 'p90') AS p90,
       max(x) FILTER (name = 'p75') AS p75, max(x) FILTER (name = 'median') AS median,
       max(x) FILTER (name = 'p25') AS p25, max(x) FILTER (name = 'worst') AS worst FROM v""")
def gap_distribution(spark, sf):
    rows = P.decide(B.listings(spark, sf), B.accepted(spark, sf), B.TODAY).select(
        "gross_pct").where("gross_pct IS NOT NULL")
    return O.interpolated_quantiles(rows, [], "gross_pct", {
        "best": 1.0, "p90": 0.9, "p75": 0.75, "median": 0.5, "p25": 0.25, "worst": 0.0}, "listings").withColumn("population", F.lit("priced"))


STAGES = {"stale_rules": {"max_age_days": 100000, "dispersion_limit": 1000000.0, "with_shipping": False},
          "wide_spread": {"dispersion_limit": 1000000.0},
          "current_rules": {}}


@query("revaluation_stages", f"""{BENCH},
{B.decided_sql('s1', 'bench', dispersion_limit=1000000.0, max_age=100000, shipping='0.0')},
{B.decided_sql('s2', 'bench', dispersion_limit=1000000.0)}, {B.decided_sql('s3', 'bench')}
""" + " UNION ALL ".join(f"SELECT '{stage}' AS stage, item_id, slab_key, decision, reason, total_cost, median_total, gross_gap FROM {cte}"
                         for stage, cte in (("stale_rules", "s1"), ("wide_spread", "s2"), ("current_rules", "s3"))))
def revaluation_stages(spark, sf):
    return P.revaluation_stages(B.listings(spark, sf), B.accepted(spark, sf), B.TODAY, STAGES)


@query("evidence_freshness", f"""WITH {B.BASE_SQL},
copies AS (SELECT slab_key, CASE WHEN line % 3 = 0 THEN NULL ELSE source_item_id END AS sid,
                  'part ' || slab_key AS raw_title, sale_date, CAST(round(total_price) AS BIGINT) AS total_price
           FROM accepted, range(2) t(copy) WHERE total_price IS NOT NULL),
u AS (SELECT slab_key, coalesce(sid, concat_ws('|', raw_title, CAST(sale_date AS VARCHAR), CAST(total_price AS VARCHAR))) AS comp,
             max(sale_date) AS sale_date FROM copies GROUP BY ALL)
SELECT slab_key, count(DISTINCT comp) AS unique_comps, max(sale_date) AS newest,
       count(DISTINCT comp) >= 3 AND {B.TODAY_SQL} - max(sale_date) <= 365 AS reusable FROM u GROUP BY slab_key""")
def evidence_freshness(spark, sf):
    once = B.accepted(spark, sf).select(
        "slab_key", F.when(F.col("line") % 3 != 0, F.col("source_item_id")).alias("source_item_id"),
        F.concat(F.lit("part "), F.col("slab_key").cast("string")).alias("raw_title"), "sale_date",
        F.floor(F.col("total_price") + 0.5).alias("total_price"))
    return P.evidence_freshness(once.unionAll(once), B.TODAY)
