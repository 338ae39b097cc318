"""Change audits and summaries over the line items, orders and events."""

from pyspark.sql import functions as F

from listwise.plans import audit as A
from listwise.plans import valuation as P
from listwise.session import settle
from listwise.workloads import base as B
from listwise.workloads import evidence as E
from listwise.workloads.registry import query

# Two rule versions over the sold items: the later one also rejects the smallest quantities.
STATES_SQL = f"""WITH {B.BASE_SQL},
v1 AS (SELECT item_id, slab_key, total_price, sale_date, CASE WHEN flag = 'N' THEN 'review_required' WHEN line = 7 THEN 'rejected' ELSE 'accepted' END AS state,
  CASE WHEN flag = 'N' THEN 'year None != 1990 (field absent from title, not a conflict)' WHEN line = 7 THEN 'PSA grade 8 != 9' END AS reason FROM sold),
v2 AS (SELECT item_id, slab_key, total_price, sale_date, CASE WHEN line = 1 THEN 'rejected' ELSE state END AS state,
  CASE WHEN line = 1 THEN 'graded by BGS, not PSA' ELSE reason END AS reason FROM v1 JOIN (SELECT item_id, line FROM sold) USING (item_id))"""


def states(spark, sf):
    line = F.col("line")
    first = B.sold(spark, sf).withColumns({
        "state": F.when(F.col("flag") == "N", "review_required").when(line == 7, "rejected").otherwise("accepted"),
        "reason": F.when(F.col("flag") == "N", "year None != 1990 (field absent from title, not a conflict)")
        .when(line == 7, "PSA grade 8 != 9")})
    second = first.withColumns({"state": F.when(line == 1, "rejected").otherwise(F.col("state")),
                                "reason": F.when(line == 1, "graded by BGS, not PSA").otherwise(F.col("reason"))})
    return first, second


@query("reclassify_diff", f"""{STATES_SQL}
SELECT a.item_id, a.state AS old_state, b.state AS new_state,
  CASE WHEN a.reason IS NULL THEN 'accepted' WHEN a.reason LIKE 'year%' THEN 'year' ELSE 'grade' END AS old_rule,
  'rival_grader' AS rule_responsible FROM v1 a JOIN v2 b USING (item_id) WHERE a.state <> b.state""")
def reclassify_diff(spark, sf):
    before, after = states(spark, sf)
    return A.reclassify_diff(before, after, "item_id").select("item_id", "old_state", "new_state", "old_rule", "rule_responsible")


@query("redecided", f"""{E.CLASSIFIED_SQL}
SELECT item_id, cid AS candidate_item_id, state, reason FROM decided""")
def redecided(spark, sf):
    """Rows of some parts are stored as decided, some of them under a candidate that has changed since; the rest was never decided."""
    candidates, sold = E.candidates(spark, sf), E.sold_titles(spark, sf)
    known = F.col("slab_key") % 3 == 0
    older = candidates.withColumn("psa_grade", F.when(F.col("slab_key") % 2 == 0, "8").otherwise(F.col("psa_grade")))
    stored = settle(A.reclassified(sold.where(known).withColumns({n: F.lit(None).cast("string") for n in ("state", "reason_code", "reason", "digest")}), older))
    never = sold.where(~known).withColumns({n: F.lit(None).cast("string") for n in ("state", "reason_code", "reason", "digest")})
    return A.reclassified(stored.unionByName(never), candidates).select("item_id", "candidate_item_id", "state", "reason")


@query("immutability", """WITH b AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 3),
a AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 4 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) FROM orders WHERE o_orderkey % 10 <> 5)
SELECT count(*) FILTER (b.o_orderkey IS NULL) AS added, count(*) FILTER (a.o_orderkey IS NULL) AS removed,
  count(*) FILTER (a.o_orderstatus <> b.o_orderstatus) AS mutated, count(*) AS ids FROM b FULL JOIN a USING (o_orderkey)""")
def immutability(spark, sf):
    orders = B.table(spark, sf, "orders")
    k = F.col("o_orderkey") % 10
    after = orders.where(k != 5).withColumn("o_orderstatus", F.when(k == 4, "X").otherwise(F.col("o_orderstatus")))
    return A.prove_immutable(orders.where(k != 3), after, "o_orderkey", orders.columns)


@query("membership_diff", """SELECT coalesce(a.c, b.c) AS o_custkey, CASE WHEN b.c IS NULL THEN 'added' ELSE 'removed' END AS change
FROM (SELECT DISTINCT o_custkey AS c FROM orders WHERE o_orderstatus = 'F') b FULL JOIN (SELECT DISTINCT o_custkey AS c FROM orders WHERE o_orderstatus = 'P') a
ON a.c = b.c WHERE a.c IS NULL OR b.c IS NULL""")
def membership_diff(spark, sf):
    orders = B.table(spark, sf, "orders")
    return A.membership_diff(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'P'"), ["o_custkey"])


@query("accounting", f"""{STATES_SQL}, c AS (SELECT * FROM v1 JOIN (SELECT item_id, line FROM sold) USING (item_id))
SELECT count(*) FILTER (line <> 1) AS unique_extracted, count(*) FILTER (line <> 1) AS collisions,
  count(*) FILTER (line <> 2 AND state = 'accepted') AS accepted, count(*) FILTER (line <> 2 AND state = 'rejected') AS rejected,
  count(*) FILTER (line <> 2 AND state = 'review_required') AS review_required,
  count(*) FILTER (line = 2) AS missing, count(*) FILTER (line = 1) AS unexpected, count(*) FILTER (line IN (1, 2)) = 0 AS balanced FROM c""")
def accounting(spark, sf):
    """First lines were classified but not extracted, second lines extracted but not classified."""
    first, _ = states(spark, sf)
    ids = first.where("line <> 1").select("item_id")
    return A.accounting(ids.unionAll(ids), first.where("line <> 2"), "item_id")


@query("duplicate_ids", "SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    return A.duplicate_ids(B.table(spark, sf, "lineitem").select("l_orderkey"), "l_orderkey")


@query("state_counts", f"""{STATES_SQL} SELECT slab_key, count(*) AS rows, count(*) FILTER (state = 'accepted') AS accepted,
  count(*) FILTER (state = 'rejected') AS rejected, count(*) FILTER (state = 'review_required') AS review_required FROM v1 GROUP BY slab_key""")
def state_counts(spark, sf):
    return A.state_counts(states(spark, sf)[0], "slab_key")


@query("reason_counts", f"{STATES_SQL} SELECT coalesce(reason, '(no reason recorded)') AS reason, count(*) AS rows FROM v2 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def reason_counts(spark, sf):
    return A.reason_counts(states(spark, sf)[1]).orderBy(F.desc("rows"), "reason").limit(10)


_SNAP = """{name}_n AS (SELECT slab_key, count(*) FILTER (state = 'accepted') AS accepted, count(*) FILTER (state = 'rejected') AS rejected,
  count(*) FILTER (state = 'review_required') AS review_required FROM {name} GROUP BY slab_key),
{name}_a AS (SELECT * FROM {name} WHERE state = 'accepted')"""


@query("snapshot_change", f"""{STATES_SQL}, one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slab_key ORDER BY item_id) AS k FROM listings) WHERE k = 1),
{_SNAP.format(name='v1')}, {_SNAP.format(name='v2')}, {B.benchmark_sql('b1', 'v1_a')}, {B.benchmark_sql('b2', 'v2_a')},
{B.decided_sql('d1', 'b1')}, {B.decided_sql('d2', 'b2')},
j AS (SELECT o.item_id, x.accepted AS accepted_before, y.accepted AS accepted_after, x.rejected AS rejected_before, y.rejected AS rejected_after,
  x.review_required AS review_before, y.review_required AS review_after, d1.median_total AS median_total_before, d2.median_total AS median_total_after,
  d1.decision AS decision_before, d2.decision AS decision_after, d1.confidence AS confidence_before, d2.confidence AS confidence_after
  FROM one o JOIN d1 USING (item_id) JOIN d2 USING (item_id) LEFT JOIN v1_n x ON x.slab_key = o.slab_key LEFT JOIN v2_n y ON y.slab_key = o.slab_key)
SELECT item_id, accepted_before, accepted_after, median_total_before, median_total_after, decision_before, decision_after, confidence_before, confidence_after,
  decision_before IS DISTINCT FROM decision_after AS decision_changed FROM j
WHERE accepted_before IS DISTINCT FROM accepted_after OR rejected_before IS DISTINCT FROM rejected_after OR review_before IS DISTINCT FROM review_after
   OR median_total_before IS DISTINCT FROM median_total_after OR decision_before IS DISTINCT FROM decision_after""")
def snapshot_change(spark, sf):
    rest = ["item_id", "price", "shipping_cost", "active"]
    one = B.listings(spark, sf).groupBy("slab_key").agg(F.min_by(F.struct(*rest), F.col("item_id")).alias("r")).select("slab_key", "r.*")
    before, after = states(spark, sf)
    out = A.snapshot_change(A.candidate_snapshot(one, before, B.TODAY, "slab_key"), A.candidate_snapshot(one, after, B.TODAY, "slab_key"), "slab_key")
    return out.join(one.select("slab_key", "item_id"), "slab_key").select(
        "item_id", *[f"{f}_{w}" for f in ("accepted", "median_total", "decision", "confidence") for w in ("before", "after")], "decision_changed")


_PCT = "round(100.0::DOUBLE * {a} / nullif({b}, 0), 1)"


@query("cohort_summary", f"""{STATES_SQL},
c AS (SELECT slab_key, count(*) AS rows, count(*) FILTER (state = 'accepted') AS accepted, count(*) FILTER (state = 'rejected') AS rejected,
  count(*) FILTER (state = 'review_required') AS review_required, count(*) FILTER (state = 'accepted') >= 9 AS sufficient FROM v1 GROUP BY slab_key),
s AS (SELECT CASE WHEN grouping(p_type) = 1 THEN 'PROJECT TOTAL' ELSE p_type END AS cohort, count(*) AS unique_candidates,
  CAST(sum(coalesce(rows, 0)) AS BIGINT) AS rows, CAST(sum(coalesce(accepted, 0)) AS BIGINT) AS accepted, CAST(sum(coalesce(rejected, 0)) AS BIGINT) AS rejected,
  CAST(sum(coalesce(review_required, 0)) AS BIGINT) AS review_required, count(*) FILTER (rows > 0) AS query_success,
  count(*) FILTER (sufficient) AS evidence_sufficient FROM part LEFT JOIN c ON slab_key = p_partkey GROUP BY ROLLUP (p_type))
SELECT *, {_PCT.format(a='query_success', b='unique_candidates')} AS query_success_pct, {_PCT.format(a='accepted', b='rows')} AS acceptance_pct,
  {_PCT.format(a='review_required', b='rows')} AS review_pct, {_PCT.format(a='evidence_sufficient', b='unique_candidates')} AS sufficiency_pct FROM s""")
def cohort_summary(spark, sf):
    counts = A.state_counts(states(spark, sf)[0], "slab_key").withColumn("sufficient", F.col("accepted") >= 9)
    part = B.table(spark, sf, "part").select(F.col("p_partkey").alias("slab_key"), F.col("p_type").alias("cohort"))
    return A.cohort_summary(part.join(counts, "slab_key", "left"))


@query("seller_profiles", f"""WITH {B.LISTINGS_SQL},
l AS (SELECT seller, price, quantity <> 50 AS single, CASE line % 4 WHEN 0 THEN NULL WHEN 1 THEN 'SGC' ELSE 'PSA' END AS grader,
  line % 4 >= 2 AS complete, CAST(quantity % 3 + 8 AS VARCHAR) AS grade FROM listings),
{B.median_sql('m', 'l', 'seller', 'price', 'price_median')},
g AS (SELECT seller, string_agg(x, ',' ORDER BY x) AS grader_distribution FROM (SELECT seller, coalesce(grader, 'none') || ':' || count(*) AS x FROM l GROUP BY seller, grader) GROUP BY seller),
h AS (SELECT seller, string_agg(x, ',' ORDER BY x) AS grade_distribution FROM (SELECT seller, grade || ':' || count(*) AS x FROM l WHERE complete GROUP BY seller, grade) GROUP BY seller)
SELECT seller, count(*) AS observed, count(*) FILTER (single) AS singles, count(*) FILTER (NOT single) AS non_singles, count(grader) AS names_a_grader,
  count(*) FILTER (complete) AS identity_complete, any_value(price_median) AS price_median, min(price) AS price_min, max(price) AS price_max,
  any_value(grader_distribution) AS grader_distribution, any_value(grade_distribution) AS grade_distribution,
  round(100.0::DOUBLE * count(*) FILTER (complete) / count(*), 1) AS identity_complete_pct
FROM l JOIN m USING (seller) JOIN g USING (seller) LEFT JOIN h USING (seller) GROUP BY seller""")
def seller_profiles(spark, sf):
    line = F.col("line") % 4
    df = B.listings(spark, sf).select(
        "seller", "price", (F.col("quantity") != 50).alias("single_card"),
        F.when(line == 1, "SGC").when(line >= 2, "PSA").alias("grader"), (line >= 2).alias("complete"),
        (F.col("quantity") % 3 + 8).cast("string").alias("grade_value"))
    return A.seller_profiles(df)


@query("eligibility_funnel", f"""WITH {B.LISTINGS_SQL},
f AS (SELECT CASE WHEN line = 7 THEN 'parse_not_ok' WHEN seller % 13 = 1 THEN 'non_numeric_grade' WHEN price + shipping_cost >= 1000 THEN 'cost_ge_1000'
  WHEN seller % 11 = 0 THEN 'auction' WHEN shipping_cost IS NULL THEN 'unresolved_shipping' ELSE 'eligible' END AS r FROM listings)
SELECT count(*) AS population, count(*) FILTER (r = 'parse_not_ok') AS parse_not_ok, count(*) FILTER (r = 'non_numeric_grade') AS non_numeric_grade,
  count(*) FILTER (r = 'cost_ge_1000') AS cost_ge_1000, count(*) FILTER (r = 'auction') AS auction,
  count(*) FILTER (r = 'unresolved_shipping') AS unresolved_shipping, count(*) FILTER (r = 'eligible') AS eligible FROM f""")
def eligibility_funnel(spark, sf):
    return A.funnel(B.listings(spark, sf), {
        "parse_not_ok": F.col("line") == 7, "non_numeric_grade": F.col("seller") % 13 == 1,
        "cost_ge_1000": F.col("price") + F.col("shipping_cost") >= 1000, "auction": F.col("seller") % 11 == 0,
        "unresolved_shipping": F.col("shipping_cost").isNull()})


@query("key_overlap", f"""WITH {B.BASE_SQL}, a AS (SELECT DISTINCT slab_key FROM listings WHERE seller % 10 = 1),
b AS (SELECT DISTINCT slab_key FROM listings WHERE seller % 10 = 2), c AS (SELECT DISTINCT slab_key FROM accepted WHERE line = 3)
SELECT count(*) AS shared_keys, count(*) FILTER (slab_key IN (SELECT slab_key FROM c)) AS carrying_comps FROM a SEMI JOIN b USING (slab_key)""")
def key_overlap(spark, sf):
    df = B.listings(spark, sf)
    return A.key_overlap(df.where("seller % 10 = 1"), df.where("seller % 10 = 2"), "slab_key", B.accepted(spark, sf).where("line = 3"))


@query("rebuild_plan", f"""WITH {B.LISTINGS_SQL} SELECT item_id FROM listings WHERE active AND seller % 4 <> 0""")
def rebuild_plan(spark, sf):
    df = B.listings(spark, sf)
    return A.rebuild_plan(df.where("active"), df.where("seller % 4 = 0"))


@query("outside_scope", f"WITH {B.LISTINGS_SQL} SELECT count(*) AS outside_scope FROM listings WHERE NOT active AND line = 2")
def outside_scope(spark, sf):
    df = B.listings(spark, sf)
    return A.outside_scope(df.where("line = 2"), df.where("active"))


@query("accepted_audit", f"""{E.CLASSIFIED_SQL}
SELECT item_id, cid AS candidate_item_id, c_subject AS candidate_subject, CAST(NULL AS VARCHAR) AS valuation_exclusion_reason FROM decided WHERE state = 'accepted'""")
def accepted_audit(spark, sf):
    return A.accepted_audit(E.classified(spark, sf), E.candidates(spark, sf)).select(
        "item_id", "candidate_item_id", "candidate_subject", "valuation_exclusion_reason")


@query("missing_evidence_relabel", f"""{STATES_SQL} SELECT item_id,
  CASE WHEN line % 2 = 0 THEN 'REVIEW_REQUIRED' END AS match_confidence,
  CASE WHEN line % 2 = 0 THEN 'print run None != 50 (field absent from title, not a conflict)' ELSE 'PSA grade 8 != 9' END AS rejection_reason FROM sold""")
def missing_evidence_relabel(spark, sf):
    from listwise.plans.evidence import missing_evidence_relabel as relabel
    rows = B.sold(spark, sf).select("item_id", F.lit(0).alias("accepted"), F.lit(None).cast("string").alias("match_confidence"),
                                    F.when(F.col("line") % 2 == 0, "print run None != 50").otherwise("PSA grade 8 != 9").alias("rejection_reason"))
    return relabel(rows).drop("accepted")


@query("market_gap", f"""WITH {B.BASE_SQL}, {B.benchmark_sql('bench', 'accepted')}
SELECT item_id, coalesce(median_total, 0) - price AS gap, CASE WHEN median_total IS NOT NULL THEN 100 * (median_total - price) / median_total ELSE 0.0 END AS pct,
  CASE WHEN coalesce(median_total, 0) > price THEN 'discount to market' WHEN coalesce(median_total, 0) < price THEN 'premium over market' ELSE 'at market' END AS label
FROM listings LEFT JOIN bench USING (slab_key)""")
def market_gap(spark, sf):
    from listwise.functions.values import market_gap as gap_of
    df = B.listings(spark, sf).join(P.benchmark(B.accepted(spark, sf), "slab_key"), "slab_key", "left")
    gap, pct, label = gap_of(F.col("price"), F.col("median_total"))
    return df.select("item_id", gap.alias("gap"), pct.alias("pct"), label.alias("label"))


@query("sold_summary", f"""WITH {B.BASE_SQL}, {B.benchmark_sql('bench', 'accepted')}
SELECT slab_key, comp_count, median_total, min_total, max_total, most_recent_sale, dispersion,
  CASE WHEN comp_count >= 5 THEN 'HIGH' WHEN comp_count >= 3 THEN 'MEDIUM' WHEN comp_count >= 1 THEN 'LOW' ELSE 'NONE' END AS confidence FROM bench""")
def sold_summary(spark, sf):
    from listwise.functions.values import confidence
    return P.benchmark(B.accepted(spark, sf), "slab_key").withColumn("confidence", confidence(F.col("comp_count")))
