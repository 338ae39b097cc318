"""Group screens and peers over the listings of each part."""

from pyspark.sql import functions as F

from listwise.plans import groups as G
from listwise.plans import peers as P
from listwise.workloads import base as B
from listwise.workloads.registry import query

L = f"WITH {B.LISTINGS_SQL}"


@query("group_sizes", f"""{L}, s AS (SELECT count(*) AS n FROM listings WHERE active GROUP BY slab_key, seller % 10)
SELECT CASE WHEN n <= 1 THEN '1' WHEN n <= 2 THEN '2' WHEN n <= 3 THEN '3' WHEN n <= 5 THEN '4-5' ELSE '6+' END AS size,
       count(*) AS groups FROM s GROUP BY 1""")
def group_sizes(spark, sf):
    keyed = B.listings(spark, sf).where("active").select(
        F.concat_ws("/", "slab_key", F.col("seller") % 10).alias("slab_key"))
    return G.group_sizes(keyed)


@query("group_totals", f"""{L}, s AS (SELECT slab_key, count(*) AS a, count(*) FILTER (active AND shipping_cost IS NOT NULL) AS e
                                      FROM listings GROUP BY slab_key, seller % 10)
SELECT count(*) AS all_groups, count(*) FILTER (a >= 2) AS all_multi_groups,
       CAST(sum(a) FILTER (a >= 2) AS BIGINT) AS all_members_covered, count(*) FILTER (e >= 1) AS eligible_groups,
       count(*) FILTER (e >= 2) AS eligible_multi_groups, CAST(sum(e) FILTER (e >= 2) AS BIGINT) AS eligible_members_covered FROM s""")
def group_totals(spark, sf):
    df = B.listings(spark, sf).withColumn("slab_key", F.concat_ws("/", "slab_key", F.col("seller") % 10))
    return G.group_totals(df, F.col("active") & F.col("shipping_cost").isNotNull())


@query("spread_counts", f"""{L}, s AS (SELECT slab_key, count(*) AS n, max(price) / min(price) AS spread FROM listings
                                       GROUP BY slab_key, seller % 5)
SELECT count(*) AS multi_groups, count(*) FILTER (spread > 2) AS above_2x, count(*) FILTER (spread > 5) AS above_5x,
       count(*) FILTER (spread > 10) AS above_10x, count(*) FILTER (spread > 100) AS above_100x FROM s WHERE n > 1""")
def spread_counts(spark, sf):
    return G.spread_counts(B.listings(spark, sf).withColumn("slab_key", F.concat_ws("/", "slab_key", F.col("seller") % 5)))


@query("product_id_state", f"""{L}, e AS (SELECT slab_key, CASE WHEN line <> 3 THEN slab_key * 10 + CAST(quantity > 49 AS INTEGER) END AS epid
                                          FROM listings)
SELECT slab_key, count(*) AS n, CASE WHEN count(DISTINCT epid) > 1 THEN 'conflict'
  WHEN count(DISTINCT epid) = 1 AND count(epid) = count(*) THEN 'agree' ELSE 'partial' END AS state FROM e GROUP BY slab_key""")
def product_id_state(spark, sf):
    epid = F.when(F.col("line") != 3, F.col("slab_key") * 10 + (F.col("quantity") > 49).cast("int"))
    return G.product_id_state(B.listings(spark, sf).withColumn("epid", epid))


@query("title_divergence", f"""WITH {B.TITLED_SQL},
m AS (SELECT slab_key, {B.TITLE_TEXT_SQL} AS title FROM identity WHERE status = 'O'),
bare AS (SELECT slab_key, regexp_replace(regexp_replace(regexp_replace(title, '\\bPSA\\s*(10|[1-9](\\.5)?)\\b', ' ', 'g'), '#\\s*/\\s*\\d{{1,5}}\\b', ' ', 'g'),
   '\\b\\d{{1,4}}\\s*/\\s*\\d{{1,5}}\\b', ' ', 'g') AS title FROM m),
t AS (SELECT slab_key, unnest(list_distinct(list_filter(regexp_split_to_array(title, '[^A-Z0-9''./-]+'), lambda x: x NOT IN ('', 'PSA', 'ROOKIE', 'AUTO')))) AS token FROM bare),
n AS (SELECT slab_key, count(*) AS n FROM m GROUP BY slab_key)
SELECT slab_key, token, count(*) AS titles, any_value(n) AS n FROM t JOIN n USING (slab_key) GROUP BY ALL HAVING count(*) < any_value(n)""")
def title_divergence(spark, sf):
    return G.divergent_tokens(B.titled_items(spark, sf, "status = 'O'"))


# Members of a group as the screen expects them; the flags follow from item columns.
MEMBERS = f"""{L},
members AS (SELECT *, CASE WHEN slab_key % 23 = 0 AND line = 1 THEN 'LOW' ELSE 'MEDIUM' END AS identity_conf,
   CASE WHEN slab_key % 29 <> 0 THEN CAST(slab_key AS VARCHAR) END AS card_number,
   CASE WHEN slab_key % 31 = 0 AND line = 2 THEN 'LOW' ELSE 'HIGH' END AS parallel_conf,
   slab_key % 37 = 0 AND line = 3 AS odd_title FROM listings WHERE active),
flags AS (SELECT slab_key, count(*) AS n, CASE WHEN count(*) < 2 THEN 'group smaller than 2'
   WHEN bool_or(identity_conf = 'LOW') THEN 'LOW identity confidence in group'
   WHEN bool_or(card_number IS NULL) THEN 'missing card number / year / grade'
   WHEN bool_or(parallel_conf = 'LOW') THEN 'LOW parallel confidence'
   WHEN bool_or(odd_title) AND NOT bool_and(odd_title) THEN 'divergent titles within group' END AS reject_reason
   FROM members GROUP BY slab_key)"""


def members(spark, sf, parts: int = 0):
    key, line = F.col("slab_key"), F.col("line")
    df = B.listings(spark, sf).where("active").withColumns({
        "identity_conf": F.when((key % 23 == 0) & (line == 1), "LOW").otherwise("MEDIUM"),
        "card_number": F.when(key % 29 != 0, key.cast("string")), "year": F.lit(1990), "grade_value": F.lit("9"),
        "parallel_conf": F.when((key % 31 == 0) & (line == 2), "LOW").otherwise("HIGH"),
        "parallel": F.when(key % 2 == 0, "GOLD"),
        "title": F.concat(F.lit("1990 TOPPS #"), key.cast("string"),
                          F.when((key % 37 == 0) & (line == 3), " GLOSSY").otherwise(""), F.lit(" PSA 9"))})
    return df


@query("guardrail_counts", f"{MEMBERS} SELECT coalesce(reject_reason, 'screened') AS outcome, count(*) AS groups FROM flags GROUP BY 1")
def guardrail_counts(spark, sf):
    return G.guardrail_counts(members(spark, sf))


# The reference form of leave-one-out: every member beside every other member of its group.
PAIRS = f"""{MEMBERS},
ok AS (SELECT m.*, price + coalesce(shipping_cost, 0.0) AS total FROM members m JOIN flags USING (slab_key)
       WHERE reject_reason IS NULL),
{B.median_sql('mid', 'ok', 'slab_key', 'total', 'whole_mid')},
g AS (SELECT slab_key, count(*) AS size, min(total) AS gmin, max(total) AS gmax, any_value(whole_mid) AS mid
      FROM ok JOIN mid USING (slab_key) GROUP BY slab_key),
others AS (SELECT a.item_id, b.total AS t, b.total <= 5 * mid AND NOT (b.price >= 1000
             AND abs(b.price - round_even(b.price / 1000, 0) * 1000) < 0.005) AS kept
           FROM ok a JOIN ok b ON a.slab_key = b.slab_key AND a.item_id <> b.item_id JOIN g ON g.slab_key = a.slab_key),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY t) AS rn, count(*) OVER (PARTITION BY item_id) AS n FROM others WHERE kept),
loo AS (SELECT item_id, any_value(n) AS left_n, min(t) AS small, max(t) AS large,
               (min(t) FILTER (rn >= (n + 1) // 2) + min(t) FILTER (rn >= n // 2 + 1)) / 2 AS baseline FROM r GROUP BY item_id),
cand AS (SELECT ok.item_id, ok.slab_key, size, total, gmin, gmax, size - 1 - left_n AS trimmed, baseline,
                baseline - total AS gap, 100.0::DOUBLE * (baseline - total) / baseline AS pct_below
         FROM ok JOIN g USING (slab_key) JOIN loo USING (item_id)
         WHERE left_n >= 2 AND NOT (small > 0 AND large / small > 10) AND size >= 3 AND baseline > 0
           AND total < baseline AND baseline - total >= 5)"""
ANOMALY = ["item_id", "slab_key", "size", "total", "gmin", "gmax", "trimmed", "baseline", "gap", "pct_below"]


@query("anomaly_candidates", f"{PAIRS} SELECT {', '.join(ANOMALY)} FROM cand")
def anomaly_candidates(spark, sf):
    return G.anomaly_candidates(G.screened(members(spark, sf))).select(*ANOMALY)


@query("weak_pairs", f"""{L},
m AS (SELECT item_id, concat_ws('/', slab_key, seller % 10) AS slab_key, price, price + coalesce(shipping_cost, 0.0) AS total FROM listings WHERE active),
s AS (SELECT slab_key, count(*) AS size FROM m GROUP BY slab_key HAVING count(*) = 2)
SELECT a.item_id, a.slab_key, a.total, b.total AS baseline, b.total - a.total AS gap,
       100.0::DOUBLE * (b.total - a.total) / b.total AS pct_below
FROM m a JOIN s USING (slab_key) JOIN m b ON a.slab_key = b.slab_key AND a.item_id <> b.item_id
WHERE a.total < b.total AND b.total - a.total >= 5
  AND NOT (b.price >= 1000 AND abs(b.price - round_even(b.price / 1000, 0) * 1000) < 0.005)""")
def weak_pairs(spark, sf):
    df = B.listings(spark, sf).where("active").withColumn("slab_key", F.concat_ws("/", "slab_key", F.col("seller") % 10))
    return G.weak_pairs(df).select("item_id", "slab_key", "total", "baseline", "gap", "pct_below")


@query("group_statistics", f"""{L}, t AS (SELECT *, price + coalesce(shipping_cost, 0.0) AS total FROM listings),
{B.median_sql('mid', 't', 'slab_key', 'total', 'gmedian')}
SELECT item_id, min(total) OVER w AS gmin, max(total) OVER w AS gmax, gmedian, count(*) OVER w AS size
FROM t JOIN mid USING (slab_key) WINDOW w AS (PARTITION BY slab_key)""")
def group_statistics(spark, sf):
    df = B.listings(spark, sf).withColumn("total", F.col("price") + F.coalesce("shipping_cost", F.lit(0.0)))
    stats = G.group_median(df, ["slab_key"], "total", "gmedian", "size", lowest="gmin", highest="gmax")
    return df.select("item_id", "slab_key").join(stats, "slab_key").drop("slab_key")


@query("risk_sample", f"""{MEMBERS},
g AS (SELECT slab_key, count(*) AS n, min(parallel_conf) AS level, slab_key % 2 <> 0 AS plain,
   CASE WHEN count(nullif(price, 0)) >= 2 AND min(nullif(price, 0)) > 0 THEN max(nullif(price, 0)) / min(nullif(price, 0)) ELSE 1.0 END AS spread
   FROM members GROUP BY slab_key HAVING count(*) > 1),
b AS (SELECT slab_key, level || ' parallel confidence' AS bucket FROM g WHERE level IN ('HIGH', 'MEDIUM')
  UNION ALL SELECT slab_key, 'no parallel vocabulary' FROM g WHERE plain
  UNION ALL (SELECT slab_key, 'widest price spread' FROM g ORDER BY spread DESC, slab_key LIMIT 25)
  UNION ALL (SELECT slab_key, 'largest group size' FROM g ORDER BY n DESC, slab_key LIMIT 25)),
r AS (SELECT slab_key, bucket, row_number() OVER (PARTITION BY bucket ORDER BY sha1(slab_key || '|11'), slab_key) AS draw FROM b)
SELECT slab_key, bucket, n, spread, draw FROM r JOIN g USING (slab_key) WHERE draw <= 25""")
def risk_sample(spark, sf):
    """Seeded samples per risk bucket."""
    return G.sample_buckets(G.risk_buckets(members(spark, sf), 25), 25, 11).select(
        "slab_key", "bucket", "n", "spread", F.col("draw").cast("long").alias("draw"))


# --- peers ----------------------------------------------------------------------------

STATES = f"""{L},
peers AS (SELECT *, CASE WHEN line = 7 AND slab_key % 3 = 0 THEN 'x' || slab_key ELSE 's' || slab_key END AS eff_slab,
   's' || slab_key AS group_slab,
   CASE WHEN slab_key % 41 = 0 AND line = 1 THEN 'quarantined_material_conflict'
        WHEN slab_key % 43 = 0 AND line = 2 THEN 'not_enriched' ELSE 'verified' END AS cls,
   CASE WHEN seller % 11 = 0 THEN 'AUCTION_ONLY' ELSE 'FIXED_PRICE_ONLY' END AS sale_format,
   CASE WHEN shipping_cost IS NULL THEN 'CALCULATED_UNKNOWN' ELSE 'KNOWN' END AS shipping_state,
   seller % 17 <> 0 AS usd_proven, quantity <> 50 AS single_card, price + shipping_cost AS acquisition_total FROM listings),
judged AS (SELECT *, CASE WHEN eff_slab <> group_slab THEN 'different_slab_identity'
   WHEN cls <> 'verified' THEN 'identity_' || cls WHEN NOT active THEN 'not_active'
   WHEN sale_format <> 'FIXED_PRICE_ONLY' THEN 'no_genuine_fixed_price'
   WHEN shipping_state <> 'KNOWN' THEN 'shipping_' || shipping_state
   WHEN NOT usd_proven THEN 'usd_not_proven' WHEN NOT single_card THEN 'not_single_card' END AS reject_reason FROM peers),
best AS (SELECT group_slab, acquisition_total AS cost, item_id, count(*) OVER (PARTITION BY group_slab) AS eligible,
   row_number() OVER (PARTITION BY group_slab ORDER BY acquisition_total, item_id) AS rn FROM judged WHERE reject_reason IS NULL),
marked AS (SELECT *, item_id = min(item_id) OVER (PARTITION BY slab_key) AS is_candidate FROM peers)"""


def peers(spark, sf):
    key, line = F.col("slab_key"), F.col("line")
    return B.listings(spark, sf).withColumns({
        "eff_slab": F.concat(F.when((line == 7) & (key % 3 == 0), "x").otherwise("s"), key.cast("string")),
        "group_slab": F.concat(F.lit("s"), key.cast("string")),
        "cls": F.when((key % 41 == 0) & (line == 1), "quarantined_material_conflict")
        .when((key % 43 == 0) & (line == 2), "not_enriched").otherwise("verified"),
        "payload_state": F.lit("read"),
        "sale_format": F.when(F.col("seller") % 11 == 0, "AUCTION_ONLY").otherwise("FIXED_PRICE_ONLY"),
        "shipping_state": F.when(F.col("shipping_cost").isNull(), "CALCULATED_UNKNOWN").otherwise("KNOWN"),
        "usd_proven": F.col("seller") % 17 != 0, "single_card": F.col("quantity") != 50,
        "acquisition_total": F.col("price") + F.col("shipping_cost")})


def marked(spark, sf):
    df = peers(spark, sf)
    first = df.groupBy("slab_key").agg(F.min("item_id").alias("first_id"))
    return df.join(first, "slab_key").withColumn("is_candidate", F.col("item_id") == F.col("first_id")).drop("first_id")


@query("member_eligibility", f"""{STATES} SELECT coalesce(reject_reason, 'eligible') AS outcome, count(*) AS members FROM judged GROUP BY 1""")
def member_eligibility(spark, sf):
    return (P.with_eligibility(peers(spark, sf), "group_slab").groupBy(F.coalesce("reject_reason", F.lit("eligible")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("members")))


@query("cheapest_eligible", f"{STATES} SELECT group_slab, item_id, cost, eligible FROM best WHERE rn = 1")
def cheapest_eligible(spark, sf):
    return P.cheapest_eligible(P.with_eligibility(peers(spark, sf), "group_slab"), "group_slab")


@query("one_per_identity", f"""{STATES}, b AS (SELECT *, CAST(substr(group_slab, 2) AS BIGINT) // 2 AS effective FROM best WHERE rn = 1),
r AS (SELECT *, count(*) OVER (PARTITION BY effective) AS groups, row_number() OVER (PARTITION BY effective ORDER BY cost, item_id) AS k FROM b)
SELECT effective, item_id, cost, groups FROM r WHERE k = 1""")
def one_per_identity(spark, sf):
    best = P.cheapest_eligible(P.with_eligibility(peers(spark, sf), "group_slab"), "group_slab")
    return P.one_per_identity(best.withColumn(
        "effective", F.floor(F.substring("group_slab", 2, 20).cast("long") / 2)), "effective")


@query("group_outcome", f"""{STATES},
c AS (SELECT slab_key, eff_slab AS candidate_slab FROM marked WHERE is_candidate),
a AS (SELECT slab_key, any_value(candidate_slab) AS candidate_slab, count(*) AS n, count(*) FILTER (eff_slab = candidate_slab) AS same,
      CASE WHEN bool_or(cls = 'quarantined_material_conflict') THEN 'material_conflict'
           WHEN bool_or(cls = 'not_enriched') THEN 'unresolved_peer_identity'
           WHEN count(DISTINCT eff_slab) = 1 THEN 'confirmed_same_identity'
           WHEN count(*) FILTER (eff_slab = candidate_slab) >= 3 THEN 'split_but_candidate_group_viable'
           WHEN count(*) FILTER (eff_slab = candidate_slab) = 2 THEN 'split_weak_signal' ELSE 'candidate_isolated' END AS outcome
      FROM marked JOIN c USING (slab_key) GROUP BY slab_key)
SELECT * FROM a""")
def group_outcome(spark, sf):
    return P.group_outcomes(marked(spark, sf))


@query("rebuild_report", f"""{STATES},
t AS (SELECT *, price + coalesce(shipping_cost, 0.0) AS total FROM marked),
c AS (SELECT slab_key, eff_slab AS cs, total AS candidate_total, item_id AS candidate_id FROM t WHERE is_candidate),
o AS (SELECT slab_key, list(total ORDER BY total) AS a, list(total ORDER BY total) FILTER (eff_slab = cs) AS b
      FROM t JOIN c USING (slab_key) GROUP BY slab_key),
m AS (SELECT slab_key, candidate_id, candidate_total, a[len(a) // 2 + 1] AS old_median, b[len(b) // 2 + 1] AS new_median,
             len(a) AS n, len(b) AS subgroup, abs(candidate_total - b[1]) < 1e-9 AS still_lowest FROM o JOIN c USING (slab_key))
SELECT *, CASE WHEN subgroup = 1 THEN '1' WHEN subgroup = 2 THEN '2' ELSE '3+' END AS subgroup_size,
   subgroup >= 2 AND abs(100 * (old_median - candidate_total) / old_median - 100 * (new_median - candidate_total) / new_median) >= 10 AS discount_moved
FROM m""")
def rebuild_report(spark, sf):
    return P.rebuild_report(marked(spark, sf))


@query("slab_fates", f"""{STATES}, f AS (SELECT slab_key, cls <> 'not_enriched' AS enriched, eff_slab <> group_slab AS rekeyed FROM peers),
a AS (SELECT slab_key, count(*) AS original, count(*) FILTER (rekeyed) AS gone, count(*) FILTER (NOT enriched) AS unenriched FROM f GROUP BY slab_key)
SELECT *, original - gone AS remaining, CASE WHEN unenriched > 0 AND gone > 0 THEN 'unresolved'
  WHEN original - gone <= 1 THEN 'invalidated' WHEN gone > 0 THEN 'reduced' ELSE 'still viable' END AS fate FROM a""")
def slab_fates(spark, sf):
    return P.slab_fates(peers(spark, sf).withColumns({
        "enriched": F.col("cls") != "not_enriched", "rekeyed": F.col("eff_slab") != F.col("group_slab")}))


@query("export_candidates", f"""{STATES}
SELECT b.group_slab, b.item_id, b.cost, b.eligible, count(*) AS members,
       round(max(p.price + coalesce(p.shipping_cost, 0.0)) / min(p.price + coalesce(p.shipping_cost, 0.0)), 3) AS intra_slab_dispersion
FROM best b JOIN peers p USING (group_slab) WHERE rn = 1 GROUP BY ALL""")
def export_candidates(spark, sf):
    df = peers(spark, sf)
    return P.export_candidates(df, P.cheapest_eligible(P.with_eligibility(df, "group_slab"), "group_slab"), "group_slab")


@query("candidate_members", f"""{STATES}
SELECT p.group_slab, b.item_id AS candidate_item_id, p.item_id, p.price, p.shipping_cost, p.price + coalesce(p.shipping_cost, 0.0) AS total
FROM best b JOIN peers p USING (group_slab) WHERE rn = 1""")
def candidate_members(spark, sf):
    df = peers(spark, sf)
    return P.candidate_members(df, P.cheapest_eligible(P.with_eligibility(df, "group_slab"), "group_slab"), "group_slab")


@query("cheapest_peer_effect", f"""{STATES}
SELECT l.item_id, b.item_id AS peer_item_id, b.cost AS peer_cost, coalesce(l.item_id = b.item_id, false) AS already_cheapest,
  CASE WHEN l.shipping_cost IS NULL THEN l.price ELSE l.price + l.shipping_cost END - b.cost AS cost_reduction
FROM peers l LEFT JOIN (SELECT * FROM best WHERE rn = 1) b USING (group_slab)""")
def cheapest_peer_effect(spark, sf):
    from listwise.functions.values import candidate_cost
    from listwise.plans.valuation import cheapest_peer_effect as effect
    df = peers(spark, sf)
    best = P.cheapest_eligible(P.with_eligibility(df, "group_slab"), "group_slab")
    priced = df.withColumn("total_cost", candidate_cost(F.col("price"), F.col("shipping_cost"))[0])
    return effect(priced, best, "group_slab").select("item_id", "peer_item_id", "peer_cost", "already_cheapest", "cost_reduction")
