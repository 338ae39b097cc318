"""Sold rows composed from the line items, matched against one candidate per part."""

from pyspark.sql import functions as F

from listwise.functions import text as T
from listwise.plans import evidence as E
from listwise.plans import identity as I
from listwise.session import own_dir, settle
from listwise.sources import exports as X
from listwise.workloads import base as B
from listwise.workloads.registry import query

# One candidate per part; the part's residue disturbs one field. Titles of every eleventh part state no number.
CANDIDATES_SQL = f"""WITH {B.TITLED_SQL},
cands AS (SELECT slab_key_p AS p, 'v1|' || (1000000 + slab_key_p) || '|0' AS cid, year + CAST(slab_key_p % 5 = 3 AS INTEGER) AS c_year,
   ['TOPPS', 'PANINI', 'UPPER DECK', 'FLEER', 'TOPPS', NULL][m + 1] AS c_maker, CASE WHEN slab_key_p % 5 = 4 THEN 'X' || slab_key_p ELSE CAST(slab_key_p AS VARCHAR) END AS c_number,
   CASE WHEN slab_key_p % 5 = 1 THEN 'JO OTHER' ELSE first_name || ' ' || noun END AS c_subject,
   CASE WHEN slab_key_p % 5 = 2 THEN 'GOLD' WHEN tint IN ('RED', 'BLUE') THEN tint END AS c_parallel,
   ['', '', '', '', 'FINEST ', 'ACME '][m + 1] || p_type || CASE WHEN tint NOT IN ('RED', 'BLUE') AND tint <> p_type THEN ' ' || tint ELSE '' END || CASE WHEN nba THEN ' NBA' ELSE '' END AS c_set
   FROM parts),
comps AS (SELECT i.*, c.*, quantity = 13 AS lot FROM identity i JOIN cands c ON c.p = i.slab_key WHERE status = 'F'),
matched AS (SELECT *, CASE
   WHEN lot THEN 'disqualified' WHEN seller % 13 = 3 THEN 'rival_grader' WHEN grade_type IS NULL THEN 'ungraded'
   WHEN grade_type = 'AUTHENTIC' THEN 'grade_type' WHEN grade_value <> '9' THEN 'grade' WHEN grade_qualifier IS NOT NULL THEN 'qualifier'
   WHEN auto_grade IS NOT NULL THEN 'autograph_grade' WHEN is_auto = 1 THEN 'autograph_status' WHEN c_year <> year THEN 'year'
   WHEN c_number IS DISTINCT FROM card_number THEN 'card_number' WHEN print_run IS NOT NULL THEN 'print_run' WHEN c_subject = 'JO OTHER' THEN 'subject'
   WHEN p % 5 = 2 AND parallel IS NOT NULL THEN 'extra_parallel' WHEN p % 5 = 2 THEN 'missing_parallel' END AS code FROM comps),
reasoned AS (SELECT *, CASE code WHEN 'disqualified' THEN 'lot or multi-card listing' WHEN 'rival_grader' THEN 'graded by BGS, not PSA'
   WHEN 'ungraded' THEN 'raw/ungraded - no PSA grade in title' WHEN 'grade_type' THEN 'grade type AUTHENTIC != NUMERIC'
   WHEN 'grade' THEN 'PSA grade ' || grade_value || ' != 9' WHEN 'qualifier' THEN 'qualifier ' || grade_qualifier || ' != None'
   WHEN 'autograph_grade' THEN 'autograph grade ' || auto_grade || ' != None'
   WHEN 'autograph_status' THEN 'autograph status differs (comp=True, candidate=False)'
   WHEN 'year' THEN 'year ' || year || ' != ' || c_year WHEN 'card_number' THEN 'card number ' || coalesce(card_number, 'None') || ' != ' || c_number
   WHEN 'print_run' THEN 'print run ' || print_run || ' != None' WHEN 'subject' THEN 'subject ' || athlete || ' != JO OTHER'
   WHEN 'extra_parallel' THEN 'parallel/set differs - comp is [''' || parallel || '''], candidate is not'
   WHEN 'missing_parallel' THEN 'parallel/set differs - comp never states [''GOLD'']' END AS why FROM matched),
gated AS (SELECT *, CASE WHEN quantity = 17 THEN 'zero' WHEN line >= 5 OR line <= 2 THEN 'sale' WHEN line = 3 THEN 'active' ELSE 'cut' END AS gate,
   seller % 19 = 0 AS self, line = 5 AND quantity % 4 = 0 AS offer FROM reasoned),
decided AS (SELECT *, CASE WHEN offer THEN 'review_required' WHEN gate IN ('zero', 'active') THEN 'rejected' WHEN gate = 'cut' OR self THEN 'review_required'
     WHEN code IS NULL THEN 'accepted' WHEN code = 'missing_parallel' THEN 'review_required'
     WHEN code = 'card_number' AND card_number IS NULL AND NOT (p % 5 = 2 AND parallel IS NOT NULL) THEN 'review_required' ELSE 'rejected' END AS state,
   CASE WHEN offer THEN 'best offer with no reliable accepted price - the displayed amount is an asking or strike-through price, not the transaction total'
     WHEN gate = 'zero' THEN CASE WHEN self THEN 'same_listing_duplicate' ELSE 'not_a_sale' END || ' - quantity_sold is zero'
     WHEN gate = 'active' THEN CASE WHEN self THEN 'same_listing_duplicate' ELSE 'not_a_sale' END || ' - active-listing layout; missing Exclude listing and sale format'
     WHEN gate = 'cut' THEN CASE WHEN self THEN 'cancelled_or_relisted_sale' ELSE 'uncertain' END || ' - row truncated by pagination; structure cannot be established'
     WHEN self THEN 'cancelled_or_relisted_sale - same eBay listing as the candidate (item ' || (1000000 + p) || '); the card is listed again, so completion is unproven'
     WHEN code = 'card_number' AND card_number IS NULL AND p % 5 = 2 AND parallel IS NOT NULL
       THEN 'parallel/set differs - comp is [''' || parallel || '''], candidate is not'
     WHEN code = 'missing_parallel' OR (code = 'card_number' AND card_number IS NULL) THEN why || ' (field absent from title, not a conflict)' ELSE why END AS reason FROM gated)"""

# Classification repairs a second "#", as in "#2/199", into "2/199" first, after which "AUTO 2/199" reads as an autograph grade.
_REPAIRED = "CASE WHEN line = 2 AND (seller % 7 = 0 OR (seller % 7 = 2 AND numbered)) AND quantity <= 10 THEN CAST(quantity AS VARCHAR) {other} END AS auto_grade"
CLASSIFIED_SQL = CANDIDATES_SQL.replace(
    "SELECT i.*, c.*", f"SELECT i.* REPLACE ({_REPAIRED.format(other='ELSE auto_grade')}), c.*")
# The same sales with every numeric grade read as a plain nine.
NINES_SQL = CANDIDATES_SQL.replace(
    "SELECT i.*, c.*", f"""SELECT i.* REPLACE ({_REPAIRED.format(other='')}, CAST(line = 2 AS INTEGER) AS is_auto,
      CASE WHEN grade_type = 'NUMERIC' THEN '9' ELSE grade_value END AS grade_value, NULL::VARCHAR AS grade_qualifier), c.*""")


def candidates(spark, sf):
    p, tint = F.col("p_partkey"), F.upper(F.substring_index("p_name", " ", 1))
    colour = F.when(tint.isin("RED", "BLUE"), tint)
    return B.table(spark, sf, "part").select(
        F.concat(F.lit("v1|"), (p + 1000000).cast("string"), F.lit("|0")).alias("item_id"), p.alias("slab_key"),
        (F.col("p_size") + 1960 + (p % 5 == 3).cast("int")).alias("year"),
        F.get(F.array(*[F.lit(m) for m in ("TOPPS", "PANINI", "UPPER DECK", "FLEER", "TOPPS")]), (p % 6).cast("int")).alias("manufacturer"),
        F.concat_ws(" ", F.when(p % 6 == 4, "FINEST").when(p % 6 == 5, "ACME"), "p_type", F.when(colour.isNull() & (tint != F.col("p_type")), tint), F.when(p % 19 == 0, "NBA")).alias("set"),
        F.when(p % 5 == 1, "JO OTHER").otherwise(F.concat_ws(
            " ", F.when(p % 17 == 0, "JOSE").otherwise("SAM"), F.upper(F.substring_index("p_name", " ", -1)))).alias("subject"),
        F.when(p % 5 == 4, F.concat(F.lit("X"), p.cast("string"))).otherwise(p.cast("string")).alias("card_number"),
        F.when(p % 5 == 2, "GOLD").otherwise(colour).alias("parallel"), F.lit(None).cast("int").alias("print_run"),
        F.lit("9").alias("psa_grade"), F.lit("NUMERIC").alias("grade_type"), F.lit(None).cast("string").alias("qualifier"),
        F.lit(0).alias("is_auto"), F.lit(None).cast("string").alias("auto_grade"))


def sold_titles(spark, sf):
    df = B.titled_items(spark, sf, "status = 'F'")
    own = (F.col("slab_key") + 1000000).cast("string")
    line = F.col("line")
    offer = (line == 5) & (F.col("quantity") % 4 == 0)
    return df.select(
        "item_id", "slab_key", "line", "quantity", F.concat(F.lit("v1|"), own, F.lit("|0")).alias("candidate_item_id"),
        F.concat(F.col("title"), F.when(F.col("quantity") == 13, " Lot").otherwise("")).alias("raw_title"),
        F.concat(F.when(F.col("seller") % 19 == 0, own).otherwise("77000001"), F.lit("-a1")).alias("source_item_id"),
        F.when(line == 1, "$5.00 Fixed price Exclude listing").when(line == 3, "Edit Sell Similar")
        .when(line == 4, "Edit 50 results per page").alias("raw_text"),
        F.when(line >= 5, F.when(offer, "BEST_OFFER").otherwise("FIXED_PRICE")).alias("sale_type"),
        F.when(F.col("quantity") == 17, "0").otherwise("1").alias("quantity_sold"),
        F.when(~offer, F.col("price")).alias("sold_price"), F.when(~offer, F.col("price")).alias("total_price"),
        F.col("day").alias("sale_date"))


def classified(spark, sf):
    return E.classify_comps(sold_titles(spark, sf), candidates(spark, sf))


@query("classify_comps", f"{CLASSIFIED_SQL} SELECT item_id, cid AS candidate_item_id, state, reason FROM decided")
def classify_comps(spark, sf):
    return classified(spark, sf).select("item_id", "candidate_item_id", "state", "reason")


@query("match_reasons", f"{CANDIDATES_SQL} SELECT coalesce(code, 'match') AS code, count(*) AS comps FROM matched GROUP BY 1")
def match_reasons(spark, sf):
    joined = sold_titles(spark, sf).join(E.prefixed(candidates(spark, sf)), F.col("candidate_item_id") == F.col("c_item_id"))
    matched = E.with_match(I.parse_titles(joined, "raw_title", "p_"))
    return matched.groupBy(F.coalesce("match_code", F.lit("match")).alias("code")).agg(F.count(F.lit(1)).alias("comps"))


# Twins of every 23rd candidate make its titles ambiguous. Candidates of a grade that no title has are never accepted, but are the
# same card as titles without a number: by subject, or, lacking one themselves, by year alone.
NEAR_SQL = f"""{CANDIDATES_SQL},
pool AS (SELECT cid, p, c_year, c_number, c_subject, false AS unlike FROM cands
  UNION ALL SELECT 'twin|' || (1000000 + p), p, c_year, c_number, c_subject, false FROM cands WHERE p % 23 = 0
  UNION ALL SELECT 'bare|' || (1000000 + p), p, c_year, NULL, CASE WHEN p % 8 <> 0 THEN c_subject END, true FROM cands WHERE p % 4 = 0),
subject AS (SELECT DISTINCT year, card_number, athlete FROM matched),
fit AS (SELECT s.*, count(o.cid) AS n, min(o.cid) AS id FROM subject s LEFT JOIN pool o ON o.c_year IS NOT DISTINCT FROM s.year
   AND o.c_number IS NOT DISTINCT FROM s.card_number AND (s.athlete IS NULL OR o.c_subject IS NULL
     OR contains(replace(s.athlete, ' ', ''), replace(o.c_subject, ' ', '')) OR contains(replace(o.c_subject, ' ', ''), replace(s.athlete, ' ', '')))
   GROUP BY ALL),
near AS (SELECT m.item_id, n, id FROM matched m JOIN fit f ON f.year IS NOT DISTINCT FROM m.year AND f.card_number IS NOT DISTINCT FROM m.card_number
   AND f.athlete IS NOT DISTINCT FROM m.athlete)"""


def pooled_candidates(spark, sf):
    given = candidates(spark, sf)
    number = (F.col("slab_key") + 1000000).cast("string")
    twins = given.where("slab_key % 23 = 0").withColumn("item_id", F.concat(F.lit("twin|"), number))
    bare = given.where("slab_key % 4 = 0").withColumns({
        "item_id": F.concat(F.lit("bare|"), number), "card_number": F.lit(None).cast("string"), "psa_grade": F.lit("4.5"),
        "subject": F.when(F.col("slab_key") % 8 != 0, F.col("subject"))})
    return given.unionByName(twins).unionByName(bare)


def attributed_titles(spark, sf):
    return E.attribute(sold_titles(spark, sf).select("item_id", "raw_title"), pooled_candidates(spark, sf))


@query("attribute_rows", f"""{NEAR_SQL}
SELECT item_id, CASE WHEN code IS NULL THEN CASE WHEN p % 23 <> 0 THEN cid END WHEN n = 1 THEN id END AS candidate_item_id,
  CASE WHEN code IS NULL AND p % 23 = 0 THEN 'row matches 2 candidates ambiguously' WHEN code IS NOT NULL AND n <> 1 THEN 'row matches no pilot candidate' END AS attribution_error,
  CASE WHEN code IS NULL AND p % 23 = 0 THEN 'twin|' || (1000000 + p) || ' x2' END AS ambiguous
FROM matched JOIN near USING (item_id)""")
def attribute_rows(spark, sf):
    shown = F.array_join(F.transform("ambiguous", lambda a: F.concat(a["item_id"], F.lit(" x"), a["copies"].cast("string"))), ", ")
    return attributed_titles(spark, sf).select("item_id", "candidate_item_id", "attribution_error", shown.alias("ambiguous"))


@query("ambiguous_candidates", f"""{CANDIDATES_SQL},
hit AS (SELECT DISTINCT p FROM matched WHERE code IS NULL AND p % 23 = 0)
SELECT cid AS candidate_item_id FROM cands JOIN hit USING (p) UNION ALL SELECT 'twin|' || (1000000 + p) FROM hit""")
def ambiguous_candidates(spark, sf):
    found = E.ambiguous_candidates(attributed_titles(spark, sf), pooled_candidates(spark, sf))
    return found.select("candidate_item_id").distinct()


@query("year_disagreement", f"""{NINES_SQL},
y AS (SELECT cid, year, count(*) AS n FROM decided WHERE state = 'rejected' AND code = 'year' AND gate = 'sale' GROUP BY ALL),
a AS (SELECT DISTINCT cid FROM decided WHERE state = 'accepted')
SELECT cid AS candidate_item_id, c_year AS candidate_year, year AS observed_year, n AS supporting_comps, 'candidate_year_disagreement' AS flag
FROM y JOIN cands USING (cid) WHERE n >= 5 AND cid NOT IN (SELECT cid FROM a)""")
def year_disagreement(spark, sf):
    nines = F.regexp_replace("raw_title", r"PSA (10|[1-9])( \(OC\)| MC)?( AUTO 10)?", "PSA 9")
    rows = E.classify_comps(sold_titles(spark, sf).withColumn("raw_title", nines), candidates(spark, sf))
    rows = settle(rows.select("candidate_item_id", "state", "reason_code", "p_year"))
    return E.year_disagreement(candidates(spark, sf), rows)


@query("item_number", f"""{CANDIDATES_SQL} SELECT CASE WHEN seller % 19 = 0 THEN CAST(1000000 + p AS VARCHAR) ELSE '77000001' END AS number,
  count(*) AS rows FROM comps GROUP BY 1""")
def item_number(spark, sf):
    return (sold_titles(spark, sf).groupBy(T.item_number(F.col("source_item_id")).alias("number"))
            .agg(F.count(F.lit(1)).alias("rows")))


@query("import_sold", f"""WITH {B.ITEMS_SQL}
SELECT item_id, price AS sold_price, shipping_cost AS shipping, price + coalesce(shipping_cost, 0.0) AS total_price,
  ['USD', 'GBP', 'EUR', 'USD'][(seller % 4) + 1] AS currency, day AS sale_date, CAST(line = 5 AS INTEGER) AS best_offer,
  CAST(line <> 5 OR quantity % 2 = 0 AS INTEGER) AS actual_price_known,
  CASE WHEN seller % 4 IN (0, 3) THEN price + coalesce(shipping_cost, 0.0) END AS converted_total FROM items WHERE status = 'F'""")
def import_sold(spark, sf):
    df = B.items(spark, sf).where("status = 'F'")
    s = F.col("seller") % 4
    # One spelling per line number, un-padded ones among them; the day comes first only where it can be no month.
    dates = F.coalesce(*[F.when(F.col("line") == n, F.date_format("day", spelling)) for n, spelling in enumerate(
        ("yyyy-MM-dd", "MMM d, yyyy", "yyyy/MM/dd", "yyyy-M-d", "M/d/yyyy"), 1)],
        F.when((F.col("line") == 6) & (F.dayofmonth("day") > 12), F.date_format("day", "d/M/yyyy")), F.date_format("day", "M-d-yyyy"))
    rows = df.select(
        "item_id", F.concat(F.lit("$"), F.col("price").cast("string")).alias("sold_price"),
        F.col("shipping_cost").cast("string").alias("shipping"),
        F.when(s == 0, "").when(s == 1, "gbp ").when(s == 2, "EUR").otherwise("usd").alias("currency"),
        dates.alias("sale_date"), F.when(F.col("line") == 5, "Yes").otherwise("no").alias("best_offer_indicator"),
        F.when(F.col("line") == 5, F.when(F.col("quantity") % 2 == 0, "true").otherwise("false")).otherwise("").alias("actual_price_known"),
        F.lit("").alias("displayed_original_price"))
    return E.shape_sold_rows(rows).select("item_id", "sold_price", "shipping", "total_price", "currency", "sale_date",
                                          "best_offer", "actual_price_known", "converted_total")


# The name of every 37th subject begins with the grader's, which then is stated once only: the query does not state the grade.
_QUERIES_SQL = f"""{CANDIDATES_SQL},
named AS (SELECT * REPLACE (CASE WHEN p % 37 = 0 THEN 'PSA ' || c_subject ELSE c_subject END AS c_subject) FROM cands),
q AS (SELECT *, concat_ws(' ', c_year, c_subject, c_maker, c_set, '#' || c_number, c_parallel, 'PSA', '9') AS raw FROM named),
asked AS (SELECT *, array_to_string(list_filter(string_split(raw, ' '), lambda x, i: list_position(string_split(raw, ' '), x) = i), ' ') AS search_query,
  CASE WHEN p % 37 = 0 THEN 'grade' ELSE '' END AS violations, 'subject|year|card_number|psa_grade|parallel|autograph_status' AS fields_that_must_match,
  'card_number|psa_grade' || CASE WHEN c_parallel IS NOT NULL THEN '|parallel' ELSE '' END AS fields_that_must_not_be_relaxed FROM q)"""


def asked_queries(spark, sf):
    named = F.when(F.col("slab_key") % 37 == 0, F.concat(F.lit("PSA "), F.col("subject"))).otherwise(F.col("subject"))
    return E.research_queries(candidates(spark, sf).withColumn("subject", named))


@query("research_queries", f"""{_QUERIES_SQL}
SELECT cid AS item_id, search_query, violations, violations = '' AS sendable, fields_that_must_match, fields_that_must_not_be_relaxed, c_parallel IS NULL AS relaxed_allowed FROM asked""")
def research_queries(spark, sf):
    return asked_queries(spark, sf).select("item_id", "search_query", "violations", "sendable", "fields_that_must_match",
                                           "fields_that_must_not_be_relaxed", "relaxed_allowed")


@query("research_file", f"""{_QUERIES_SQL}
SELECT cid AS candidate_item_id, CASE WHEN c_parallel IS NULL THEN 'base' ELSE 'parallel/serial' END AS candidate_type, 'STRICT' AS query_tier, search_query,
  CAST(c_year AS VARCHAR) AS year, c_subject AS subject, c_maker AS manufacturer, c_set AS set_name, c_number AS card_number, c_parallel AS parallel,
  NULL::VARCHAR AS qualifier, 'no' AS autograph_status, fields_that_must_not_be_relaxed FROM asked WHERE violations = ''""")
def research_file(spark, sf):
    """Queries that may be sent, written as a file and read back."""
    path = own_dir(spark)
    X.write_report(X.research_file(asked_queries(spark, sf), F.when(F.col("parallel").isNull(), "base").otherwise("parallel/serial")), path, "csv")
    return X.read_research_file(spark, path).select(
        "candidate_item_id", "candidate_type", "query_tier", "search_query", "year", "subject", "manufacturer", "set_name", "card_number", "parallel",
        "qualifier", "autograph_status", "fields_that_must_not_be_relaxed")


@query("candidate_file", f"""{CANDIDATES_SQL}
SELECT cid AS item_id, c_year AS year, c_maker AS manufacturer, c_set AS set, c_subject AS subject, c_number AS card_number, c_parallel AS parallel,
  '9' AS psa_grade, 'NUMERIC' AS grade_type, NULL::VARCHAR AS qualifier, 0 AS is_auto FROM cands""")
def candidate_file(spark, sf):
    """The pool written as JSON and read back."""
    path = own_dir(spark)
    X.write_report(candidates(spark, sf).drop("slab_key"), path, "json")
    return X.read_candidates(spark, path, multi_line=False).select(
        "item_id", "year", "manufacturer", "set", "subject", "card_number", "parallel", "psa_grade", "grade_type", "qualifier", "is_auto")


@query("query_token_sources", f"""{CANDIDATES_SQL},
t AS (SELECT source, count(*) AS terms FROM (SELECT unnest(['candidate.year', 'candidate.card_number', 'candidate.psa_grade', 'candidate.psa_grade']) AS source FROM cands
   UNION ALL SELECT 'candidate.subject' FROM cands, range(2) UNION ALL SELECT 'candidate.manufacturer' FROM cands, range(2) t(i) WHERE c_maker = 'UPPER DECK' OR (i = 0 AND c_maker IS NOT NULL)
   UNION ALL SELECT 'candidate.parallel' FROM cands WHERE c_parallel IS NOT NULL
   UNION ALL SELECT 'candidate.set' FROM (SELECT unnest(string_split(c_set, ' ')) FROM cands)) GROUP BY 1)
SELECT * FROM t""")
def query_token_sources(spark, sf):
    return (E.query_token_sources(E.research_queries(candidates(spark, sf))).groupBy("source")
            .agg(F.count(F.lit(1)).alias("terms")))


@query("reusable_evidence", f"""{CLASSIFIED_SQL}
SELECT p % 50 AS eff_slab, count(*) AS comps FROM decided WHERE state = 'accepted' AND p % 50 <> 0 GROUP BY 1""")
def reusable_evidence(spark, sf):
    keyed = candidates(spark, sf).select("item_id", F.when(F.col("slab_key") % 50 != 0, F.col("slab_key") % 50).alias("eff_slab"))
    return E.reusable_comps(classified(spark, sf), keyed).groupBy("eff_slab").agg(F.count(F.lit(1)).alias("comps"))


@query("pending_work", f"""{CANDIDATES_SQL} SELECT cid AS item_id FROM cands WHERE p % 3 <> 0""")
def pending_work(spark, sf):
    cands = candidates(spark, sf)
    runs = cands.select(F.col("item_id").alias("candidate_id"), F.when(F.col("slab_key") % 3 == 0, "completed")
                        .when(F.col("slab_key") % 3 == 1, "failed").otherwise("running").alias("status"))
    return E.pending_work(cands, runs, ("completed", "no_results", "failed"), retry_failed=True).select("item_id")


@query("uncertain_evidence", f"""{CLASSIFIED_SQL}
SELECT item_id, cid AS candidate_item_id FROM decided WHERE state = 'review_required' AND self AND NOT offer AND gate = 'sale'""")
def uncertain_evidence(spark, sf):
    return E.uncertain_evidence(classified(spark, sf)).select("item_id", "candidate_item_id")


# Line 6 is imported twice, line 5 twice in equal rows; line 7 is stored already.
@query("import_ledger", f"""{CANDIDATES_SQL},
near AS (SELECT m.item_id, count(o.cid) AS n, min(o.cid) AS id FROM matched m LEFT JOIN cands o ON o.c_year = m.year AND o.c_number = m.card_number
   AND (contains(replace(m.athlete, ' ', ''), replace(o.c_subject, ' ', '')) OR contains(replace(o.c_subject, ' ', ''), replace(m.athlete, ' ', '')))
   GROUP BY m.item_id),
a AS (SELECT item_id, line, CASE WHEN code IS NULL THEN cid WHEN n = 1 THEN id END AS candidate_item_id FROM matched JOIN near USING (item_id)),
batch AS (SELECT *, item_id AS row_id, false AS twice FROM a UNION ALL SELECT *, item_id || '-again', false FROM a WHERE line = 6
  UNION ALL SELECT *, item_id, true FROM a WHERE line = 5)
SELECT row_id, candidate_item_id, CASE WHEN candidate_item_id IS NULL THEN 'unattributed' WHEN line = 7 OR row_id <> item_id OR twice THEN 'duplicate' ELSE 'added' END AS status,
  CASE WHEN candidate_item_id IS NULL THEN 'row matches no pilot candidate' END AS attribution_error FROM batch""")
def import_ledger(spark, sf):
    sold = sold_titles(spark, sf).select(
        "line", F.col("item_id").alias("row_id"), F.col("item_id").alias("source_item_id"), "raw_title", F.lit("export").alias("source"),
        F.col("sold_price").cast("string").alias("sold_price"), F.lit("").alias("shipping"), F.lit("USD").alias("currency"),
        F.date_format("sale_date", "M/d/yyyy").alias("sale_date"))
    again = sold.where("line = 6").withColumn("row_id", F.concat("row_id", F.lit("-again")))
    stored = E.attribute(sold.where("line = 7"), candidates(spark, sf)).select(
        "candidate_item_id", "source", F.col("source_item_id").alias("sale_key"))
    batch = sold.unionByName(again).unionByName(sold.where("line = 5"))
    return E.import_ledger(batch, candidates(spark, sf), stored, "row_id").select(
        "row_id", "candidate_item_id", "status", "attribution_error")
