"""What changed and what must not: re-decisions, immutability, accounting, summaries."""

from pyspark.sql import Column, DataFrame, functions as F

from listwise import fixed_values as V
from listwise.functions import text as T
from listwise.operators.order_stats import group_median
from listwise.plans.evidence import CANDIDATE_FIELDS, classify_comps
from listwise.plans.valuation import benchmark, decision_columns


#: The version of the rules; a new one makes every stored decision stale.
RULE_VERSION = "1"
_DECIDED_BY = ("raw_title", "source_item_id", "raw_text", "sale_type", "sale_format", "quantity_sold", "best_offer", "actual_price_known",
               "total_price", "sold_price", "displayed_original_price")


def _fingerprint(df: DataFrame, columns) -> Column:
    fields = [F.col(n).cast("string") if n in df.columns else F.lit(None).cast("string") for n in columns]
    return F.sha2(F.to_json(F.struct(*[f.alias(f"f{i}") for i, f in enumerate(fields)]), {"ignoreNullFields": "false"}), 256)


def with_digest(stored: DataFrame, candidates: DataFrame, version: str = RULE_VERSION, name: str = "digest") -> DataFrame:
    """``stored`` with a digest of all that decides a row: its own inputs, its candidate's fields, and the rules' version.

    NULL for a row whose candidate is gone.
    """
    cand = candidates.select(F.col("item_id").alias("__cid"), _fingerprint(candidates, [n for n in CANDIDATE_FIELDS]).alias("__cand"))
    df = stored.withColumn("__own", _fingerprint(stored, _DECIDED_BY)).join(cand, F.col("candidate_item_id") == F.col("__cid"), "left")
    digest = F.when(F.col("__cand").isNotNull(), F.sha2(F.concat_ws("|", F.lit(version), "__own", "__cand"), 256))
    return df.withColumn(name, digest).drop("__cid", "__own", "__cand")


def stale_rows(stored: DataFrame, candidates: DataFrame, version: str = RULE_VERSION) -> DataFrame:
    """Stored rows (with ``digest``, ``state``, ``reason_code``, ``reason``) to decide again: those whose digest is no longer the stored one."""
    now = with_digest(stored, candidates, version, "__now")
    return now.where(F.col("__now").isNotNull() & ~F.col("__now").eqNullSafe(F.col("digest"))).withColumn("digest", F.col("__now")).drop("__now")


def reclassified(stored: DataFrame, candidates: DataFrame, version: str = RULE_VERSION) -> DataFrame:
    """Every stored row with the state that today's rules give it, and its new digest.

    Only rows that moved - their inputs, their candidate or the rules - are read as titles; all others
    keep their state as it is, and so do rows whose candidate is gone. A plan; writing it is the caller's step.
    """
    kept = [n for n in stored.columns if n not in ("state", "reason_code", "reason", "digest")]
    decided = ["state", "reason_code", "reason", "digest"]
    again = classify_comps(stale_rows(stored, candidates, version).drop("state", "reason_code", "reason"), candidates)
    now = with_digest(stored, candidates, version, "__now")
    same = now.where(F.col("__now").isNull() | F.col("__now").eqNullSafe(F.col("digest"))).drop("__now")
    return same.select(*kept, *decided).unionByName(again.select(*kept, *decided))


def reclassify_diff(before: DataFrame, after: DataFrame, row: str = "row_id") -> DataFrame:
    """Rows whose state moved, with old and new state, reason and the rule responsible."""
    old = before.select(row, F.col("state").alias("old_state"), F.col("reason").alias("old_reason"))
    new = after.select(row, F.col("state").alias("new_state"), F.col("reason").alias("new_reason"))
    moved = old.join(new, row).where(~F.col("old_state").eqNullSafe(F.col("new_state")))
    return moved.withColumns({"old_rule": T.rule_for(F.col("old_reason")),
                              "rule_responsible": T.rule_for(F.col("new_reason"))})


def prove_immutable(before: DataFrame, after: DataFrame, row: str, columns: list[str]) -> DataFrame:
    """One row: ids added, removed and mutated between two snapshots.

    Both sides shrink to (id, hash) before the join; a pair of 64-bit hashes stands for
    the columns.
    """
    def digest(df, name):
        fields = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
        return df.select(row, F.struct(F.xxhash64(*fields), F.xxhash64(F.lit(7), *fields)).alias(name))

    both = digest(before, "b").join(digest(after, "a"), row, "full_outer")
    return both.agg(F.count_if(F.col("b").isNull()).alias("added"), F.count_if(F.col("a").isNull()).alias("removed"),
                    F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).alias("mutated"),
                    F.count(F.lit(1)).alias("ids"))


def membership_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Added and removed keys."""
    b = before.select(*keys).distinct().withColumn("__b", F.lit(True))
    a = after.select(*keys).distinct().withColumn("__a", F.lit(True))
    both = b.join(a, keys, "full_outer").where(F.col("__a").isNull() | F.col("__b").isNull())
    return both.select(*keys, F.when(F.col("__b").isNull(), F.lit("added")).otherwise(F.lit("removed")).alias("change"))


def accounting(extracted: DataFrame, classified: DataFrame, row: str = "source_item_id") -> DataFrame:
    """One row: states sum to the unique extracted ids, with the missing and unexpected ids counted."""
    unique = extracted.select(row).groupBy(row).agg(F.count(F.lit(1)).alias("copies"))
    states = classified.groupBy(row).agg(F.max("state").alias("state"))
    both = unique.join(states, row, "full_outer")
    out = both.agg(
        F.count("copies").alias("unique_extracted"), F.count_if(F.col("copies") > 1).alias("collisions"),
        *[F.count_if(F.col("state") == s).alias(s) for s in ("accepted", "rejected", "review_required")],
        F.count_if(F.col("state").isNull()).alias("missing"), F.count_if(F.col("copies").isNull()).alias("unexpected"))
    return out.withColumn("balanced", (F.col("missing") == 0) & (F.col("unexpected") == 0) & (
        F.col("accepted") + F.col("rejected") + F.col("review_required") == F.col("unique_extracted")))


def duplicate_ids(rows: DataFrame, row: str) -> DataFrame:
    return (rows.where(F.col(row).isNotNull()).groupBy(row).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > 1))


def state_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows by state per key, one partially aggregated pass."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col("state") == s).alias(s) for s in ("accepted", "rejected", "review_required")])


def reason_counts(rows: DataFrame, reason: str = "reason") -> DataFrame:
    return (rows.groupBy(F.coalesce(F.col(reason), F.lit("(no reason recorded)")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def candidate_snapshot(listings: DataFrame, comps: DataFrame, today, key: str) -> DataFrame:
    """Counts, benchmark and decision of each candidate as stored; comps carry ``state``."""
    counts = state_counts(comps, key)
    priced = benchmark(comps.where("state = 'accepted'"), key)
    df = listings.join(counts, key, "left").join(priced, key, "left")
    return decision_columns(df, today)


def snapshot_change(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Candidates whose counts, median or decision differ between two snapshots."""
    fields = ["accepted", "rejected", "review_required", "median_total", "decision", "confidence"]
    b = before.select(key, *[F.col(f).alias(f"{f}_before") for f in fields])
    a = after.select(key, *[F.col(f).alias(f"{f}_after") for f in fields])
    both = b.join(a, key, "full_outer")
    changed = F.lit(False)
    for f in fields:
        changed = changed | ~F.col(f"{f}_before").eqNullSafe(F.col(f"{f}_after"))
    return both.where(changed).withColumn(
        "decision_changed", ~F.col("decision_before").eqNullSafe(F.col("decision_after")))


def cohort_summary(per_candidate: DataFrame, cohort: str = "cohort", total_label: str = "PROJECT TOTAL") -> DataFrame:
    """Per cohort and over all: candidates, rows, states and percentages, by one rollup."""
    sums = per_candidate.rollup(cohort).agg(
        F.count(F.lit(1)).alias("unique_candidates"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (
            "rows", "accepted", "rejected", "review_required")],
        F.count_if(F.col("rows") > 0).alias("query_success"), F.count_if(F.col("sufficient")).alias("evidence_sufficient"),
        F.grouping(cohort).alias("__all"))
    share = lambda a, b: F.round(100.0 * F.col(a) / F.nullif(F.col(b), F.lit(0)), 1)
    return sums.withColumns({
        cohort: F.when(F.col("__all") == 1, F.lit(total_label)).otherwise(F.col(cohort)),
        "query_success_pct": share("query_success", "unique_candidates"),
        "acceptance_pct": share("accepted", "rows"), "review_pct": share("review_required", "rows"),
        "sufficiency_pct": share("evidence_sufficient", "unique_candidates")}).drop("__all")


def distribution(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Per key, "value:count" pairs of a column with few values, as one text."""
    counts = df.groupBy(key, value.cast("string").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    pair = F.concat_ws(":", F.coalesce("__v", F.lit("none")), F.col("__n").cast("string"))
    return counts.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(pair)), ",").alias(name))


def seller_profiles(listings: DataFrame, seller: str = "seller") -> DataFrame:
    """Per seller: counts, price median and range, grade and grader distributions, completeness."""
    plain = listings.groupBy(seller).agg(
        F.count(F.lit(1)).alias("observed"), F.count_if("single_card").alias("singles"),
        F.count_if(~F.col("single_card")).alias("non_singles"), F.count("grader").alias("names_a_grader"),
        F.count_if("complete").alias("identity_complete"))
    prices = group_median(listings, [seller], "price", "price_median", "__n", lowest="price_min", highest="price_max").drop("__n")
    out = plain.join(prices, seller).join(distribution(listings, seller, F.col("grader"), "grader_distribution"), seller)
    out = out.join(distribution(listings.where("complete"), seller, F.col("grade_value"), "grade_distribution"), seller, "left")
    return out.withColumn("identity_complete_pct", F.round(100.0 * F.col("identity_complete") / F.col("observed"), 1))


def funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows leaving at each ordered exclusion, and the rows left, in one aggregation."""
    reason = None
    for name, test in steps.items():
        test = F.coalesce(test, F.lit(False))
        reason = F.when(test, F.lit(name)) if reason is None else reason.when(test, F.lit(name))
    marked = df.select(reason.otherwise(F.lit("eligible")).alias("__r"))
    return marked.agg(F.count(F.lit(1)).alias("population"), *[
        F.count_if(F.col("__r") == name).alias(name) for name in (*steps, "eligible")])


def key_overlap(left: DataFrame, right: DataFrame, key: str, with_comps: DataFrame) -> DataFrame:
    """Distinct keys two populations share, and how many of those carry comps."""
    shared = (left.select(key).where(F.col(key).isNotNull()).distinct()
              .join(right.select(key), key, "left_semi"))
    comps = with_comps.select(key, F.lit(True).alias("__c")).distinct()
    return shared.join(comps, key, "left").agg(F.count(F.lit(1)).alias("shared_keys"), F.count("__c").alias("carrying_comps"))


def rebuild_plan(members: DataFrame, cached: DataFrame, item: str = "item_id") -> DataFrame:
    """Member work still to do: members without a stored second source."""
    return members.select(item).distinct().join(cached.select(item), item, "left_anti")


def outside_scope(planned: DataFrame, members: DataFrame, item: str = "item_id") -> DataFrame:
    """How many planned items are not members of a group in scope; must be zero."""
    return (planned.select(item).distinct().join(members.select(item), item, "left_anti")
            .agg(F.count(F.lit(1)).alias("outside_scope")))


def accepted_audit(classified: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every accepted row beside its candidate, with the parsed fields and why it is or is not valued."""
    cand = candidates.select(F.col("item_id").alias("candidate_item_id"), F.col("subject").alias("candidate_subject"),
                             F.col("set").alias("candidate_set"))
    rows = classified.where("state = 'accepted'").join(cand, "candidate_item_id")
    return rows.withColumns({
        "cleaned_title": T.clean_listing_title(F.col("raw_title")),
        "valuation_exclusion_reason": F.when(F.col("sold_price").isNull(),
                                             F.lit("no usable sold price - excluded from valuation"))})


IMMUTABLE = list(V.IMMUTABLE_COLUMNS)
