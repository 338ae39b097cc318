"""Which member may stand for its slab, and what regrouping did to a group."""

from pyspark.sql import Column, DataFrame, functions as F

from listwise import fixed_values as V
from listwise.operators.order_stats import UPPER_MEDIAN, order_statistics


def reject_reason(group_key: str = "slab_key", eff_key: str = "eff_slab") -> Column:
    """First failed test of a member, in order; NULL when it is eligible.

    Expects the flattened listing columns beside the member's effective key and class.
    """
    c = F.col
    tests = [
        (~c(eff_key).eqNullSafe(c(group_key)), F.lit("different_slab_identity")),
        (c("cls").isin(*V.UNSETTLED_CLASSES), F.concat(F.lit("identity_"), c("cls"))),
        (c("payload_state") == "unreadable", F.lit("unreadable_payload")),
        (c("payload_state") == "empty", F.lit("no_payload")),
        (~c("active"), F.lit("not_active")),
        (c("sale_format") != "FIXED_PRICE_ONLY", F.lit("no_genuine_fixed_price")),
        (c("shipping_state") != "KNOWN", F.concat(F.lit("shipping_"), c("shipping_state"))),
        (~c("usd_proven"), F.lit("usd_not_proven")),
        (~c("single_card"), F.lit("not_single_card")),
        (c("acquisition_total").isNull(), F.lit("acquisition_total_incomplete")),
    ]
    out = None
    for test, label in tests:
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def with_eligibility(members: DataFrame, group_key: str = "slab_key") -> DataFrame:
    return members.withColumn("reject_reason", reject_reason(group_key))


def cheapest_eligible(members: DataFrame, key: str = "slab_key", cost: str = "acquisition_total",
                      item: str = "item_id") -> DataFrame:
    """The eligible member with the lowest complete cost; ties go to the lower id.

    A minimum of a struct is partially aggregated, so no group is ever sorted.
    """
    best = members.where(F.col("reject_reason").isNull()).groupBy(key).agg(
        F.min(F.struct(F.col(cost), F.col(item))).alias("b"), F.count(F.lit(1)).alias("eligible"))
    return best.select(key, F.col(f"b.{item}").alias(item), F.col(f"b.{cost}").alias("cost"), "eligible")


def one_per_identity(candidates: DataFrame, identity: str, cost: str = "cost", item: str = "item_id") -> DataFrame:
    """One candidate per effective identity: the cheapest, then the lower id."""
    best = candidates.groupBy(identity).agg(F.min(F.struct(F.col(cost), F.col(item))).alias("b"),
                                            F.count(F.lit(1)).alias("groups"))
    return best.select(identity, F.col(f"b.{item}").alias(item), F.col(f"b.{cost}").alias(cost), "groups")


def group_outcomes(members: DataFrame, key: str = "slab_key", item: str = "item_id") -> DataFrame:
    """One of six outcomes per group, from identity only.

    Members carry ``eff_slab``, ``cls`` and ``is_candidate`` (exactly one per group).
    """
    agg = members.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("cls") == "quarantined_material_conflict").alias("conflict"),
        F.max(F.col("cls").isin("not_enriched", "held_for_parallel_resolution")).alias("unresolved"),
        F.max(F.when(F.col("is_candidate"), F.col("eff_slab"))).alias("candidate_slab"),
        F.min(F.coalesce("eff_slab", F.lit(""))).alias("low"), F.max(F.coalesce("eff_slab", F.lit(""))).alias("high"))
    same = members.join(agg.select(key, "candidate_slab"), key).groupBy(key).agg(
        F.count_if(F.col("eff_slab").eqNullSafe(F.col("candidate_slab"))).alias("same"))
    outcome = (F.when(F.col("conflict"), F.lit("material_conflict"))
               .when(F.col("unresolved"), F.lit("unresolved_peer_identity"))
               .when(F.col("low") == F.col("high"), F.lit("confirmed_same_identity"))
               .when(F.col("same") >= 3, F.lit("split_but_candidate_group_viable"))
               .when(F.col("same") == 2, F.lit("split_weak_signal")).otherwise(F.lit("candidate_isolated")))
    return agg.join(same, key).select(key, "n", "same", "candidate_slab", outcome.alias("outcome"))


def rebuild_report(members: DataFrame, key: str = "slab_key") -> DataFrame:
    """Per group, before and after regrouping around its candidate: still the lowest,
    and whether the discount to the upper median moved by ten points."""
    df = members.withColumn("total", F.coalesce("price", F.lit(0.0)) + F.coalesce("shipping_cost", F.lit(0.0)))
    cand = df.where("is_candidate").select(key, F.col("eff_slab").alias("__slab"), F.col("total").alias("candidate_total"),
                                           F.col("item_id").alias("candidate_id"))
    df = df.join(cand, key)
    df = df.withColumn("__with", F.when(F.col("eff_slab").eqNullSafe(F.col("__slab")), F.col("total")))
    old = order_statistics(df, [key], "total", {"old_median": UPPER_MEDIAN}, "n")
    new = order_statistics(df, [key], "__with", {"new_median": UPPER_MEDIAN}, "subgroup", lowest="__low")
    out = cand.drop("__slab").join(old, key).join(new, key)
    before = 100 * (F.col("old_median") - F.col("candidate_total")) / F.nullif(F.col("old_median"), F.lit(0.0))
    after = 100 * (F.col("new_median") - F.col("candidate_total")) / F.nullif(F.col("new_median"), F.lit(0.0))
    return out.withColumns({
        "still_lowest": F.abs(F.col("candidate_total") - F.col("__low")) < 1e-9,
        "subgroup_size": F.when(F.col("subgroup") == 1, "1").when(F.col("subgroup") == 2, "2").otherwise("3+"),
        "discount_moved": F.coalesce((F.col("subgroup") >= 2) & (F.abs(before - after) >= 10), F.lit(False)),
    }).drop("__low")


def slab_fates(listings: DataFrame, key: str = "slab_key") -> DataFrame:
    """Per original group, who left by re-keying and what remains.

    Rows carry ``enriched`` and ``rekeyed`` flags.
    """
    agg = listings.groupBy(key).agg(F.count(F.lit(1)).alias("original"), F.count_if("rekeyed").alias("gone"),
                                    F.count_if(~F.col("enriched")).alias("unenriched"))
    remaining = F.col("original") - F.col("gone")
    fate = (F.when((F.col("unenriched") > 0) & (F.col("gone") > 0), F.lit("unresolved"))
            .when(remaining <= 1, F.lit("invalidated")).when(F.col("gone") > 0, F.lit("reduced"))
            .otherwise(F.lit("still viable")))
    return agg.select(key, "original", "gone", "unenriched", remaining.alias("remaining"), fate.alias("fate"))


def export_candidates(members: DataFrame, chosen: DataFrame, key: str = "slab_key", max_members: int | None = None) -> DataFrame:
    """Frozen candidates with the dispersion of their slab's active totals.

    The group's members stay a table of their own (``candidate_members``): a hot slab has
    no size limit, so its members are never gathered into one row.
    """
    total = F.coalesce("price", F.lit(0.0)) + F.coalesce("shipping_cost", F.lit(0.0))
    spread = members.groupBy(key).agg(
        F.count(F.lit(1)).alias("members"), F.min(F.when(F.col("price") > 0, total)).alias("low"),
        F.max(F.when(F.col("price") > 0, total)).alias("high"))
    return chosen.join(spread, key).select(
        *chosen.columns, "members", F.round(F.col("high") / F.col("low"), 3).alias("intra_slab_dispersion"))


def candidate_members(members: DataFrame, chosen: DataFrame, key: str = "slab_key") -> DataFrame:
    """Every member of a chosen candidate's slab, one row each."""
    total = F.coalesce("price", F.lit(0.0)) + F.coalesce("shipping_cost", F.lit(0.0))
    picked = chosen.select(key, F.col("item_id").alias("candidate_item_id"))
    return members.join(picked, key).select(key, "candidate_item_id", "item_id", "price", "shipping_cost",
                                            total.alias("total"))
