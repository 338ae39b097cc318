"""Benchmarks, guarded decisions and the economic report."""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from listwise import fixed_values as V
from listwise.functions import values as N
from listwise.operators.joining import join_null_safe
from listwise.operators.order_stats import (
    INDEX_QUARTILES, LOWER_MEDIAN, UPPER_MEDIAN, exclusive_quartiles, group_median, middle_of, order_statistics, with_value_rank)
from listwise.operators.sequences import falls_in_order


def dispersion(n: Column, low: Column, high: Column) -> Column:
    """max/min, or NULL with fewer than two values or a non-positive minimum."""
    return F.when((n >= 2) & (low > 0), high / low)


def in_valuation_currency(comps: DataFrame) -> DataFrame:
    """``total_price`` as the converted total where the rows carry one: another currency is no price."""
    return comps.withColumn("total_price", F.col("converted_total")) if "converted_total" in comps.columns else comps


def benchmark(comps: DataFrame, key: str, total: str = "total_price", sold_on: str = "sale_date") -> DataFrame:
    """Per key: priced comps, median, min, max, dispersion and the newest sale.

    Totals are in the valuation currency: rows that carry ``converted_total`` count by it.
    The newest sale counts every comp passed in, priced or not. A comp's NULL key
    matches no listing, so it is dropped before the shuffle.
    """
    comps = in_valuation_currency(comps.where(F.col(key).isNotNull()))
    stats = group_median(comps, [key], total, "median_total", "comp_count", lowest="min_total",
                         highest="max_total", newest={"most_recent_sale": sold_on})
    return stats.withColumn("dispersion", dispersion(F.col("comp_count"), F.col("min_total"), F.col("max_total")))


def decision_columns(df: DataFrame, today: Column | dt.date, *, min_comps: int = V.MIN_COMPS,
                     buy: float = V.BUY_DISCOUNT, watch: float = V.WATCH_DISCOUNT,
                     max_age_days: int = V.MAX_COMP_AGE_DAYS,
                     dispersion_limit: float = V.DISPERSION_LIMIT) -> DataFrame:
    """Decision, reason, guard and gap from a listing row with its benchmark beside it."""
    today = today if isinstance(today, Column) else F.lit(today)
    n = F.coalesce(F.col("comp_count"), F.lit(0)).cast("long")
    enough = n >= min_comps
    cost, complete = N.candidate_cost(F.col("price"), F.col("shipping_cost"))
    df = df.withColumns({"comp_count": n, "confidence": N.confidence(n), "total_cost": cost,
                         "cost_complete": complete, "benchmark_median": F.col("median_total"),
                         "median_total": F.when(enough, F.col("median_total")),
                         "min_total": F.when(enough, F.col("min_total")),
                         "max_total": F.when(enough, F.col("max_total")),
                         "dispersion": F.when(enough, F.col("dispersion"))})
    cost, median = F.col("total_cost"), F.col("median_total")
    priced = (F.col("comp_count") >= min_comps) & F.coalesce(cost > 0, F.lit(False)) & F.col("active")
    df = df.withColumn("gross_gap", F.when(priced, median - cost))
    df = df.withColumn("__pct", F.when(priced, F.when(median == 0, F.lit(0.0)).otherwise(
        F.col("gross_gap") / F.nullif(median, F.lit(0.0)))))
    pct = F.col("__pct")
    stale = F.col("most_recent_sale").isNull() | (F.datediff(today, F.col("most_recent_sale")) > max_age_days)
    guard = (F.when(F.col("dispersion") > dispersion_limit, F.lit("DOWNGRADED_HIGH_DISPERSION"))
             .when(stale, F.lit("DOWNGRADED_STALE_COMPS"))
             .when(~F.col("cost_complete"), F.lit("DOWNGRADED_INCOMPLETE_COST")))
    reason = (F.when(F.col("comp_count") < min_comps, F.lit("INSUFFICIENT_EVIDENCE"))
              .when(cost.isNull() | (cost <= 0), F.lit("NO_ASKING_PRICE"))
              .when(~F.col("active"), F.lit("STALE_ASKING_PRICE"))
              .when(pct >= buy, F.lit("BUY_DISCOUNT_AT_OR_ABOVE_25"))
              .when(pct >= watch, F.lit("WATCH_DISCOUNT_10_TO_25"))
              .when(pct > 0, F.lit("PASS_DISCOUNT_BELOW_10"))
              .otherwise(F.lit("PASS_AT_OR_ABOVE_MARKET")))
    df = df.withColumns({"gross_pct": pct * 100, "reason": reason,
                         "downgrade_reason": F.when(pct >= buy, guard)})
    decision = (F.when(F.col("reason") == "BUY_DISCOUNT_AT_OR_ABOVE_25",
                       F.when(F.col("downgrade_reason").isNull(), F.lit("BUY")).otherwise(F.lit("WATCH")))
                .when(F.col("reason") == "WATCH_DISCOUNT_10_TO_25", F.lit("WATCH"))
                .otherwise(F.lit("PASS")))
    return df.withColumn("decision", decision).drop("__pct")


_BENCH = ["comp_count", "min_total", "max_total", "most_recent_sale", "median_total", "dispersion"]


def decide(listings: DataFrame, comps: DataFrame, today, key: str = "slab_key",
           uncertain: DataFrame | None = None, **thresholds) -> DataFrame:
    """One decision per listing from the accepted comps of its key.

    ``uncertain`` comps never enter the benchmark. Where counting them in would
    change the decision, the answer is REVIEW_REQUIRED.
    """
    plain = decision_columns(listings.join(benchmark(comps, key), key, "left"), today, **thresholds)
    if uncertain is None:
        return plain
    columns = [key, "total_price", "sale_date"]
    comps, uncertain = in_valuation_currency(comps), in_valuation_currency(uncertain)
    unsure = uncertain.where(F.col("total_price").isNotNull()).select(*columns)
    touched = unsure.groupBy(key).agg(F.count(F.lit(1)).alias("uncertain_comp_count"))
    # Only keys with uncertain comps need the second benchmark.
    alternative = benchmark(comps.select(*columns).join(touched.select(key), key, "left_semi")
                            .unionByName(unsure), key)
    alternative = alternative.select(key, *[F.col(c).alias(f"__alt_{c}") for c in _BENCH])
    both = (plain.join(touched, key, "left").join(alternative, key, "left"))
    second = decision_columns(
        both.select(*[F.col(c).alias(f"__was_{c}") for c in plain.columns if c != key], key,
                    "uncertain_comp_count", "active", "price", "shipping_cost",
                    *[F.col(f"__alt_{c}").alias(c) for c in _BENCH]), today, **thresholds)
    unsure_n = F.coalesce(F.col("uncertain_comp_count"), F.lit(0)).cast("long")
    differs = (unsure_n > 0) & (F.col("decision") != F.col("__was_decision"))
    return second.select(
        key, *[F.col(f"__was_{c}").alias(c) for c in plain.columns
               if c not in (key, "decision", "reason")],
        F.when(differs, F.lit("REVIEW_REQUIRED")).otherwise(F.col("__was_decision")).alias("decision"),
        F.when(differs, F.lit("UNCERTAIN_EVIDENCE_WOULD_CHANGE_THE_DECISION"))
        .otherwise(F.col("__was_reason")).alias("reason"),
        unsure_n.alias("uncertain_comp_count"),
        F.when(unsure_n > 0, F.col("__was_decision")).alias("decision_without_uncertain"),
        F.when(unsure_n > 0, F.col("decision")).alias("decision_with_uncertain"))


def population(comp_count: Column) -> Column:
    return (F.when(comp_count >= V.MIN_COMPS, F.lit("valued"))
            .when(comp_count > 0, F.lit("benchmark_only")).otherwise(F.lit("no_benchmark")))


def cohort(parallel: Column, print_run: Column, is_auto: Column, auto_grade: Column, qualifier: Column) -> Column:
    def stated(c):
        return c.isNotNull() & ~c.cast("string").isin("", "0")
    return (F.when(stated(parallel) | stated(print_run), F.lit("parallel/serial"))
            .when(stated(is_auto) | stated(auto_grade), F.lit("auto"))
            .when(stated(qualifier), F.lit("qualifier")).otherwise(F.lit("base")))


def shipping_diagnostic(listings: DataFrame, comps: DataFrame, key: str = "slab_key") -> DataFrame:
    """How much of an apparent discount is postage. Never changes a decision."""
    priced = comps.where(F.col("sold_price").isNotNull() & F.col(key).isNotNull()).select(
        key, F.col("sold_price"), F.coalesce(F.col("shipping"), F.lit(0.0)).alias("ship"),
        N.comp_total(F.col("sold_price"), F.col("shipping")).alias("total"))
    meds = None
    for column, name in (("ship", "median_comp_shipping"), ("sold_price", "median_comp_item_price"),
                         ("total", "median_comp_total")):
        one = group_median(priced, [key], column, name, "__n").drop("__n")
        meds = one if meds is None else meds.join(one, key)
    df = listings.join(meds, key, "left")
    usable = (F.col("median_comp_total").isNotNull() & F.col("price").isNotNull()
              & F.col("shipping_cost").isNotNull())
    df = df.withColumns({name: F.when(usable, F.col(name)) for name in (
        "median_comp_shipping", "median_comp_item_price", "median_comp_total")})
    df = df.withColumns({
        "total_cost_gap": F.when(usable, F.col("median_comp_total") - (F.col("price") + F.col("shipping_cost"))),
        "item_price_only_gap": F.when(usable, F.col("median_comp_item_price") - F.col("price"))})
    df = df.withColumn("shipping_contribution", F.col("total_cost_gap") - F.col("item_price_only_gap"))
    df = df.withColumn("shipping_share_of_gap", F.when(
        F.col("total_cost_gap") > 0, F.col("shipping_contribution") / F.nullif(F.col("total_cost_gap"), F.lit(0.0))))
    return df.withColumns({
        "shipping_dominated": F.coalesce(F.col("shipping_share_of_gap") >= V.SHIPPING_DOMINANCE, F.lit(False)),
        "shipping_note": F.when(~usable, F.lit("no priced comps"))
        .when(F.col("total_cost_gap") <= 0, F.lit("no discount to attribute"))
        .when(F.col("shipping_share_of_gap") >= V.SHIPPING_DOMINANCE, F.lit("gap is mostly postage"))
        .otherwise(F.lit("gap is mostly the item"))})


def run_statuses(valued: DataFrame, runs: DataFrame, item: str = "item_id", sold_on: str = "most_recent_sale") -> DataFrame:
    """(item, run_status, run_status_at_sale): the latest run of each candidate, and the one in force at its newest sale.

    ``runs`` has (candidate_id, status, updated_at). One row per candidate meets its runs, which are then
    reduced by their times, partially aggregated; a run on the day of the sale is in force.
    """
    at = F.struct("updated_at", "status")
    met = valued.select(item, sold_on).join(runs.select(F.col("candidate_id").alias(item), "status", "updated_at"), item)
    in_force = F.to_date("updated_at") <= F.col(sold_on)
    return met.groupBy(item).agg(F.max(at)["status"].alias("run_status"), F.max(F.when(in_force, at))["status"].alias("run_status_at_sale"))


def economic_report(listings: DataFrame, comps: DataFrame, today, key: str = "slab_key",
                    uncertain: DataFrame | None = None, runs: DataFrame | None = None) -> DataFrame:
    """One row per listing with every measure; the median shows even below three comps.

    With ``runs`` each listing has the status of its collection run, now and as of the newest sale.
    """
    df = decide(listings, comps, today, key, uncertain)
    markup = N.markup_pct(F.col("total_cost"), F.col("benchmark_median"))
    df = df.withColumns({
        "population": population(F.col("comp_count")), "markup_percent": markup,
        "cost_to_market_ratio": F.when(F.col("benchmark_median") != 0, F.col("total_cost") / F.nullif(
            F.col("benchmark_median"), F.lit(0.0))),
        "markup_band": N.markup_band(markup)})
    if runs is None:
        return df
    # The sale date is read from the comps again, so that the runs do not wait for the whole report.
    newest = comps.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("sale_date").alias("most_recent_sale"))
    return df.join(run_statuses(listings.select("item_id", key).join(newest, key, "left"), runs), "item_id", "left")


def what_if(report: DataFrame, discounts=V.WHAT_IF_DISCOUNTS) -> DataFrame:
    """Decision counts of the valued rows at modelled seller discounts.

    The discounts are a literal array, so each row is read once and counted per
    discount on the map side.
    """
    valued = report.where(F.col("population") == "valued").select("total_cost", "benchmark_median")
    rows = valued.select("*", F.explode(F.array(*[F.lit(d) for d in discounts])).alias("discount_pct"))
    cost = F.col("total_cost") * (1 - F.col("discount_pct") / 100)
    pct = (F.col("benchmark_median") - cost) / F.nullif(F.col("benchmark_median"), F.lit(0.0))
    buy = F.coalesce(pct >= V.BUY_DISCOUNT, F.lit(False))
    watch = F.coalesce(pct >= V.WATCH_DISCOUNT, F.lit(False)) & ~buy
    return (rows.groupBy("discount_pct").agg(
        F.count_if(buy).alias("buy"), F.count_if(watch).alias("watch"),
        F.count_if(~buy & ~watch).alias("pass"))
        .withColumn("label", F.when(F.col("discount_pct") == 0, F.lit("actual")).otherwise(
            F.concat(F.col("discount_pct").cast("string"), F.lit("%")))))


def headline(report: DataFrame) -> DataFrame:
    """Totals by decision, population and the outer markup bands, in one pass."""
    valued = F.col("population") == "valued"
    return report.agg(
        F.count(F.lit(1)).alias("candidates"),
        *[F.count_if(F.col("decision") == d).alias(d.lower()) for d in ("BUY", "WATCH", "PASS", "REVIEW_REQUIRED")],
        *[F.count_if(F.col("population") == p).alias(p) for p in ("valued", "benchmark_only", "no_benchmark")],
        F.count_if(F.col("population") != "valued").alias("without_sufficient_benchmark"),
        F.count_if(valued & (F.col("markup_band") == "above market over 50%")).alias("above_market_over_50pct"),
        F.count_if(valued & (F.col("markup_band") == "at or below market")).alias("at_or_below_market"))


def markup_bands(report: DataFrame) -> DataFrame:
    return (report.where(F.col("population") == "valued").groupBy("markup_band")
            .agg(F.count(F.lit(1)).alias("listings")))


def markup_quartiles(report: DataFrame) -> DataFrame:
    valued = report.where(F.col("population") == "valued")
    stats = order_statistics(valued, [], "markup_percent", {**INDEX_QUARTILES, "__lo": LOWER_MEDIAN, "__hi": UPPER_MEDIAN}, "listings")
    return stats.select(F.lit("valued").alias("population"), "listings", "q1_index", middle_of().alias("median_markup"), "q3_index")


def cohort_rollup(report: DataFrame, cohort_column: str = "cohort") -> DataFrame:
    """Per cohort of the valued rows: count, median, min and max markup."""
    valued = report.where((F.col("population") == "valued") & F.col("markup_percent").isNotNull()).select(
        cohort_column, "markup_percent")
    plain = valued.groupBy(cohort_column).agg(F.min("markup_percent").alias("min_markup_pct"),
                                              F.max("markup_percent").alias("max_markup_pct"))
    middle = group_median(valued, [cohort_column], "markup_percent", "median_markup_pct", "valued")
    return join_null_safe(plain, middle, [cohort_column])


def ranked_by_markup(report: DataFrame) -> DataFrame:
    """Valued rows with their rank by markup over the whole table."""
    return with_value_rank(report.where(F.col("population") == "valued"), [], "markup_percent", "markup_rank")


def check_report(report: DataFrame) -> DataFrame:
    """Consistency of a report as one row of booleans."""
    valued, bench = F.col("population") == "valued", F.col("population") == "benchmark_only"
    return report.agg(
        (F.count_if(valued & F.col("markup_band").isNotNull()) == F.count_if(valued)).alias("bands_total_valued"),
        (F.count_if(F.col("decision").isin("BUY", "WATCH", "PASS", "REVIEW_REQUIRED"))
         == F.count(F.lit(1))).alias("decisions_total_candidates"),
        (F.count_if(F.col("population").isin("valued", "benchmark_only", "no_benchmark"))
         == F.count(F.lit(1))).alias("populations_total_candidates"),
        (F.count_if(valued & F.col("active") & (F.col("total_cost") > 0) & F.col("gross_gap").isNull())
         == 0).alias("valued_rows_have_a_gap"),
        (F.count_if(bench & F.col("gross_gap").isNotNull()) == 0).alias("unvalued_rows_have_no_gap"))


def rank_is_monotonic(report: DataFrame, order: str = "cost_to_market_ratio") -> DataFrame:
    """Valued rows in the order of a measure never step down in markup: rank groups and steps down."""
    valued = report.where(F.col("population") == "valued")
    return falls_in_order(valued, order, "markup_percent").withColumnRenamed("groups", "rank_groups")


def research_watch(auctions: DataFrame, comps: DataFrame, key: str = "slab_key") -> DataFrame:
    """Which auctions merit monitoring, against the conservative p25, with the first failed test."""
    quart = exclusive_quartiles(comps.where(F.col(key).isNotNull() & F.col("total_price").isNotNull()), [key], "total_price", "accepted_comps")
    df = auctions.join(quart, key, "left")
    n = F.coalesce(F.col("accepted_comps"), F.lit(0)).cast("long")
    floor, complete = N.candidate_cost(F.col("current_bid_price"), F.col("shipping_cost"))
    df = df.withColumns({"accepted_comps": n, "cost_floor": floor, "cost_floor_is_complete": complete,
                         "iqr_ratio": F.when(F.col("p25") > 0, F.col("p75") / F.col("p25"))})
    df = df.withColumn("headroom_pct", F.when(F.col("p25") > 0, (F.col("p25") - F.col("cost_floor"))
                                              / F.nullif(F.col("p25"), F.lit(0.0)) * 100))
    reason = (F.when(F.col("accepted_comps") == 0, F.lit("no_accepted_comps"))
              .when(F.col("accepted_comps") < V.WATCH_MIN_COMPS, F.concat(
                  F.lit("only_"), F.col("accepted_comps").cast("string"),
                  F.when(F.col("accepted_comps") == 1, F.lit("_accepted_comp")).otherwise(F.lit("_accepted_comps"))))
              .when(F.col("cost_floor").isNull(), F.lit("no_current_bid"))
              .when(F.coalesce(F.col("iqr_ratio") > V.WATCH_MAX_IQR_RATIO, F.lit(True)), F.lit("comp_range_too_wide"))
              .when(F.col("cost_floor") >= F.col("p25"), F.lit("bid_already_at_or_above_conservative_valuation"))
              .when(F.col("headroom_pct") < V.WATCH_MIN_HEADROOM, F.lit("headroom_below_25pct")))
    return df.withColumns({"exclusion_reason": reason, "research_watch": reason.isNull()})


def cheapest_peer_effect(decided: DataFrame, cheapest: DataFrame, key: str = "slab_key") -> DataFrame:
    """Cost cut from re-pointing each decided listing at its key's cheapest eligible peer."""
    peer = cheapest.select(key, F.col("item_id").alias("peer_item_id"), F.col("cost").alias("peer_cost"))
    df = decided.join(peer, key, "left")
    return df.withColumns({
        "already_cheapest": F.coalesce(F.col("item_id") == F.col("peer_item_id"), F.lit(False)),
        "cost_reduction": F.col("total_cost") - F.col("peer_cost")})


def rescored_at_peer(listings: DataFrame, comps: DataFrame, cheapest: DataFrame, today, key: str = "slab_key") -> DataFrame:
    """Each listing decided as it is, and again at the complete cost of its key's cheapest eligible peer.

    ``outcome`` tells where that cost stands to the market, or that the comps carry no statement; it is
    ``no_eligible_peer`` for a key without one, which is decided once.
    """
    c = F.col
    peer = cheapest.select(key, c("item_id").alias("peer_item_id"), c("cost").alias("peer_cost"))
    base = listings.select("item_id", key, "price", "shipping_cost", "active").join(benchmark(comps, key), key, "left").join(peer, key, "left")
    stages = F.array(F.struct(F.lit(False).alias("moved"), c("price").alias("p"), c("shipping_cost").alias("s"), c("active").alias("a")),
                     F.struct(F.lit(True).alias("moved"), c("peer_cost").alias("p"), F.lit(0.0).alias("s"), F.lit(True).alias("a")))
    rows = base.withColumn("__stage", F.explode(stages)).where(~c("__stage.moved") | c("peer_item_id").isNotNull())
    rows = decision_columns(rows.withColumns({"price": c("__stage.p"), "shipping_cost": c("__stage.s"), "active": c("__stage.a")}), today)
    below = c("gross_gap") / F.nullif(c("median_total"), F.lit(0.0))
    outcome = (F.when(c("comp_count") < V.MIN_COMPS, "excluded_insufficient_or_unreliable_comps").when(below >= V.WATCH_DISCOUNT, "below_market_10pct_or_more")
               .when(below > 0, "within_10pct_of_market").otherwise("above_market"))
    pick = lambda value, moved: F.max(F.when(c("__stage.moved") == moved, value))
    return rows.withColumn("__outcome", outcome).groupBy("item_id").agg(
        F.max("peer_item_id").alias("peer_item_id"), pick(c("decision"), F.lit(False)).alias("decision"), pick(c("decision"), F.lit(True)).alias("decision_at_peer"),
        pick(c("reason"), F.lit(True)).alias("reason_at_peer"), F.coalesce(pick(c("__outcome"), F.lit(True)), F.lit("no_eligible_peer")).alias("outcome"))


def revaluation_stages(listings: DataFrame, comps: DataFrame, today, stages: dict[str, dict],
                       key: str = "slab_key") -> DataFrame:
    """The same listings under several rule sets: one benchmark, one column set per stage.

    A stage may name thresholds of ``decision_columns``, and ``with_shipping=False``
    to compare the bare item price.
    """
    base = listings.join(benchmark(comps, key), key, "left")
    parts = []
    for name, options in stages.items():
        options = dict(options)
        shipped = options.pop("with_shipping", True)
        source = base if shipped else base.withColumn("shipping_cost", F.lit(0.0))
        parts.append(decision_columns(source, today, **options).select(
            F.lit(name).alias("stage"), "item_id", key, "decision", "reason", "total_cost",
            "median_total", "gross_gap"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def evidence_freshness(comps: DataFrame, today, key: str = "slab_key",
                       max_age_days: int = V.MAX_COMP_AGE_DAYS) -> DataFrame:
    """Per key: unique accepted priced comps, the newest one, and whether they can be reused.

    A comp is identified by its source id, or by title, date and price without one.
    Copies collapse in their own shuffle first, so repeated collections of one sale
    never pile up on the key.
    """
    blank = F.nullif(F.trim(F.col("source_item_id").cast("string")), F.lit(""))
    identity = F.coalesce(blank, F.concat_ws("|", "raw_title", F.col("sale_date").cast("string"),
                                             F.col("total_price").cast("string")))
    unique = (comps.where(F.col(key).isNotNull() & F.col("total_price").isNotNull())
              .select(key, identity.alias("__comp"), "sale_date")
              .groupBy(key, "__comp").agg(F.max("sale_date").alias("sale_date")))
    today = today if isinstance(today, Column) else F.lit(today)
    out = unique.groupBy(key).agg(F.count(F.lit(1)).alias("unique_comps"), F.max("sale_date").alias("newest"))
    return out.withColumn("reusable", (F.col("unique_comps") >= V.MIN_COMPS)
                          & F.coalesce(F.datediff(today, F.col("newest")) <= max_age_days, F.lit(False)))
