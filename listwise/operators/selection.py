"""Caps, shortlists, bands and first-of-a-kind picks."""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from listwise import fixed_values as V
from listwise.session import settle


#: Up to this limit Spark applies a rank limit to each task's rows before the shuffle.
GROUP_LIMIT = 1000


def cap_per_key(df: DataFrame, key: str, limit: int, order: list[str]) -> DataFrame:
    """At most ``limit`` rows per key in the given order; rows without a key are kept.

    Up to ``GROUP_LIMIT`` a hot key sends at most ``limit`` rows per task. Above it the rows of a key are first
    ranked within their own partition, so that what meets in one task is ``limit`` rows of each, never the whole key.
    """
    def first(rows: DataFrame, *within: str) -> DataFrame:
        ranked = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*within).orderBy(*order)))
        return ranked.where(F.col("__n") <= limit).drop("__n")

    rows = df.where(F.col(key).isNotNull())
    if limit > GROUP_LIMIT:
        rows = first(rows.withColumn("__part", F.spark_partition_id()), key, "__part").drop("__part")
    return first(rows, key).unionByName(df.where(F.col(key).isNull()))


def capped_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") > limit))


def stratified_shortlist(df: DataFrame, categories: dict[str, Column], quota: int, total: int, score: str,
                         group: str = "slab_key", item: str = "item_id") -> DataFrame:
    """One row per group, up to ``quota`` of each category (rarest first), then the best of the rest.

    A row counts toward the first category it belongs to. Set-based, so a row never
    fills two quotas at once.
    """
    rest = [c for c in df.columns if c != group]
    one = df.groupBy(group).agg(F.max_by(F.struct(*rest), F.struct(F.col(score), F.col(item))).alias("__row")).select(
        *[c if c == group else F.col(f"__row.{c}").alias(c) for c in df.columns])
    label = None
    for name, test in categories.items():
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    one = one.withColumn("category", label)
    order = [F.desc(score), F.col(item)]
    picked = (one.where(F.col("category").isNotNull())
              .withColumn("__n", F.row_number().over(Window.partitionBy("category").orderBy(*order)))
              .where(F.col("__n") <= quota).drop("__n").withColumn("stage", F.lit("quota")))
    fill = (one.join(picked.select(item), item, "left_anti").orderBy(*order).limit(total)
            .withColumn("stage", F.lit("fill")))
    return (picked.unionByName(fill.select(*picked.columns))
            .orderBy(F.desc("stage"), *order).limit(total))


def greedy_shortlist(df: DataFrame, categories: dict[str, Column], quota: int, total: int, order: list[Column | str],
                     group: str = "slab_key", item: str = "item_id", seed: DataFrame | None = None) -> DataFrame:
    """A cover of the categories in rounds, one round per category as listed (rarest first), then the best of the rest.

    In ``order``, a round takes rows of its category, one per group and none of a group already
    chosen, until ``quota`` chosen rows belong to it; a row counts toward every category it is in,
    whichever round took it. ``seed`` rows (with the same columns, groups distinct) are chosen from the start and count
    as well. Ends at ``total`` rows; ``round`` names what took a row. Rows with a NULL group are one group.

    What is chosen never exceeds ``total`` rows, which is the feature; a round reads the pool
    once, reduces it to one row per group before it is ordered, and is checkpointed, as the next one builds on it.
    """
    tags = {f"__in_{i}": F.coalesce(test, F.lit(False)) for i, test in enumerate(categories.values())}
    place = F.struct(*[c.alias(f"o{i}") if isinstance(c, Column) else F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                     F.col(item).alias("__tie"))
    pool = df.withColumns({**tags, "__group": F.struct(F.col(group).alias("g")), "__place": place})
    kept = [*df.columns, *tags, "__group", "__place"]
    start = (seed if seed is not None else df.limit(0)).withColumns({**tags, "__group": F.struct(F.col(group).alias("g")), "__place": place})
    chosen = settle(start.orderBy("__place").limit(total).select(*kept, F.lit("seed").alias("round")))
    for name, tag in [*zip(categories, tags), (None, None)]:
        wanted = total if tag is None else quota
        rows = pool if tag is None else pool.where(F.col(tag))
        rows = rows.join(chosen.select("__group"), "__group", "left_anti")
        firsts = rows.groupBy("__group").agg(F.min_by(F.struct(*[c for c in kept if c != "__group"]), F.col("__place")).alias("__row"))
        firsts = firsts.orderBy(F.col("__row.__place")).limit(wanted).select(*[c if c == "__group" else F.col(f"__row.{c}").alias(c) for c in kept])
        both = firsts.withColumn("round", F.lit(name or "fill")).withColumn("__new", F.lit(True)).unionByName(chosen.withColumn("__new", F.lit(False)))
        # At most ``total`` chosen rows and as many as the round may add meet in one window.
        every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        old = ~F.col("__new")
        have = F.count_if(old & F.col(tag)).over(every) if tag else F.lit(0)
        nth = F.row_number().over(Window.partitionBy("__new").orderBy("__place"))
        fits = (nth <= wanted - have) & (nth <= total - F.count_if(old).over(every))
        chosen = settle(both.withColumn("__fits", old | fits).where("__fits").select(*kept, "round"))
    return chosen.select(*df.columns, "round")


def bounded_selection(rows: DataFrame, known: DataFrame, researched: DataFrame, *, key: str, limit: int,
                      eligible_reason: Column, order: list[str], item: str = "item_id") -> DataFrame:
    """Every row with its outcome: ``selected`` or the first reason against it.

    Rows are taken in ``order`` only, one per key, up to ``limit``. Ids are unique.
    """
    df = rows.withColumn("__why", eligible_reason)
    df = df.join(known.select(item, F.lit(True).alias("__known")).distinct(), item, "left")
    df = df.join(researched.where(F.col(key).isNotNull()).select(key, F.lit(True).alias("__done")).distinct(), key, "left")
    df = df.withColumns({
        "__why": F.coalesce("__why", F.when(F.col("__known"), F.lit("already_discovered")),
                            F.when(F.col("__done"), F.lit("identity_already_researched"))),
        "__unit": F.coalesce(F.concat(F.lit("k:"), F.col(key).cast("string")), F.concat(F.lit("i:"), F.col(item)))})
    open_rows = df.where(F.col("__why").isNull())
    firsts = open_rows.groupBy("__unit").agg(F.min(F.struct(*order)).alias("__first"))
    # The cap is the feature here: at most ``limit`` units are ever admitted.
    chosen = firsts.orderBy("__first").limit(limit).select("__unit", F.col("__first").alias("__picked"))
    out = df.join(chosen, "__unit", "left")
    outcome = (F.when(F.col("__why").isNotNull(), F.col("__why"))
               .when(F.col("__picked").isNull(), F.lit("over_candidate_cap"))
               .when(F.struct(*order) == F.col("__picked"), F.lit("selected"))
               .otherwise(F.lit("identity_already_researched")))
    return out.withColumn("outcome", outcome).select(*rows.columns, "outcome")


def auction_reason(sale_format: Column, end_time: Column, bid: Column) -> Column:
    return (F.when(~sale_format.isin("AUCTION_ONLY", "AUCTION_WITH_FIXED_PRICE_OPTION"), F.lit("not_an_auction"))
            .when(end_time.isNull(), F.lit("no_end_time")).when(bid.isNull(), F.lit("no_current_bid")))


def _depth_range(v: Column, ratio: float, depth: int, min_width: float) -> tuple[Column, Column]:
    """(least, greatest) depth that the deepest band of a value can have whose parent is wider than ``min_width``.

    A band that holds ``v`` and is one step of ``q`` long is narrower than ``v * (q - 1)`` and wider than ``v * (1 - 1 / q)``;
    rounded edges move the width by a hundredth at most. So the two differ by a few depths, whatever the range.
    """
    def steps(log_q: Column) -> Column:
        return F.log2(F.lit(math.log(ratio)) / log_q)

    bounded = lambda d: F.greatest(F.lit(0), F.least(F.lit(depth), d)).cast("int")
    sure = F.when(v > min_width + 0.02, F.ceil(steps(-F.log(1 - (min_width + 0.02) / v))) - 1)
    possible = F.when(F.lit(min_width > 0.02), F.floor(steps(F.log(1 + (min_width - 0.02) / v))) + 2)
    return bounded(F.coalesce(sure, F.lit(0))), bounded(F.coalesce(possible, F.lit(depth)))


def geometric_bands(df: DataFrame, value: str, low: float, high: float, ceiling: int = V.PAGING_CEILING,
                    min_width: float = V.MIN_BAND_WIDTH) -> DataFrame:
    """Split [low, high) at geometric midpoints until every band holds at most ``ceiling`` rows.

    Counts are real and go by the rounded edges that are reported. One aggregation by value,
    one by the deepest band a value can reach, and one by the bands around those, which hold
    their children's edges exactly; the bands that can be reached are bounded by the
    range and ``min_width``, whatever the number of rows. A band still too dense at the
    narrowest width is reported as excluded, never dropped.
    """
    ratio = float(high) / float(low)
    # So many halvings make the widest band, the one below ``high``, narrower than min_width.
    depth = max(0, math.ceil(math.log2(high * math.log(ratio) / min_width)))

    def edge(at: Column, level: Column) -> Column:
        return F.round(F.lit(float(low)) * F.pow(F.lit(ratio), at / F.pow(F.lit(2.0), level)), 2)

    counted = df.where((F.col(value) >= low) & (F.col(value) < high)).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    at = counted.select("v", "n", F.explode(F.sequence(*_depth_range(F.col("v").cast("double"), ratio, depth, min_width))).alias("depth"))
    position = F.log(F.col("v") / F.lit(float(low))) / F.log(F.lit(ratio)) * F.pow(F.lit(2.0), F.col("depth"))
    at = at.withColumn("node", F.greatest(F.lit(0), F.least(F.floor(position), F.pow(F.lit(2.0), F.col("depth")) - 1)).cast("long"))
    # Rounding may put a value beside an edge into the neighbouring band.
    at = at.withColumn("node", F.col("node") - (F.col("v") < edge(F.col("node"), F.col("depth"))).cast("long")
                       + (F.col("v") >= edge(F.col("node") + 1, F.col("depth"))).cast("long"))
    parent = F.floor(F.col("node") / 2)
    wide = edge(parent + 1, F.col("depth") - 1) - edge(parent, F.col("depth") - 1) > min_width
    leaves = at.where((F.col("depth") == 0) | wide).groupBy("v").agg(F.max(F.struct("depth", "node")).alias("leaf"), F.first("n").alias("n"))
    leaves = leaves.groupBy("leaf").agg(F.sum("n").alias("n"))
    around = leaves.select("n", "leaf.*").select("n", F.col("depth").alias("leaf_depth"), F.col("node").alias("leaf_node"),
                                                 F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("depth"))
    node = F.floor(F.col("leaf_node") / F.pow(F.lit(2.0), F.col("leaf_depth") - F.col("depth"))).cast("long")
    nodes = around.select("depth", node.alias("node"), "n").groupBy("depth", "node").agg(F.sum("n").alias("n"))
    nodes = nodes.withColumns({"low": edge(F.col("node"), F.col("depth")), "high": edge(F.col("node") + 1, F.col("depth"))})
    splittable = (F.col("n") > ceiling) & (F.col("high") - F.col("low") > min_width)
    split = nodes.where(splittable)
    children = split.select((F.col("depth") + 1).alias("depth"), F.explode(F.array(
        F.col("node") * 2, F.col("node") * 2 + 1)).alias("node"))
    root = df.sparkSession.range(1).select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("node"))
    bands = children.unionByName(root).join(nodes.select("depth", "node", "n"), ["depth", "node"], "left")
    bands = bands.withColumns({"n": F.coalesce("n", F.lit(0)), "low": edge(F.col("node"), F.col("depth")),
                               "high": edge(F.col("node") + 1, F.col("depth"))})
    return bands.where(~splittable).select("low", "high", "n", (F.col("n") > ceiling).alias("excluded"))


def strided(bands: DataFrame, count: int, order: str = "low") -> DataFrame:
    """``count`` bands spread evenly by position over a list of bands.

    The bands are ordered in one task: their number is bounded by their range and width.
    """
    numbered = bands.withColumn("i", F.row_number().over(Window.orderBy(order)) - 1).withColumn(
        "n_bands", F.count(F.lit(1)).over(Window.partitionBy()))
    step = F.ceil(F.col("i") * count / F.col("n_bands"))
    hit = (step < count) & (F.floor(step * F.col("n_bands") / count) == F.col("i"))
    return numbered.where((F.col("n_bands") <= count) | hit).drop("i", "n_bands")


def strictest_tier(rows: DataFrame, sale: str, tier_rank: str, order: list[str]) -> DataFrame:
    """Each sale once, as the strictest tier that found it reported it."""
    rest = [c for c in rows.columns if c != sale]
    best = rows.groupBy(sale).agg(F.min_by(F.struct(*rest), F.struct(tier_rank, *order)).alias("__row"))
    return best.select(*[c if c == sale else F.col(f"__row.{c}").alias(c) for c in rows.columns])


def latest_run_rows(rows: DataFrame, runs: DataFrame, candidate: str = "candidate_id", run: str = "run_id",
                    updated: str = "updated_at") -> DataFrame:
    """Rows of each candidate's latest run only; history is never mixed in."""
    latest = runs.groupBy(candidate).agg(F.max_by(run, F.struct(updated, run)).alias(run))
    return rows.join(latest, [candidate, run], "left_semi")


def latest_non_empty(attempts: DataFrame, key: str, rows: str, order: list[str]) -> DataFrame:
    """Per key the newest attempt that found something, else the newest attempt."""
    rest = [c for c in attempts.columns if c != key]
    best = attempts.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(rows) > 0, *order)).alias("__row"))
    return best.select(*[c if c == key else F.col(f"__row.{c}").alias(c) for c in attempts.columns])
