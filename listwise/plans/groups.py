"""Groups of listings of one slab: sizes, agreement, spread and price anomalies."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from listwise import fixed_values as V
from listwise.functions import text as T
from listwise.functions import values as N
from listwise.operators.order_stats import LOWER_MEDIAN, UPPER_MEDIAN, group_median, order_statistics


def size_band(n: Column, edges=(1, 2, 3, 5)) -> Column:
    """1 / 2 / 3 / 4-5 / 6+ with the default edges."""
    out, low = None, 0
    for high in edges:
        label = F.lit(str(high) if high == low + 1 else f"{low + 1}-{high}")
        out = F.when(n <= high, label) if out is None else out.when(n <= high, label)
        low = high
    return out.otherwise(F.lit(f"{low + 1}+"))


def group_sizes(members: DataFrame, key: str = "slab_key", edges=(1, 2, 3, 5)) -> DataFrame:
    """How many groups there are of each size band."""
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(size_band(F.col("n"), edges).alias("size")).agg(F.count(F.lit(1)).alias("groups"))


def group_totals(members: DataFrame, eligible: Column, key: str = "slab_key") -> DataFrame:
    """Groups, multi-member groups and the members in them, for all and for eligible members."""
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("all_n"), F.count_if(eligible).alias("ok_n"))
    parts = []
    for name, n in (("all", F.col("all_n")), ("eligible", F.col("ok_n"))):
        parts += [F.count_if(n >= 1).alias(f"{name}_groups"), F.count_if(n >= 2).alias(f"{name}_multi_groups"),
                  F.coalesce(F.sum(F.when(n >= 2, n)), F.lit(0)).alias(f"{name}_members_covered")]
    return sizes.agg(*parts)


def price_spread(members: DataFrame, key: str = "slab_key", price: str = "price") -> DataFrame:
    """max/min price per group; 1.0 below two prices or with a non-positive minimum."""
    stated = F.nullif(F.col(price), F.lit(0.0))
    agg = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count(stated).alias("priced"),
                                   F.min(stated).alias("low"), F.max(stated).alias("high"))
    return agg.select(key, "n", F.when((F.col("priced") >= 2) & (F.col("low") > 0), F.col("high") / F.col("low"))
                      .otherwise(F.lit(1.0)).alias("spread"))


def spread_counts(members: DataFrame, key: str = "slab_key", thresholds=(2, 5, 10, 100)) -> DataFrame:
    """Multi-member groups whose spread exceeds each threshold, in one pass."""
    multi = price_spread(members, key).where("n > 1")
    return multi.agg(F.count(F.lit(1)).alias("multi_groups"),
                     *[F.count_if(F.col("spread") > t).alias(f"above_{t}x") for t in thresholds])


def product_id_state(members: DataFrame, key: str = "slab_key", product_id: str = "epid") -> DataFrame:
    """agree / conflict / partial, from the smallest and largest stated product id."""
    stated = F.nullif(F.col(product_id).cast("string"), F.lit(""))
    agg = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count(stated).alias("stated"),
                                   F.min(stated).alias("low"), F.max(stated).alias("high"))
    return agg.select(key, "n", F.when(F.col("low") != F.col("high"), F.lit("conflict"))
                      .when((F.col("stated") == F.col("n")), F.lit("agree")).otherwise(F.lit("partial")).alias("state"))


def divergent_tokens(members: DataFrame, key: str = "slab_key", title: str = "title") -> DataFrame:
    """Title tokens some members of a group have and others lack: one row per (group, token).

    Tokens are counted per (group, token) before anything is keyed by the group alone,
    so a hot group is spread by its tokens.
    """
    tokens = members.select(key, F.explode(F.array_distinct(T.group_title_tokens(F.col(title)))).alias("token"))
    counted = tokens.groupBy(key, "token").agg(F.count(F.lit(1)).alias("titles"))
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(sizes, key).where(F.col("titles") < F.col("n")).select(key, "token", "titles", "n")


GUARDS = ("group smaller than 2", "LOW identity confidence in group", "missing card number / year / grade",
          "LOW parallel confidence", "divergent titles within group", "non-positive price")


def group_guardrails(members: DataFrame, key: str = "slab_key") -> DataFrame:
    """Per group its size and the first guardrail it fails (NULL when it may be screened)."""
    missing = (F.col("card_number").isNull() | (F.col("card_number") == "") | F.col("year").isNull()
               | F.col("grade_value").isNull())
    flags = members.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.max(~F.col("identity_conf").isin("MEDIUM", "HIGH")).alias("weak"),
        F.max(missing).alias("missing"), F.max(F.col("parallel_conf") == "LOW").alias("unclear"),
        F.max(F.coalesce(F.col("price"), F.lit(0.0)) <= 0).alias("unpriced"))
    divergent = divergent_tokens(members, key).select(key, F.lit(True).alias("divergent")).distinct()
    tests = (F.col("n") < V.WEAK_GROUP, F.col("weak"), F.col("missing"), F.col("unclear"),
             F.coalesce(F.col("divergent"), F.lit(False)), F.col("unpriced"))
    reason = None
    for test, label in zip(tests, GUARDS):
        reason = F.when(test, F.lit(label)) if reason is None else reason.when(test, F.lit(label))
    return flags.join(divergent, key, "left").select(key, "n", reason.alias("reject_reason"))


def guardrail_counts(members: DataFrame, key: str = "slab_key") -> DataFrame:
    return (group_guardrails(members, key)
            .groupBy(F.coalesce("reject_reason", F.lit("screened")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("groups")))


def screened(members: DataFrame, key: str = "slab_key") -> DataFrame:
    """Members of the groups that pass every guardrail."""
    passed = group_guardrails(members, key).where(F.col("reject_reason").isNull()).select(key)
    return members.join(passed, key, "left_semi")


def leave_one_out_baseline(members: DataFrame, key: str = "slab_key") -> DataFrame:
    """Each member with the median of the *other* members' kept totals.

    A total is kept unless it exceeds five times the whole group's median or its ask is
    a placeholder. Leaving one member out only shifts the middle of the kept totals by
    one place, so a handful of order statistics per group answers for every member: no
    member is ever paired with another, and no group is collected.
    """
    df = members.withColumns({"__ask": F.coalesce(F.col("price"), F.lit(0.0)),
                              "shipping": F.coalesce(F.col("shipping_cost"), F.lit(0.0))})
    df = df.withColumn("total", F.col("__ask") + F.col("shipping"))
    whole = group_median(df, [key], "total", "__mid", "size", lowest="gmin", highest="gmax")
    df = df.join(whole, key).withColumn(
        "__kept", F.when((F.col("total") <= V.OUTLIER_MULTIPLE * F.col("__mid")) & ~N.is_placeholder(F.col("__ask")),
                         F.col("total")))
    stats = order_statistics(df, [key], "__kept", {
        "__m1": lambda k: F.floor((k - 2) / 2), "__m2": lambda k: F.floor((k - 2) / 2) + 1,
        "__m3": lambda k: F.floor((k - 1) / 2), "__m4": lambda k: F.floor((k - 1) / 2) + 1,
        "__lo": LOWER_MEDIAN, "__hi": UPPER_MEDIAN,
        "__second": lambda k: F.lit(1), "__before_last": lambda k: k - 2,
    }, "__k", lowest="__least", highest="__most")
    df = df.join(stats, key)
    mine, x = F.col("__kept").isNotNull(), F.col("total")

    def without_me(at: str, next_one: str) -> Column:
        return F.when(mine & (x <= F.col(at)), F.col(next_one)).otherwise(F.col(at))

    low, high = without_me("__m1", "__m2"), without_me("__m3", "__m4")
    left = F.col("__k") - mine.cast("long")
    smallest = without_me("__least", "__second")
    largest = F.when(mine & (x >= F.col("__most")), F.col("__before_last")).otherwise(F.col("__most"))
    df = df.withColumns({"__left": left, "__small": smallest, "__large": largest,
                         "__a": F.when(mine, low).otherwise(F.col("__lo")),
                         "__b": F.when(mine, high).otherwise(F.col("__hi"))})
    coherent = (F.col("__left") >= V.MIN_COMPARATORS) & ~(
        (F.col("__small") > 0) & (F.col("__large") / F.nullif(F.col("__small"), F.lit(0.0)) > V.GROUP_SPREAD_LIMIT))
    middle = F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise((F.col("__a") + F.col("__b")) / 2)
    df = df.withColumns({"baseline": F.when(coherent, middle),
                         "trimmed": (F.col("size") - 1 - F.col("__left")).cast("long")})
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def _below(df: DataFrame) -> DataFrame:
    df = df.where((F.col("baseline") > 0) & (F.col("total") < F.col("baseline")))
    df = df.withColumn("gap", F.col("baseline") - F.col("total")).where(F.col("gap") >= V.MIN_DOLLAR_GAP)
    return df.withColumn("pct_below", 100.0 * F.col("gap") / F.col("baseline"))


def anomaly_candidates(members: DataFrame, key: str = "slab_key") -> DataFrame:
    """Members of groups of three or more priced below the others' trimmed median."""
    return _below(leave_one_out_baseline(members, key).where(F.col("size") >= V.STRONG_GROUP))


def weak_pairs(members: DataFrame, key: str = "slab_key") -> DataFrame:
    """The cheaper member of a pair, against the other's total unless that is a placeholder."""
    ask = F.coalesce(F.col("price"), F.lit(0.0))
    df = members.withColumn("total", ask + F.coalesce(F.col("shipping_cost"), F.lit(0.0)))
    pair = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"), F.max(F.struct(F.col("total"), ask.alias("ask"))).alias("__top"))
    pair = pair.where(F.col("size") == V.WEAK_GROUP).select(
        key, "size", F.col("__top.total").alias("baseline"), F.col("__top.ask").alias("__other_ask"))
    return _below(df.join(pair, key).where(~N.is_placeholder(F.col("__other_ask"))).drop("__other_ask"))


def sample_buckets(groups: DataFrame, per_bucket: int, seed: int, key: str = "slab_key",
                   bucket: str = "bucket") -> DataFrame:
    """Up to ``per_bucket`` groups of each bucket, the same ones on any partitioning."""
    draw = F.sha1(F.concat_ws("|", F.col(key).cast("string"), F.lit(seed)))
    ranked = Window.partitionBy(bucket).orderBy(draw, F.col(key))
    return groups.withColumn("draw", F.row_number().over(ranked)).where(F.col("draw") <= per_bucket)


def risk_buckets(members: DataFrame, per_bucket: int, key: str = "slab_key") -> DataFrame:
    """Multi-member groups under each risk bucket, with the widest and largest ones."""
    spread = price_spread(members, key)
    levels = members.groupBy(key).agg(F.min("parallel_conf").alias("level"),
                                      F.min("parallel").alias("parallel"))
    multi = spread.join(levels, key).where("n > 1")
    widest = multi.orderBy(F.desc("spread"), key).limit(per_bucket).withColumn("bucket", F.lit("widest price spread"))
    largest = multi.orderBy(F.desc("n"), key).limit(per_bucket).withColumn("bucket", F.lit("largest group size"))
    named = (multi.where("level = 'HIGH'").withColumn("bucket", F.lit("HIGH parallel confidence"))
             .unionByName(multi.where("level = 'MEDIUM'").withColumn("bucket", F.lit("MEDIUM parallel confidence")))
             .unionByName(multi.where("parallel IS NULL").withColumn("bucket", F.lit("no parallel vocabulary"))))
    return named.unionByName(widest).unionByName(largest)
