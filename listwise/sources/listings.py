"""Listing payloads to flat rows, and keeping the listing table current."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from listwise import fixed_values as V
from listwise.functions import values as N

_MONEY = "struct<value: string, currency: string>"
PAYLOAD_SCHEMA = f"""
itemId string, title string, categories array<struct<categoryId: string, categoryName: string>>,
leafCategoryIds array<string>, buyingOptions array<string>, price {_MONEY}, currentBidPrice {_MONEY},
shippingOptions array<struct<shippingCostType: string, shippingCost: {_MONEY}>>, itemEndDate string,
bidCount int, condition string, itemCreationDate string,
seller struct<username: string, feedbackPercentage: string, feedbackScore: string>, epid string, itemWebUrl string,
localizedAspects array<struct<name: string, value: string>>"""


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payload files with a stated schema: no inference pass over the data."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path)


def parse_payloads(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Payload text in a column to the payload's fields; unreadable text is marked."""
    # Generated as one row per payload, so that the text is parsed once and not per field.
    read = df.select("*", F.inline(F.array(F.from_json(F.col(raw), PAYLOAD_SCHEMA, {"mode": "PERMISSIVE"}))))
    state = (F.when(F.col(raw).isNull() | F.trim(raw).isin("", "{}", "null"), F.lit("empty"))
             .when(F.col("itemId").isNull(), F.lit("unreadable")).otherwise(F.lit("read")))
    return read.withColumn("payload_state", state)


def stated_currencies(price: Column, bid: Column, shipping: Column) -> Column:
    """Distinct upper-case currencies an item states."""
    seen = F.transform(F.array(price, bid, shipping), lambda c: F.upper(F.nullif(c, F.lit(""))))
    return F.array_distinct(F.array_compact(seen))


def sale_format(options: Column) -> Column:
    opts = F.transform(F.coalesce(options, F.array().cast("array<string>")), F.upper)
    auction, fixed = F.array_contains(opts, "AUCTION"), F.array_contains(opts, "FIXED_PRICE")
    return (F.when(auction & fixed, F.lit("AUCTION_WITH_FIXED_PRICE_OPTION")).when(auction, F.lit("AUCTION_ONLY"))
            .when(fixed, F.lit("FIXED_PRICE_ONLY")).otherwise(F.lit("UNKNOWN")))


def shipping_state(kind: Column, cost: Column) -> tuple[Column, Column]:
    """(state, known cost). CALCULATED decides before any figure is read; only FIXED proves one."""
    kind = F.upper(F.coalesce(kind, F.lit("")))
    known = (kind == "FIXED") & cost.isNotNull() & (cost != "")
    state = (F.when(kind == "CALCULATED", F.lit("CALCULATED_UNKNOWN")).when(known, F.lit("KNOWN"))
             .otherwise(F.lit("NOT_RETURNED")))
    return state, F.when(known, N.number(cost))


def flatten_listings(df: DataFrame, fetched_at: Column, run_id: Column | None = None) -> DataFrame:
    """Payload rows to flat listing rows. Unknown shipping, price or currency stays unknown."""
    option = F.get(F.col("shippingOptions"), F.lit(0))
    options = F.coalesce(F.col("buyingOptions"), F.array().cast("array<string>"))
    state, shipping = shipping_state(option["shippingCostType"], option["shippingCost"]["value"])
    currencies = stated_currencies(F.col("price.currency"), F.col("currentBidPrice.currency"),
                                   option["shippingCost"]["currency"])
    c = F.col
    df = df.withColumns({
        "sale_format": sale_format(c("buyingOptions")), "shipping_state": state, "shipping_cost": shipping,
        "usd_proven": currencies == F.array(F.lit(V.VALUATION_CURRENCY)),
        "fixed_asking_price": F.when(F.array_contains(options, "FIXED_PRICE"), N.number(c("price.value"))),
        "current_bid_price": N.number(c("currentBidPrice.value"))})
    complete = (c("usd_proven") & (c("sale_format") == "FIXED_PRICE_ONLY") & c("fixed_asking_price").isNotNull()
                & (c("shipping_state") == "KNOWN"))
    return df.select(
        c("itemId").alias("item_id"), F.coalesce(c("title"), F.lit("")).alias("title"),
        c("fixed_asking_price").alias("price"), c("price.currency").alias("currency"), "shipping_cost",
        F.array_join(options, ",").alias("buying_option"), c("bidCount").alias("bid_count"),
        N.utc_instant(c("itemEndDate")).alias("end_time"),
        F.get(c("categories"), F.lit(0))["categoryId"].alias("category_id"), "condition",
        c("itemWebUrl").alias("url"), fetched_at.alias("fetched_at"), F.lit(1).alias("active"),
        F.nullif(c("seller.username"), F.lit("")).alias("seller"),
        N.number(c("seller.feedbackPercentage")).alias("seller_feedback_pct"),
        c("seller.feedbackScore").try_cast("int").alias("seller_feedback_score"),
        (F.lit(None).cast("string") if run_id is None else run_id).alias("discovery_run_id"),
        "current_bid_price", c("currentBidPrice.currency").alias("current_bid_currency"), "fixed_asking_price",
        "shipping_state",
        F.when(complete, c("fixed_asking_price") + F.coalesce(c("shipping_cost"), F.lit(0.0))).alias("acquisition_total"),
        complete.cast("int").alias("acquisition_total_complete"),
        F.when(c("usd_proven") & (c("shipping_state") == "KNOWN"), c("current_bid_price") + c("shipping_cost"))
        .alias("provisional_bid_total"),
        "sale_format", F.lit("UNKNOWN").alias("reserve_state"), "usd_proven", c("leafCategoryIds").alias("leaf_ids"),
        F.array_contains(F.coalesce(c("leafCategoryIds"), F.array().cast("array<string>")), V.SINGLES_LEAF)
        .alias("single_card"), "epid")


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key of both tables, re-seen rows active again.

    ``max_by`` keeps one row per key on the map side, so a key that arrives a billion
    times costs one row per task in the shuffle.
    """
    if "active" in new.columns:
        new = new.withColumn("active", F.lit(1).cast(new.schema["active"].dataType))
    return newest_per_key(old.unionByName(new), keys, order)


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*[c if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def upsert_unless_worse(df: DataFrame, keys: list[str], success: Column, order: list[str]) -> DataFrame:
    """The newest success per key; the newest failure only where nothing ever succeeded."""
    df = df.withColumn("__ok", success.cast("int"))
    return newest_per_key(df, keys, ["__ok", *order]).drop("__ok")


def insert_ignore(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to add, accounting). A key already stored, or seen earlier in the batch, is a duplicate.

    A blank key part is unknown, not equal to another blank one: callers give such rows
    a derived key first.
    """
    rest = [c for c in incoming.columns if c not in keys]
    first = incoming.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"),
                                        F.count(F.lit(1)).alias("__copies"))
    known = stored.select(*keys, F.lit(True).alias("__known")).distinct()
    marked = first.join(known, keys, "left")
    added = marked.where(F.col("__known").isNull()).select(
        *[c if c in keys else F.col(f"__row.{c}").alias(c) for c in incoming.columns])
    accounting = marked.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("incoming"), F.count_if(F.col("__known").isNull()).alias("added"))
    return added, accounting.withColumn("duplicates", F.col("incoming") - F.col("added"))


def sweep_stale(listings: DataFrame, run_start: Column, sellers: list[str] | None = None) -> DataFrame:
    """Active rows this run did not see become inactive; a scoped sweep spares NULL sellers."""
    stale = (F.col("active") == 1) & (F.col("fetched_at") < run_start)
    if sellers:
        stale = stale & F.col("seller").isin(*sellers)
    return listings.withColumn("active", F.when(stale, F.lit(0)).otherwise(F.col("active")))


def crawl_quality(listings: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """Counts of allow-list, category and duplicate findings with their verdicts."""
    df = listings
    if allow is not None:
        df = df.join(allow.select("seller", F.lit(True).alias("__allowed")).distinct(), "seller", "left")
    else:
        df = df.withColumn("__allowed", F.col("seller").isNotNull())
    # Copies of an item collapse per id before the totals, so a hot id costs one row per task.
    per_item = df.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("seller").isNull()).alias("missing"),
        F.count_if(F.col("seller").isNotNull() & F.col("__allowed").isNull()).alias("foreign"),
        F.count_if(~F.col("single_card")).alias("wrong"))
    out = per_item.agg(F.sum("rows").alias("fetched_rows"), F.count(F.lit(1)).alias("distinct_items"),
                       F.sum("missing").alias("missing_seller"), F.sum("foreign").alias("foreign_seller"),
                       F.sum("wrong").alias("wrong_category"))
    return out.withColumns({
        "duplicates": F.col("fetched_rows") - F.col("distinct_items"),
        "seller_check": F.when((F.col("missing_seller") == 0) & (F.col("foreign_seller") == 0), "PASS").otherwise("FAIL"),
        "category_check": F.when(F.col("wrong_category") == 0, "PASS").otherwise("FAIL")})


def write_derived(df: DataFrame, path: str) -> DataFrame:
    """Rebuild a derived table in place and read it back, statistics and pruning included."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def replace_scope(df: DataFrame, path: str, scope: str, values: list) -> None:
    """Replace the partitions of ``scope`` named by ``values`` by the rows of ``df``.

    A named value of which ``df`` has no row loses its old rows: its place in the table is
    taken by one row without an item, which ``read_scoped`` leaves out. Rows of ``df``
    outside the named values are an error of the caller and are not written. A writing task
    orders its rows by ``scope``, so they are dealt in pieces of Spark's advisory size before that.
    """
    spark = df.sparkSession
    kind = df.schema[scope].dataType
    named = spark.createDataFrame([(v,) for v in values], f"`{scope}` {kind.simpleString()}")
    inside = df.join(F.broadcast(named), scope, "left_semi").withColumn("__row", F.lit(True))
    gone = named.join(inside.select(scope).distinct(), scope, "left_anti").select(
        *[F.col(scope) if c == scope else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns],
        F.lit(False).alias("__row"))
    dealt = inside.unionByName(gone).hint("rebalance", F.col(scope))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).parquet(path)


def read_scoped(spark: SparkSession, path: str) -> DataFrame:
    """A table kept by ``replace_scope``."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return (df.where("coalesce(__row, true)") if "__row" in df.columns else df).drop("__row")


