"""Listings, sold comps and titles read out of the given tables.

A line item is a listing (open) or a sale (finished) of a part: the part is the
slab, the supplier the seller, price per unit the price, price times tax the
shipping. The highest tax rate stands for shipping that was never stated.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from listwise.session import spread_few

TODAY = dt.date(2002, 6, 30)
TODAY_SQL = "DATE '2002-06-30'"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def item_id():
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.date_format("l_shipdate", "yyyyMMdd"))


ITEM_ID_SQL = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
               "strftime(l_shipdate, '%Y%m%d'))")


def items(spark: SparkSession, sf: str, lines: DataFrame | None = None, beside: tuple[str, ...] = ()) -> DataFrame:
    """Every line item as a priced row with an id, a slab, a seller and a day, and the columns ``beside`` of ``lines``."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return (table(spark, sf, "lineitem") if lines is None else lines).select(
        item_id().alias("item_id"), F.col("l_partkey").alias("slab_key"),
        F.col("l_suppkey").alias("seller"), F.col("l_linestatus").alias("status"),
        F.col("l_returnflag").alias("flag"), price.alias("price"),
        F.when(F.col("l_tax") < 0.075, price * F.col("l_tax")).alias("shipping_cost"),
        F.col("l_discount").alias("discount"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_linenumber").alias("line"),
        (F.col("l_returnflag") != "R").alias("active"), F.col("l_shipdate").cast("date").alias("day"), *beside)


ITEMS_SQL = f"""items AS (
  SELECT {ITEM_ID_SQL} AS item_id, l_partkey AS slab_key, l_suppkey AS seller,
         l_linestatus AS status, l_returnflag AS flag, l_extendedprice / l_quantity AS price,
         CASE WHEN l_tax < 0.075 THEN l_extendedprice / l_quantity * l_tax END AS shipping_cost,
         l_discount AS discount, CAST(l_quantity AS INTEGER) AS quantity, l_linenumber AS line,
         l_returnflag <> 'R' AS active, CAST(l_shipdate AS DATE) AS day
  FROM lineitem)"""


def listings(spark, sf) -> DataFrame:
    return items(spark, sf).where("status = 'O'")


LISTINGS_SQL = ITEMS_SQL + ", listings AS (SELECT * FROM items WHERE status = 'O')"


def sold(spark, sf) -> DataFrame:
    """Finished sales; a deep discount hides the accepted price."""
    shown = F.when(F.col("discount") < 0.055, F.col("price"))
    return items(spark, sf).where("status = 'F'").select(
        "item_id", "slab_key", "seller", "flag", "line", F.col("item_id").alias("source_item_id"),
        shown.alias("sold_price"), F.col("shipping_cost").alias("shipping"),
        (shown + F.coalesce(F.col("shipping_cost"), F.lit(0.0))).alias("total_price"),
        F.col("day").alias("sale_date"))


SOLD_SQL = """sold AS (
  SELECT item_id, slab_key, seller, flag, line, item_id AS source_item_id,
         CASE WHEN discount < 0.055 THEN price END AS sold_price, shipping_cost AS shipping,
         CASE WHEN discount < 0.055 THEN price END + coalesce(shipping_cost, 0.0) AS total_price,
         day AS sale_date
  FROM items WHERE status = 'F')"""


def accepted(spark, sf) -> DataFrame:
    return sold(spark, sf).where("flag <> 'N'")


def uncertain(spark, sf) -> DataFrame:
    return sold(spark, sf).where("flag = 'N'")


BASE_SQL = f"""{LISTINGS_SQL}, {SOLD_SQL},
accepted AS (SELECT * FROM sold WHERE flag <> 'N'),
uncertain AS (SELECT * FROM sold WHERE flag = 'N' AND total_price IS NOT NULL)"""


def median_sql(name: str, source: str, keys: str, value: str, out: str) -> str:
    """A CTE with the exact median of ``value`` per key, by counting rows."""
    return f"""{name} AS (
  SELECT {keys}, count(*) AS n_{out}, (min(v) + max(v)) / 2 AS {out} FROM (
    SELECT {keys}, {value} AS v, row_number() OVER (PARTITION BY {keys} ORDER BY {value}) AS rn,
           count(*) OVER (PARTITION BY {keys}) AS n
    FROM {source} WHERE {value} IS NOT NULL) WHERE rn IN ((n + 1) // 2, n // 2 + 1)
  GROUP BY {keys})"""


def benchmark_sql(name: str, source: str, key: str = "slab_key") -> str:
    """CTEs ``<name>_med`` and ``<name>``: the benchmark of each key."""
    return median_sql(f"{name}_med", source, key, "total_price", "med") + f""",
{name} AS (
  SELECT {key}, count(total_price) AS comp_count, min(total_price) AS min_total,
         max(total_price) AS max_total, max(sale_date) AS most_recent_sale,
         CASE WHEN count(total_price) >= 2 AND min(total_price) > 0
              THEN max(total_price) / min(total_price) END AS dispersion,
         any_value(med) AS median_total
  FROM {source} LEFT JOIN {name}_med USING ({key}) GROUP BY {key})"""


def decided_sql(name: str, bench: str, key: str = "slab_key", dispersion_limit: float = 2.5,
                max_age: int = 365, shipping: str = "shipping_cost", buy: float = 0.25,
                watch: float = 0.10) -> str:
    """A CTE with one decision per listing against the benchmark ``bench``."""
    return f"""{name}_c AS (
  SELECT l.* EXCLUDE (shipping_cost), {shipping} AS shipping_cost, coalesce(comp_count, 0) AS comp_count,
         CASE WHEN comp_count >= 3 THEN median_total END AS median_total,
         CASE WHEN comp_count >= 3 THEN min_total END AS min_total,
         CASE WHEN comp_count >= 3 THEN max_total END AS max_total,
         CASE WHEN comp_count >= 3 THEN dispersion END AS dispersion,
         most_recent_sale, median_total AS benchmark_median,
         CASE WHEN {shipping} IS NULL THEN price ELSE price + {shipping} END AS total_cost,
         price IS NOT NULL AND {shipping} IS NOT NULL AS cost_complete
  FROM listings l LEFT JOIN {bench} USING ({key})),
{name}_g AS (
  SELECT *, CASE WHEN comp_count >= 5 THEN 'HIGH' WHEN comp_count >= 3 THEN 'MEDIUM'
                 WHEN comp_count >= 1 THEN 'LOW' ELSE 'NONE' END AS confidence,
         CASE WHEN comp_count >= 3 AND total_cost > 0 AND active
              THEN median_total - total_cost END AS gross_gap
  FROM {name}_c),
{name}_p AS (SELECT *, gross_gap / nullif(median_total, 0) AS pct FROM {name}_g),
{name}_r AS (
  SELECT *, pct * 100 AS gross_pct,
    CASE WHEN comp_count < 3 THEN 'INSUFFICIENT_EVIDENCE'
         WHEN total_cost IS NULL OR total_cost <= 0 THEN 'NO_ASKING_PRICE'
         WHEN NOT active THEN 'STALE_ASKING_PRICE'
         WHEN pct >= {buy} THEN 'BUY_DISCOUNT_AT_OR_ABOVE_25'
         WHEN pct >= {watch} THEN 'WATCH_DISCOUNT_10_TO_25'
         WHEN pct > 0 THEN 'PASS_DISCOUNT_BELOW_10' ELSE 'PASS_AT_OR_ABOVE_MARKET' END AS reason,
    CASE WHEN pct >= {buy} THEN
      CASE WHEN dispersion > {dispersion_limit} THEN 'DOWNGRADED_HIGH_DISPERSION'
           WHEN most_recent_sale IS NULL OR {TODAY_SQL} - most_recent_sale > {max_age} THEN 'DOWNGRADED_STALE_COMPS'
           WHEN NOT cost_complete THEN 'DOWNGRADED_INCOMPLETE_COST' END END AS downgrade_reason
  FROM {name}_p),
{name} AS (
  SELECT *, CASE WHEN reason LIKE 'BUY%' THEN CASE WHEN downgrade_reason IS NULL THEN 'BUY' ELSE 'WATCH' END
                 WHEN reason LIKE 'WATCH%' THEN 'WATCH' ELSE 'PASS' END AS decision
  FROM {name}_r)"""


# --- titles ------------------------------------------------------------------------
# Each item gets a title composed of its own and its part's columns, so that what the
# extractor must find is known from those columns without reading the title.

MAKER_HEADS = ("TOPPS", "PANINI", "Upper Deck", "FLEER", "FINEST", "ACME")


def _pick(index, values):
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def titled_items(spark, sf, where: str = "true") -> DataFrame:
    """Items with the title a seller might write for them, dealt to all cores: reading a title costs far more than its row."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")
    # Ids and prices are written behind the join, which shuffles the plain columns where parts are many.
    lines = spread_few(table(spark, sf, "lineitem")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    df = items(spark, sf, lines, ("p_name", "p_type", "p_size")).where(where)
    p, s = F.col("slab_key"), F.col("seller")
    numeric = F.concat(F.lit("PSA "), ((F.col("quantity") % 10) + 1).cast("string"),
                       F.when(F.col("discount") >= 0.095, " (OC)").when(F.col("discount") >= 0.085, " MC").otherwise(""))
    grade = (F.when(s % 13 == 0, F.lit("PSA/DNA")).when(s % 13 == 4, F.lit("")).when(s % 13 == 1, "PSA AUTHENTIC").when(s % 13 == 2, "PSA 9 AUTO 10")
             .when(s % 13 == 3, "BGS 9.5").otherwise(numeric))
    serial = (F.when(s % 7 == 0, F.concat(F.col("quantity").cast("string"), F.lit("/99"))).when(s % 7 == 1, "#/50")
              .when(s % 7 == 2, F.concat(F.lit("#"), F.col("quantity").cast("string"), F.lit("/199"))).otherwise(""))
    flag = (F.when(F.col("line") == 1, "Rookie").when(F.col("line") == 2, "Auto").when(F.col("line") == 3, "Patch")
            .otherwise(""))
    title = F.concat_ws(
        " ", (F.col("p_size") + 1960).cast("string"), _pick(p % 6, MAKER_HEADS), F.col("p_type"),
        F.upper(F.substring_index("p_name", " ", 1)), F.when(p % 19 == 0, "NBA").otherwise(""),
        F.when(p % 11 != 0, F.concat(F.lit("#"), p.cast("string"))).otherwise(""),
        F.when(p % 17 == 0, "José").otherwise("Sam"), F.initcap(F.substring_index("p_name", " ", -1)),
        flag, serial, grade)
    return df.withColumn("title", F.trim(F.regexp_replace(title, " +", " ")))


# The composed title itself, in capitals, over the columns of ``facts``.
TITLE_TEXT_SQL = """array_to_string(list_filter([CAST(year AS VARCHAR),
    ['TOPPS', 'PANINI', 'UPPER DECK', 'FLEER', 'FINEST', 'ACME'][(slab_key % 6) + 1], upper(p_type), tint, CASE WHEN nba THEN 'NBA' END,
    CASE WHEN numbered THEN '#' || slab_key END, first_name, noun, trim(flag_text),
    CASE seller % 7 WHEN 0 THEN quantity || '/99' WHEN 1 THEN '#/50' WHEN 2 THEN '#' || quantity || '/199' END,
    CASE seller % 13 WHEN 0 THEN 'PSA/DNA' WHEN 1 THEN 'PSA AUTHENTIC' WHEN 2 THEN 'PSA 9 AUTO 10' WHEN 3 THEN 'BGS 9.5' WHEN 4 THEN ''
      ELSE 'PSA ' || (quantity % 10 + 1) || CASE WHEN discount >= 0.095 THEN ' (OC)' WHEN discount >= 0.085 THEN ' MC' ELSE '' END END],
    lambda x: x <> ''), ' ')"""

TITLED_SQL = ITEMS_SQL + """,
parts AS (
  SELECT slab_key_p, p_size + 1960 AS year, p_type, upper(split_part(p_name, ' ', 1)) AS tint,
         upper(split_part(p_name, ' ', 2)) AS noun, slab_key_p % 6 AS m, slab_key_p % 19 = 0 AS nba,
         CASE WHEN slab_key_p % 17 = 0 THEN 'JOSE' ELSE 'SAM' END AS first_name, slab_key_p % 11 <> 0 AS numbered
  FROM (SELECT *, p_partkey AS slab_key_p FROM part)),
facts AS (
  SELECT i.*, year, tint, noun, nba, numbered, p_type, first_name,
    ['TOPPS', 'PANINI', 'UPPER DECK', 'FLEER', 'TOPPS', NULL][m + 1] AS manufacturer,
    ['HIGH', 'HIGH', 'HIGH', 'HIGH', 'MEDIUM', 'LOW'][m + 1] AS manufacturer_conf,
    ['', '', '', '', 'FINEST ', 'ACME '][m + 1] AS lead,
    CASE WHEN nba THEN 'BASKETBALL' END AS sport,
    CASE WHEN tint IN ('RED', 'BLUE') THEN tint END AS parallel,
    CASE WHEN line = 1 THEN ' ROOKIE' WHEN line = 2 THEN ' AUTO' WHEN line = 3 THEN ' PATCH' ELSE '' END AS flag_text,
    CAST(line = 1 AS INTEGER) AS is_rookie,
    CAST(line = 2 OR seller % 13 = 2 AS INTEGER) AS is_auto, CAST(line = 3 AS INTEGER) AS is_relic,
    CASE WHEN seller % 7 IN (0, 2) THEN quantity END AS serial_num,
    CASE seller % 7 WHEN 0 THEN 99 WHEN 1 THEN 50 WHEN 2 THEN 199 END AS print_run,
    CASE WHEN seller % 13 IN (0, 3, 4) THEN NULL WHEN seller % 13 = 1 THEN 'AUTHENTIC' ELSE 'NUMERIC' END AS grade_type,
    CASE WHEN seller % 13 IN (0, 3, 4) THEN NULL WHEN seller % 13 = 1 THEN 'AUTHENTIC' WHEN seller % 13 = 2 THEN '9'
         ELSE CAST(quantity % 10 + 1 AS VARCHAR) END AS grade_value,
    CASE WHEN seller % 13 > 4 THEN CASE WHEN discount >= 0.095 THEN 'OC' WHEN discount >= 0.085 THEN 'MC' END
         END AS grade_qualifier,
    CASE WHEN line = 2 AND seller % 7 = 0 AND quantity <= 10 THEN CAST(quantity AS VARCHAR) WHEN seller % 13 = 2 THEN '10' END AS auto_grade,
    CASE WHEN seller % 13 = 3 THEN 'BGS' WHEN seller % 13 = 4 THEN 'NO GRADER' END AS excluded
  FROM items i JOIN parts ON slab_key_p = slab_key),
spans AS (
  SELECT *, lead || p_type || CASE WHEN parallel IS NULL AND tint <> p_type THEN ' ' || tint ELSE '' END
         || CASE WHEN nba THEN ' NBA' ELSE '' END AS short_span FROM facts),
cards AS (
  SELECT *, CASE WHEN numbered THEN CAST(slab_key AS VARCHAR) END AS card_number,
    CASE WHEN numbered THEN first_name || ' ' || noun || CASE WHEN excluded = 'BGS' AND flag_text = '' AND seller % 7 > 1 THEN ' BGS 9.5' ELSE '' END END AS athlete,
    CASE WHEN numbered THEN short_span
         ELSE short_span || ' ' || first_name || ' ' || noun || flag_text
              || CASE WHEN seller % 13 = 0 AND seller % 7 > 1 THEN ' PSA/DNA' WHEN excluded = 'BGS' THEN ' BGS 9.5' ELSE '' END END AS set_name
  FROM spans),
leveled AS (
  SELECT *, CASE WHEN parallel IS NOT NULL THEN 'HIGH'
                 WHEN len(string_split(set_name, ' ')) >= 5 THEN 'LOW' ELSE 'MEDIUM' END AS parallel_conf,
         CASE WHEN numbered THEN 'HIGH' ELSE 'MISSING' END AS card_number_conf,
         CASE WHEN manufacturer IS NULL THEN 'LOW' ELSE 'MEDIUM' END AS set_name_conf,
         CASE WHEN grade_type IS NULL THEN 'MISSING' ELSE 'HIGH' END AS grade_conf
  FROM cards),
rated AS (
  SELECT *, CASE WHEN card_number_conf = 'MISSING' OR grade_conf = 'MISSING' THEN 'MISSING'
                 WHEN parallel_conf = 'LOW' OR set_name_conf = 'LOW' THEN 'LOW' ELSE 'MEDIUM' END AS identity_conf
  FROM leveled),
keyparts AS (
  SELECT *, list_transform([sport, CAST(year AS VARCHAR), manufacturer, set_name, NULL, parallel, card_number, athlete],
      lambda x: coalesce(nullif(regexp_replace(upper(x), '[^A-Z0-9]+', '', 'g'), ''), '-')) AS kp FROM rated),
keyed AS (
  SELECT *, substr(sha1(array_to_string(kp, '|') || '|' || is_auto || '|' || is_relic || '|'
      || coalesce(CAST(print_run AS VARCHAR), '-')), 1, 16) AS card_key FROM keyparts),
identity AS (
  SELECT *, substr(sha1(card_key || '|' || coalesce(grade_type, '-') || '|' || coalesce(grade_value, '-') || '|'
      || coalesce(grade_qualifier, '-') || '|' || coalesce(auto_grade, '-')), 1, 16) AS title_slab_key,
    CASE WHEN identity_conf IN ('MEDIUM', 'HIGH') AND manufacturer IS NOT NULL THEN 'ok'
         WHEN identity_conf IN ('MEDIUM', 'HIGH') THEN 'partial' ELSE 'failed' END AS parse_status
  FROM keyed)"""
