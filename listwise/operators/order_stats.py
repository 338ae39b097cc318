"""Exact order statistics per group without collecting any group.

A built-in ``percentile`` holds every distinct value of a group in one buffer, and a
window over the group sorts the whole group in one task. With a third of all rows on
one key neither survives, so every group, large or small, goes one way:

* the input is reduced to (key, value, count), partially aggregated, which spreads a
  hot key over all tasks by its values;
* a histogram per key, whose number of bins is fixed by the value range and not by the
  row count, gives the rows below each bin by a running sum;
* only bins that hold a wanted rank are looked into, by a running sum per (key, bin);
* where values may lie so close that a bin holds very many of them, ``cuts`` has dense bins cut by
  their own range, and dense parts again, so that no running sum is over more than a bounded number.

The result is exact: a bin only decides where to look, never what the value is. NaN is
no value and counts like NULL.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from listwise.operators.joining import join_null_safe

# Bins per e-fold of 1+|value|. A value range up to 1e9 gives at most about 85k
# bins per group each side of zero, whatever the number of rows.
BINS_PER_EFOLD = 4096

# Distinct values that one running sum takes where bins are cut, and parts of one cut. A bin holds at most 2 ** 41
# doubles (but for the one around zero), so two cuts leave a few thousand of them, however they lie.
DENSE = 100_000
PARTS = 65_536

RankOf = Callable[[Column], Column]


def value_bin(value: Column, bins_per_efold: int = BINS_PER_EFOLD) -> Column:
    """A monotone, data-independent bin number."""
    depth = F.floor(F.log1p(F.abs(value)) * bins_per_efold)
    return F.when(value < 0, -depth).otherwise(depth)


def stated(df: DataFrame, value: str) -> Column:
    """The value, NULL for NaN."""
    return F.when(~F.isnan(value), F.col(value)) if dict(df.dtypes)[value] in ("double", "float") else F.col(value)


def _value_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values of each group with their bins and counts; NULL counts no rows."""
    carried = [c for c in rows.columns if c.startswith("__x_")]
    return (rows.groupBy(*keys, "__v").agg(F.count("__v").alias("__n"), *[F.max(c).alias(c) for c in carried])
            .withColumn("__bin", value_bin(F.col("__v"))))


def _bin_offsets(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Per bin of a group: the rows below it, the rows in it, and the group's summary."""
    carried = [c for c in counts.columns if c.startswith("__x_")]
    hist = counts.groupBy(*keys, "__bin").agg(
        F.sum("__n").alias("__in"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        F.count("__v").alias("__distinct"), *[F.max(c).alias(c) for c in carried])
    # Without keys the bins of the whole table meet in one task: a fixed number of rows.
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.select(*keys, "__bin", "__in", "__distinct", F.col("__min").alias("__low"), F.col("__max").alias("__high"),
                       (F.sum("__in").over(running) - F.col("__in")).alias("__below"),
                       F.sum("__in").over(whole).alias("__total"),
                       F.min("__min").over(whole).alias("__min"), F.max("__max").over(whole).alias("__max"),
                       *[F.max(c).over(whole).alias(f"__w{c}") for c in carried])


def _locate(counts: DataFrame, offsets: DataFrame, keys: list[str], cuts: int) -> DataFrame:
    """Rank range [start, end) of each value inside the kept bins."""
    values = counts.select(*keys, "__bin", "__v", "__n")
    return _placed(join_null_safe(values, offsets.drop("__in"), [*keys, "__bin"]), [*keys, "__bin"], cuts)


def _placed(rows: DataFrame, cell: list[str], cuts: int) -> DataFrame:
    """Rank ranges of the values of each cell, a group of rows with the rows ``__below`` it, its ``__distinct`` values, ``__low`` and ``__high``.

    With ``cuts``, cells of more than ``DENSE`` values are cut into parts of their own range, which are cells themselves. Without any,
    adaptive execution finds their branch empty and leaves it out, but the input is planned several times over.
    """
    c = F.col
    within = Window.partitionBy(*cell).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = c("__below") + F.sum("__n").over(within)
    plain = rows.where(c("__distinct") <= DENSE) if cuts else rows
    out = plain.withColumns({"__end": end, "__start": end - c("__n")}).drop("__distinct", "__low", "__high")
    if not cuts:
        return out
    dense, part = rows.where(c("__distinct") > DENSE), f"__part{cuts}"
    parts = F.least(F.lit(PARTS), F.ceil(c("__distinct") * 4 / DENSE))
    low, high, value = (c(n).cast("double") for n in ("__low", "__high", "__v"))
    dense = dense.withColumn(part, F.least(F.floor((value - low) / (high - low) * parts), parts - 1))
    deeper = [*cell, part]
    inner = dense.groupBy(*deeper).agg(F.sum("__n").alias("__in"), F.count("__v").alias("__distinct"), F.min("__v").alias("__low"),
                                       F.max("__v").alias("__high"), F.max("__below").alias("__base"))
    running = Window.partitionBy(*cell).orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = inner.withColumn("__below", c("__base") + F.sum("__in").over(running) - c("__in")).drop("__base", "__in")
    dense = join_null_safe(dense.drop("__below", "__distinct", "__low", "__high"), inner, deeper)
    return out.unionByName(_placed(dense, deeper, cuts - 1).drop(part))


def order_statistics(df: DataFrame, keys: list[str], value: str, ranks: dict[str, RankOf],
                     total: str = "n", *, lowest: str | None = None, highest: str | None = None,
                     newest: dict[str, str] | None = None, cuts: int = 0) -> DataFrame:
    """One row per group: its row count and the value at each zero-based rank.

    ``ranks`` maps an output column to a function of the group's count of values; a rank
    outside the group yields NULL. ``lowest``, ``highest`` and ``newest`` (output name to
    source column, by maximum over all rows of the group) come along in the same pass.
    Without keys the table is one group; an empty table has no group. Two ``cuts`` are enough for
    values of any density; they cost plan size, so they are for values known to lie close.
    """
    newest = newest or {}
    rows = df.select(*keys, stated(df, value).alias("__v"), *[F.col(source).alias(f"__x_{name}") for name, source in newest.items()])
    counts = _value_counts(rows, keys)
    offsets = _bin_offsets(counts, keys)

    def wanted(rank):
        r = rank(F.col("__total")).cast("long")
        return (r >= F.col("__start")) & (r < F.col("__end"))

    hit = F.col("__below") == 0
    for rank in ranks.values():
        r = rank(F.col("__total")).cast("long")
        hit = hit | F.coalesce((r >= F.col("__below")) & (r < F.col("__below") + F.col("__in")), F.lit(False))
    picks = [F.max("__total").alias(total)]
    picks += [F.max(F.when(wanted(rank), F.col("__v"))).alias(name) for name, rank in ranks.items()]
    picks += [F.min("__min").alias(lowest)] if lowest else []
    picks += [F.max("__max").alias(highest)] if highest else []
    picks += [F.max(f"__w__x_{name}").alias(name) for name in newest]
    out = _locate(counts, offsets.where(hit), keys, cuts).groupBy(*keys).agg(*picks)
    return out if keys else out.where(F.col(total).isNotNull())


LOWER_MEDIAN: RankOf = lambda n: F.floor((n - 1) / 2)
UPPER_MEDIAN: RankOf = lambda n: F.floor(n / 2)
SMALLEST: RankOf = lambda n: F.lit(0)
LARGEST: RankOf = lambda n: n - 1
INDEX_QUARTILES: dict[str, RankOf] = {"q1_index": lambda n: F.floor(n / 4), "q3_index": lambda n: F.floor(3 * n / 4)}


def middle_of(low: str = "__lo", high: str = "__hi") -> Column:
    """The middle value, or the mean of the two middle values."""
    return F.when(F.col(low) == F.col(high), F.col(low)).otherwise((F.col(low) + F.col(high)) / 2)


def group_median(df: DataFrame, keys: list[str], value: str, name: str = "median",
                 total: str = "n", **also) -> DataFrame:
    """Exact median of each group's non-NULL values; NULL for a group without any."""
    stats = order_statistics(df, keys, value, {"__lo": LOWER_MEDIAN, "__hi": UPPER_MEDIAN}, total, **also)
    return stats.withColumn(name, middle_of()).drop("__lo", "__hi")


def _exclusive_position(n: Column, quarter: int) -> Column:
    """One-based lower neighbour of an exclusive quartile."""
    return F.greatest(F.lit(1).cast("long"), F.least(n - 1, F.floor((n + 1) * quarter / 4)))


def exclusive_quartiles(df: DataFrame, keys: list[str], value: str, total: str = "n") -> DataFrame:
    """p25, median and p75 by the exclusive method; quartiles need two values."""
    ranks = {"__lo": LOWER_MEDIAN, "__hi": UPPER_MEDIAN}
    for q in (1, 3):
        ranks[f"__a{q}"] = lambda n, q=q: F.when(n >= 2, _exclusive_position(n, q) - 1)
        ranks[f"__b{q}"] = lambda n, q=q: F.when(n >= 2, _exclusive_position(n, q))
    stats = order_statistics(df, keys, value, ranks, total)

    def quartile(q):
        delta = (F.col(total) + 1) * q - 4 * _exclusive_position(F.col(total), q)
        return F.when(F.col(total) >= 2, (F.col(f"__a{q}") * (4 - delta) + F.col(f"__b{q}") * delta) / 4)

    return stats.select(*keys, total, quartile(1).alias("p25"),
                        middle_of().alias("median"),
                        quartile(3).alias("p75"))


def index_quartiles(df: DataFrame, keys: list[str], value: str, total: str = "n") -> DataFrame:
    """Quartiles read straight off the sorted list: positions n/4, n/2 and 3n/4."""
    return order_statistics(df, keys, value, {**INDEX_QUARTILES, "upper_median": UPPER_MEDIAN}, total)


def interpolated_quantiles(df: DataFrame, keys: list[str], value: str,
                           quantiles: dict[str, float], total: str = "n") -> DataFrame:
    """Inclusive (linear) quantiles between neighbouring ranks."""
    ranks = {}
    for name, q in quantiles.items():
        ranks[f"__f_{name}"] = lambda n, q=q: F.floor((n - 1) * q)
        ranks[f"__c_{name}"] = lambda n, q=q: F.ceil((n - 1) * q)
    stats = order_statistics(df, keys, value, ranks, total)
    outs = []
    for name, q in quantiles.items():
        position = (F.col(total) - 1) * q
        share = position - F.floor(position)
        low, high = F.col(f"__f_{name}"), F.col(f"__c_{name}")
        outs.append((low + (high - low) * share).alias(name))
    return stats.select(*keys, total, *outs)


def with_value_rank(df: DataFrame, keys: list[str], value: str, name: str = "rank", cuts: int = 0) -> DataFrame:
    """Each row with the competition rank (1 + rows below) of its value in its group.

    Without keys the whole table is one group, and there is no global sort. Rows without
    a value keep a NULL rank.
    """
    counts = _value_counts(df.select(*keys, stated(df, value).alias("__v")).where("__v IS NOT NULL"), keys)
    ranks = _locate(counts, _bin_offsets(counts, keys), keys, cuts).select(
        *keys, F.col("__v").alias(value), (F.col("__start") + 1).alias(name))
    return join_null_safe(df, ranks, [*keys, value], "left")
