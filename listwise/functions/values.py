"""Number, money and date functions on columns."""

from pyspark.sql import Column, functions as F

from listwise import fixed_values as V
from listwise.functions.text import capture


def number(c: Column) -> Column:
    """Text to double; what does not read as a number, NaN included, is NULL."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def as_number(c: Column) -> Column:
    """Text to double with symbols stripped; NULL when nothing numeric is left."""
    return F.regexp_replace(c.cast("string"), r"[^\d.\-]", "").try_cast("double")


def truthy(c: Column, *more: str) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "yes", "y", *more), F.lit(False))


def falsey(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string"))).isin("0", "false", "no", "none", "")


def money(c: Column) -> tuple[Column, Column]:
    """Displayed price to (amount, currency); placeholders give neither."""
    text = F.trim(c.cast("string"))
    usable = text.isNotNull() & (text != "") & ~F.lower(text).isin("-", "n/a", "na", "none", "--")
    currency = F.lit(None).cast("string")
    for symbol, code in reversed(list(V.CURRENCY_SYMBOLS.items())):
        currency = F.when(text.contains(symbol), F.lit(code)).otherwise(currency)
    amount = F.replace(capture(F.replace(text, F.lit(" "), F.lit("")), r"(-?\d[\d,]*\.?\d*)", 1),
                       F.lit(","), F.lit("")).try_cast("double")
    return F.when(usable, amount), F.when(usable, currency)


def sale_date(c: Column) -> Column:
    """Seven accepted spellings, tried in order; anything else is NULL."""
    text = F.trim(c)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in V.DATE_FORMATS])


def iso_date(c: Column) -> Column:
    """Date from the first ten characters of an ISO text."""
    return F.try_to_timestamp(F.substring(c.cast("string"), 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def candidate_cost(price: Column, shipping: Column) -> tuple[Column, Column]:
    """(total, complete). Unknown shipping leaves a floor, never a free delivery."""
    total = F.when(shipping.isNull(), price).otherwise(price + shipping)
    return total, price.isNotNull() & shipping.isNotNull()


def comp_total(price: Column, shipping: Column) -> Column:
    return price + F.coalesce(shipping, F.lit(0.0))


def confidence(n: Column) -> Column:
    return (F.when(n >= 5, "HIGH").when(n >= 3, "MEDIUM").when(n >= 1, "LOW").otherwise("NONE"))


def markup_pct(cost: Column, median: Column) -> Column:
    return F.when(median != 0, (cost / F.nullif(median, F.lit(0.0)) - 1) * 100)


def markup_band(markup: Column) -> Column:
    """Half-open bands (previous, edge]; NULL only for a NULL markup."""
    out = F.when(markup <= 0, F.lit("at or below market"))
    prev = 0
    for edge in V.MARKUP_EDGES[1:]:
        out = out.when(markup <= edge, F.lit(f"above market {prev}-{edge}%"))
        prev = edge
    return out.when(markup > V.MARKUP_EDGES[-1], F.lit(f"above market over {V.MARKUP_EDGES[-1]}%"))


def price_band(price: Column) -> Column:
    out = None
    for low, high in V.PRICE_BANDS:
        test = (price >= low) & (price < high) if high is not None else price >= low
        label = F.lit(f"{low}-{high}" if high is not None else f"{low}+")
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def market_gap(asking: Column, median: Column) -> tuple[Column, Column, Column]:
    """(gap, percent, label); a positive gap is a discount to the market."""
    gap = F.coalesce(median, F.lit(0.0)) - F.coalesce(asking, F.lit(0.0))
    pct = F.when(F.coalesce(median, F.lit(0.0)) != 0, 100 * gap / F.nullif(median, F.lit(0.0))).otherwise(0.0)
    label = (F.when(gap > 0, "discount to market").when(gap < 0, "premium over market").otherwise("at market"))
    return gap, pct, label


def is_placeholder(ask: Column) -> Column:
    """An ask on an exact thousand boundary: not a real offer."""
    nearest = F.bround(ask / V.PLACEHOLDER_STEP) * V.PLACEHOLDER_STEP
    return (ask >= V.PLACEHOLDER_FLOOR) & (F.abs(ask - nearest) < 0.005)


def ending_window(start: Column) -> tuple[Column, Column]:
    """The auction window: opens a lead after the start and lasts a day."""
    opens = start + F.expr(f"INTERVAL {V.WINDOW_LEAD_HOURS} HOURS")
    return opens, opens + F.expr(f"INTERVAL {V.WINDOW_HOURS} HOURS")


def utc_instant(text: Column) -> Column:
    """ISO text that states its offset, as a timestamp; a naive text is NULL."""
    stated = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(stated, F.try_to_timestamp(text))
