"""Grouping keys and readable identities."""

from pyspark.sql import Column, functions as F

from listwise.functions.text import key_part, present

KEY_LENGTH = 16


def short_sha(text: Column, length: int = KEY_LENGTH) -> Column:
    return F.substring(F.sha1(text), 1, length)


def flag_text(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0)).cast("string")


def card_rest(f) -> Column:
    """What a card key hashes behind the sport."""
    parts = [key_part(f[n]) for n in ("year", "manufacturer", "set_name", "insert_name", "parallel", "card_number", "athlete")]
    return F.concat_ws("|", *parts, flag_text(f["is_auto"]), flag_text(f["is_relic"]), key_part(f["print_run"]))


def card_key(f, rest: Column | None = None) -> Column:
    """Identity without grade and serial; the print run stays in. ``rest`` is ``card_rest`` where several keys share it."""
    return short_sha(F.concat_ws("|", key_part(f["sport"]), card_rest(f) if rest is None else rest))


def grade_rest(f) -> Column:
    """What a slab key hashes behind the card key."""
    kind = F.coalesce(present(f["grade_type"]), F.lit("-"))
    return F.concat_ws("|", kind, key_part(f["grade_value"]), key_part(f["grade_qualifier"]), key_part(f["auto_grade"]))


def slab_key(card: Column, f, rest: Column | None = None) -> Column:
    """The card key plus grade, qualifier and autograph grade. ``rest`` is ``grade_rest`` where several keys share it."""
    return short_sha(F.concat_ws("|", card, grade_rest(f) if rest is None else rest))


def identity_text(f) -> Column:
    """Pipe-joined identity; an absent part prints as None."""
    def shown(name):
        return F.coalesce(f[name].cast("string"), F.lit("None"))

    def marked(prefix, name, zero_is_absent=False):
        value = f[name].cast("string")
        absent = f[name].isNull() | (value == "") | ((value == "0") if zero_is_absent else F.lit(False))
        return F.when(absent, F.lit("")).otherwise(F.concat(F.lit(prefix), value))

    return F.concat(
        shown("year"), F.lit("|"), shown("manufacturer"), F.lit("|"), shown("set_name"), F.lit("|"),
        shown("parallel"), F.lit("|#"), shown("card_number"), F.lit("|"),
        shown("grade_type"), F.lit(":"), shown("grade_value"),
        marked("+", "grade_qualifier"), marked("+AUTO", "auto_grade"), marked("|/", "print_run", True),
        F.lit("|"), F.coalesce(F.nullif(f["sport"], F.lit("")), F.lit("SPORT?")))


def transaction_key(item_id: Column, title: Column, price: Column, shipping: Column, date: Column) -> Column:
    """One sale, not one listing: the same listing can sell twice."""
    blank = F.lit("")
    has_id = F.coalesce(item_id, blank) != ""
    seed = F.concat_ws("|", F.when(has_id, item_id).otherwise(F.lower(F.trim(F.coalesce(title, blank)))),
                       *[F.coalesce(c.cast("string"), blank) for c in (price, shipping, date)])
    return F.concat(F.when(has_id, item_id).otherwise(F.lit("pr")), F.lit("-"), short_sha(seed, 10))
