"""String functions on columns. All stay inside code generation; no UDFs."""

import re
import unicodedata
from html.entities import html5

from pyspark.sql import Column, functions as F

from listwise import fixed_values as V


def _accent_tables() -> tuple[str, str]:
    """One-to-one accent folding for the Latin blocks, derived from Unicode data."""
    source, target = [], []
    for code in [*range(0x00A0, 0x0250), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if folded != ch and len(folded) == 1:
            source.append(ch)
            target.append(folded)
    return "".join(source), "".join(target)


ACCENTED, PLAIN = _accent_tables()


def normalize(c: Column) -> Column:
    """Accents off, curly quotes and dashes straightened, one space, upper case.

    Text of one byte a character has nothing to fold, and single blanks stay as they are.
    """
    folded = F.when(F.octet_length(c) == F.char_length(c), c).otherwise(
        F.regexp_replace(F.translate(c, ACCENTED + "’‘–", PLAIN + "''-"), r"\p{M}+", ""))
    return F.upper(F.trim(F.regexp_replace(folded, r"(?U)\s\s+|[\s&&[^ ]]", " ")))


def present(c: Column) -> Column:
    """The text, or NULL for an empty one. ``nullif`` would evaluate it twice inside a branch, or add a projection outside of one."""
    return F.get(F.array_remove(F.array(c), ""), F.lit(0))


def norm(c: Column) -> Column:
    """Letters and digits only, upper case; empty becomes NULL."""
    return present(F.regexp_replace(F.upper(c.cast("string")), "[^A-Z0-9]+", ""))


def key_part(c: Column) -> Column:
    """``norm`` for hashing, where an absent part is written ``-``."""
    return F.coalesce(norm(c), F.lit("-"))


def words(c: Column) -> Column:
    """Whitespace-separated words, no empties."""
    return F.array_remove(F.split(c, r"\s+"), "")


def plain_words(c: Column) -> Column:
    """``words`` of a text whose only white space is the blank."""
    return F.array_remove(F.split(c, " "), "")


def tokens_of(c: Column) -> Column:
    """Distinct upper-case alphanumeric tokens; NULL text has none."""
    parts = F.split(F.upper(F.coalesce(c.cast("string"), F.lit(""))), "[^A-Z0-9]+")
    return F.array_distinct(F.array_remove(parts, ""))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


_SEP, _PAIR = "~", "|"


def lit_array(values) -> Column:
    """A constant string array, written as one literal that folds at planning time."""
    values = list(values)
    return F.split(F.lit(_SEP.join(values)), _SEP) if values else F.array().cast("array<string>")


def lit_map(mapping: dict) -> Column:
    """A constant string map, written as one literal that folds at planning time."""
    text = _SEP.join(f"{k}{_PAIR}{v}" for k, v in mapping.items())
    return F.str_to_map(F.lit(text), F.lit(_SEP), F.lit(r"\|"))


def lookup(mapping: dict, key: Column) -> Column:
    """Dictionary lookup; NULL when the key is unknown."""
    return F.try_element_at(lit_map(mapping), key)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row.

    An outer expression used inside a lambda is evaluated again for every element;
    bound this way it is a variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def capture(c: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, NULL when nothing matched (or the group did not take part)."""
    return present(F.regexp_extract(c, pattern, group))


def matches(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def phrase_trie(phrases) -> str:
    """A pattern for any of the phrases, as a trie of their characters; where one begins another, the longer is tried first.

    At a place in a text it looks at one branch of each letter, where a list of alternatives tries every phrase.
    """
    root: dict = {}
    for phrase in phrases:
        node = root
        for ch in phrase:
            node = node.setdefault(ch, {})
        node[""] = {}

    def shown(node: dict) -> str:
        branches = [(" " if ch == " " else re.escape(ch)) + shown(after) for ch, after in node.items() if ch]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and "" not in node else "(?:" + "|".join(branches) + ")"
        return body + "?" if "" in node else body

    return shown(root)


def phrase_regex(phrases) -> str:
    """Known phrases bounded by word edges, the longest at a place."""
    return r"\b(" + phrase_trie(phrases) + r")\b"


def dedupe_tokens(c: Column) -> Column:
    """Repeated words collapse to their first occurrence."""
    return F.array_join(F.array_distinct(words(c)), " ")


def group_title_tokens(title: Column) -> Column:
    """Title tokens that could tell two slabs apart: no grade, no copy number, no noise."""
    t = F.regexp_replace(normalize(title), r"\bPSA\s*(10|[1-9](?:\.5)?)\b", " ")
    t = F.regexp_replace(t, r"#\s*/\s*\d{1,5}\b", " ")
    t = F.regexp_replace(t, r"\b\d{1,4}\s*/\s*\d{1,5}\b", " ")
    parts = F.array_remove(F.split(t, r"[^A-Z0-9'./-]+"), "")
    return F.array_except(parts, lit_array(V.GROUP_TITLE_NOISE))


def dedupe_query(text: Column) -> Column:
    """Drop repeated search words, but never a value that follows PSA or AUTO."""
    toks = words(F.coalesce(text, F.lit("")))
    spelled_out = F.exists(toks, lambda t: F.upper(t).startswith("AUTOGRAPH"))
    start = F.struct(F.array().cast("array<string>").alias("kept"),
                     F.array().cast("array<string>").alias("seen"),
                     F.lit(None).cast("string").alias("prev"))

    def step(acc, tok):
        key = F.upper(tok)
        value_after_label = F.coalesce(acc["prev"].isin("PSA", "AUTO"), F.lit(False)) & key.rlike(
            r"^(10|[1-9](?:\.5)?|AUTHENTIC|AUTH)$")
        skip = (spelled_out & (key == "AUTO")) | (F.array_contains(acc["seen"], key) & ~value_after_label)
        return F.when(skip, acc).otherwise(F.struct(
            F.concat(acc["kept"], F.array(tok)).alias("kept"),
            F.concat(acc["seen"], F.array(key)).alias("seen"),
            key.alias("prev")))

    return F.array_join(F.aggregate(toks, start, step, lambda acc: acc["kept"]), " ")


def clean_listing_title(text: Column) -> Column:
    """Remove interface phrases and collapse a title printed twice in one cell."""
    noise = "(?i)(" + "|".join(re.escape(n).replace(r"\ ", " ") for n in V.UI_NOISE) + ")"
    out = squeeze(F.regexp_replace(squeeze(F.coalesce(text, F.lit(""))), noise, " "))

    def once(out: Column) -> Column:
        half = F.floor(F.length(out) / 2).cast("int")
        left, right = F.trim(out.substr(F.lit(1), half)), F.trim(out.substr(half + 1, F.length(out)))
        twice = (half > 15) & (F.lower(left) == F.lower(right))
        # Twice twenty characters and a blank are the least that can repeat.
        repeated = F.when(F.length(out) > 40, F.trim(F.regexp_extract(out, r"(?s)^(.{20,}?)\s+\1\b", 1))).otherwise("")
        return F.when(twice, left).otherwise(let(repeated, lambda r: F.when(r != "", r).otherwise(out)))

    return let(F.regexp_replace(out, r"^[ ,;|\-]+|[ ,;|\-]+$", ""), once)


def hoist_year(title: Column) -> Column:
    """Start a sold title at its first year; the words before it move to the end."""
    def moved(text: Column, at: Column) -> Column:
        prefix = F.regexp_replace(text.substr(F.lit(1), at - 1), r"^[ ~\-|,]+|[ ~\-|,]+$", "")
        rest = F.trim(text.substr(at, F.length(text)))
        return F.when((text == "") | (at == 0), text).otherwise(F.trim(F.concat_ws(" ", rest, prefix)))

    def hoisted(text: Column) -> Column:
        led = text.rlike(r"^\s*(?:18|19|20)\d{2}")
        return F.when(led, text).otherwise(let(F.regexp_instr(text, F.lit(r"\b((?:19|20)\d{2})\b")), lambda at: moved(text, at)))

    return let(F.trim(F.coalesce(title, F.lit(""))), hoisted)


def repair_print_run(text: Column, print_run: Column) -> Column:
    """Make three print-run spellings of sold titles readable by the extractor.

    A zero-padded "#0NN/M" is a serial stamp only when M is the candidate's own run.
    """
    out = F.coalesce(text, F.lit(""))
    run = F.coalesce(F.nullif(print_run.cast("int"), F.lit(0)).cast("string"), F.lit("(?!)"))
    padded = F.concat(F.lit(r"#\s*(0\d{1,4})\s*/\s*("), run, F.lit(r")\b"))
    copy_no = F.call_function("regexp_extract", out, padded, F.lit(1)).try_cast("int")
    stamped = F.regexp_replace(out, F.concat(F.lit(r"(?s)^(.*?)"), padded), F.lit("$1$2/$3"))
    out = F.when(copy_no <= print_run.cast("int"), stamped).otherwise(out)
    # "#200 ... #37/99": the second hash marks the serial, not a second card number. A card number may have any length.
    out = F.regexp_replace(out, r"(?s)^(.*?#\s*\d+\b.*?)#(\d{1,4}\s*/\s*\d{1,5})", "$1$2")
    return F.regexp_replace(out, r"(?<![\d/#])\s/\s*(\d{1,5})\b", " #/$1")


def item_number(value: Column) -> Column:
    """The marketplace item number inside an id, or NULL."""
    return capture(F.trim(F.coalesce(value.cast("string"), F.lit(""))), V.ITEM_NUMBER, 1)


def header_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.coalesce(name, F.lit("")))), "[^a-z0-9]", "")


def rule_for(reason: Column) -> Column:
    """Which rule produced a verdict, from its reason text."""
    low = F.lower(reason)
    out = F.when(reason.isNull() | (reason == ""), F.lit("accepted"))
    for needle, rule in V.REASON_RULES:
        out = out.when(low.contains(needle), F.lit(rule))
    return out.otherwise(F.lit("other"))


def canonical_sport(value: Column) -> Column:
    v = F.regexp_replace(F.upper(F.trim(value)), r"\s+", " ")
    return F.when((value.isNotNull()) & (value != ""), F.coalesce(lookup(V.SPORT_ALIASES, v), v))


def maker_of_token(token: Column) -> Column:
    return F.coalesce(lookup(V.MAKERS, token), lookup(V.PRODUCT_LINE_MAKER, token))


def canonical_brand(name: Column) -> Column:
    """First word of a maker name that is a known maker or product line."""
    return F.get(F.array_compact(F.transform(words(normalize(name)), maker_of_token)), F.lit(0))


def brands_in(text: Column) -> Column:
    """Every maker a (normalised) title names."""
    toks = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[^A-Z0-9'-]+"), "")
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(toks, maker_of_token))))


def synonym(token: Column) -> Column:
    return F.coalesce(lookup(V.TOKEN_SYNONYMS, token), token)


def _maker_words() -> dict[str, list[str]]:
    """Per maker, its own words and those of every alias."""
    out: dict[str, list[str]] = {}
    for alias, maker in V.MAKERS.items():
        out.setdefault(maker, maker.split()).extend(alias.split())
    return {maker: list(dict.fromkeys(tokens)) for maker, tokens in out.items()}


def maker_tokens(maker: Column) -> Column:
    """Every token that may prefix a set name of this maker."""
    canon = F.upper(maker)
    known = F.create_map(*[x for name, tokens in _maker_words().items() for x in (F.lit(name), lit_array(tokens))])
    return F.coalesce(F.try_element_at(known, canon), words(canon), F.array().cast("array<string>"))


def canonical_set(raw: Column, year: Column, maker: Column, season: Column | None = None) -> Column:
    """Set name without its leading season and maker words; an empty one is BASE."""
    text = F.regexp_replace(F.upper(raw), r"(?U)[^\w\s/&'-]", " ")
    text = F.regexp_replace(text, r"\b((?:18|19|20)\d{2})\s*-\s*(?:\d{4}|\d{2})\b", "$1")
    toks = words(F.regexp_replace(F.regexp_replace(text, "'", ""), "-", " "))
    season = F.lit(None).cast("string") if season is None else season.cast("string")
    years = F.array_compact(F.array(F.substring(year.cast("string"), 1, 4), F.substring(season, 1, 4)))

    def strip_prefix(given: Column) -> Column:
        def prefix(t):
            dated = t.rlike(r"^(18|19|20)\d{2}(/\d{2})?$") & (
                (F.size(given["years"]) == 0) | F.array_contains(given["years"], F.substring(t, 1, 4)))
            return F.array_contains(given["mine"], t) | dated

        first_kept = F.array_position(F.transform(given["toks"], prefix), F.lit(False)).cast("int")
        return F.when(first_kept == 0, F.array().cast("array<string>")).otherwise(F.transform(
            F.slice(given["toks"], F.greatest(first_kept, F.lit(1)), F.greatest(F.size(given["toks"]), F.lit(1))), synonym))

    kept = let(F.struct(toks.alias("toks"), years.alias("years"), maker_tokens(maker).alias("mine")), strip_prefix)

    def named(canon: Column) -> Column:
        return F.coalesce(lookup(V.PRODUCT_SYNONYMS, canon), canon)

    canon = let(F.array_join(kept, " "), named)
    for phrase, replacement in V.PHRASE_ALIASES.items():
        canon = F.regexp_replace(canon, rf"\b{phrase}\b", replacement)
    return F.when(raw.isNotNull(), F.coalesce(present(canon), F.lit(V.BASE)))


def _parallel_words(raw: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(F.upper(raw.cast("string")), r"(?U)[^\w\s-]", " "), "-", " ")
    return words(text)


def canonical_parallel(raw: Column, set_canon: Column, maker: Column) -> Column:
    """Sorted token multiset of a parallel, without set and maker words."""
    drop = F.concat(words(F.coalesce(set_canon, F.lit(""))), maker_tokens(maker))
    kept = let(F.struct(F.transform(_parallel_words(raw), synonym).alias("toks"), drop.alias("drop")),
               lambda g: F.filter(g["toks"], lambda t: ~F.array_contains(g["drop"], t)))
    return F.when(raw.isNotNull(), F.array_sort(kept))


def identity_tokens(set_canon: Column, parallel: Column, maker: Column) -> Column:
    """Distinct set and parallel tokens together, without maker words."""
    in_set = F.filter(words(F.coalesce(set_canon, F.lit(""))), lambda t: t != V.BASE)
    toks = F.transform(F.concat(in_set, _parallel_words(F.coalesce(parallel, F.lit("")))), synonym)
    return F.array_sort(F.array_except(toks, maker_tokens(maker)))


def name_tokens(*values: Column) -> Column:
    """Tokens of a person or card title."""
    joined = F.upper(F.concat_ws(" ", *values))
    return F.array_distinct(words(F.regexp_replace(
        F.regexp_replace(joined, r"(?U)[^\w\s/-]", " "), "[-/]", " ")))


def grade_parts(text: Column) -> tuple[Column, Column]:
    """A second-source grade text as (number or AUTHENTIC, qualifier)."""
    t = F.upper(text)
    number = capture(t, r"\b(10|[1-9](?:\.5)?)\b", 1)
    qualifier = capture(t, r"\b(" + "|".join(V.QUALIFIERS) + r")\b", 1)
    grade = F.coalesce(number, F.when(t.contains("AUTH"), F.lit("AUTHENTIC")))
    return grade, qualifier


# --- word roles ------------------------------------------------------------------

TRUE_PARALLEL = tuple(dict.fromkeys(
    t for phrase in V.PARALLEL_PHRASES + V.PARALLEL_COLORS for t in phrase.split()
    if t not in V.PRODUCT_WORDS))
ANY_PARALLEL_WORD = tuple(dict.fromkeys(
    t for phrase in V.PARALLEL_PHRASES + V.PARALLEL_COLORS for t in phrase.split()))
IGNORABLE = tuple(dict.fromkeys(V.LEAGUE_SPORT + V.TEAM_CITY + V.ACCOLADE + V.GENERIC))


def token_role(token: Column) -> Column:
    t = F.upper(token)
    return (F.when(t.isin(*TRUE_PARALLEL), F.lit("parallel"))
            .when(t.isin(*V.LEAGUE_SPORT), F.lit("league_sport"))
            .when(t.isin(*V.TEAM_CITY), F.lit("team_city"))
            .when(t.isin(*V.ACCOLADE), F.lit("accolade"))
            .when(t.isin(*V.GENERIC), F.lit("generic"))
            .when(t.isin(*V.MAKERS), F.lit("manufacturer"))
            .otherwise(F.lit("set_product")))


def parallel_difference(candidate: Column, comp: Column) -> tuple[Column, Column]:
    """(extra, missing) true-parallel words of a comp against a candidate.

    Team, city, league, accolade and generic words never decide.
    """
    def deciding(tokens: Column) -> Column:
        return F.transform(F.filter(tokens, lambda t: ~t.isin(*IGNORABLE)), synonym)

    def both(sides: Column) -> Column:
        def true_only(tokens: Column) -> Column:
            return F.array_sort(F.filter(tokens, lambda t: t.isin(*TRUE_PARALLEL)))
        return F.struct(true_only(F.array_except(sides["theirs"], sides["mine"])).alias("extra"),
                        true_only(F.array_except(sides["mine"], sides["theirs"])).alias("missing"))

    found = let(F.struct(deciding(candidate).alias("mine"), deciding(comp).alias("theirs")), both)
    return found["extra"], found["missing"]


def python_list_text(tokens: Column) -> Column:
    """A token array written the way reason texts print lists: ['A', 'B']."""
    return F.concat(F.lit("['"), F.array_join(tokens, "', '"), F.lit("']"))


# --- HTML ------------------------------------------------------------------------

def visible_text(html: Column) -> Column:
    """Rendered text in lower case; scripts, styles and templates are not text."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")),
                            r"(?is)<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    return F.lower(squeeze(unescape(bare)))


#: Every named character reference of the HTML standard but the ampersand, from the standard library's table.
_REFERENCES = {f"&{name}": text for name, text in html5.items() if name.endswith(";") and name not in ("amp;", "AMP;")}


def unescape(c: Column) -> Column:
    """Character references as the characters they name, by name or number; what names none stays.

    The ampersand comes last, so that what it uncovers is not read again.
    """
    names = F.str_to_map(F.lit("\u0001".join(f"{k}\u0002{v}" for k, v in _REFERENCES.items())), F.lit("\u0001"), F.lit("\u0002"))
    c = let(c, lambda text: F.aggregate(F.array_distinct(F.regexp_extract_all(text, F.lit(r"&[A-Za-z][A-Za-z0-9]*;"), F.lit(0))), text,
                                        lambda acc, ref: F.replace(acc, ref, F.coalesce(F.try_element_at(names, ref), ref))))
    c = F.replace(c, F.lit("\u00a0"), F.lit(" "))
    return F.regexp_replace(let(c, _numbered_characters), "&(amp|AMP);", "&")


def _numbered_characters(c: Column) -> Column:
    """``&#39;`` and ``&#x27;`` as the characters they name; anything else after ``&#`` stays."""
    pieces = F.split(c, "&#")

    def decoded(piece: Column) -> Column:
        code = F.regexp_extract(piece, r"^([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});", 1)
        number = F.when(F.lower(F.substring(code, 1, 1)) == "x", F.conv(F.substring(code, 2, 6), 16, 10)).otherwise(code).try_cast("int")
        named = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(F.when(named, number).otherwise(F.lit(32))), 8, "0")), "UTF-32")
        return F.when(F.coalesce(named, F.lit(False)), F.concat(character, F.regexp_replace(piece, r"^[^;]*;", ""))).otherwise(
            F.concat(F.lit("&#"), piece))

    rest = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))), decoded)
    return F.when(c.contains("&#"), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(c)


def date_range(html: Column) -> Column:
    """The date range a page shows as selected: a stated span first, then a pair of dates; else unknown."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"\s+", " ")
    return F.coalesce(*[F.nullif(F.regexp_extract(text, "(?i)" + pattern, 0), F.lit("")) for pattern in V.DATE_RANGES], F.lit("unknown"))


def page_title(html: Column) -> Column:
    return F.lower(F.trim(unescape(F.regexp_extract(
        F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title\s*>", 1))))
