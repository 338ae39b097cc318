"""Structured identity from free-text titles, as one projection per row.

Everything is a column expression, so the job is a scan plus generated code: no
shuffle, no UDF. What a title does not state stays NULL with an issue beside it.
"""

from pyspark.sql import Column, DataFrame, functions as F

from listwise import fixed_values as V
from listwise.functions import keys as K
from listwise.functions import text as T
from listwise.operators.joining import fenced

FIELDS = ("sport", "year", "year_raw", "manufacturer", "set_name", "insert_name", "parallel", "athlete",
          "card_number", "is_rookie", "is_auto", "is_relic", "serial_num", "print_run", "grade_type",
          "grade_value", "grade_qualifier", "auto_grade", "grade_raw", "truncation_risk")
CONFIDENCES = ("sport", "year", "manufacturer", "set_name", "insert_name", "parallel", "athlete",
               "card_number", "grade")
_PARALLEL_ORDER = V.PARALLEL_COLORS + V.PARALLEL_PHRASES
_PARALLEL_REGEX = T.phrase_regex(V.PARALLEL_PHRASES + V.PARALLEL_COLORS)
_SPORT_ORDER = [token for token, _ in V.SPORT_TOKENS]
_SPORT_REGEX = r" (" + T.phrase_trie(_SPORT_ORDER) + r")(?=[ -])"
# A slash pair that is neither a hashed number nor a grade standing over a year.
_SERIAL_PAIR = (r"(?=\d)(?<![\d/.#])(?!(?<=PSA\s{0,9})\d{1,4}\s*/\s*(?:19|20)\d\d(?!\d))"
                r"(\d{1,4})\s*/\s*(\d{1,5})(?![\d/])")

# The first word that is no name, whatever marks stand around it: a stop token, anything led by the grader, digits.
_NAME_STOP = r"(?:^| )[.,']*(?:PSA|(?:" + T.phrase_trie(V.NAME_STOP_TOKENS) + r"|[\d/]+)[.,']*(?= |$))"


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _pairs(text: Column, pattern: str) -> Column:
    """Every n/m match as (whole, num, den, num_text), in reading order; most titles hold no slash and are not searched."""
    zipped = F.arrays_zip(_all(text, pattern, 0).alias("whole"), _all(text, pattern, 1).alias("num"),
                          _all(text, pattern, 2).alias("den"))
    return F.when(text.contains("/"), F.transform(zipped, lambda p: F.struct(
        p["whole"].alias("whole"), p["num"].cast("int").alias("num"), p["den"].cast("int").alias("den"),
        p["num"].alias("num_text"))))


def serial_pair(text: Column) -> Column:
    """First copy-number/print-run pair: the copy cannot exceed the run."""
    return F.when(text.rlike(_SERIAL_PAIR), F.get(F.filter(_pairs(text, _SERIAL_PAIR), lambda p: p["num"] <= p["den"]), F.lit(0)))


def serial_stamp(text: Column) -> Column:
    """First "#N/M" that is a stamp, not a card number.

    A zero-padded one counts only when another hash states the card number.
    """
    others = F.size(_all(text, V.OTHER_CARD_NUMBER, 0)) >= 2
    stamped = F.filter(_pairs(text, V.SERIAL_STAMP), lambda p: p["num"] <= p["den"])
    first = F.get(F.filter(stamped, lambda p: ~p["num_text"].startswith("0") | others), F.lit(0))
    return F.when(text.rlike(V.SERIAL_STAMP), first)


def extract_parallel(span: Column) -> tuple[Column, Column]:
    """(parallel terms in rank order or NULL, the span without them)."""
    hits = _all(span, _PARALLEL_REGEX, 1)
    ordered = F.array_join(F.array_intersect(T.lit_array(_PARALLEL_ORDER), hits), " ")
    return F.nullif(ordered, F.lit("")), T.squeeze(F.regexp_replace(span, _PARALLEL_REGEX, " "))


def _first_end(text: Column, pattern: str) -> Column:
    """One past the end of the first match; 1 when there is none."""
    return F.length(F.regexp_extract(text, "(?s)^.*?" + pattern, 0)) + 1


def _outside(text: Column, rival: Column) -> Column:
    graded = text.contains("PSA")
    return (F.when(rival.isNotNull() & ~graded, rival)
            .when(rival.isNotNull(), F.concat(F.lit("AMBIGUOUS PSA+"), rival))
            .when(~graded, F.lit("NO GRADER")))


def classify_population(title: Column) -> Column:
    """NULL for the graded population, else why the title is outside it."""
    read = lambda text: F.struct(text.alias("text"), T.capture(text, V.RIVAL_GRADE, 1).alias("rival"))
    return T.let(T.let(T.normalize(title), read), lambda g: _outside(g["text"], g["rival"]))


def _issue(field: str, reason: Column) -> Column:
    return F.when(reason.isNotNull(), F.struct(F.lit(field).alias("field"), reason.alias("reason")))


def parse_titles(df: DataFrame, title: str = "title", prefix: str = "", outside: bool = False) -> DataFrame:
    """``df`` with one column per field, ``<field>_conf`` levels and an ``issues`` array.

    ``prefix`` names the outputs apart when a row carries more than one title; ``outside``
    adds ``excluded``, why a title is outside the graded population.
    """
    c = F.col
    given = df.columns
    # What several expressions read is a column first: an expression named twice is evaluated twice.
    df = df.withColumn("_text", T.normalize(F.coalesce(c(title), F.lit(""))))
    text = c("_text")
    graded_at = r"PSA\s*(?:10|[1-9](?:\.5)?)(?![\d.])"
    df = df.withColumns({
        "_graded": F.regexp_extract(text, r"(?s)^.*" + graded_at, 0),
        "_authentic": F.when(text.contains("AUTH"), T.capture(text, V.GRADE_AUTHENTIC, 1)),
        "_qualified": F.regexp_extract(text, V.GRADE_QUALIFIER, 0),
        "_auto_value": F.when(text.contains("AUTO"), T.capture(text, V.AUTO_GRADE, 1)),
        "_year_raw": T.capture(text, V.YEAR_LEAD, 1), "_sports": _all(F.concat(F.lit(" "), text, F.lit(" ")), _SPORT_REGEX, 1),
        "_serial": F.when(text.contains("/"), serial_pair(text)), "_stamp": F.when(text.contains("/") & text.contains("#"), serial_stamp(text)),
        "_declared": F.when(text.rlike(r"#\s*/"), T.capture(text, V.PRINT_RUN, 1).cast("int")),
        "_risk": ((F.length(F.coalesce(c(title), F.lit(""))) >= V.TITLE_RISK_LENGTH)
                  | text.endswith("PSA")).cast("int")})
    numeric, authentic = c("_graded") != "", c("_authentic").isNotNull()
    # The last mention of the grader begins the grade that ends this text.
    last_grade = F.substring_index(c("_graded"), "PSA", -1)
    grade_from = F.length(c("_graded")) - F.length(last_grade) - 2
    df = df.withColumns({
        "_sport": F.when(F.size(c("_sports")) > 0, T.lookup(dict(V.SPORT_TOKENS), F.get(
            F.array_intersect(T.lit_array(_SPORT_ORDER), c("_sports")), F.lit(0)))),
        "_qualifier": F.when(c("_qualified") != "", F.regexp_extract(c("_qualified"), r"(" + "|".join(V.QUALIFIERS) + r")\s*\)?$", 1)),
        "_auto_grade": F.when(c("_auto_value").isin("AUTHENTIC", "AUTH"), F.lit("AUTHENTIC")).otherwise(c("_auto_value")),
        "_seen": F.coalesce(c("_stamp"), c("_serial"))})
    seen = c("_seen")
    grade_to = F.greatest(
        F.length(c("_graded")) + 1,
        F.when(c("_auto_grade").isNotNull(), _first_end(text, V.AUTO_GRADE)),
        F.when(c("_auto_grade").isNull() & c("_qualifier").isNotNull(), _first_end(text, V.GRADE_QUALIFIER)))
    auth_from = F.regexp_instr(text, F.lit(V.GRADE_AUTHENTIC))
    auth_to = F.when(c("_auto_grade").isNotNull(), _first_end(text, V.AUTO_GRADE)).otherwise(
        _first_end(text, V.GRADE_AUTHENTIC))
    df = df.withColumns({
        "_grade_type": F.when(numeric, F.lit("NUMERIC")).when(authentic, F.lit("AUTHENTIC")),
        "_grade_value": F.when(numeric, F.trim(last_grade)).when(
            authentic, F.when(c("_authentic").contains("ALTERED"), F.lit("AUTHENTIC ALTERED"))
            .otherwise(F.lit("AUTHENTIC"))),
        "_grade_raw": F.when(numeric, text.substr(grade_from, grade_to - grade_from)).when(
            authentic, text.substr(auth_from, auth_to - auth_from)),
        "_serial_num": seen["num"], "_run_seen": seen["den"],
        "_run": F.coalesce(c("_declared"), seen["den"]),
        "_run_conflict": F.coalesce((seen["den"] != c("_declared")), F.lit(False)),
        "_tokens": T.plain_words(F.when(c("_year_raw").isNull(), text).otherwise(
            text.substr(F.length(c("_year_raw")) + 1, F.length(text))))})
    df = df.withColumn("_head", F.get(c("_tokens"), F.lit(0)))
    df = df.withColumns({"_named": T.lookup(V.MAKERS, c("_head")), "_implied": T.lookup(V.PRODUCT_LINE_MAKER, c("_head"))})
    skip = F.when(c("_named").isNull(), 1).when(
        c("_head").isin(*V.TWO_WORD_MAKER_HEADS) & (F.size(c("_tokens")) > 1), 3).otherwise(2)
    df = df.withColumn("_rest", F.array_join(F.slice(c("_tokens"), skip, F.greatest(
        F.size(c("_tokens")), F.lit(1))), " "))
    # A hash stamp is blanked so that its numerator is never read as the card number.
    df = df.withColumn("_blank", F.when(c("_rest").contains("/") & c("_rest").contains("#"), serial_stamp(c("_rest"))["whole"]))
    df = df.withColumn("_rest", F.when(c("_blank").isNull(), c("_rest")).otherwise(
        F.replace(c("_rest"), c("_blank"), F.rpad(F.lit(""), 12, " "))))
    cuts = {"_cut_grade": V.GRADE_NUMERIC, "_cut_authentic": V.GRADE_AUTHENTIC, "_cut_run": V.PRINT_RUN}
    df = df.withColumns({**{name: F.regexp_instr(c("_rest"), F.lit(pattern)) for name, pattern in cuts.items()},
                         "_pair": F.when(c("_rest").contains("/"), serial_pair(c("_rest"))["whole"])})
    df = df.withColumn("_cut_pair", F.when(c("_pair").isNotNull(), F.position(c("_pair"), c("_rest"))))
    df = df.withColumn("_cut", F.least(*[F.when(c(name) > 0, c(name)) for name in (*cuts, "_cut_pair")]))
    df = df.withColumn("_core", F.trim(F.when(c("_cut").isNull(), c("_rest")).otherwise(
        c("_rest").substr(F.lit(1), c("_cut") - 1))))
    df = df.withColumns({"_number_at": F.regexp_instr(c("_core"), F.lit(V.CARD_NUMBER)),
                         "_number_text": F.regexp_extract(c("_core"), V.CARD_NUMBER, 0)})
    numbered = c("_number_at") > 0
    df = df.withColumns({
        "_number": F.when(numbered, F.regexp_replace(
            F.regexp_extract(c("_number_text"), V.CARD_NUMBER, 1), r"[./\-]+$", "")),
        "_span": F.trim(F.when(numbered, c("_core").substr(F.lit(1), c("_number_at") - 1)).otherwise(c("_core"))),
        "_tail": F.when(numbered, F.trim(c("_core").substr(
            c("_number_at") + F.length(c("_number_text")), F.length(c("_core")))))})
    df = df.withColumns({"_parallels": _all(c("_span"), _PARALLEL_REGEX, 1), "_stop_at": F.regexp_instr(c("_tail"), F.lit(_NAME_STOP))})
    df = df.withColumns({
        "_parallel": F.when(F.size(c("_parallels")) > 0, F.array_join(F.array_intersect(
            T.lit_array(_PARALLEL_ORDER), c("_parallels")), " ")),
        "_remainder": F.when(F.size(c("_parallels")) > 0, F.regexp_replace(c("_span"), _PARALLEL_REGEX, " ")).otherwise(c("_span")),
        "_name": F.when(c("_stop_at") == 0, c("_tail")).otherwise(c("_tail").substr(F.lit(1), c("_stop_at") - 1))})
    df = df.withColumns({
        "_set_words": F.array_distinct(T.plain_words(F.regexp_replace(c("_remainder"), r"^[ \-,]+|[ \-,]+$", ""))),
        "_name": F.regexp_replace(F.array_join(T.plain_words(c("_name")), " "), r"^[\-,'. ]+|[\-,'. ]+$", "")})
    df = df.withColumn("_set", F.array_join(c("_set_words"), " "))
    df = df.withColumn("_hints", _all(c("_set"), T.phrase_regex(V.INSERT_HINTS), 1))
    df = df.withColumns({
        "_athlete": F.when(c("_name") != "", c("_name")),
        "_insert": F.when(F.size(c("_hints")) > 0, F.array_join(F.array_intersect(T.lit_array(V.INSERT_HINTS), c("_hints")), " ")),
        "_maker": F.coalesce(c("_named"), c("_implied"))})

    has_set = c("_set") != ""
    levels = {
        "sport": F.when(c("_sport").isNotNull(), "HIGH").otherwise("MISSING"),
        "year": F.when(c("_year_raw").isNotNull(), "HIGH").otherwise("MISSING"),
        "manufacturer": F.when(c("_named").isNotNull(), "HIGH").when(c("_implied").isNotNull(), "MEDIUM")
        .when(c("_head").isNotNull(), "LOW").otherwise("MISSING"),
        "grade": F.when(c("_grade_type").isNotNull(), "HIGH").otherwise("MISSING"),
        "card_number": F.when(c("_run_conflict"), "LOW").when(c("_number").isNull(), "MISSING")
        .when(c("_number").contains("/"), "LOW").otherwise("HIGH"),
        "parallel": F.when(c("_parallel").isNotNull(), "HIGH").when(
            F.size(c("_set_words")) >= 5, "LOW").otherwise("MEDIUM"),
        "insert_name": F.when(c("_insert").isNotNull(), "LOW").otherwise("MISSING"),
        "athlete": F.when(c("_athlete").isNotNull(), "MEDIUM").otherwise("MISSING"),
    }
    levels["set_name"] = (F.when(has_set, F.when(c("_head").isNotNull() & c("_maker").isNull(), "LOW")
                                 .otherwise("MEDIUM"))
                          .when(c("_maker").isNotNull(), "MEDIUM").otherwise("MISSING"))
    df = df.withColumns({f"_{name}_conf": level for name, level in levels.items()})
    quoted = lambda x: F.concat(F.lit("'"), x, F.lit("'"))
    issues = [
        _issue("grade", F.when(c("_grade_type").isNull(), F.when(
            text.rlike(r"PSA[\s/]*DNA"), F.lit("PSA/DNA autograph authentication, not a card grade"))
            .when(c("_risk") == 1, F.lit("grade absent - title truncated at eBay's 80-char limit"))
            .otherwise(F.lit("no PSA grade token found")))),
        _issue("year", F.when(c("_year_raw").isNull(), F.lit("no leading 4-digit year"))),
        _issue("print_run", F.when(c("_run_conflict"), F.concat(
            F.lit("conflicting print runs: serial says /"), c("_run_seen").cast("string"),
            F.lit(", '#/' says /"), c("_declared").cast("string")))),
        _issue("manufacturer", F.when(c("_maker").isNull() & c("_head").isNotNull(), F.concat(
            F.lit("unrecognized leading token "), quoted(c("_head"))))),
        _issue("card_number", F.when(c("_number").isNull(), F.lit("no '#' card number in title")).when(
            c("_number").contains("/"), F.concat(F.lit("card number "), quoted(c("_number")),
                                                 F.lit(" contains '/' - may be a serial")))),
        _issue("parallel", F.when(c("_parallel_conf") == "LOW", F.concat(
            F.lit("no known parallel term in long set span "), quoted(c("_set"))))),
        _issue("set_name", F.when(~has_set & c("_maker").isNull(),
                                  F.lit("empty set span and unknown manufacturer"))),
        _issue("athlete", F.when(c("_tail").isNull(), F.lit("no card number to anchor the athlete name")).when(
            c("_athlete").isNull(), F.lit("could not isolate an athlete name"))),
    ]
    graded = c("_grade_type").isNotNull()
    outputs = {
        "sport": c("_sport"), "year": F.substring(c("_year_raw"), 1, 4).cast("int"), "year_raw": c("_year_raw"),
        "manufacturer": c("_maker"),
        "set_name": F.when(has_set, c("_set")).when(c("_maker").isNotNull(), F.lit(V.BASE)),
        "insert_name": c("_insert"), "parallel": c("_parallel"), "athlete": c("_athlete"),
        "card_number": c("_number"), "is_rookie": text.rlike(V.ROOKIE).cast("int"),
        "is_auto": text.rlike(V.AUTO).cast("int"), "is_relic": text.rlike(V.RELIC).cast("int"),
        "serial_num": c("_serial_num"), "print_run": c("_run"), "grade_type": c("_grade_type"),
        "grade_value": c("_grade_value"), "grade_qualifier": F.when(graded, c("_qualifier")),
        "auto_grade": c("_auto_grade"), "grade_raw": c("_grade_raw"), "truncation_risk": c("_risk"),
        **{f"{name}_conf": c(f"_{name}_conf") for name in CONFIDENCES},
        "issues": F.array_compact(F.array(*issues)), "normalized": text,
    }
    if outside:
        df = df.withColumn("_rival", T.capture(text, V.RIVAL_GRADE, 1))
        outputs["excluded"] = _outside(text, c("_rival"))
    kept = [col for col in given if col not in {prefix + name for name in outputs}]
    return fenced(df, kept, {prefix + name: value for name, value in outputs.items()})


def _rank(level: Column) -> Column:
    return T.lookup(V.LEVELS, level).cast("int")


def identity_confidence(prefix: str = "") -> Column:
    """The weakest of the identity-critical levels."""
    worst = F.least(*[_rank(F.col(f"{prefix}{f}_conf")) for f in V.IDENTITY_FIELDS])
    return T.lookup({rank: level for level, rank in V.LEVELS.items()}, worst.cast("string"))


def parse_status(identity: Column, issues: Column) -> Column:
    usable = identity.isin("MEDIUM", "HIGH")
    return (F.when(usable & (F.size(issues) == 0), F.lit("ok")).when(usable, F.lit("partial"))
            .otherwise(F.lit("failed")))


def with_keys(df: DataFrame) -> DataFrame:
    """Card and slab keys from the field columns."""
    df = df.withColumn("card_key", K.card_key(df))
    return df.withColumn("slab_key", K.slab_key(F.col("card_key"), df))


def extract_identity(df: DataFrame, title: str = "title") -> DataFrame:
    """Fields, levels, issues, status and keys of every title, with ``excluded`` set
    for titles outside the graded population (their identity columns still show what
    the title said, and ``graded`` jobs filter on ``excluded IS NULL``)."""
    df = parse_titles(df, title, outside=True)
    df = df.withColumn("identity_conf", identity_confidence())
    df = df.withColumn("parse_status", parse_status(F.col("identity_conf"), F.col("issues")))
    return with_keys(df)


def cards(identity: DataFrame) -> DataFrame:
    return identity.where(F.col("excluded").isNull())


def issue_table(identity: DataFrame, item: str = "item_id", title: str = "title") -> DataFrame:
    """One row per (item, field, reason); an excluded title has the exclusion only."""
    excluded = F.array(F.struct(F.lit("excluded").alias("field"), F.col("excluded").alias("reason")))
    rows = F.when(F.col("excluded").isNotNull(), excluded).otherwise(F.col("issues"))
    return identity.select(item, title, F.explode(rows).alias("i")).select(
        item, title, F.col("i.field").alias("field"), F.col("i.reason").alias("reason"))


def eligible(df: DataFrame) -> Column:
    return df["identity_conf"].isin("MEDIUM", "HIGH") & (df["grade_type"] == "NUMERIC")


def identity_coverage(parsed: DataFrame) -> DataFrame:
    """Per field: rows, rows with a value and rows per level, in one aggregation."""
    parts = [F.struct(F.lit(f).alias("field"), F.col("grade_value" if f == "grade" else f).isNotNull().alias("has"),
                      F.col(f"{f}_conf").alias("level")) for f in CONFIDENCES]
    rows = parsed.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
    return rows.groupBy("field").agg(
        F.count(F.lit(1)).alias("listings"), F.count_if("has").alias("filled"),
        *[F.count_if(F.col("level") == level).alias(level.lower()) for level in V.LEVELS])


def grader_reconciliation(listings: DataFrame, title: str = "title") -> DataFrame:
    """Listings by what the earlier rule (leftmost grader word) and the current rule say."""
    text = T.normalize(F.col(title))
    earlier = T.capture(text, r"\b(" + "|".join(V.EARLIER_RULE_GRADERS) + r")\b", 1)
    return (listings.select(F.coalesce(earlier, F.lit("NONE")).alias("earlier_rule"),
                            F.coalesce(classify_population(F.col(title)), F.lit("PSA")).alias("current_rule"))
            .groupBy("earlier_rule", "current_rule").agg(F.count(F.lit(1)).alias("listings")))


def token_role_counts(tokens: DataFrame, token: str = "token") -> DataFrame:
    """Distinct tokens with their role; counted before the role is looked up."""
    return (tokens.groupBy(token).agg(F.count(F.lit(1)).alias("titles"))
            .withColumn("role", T.token_role(F.col(token))))


def name_vocabulary(cards: DataFrame, athlete: str = "athlete") -> DataFrame:
    """Distinct name words longer than two letters seen in the subject column."""
    return (cards.where(F.col(athlete).isNotNull())
            .select(F.explode(T.words(F.upper(F.col(athlete)))).alias("name"))
            .where(F.length("name") > 2).distinct())
