"""Sold rows: gate, match to a candidate with a recorded reason, attribute, import."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from listwise import fixed_values as V
from listwise.functions import keys as K
from listwise.functions import text as T
from listwise.functions import values as N
from listwise.operators.containment import containing_pairs
from listwise.operators.joining import fenced, join_null_safe
from listwise.plans.identity import parse_titles
from listwise.session import settle, spread

CANDIDATE_FIELDS = ("item_id", "year", "manufacturer", "set", "subject", "card_number", "parallel", "print_run",
                    "psa_grade", "grade_type", "qualifier", "is_auto", "auto_grade")


def prefixed(candidates: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Candidate columns under ``c_`` so that they can sit beside a sold row."""
    return candidates.select(*[F.col(n).alias(f"c_{n}") for n in (*CANDIDATE_FIELDS, *extra)])


def _shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def _flag(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0)) != 0


def _differs(label: str, comp: Column, candidate: Column) -> Column:
    return F.concat(F.lit(f"{label} "), _shown(comp), F.lit(" != "), _shown(candidate))


def _differ(a: Column, b: Column) -> Column:
    return ~T.norm(a).eqNullSafe(T.norm(b))


def with_identity_differences(df: DataFrame) -> DataFrame:
    """``__extra`` and ``__missing`` parallel words of the comp title against the candidate.

    The candidate's own subject words are noise; the comp's name slot is not, because a
    parallel may be sitting in it.
    """
    c = F.col
    df = df.withColumns({
        "__noise": T.name_tokens(c("c_subject")),
        "__c_set": T.canonical_set(c("c_set"), c("c_year"), c("c_manufacturer")),
        "__p_set": T.canonical_set(c("p_set_name"), c("p_year"), c("p_manufacturer"))})
    candidate = T.identity_tokens(c("__c_set"), c("c_parallel"), c("c_manufacturer"))
    comp = T.identity_tokens(c("__p_set"), c("p_parallel"), c("p_manufacturer"))
    title = F.array_union(T.tokens_of(c("p_normalized")), comp)
    extra, missing = T.parallel_difference(F.array_except(candidate, c("__noise")), F.array_except(title, c("__noise")))
    return df.withColumns({"__extra": extra, "__missing": missing}).drop("__noise", "__c_set", "__p_set")


def with_match(df: DataFrame) -> DataFrame:
    """``match_code``, ``match_reason`` and ``missing_evidence`` for rows carrying ``c_`` and ``p_`` columns.

    The first failed test decides; NULL code means the title is the candidate's card.
    """
    c = F.col
    text = c("p_normalized")
    df = with_identity_differences(df).withColumns({
        "__rival": T.capture(text, V.RIVAL_GRADE, 1),
        "__grades": F.size(F.regexp_extract_all(text, F.lit(r"PSA\s*(?:10|[1-9](?:\.5)?)\b"), F.lit(0))),
        "__comp_subject": T.norm(c("p_athlete")), "__subject": T.norm(c("c_subject")),
        "__surname": F.upper(F.try_element_at(T.words(c("c_subject")), F.lit(-1))),
        "__brand": T.canonical_brand(c("c_manufacturer")), "__brands": T.brands_in(text)})
    named = (F.coalesce(T.norm(text).contains(c("__subject")), F.lit(False))
             | F.coalesce((F.length("__surname") > 2) & text.contains(c("__surname")), F.lit(False)))
    contains = c("__subject").contains(c("__comp_subject")) | c("__comp_subject").contains(c("__subject"))
    run, wanted_run = F.nullif(c("p_print_run"), F.lit(0)), F.nullif(c("c_print_run").cast("int"), F.lit(0))
    yes_no = lambda x: F.when(_flag(x), F.lit("True")).otherwise(F.lit("False"))
    tests = [(text.rlike(pattern), "disqualified", F.lit(why), False) for pattern, why in V.DISQUALIFYING]
    tests += [
        (c("__rival").isNotNull(), "rival_grader", F.concat(F.lit("graded by "), c("__rival"), F.lit(", not PSA")), False),
        (c("__grades") > 1, "lot", F.lit("lot - title describes more than one graded card"), False),
        (c("p_grade_type").isNull(), "ungraded", F.lit("raw/ungraded - no PSA grade in title"), False),
        (~c("p_grade_type").eqNullSafe(c("c_grade_type")), "grade_type",
         _differs("grade type", c("p_grade_type"), c("c_grade_type")), False),
        (_differ(c("p_grade_value"), c("c_psa_grade")), "grade", _differs("PSA grade", c("p_grade_value"), c("c_psa_grade")),
         c("p_grade_value").isNull()),
        (_differ(c("p_grade_qualifier"), c("c_qualifier")), "qualifier",
         _differs("qualifier", c("p_grade_qualifier"), c("c_qualifier")), c("p_grade_qualifier").isNull()),
        (_differ(c("p_auto_grade"), c("c_auto_grade")), "autograph_grade",
         _differs("autograph grade", c("p_auto_grade"), c("c_auto_grade")), c("p_auto_grade").isNull()),
        (_flag(c("p_is_auto")) != _flag(c("c_is_auto")), "autograph_status", F.concat(
            F.lit("autograph status differs (comp="), yes_no(c("p_is_auto")), F.lit(", candidate="),
            yes_no(c("c_is_auto")), F.lit(")")), False),
        (~c("p_year").eqNullSafe(c("c_year")), "year", _differs("year", c("p_year"), c("c_year")), c("p_year").isNull()),
        (_differ(c("p_card_number"), c("c_card_number")), "card_number",
         _differs("card number", c("p_card_number"), c("c_card_number")), c("p_card_number").isNull()),
        (~run.eqNullSafe(wanted_run), "print_run", _differs("print run", c("p_print_run"), c("c_print_run")),
         c("p_print_run").isNull()),
        (c("__comp_subject").isNotNull() & c("__subject").isNotNull() & (c("__comp_subject") != c("__subject"))
         & ~contains & ~named, "subject", _differs("subject", c("p_athlete"), c("c_subject")), False),
        (c("__subject").isNotNull() & c("__comp_subject").isNull() & ~named, "subject",
         F.concat(F.lit("subject None != "), _shown(c("c_subject"))), True),
        (c("__brand").isNotNull() & (F.size("__brands") > 0) & ~F.array_contains(c("__brands"), c("__brand")),
         "manufacturer", F.concat(F.lit("manufacturer/brand conflict - comp is "), T.python_list_text(c("__brands")),
                                  F.lit(", candidate is "), c("__brand")), False),
        (F.size("__extra") > 0, "extra_parallel", F.concat(
            F.lit("parallel/set differs - comp is "), T.python_list_text(c("__extra")), F.lit(", candidate is not")), False),
        (F.size("__missing") > 0, "missing_parallel", F.concat(
            F.lit("parallel/set differs - comp never states "), T.python_list_text(c("__missing"))), True),
    ]
    verdict = None
    for test, code, reason, absent in tests:
        absent = absent if isinstance(absent, Column) else F.lit(absent)
        found = F.struct(F.lit(code).alias("code"), reason.alias("reason"), absent.alias("absent"))
        test = F.coalesce(test, F.lit(False))
        verdict = F.when(test, found) if verdict is None else verdict.when(test, found)
    df = df.withColumn("__verdict", verdict)
    return df.withColumns({
        "match_code": c("__verdict.code"), "match_reason": c("__verdict.reason"),
        "missing_evidence": F.coalesce(c("__verdict.absent"), F.lit(False)),
        "parallel_conflict": F.when(F.size("__extra") > 0, F.concat(
            F.lit("parallel/set differs - comp is "), T.python_list_text(c("__extra")), F.lit(", candidate is not")))
    }).drop("__rival", "__extra", "__missing", "__grades", "__comp_subject", "__subject", "__surname", "__brand",
            "__brands", "__verdict")


def sale_gate(raw_text: Column, sale_format: Column, quantity_sold: Column) -> tuple[Column, Column]:
    """(sale / not_a_sale / uncertain, reason): does the row structurally show a finished sale?"""
    text = F.coalesce(raw_text, F.lit(""))
    low = F.lower(text)
    excluded, formatted = low.contains(V.EXCLUDE_MARKER), text.rlike(V.SALE_FORMAT_TEXT)
    nothing_sold = F.coalesce(F.trim(quantity_sold.cast("string")).try_cast("double") <= 0, F.lit(False))
    absent = F.concat_ws(" and ", F.when(~excluded, F.lit("Exclude listing")), F.when(~formatted, F.lit("sale format")))
    cases = [
        (nothing_sold, "not_a_sale", F.lit("quantity_sold is zero")),
        (F.coalesce(sale_format, F.lit("")) != "", "sale", F.lit("sale format recorded on the row")),
        (F.trim(text) == "", "sale", F.lit("no captured UI text to gate on")),
        (excluded & formatted, "sale", F.lit("sold-row layout: exclude marker + sale format")),
        (text.rlike(V.PAGINATION_TEXT), "uncertain", F.lit("row truncated by pagination; structure cannot be established")),
    ]
    verdict = reason = None
    for test, label, why in cases:
        verdict = F.when(test, F.lit(label)) if verdict is None else verdict.when(test, F.lit(label))
        reason = F.when(test, why) if reason is None else reason.when(test, why)
    return (verdict.otherwise(F.lit("not_a_sale")),
            reason.otherwise(F.concat(F.lit("active-listing layout; missing "), absent)))


def offer_is_unreliable(df: DataFrame) -> Column:
    """A best offer whose accepted amount is not known."""
    c = F.col
    kind = F.upper(F.coalesce(F.nullif(c("sale_type"), F.lit("")), c("sale_format"), F.lit("")))
    flagged = c("best_offer").isNotNull() & ~F.coalesce(N.falsey(c("best_offer")), F.lit(True))
    offer = kind.contains("BEST_OFFER") | kind.contains("BEST OFFER") | flagged
    unknown = c("actual_price_known").isNotNull() & F.coalesce(N.falsey(c("actual_price_known")), F.lit(True))
    no_price = c("total_price").isNull() & c("sold_price").isNull()
    struck = c("displayed_original_price").isNotNull() & c("sold_price").isNull()
    return offer & (unknown | no_price | struck)


_SOLD_DEFAULTS = {"source_item_id": "string", "raw_text": "string", "sale_type": "string", "sale_format": "string",
                  "quantity_sold": "string", "best_offer": "string", "actual_price_known": "string",
                  "total_price": "double", "sold_price": "double", "displayed_original_price": "double"}


def classify_comps(comps: DataFrame, candidates: DataFrame) -> DataFrame:
    """accepted / rejected / review_required for each sold row, with code, reason and rule.

    Rows join their candidate on its id. The cheap structural gates are decided before
    the title is read; the match itself is a projection, so the join is the only shuffle.
    """
    c = F.col
    for name, kind in _SOLD_DEFAULTS.items():
        if name not in comps.columns:
            comps = comps.withColumn(name, F.lit(None).cast(kind))
    df = comps.join(prefixed(candidates), c("candidate_item_id") == c("c_item_id"))
    recorded = F.coalesce(F.nullif(c("sale_format"), F.lit("")), F.nullif(c("sale_type"), F.lit("")))
    gate, gate_reason = sale_gate(c("raw_text"), recorded, c("quantity_sold"))
    mine = T.item_number(c("candidate_item_id"))
    # A step a column: nested, each step would evaluate the ones before it many times.
    df = df.withColumn("__hoisted", T.hoist_year(T.clean_listing_title(c("raw_title"))))
    df = df.withColumns({
        "__title": T.repair_print_run(c("__hoisted"), c("c_print_run")),
        "__gate": gate, "__gate_reason": gate_reason, "__unreliable": F.coalesce(offer_is_unreliable(comps), F.lit(False)),
        "__self": F.coalesce(mine == T.item_number(c("source_item_id")), F.lit(False))})
    df = with_match(parse_titles(df, "__title", "p_"))
    category = (F.when((c("__gate") == "not_a_sale") & c("__self"), F.lit("same_listing_duplicate"))
                .when(c("__gate") == "not_a_sale", F.lit("not_a_sale"))
                .when(c("__self"), F.lit("cancelled_or_relisted_sale"))
                .when(c("__gate") == "uncertain", F.lit("uncertain")).otherwise(F.lit("ordinary_independent_comp")))
    df = df.withColumn("evidence_category", category)
    dash = F.lit(" - ")
    same_item = F.concat(c("evidence_category"), F.lit(" - same eBay listing as the candidate (item "),
                         T.item_number(c("source_item_id")),
                         F.lit("); the card is listed again, so completion is unproven"))
    gated = F.concat(c("evidence_category"), dash, c("__gate_reason"))
    cases = [
        (c("__unreliable"), "review_required", "unreliable_offer", F.lit(V.UNRELIABLE_OFFER)),
        (c("__gate") == "not_a_sale", "rejected", "not_a_sale", gated),
        (c("__gate") == "uncertain", "review_required", "uncertain", gated),
        (c("evidence_category") == "cancelled_or_relisted_sale", "review_required", "same_item", same_item),
        (c("match_code").isNull(), "accepted", None, F.lit(None).cast("string")),
        (c("missing_evidence") & c("parallel_conflict").isNotNull(), "rejected", "extra_parallel", c("parallel_conflict")),
        (c("missing_evidence"), "review_required", c("match_code"), F.concat(c("match_reason"), F.lit(V.ABSENT_SUFFIX))),
    ]
    state = code = reason = None
    for test, label, short, why in cases:
        short = short if isinstance(short, Column) else F.lit(short).cast("string")
        state = F.when(test, F.lit(label)) if state is None else state.when(test, F.lit(label))
        code = F.when(test, short) if code is None else code.when(test, short)
        reason = F.when(test, why) if reason is None else reason.when(test, why)
    df = df.withColumns({"state": state.otherwise(F.lit("rejected")), "reason_code": code.otherwise(c("match_code")),
                         "reason": reason.otherwise(c("match_reason"))})
    df = df.withColumn("rule", T.rule_for(c("reason")))
    return df.drop(*[col for col in df.columns if col.startswith(("__", "c_"))])


_TITLE_FIELDS = ("normalized", "athlete", "year", "manufacturer", "set_name", "parallel", "print_run", "card_number", "grade_type",
                 "grade_value", "grade_qualifier", "is_auto", "auto_grade")


def _classes(candidates: DataFrame) -> DataFrame:
    """Candidates with the key of their class: those that agree in every field a match reads."""
    fields = [F.col(n) for n in CANDIDATE_FIELDS if n != "item_id"]
    return candidates.withColumn("__class", F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256))


def attribute(rows: DataFrame, candidates: DataFrame, title: str = "raw_title") -> DataFrame:
    """Which candidate each title belongs to: exactly one must accept it.

    Distinct titles are parsed and matched once, however often they were sold, and meet only
    the classes of candidates that agree on the eight fields the match requires to be equal
    (NULL equals NULL); candidates alike in every field are one class. Without an accepting
    candidate, the card ignoring grade and variety decides, again only when exactly one fits:
    subjects meet through an index of their pieces, a missing subject fits every other of its
    year and number, which is a count. Ambiguity is recorded, never resolved:
    ``ambiguous`` lists the accepting classes, each by its smallest item and its number of
    candidates; ``ambiguous_candidates`` has their members as rows.
    """
    c = F.col
    titles = parse_titles(rows.select(F.col(title).alias("__t")).distinct(), "__t", "p_")
    # Four joins below read the parsed titles; they are parsed once.
    left = settle(titles.select("__t", *[f"p_{n}" for n in _TITLE_FIELDS]))
    keyed = _classes(candidates)
    sizes = keyed.groupBy("__class").agg(F.count(F.lit(1)).alias("copies"), F.min("item_id").alias("first"))
    fields = keyed.groupBy("__class").agg(*[F.first(n).alias(n) for n in CANDIDATE_FIELDS if n != "item_id"])
    right = prefixed(fields.withColumn("item_id", c("__class")))
    block = {
        "year": (c("p_year"), c("c_year")), "number": (T.norm(c("p_card_number")), T.norm(c("c_card_number"))),
        "type": (c("p_grade_type"), c("c_grade_type")), "grade": (T.norm(c("p_grade_value")), T.norm(c("c_psa_grade"))),
        "qualifier": (T.norm(c("p_grade_qualifier")), T.norm(c("c_qualifier"))),
        "auto_grade": (T.norm(c("p_auto_grade")), T.norm(c("c_auto_grade"))),
        "auto": (_flag(c("p_is_auto")), _flag(c("c_is_auto"))),
        "run": (F.nullif(c("p_print_run"), F.lit(0)), F.nullif(c("c_print_run").cast("int"), F.lit(0))),
    }
    left = left.withColumns({f"__l_{n}": a for n, (a, _) in block.items()})
    right = right.withColumns({f"__r_{n}": b for n, (_, b) in block.items()})
    on = reduce(lambda a, b: a & b, [c(f"__l_{n}").eqNullSafe(c(f"__r_{n}")) for n in block])
    graded = left.where(c("p_grade_type").isNotNull())
    accepted = (with_match(graded.join(right, on)).where(c("match_code").isNull()).select("__t", c("c_item_id").alias("__class"))
                .join(sizes, "__class").groupBy("__t").agg(
                    F.sum("copies").alias("hits"), F.min("first").alias("hit"),
                    F.sort_array(F.collect_list(F.struct(c("first").alias("item_id"), "copies"))).alias("classes")))

    # Same card, ignoring grade and variety.
    cards = ["__year", "__number"]
    subjects = (candidates.select(c("year").alias("__year"), T.norm(c("card_number")).alias("__number"), T.norm(c("subject")).alias("__theirs"), "item_id")
                .groupBy(*cards, "__theirs").agg(F.count(F.lit(1)).alias("near_n"), F.min("item_id").alias("near_id")))
    everyone = subjects.groupBy(*cards).agg(F.sum("near_n").alias("near_n"), F.min("near_id").alias("near_id"))
    names = left.select(c("__l_year").alias("__year"), c("__l_number").alias("__number"), T.norm(c("p_athlete")).alias("__ours")).distinct()
    pairs = containing_pairs(names, subjects, cards, "__ours", "__theirs")
    fitting = join_null_safe(pairs, subjects, [*cards, "__theirs"]).select(*cards, "__ours", "near_n", "near_id")
    nameless = join_null_safe(names.where("__ours IS NOT NULL"), subjects.where("__theirs IS NULL").drop("__theirs"), cards)
    anyone = join_null_safe(names.where("__ours IS NULL"), everyone, cards)
    near = (fitting.unionByName(nameless).unionByName(anyone).groupBy(*cards, "__ours")
            .agg(F.sum("near_n").alias("near_n"), F.min("near_id").alias("near_id")))
    of_titles = left.select("__t", c("__l_year").alias("__year"), c("__l_number").alias("__number"), T.norm(c("p_athlete")).alias("__ours"))
    out = join_null_safe(of_titles, near, [*cards, "__ours"], "left").select("__t", "near_n", "near_id").join(accepted, "__t", "left")
    hits, near_n = F.coalesce(c("hits"), F.lit(0)), F.coalesce(c("near_n"), F.lit(0))
    out = out.select(
        c("__t").alias(title), F.when(hits == 1, c("hit")).when((hits == 0) & (near_n == 1), c("near_id")).alias("candidate_item_id"),
        F.when(hits > 1, F.concat(F.lit("row matches "), hits.cast("string"), F.lit(" candidates ambiguously")))
        .when((hits == 0) & (near_n != 1), F.lit("row matches no pilot candidate")).alias("attribution_error"),
        F.when(hits > 1, c("classes")).alias("ambiguous"))
    return join_null_safe(rows.drop("candidate_item_id", "attribution_error", "ambiguous"), out, [title], "left")


def ambiguous_candidates(attributed: DataFrame, candidates: DataFrame, title: str = "raw_title") -> DataFrame:
    """(title, candidate_item_id): each ambiguous title of ``attribute`` with every candidate that accepts it.

    A class of any size is rows, never a list.
    """
    c = F.col
    found = (attributed.where(c("ambiguous").isNotNull()).groupBy(title).agg(F.first("ambiguous").alias("ambiguous"))
             .select(title, F.explode("ambiguous").alias("__hit")).select(title, c("__hit.item_id").alias("__first")))
    keyed = _classes(candidates).select("__class", "item_id")
    firsts = keyed.groupBy("__class").agg(F.min("item_id").alias("__first"))
    members = keyed.join(firsts, "__class").select("__first", c("item_id").alias("candidate_item_id"))
    return found.join(members, "__first").select(title, "candidate_item_id")


def shape_sold_rows(rows: DataFrame) -> DataFrame:
    """Text columns of an import to typed sold rows; only USD gets converted amounts."""
    c = F.col
    price, ship = N.as_number(c("sold_price")), N.as_number(c("shipping"))
    currency = F.upper(F.trim(F.coalesce(F.nullif(c("currency"), F.lit("")), F.lit("USD"))))
    known = c("actual_price_known") if "actual_price_known" in rows.columns else F.lit(None).cast("string")
    offer = c("best_offer_indicator") if "best_offer_indicator" in rows.columns else F.lit(None).cast("string")
    original = c("displayed_original_price") if "displayed_original_price" in rows.columns else F.lit(None).cast("string")
    df = rows.withColumns({
        "sold_price": price, "shipping": ship, "total_price": N.comp_total(price, ship), "currency": currency,
        "sale_date": N.sale_date(c("sale_date")), "best_offer": N.truthy(offer).cast("int"),
        "actual_price_known": F.when(known.isNull() | (known == ""), F.lit(True)).otherwise(N.truthy(known)).cast("int"),
        "displayed_original_price": N.as_number(original)})
    usd = c("currency") == V.VALUATION_CURRENCY
    return df.withColumns({
        "converted_price": F.when(usd, c("sold_price")), "converted_shipping": F.when(usd, c("shipping")),
        "converted_total": F.when(usd, c("total_price"))})


def unique_sale_key(df: DataFrame) -> Column:
    """The source id, or a transaction key where the id is blank."""
    blank = F.nullif(F.trim(F.col("source_item_id").cast("string")), F.lit(""))
    return F.coalesce(blank, K.transaction_key(F.lit(None).cast("string"), F.col("raw_title"), F.col("sold_price"),
                                               F.col("shipping"), F.col("sale_date")))


def import_ledger(rows: DataFrame, candidates: DataFrame, stored: DataFrame, order: str = "item_id") -> DataFrame:
    """Prepared rows as one import: every row with its candidate, its sale key and what became of it.

    Of the rows new by (candidate, source, sale key) the first in ``order`` of their batch is
    ``added``; the others of that key, and keys already ``stored``, are ``duplicate``. Rows equal in
    ``order`` go by their other columns, and of rows equal in all of them one is added. A row
    whose title no single candidate accepts is ``unattributed`` and kept with the reason.
    """
    c, keys = F.col, ["candidate_item_id", "source", "sale_key"]
    df = attribute(shape_sold_rows(rows), candidates).withColumn("sale_key", unique_sale_key(rows))
    # Rows equal in every column are counted, marked by a copy number, and become rows again.
    place = F.struct(c(order), F.sha2(F.to_json(F.struct(*[c(n) for n in df.columns if n != "ambiguous"])), 256).alias("__row"))
    df = df.withColumn("__place", place)
    df = df.groupBy("__place").agg(F.count(F.lit(1)).alias("__copies"), *[F.first(n).alias(n) for n in df.columns if n != "__place"])
    # Read for the rows and for the first of each key: attributed once, and the driver holds a plan of one attribution at a time.
    df, stored = settle(df), settle(stored.select(*keys))
    known = stored.select(*keys, F.lit(True).alias("__stored")).distinct()
    first = df.where(c("candidate_item_id").isNotNull()).groupBy(*keys).agg(F.min("__place").alias("__first"))
    df = join_null_safe(join_null_safe(df, known, keys, "left"), first, keys, "left")
    df = df.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), c("__copies"))))
    status = (F.when(c("candidate_item_id").isNull(), "unattributed").when(c("__stored"), "duplicate")
              .when((c("__place") == c("__first")) & (c("__copy") == 1), "added").otherwise("duplicate"))
    return df.withColumn("status", status).drop("__stored", "__first", "__place", "__copies", "__copy")


def uncertain_evidence(classified: DataFrame) -> DataFrame:
    """Rows to value a second time: sales of the candidate's own, relisted item."""
    return classified.where((F.col("state") == "review_required") & (F.col("reason_code") == "same_item"))


def missing_evidence_relabel(rows: DataFrame) -> DataFrame:
    """Old rejections for absent evidence become REVIEW_REQUIRED; they stay out of valuation."""
    absent = F.coalesce((F.col("accepted") == 0) & F.col("rejection_reason").rlike(V.MISSING_EVIDENCE_TEXT), F.lit(False))
    return rows.withColumns({
        "match_confidence": F.when(absent, F.lit("REVIEW_REQUIRED")).otherwise(F.col("match_confidence")),
        "rejection_reason": F.when(absent, F.concat(F.col("rejection_reason"), F.lit(V.ABSENT_SUFFIX)))
        .otherwise(F.col("rejection_reason"))})


def year_disagreement(candidates: DataFrame, classified: DataFrame) -> DataFrame:
    """Candidates whose year-only rejections near-unanimously name one other year.

    A diagnostic: nothing is rewritten. The most frequent year wins, the lowest on a tie.
    """
    c = F.col
    accepted = classified.where("state = 'accepted'").select("candidate_item_id").distinct()
    years = (classified.where((c("reason_code") == "year") & c("p_year").isNotNull())
             .groupBy("candidate_item_id", "p_year").agg(F.count(F.lit(1)).alias("n")))
    top = years.groupBy("candidate_item_id").agg(F.max(F.struct(c("n"), (-c("p_year")).alias("neg"))).alias("top"),
                                                 F.sum("n").alias("total"))
    df = top.join(accepted, "candidate_item_id", "left_anti").join(
        candidates.select(c("item_id").alias("candidate_item_id"), c("year").alias("candidate_year")), "candidate_item_id")
    df = df.select("candidate_item_id", "candidate_year", (-c("top.neg")).alias("observed_year"),
                   c("top.n").alias("supporting_comps"), "total")
    return df.where((c("supporting_comps") >= V.MIN_DISAGREEING_COMPS)
                    & (c("supporting_comps") / c("total") >= V.MIN_DISAGREEMENT_SHARE)
                    & c("candidate_year").isNotNull() & (c("observed_year") != c("candidate_year"))).withColumn(
        "flag", F.lit(V.YEAR_DISAGREEMENT)).drop("total")


# --- research queries ------------------------------------------------------------------

def query_text(strict: bool = True) -> Column:
    """Search words from the effective identity, without any price."""
    c = F.col
    number = F.concat(F.lit("#" if strict else ""), c("card_number"))
    parts = F.concat_ws(
        " ", c("year").cast("string"), c("subject"), c("manufacturer"),
        F.when(c("set") != V.BASE, c("set")), number, c("parallel"),
        F.when(F.coalesce(c("print_run"), F.lit(0)) != 0, F.concat(F.lit("/"), c("print_run").cast("string"))),
        F.when(_flag(c("is_auto")), F.lit("auto")), F.concat(F.lit("auto "), c("auto_grade")),
        F.concat(F.lit("PSA "), c("psa_grade")), c("qualifier"))
    return T.squeeze(parts)


def query_violations(query: Column) -> Column:
    """Identity facts a query fails to state; empty means it may be sent."""
    c = F.col
    text = T.normalize(query)

    def states(*forms: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(text.contains(T.normalize(f)), F.lit(False)) for f in forms])

    aliases = F.exists(T.maker_tokens(c("manufacturer")), lambda t: text.contains(T.normalize(t)))
    has_set = c("set").isNotNull() & (c("set") != V.BASE)
    facts = {
        "year": (c("year").isNotNull(), states(c("year").cast("string"))),
        "subject": (c("subject").isNotNull(), states(F.try_element_at(T.words(c("subject")), F.lit(-1)))),
        "card_number": (c("card_number").isNotNull(), states(c("card_number"))),
        "grade": (c("psa_grade").isNotNull(), states(F.concat(F.lit("PSA "), c("psa_grade")))),
        "manufacturer_or_set": (c("manufacturer").isNotNull() | has_set,
                                states(c("manufacturer"), F.when(has_set, c("set"))) | F.coalesce(aliases, F.lit(False))),
        "parallel": (c("parallel").isNotNull(), states(c("parallel"))),
        "print_run": (F.coalesce(c("print_run"), F.lit(0)) != 0, states(c("print_run").cast("string"))),
        "auto_status": (_flag(c("is_auto")), states(F.lit("auto"))),
        "auto_grade": (c("auto_grade").isNotNull(), states(F.concat(F.lit("auto "), c("auto_grade")))),
        "qualifier": (c("qualifier").isNotNull(), states(c("qualifier"))),
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(known, F.lit(False)) & ~said, F.lit(name))
                                     for name, (known, said) in facts.items()]))


def research_queries(candidates: DataFrame) -> DataFrame:
    """One safe query per candidate, the violations of an unsafe one, and what must match."""
    c = F.col
    df = spread(candidates).withColumn("search_query", T.dedupe_query(query_text()))
    df = df.withColumn("violations", F.array_join(query_violations(c("search_query")), "|"))
    # A filter on what may be sent would otherwise write the query text anew for every fact it looks for.
    df = fenced(df, candidates.columns, {n: c(n) for n in ("search_query", "violations")})
    run, auto = F.coalesce(c("print_run"), F.lit(0)) != 0, _flag(c("is_auto"))
    must = F.concat_ws("|", F.lit("subject|year|card_number|psa_grade|parallel|autograph_status"),
                       F.when(run, "print_run"), F.when(c("qualifier").isNotNull(), "qualifier"),
                       F.when(c("auto_grade").isNotNull(), "autograph_grade"))
    never = F.concat_ws("|", F.lit("card_number|psa_grade"), F.when(run, "print_run"),
                        F.when(c("parallel").isNotNull() & (c("parallel") != V.BASE), "parallel"),
                        F.when(auto | c("auto_grade").isNotNull(), "autograph_status"),
                        F.when(c("qualifier").isNotNull(), "qualifier"))
    return df.withColumns({"sendable": c("violations") == "", "fields_that_must_match": must,
                           "fields_that_must_not_be_relaxed": never, "relaxed_allowed": relaxed_allowed(), "query_tier": F.lit("STRICT")})


def query_token_sources(queries: DataFrame) -> DataFrame:
    """Which identity field explains each term of a query."""
    c = F.col
    df = queries.select("item_id", "year", "subject", "manufacturer", "set", "psa_grade", "parallel",
                        F.posexplode(T.words(c("search_query"))).alias("position", "term"))
    up = F.upper(c("term"))
    within = lambda name: F.coalesce(F.upper(c(name)).contains(up), F.lit(False))
    source = (F.when(up == c("year").cast("string"), "candidate.year").when(within("subject"), "candidate.subject")
              .when(within("manufacturer"), "candidate.manufacturer").when(within("set"), "candidate.set")
              .when(c("term").startswith("#"), "candidate.card_number").when(c("term").startswith("/"), "candidate.print_run")
              .when(up == "AUTO", "candidate.is_auto").when((up == "PSA") | (up == c("psa_grade")), "candidate.psa_grade")
              .when(within("parallel"), "candidate.parallel").otherwise("unattributed"))
    return df.select("item_id", "position", "term", source.alias("source"))


def relaxed_allowed() -> Column:
    """Whether a looser query could drop the parallel: only when nothing else distinguishes the card."""
    c = F.col
    plain = (F.coalesce(c("print_run"), F.lit(0)) == 0) & ~_flag(c("is_auto")) & c("auto_grade").isNull() & c("qualifier").isNull()
    return plain & (c("parallel").isNull() | (c("parallel") == V.BASE))


def pending_work(candidates: DataFrame, runs: DataFrame, terminal: tuple[str, ...], retry_failed: bool = False,
                 failed: tuple[str, ...] = ("failed",), item: str = "item_id") -> DataFrame:
    """Candidates without a finished run; failed runs come back only on request."""
    done = runs.where(F.col("status").isin(*terminal))
    if retry_failed:
        done = done.where(~F.col("status").isin(*failed))
    return candidates.join(done.select(F.col("candidate_id").alias(item)), item, "left_anti")


def reusable_comps(comps: DataFrame, identities: DataFrame, key: str = "eff_slab") -> DataFrame:
    """Accepted comps of an identity through their candidate's key; a NULL key matches nothing."""
    keyed = identities.where(F.col(key).isNotNull()).select(F.col("item_id").alias("candidate_item_id"), key)
    return comps.where("state = 'accepted'").join(keyed, "candidate_item_id")
