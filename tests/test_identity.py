"""Golden titles, keys, second-source cases and sold-title matching."""

import re

from pyspark.sql import functions as F

from listwise.functions import keys as K
from listwise.functions import text as T
from listwise.functions import values as N
from listwise.plans import evidence as E
from listwise.plans import identity as I
from listwise.plans import reconcile as R
from listwise.plans import tolerant as L


def read(spark, titles):
    df = spark.createDataFrame(list(enumerate(titles)), "i int, title string")
    return {r.title: r for r in I.extract_identity(df).collect()}


GOLDEN = [
    ("2018 PANINI PRIZM GOLD #12 LUKA DONCIC ROOKIE 7/10 PSA 10",
     {"year": 2018, "manufacturer": "PANINI", "set_name": "PRIZM", "parallel": "GOLD", "card_number": "12",
      "athlete": "LUKA DONCIC", "is_rookie": 1, "serial_num": 7, "print_run": 10, "grade_value": "10", "parse_status": "ok"}),
    ("1975 TOPPS #370 TOM SEAVER PSA 8.5", {"set_name": "BASE", "grade_value": "8.5", "parallel": None}),
    ("2020-21 UPPER DECK SERIES ONE #201 ALEXIS LAFRENIERE PSA 9 AUTO 10",
     {"year": 2020, "year_raw": "2020-21", "manufacturer": "UPPER DECK", "set_name": "SERIES ONE", "grade_value": "9",
      "auto_grade": "10", "is_auto": 1}),
    ("1980 TOPPS #482 RICKEY HENDERSON PSA 8 NM-MT (OC)", {"grade_value": "8", "grade_qualifier": "OC"}),
    ("1980 TOPPS #482 RICKEY HENDERSON PSA 8 (ST. LOUIS CARDINALS)", {"grade_qualifier": None}),
    ("1952 BOWMAN #1 YOGI BERRA PSA AUTHENTIC ALTERED", {"grade_type": "AUTHENTIC", "grade_value": "AUTHENTIC ALTERED"}),
    ("1996TOPPS FINEST #3 A PLAYER PSA 9", {"year": 1996, "manufacturer": "TOPPS", "set_name": "FINEST"}),
    ("1993 FINEST #199 A PLAYER REFRACTOR PSA 9", {"manufacturer": "TOPPS", "manufacturer_conf": "MEDIUM"}),
    ("2011 BOWMAN CHROME #151 MIKE TROUT #/50 PSA 9", {"serial_num": None, "print_run": 50, "card_number": "151"}),
    ("2011 BOWMAN CHROME #151 MIKE TROUT #429/500 PSA 9", {"serial_num": 429, "print_run": 500, "card_number": "151"}),
    ("2022 TOPPS #073/150 HYDREIGON PSA 9", {"serial_num": None, "card_number": "073/150", "card_number_conf": "LOW"}),
    ("2011 BOWMAN #1 A B 12/50 #/25 PSA 9", {"print_run": 25, "card_number_conf": "LOW", "parse_status": "failed"}),
    ("1991 FLEER #29 MICHAEL JORDAN PSA 8 / 1991 FLEER", {"serial_num": None, "print_run": None}),
    ("2018 PANINI PRIZM LUKA DONCIC PSA 10", {"card_number": None, "athlete": None, "parse_status": "failed"}),
    ("2019 PANINI DRAFT PICKS SILVER #5 José Peña RC PSA 9",
     {"athlete": "JOSE PENA", "insert_name": "DRAFT PICKS", "set_name": "DRAFT PICKS", "parallel": "SILVER"}),
    ("2021 PANINI MONEY SHIMMER GOLD #5 A B PSA 9", {"parallel": "GOLD MONEY SHIMMER"}),
    ("2020 PANINI PRIZM WNBA #8 A B PSA 10", {"sport": "BASKETBALL"}),
    ("2018 PANINI #1 A B BGS 9.5", {"excluded": "BGS"}),
    ("2018 PANINI #1 A B PSA 9 BGS 9.5", {"excluded": "AMBIGUOUS PSA+BGS"}),
    ("2018 PANINI MATERIAL-TAG #1 A B PSA 9", {"excluded": None}),
    ("2018 PANINI #1 A B", {"excluded": "NO GRADER"}),
]


def test_golden_titles(spark):
    got = read(spark, [t for t, _ in GOLDEN])
    for title, expected in GOLDEN:
        row = got[title].asDict()
        assert {k: row[k] for k in expected} == expected, title


def test_keys_equal_and_different(spark):
    a = "2018 UD SERIES ONE #5 A PLAYER PSA 9"
    got = read(spark, [a, a.replace("UD", "UPPER DECK"), a.replace("PSA 9", "PSA 10"), a.replace("PSA 9", "3/50 PSA 9"),
                       a.replace("PSA 9", "4/50 PSA 9"), a.replace("PSA 9", "PSA 9 (MC)")])
    alias, grade, third, fourth, miscut = list(got.values())[1:]
    base = got[a]
    assert (alias.card_key, alias.slab_key) == (base.card_key, base.slab_key)
    assert grade.card_key == base.card_key and grade.slab_key != base.slab_key
    assert third.slab_key == fourth.slab_key != base.slab_key
    assert miscut.card_key == base.card_key and miscut.slab_key != base.slab_key


def test_filters_above_identity_stay_cheap(spark):
    df = spark.createDataFrame([(1, "2018 PANINI PRIZM #1 A B PSA 9")], "i int, title string")
    cards = I.extract_identity(df)
    joined = cards.where("athlete = 'A B' AND parse_status = 'ok'").join(cards.select("slab_key").distinct(), "slab_key")
    assert joined.count() == 1


LAYOUTS = [
    ("Cortez Kennedy Auto Signed 1990 Topps #514 PSA 9", ("tolerant", 1990, "9", "514", "CORTEZ KENNEDY", 1)),
    ("PSA 8 Shaquille O'Neal 1992 Hoops #1", ("tolerant", 1992, "8", "1", "SHAQUILLE O'NEAL", 0)),
    ("Graded 2022 Bowman Jackson Holliday #BS6 PSA 10", ("tolerant", 2022, "10", "BS6", "JACKSON HOLLIDAY", 0)),
    ("Graded 2022 Topps NOW Alex Ovechkin #12 PSA 10", ("tolerant", 2022, "10", "12", "ALEX OVECHKIN", 0)),
]
REFUSED = [
    ("A B 1990 Topps #1 PSA 9 BGS 9.5", "multiple graders or grades"),
    ("A B 1990 Topps #1 card 22 PSA 9", "multiple card-number forms"),
    ("A B 1990 Topps Gold Silver #1 PSA 9", "two competing parallel readings"),
]
WHITE_SOX = "Dylan Crews 2023 Topps Chicago White Sox #1 PSA 9"


def test_tolerant_titles(spark):
    words = "CORTEZ KENNEDY SHAQUILLE O'NEAL JACKSON HOLLIDAY ALEX OVECHKIN NOW DYLAN CREWS".split()
    names = spark.createDataFrame([(n,) for n in words], "name string")
    titles = [t for t, _ in LAYOUTS + REFUSED] + [WHITE_SOX]
    df = I.extract_identity(spark.createDataFrame([(t, t) for t in titles], "item_id string, title string"))
    got = {r.item_id: r for r in L.tolerant_identity(df, names).collect()}
    for title, expected in LAYOUTS:
        r = got[title]
        assert (r.provenance, r.year, r.grade_value, r.card_number, r.athlete, r.is_auto) == expected and r.complete
    for title, why in REFUSED:
        assert got[title].provenance == "ambiguous" and why in got[title].ambiguity and not got[title].complete
    assert got[WHITE_SOX].parallel is None


def reconcile(spark, cases, names=None):
    """Reconciled rows of (title, aspects) cases, in order."""
    cards = I.extract_identity(spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(cases)], "item_id string, title string"))
    second = spark.createDataFrame([(str(i), 200, [tuple(x) for x in a.items()]) for i, (_, a) in enumerate(cases)],
                                   "item_id string, http_status int, aspects array<struct<name: string, value: string>>")
    got = {r.item_id: r for r in R.reconcile_identity(cards, second, names).collect()}
    return [got[str(i)] for i in range(len(cases))]


CORE = {"Professional Grader": "PSA", "Grade": "9", "Player/Athlete": "A Player", "Card Number": "5", "Season": "2018",
        "Sport": "Basketball", "Set": "2018 Panini Prizm"}


RECONCILED = [
    ("2018 PANINI PRIZM #5 A PLAYER PSA 9", {}, "verified", "verified"),
    ("2018 PANINI PRIZM #5 A PLAYER PSA 9", {"Card Number": "6"}, "quarantined_material_conflict", "quarantined"),
    ("2018 PANINI PRIZM #5 A PLAYER PSA 9", {"Professional Grader": "Beckett"}, "quarantined_material_conflict", "quarantined"),
    ("2018 PANINI PRIZM #5 A PLAYER PSA 9", {"Parallel/Variety": "Silver"}, "identity_rekey_required", "verified"),
    ("2018 PANINI PRIZM SILVER #5 A PLAYER PSA 9", {"Parallel/Variety": "Silver Prizm"}, "identity_rekey_required", "verified"),
    ("2018 PANINI PRIZM #5 A PLAYER ZEBRA PSA 9", {"Player/Athlete": "A Player", "Card Name": ""}, "verified", "verified"),
    ("2018 PANINI PRIZM #5 A PLAYER 3/50 PSA 9", {}, "held_for_parallel_resolution", "held_for_parallel_resolution"),
    ("2018 PANINI PRIZM #5 A PLAYER PSA 9", {"Parallel/Variety": "A PLAYER"}, "held_for_parallel_resolution", "held_for_parallel_resolution"),
]


def test_reconcile_cases(spark):
    rows = reconcile(spark, [(title, {**CORE, **change}) for title, change, _, _ in RECONCILED])
    for row, (title, change, cls, verdict) in zip(rows, RECONCILED):
        assert (row.cls, row.verdict) == (cls, verdict), (title, change)


def test_slash_joined_names_need_the_vocabulary(spark):
    names = spark.createDataFrame([("JORDAN",), ("WILKINS",), ("MALONE",)], "name string")
    case = [("2018 PANINI HOOPS #5 A PLAYER PSA 9",
             {**CORE, "Set": "2018 Panini Hoops", "Parallel/Variety": "JORDAN/WILKINS/MALONE"})]
    assert reconcile(spark, case, names)[0].eff_parallel is None
    assert reconcile(spark, case)[0].eff_parallel == "JORDAN/WILKINS/MALONE"


def candidate(spark, **change):
    base = {"item_id": "v1|306942391283|0", "year": 2018, "manufacturer": "PANINI", "set": "PRIZM", "subject": "LUKA DONCIC",
            "card_number": "280", "parallel": None, "print_run": None, "psa_grade": "10", "grade_type": "NUMERIC",
            "qualifier": None, "is_auto": 0, "auto_grade": None, **change}
    schema = ("item_id string, year int, manufacturer string, set string, subject string, card_number string, parallel string, "
              "print_run int, psa_grade string, grade_type string, qualifier string, is_auto int, auto_grade string")
    return spark.createDataFrame([tuple(base.values())], schema)


SOLD = [
    ("Luka Doncic ~ 2018 Panini Prizm #280 RC PSA 10", {}, "accepted", None),
    ("2018 Panini Prizm #280 Luka Doncic PSA 10 Dallas Mavericks NBA", {}, "accepted", None),
    ("2018 Panini Prizm #280 Luka Doncic Silver PSA 10", {}, "rejected", "extra_parallel"),
    ("2018 Panini Prizm #280 Luka Doncic PSA 10", {"parallel": "SILVER"}, "review_required", "missing_parallel"),
    ("2018 Panini Prizm #280 Luka Doncic PSA 9", {}, "rejected", "grade"),
    ("2018 Panini Prizm #281 Luka Doncic PSA 10", {}, "rejected", "card_number"),
    ("2018 Panini Prizm Luka Doncic PSA 10", {}, "review_required", "card_number"),
    ("2019 Panini Prizm #280 Luka Doncic PSA 10", {}, "rejected", "year"),
    ("2018 Panini Prizm #280 Trae Young PSA 10", {}, "rejected", "subject"),
    ("2018 Topps #280 Luka Doncic PSA 10", {}, "rejected", "manufacturer"),
    ("2018 Panini Prizm #280 Luka Doncic PSA 10 lot", {}, "rejected", "disqualified"),
    ("2018 Panini Prizm #280 Luka Doncic PSA 10 PSA 9", {}, "rejected", "lot"),
    ("2018 Panini Prizm #280 Luka Doncic BGS 9.5", {}, "rejected", "rival_grader"),
    ("2018 Panini Prizm #280 Luka Doncic", {}, "rejected", "ungraded"),
    ("2018 Panini Prizm #280 Luka Doncic Gold /10 PSA 10", {"parallel": "GOLD", "print_run": 10}, "accepted", None),
    ("2018 Panini Prizm #280 Luka Doncic Gold #03/10 PSA 10", {"parallel": "GOLD", "print_run": 10}, "accepted", None),
    ("2018 Panini Prizm #280 Luka Doncic Gold PSA 10", {"parallel": "GOLD", "print_run": 10}, "review_required", "print_run"),
]


def test_sold_titles(spark):
    ids = [f"v1|{306942390000 + i}|0" for i in range(len(SOLD))]
    cands = candidate(spark, item_id="none")
    for cid, (_, change, _, _) in zip(ids, SOLD):
        cands = cands.unionByName(candidate(spark, item_id=cid, **change))
    rows = spark.createDataFrame([(cid, case[0]) for cid, case in zip(ids, SOLD)], "candidate_item_id string, raw_title string")
    got = {r.candidate_item_id: r for r in E.classify_comps(rows, cands).collect()}
    for cid, (title, _, state, code) in zip(ids, SOLD):
        assert (got[cid].state, got[cid].reason_code) == (state, code), (title, got[cid].reason)


GATES = [
    ({"raw_text": "x Fixed price Exclude listing"}, "accepted", None),
    ({"raw_text": "Edit Sell Similar"}, "rejected", "missing Exclude listing and sale format"),
    ({"raw_text": "50 results per page"}, "review_required", "truncated by pagination"),
    ({"quantity_sold": "0"}, "rejected", "quantity_sold is zero"),
    ({"source_item_id": "306942391283-23d2a0628b"}, "review_required", "cancelled_or_relisted_sale"),
    ({"source_item_id": "3069423912"}, "accepted", None),
    ({"sale_type": "BEST_OFFER"}, "review_required", "best offer with no reliable accepted price"),
    ({"sale_type": "FIXED_PRICE"}, "accepted", None),
]


def test_sale_gates(spark):
    names = ("raw_text", "quantity_sold", "source_item_id", "sale_type")
    rows = spark.createDataFrame(
        [(i, "v1|306942391283|0", "2018 Panini Prizm #280 Luka Doncic PSA 10", *[f.get(n) for n in names])
         for i, (f, _, _) in enumerate(GATES)],
        "i int, candidate_item_id string, raw_title string, " + ", ".join(f"{n} string" for n in names))
    got = {r.i: r for r in E.classify_comps(rows, candidate(spark)).collect()}
    for i, (fields, state, text) in enumerate(GATES):
        assert got[i].state == state and (text is None or text in got[i].reason), fields


def test_attribution_refuses_ambiguity(spark):
    two = candidate(spark).unionByName(candidate(spark, item_id="v1|999999|0", set="SELECT"))
    rows = spark.createDataFrame([("2018 Panini Prizm #280 Luka Doncic PSA 10",), ("2018 Panini Prizm #280 Luka Doncic PSA 9",),
                                  ("2018 Panini Prizm #7 Luka Doncic PSA 9",)], "raw_title string")
    got = {r.raw_title: (r.candidate_item_id, r.attribution_error) for r in E.attribute(rows, two).collect()}
    assert got["2018 Panini Prizm #280 Luka Doncic PSA 10"] == (None, "row matches 2 candidates ambiguously")
    assert got["2018 Panini Prizm #280 Luka Doncic PSA 9"][0] is None
    one = {r.raw_title: r.candidate_item_id for r in E.attribute(rows, candidate(spark)).collect()}
    assert list(one.values()).count("v1|306942391283|0") == 2 and one["2018 Panini Prizm #7 Luka Doncic PSA 9"] is None


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).collect()[0].x


def test_text_functions(spark):
    lit = F.lit
    assert one(spark, T.normalize(lit("  José  O’Neal – ½ "))).startswith("JOSE O'NEAL -")
    assert one(spark, T.dedupe_query(lit("A B A auto 10 PSA 10"))) == "A B auto 10 PSA 10"
    assert one(spark, T.dedupe_query(lit("X auto AUTOGRAPHS PSA 9"))) == "X AUTOGRAPHS PSA 9"
    assert one(spark, T.clean_listing_title(lit("2018 Panini Prizm Luka, preview full size image 2018 Panini Prizm Luka"))) == "2018 Panini Prizm Luka"
    assert one(spark, T.canonical_set(lit("2018-19 Panini Prizm"), lit(2018), lit("PANINI"))) == "PRIZM"
    assert one(spark, T.canonical_set(lit("2018 UD"), lit(2018), lit("UPPER DECK"))) == "BASE"
    assert one(spark, T.canonical_set(lit("Topps RC Signatures"), lit(2018), lit("TOPPS"))) == "ROOKIE SIGNATURES"
    assert one(spark, T.canonical_parallel(lit("Green-Laser Holo"), lit("PRIZM"), lit("PANINI"))) == ["GREEN", "HOLO", "LASER"]
    assert one(spark, T.item_number(lit("v1|306942391283|0"))) == "306942391283"
    assert one(spark, T.item_number(lit("pr-23d2a0628b"))) is None
    assert one(spark, T.rule_for(lit("raw/ungraded - no PSA grade in title"))) == "ungraded"


DATES = {"2024-03-05": "2024-03-05", "03/05/2024": "2024-03-05", "25/12/2023": "2023-12-25", "Mar 5, 2024": "2024-03-05",
         "5 Mar 2024": "2024-03-05", "2024/03/05": "2024-03-05", "03-05-2024": "2024-03-05", "yesterday": None, "": None}
MONEY = {"$1,234.50": (1234.5, "USD"), "£12": (12.0, "GBP"), "n/a": (None, None), "12.5": (12.5, None), "--": (None, None),
         "free": (None, None)}


def test_dates_and_money(spark):
    df = spark.createDataFrame([(t,) for t in (*DATES, *MONEY)], "t string")
    amount, currency = N.money(F.col("t"))
    got = {r.t: r for r in df.select("t", N.sale_date(F.col("t")).cast("string").alias("d"), amount.alias("a"), currency.alias("c")).collect()}
    assert {t: got[t].d for t in DATES} == DATES
    assert {t: (got[t].a, got[t].c) for t in MONEY} == MONEY


def test_transaction_keys_tell_sales_apart(spark):
    key = lambda price: K.transaction_key(F.lit("117"), F.lit("t"), F.lit(price), F.lit(None), F.lit("2024-01-01"))
    assert one(spark, key("88.00")) != one(spark, key("53.14")) and one(spark, key("88.00")).startswith("117-")


def brute_numbers(text):
    """Year, copy number and print run, and grade of a text, by reading it place by place."""
    text = " ".join((text or "").translate(str.maketrans(T.ACCENTED, T.PLAIN)).split()).upper()
    digits = lambda at, most: next((n for n in range(most, 0, -1) if text[at:at + n].isdigit() and text[at:at + n].isascii() and len(text[at:at + n]) == n), 0)
    year = int(text[:4]) if re.match(r"(18|19|20)[0-9][0-9](-([0-9]{4}|[0-9]{2}))?S?(\s|$|[A-Z])", text) else None
    grades = re.findall(r"PSA\s*(10|[1-9](?:\.5)?)(?![0-9.])", text)
    runs = []
    for at in range(len(text)):
        if at and text[at - 1] in "0123456789/.#" or not text[at].isdigit():
            continue
        n = digits(at, 4)
        rest = at + n
        if text[rest:rest + 1].isdigit():
            continue
        slash = re.match(r"\s*/\s*", text[rest:])
        m = digits(rest + slash.end(), 5) if slash else 0
        behind = rest + slash.end() + m if slash else 0
        if m and text[behind:behind + 1] not in tuple("0123456789/") and int(text[at:rest]) <= int(text[rest + slash.end():behind]):
            runs.append((int(text[at:rest]), int(text[rest + slash.end():behind])))
    return year, runs[0] if runs else None, grades[-1] if grades else None


def test_document_numbers_by_hand(spark):
    """Years, copy numbers and grades over whole documents, and texts that hold them."""
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    hand = ["1999 copy 5/10 of PSA 9", "2004-05S set 12 / 99 PSA 10", "7/5 then 3/50", "", None, "3.5/10", "12345/99999", "1/2/3", "2010x", "PSA 8.5 4/4 PSA 7"]
    texts |= {-1 - k: t for k, t in enumerate(hand)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in I.parse_titles(df, "text").collect():
        year, run, grade = brute_numbers(texts[r.doc_id])
        assert (r.year, r.grade_value if r.grade_type == "NUMERIC" else None) == (year, grade), texts[r.doc_id]
        if "#" not in (texts[r.doc_id] or ""):
            assert (r.serial_num, r.print_run) == (run or (None, None)), texts[r.doc_id]


def test_second_hash_behind_a_long_card_number_marks_the_serial(spark):
    df = spark.createDataFrame([("1990 TOPPS SMALL #100896 SAM GEAR AUTO #8/199 PSA 9",), ("1990 TOPPS SMALL #2 SAM GEAR AUTO #8/199 PSA 9",)], "t string")
    out = [r.v for r in df.select(T.repair_print_run(F.col("t"), F.lit(None).cast("int")).alias("v")).collect()]
    assert out == ["1990 TOPPS SMALL #100896 SAM GEAR AUTO 8/199 PSA 9", "1990 TOPPS SMALL #2 SAM GEAR AUTO 8/199 PSA 9"]


def searches(df):
    return len(re.findall(r"regexp_\w+\(|RLIKE\(", df._jdf.queryExecution().optimizedPlan().toString()))


def test_a_title_is_searched_once_for_each_pattern(spark):
    """Nested steps multiply the patterns of the steps before them."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    sold = spark.createDataFrame([("a", "x", "1990 TOPPS SMALL #1 SAM GEAR PSA 9")], "item_id string, candidate_item_id string, raw_title string")
    wanted = spark.createDataFrame([], ", ".join(f"{n} {'int' if n in ('year', 'print_run', 'is_auto') else 'string'}" for n in E.CANDIDATE_FIELDS))
    assert searches(I.cards(I.extract_identity(sold, "raw_title"))) <= 80
    assert searches(E.classify_comps(sold, wanted)) <= 200


def test_marks_around_a_stop_word_and_a_wide_gap(spark):
    got = read(spark, ["1990 TOPPS SMALL #1 SAM GEAR ,ROOKIE. PSA 9", "1990 TOPPS SMALL #1 SAM #3/99 GEAR RCA PSA 9", "1990 TOPPS SMALL #1 'PSAX SAM PSA 9", "1990 TOPPS SMALL #1 SAM 12/ GEAR PSA 9"])
    assert [r.athlete for r in got.values()] == ["SAM GEAR", "SAM GEAR RCA", None, "SAM"]


def test_a_reading_that_may_be_empty_is_evaluated_once(spark):
    """``nullif`` in a branch would evaluate its text twice, and the canonical set names with all they depend on."""
    df = spark.createDataFrame([("a-b", True), ("--", True), (None, True), ("c", False)], "x string, on boolean")
    out = df.select(F.when(F.col("on"), T.norm(F.col("x"))).alias("n"), F.when(F.col("on"), T.capture(F.col("x"), "(b*)$")).alias("c"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and plan.count("regexp_extract(") == 1
    assert [tuple(r) for r in out.collect()] == [("AB", "b"), (None, None), (None, None), (None, None)]


def test_aspects_by_name_the_last_statement_wins(spark):
    said = [[("Grade", "8"), (" grade ", " 9 "), (None, "x"), ("SET", None), ("Season", " ")], [], None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(said)], "id int, aspects array<struct<name: string, value: string>>")
    rows = R.aspect_columns(df).orderBy("id").select("b_grade", "b_set_name", "b_season").collect()
    assert [tuple(r) for r in rows] == [("9", None, None), (None, None, None), (None, None, None)]


def test_a_table_in_one_piece_is_read_by_all_cores(spark, tmp_path):
    """A file of one row group is one task, however much reading its titles takes; a table in many pieces is not shuffled."""
    from listwise.session import spread_few
    least = 3 * spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    assert spread_few(one).rdd.getNumPartitions() == least and spread_few(one).count() == 100
    many = spark.range(0, 100, 1, least)
    assert spread_few(many) is many
    from listwise.workloads import base as B
    spark.range(50).selectExpr(
        "id l_orderkey", "1L l_linenumber", "id l_partkey", "id l_suppkey", "'O' l_linestatus", "'N' l_returnflag", "10D l_extendedprice", "2D l_quantity",
        "0D l_tax", "0D l_discount", "DATE '2000-01-01' l_shipdate").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(50).selectExpr("id p_partkey", "'red fox' p_name", "'CARD' p_type", "1 p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    titled = B.titled_items(spark, str(tmp_path))
    assert titled.count() == 50 and titled.rdd.getNumPartitions() > 1


def plan_nodes(df):
    """Every node of the optimized plan."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        found.append(node)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_a_fence_stops_filters_and_drops_outputs_that_nobody_reads(spark):
    from listwise.operators.joining import fenced
    df = fenced(spark.range(4), ["id"], {"twice": F.sha1(F.col("id").cast("string")), "square": F.col("id") * F.col("id")})
    filtered = df.where("square > 3").select("id", "square")
    nodes = plan_nodes(filtered)
    assert not any("sha" in n.simpleString(99) for n in nodes)
    names = [n.nodeName() for n in nodes]
    assert names.index("Filter") < names.index("Generate")
    assert [tuple(r) for r in filtered.orderBy("id").collect()] == [(2, 4), (3, 9)]
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    try:
        assert fenced(spark.range(5), ["id"], {"next": F.col("id") + 1}).where("next > 2").count() == 3
    finally:
        spark.conf.unset("spark.sql.codegen.wholeStage")


def test_settled_rows_are_a_table_that_readers_take_columns_of(spark):
    """A checkpoint keeps rows as they lie in memory, and each reader reads all columns."""
    from listwise.session import settle
    rows = spark.range(1000).select("id", F.lit("the same long text " * 20).alias("text"), F.array(F.struct(F.col("id").alias("a"))).alias("list"))
    kept = settle(rows.repartition(3))
    assert kept.inputFiles() and kept.columns == rows.columns and kept.exceptAll(rows).count() == rows.exceptAll(kept).count() == 0
    assert "ReadSchema: struct<id:bigint>" in kept.select("id")._jdf.queryExecution().toString()
    assert settle(rows.where("id < 0")).count() == 0


def test_lists_of_aspects_do_not_meet_the_cards(spark):
    said = "array<struct<name: string, value: string>>"
    cards = I.extract_identity(spark.createDataFrame([("a", "1990 TOPPS BASE #5 SAM RING PSA 9"), ("b", "1990 TOPPS BASE #6 SAM RING PSA 9"), (None, "x")], "item_id string, title string"))
    aspects = spark.createDataFrame([("a", 200, [("Grade", "9"), ("Finish", "Gold Refractor")]), ("a", 200, [("Grade", "8")]), ("b", 404, None), (None, 200, [])],
                                    f"item_id string, http_status int, aspects {said}")
    out = R.reconcile_identity(cards, aspects)
    for node in plan_nodes(out.select("item_id", "cls", "base_reason")):
        if node.nodeName() == "Join":
            assert all("aspects#" not in node.children().apply(i).output().mkString(" ") for i in range(2))
    assert sorted((r.item_id or "", r.cls) for r in out.collect()) == [
        ("", "not_enriched"), ("a", "held_for_parallel_resolution"), ("a", "quarantined_material_conflict"), ("b", "not_enriched")]
    stated = aspects.select(R.aspect_states_parallel(F.col("aspects")).alias("s")).collect()
    assert [r.s for r in stated] == [True, False, False, False]


def test_first_verdicts_are_those_that_stay(spark):
    rows = [("a", 3, "x"), ("a", 1, "v"), ("a", 1, "w"), ("b", 2, None), ("b", 4, "x"), (None, 1, "x"), ("c", None, "x")]
    history = spark.createDataFrame(rows, "item_id string, scored_at int, verdict string")
    first = {r.item_id: r.original_verdict for r in R.first_verdicts(history).collect()}
    assert first == {"a": "w", "b": None}
    assert first == {r.item_id: r.original_verdict for r in R.frozen_verdicts(history, lambda at: at % 2).collect()}


def test_verdicts_are_looked_up_for_every_asking_of_a_peer(spark):
    """Two askings of one peer, one of them twice; a peer without a time and one without an id are kept."""
    said = "array<struct<name: string, value: string>>"
    peers = [("a", 2), ("a", 5), ("a", 5), ("b", None), (None, 3)]
    before = spark.createDataFrame([(i, "t", "s", "k", None, at) for i, at in peers], "item_id string, title string, slab_key string, card_key string, identity string, asked_at int")
    attempts = spark.createDataFrame([("a", 6, 200, None), ("b", 9, 404, "gone")], "item_id string, attempted_at int, http_status int, error string")
    aspects = spark.createDataFrame([("a", [("Grade", "9")])], f"item_id string, aspects {said}")
    after = spark.createDataFrame([], f"item_id string, cls string, findings array<struct<severity: string>>, eff_identity string, eff_card_key string, eff_slab string, rekeyed boolean")
    history = spark.createDataFrame([("a", 1, "one"), ("a", 4, "four"), ("a", 6, "six"), ("b", 1, "x")], "item_id string, scored_at int, verdict string")
    audit = R.peer_audit(before, attempts, aspects, after, history, lambda at: (at / 3).cast("int"))
    rows = sorted((r.item_id or "", r.verdict_before or "", r.verdict_after or "", r.original_verdict or "", r.http_calls) for r in audit.collect())
    assert rows == [("", "", "", "", 0), ("a", "four", "six", "one", 1), ("a", "four", "six", "one", 1), ("a", "one", "six", "one", 1), ("b", "", "x", "x", 1)]


def test_ids_are_written_behind_the_join_with_parts(spark, tmp_path):
    from listwise.workloads import base as B
    spark.range(50).selectExpr(
        "id l_orderkey", "1L l_linenumber", "id l_partkey", "id l_suppkey", "'O' l_linestatus", "'N' l_returnflag", "10D l_extendedprice", "2D l_quantity",
        "0D l_tax", "0D l_discount", "DATE '2000-01-01' l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(49).selectExpr("id p_partkey", "'red fox' p_name", "'CARD' p_type", "1 p_size").write.parquet(f"{tmp_path}/part.parquet")
    titled = B.titled_items(spark, str(tmp_path))
    joins = [n for n in plan_nodes(titled.select("item_id", "title")) if n.nodeName() == "Join"]
    assert joins and "item_id" not in joins[0].children().apply(0).output().mkString(" ")
    assert titled.count() == 49 and "1-1-1-1-20000101" in [r.item_id for r in titled.collect()]
