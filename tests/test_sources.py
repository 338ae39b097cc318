"""Exports with a preamble, artifacts, pages, payload cases, and the file stores."""

import json

from pyspark.sql import functions as F

from listwise.plans.evidence import reusable_comps
from listwise.sources import exports as X
from listwise.sources import listings as S
from listwise.sources import pages as G


def test_exports_with_preamble_and_aliases(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'Research export\nfilters,PSA\n"Listing title","Avg. sold price",Shipping,"Date sold","Best offer","List price"\n'
        '"1990 Topps, #1",$12.50,$1.00,2024-01-02,no,\n"Offer card",$9.00,,2024-01-03,yes,$9.00\n'
        '"Real offer",$7.00,,2024-01-03,accepted,$9.00\n,,,,,\n', encoding="utf-8-sig")
    (tmp_path / "b.csv").write_text("Item title,Total price,Shipping price\nBacked out,$15.00,$5.00\n")
    (tmp_path / "c.csv").write_text("nothing,here\n1,2\n")
    rows = {r.raw_title: r for r in X.translate_rows(X.read_exports(spark, str(tmp_path))).collect()}
    assert set(rows) == {"1990 Topps, #1", "Offer card", "Real offer", "Backed out"}
    assert (rows["1990 Topps, #1"].sold_price, rows["1990 Topps, #1"].shipping, rows["1990 Topps, #1"].currency) == (12.5, 1.0, "USD")
    assert rows["Offer card"].sold_price is None and rows["Offer card"].displayed_original_price == 9.0
    assert rows["Real offer"].sold_price == 7.0 and rows["Real offer"].actual_price_known
    assert rows["Backed out"].sold_price == 10.0
    (tmp_path / "d.csv").write_text("x\n" * 25 + "Title,Sold price\nlate,$1\n")
    assert {(r.file.rsplit("/", 1)[1], r.reason) for r in X.rejected_exports(spark, str(tmp_path)).collect()} == {
        ("c.csv", "no header"), ("d.csv", "header after more than 24 lines")}


def test_exports_have_any_width(spark, tmp_path):
    names = [f"extra {i}" for i in range(58)] + ["Title", "Sold price"]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join(["x"] * 58 + ["wide card", "$3.00"]) + "\n")
    (tmp_path / "slim.csv").write_text("Title,Sold price\nslim card,$4.00\n")
    got = {r.raw_title: r.sold_price for r in X.translate_rows(X.read_exports(spark, str(tmp_path))).collect()}
    assert got == {"wide card": 3.0, "slim card": 4.0}


def test_import_needs_its_columns(spark, tmp_path):
    X.write_report(X.import_template(spark).drop("sold_price"), str(tmp_path / "t"), "csv")
    (tmp_path / "bad.csv").write_text("candidate_item_id,raw_title\n1,x\n")
    try:
        X.read_sold_csv(spark, str(tmp_path / "bad.csv"))
    except ValueError as exc:
        assert "sold_price" in str(exc)
    else:
        raise AssertionError("a missing column must fail")


def test_artifacts(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"candidate_id": "c", "level": "STRICT", "rows": [
        {"source_item_id": "1", "raw_title": "t"}, {"source_item_id": "2", "raw_title": "u"}]}, indent=1))
    assert {(r.candidate_id, r.source_item_id) for r in X.read_artifacts(spark, str(tmp_path)).collect()} == {("c", "1"), ("c", "2")}


PAGES = {
    "sold": ("<div><div><div><a href='/itm/123456789012'>1990 Topps Base Card</a> <span>$88.00 +$3.50 shipping</span> Jan 5, 2024</div></div>"
             "<ul><li><a href='/itm/123456789013'>1991 Topps Base Card</a> $53.14 Free shipping Feb 6, 2024</li></ul></div>", "results_ok"),
    "captcha": ("<p>Please solve the CAPTCHA</p><div>$1 Jan 5, 2024</div>", "verification_required"),
    "login": ("<p>Please sign in</p>", "login_required"), "empty": ("<p>No results found</p>", "empty_results"),
    "script": ("<script>var x = 'no results found';</script><p>hello</p>", "unknown_page"),
    "layout": ("<th>Avg sold price</th>", "unsupported_layout"), "ready": ("<title>Product Research - x</title>", "research_ready"),
    "blank": ("", "unknown_page"),
}


def test_pages(spark):
    keys = list(PAGES)
    pages = spark.createDataFrame([(i, PAGES[k][0]) for i, k in enumerate(keys)], "page_id long, html string")
    blocks = G.page_blocks(pages)
    states = {keys[r.page_id]: r.state for r in G.page_states(pages).collect()}
    assert states == {k: state for k, (_, state) in PAGES.items()}
    rows = G.records_to_rows(G.sold_records(blocks)).where("page_id = 0").collect()
    assert {(r.raw_title, r.sold_price, r.shipping, str(r.sale_date)) for r in rows} == {
        ("1990 Topps Base Card", 88.0, 3.5, "2024-01-05"), ("1991 Topps Base Card", 53.14, 0.0, "2024-02-06")}
    assert all(r.source_item_id.startswith("12345678901") for r in rows)


def test_shipping_cases(spark):
    cases = [(None, None), ("CALCULATED", "0.00"), ("FIXED", "0.00"), ("FIXED", None), ("ODD", "1"), ("fixed", "2.5")]
    df = spark.createDataFrame(cases, "k string, v string")
    state, cost = S.shipping_state(F.col("k"), F.col("v"))
    got = [(r.s, r.c) for r in df.select(state.alias("s"), cost.alias("c")).collect()]
    assert got == [("NOT_RETURNED", None), ("CALCULATED_UNKNOWN", None), ("KNOWN", 0.0), ("NOT_RETURNED", None),
                   ("NOT_RETURNED", None), ("KNOWN", 2.5)]


def test_scoped_sweep_spares_unknown_sellers(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), (None, 1, 1), ("a", 9, 1)], "seller string, fetched_at int, active int")
    assert [r.active for r in S.sweep_stale(df, F.lit(5), ["a"]).collect()] == [0, 1, 1, 1]
    assert [r.active for r in S.sweep_stale(df, F.lit(5)).collect()] == [0, 0, 0, 1]


def test_replace_scope_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "c string, v int"
    spark.createDataFrame([("a", 1), ("b", 1), ("d", 1)], schema).write.partitionBy("c").parquet(path)
    S.replace_scope(spark.createDataFrame([("a", 2)], schema), path, "c", ["a"])
    assert {(r.c, r.v) for r in S.read_scoped(spark, path).collect()} == {("a", 2), ("b", 1), ("d", 1)}
    S.replace_scope(spark.createDataFrame([("d", 3), ("x", 9)], schema), path, "c", ["a", "d"])
    assert {(r.c, r.v) for r in S.read_scoped(spark, path).collect()} == {("b", 1), ("d", 3)}


def test_null_identity_borrows_no_evidence(spark):
    comps = spark.createDataFrame([("x", "accepted"), ("y", "accepted"), ("x", "rejected")], "candidate_item_id string, state string")
    ids = spark.createDataFrame([("x", "k"), ("y", None)], "item_id string, eff_slab string")
    assert [r.eff_slab for r in reusable_comps(comps, ids).collect()] == ["k"]


def test_a_block_is_cleaned_once(spark):
    pages = spark.createDataFrame([(0, "<div>x</div>")], "page_id long, html string")
    plan = G.sold_records(G.page_blocks(pages))._jdf.queryExecution().optimizedPlan().toString()
    # Once for the link, once for the cells: a filter on the listing repeats neither.
    assert plan.count("opens in a new window or tab") == 2


def test_blocks_of_a_page_in_odd_layouts():
    row = "<div role='row'><span role='cell'>1990 Topps Base</span><b>$5.00</b> <i>Jan 5,</i> 1997</div>"
    columns, blocks, tables = G._page_blocks(f"<p>Last  Sold:</p>{row}<table><tr><th>a</th></tr><tr></tr></table>")
    assert columns == ["date_last_sold"] and tables == [[["a"]]]
    assert [(b["text"], b["cells"]) for b in blocks] == [("1990 Topps Base $5.00 Jan 5, 1997", ["1990 Topps Base"])]
    assert G._page_blocks(None) == ([], [], [])


def test_replace_scope_deals_rows_by_scope_before_writing(spark, tmp_path):
    """Scopes spread over all pieces of the input are written once each, so no writing task has to order the rows of them all."""
    path = str(tmp_path / "table")
    rows = spark.range(0, 200_000, 1, 4).selectExpr("id item", "cast(id % 7 as int) c")
    S.replace_scope(rows, path, "c", list(range(7)))
    table = S.read_scoped(spark, path)
    assert len(table.inputFiles()) == 7 and table.distinct().count() == 200_000


def test_a_line_that_is_a_whole_record_meets_no_other(spark, tmp_path):
    """Only records over several lines are gathered by their number; the lines of an export are numbered once."""
    path = tmp_path / "export.csv"
    path.write_text('Report\n\nTitle,Sold price\nplain,$1.00\n"over\ntwo, lines",$2.00\n\n"doubled ""quote""",$3.00\n"three\n\nlines",$4.00\n')
    df = X.read_exports(spark, str(path))
    assert sorted((r["at"], r["raw_title"], r["sold_price"]) for r in df.collect()) == [
        (3, "plain", "$1.00"), (4, "over\ntwo, lines", "$2.00"), (5, 'doubled "quote"', "$3.00"), (6, "three\n\nlines", "$4.00")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "whole" in plan and "Union" in plan
