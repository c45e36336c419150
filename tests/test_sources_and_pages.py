import json

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import html, numbers, urls
from shelfspark.operators import extract, operations as ops, policy
from shelfspark.operators.skew import scratch_folder
from shelfspark.plans.derived import products, view
from shelfspark.schema import IMPORT_COLUMNS
from shelfspark.sources import readers, writers
from shelfspark.streaming import streams


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_import_csv_round_trip(spark, sf_dir):
    rows = view(spark, sf_dir, "feed")
    folder = scratch_folder(spark, "csv")
    writers.write_import_csv(rows.orderBy("row_number").coalesce(1), folder)
    back = readers.read_import_csv(spark, folder)
    assert back.columns == ["row_number", *IMPORT_COLUMNS]
    key = lambda r: (r["row_number"], r["Item ID"], r["Item name"])
    assert sorted(map(key, back.collect())) == sorted(map(key, rows.collect()))


def test_product_export_round_trip_and_unknown_field(spark, sf_dir):
    folder = scratch_folder(spark, "jsonl")
    writers.write_jsonl(products(spark, sf_dir).drop("ordinal", "supplier_slug"), folder)
    assert readers.read_products_jsonl(spark, folder).count() == products(spark, sf_dir).count()
    bad = scratch_folder(spark, "bad")
    spark.createDataFrame([('{"sku": "a", "surprise": 1}',)], "value string").write.text(bad)
    with pytest.raises(Exception, match="unknown product fields"):
        readers.read_products_jsonl(spark, bad).collect()


def test_config_shapes(spark):
    texts = ['{"suppliers": [{"supplier_slug": "a"}, {"supplier_slug": "b"}]}', '{"supplier_slug": "c"}', '[{"supplier_slug": "d"}]', "[]", '"x"']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert sorted(r["supplier_slug"] for r in readers.parse_configs(df).collect()) == ["a", "b", "c", "d"]


def test_money_rules(spark):
    assert one(spark, numbers.divide_half_up(F.lit("96.25"), F.lit("6"))) == "16.04"
    assert one(spark, numbers.divide_half_up(F.lit("94.00"), F.lit("6"))) == "15.67"
    assert one(spark, numbers.divide_half_up(F.lit("abc"), F.lit("6"))) == "abc"
    assert one(spark, numbers.divide_half_up(F.lit("9"), F.lit("0"))) == "9"
    assert one(spark, numbers.two_decimals(F.lit(2.675))) == "2.67"
    assert one(spark, numbers.cents(F.lit("1'234,565"))) == 123457
    assert one(spark, numbers.trimmed_four_decimals(F.lit("2.000"))) == "2"


def test_links(spark):
    base = F.lit("https://a.ch/x/y.html?q=1")
    cases = {"z.html": "https://a.ch/x/z.html", "../z": "https://a.ch/z", "/z": "https://a.ch/z", "//b.ch/z": "https://b.ch/z",
             "https://c.ch": "https://c.ch", "?p=2": "https://a.ch/x/y.html?p=2", "": ""}
    for href, expected in cases.items():
        assert one(spark, urls.absolute_url(base, F.lit(href))) == expected
    assert one(spark, urls.with_page(F.lit("https://a.ch/c/?p=1&o=2"), F.lit(3))) == "https://a.ch/c/?p=3&o=2"
    assert one(spark, urls.absolute_url(F.lit("https://h.ch/a/b/c/d/e/f/g.html"), F.lit("../../../../../x.html?r=../y"))) == "https://h.ch/a/x.html?r=../y"
    assert one(spark, urls.absolute_url(F.lit("https://h.ch/a/b"), F.lit("../../../.."))) == "https://h.ch/"


def test_crawl_policy(spark):
    lines = ["Disallow: /first", "User-agent: x", "Disallow: /", "User-agent: *", "Disallow: /a", "Allow: /a/b", "Disallow: /*.pdf$", "Disallow:", "#Allow: /"]
    rules = policy.policy_rules(spark.createDataFrame([("h.ch", i, line) for i, line in enumerate(lines)], "host string, ord int, line string"))
    wanted = {"/a/x": False, "/a/b/c": True, "/z": True, "/z.pdf": False, "/z.pdf?x": True, "/first": False}
    pages = spark.createDataFrame([(f"https://{h}{p}",) for h in ("h.ch", "i.ch") for p in wanted], "url string")
    got = {r["url"]: r["allowed"] for r in policy.with_verdict(pages, rules).collect()}
    assert got == {f"https://h.ch{p}": v for p, v in wanted.items()} | {f"https://i.ch{p}": True for p in wanted}


def test_food_page(spark):
    html = (
        '<nav class="breadcrumb"><span class="breadcrumb-title">Shop</span><span class="breadcrumb-title">Asia &amp; Orient</span></nav>'
        '<h1 class="product-detail-name">Teriyaki Sauce</h1><ul class="product-additional-info-list"><li>2.000 kg/l</li><li>1 / Flasche</li></ul>'
        '<span class="product-box-articlenumber">Art-Nr. 18071</span>')
    page = spark.createDataFrame([("https://f.ch/Teriyaki-Sauce/18071", html), ("https://f.ch/none", "<p>x</p>")], "url string, html string")
    good, bad = extract.extract_products(page, "food")
    row = good.collect()[0]
    assert (row["sku"], row["category_path"], row["vessel_size"], row["vessel_unit"], row["vessel_type"]) == (
        "18071", "Asia & Orient", "2", "kg", "Flasche")
    assert [r["reason"] for r in bad.collect()] == ["not-a-product-page"]


def test_log_markers(spark):
    lines = ["Parsed product 1", "PROGRESS phase=processing found=1001 processed=437 scraped=430 total=1001", "ERROR a", "ERROR a",
             "Traceback x", "Parsed product 2", 'RESULT_RUN_SUMMARY {"a":1}', "RESULT_RUN_SUMMARY {broken}"]
    df = spark.createDataFrame([(1, i, line) for i, line in enumerate(lines)], "job_id int, ord int, line string")
    p = ops.log_progress(df).first()
    assert (p["phase"], p["found_count"], p["processed_count"], p["scraped_count"], p["total_count"], p["parsed_products"]) == (
        "processing", 1001, 437, 430, 1001, 2)
    assert sorted(r["line"] for r in ops.log_errors(df).collect()) == ["ERROR a", "Traceback x"]
    assert ops.last_result(df).first()["payload"] == '{"a":1}'


def test_alert_thresholds(spark):
    base = ("scheduler", "succeeded", "", "", 10, 100, 10, 5.0)
    rows = [base, (*base[:4], 4, *base[5:]), ("panel", *base[1:]), ("scheduler", "failed", *base[2:])]
    df = spark.createDataFrame(rows, "requested_by string, status string, error_message string, sync_error string, failure_count int, "
                                     "raw_record_count int, minimum_failures int, failure_rate_percent double")
    assert [r["alert_reason"] for r in ops.alert_reason(df).collect()] == [
        "10 product errors out of 100 processed (10.0%).", "", "", ops.FAILED_MESSAGE]


def test_html_nesting_quotes_and_references(spark):
    page = ("<div class=\"d\">a <div>b</div> tail &#8211; &ndash; &#xE4; &amp;lt;</div><a href='/q'>x</a><a href=/z>y</a><a href=\"https://h.ch/z\">z</a>"
            "<nav>n<nav>m</nav>o</nav><p class='x d2'>one<p class=\"d2\">two</p>end<meta property='og:t' content='v &auml;'>")
    h = F.col("html")
    row = spark.createDataFrame([("https://h.ch/p", page)], "url string, html string").select(
        html.class_text(h, "d").alias("d"), html.class_texts(h, "d2").alias("all"), html.tag_texts(h, "div").alias("divs"),
        html.meta(h, "property", "og:t").alias("meta"), html.body_text(h, "nav", "a", "div", "p").alias("rest"), html.class_html(h, "none").alias("none")).first()
    assert row.asDict() == {"d": "a b tail – – ä &lt;", "all": ["one", "two"], "divs": ["a b tail – – ä &lt;", "b"], "meta": "v ä", "rest": "one end", "none": ""}
    links = extract.page_links(spark.createDataFrame([("https://h.ch/p", page)], "url string, html string"))
    assert sorted(r["url"] for r in links.collect()) == ["https://h.ch/q", "https://h.ch/z"]


def test_options_and_attributes_are_paired_inside_their_group():
    group = "<div class='product-detail-configurator-group'><legend>{}\xa0auswählen</legend><input type=radio id={}{}><label for={}>{}</label></div>"
    assert html.chosen_options(group.format("Farbe", "a", "", "a", "rot") + group.format("Form", "b", " checked", "b", "rund")) == {"Form": "rund"}
    item = "<li><div class='overlay-flag'><span>{}</span></div>{}</li>"
    page = ("<div class=product-detail__attributes><ul>" + item.format("Traube", "<span class=content>Merlot</span><span class=content>Syrah</span><span class=content>Merlot</span>")
            + item.format("Leer", "") + item.format("Herkunft", "<svg>i</svg>Toskana | Italien") + "</ul></div>")
    assert html.flagged_attributes(page) == {"Traube": "Merlot | Syrah", "Herkunft": "Toskana | Italien"}


def test_snapshot_arrays_stay_bounded(spark, sf_dir, monkeypatch):
    from shelfspark.plans import source_queries
    from shelfspark.streaming.streams import workspace

    folders = []
    monkeypatch.setattr(source_queries, "workspace", lambda s, name: folders.append(workspace(s, name)) or folders[-1])
    monkeypatch.setattr(source_queries, "ARRAY_ROWS", 20, raising=False)
    rows = source_queries._snapshot(spark, sf_dir).count()
    sizes = [len(json.loads(r["value"])) for r in spark.read.text(folders[0], wholetext=True).collect()]
    assert sum(sizes) == rows > 100 and max(sizes) < 60


def test_references_need_their_semicolon():
    assert html.plain("<h1>a&amp;b &lt; c&#37; des&amp</h1>") == "a&b < c% des&amp"
    assert html.resolve("/z?a=1&copy=2&amp;b=3&nope;&ampx;") == "/z?a=1&copy=2&b=3&nope;&ampx;"


def test_links_of_repeated_snapshots_are_one(spark):
    rows = [("https://h.ch/p", "<a href='/q'>x</a><a href='/r'>y</a>"), ("https://h.ch/p", "<a href='/r'>y</a>"), ("https://h.ch/s", "<a href='/q'>x</a>")]
    links = extract.page_links(spark.createDataFrame(rows, "url string, html string"))
    assert sorted(tuple(r) for r in links.collect()) == [
        ("https://h.ch/p", "https://h.ch/q"), ("https://h.ch/p", "https://h.ch/r"), ("https://h.ch/s", "https://h.ch/q")]


def test_page_bundles_hold_many_snapshots(spark):
    from shelfspark.sources import folders, readers, writers
    from shelfspark.streaming.streams import workspace

    pages = [(f"p{i}.html", f"<p>\n\r\u2028 {i} \"q\" \\ </p>\n" * (i % 3)) for i in range(100)] + [("none.html", None)]
    folder = workspace(spark, "pages")
    writers.write_page_bundles(spark.createDataFrame(pages, "snapshot_name string, html string").repartition(3), folder)
    assert len([n for n in folders.children(spark, folder) if n.startswith("part-")]) == 3
    assert sorted(((r["snapshot_name"], r["html"]) for r in readers.read_page_bundles(spark, folder).collect()), key=str) == sorted(pages, key=str)


def test_pages_reach_python_in_small_batches(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    pages = spark.range(0, 3000, 1, 1).select(F.expr("repeat('<p>x</p>', cast(id % 2 * 10000 AS int))").alias("html"))
    seen = pages.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in seen) == 3000 and max(r["rows"] for r in seen) <= 256 and max(r["bytes"] for r in seen) <= 8 << 20
