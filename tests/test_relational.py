from pyspark.sql import functions as F

from shelfspark.operators import categories, coverage, diff, identity
from shelfspark.operators.skew import with_sequence
from shelfspark.plans.derived import remote_products, view


def test_sequence_matches_sort_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("g"))
    got = with_sequence(df, [F.col("k")], "n", within=["g"]).collect()
    groups = {}
    for row in sorted(got, key=lambda r: (r["g"], r["k"])):
        groups[row["g"]] = groups.get(row["g"], 0) + 1
        assert row["n"] == groups[row["g"]]
    whole = with_sequence(df, [F.col("k")], "n", start=2).orderBy("k").collect()
    assert [r["n"] for r in whole] == list(range(2, 5002))


def test_sequence_over_many_sorted_parts(spark, monkeypatch):
    from shelfspark.operators import skew
    monkeypatch.setattr(skew, "ROWS_PER_SORT", 700)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 100)
    df = spark.range(5000).select((F.col("id") % 40).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.col("id").alias("wide"))
    got = with_sequence(df.coalesce(1), [F.col("k")], "n", within=["g"]).collect()
    assert len(got) == 5000
    groups = {}
    for row in sorted(got, key=lambda r: (r["g"] or 0, r["k"], r["wide"])):  # ties by input order, null is a group
        groups[row["g"]] = groups.get(row["g"], 0) + 1
        assert row["n"] == groups[row["g"]]
    assert with_sequence(df.limit(0), [F.col("k")], "n").collect() == []


def test_salted_join_splits_measured_hot_keys(spark):
    from shelfspark.operators import skew
    key = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.col("id").cast("string"))
    rows = spark.range(4000).select("id", key.alias("k"))
    lookup = rows.select("k").distinct().withColumn("v", F.upper("k")).filter("k is null or k <> '3'")
    hot = {r["k"]: r["_salts"] for r in skew.hot_keys(skew.key_counts(rows, ["k"]), ["k"], 16).collect()}
    assert hot == {"hot": 8}
    left = skew.salted_join(rows, lookup, "k", F.col("id"), "left")
    assert sorted((r["id"], r["v"]) for r in left.collect()) == [
        (i, "HOT" if i % 2 == 0 else None if i % 10 == 1 or i == 3 else str(i)) for i in range(4000)]
    assert skew.salted_join(rows, lookup, "k", F.col("id")).count() == 4000 - 400 - 1
    assert skew.salted_join(rows.limit(0), lookup, "k", F.col("id")).count() == 0


def test_half_of_all_payloads_in_one_category(spark):
    payloads = spark.range(2000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 2 == 0, "c0").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("category"))
    reconciled = spark.createDataFrame([("s", "c0", "n", "r0", "alias"), ("s", "c5", "n", "c5", "create")], "supplier_slug string, id string, name string, remote_id string, action string")
    got = {r["id"]: r["category"] for r in categories.remap_categories(payloads, reconciled).collect()}
    assert got == {str(i): "r0" if i % 2 == 0 else f"c{i}" for i in range(2000)}


def test_category_names(spark):
    paths = ["A > Cups", "B > Cups", "B > Lids", "x" * 70 + " > " + "y" * 70, ""]
    rows = spark.createDataFrame([("s", p) for p in paths], "supplier_slug string, category_path string")
    names = {r["path"]: r["name"] for r in categories.category_names(rows).collect()}
    assert names["A > Cups"] == "A > Cups" and names["B > Lids"] == "Lids" and names["Uncategorized"] == "Uncategorized"
    assert names[paths[3]] == "y" * 64
    twice = rows.union(rows)
    assert {r["path"]: r["name"] for r in categories.category_names(twice, compat_per_product=True).collect()}["B > Lids"] == "B > Lids"


def test_category_alias_by_name(spark):
    local = spark.createDataFrame([("s", "l1", "Cups"), ("s", "l2", "Lids"), ("s", "l3", "New")], "supplier_slug string, id string, name string")
    remote = spark.createDataFrame([("r1", " CUPS ", 1), ("l2", "Old", 2)], "id string, name string, ordinal int")
    got = {r["id"]: (r["remote_id"], r["action"]) for r in categories.reconcile_categories(local, remote).collect()}
    assert got == {"l1": ("r1", "alias"), "l2": ("l2", "update"), "l3": ("l3", "create")}


def test_diff_with_itself_is_unchanged(spark, sf_dir):
    local = diff.payload_from_rows(view(spark, sf_dir, "items"))
    actions = {r["action"] for r in diff.catalog_plan(local, local.drop("supplier_slug")).select("action").distinct().collect()}
    assert actions == {"unchanged"}


def test_policy_keeps_missing_products(spark, sf_dir):
    local = diff.payload_from_rows(view(spark, sf_dir, "items"))
    plan = diff.catalog_plan(local, remote_products(spark, sf_dir), skip_inactivate=True)
    assert plan.filter("action = 'inactivate'").count() == 0
    flags = spark.createDataFrame([(None, " Keep_Existing "), (None, "delete_missing"), (False, "keep_existing")], "e boolean, p string")
    assert [r[0] for r in flags.select(diff.skip_inactivate(F.col("e"), F.col("p"))).collect()] == [True, False, False]


def test_item_id_numbers_and_repeats(spark):
    rows = [("s", "", "u2", "n", 1), ("s", "", "u1", "n", 2), ("s", "K", "u0", "n", 3), ("s", "", "u1", "n", 4)]
    df = spark.createDataFrame(rows, "supplier_slug string, sku string, product_url string, item_name string, ordinal int")
    df = df.withColumn("variant_options", F.create_map().cast("map<string,string>"))
    got = {r["record_key"]: r["item_id"] for r in identity.item_ids(df).collect()}
    assert got == {"sku:K": "K", "url:u1|{}": "S_NO_ID_000002", "url:u2|{}": "S_NO_ID_000003"}


def test_running_total_over_many_blocks(spark):
    df = spark.range(5000).select(F.lit("a").alias("s"), F.col("id").alias("page_index"), F.lit(1).alias("v"))
    got = coverage.running_total(df, "v", "page_index", ["s"], "c").orderBy("page_index").collect()
    assert [r["c"] for r in got] == list(range(1, 5001))


def test_only_products_of_the_run_end(spark, sf_dir):
    from shelfspark.operators import diff
    from shelfspark.plans.derived import remote_products, view
    local = diff.payload_from_rows(view(spark, sf_dir, "items"))
    one = local.select("supplier_slug").first()[0]
    remote = remote_products(spark, sf_dir)
    feed = local.filter(F.col("supplier_slug") == one)
    plan = diff.catalog_plan(feed, remote)
    assert {r["supplier_slug"] for r in plan.collect()} == {one}
    assert {r["supplier_slug"] for r in diff.missing_from_feed(feed, remote).collect()} <= {one}
    assert diff.catalog_plan(feed.limit(0), remote, suppliers=feed).filter("action = 'inactivate'").count() > 0
    assert diff.catalog_plan(feed.limit(0), remote).count() == 0


def test_repeated_feed_rows_make_one_plan_row(spark, sf_dir):
    from shelfspark.operators import diff
    from shelfspark.plans.derived import remote_products, view
    row = diff.payload_from_rows(view(spark, sf_dir, "items")).limit(1)
    twice = row.withColumn("name", F.lit("first")).unionByName(row.withColumn("name", F.lit("last"))).coalesce(1)
    plan = diff.catalog_plan(twice, remote_products(spark, sf_dir).limit(0)).collect()
    assert [r["action"] for r in plan] == ["create"] and '"name":"last"' in plan[0]["payload"]


def test_base_rows_are_spread_before_anything_is_derived(spark, sf_dir):
    """One file is one row group here, so what is derived before a shuffle is derived by one task."""
    from shelfspark.plans.derived import HEAVY, view
    assert {"items", "remote"} <= HEAVY
    for name, made in [("shop_pages", " AS html"), ("items", " AS Item ID"), ("remote", " AS status")]:
        rows = view(spark, sf_dir, name)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index(made) < plan.index("Repartition"), name
        assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_names_are_read_above_the_dealing_of_pages(spark, sf_dir):
    from shelfspark.operators.extract import extract_products
    from shelfspark.plans.derived import view
    for rows in extract_products(view(spark, sf_dir, "shop_pages"), "shop"):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "ArrowEvalPython" in plan[:plan.index("Repartition")] and "ArrowEvalPython" not in plan[plan.index("Repartition"):]
