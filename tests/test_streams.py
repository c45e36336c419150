"""Streams over several triggers: restarts, repeated batches, order of log lines, incomplete snapshots."""

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import coverage, diff, identity
from shelfspark.operators import operations as ops
from shelfspark.plans.derived import remote_products, view
from shelfspark.sources import folders, readers, writers
from shelfspark.streaming import streams
from shelfspark.streaming.state import KeyedTable

MANIFEST = "url string, status_code int, snapshot_path string, ord long"


def plain(frame):
    return sorted(map(str, frame.collect()))


def test_a_repeated_batch_replaces_itself(spark, monkeypatch):
    folder, landing = streams.workspace(spark, "t"), streams.workspace(spark, "l")
    rows = [("a", 200, "s1", 1), ("a", 500, "s3", 3), ("b", 200, "s2", 2), (None, 200, "s0", 1)]
    spark.createDataFrame(rows, MANIFEST).write.mode("append").parquet(landing)

    def stream():
        return spark.readStream.schema(MANIFEST).parquet(landing)

    streams.run_latest_fetch(stream(), folder)
    spark.createDataFrame([("a", 200, "s4", 2), ("a", 404, "s9", 3), ("c", 200, "s5", 9)], MANIFEST).write.mode("append").parquet(landing)
    merge = KeyedTable.merge

    def fails(self, *args):
        merge(self, *args)
        raise RuntimeError("lost after the table was written")

    monkeypatch.setattr(KeyedTable, "merge", fails)
    with pytest.raises(Exception, match="lost after"):
        streams.run_latest_fetch(stream(), folder)
    monkeypatch.setattr(KeyedTable, "merge", merge)
    for _ in range(2):  # the failed batch again, then nothing new
        got = {r["url"]: (r["status_code"], r["snapshot_path"], r["fetches"]) for r in streams.run_latest_fetch(stream(), folder).collect()}
        assert got == {"a": (404, "s9", 4), "b": (200, "s2", 1), "c": (200, "s5", 1), None: (200, "s0", 1)}
    everything = spark.read.schema(MANIFEST).parquet(landing)
    batch = {r["url"]: (r["status_code"], r["snapshot_path"], r["fetches"]) for r in coverage.latest_fetch(everything, "ord").collect()}
    assert got == batch


def test_merges_rewrite_only_the_buckets_they_touch(spark):
    folder = streams.workspace(spark, "k")
    schema = spark.createDataFrame([], "k long, n long").schema
    table = KeyedTable(spark, folder, schema, ["k"], buckets=8)

    def sums(old, delta):
        return old.unionByName(delta).groupBy("k").agg(F.sum("n").alias("n")).filter("n > 0")

    table.merge(0, spark.range(100).selectExpr("id AS k", "id + 1 AS n"), sums)
    before, _ = table.commit(0)
    table.merge(1, spark.createDataFrame([(5, 100)], "k long, n long"), sums)
    after, _ = table.commit(1)
    assert len(before) == 8 and [b for b in after if after[b] != before[b]] != [] and sum(after[b] != before[b] for b in after) == 1
    table.merge(2, spark.createDataFrame([(6, -7)], "k long, n long"), sums)
    table.merge(3, spark.createDataFrame([], "k long, n long"), sums)
    assert table.versions() == [2, 3] and table.read().count() == 99
    assert {r["k"]: r["n"] for r in table.read().filter("k in (5, 6, 7)").collect()} == {5: 106, 7: 8}
    table.merge(3, spark.createDataFrame([(7, 1)], "k long, n long"), sums)  # the same version again
    table.merge(3, spark.createDataFrame([(7, 1)], "k long, n long"), sums)
    assert {r["k"]: r["n"] for r in table.read().filter("k = 7").collect()} == {7: 9}
    named = {(v, b) for k in table.versions() for b, v in table.commit(k)[0].items()}
    held = {(int(v.split("=")[1]), int(b.split("=")[1])) for v in folders.children(spark, f"{folder}/rows")
            for b in folders.children(spark, f"{folder}/rows/{v}") if b.startswith("bucket=")}
    assert named == held


def test_line_numbers_do_not_depend_on_splits(spark):
    landing = streams.workspace(spark, "logs")
    lines = {"job1": ["start", "", "ERROR a  ", "  ", "ERROR b", "ERROR a"] * 300, "job2": ["x" * 50_000, "FAILED z", ""], "job3": [""]}
    for job, texts in lines.items():
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string").coalesce(1).orderBy("i")
        rows.select("value").write.text(f"{landing}/{job}")
    expected = sorted((job, at, text) for job, texts in lines.items() for at, text in enumerate(texts) if text.strip())
    job = F.regexp_extract(F.col("_metadata.file_path"), r"/(job\d)/", 1)
    seen = []
    for size in ("3000", "20000", "128m"):
        with streams._setting(spark, "spark.sql.files.maxPartitionBytes", size), streams._setting(spark, "spark.sql.files.openCostInBytes", "1"):
            logs = readers.read_logs(spark, f"{landing}/*", job)
            seen.append(sorted((r["job_id"], r["ord"], r["line"]) for r in logs.collect()))
    assert seen == [expected] * 3
    found = streams.run_errors(readers.read_log_stream(spark, f"{landing}/*", job), streams.workspace(spark, "e"))
    assert plain(found.select("job_id", "line", "ord", "rank")) == plain(ops.log_errors(logs).select("job_id", "line", "ord", "rank"))
    assert {(r["job_id"], r["line"], r["ord"]) for r in found.collect()} == {("job1", "ERROR a", 2), ("job1", "ERROR b", 4), ("job2", "FAILED z", 1)}


def test_bundles_hold_whole_logs_of_many_jobs(spark):
    rows = [(job, at, text) for job in range(200) for at, text in enumerate(["start", " ", f"ERROR a\t{job}", "", "FAILED b", "ERROR c " + "x" * 300])]
    landing = streams.workspace(spark, "logs")
    writers.write_log_bundles(spark.createDataFrame(rows, "job_id long, ord long, line string").repartition(5), landing)
    files = [n for n in folders.children(spark, landing) if n.startswith("part-")]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    expected = sorted((str(job), at, text) for job, at, text in rows if text.strip())
    for size in ("1000", "128m"):
        with streams._setting(spark, "spark.sql.files.maxPartitionBytes", size), streams._setting(spark, "spark.sql.files.openCostInBytes", "1"):
            logs = readers.read_log_bundles(spark, landing)
            assert sorted((r["job_id"], r["ord"], r["line"]) for r in logs.collect()) == expected
    found = streams.run_errors(readers.read_log_bundle_stream(spark, landing), streams.workspace(spark, "e"))
    assert plain(found.select("job_id", "line", "ord", "rank")) == plain(ops.log_errors(logs).select("job_id", "line", "ord", "rank"))


def test_old_error_lines_do_not_come_back(spark):
    folder, landing = streams.workspace(spark, "e"), streams.workspace(spark, "l")
    schema = "job_id string, ord long, line string"
    everything = []
    for batch in range(3):
        rows = [("j", batch * 100 + i, f"ERROR {(batch * 17 + i) % 40}") for i in range(30)] + [("j", batch * 100 + 50, "ERROR 0 ")]
        everything += rows
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        got = streams.run_errors(spark.readStream.schema(schema).parquet(landing), folder)
        assert plain(got.select("line", "ord", "rank")) == plain(ops.log_errors(spark.createDataFrame(everything, schema)).select("line", "ord", "rank"))
    assert got.count() == 20 and got.filter("line = 'ERROR 0'").count() == 0


def test_progress_drops_late_lines_only(spark):
    folder, landing = streams.workspace(spark, "p"), streams.workspace(spark, "l")
    schema = "job_id long, at timestamp, ord long, line string"

    def run(*rows):
        made = [(j, t, o, f"PROGRESS {x}") for j, t, o, x in rows]
        spark.createDataFrame(made, "job_id long, at string, ord long, line string").withColumn("at", F.col("at").cast("timestamp")).write.mode("append").parquet(landing)
        out = streams.run_progress(spark.readStream.schema(schema).parquet(landing), folder)
        return {r["job_id"]: (r["phase"], r["found_count"], r["total_count"]) for r in out.collect()}

    assert run((1, "2024-01-01 00:00", 1, "phase=a found=3"), (2, "2024-01-01 00:00", 1, "found=x")) == {1: ("a", 3, 0), 2: ("waiting", 0, 0)}
    assert run((1, "2024-01-05 00:00", 5, "total=9 found=8"))[1] == ("a", 8, 9)
    # out of order within the delay: counts by its place
    assert run((1, "2024-01-02 00:00", 4, "phase=b found=5"))[1] == ("b", 8, 9)
    assert run((3, "2024-02-01 00:00", 1, "phase=z"))[3] == ("z", 0, 0)
    assert run((1, "2024-02-01 00:00", 9, "found=10"), (2, "2024-01-02 00:00", 99, "phase=late"))[2] == ("waiting", 0, 0)
    assert run((4, "2024-02-01 00:00", 1, "phase=q"))[1] == ("b", 10, 9)


def test_snapshots_apply_when_complete_and_in_order(spark, sf_dir, monkeypatch):
    local = diff.payload_from_rows(view(spark, sf_dir, "items"), order="row_number").limit(60)
    local = spark.createDataFrame(local.collect(), local.schema)
    one, two = streams.with_marker(local, 1), streams.with_marker(local.filter("row_number % 2 = 0"), 2)
    empty, folder = local.drop("supplier_slug", "row_number").limit(0), streams.workspace(spark, "d")
    both = one.unionByName(two)
    first = "snapshot = 1 AND (id IS NULL OR row_number % 3 > 0)"
    landing = streams.workspace(spark, "s")
    both.filter(first).write.mode("append").parquet(landing)

    def run():
        return streams.run_diff(spark.readStream.schema(both.schema).parquet(landing), empty, folder, order="row_number")

    assert run().count() == 0  # the marker is there, a third of the rows is not
    both.filter(f"NOT ({first})").write.mode("append").parquet(landing)
    merge, calls = KeyedTable.merge, []

    def fails(self, version, *args, **kwargs):
        merge(self, version, *args, **kwargs)
        calls.append(version)
        if calls == [1]:
            raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "merge", fails)
    with pytest.raises(Exception, match="lost"):
        run()
    plan = run()
    counts = {(r["snapshot"], r["action"]): r["count"] for r in plan.groupBy("snapshot", "action").count().collect()}
    half = local.filter("row_number % 2 = 0").count()
    gone = local.filter("row_number % 2 = 1").count()
    ended = local.filter("row_number % 2 = 1 AND status <> 'INACTIVE'").join(two.select("supplier_slug").distinct(), "supplier_slug", "left_semi").count()
    assert calls == [1, 1, 2] and counts[(1, "create")] == 60 and counts.get((2, "inactivate"), 0) == ended
    assert counts[(2, "unchanged")] >= half and half + gone == 60
    # an older snapshot that completes after a newer one is superseded, an empty one ends everything it owns
    streams.with_marker(local, 0).write.mode("append").parquet(landing)
    assert run().filter("snapshot = 0").count() == 0
    late = streams.with_marker(local.limit(1).withColumn("name", F.lit("new")), 3)
    late.write.mode("append").parquet(landing)
    assert run().filter("snapshot = 3 AND action = 'update'").count() == 1
    assert run().filter("snapshot = 3 AND action = 'create'").count() == 0


def test_one_row_per_key_with_ties_and_nulls(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m"), ("b", None, "z"), ("b", 0, "w"), ("c", None, "q"), ("c", None, "q")]
    df = spark.createDataFrame(rows, "k string, ord long, v string").withColumn("m", F.create_map(F.lit("a"), F.lit("b"))).repartition(4)
    for pick, expected in ((identity.latest_per_key, {"a": "y", None: "n", "b": "w", "c": "q"}), (identity.first_per_key, {"a": "x", None: "m", "b": "w", "c": "q"})):
        got = pick(df, ["k"], "ord", "copies", ties=("v",)).collect()
        assert {r["k"]: r["v"] for r in got} == expected and len(got) == 4
        assert {r["k"]: r["copies"] for r in got} == {"a": 3, None: 2, "b": 2, "c": 2} and got[0].__fields__ == ["k", "ord", "v", "m", "copies"]
        assert len(pick(df, ["k"], "ord").collect()) == 4


def test_the_last_row_of_an_id_counts_before_the_limit(spark, sf_dir):
    row = diff.payload_from_rows(view(spark, sf_dir, "items"), order="row_number").limit(1)
    rows = [row.withColumns({"id": F.lit(i), "row_number": F.lit(n).cast("bigint"), "name": F.lit(f"{i}{n}")}) for i, n in (("b", 2), ("a", 9), ("a", 3), ("c", 1))]
    feed = rows[0]
    for other in rows[1:]:
        feed = feed.unionByName(other)
    plan = diff.catalog_plan(feed.repartition(4), remote_products(spark, sf_dir).limit(0), limit=2, order="row_number").collect()
    assert {r["id"]: r["action"] for r in plan} == {"a": "create", "b": "create"}
    assert '"name":"a9"' in next(r["payload"] for r in plan if r["id"] == "a")
