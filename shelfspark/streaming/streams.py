"""Structured Streaming variants of the log, manifest and diff jobs.

Each job is a stateless or watermarked query whose batches are merged into a `KeyedTable` under the
batch's own number.  A batch that is repeated after a failure replaces what it wrote before, a
restart goes on from the checkpoint, and a batch rewrites only the buckets of its keys.  Every batch is
aggregated by key, map side first, before it meets the table, so a hot job or URL is one row there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.text import has_text
from shelfspark.operators import operations as ops
from shelfspark.operators.diff import catalog_plan
from shelfspark.operators.skew import landed, scratch_folder
from shelfspark.sources import folders, readers
from shelfspark.streaming.state import BUCKETS, KeyedTable

# Streaming state of progress lines is kept this long after the newest line; older lines are dropped as late.
STATE_DELAY = "7 days"
# Event-time length of one state row per job.
STATE_WINDOW = "1 day"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return scratch_folder(spark, f"stream-{name}")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds while a query starts; the query keeps it, the session gets its own back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def drain(stream: DataFrame, folder: str, apply: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run what has arrived since the checkpoint through `apply(batch, number)`."""
    with _setting(stream.sparkSession, _PROVIDER, _ROCKS):
        query = (
            stream.writeStream.outputMode(mode).foreachBatch(apply)
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
    query.awaitTermination()


# ---------------------------------------------------------------- live progress

def _marker(field: str):
    """(order, value) of a field's marker; null for lines without one."""
    return F.when(F.col(field).isNotNull(), F.struct(F.col("ord"), F.col(field).alias("value")))


def progress_stream(lines: DataFrame, delay: str = STATE_DELAY, window: str = STATE_WINDOW) -> DataFrame:
    """Newest marker per field, job and event-time window (update mode), from job_id, at, ord and line.

    The state holds one row per job and window that is not older than `delay` before the newest line
    seen; a line older than that is dropped, a line out of order within it counts by its `ord`.
    """
    staged = lines.select("job_id", "at", "ord", *[c.alias(n) for n, c in ops.progress_columns(F.col("line")).items()])
    marked = staged.select("job_id", "at", *[_marker(f).alias(f) for f in ops.PROGRESS_FIELDS])
    return marked.withWatermark("at", delay).groupBy("job_id", F.window("at", window).alias("_window")).agg(
        *[F.max(f).alias(f) for f in ops.PROGRESS_FIELDS])


def progress_table(spark: SparkSession, folder: str, job: T.DataType, buckets: int = BUCKETS) -> KeyedTable:
    marker = T.StructType().add("ord", "long").add("value", "string")
    schema = T.StructType([T.StructField("job_id", job), *[T.StructField(f, marker) for f in ops.PROGRESS_FIELDS]])
    return KeyedTable(spark, f"{folder}/progress", schema, ["job_id"], buckets)


def run_progress(lines: DataFrame, folder: str, delay: str = STATE_DELAY, buckets: int = BUCKETS) -> DataFrame:
    """Drain log lines; the latest progress per job, as `operations.log_progress` gives it without its product count."""
    spark = lines.sparkSession
    table = progress_table(spark, folder, lines.schema["job_id"].dataType, buckets)

    def newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("job_id").agg(*[F.max(f).alias(f) for f in ops.PROGRESS_FIELDS])

    def apply(batch: DataFrame, number: int) -> None:
        # windows of a job are updated again and again; the newest marker of all of them is the same each time
        table.merge(number, newest(batch), lambda old, delta: newest(old.unionByName(delta)))

    drain(progress_stream(lines, delay), folder, apply, "update")
    counts = [F.coalesce(F.col(f"{f}.value").try_cast("bigint"), F.lit(0)).alias(f"{f}_count") for f in ops.PROGRESS_FIELDS if f != "phase"]
    return table.read().select("job_id", F.coalesce("phase.value", F.lit("waiting")).alias("phase"), *counts)


# ---------------------------------------------------------------- error lines

def run_errors(logs: DataFrame, folder: str, keep: int = 20, buckets: int = BUCKETS) -> DataFrame:
    """Drain log files (readers.read_log_stream) or log events; the last `keep` distinct error lines per job.

    Equals `operations.log_errors` over all files so far: the table holds the first place of every
    distinct error line of a job, as a line that comes again must not count as new, however old it is.
    Nothing stays in the stream's own state.
    """
    spark = logs.sparkSession
    schema = T.StructType().add("job_id", logs.schema["job_id"].dataType).add("line", "string").add("ord", "long")
    table = KeyedTable(spark, f"{folder}/errors", schema, ["job_id", "line"], buckets)

    def first(rows: DataFrame) -> DataFrame:
        return rows.groupBy("job_id", "line").agg(F.min("ord").alias("ord"))

    def apply(batch: DataFrame, number: int) -> None:
        lines = readers.numbered_lines(batch) if "block" in batch.columns else batch
        table.merge(number, ops.first_error_lines(lines), lambda old, delta: first(old.unionByName(delta)))

    drain(logs, folder, apply)
    return ops.last_lines(table.read(), keep)


# ---------------------------------------------------------------- latest fetch

def latest_fetch_rows(manifest: DataFrame) -> DataFrame:
    """Per URL the newest fetch, as `coverage.latest_fetch` picks it, and the number of fetches."""
    last = F.max(F.struct("ord", "snapshot_path", "status_code")).alias("last")
    return manifest.groupBy("url").agg(last, F.count(F.lit(1)).alias("fetches"))


def run_latest_fetch(manifest: DataFrame, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """Drain manifest lines in any order; the newest fetch per URL."""
    last = T.StructType().add("ord", "long").add("snapshot_path", "string").add("status_code", "integer")
    schema = T.StructType().add("url", "string").add("last", last).add("fetches", "long")
    table = KeyedTable(manifest.sparkSession, f"{folder}/latest", schema, ["url"], buckets)

    def both(old: DataFrame, delta: DataFrame) -> DataFrame:
        return old.unionByName(delta).groupBy("url").agg(F.max("last").alias("last"), F.sum("fetches").alias("fetches"))

    drain(manifest, folder, lambda batch, number: table.merge(number, latest_fetch_rows(batch), both))
    return table.read().select("url", "last.status_code", "last.snapshot_path", "last.ord", "fetches")


# ---------------------------------------------------------------- incremental diff

def run_diff(snapshots: DataFrame, initial_remote: DataFrame, folder: str, supplier: str = "supplier_slug",
             order: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Diff every complete payload snapshot with the catalogue that the previous one left.

    `snapshots` has payload columns, the supplier, `snapshot` (a rising number) and `snapshot_rows`.  A
    snapshot's rows may come in any number of batches, and several snapshots in one; it is complete
    with its marker, a row without id whose `snapshot_rows` says how many rows belong to it.  Until
    then its rows wait in `pending`.  Complete snapshots are applied in rising order: the plan is
    stored, then the buckets of created, updated and ended products are rewritten under the snapshot's
    number.  A snapshot that completes after a later one was applied is superseded and left out.
    The initial catalogue counts only where the folder holds none yet.  Returns the plans, with `snapshot`.
    """
    spark = snapshots.sparkSession
    table = KeyedTable(spark, f"{folder}/catalogue", initial_remote.schema, ["id"], buckets)
    if not table.versions():
        table.merge(-1, initial_remote, lambda _, rows: rows, batch=-1)
    pending, schema = f"{folder}/pending", snapshots.schema

    def waiting(number: int) -> DataFrame | None:
        """Rows that have come and are not yet removed, with the batch they came in."""
        names = [n for n in folders.children(spark, pending) if n.startswith("batch=") and int(n[6:]) <= number]
        held = [f"{pending}/{n}" for n in names if any(c.startswith("snapshot=") for c in folders.children(spark, f"{pending}/{n}"))]
        return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).option("basePath", pending).parquet(*held) if held else None

    def applied(old: DataFrame, delta: DataFrame) -> DataFrame:
        ended = old.join(delta.filter("action = 'inactivate'").select("id"), "id", "left_semi").withColumn("status", F.lit("INACTIVE"))
        sent = delta.filter("action <> 'inactivate'").select(F.from_json("payload", initial_remote.schema).alias("p")).select("p.*")
        return old.join(delta.select("id"), "id", "left_anti").unionByName(ended).unionByName(sent)

    def diff(rows: DataFrame, number: int, batch: int) -> None:
        local = rows.filter(has_text(F.col("id"))).drop("snapshot", "snapshot_rows", "batch")
        plan = catalog_plan(local, table.read(before=number), supplier, order=order)
        plan.write.mode("overwrite").parquet(f"{folder}/plan/snapshot={number}")
        stored = spark.read.schema(plan.schema).parquet(f"{folder}/plan/snapshot={number}")
        table.merge(number, stored.filter("action <> 'unchanged'").select("id", "action", "payload"), applied, batch)

    def apply(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("snapshot").parquet(f"{pending}/batch={number}")
        rows = waiting(number)
        if rows is None:
            return
        seen = rows.groupBy("snapshot").agg(
            F.count(F.when(has_text(F.col("id")), 1)).alias("rows"), F.max("snapshot_rows").alias("announced"), F.max("batch").alias("last"))
        done = {v for v in table.versions() if v >= 0 and table.commit(v)[1] < number}
        for found in sorted(seen.filter("rows = announced").collect(), key=lambda r: r["snapshot"]):  # open snapshots only
            snapshot = found["snapshot"]
            if found["last"] < number:  # applied in an earlier batch, which has been committed
                for name in folders.children(spark, pending):
                    folders.remove(spark, f"{pending}/{name}/snapshot={snapshot}")
            elif not any(v > snapshot for v in done):
                diff(rows.filter(F.col("snapshot") == snapshot), snapshot, number)

    drain(snapshots, folder, apply)
    plan = "supplier_slug string, id string, action string, payload string, origin string".replace("supplier_slug", supplier)
    return spark.read.schema(f"{plan}, snapshot long").parquet(f"{folder}/plan") if folders.exists(spark, f"{folder}/plan") \
        else spark.createDataFrame([], f"{plan}, snapshot long")


def with_marker(rows: DataFrame, snapshot: int) -> DataFrame:
    """Rows of one whole snapshot, and its marker."""
    rows = landed(rows.withColumns({"snapshot": F.lit(snapshot).cast("bigint"), "snapshot_rows": F.lit(None).cast("bigint")}), "snapshot")
    marker = rows.agg(F.count(F.lit(1)).alias("snapshot_rows")).select(
        *[F.col(f.name) if f.name == "snapshot_rows" else (F.lit(snapshot) if f.name == "snapshot" else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in rows.schema.fields])
    return rows.unionByName(marker)
