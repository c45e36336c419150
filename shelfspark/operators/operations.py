"""Run, job and log analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.text import blank_to_null, first_non_empty, has_text, text
from shelfspark.operators.identity import latest_per_key
from shelfspark.operators.skew import side_by_side

# Job states, log markers and messages.
ACTIVE_STATES = ["queued", "running"]
PARSED = r"\bParsed product\b"
ERROR_LINE = r"(?i)\b(ERROR|CRITICAL|Traceback|Exception|FAILED)\b"
PROGRESS = r"\bPROGRESS\s+(.+)$"
RESULT_MARKER = r"RESULT_RUN_SUMMARY\s+(\{.*\})$"
PROGRESS_FIELDS = ["phase", "found", "processed", "scraped", "total"]
STOPPED_MESSAGE = "Stopped by user."
RECOVERED_MESSAGE = "Recovered stale running job during service startup."
FAILED_MESSAGE = "The automated job failed before it could complete."
DEFAULT_MINIMUM, DEFAULT_PERCENT = 10, 5.0


def recent_jobs(jobs: DataFrame, limit: int = 50, supplier: str | None = None) -> DataFrame:
    chosen = jobs if supplier is None else jobs.filter(F.col("supplier_slug") == supplier)
    return chosen.orderBy(F.col("id").desc()).limit(limit)


def latest_job(jobs: DataFrame) -> DataFrame:
    rest = [c for c in jobs.columns if c != "supplier_slug"]
    return jobs.groupBy("supplier_slug").agg(F.max_by(F.struct(*rest), "id").alias("j")).select("supplier_slug", "j.*")


def job_conflicts(requests: DataFrame, jobs: DataFrame) -> DataFrame:
    """Each request with `accepted`: false while the same supplier and type is active."""
    active = jobs.filter(F.col("status").isin(ACTIVE_STATES)).groupBy("supplier_slug", "job_type").agg(F.max("id").alias("active_job"))
    return requests.join(active, ["supplier_slug", "job_type"], "left").withColumn("accepted", F.col("active_job").isNull())


def stale_jobs(jobs: DataFrame) -> DataFrame:
    """What a restart makes of jobs still marked running."""
    stopped = has_text(F.col("stop_requested_at"))
    message = first_non_empty(F.col("error_message"), F.when(stopped, STOPPED_MESSAGE).otherwise(RECOVERED_MESSAGE))
    return jobs.filter("status = 'running'").select(
        "id", "supplier_slug", F.when(stopped, "stopped").otherwise("failed").alias("status"), message.alias("error_message"),
        F.when(stopped, F.coalesce("exit_code", F.lit(0))).otherwise(F.col("exit_code")).alias("exit_code"))


def scheduler_state(events: DataFrame) -> DataFrame:
    """Latest scheduler row per supplier; the enqueue time survives events without one."""
    order = F.col("updated_at")
    enqueued = blank_to_null(F.col("last_enqueued_at"))
    return events.groupBy("supplier_slug").agg(
        *[F.max_by(c, order).alias(c) for c in ("next_run_at", "last_status", "last_error")],
        text(F.max_by(enqueued, F.when(enqueued.isNotNull(), order))).alias("last_enqueued_at"),
        F.max(order).alias("updated_at"))


def merge_configs(runtime: DataFrame, defaults: DataFrame) -> DataFrame:
    """Runtime rows stay; defaults add unknown suppliers."""
    added = defaults.join(runtime.select("supplier_slug").distinct(), "supplier_slug", "left_anti")
    return runtime.withColumn("origin", F.lit("runtime")).unionByName(added.withColumn("origin", F.lit("default")))


def alert_reason(jobs: DataFrame) -> DataFrame:
    """Why a scheduled run deserves an alert; '' when it does not.

    Needs requested_by, status, error_message, sync_error, failure_count, raw_record_count,
    minimum_failures and failure_rate_percent.
    """
    failures = F.coalesce("failure_count", F.lit(0))
    processed = F.coalesce("raw_record_count", F.lit(0))
    minimum = F.greatest(F.lit(1), F.coalesce(F.nullif("minimum_failures", F.lit(0)), F.lit(DEFAULT_MINIMUM)))
    percent = F.greatest(F.lit(0.0), F.coalesce(F.nullif("failure_rate_percent", F.lit(0.0)), F.lit(DEFAULT_PERCENT)))
    rate = failures / F.greatest(processed, failures, F.lit(1)) * 100
    total = F.greatest(processed, failures)
    numbers = F.concat(
        failures.cast("string"), F.lit(" product errors out of "), total.cast("string"), F.lit(" processed ("),
        F.replace(F.format_number(rate, 1), F.lit(","), F.lit("")), F.lit("%)."))
    reason = (
        F.when(F.col("requested_by") != "scheduler", "")
        .when(F.col("status") == "failed", first_non_empty(F.col("error_message"), F.lit(FAILED_MESSAGE)))
        .when(has_text(F.col("sync_error")), F.concat(F.lit("Sync failed: "), F.col("sync_error")))
        .when((failures >= minimum) & (rate >= percent), numbers).otherwise("")
    )
    return jobs.withColumn("alert_reason", reason)


def progress_columns(line: Column) -> dict[str, Column]:
    """Value of every progress field a log line carries, null for the others."""
    fields = F.regexp_extract(line, PROGRESS, 1)
    return {f: blank_to_null(F.regexp_extract(fields, rf"(?:.*\b|\b){f}=(\S+)", 1)) for f in PROGRESS_FIELDS}


def progress_aggregates() -> list[Column]:
    """Per field the last marker that carries it; batch and streaming share these."""
    out = []
    for field in PROGRESS_FIELDS:
        last = F.max_by(field, F.when(F.col(field).isNotNull(), F.col("ord")))
        out.append(F.coalesce(last, F.lit("waiting")).alias("phase") if field == "phase"
                   else F.coalesce(last.try_cast("bigint"), F.lit(0)).alias(f"{field}_count"))
    return out


def log_progress(lines: DataFrame) -> DataFrame:
    """Latest progress and number of parsed products per job."""
    staged = lines.select("job_id", "ord", F.col("line").rlike(PARSED).alias("parsed"),
                          *[c.alias(n) for n, c in progress_columns(F.col("line")).items()])
    return staged.groupBy("job_id").agg(*progress_aggregates(), F.count_if("parsed").alias("parsed_products"))


def first_error_lines(lines: DataFrame) -> DataFrame:
    """(job_id, line, ord): distinct error lines per job, each at its first place."""
    return (
        lines.filter(F.trim("line") != "").filter(F.col("line").rlike(ERROR_LINE))
        .groupBy("job_id", F.regexp_replace("line", r"\s+$", "").alias("line")).agg(F.min("ord").alias("ord"))
    )


def last_lines(first: DataFrame, keep: int = 20) -> DataFrame:
    """The last `keep` of a job's lines, newest first in `rank`."""
    rank = F.row_number().over(Window.partitionBy("job_id").orderBy(F.col("ord").desc(), "line"))
    return first.withColumn("rank", rank).filter(F.col("rank") <= keep)


def log_errors(lines: DataFrame, keep: int = 20) -> DataFrame:
    """The last distinct error lines per job, each at its first occurrence.

    Lines are filtered and deduplicated by partial aggregation first; the top-N per job
    then uses a rank filter, which Spark also applies before the shuffle.
    """
    return last_lines(first_error_lines(lines), keep)


def last_result(lines: DataFrame) -> DataFrame:
    """Last result marker per job whose payload is a JSON object."""
    payload = F.regexp_extract("line", RESULT_MARKER, 1)
    valid = lines.select("job_id", "ord", payload.alias("payload")).filter(
        (F.col("payload") != "") & F.json_object_keys("payload").isNotNull())
    return valid.groupBy("job_id").agg(F.max_by("payload", "ord").alias("payload"), F.max("ord").alias("ord"))


def supplier_health(configs: DataFrame, states: DataFrame, summaries: DataFrame, reports: DataFrame,
                    jobs: DataFrame, scheduler: DataFrame, include_archived: bool = False) -> DataFrame:
    """One row per supplier; a missing side gives defaults.  Sides are latest-per-supplier."""
    chosen = configs if include_archived else configs.filter(~F.col("archived"))
    joined = chosen
    for side in (states, summaries, reports, latest_job(jobs).select(
            "supplier_slug", F.col("id").alias("latest_job_id"), F.col("status").alias("latest_job_status")), scheduler):
        joined = joined.join(side, "supplier_slug", "left")
    status = (
        F.when(F.coalesce("validation_performed", F.lit(False)) & (F.coalesce("validation_errors", F.lit(1)) == 0), "ok")
        .when(F.col("mode") == "scrape_only", "scraped").otherwise("error")
    )
    return joined.select(
        "supplier_slug", "enabled", "scraper_adapter", text(F.col("last_successful_run_at")).alias("last_successful_run_at"),
        F.coalesce("latest_job_id", F.lit(-1)).alias("latest_job_id"), text(F.col("latest_job_status")).alias("latest_job_status"),
        status.alias("last_run_status"), F.coalesce("product_count", F.lit(0)).alias("product_count"),
        F.coalesce("validation_errors", F.lit(0)).alias("validation_error_count"),
        F.coalesce("validation_warnings", F.lit(0)).alias("validation_warning_count"),
        text(F.col("next_run_at")).alias("next_run_at"))


def onboarding_stage(suppliers: DataFrame) -> DataFrame:
    """Stage of each supplier from its set-up checks and last runs."""
    c = F.col
    validated = c("has_summary") & c("validation_performed") & (c("validation_errors") == 0)
    synced = c("has_report") & ~c("sync_aborted") & (c("sync_errors") == 0)
    live = synced & validated & c("secret_present")
    stage = (
        F.when(~c("adapter_available") | ~c("scraper_exists"), "Config only")
        .when(~c("secret_present"), "Needs secret")
        .when(~c("transformer_exists") | ~c("fixtures_present") | ~c("tests_present"), "Implementation pending")
        .when(validated & ~synced, "Ready for sync").when(live, "Live").otherwise("Config created")
    )
    return suppliers.select("supplier_slug", "secret_present", "scraper_exists", stage.alias("stage"), live.alias("live"),
                            c("has_summary").alias("dry_run_seen"), validated.alias("validation_passed"), synced.alias("first_sync_passed"))


def dashboard_stats(stages: DataFrame) -> DataFrame:
    return stages.agg(
        F.count(F.lit(1)).alias("suppliers"), F.count_if("live").alias("live"), F.count_if("secret_present").alias("secrets_ready"),
        F.count_if(~F.col("live")).alias("need_attention"), F.count_if(~F.col("secret_present")).alias("missing_secrets"),
        F.count_if(~F.col("scraper_exists")).alias("code_pending"))


SCRAPE_MODES = ["scrape_only", "scrape_and_sync", "scrape_dry_run"]


_PLAN_COUNTERS = ["created_products", "updated_products", "unchanged_products", "inactivated_products"]
_CATEGORY_COUNTERS = ["created_categories", "updated_categories"]


def run_summary(products: DataFrame, failures: DataFrame, discovered: DataFrame, gate: DataFrame, corrections: DataFrame,
                plan_counts: DataFrame | None, mode: str, generated_at: str, dry_run: bool = False, supplier: str = "",
                checksum: DataFrame | None = None, warnings: DataFrame | None = None, remote: DataFrame | None = None) -> DataFrame:
    """One row: who ran, and product, failure, validation, correction and sync counters of the run.

    `checksum` is the catalogue's one-row fingerprint, `warnings` the coverage findings and
    `remote` the catalogue before the run.  Failures of the listing have no raw record.
    """
    def one(df: DataFrame | None, name: str) -> DataFrame:
        counted = F.count(F.lit(1)).alias(name)
        return df.agg(counted) if df is not None else gate.select(F.lit(0).cast("bigint").alias(name))

    raw = F.count_if(F.coalesce(F.col("stage"), F.lit("detail")) != "listing") if "stage" in failures.columns else F.count(F.lit(1))
    counters = [*_PLAN_COUNTERS, *_CATEGORY_COUNTERS]
    parts = [
        one(products, "product_count"), failures.agg(F.count(F.lit(1)).alias("failure_count"), raw.alias("_raw_failures")),
        discovered.agg(F.count_distinct("url").alias("discovered_product_url_count")), gate, one(corrections, "correction_count"),
        one(warnings, "warning_count"), one(remote, "old_catalog_products"),
        checksum.select("checksum") if checksum is not None else gate.select(F.lit("").alias("checksum")),
    ]
    if plan_counts is not None:
        known = [c for c in counters if c in plan_counts.columns]
        parts.append(plan_counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in known]))
    row = side_by_side(*parts)
    row = row.select("*", *[F.lit(0).cast("bigint").alias(c) for c in counters if c not in row.columns])
    aborted = F.lit(plan_counts is None and mode != "scrape_only") & ~F.col("is_valid")
    return row.select(
        F.lit(supplier).alias("supplier_slug"), F.lit(mode).alias("mode"), F.lit(generated_at).alias("generated_at"),
        F.lit(dry_run).alias("dry_run"), *[c for c in row.columns if c != "_raw_failures"],
        (F.col("product_count") + F.col("failure_count")).alias("covered_product_url_count"),
        (F.col("product_count") + F.col("_raw_failures")).alias("raw_record_count"), F.col("product_count").alias("interpreted_record_count"),
        F.lit(mode in SCRAPE_MODES).alias("scrape_performed"), F.lit(plan_counts is not None).alias("sync_performed"),
        aborted.alias("sync_aborted"), F.when(aborted, "validation_errors").otherwise("").alias("sync_reason"),
        (F.col("created_products") + F.col("updated_products")).alias("uploaded_products"))


# Error texts that a summary carries; the run's error file has all of them.
ERRORS_IN_SUMMARY = 20


def finding_messages(findings: DataFrame, duplicates: DataFrame, supplier: str = "supplier_slug") -> DataFrame:
    """(supplier, severity, message): one text per finding and per repeated id."""
    said = F.concat_ws(": ", "rule", F.coalesce("item_id", F.lit("")), F.nullif("value", F.lit("")))
    repeated = F.concat(F.lit("duplicate_item_id: "), F.col("item_id"), F.lit(" x"), F.col("copies").cast("string"))
    return findings.select(supplier, "severity", said.alias("message")).unionByName(
        duplicates.select(supplier, F.lit("error").alias("severity"), repeated.alias("message")))


def supplier_summary(
    products: DataFrame, failures: DataFrame, discovered: DataFrame, gate: DataFrame, corrections: DataFrame, messages: DataFrame,
    plan_counts: DataFrame | None, mode: str, generated_at: str, dry_run: bool = False, checksum: DataFrame | None = None,
    rows: DataFrame | None = None, remote: DataFrame | None = None, covered: DataFrame | None = None,
    output_paths: dict[str, str] | None = None, supplier: str = "supplier_slug",
) -> DataFrame:
    """One row per supplier of a run: counters, texts, output paths and the scrape, validation and sync stages.

    Every input has a supplier column; `discovered` has url, `remote` the catalogue before the run with the owner as
    supplier, `covered` (supplier, covered_product_url_count) overrides rows plus failures where it has a supplier.
    Counters are summed in one aggregation over stacked partial counts; rows of a hot supplier are counted where they lie.
    Suppliers are those with a product, a failure, a discovered URL or a gate.  `errors` holds the first
    `ERRORS_IN_SUMMARY` texts in text order, `error_count` counts all.
    """
    def count(df: DataFrame | None, *named) -> list[DataFrame]:
        return [] if df is None else [df.groupBy(supplier).agg(*[c.cast("bigint").alias(n) for n, c in named])]

    one = F.count(F.lit(1))
    raw = F.count_if(F.coalesce(F.col("stage"), F.lit("detail")) != "listing") if "stage" in failures.columns else one
    parts = [
        *count(products, ("product_count", one)), *count(failures, ("failure_count", one), ("_raw_failures", raw)),
        *count(discovered, ("discovered_product_url_count", F.count_distinct("url"))), *count(corrections, ("correction_count", one)),
        *count(remote, ("old_catalog_products", one)), *count(covered, ("_covered", F.max("covered_product_url_count"))),
        *count(rows, ("_images", F.count_if(F.col("Image") != "")), ("_rows", one)),
        gate.select(supplier, "row_count", "passed_row_count", "error_count", F.col("is_valid").cast("bigint").alias("_valid")),
    ]
    counters = [*_PLAN_COUNTERS, *_CATEGORY_COUNTERS]
    if plan_counts is not None:
        parts.append(plan_counts.select(supplier, *[c for c in counters if c in plan_counts.columns]))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    summed = [c for c in stacked.columns if c != supplier]
    row = stacked.groupBy(supplier).agg(*[F.sum(c).alias(c) for c in summed])
    known = {"product_count", "failure_count", "_raw_failures", "discovered_product_url_count", "correction_count", "old_catalog_products", "_images", "_rows",
             "row_count", "passed_row_count", "error_count", *counters}
    row = row.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") if c in summed else F.lit(0).cast("bigint") for c in known})
    row = row.withColumns({"is_valid": F.coalesce(F.col("_valid") == 1, F.lit(True)),
                           "covered_product_url_count": F.coalesce(*([F.col("_covered")] if covered is not None else []), F.col("_rows") + F.col("failure_count"))})
    # a few lines per supplier: the rank filter runs before the shuffle as well
    first = F.row_number().over(Window.partitionBy(supplier).orderBy("message"))
    texts = messages.filter("severity = 'error'").withColumn("_nth", first).filter(F.col("_nth") <= ERRORS_IN_SUMMARY)
    row = row.join(texts.groupBy(supplier).agg(F.sort_array(F.collect_list("message")).alias("errors")), supplier, "left")
    if checksum is not None:
        row = row.join(checksum.select(supplier, "checksum"), supplier, "left")
    number = lambda c: F.col(c).cast("string")
    warnings = F.array_compact(F.array(
        F.when(F.col("covered_product_url_count") < F.col("discovered_product_url_count"), F.concat(
            F.lit("not_fully_covered: "), number("covered_product_url_count"), F.lit(" of "), number("discovered_product_url_count"))),
        F.when(F.col("failure_count") > 0, F.concat(F.lit("failed_urls: "), number("failure_count"))),
        F.when(F.col("_images") == 0, F.lit("no_images"))))
    synced = F.col("is_valid") & F.lit(plan_counts is not None)
    aborted = ~F.col("is_valid") & F.lit(mode != "scrape_only")
    row = row.withColumns({
        "errors": F.coalesce("errors", F.array().cast("array<string>")), "warnings": warnings, "checksum": F.coalesce("checksum", F.lit("")) if checksum is not None else F.lit(""),
        "sync_performed": synced, "sync_aborted": aborted, "sync_reason": F.when(aborted, "validation_errors").otherwise(""),
        "uploaded_products": F.col("created_products") + F.col("updated_products"),
        "raw_record_count": F.col("product_count") + F.col("_raw_failures"), "interpreted_record_count": F.col("product_count")})
    c = F.col
    scrape = F.struct(F.lit(mode in SCRAPE_MODES).alias("performed"), *[c(n) for n in (
        "product_count", "failure_count", "discovered_product_url_count", "covered_product_url_count", "raw_record_count", "interpreted_record_count")])
    validation = F.struct(F.lit(True).alias("performed"), c("row_count"), c("passed_row_count"), c("error_count"), F.size("warnings").cast("bigint").alias("warning_count"), c("errors"), c("warnings"))
    sync = F.struct(c("sync_performed").alias("performed"), F.lit(dry_run).alias("dry_run"), c("sync_aborted").alias("aborted"), c("old_catalog_products"),
                    *[c(n) for n in counters], c("uploaded_products"), c("sync_reason").alias("reason"))
    paths = F.map_from_arrays(F.array(*map(F.lit, output_paths or [])).cast("array<string>"),
                              F.array(*[F.concat(F.lit(f"{p}/{supplier}="), c(supplier)) for p in (output_paths or {}).values()]).cast("array<string>"))
    return row.select(
        supplier, F.lit(mode).alias("mode"), F.lit(generated_at).alias("generated_at"), F.lit(dry_run).alias("dry_run"),
        *[c(n) for n in ("product_count", "failure_count", "discovered_product_url_count", "covered_product_url_count", "raw_record_count", "interpreted_record_count",
                         "row_count", "passed_row_count", "error_count", "is_valid", "correction_count", "checksum", "old_catalog_products", *counters,
                         "uploaded_products", "sync_performed", "sync_aborted", "sync_reason", "errors", "warnings")],
        paths.alias("output_paths"), F.struct(scrape.alias("scrape"), validation.alias("validation"), sync.alias("sync")).alias("stages"))


def latest_state(states: DataFrame) -> DataFrame:
    """The last good run of each supplier from the appended run states."""
    return latest_per_key(states, ["supplier_slug"], "generated_at", ties=("checksum",))
