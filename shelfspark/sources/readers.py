"""Readers.  Schemas are explicit, so no file is read twice to guess its types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfspark.functions.text import strip
from shelfspark.functions.urls import without_query
from shelfspark.operators.skew import join_checked, landed, with_sequence
from shelfspark.schema import (
    IMPORT_COLUMNS, LOG_EVENT_SCHEMA, MANIFEST_SCHEMA, PAGE_BUNDLE_SCHEMA, REMOTE_CATEGORY_SCHEMA, REMOTE_PAGE_SCHEMA, REMOTE_PRODUCT_STRUCT,
    STATE_SCHEMA, SUPPLIER_CONFIG_STRUCT, import_row_schema, product_schema,
)


def read_import_csv(spark: SparkSession, path: str) -> DataFrame:
    """Import rows with `row_number` (2 for the first data row, in file order)."""
    rows = (
        spark.read.schema(import_row_schema()).option("header", True).option("multiLine", True)
        .option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)
        .na.fill("").withColumns({"_file": F.col("_metadata.file_path"), "_at": F.monotonically_increasing_id()})
    )
    # the position is fixed before the global numbering shuffles the rows
    numbered = with_sequence(landed(rows), [F.col("_file"), F.col("_at")], "row_number", start=2)
    return numbered.select("row_number", *IMPORT_COLUMNS)


def read_products_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Exported product records; a malformed line fails the read, blank lines are skipped.

    A field outside the record layout also fails: it is kept by the variant reader and
    checked against the schema.
    """
    known = [f.name for f in product_schema()]
    lines = spark.read.text(path).filter(F.trim("value") != "")
    extra = F.array_except(F.json_object_keys("value"), F.array(*[F.lit(k) for k in known]))
    checked = F.when(F.size(extra) > 0, F.raise_error(F.concat(F.lit("unknown product fields: "), F.array_join(extra, ", ")))) \
        .otherwise(F.col("value"))
    parsed = lines.select(F.from_json(checked, product_schema(), {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")


def read_remote_products(spark: SparkSession, path: str) -> DataFrame:
    """A whole-array JSON snapshot of the remote catalogue."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.explode(F.from_json("value", f"array<{REMOTE_PRODUCT_STRUCT}>", {"mode": "FAILFAST"})).alias("p")).select("p.*")


def read_remote_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed result pages of the remote catalogue, one JSON object each, as one product list."""
    return spark.read.schema(REMOTE_PAGE_SCHEMA).json(path).select(F.explode("products").alias("p")).select("p.*")


def read_remote_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REMOTE_CATEGORY_SCHEMA).option("multiLine", True).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed HTML snapshots, one file per URL."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("snapshot_name"), F.col("value").alias("html"))


def read_page_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Landed HTML snapshots, many to a file (writers.write_page_bundles): a crawl of any size is few files."""
    return spark.read.schema(PAGE_BUNDLE_SCHEMA).json(path)


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """All <loc> entries of plain or gzipped sitemaps, with whether the entry has an image."""
    entries = spark.read.format("xml").option("rowTag", "url").schema("loc string, `image:image` string, image string").load(path)
    return entries.select(strip(F.col("loc")).alias("url"), F.coalesce("image:image", "image").isNotNull().alias("has_image"))


def read_sitemap_index(spark: SparkSession, index: str, folder: str) -> DataFrame:
    """Entries of all sitemaps an index names, from the folder they were landed in under their own names.

    An index is short by its format (50 000 names at most), so its names form one path list.
    """
    listed = spark.read.format("xml").option("rowTag", "sitemap").schema("loc string").load(index)
    names = [r["name"] for r in listed.select(F.regexp_extract(strip(F.col("loc")), r"([^/?#]+)[?#]?[^/]*$", 1).alias("name")).distinct().collect()]
    entries = spark.read.format("xml").option("rowTag", "url").schema("loc string, `image:image` string, image string")
    found = entries.load([f"{folder.rstrip('/')}/{name}" for name in names if name]) if any(names) else spark.createDataFrame(
        [], "loc string, `image:image` string, image string")
    return found.select(strip(F.col("loc")).alias("url"), F.coalesce("image:image", "image").isNotNull().alias("has_image"))


def sitemap_products(entries: DataFrame, base_url: str) -> DataFrame:
    """Image-bearing entries of the site: a product discovery fallback."""
    url = without_query(F.col("url"))
    return entries.filter("has_image").select(url.alias("url")).filter(F.col("url").startswith(base_url.rstrip("/"))).distinct()


def read_configs(spark: SparkSession, path: str, inline: str = "") -> DataFrame:
    """Supplier configurations: {suppliers: [...]}, one object, or a bare list.

    A readable inline JSON text wins over the files.
    """
    files = spark.read.text(path, wholetext=True)
    if inline:
        text = F.coalesce(F.when(F.try_parse_json(F.lit(inline)).isNotNull(), F.lit(inline)), F.col("value"))
        files = files.select(text.alias("value"))
    return parse_configs(files)


def parse_configs(texts: DataFrame) -> DataFrame:
    """Configuration rows of JSON texts in a `value` column, whichever shape each has."""
    wrapped = F.from_json("value", f"suppliers array<{SUPPLIER_CONFIG_STRUCT}>")["suppliers"]
    single = F.from_json("value", SUPPLIER_CONFIG_STRUCT)
    bare = F.when(F.trim("value").startswith("["), F.from_json("value", f"array<{SUPPLIER_CONFIG_STRUCT}>"))
    rows = F.coalesce(bare, wrapped, F.when(single["supplier_slug"].isNotNull(), F.array(single)))
    return texts.select(F.explode(rows).alias("c")).select("c.*").withColumns({
        "catalog_update_policy": F.coalesce("catalog_update_policy", F.lit("delete_missing")),
        "archived": F.coalesce("archived", F.lit(False)),
    })


def read_manifest(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(MANIFEST_SCHEMA).json(path)


def _raw_logs(reader, path: str, job: Column | None, line: Column | None = None) -> DataFrame:
    """Lines as scanned, with their file and the block it was read in; by default a file is named after its job."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[A-Za-z]+)*$", 1)
    return reader.text(path).select(
        (name if job is None else job).alias("job_id"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), (F.col("value") if line is None else line).alias("line"))


def _bundled() -> tuple[Column, Column]:
    """(job, line) of a line in a bundle: the job stands before the first tab."""
    return F.substring_index("value", "\t", 1), F.expr(r"substring(value, locate('\t', value) + 1)")


def numbered_lines(raw: DataFrame) -> DataFrame:
    """(job_id, ord, line) of scanned log lines, blank ones dropped; `ord` is the line's number in its job's log.

    A file holds one job's log, or those of several jobs one after the other.  The number does not depend on how
    files are split or packed into tasks, nor on other files, so it is the same in batch and stream and
    after a restart.  Lines are landed with their position in the scan; one row per job and block then says how
    many lines of the job precede the block in its file.
    """
    scanned = landed(raw.withColumn("_at", F.monotonically_increasing_id()), "log-lines")
    earlier = Window.partitionBy("file", "job_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = scanned.groupBy("file", "job_id", "block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_lines")).select(
        "file", "job_id", "block", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))
    return join_checked(scanned.filter(F.trim("line") != ""), blocks, ["file", "job_id", "block"], "inner").select(
        "job_id", (F.col("_before") + F.col("_at") - F.col("_first")).alias("ord"), "line")


def read_logs(spark: SparkSession, path: str, job: Column | None = None) -> DataFrame:
    """Non-blank log lines (job_id, ord, line) of landed text files, one file per job."""
    return numbered_lines(_raw_logs(spark.read, path, job))


def read_log_bundles(spark: SparkSession, path: str) -> DataFrame:
    """The same rows from files that each hold the logs of many jobs (writers.write_log_bundles)."""
    return numbered_lines(_raw_logs(spark.read, path, *_bundled()))


def read_log_bundle_stream(spark: SparkSession, path: str) -> DataFrame:
    """Bundles as a stream, to be numbered batch by batch like read_log_stream."""
    return _raw_logs(spark.readStream, path, *_bundled())


def read_log_stream(spark: SparkSession, path: str, job: Column | None = None) -> DataFrame:
    """The same files as a stream; a batch gets its numbers from `numbered_lines`.  A file arrives whole."""
    return _raw_logs(spark.readStream, path, job)


def read_log_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Log events as a log service hands them out, one JSON object each; blank messages are dropped."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(LOG_EVENT_SCHEMA).json(path).select(
        "job_id", F.col("timestamp").alias("at"), F.col("sequence").alias("ord"), F.col("message").alias("line")).filter(F.trim("line") != "")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """Run states as appended by writers.append_state."""
    return spark.read.schema(STATE_SCHEMA).json(path)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
