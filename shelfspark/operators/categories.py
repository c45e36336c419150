"""Category ids, shortest unique names, and reconciliation with the remote catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.ids import category_id, short_hash
from shelfspark.functions.text import strip
from shelfspark.operators.skew import landed, salted_join

MAX_NAME = 64


def category_names(rows: DataFrame, supplier: str = "supplier_slug", path: str = "category_path",
                   compat_per_product: bool = False) -> DataFrame:
    """One row per category: id, path and the shortest unambiguous name.

    A name starts at the leaf and widens to the smallest path suffix no other path of the
    supplier ends with.  `compat_per_product` counts every product as its own path, so a
    category holding two products always keeps its full path.
    """
    source = F.when(F.coalesce(F.col(path), F.lit("")) == "", "Uncategorized").otherwise(F.col(path))
    paths = rows.groupBy(F.col(supplier), source.alias("path")).agg(F.count(F.lit(1)).alias("products"))
    segments = F.filter(F.transform(F.split("path", ">"), strip), lambda s: s != "")
    segments = F.when(F.size(segments) == 0, F.array(F.lit("Uncategorized"))).otherwise(segments)
    paths = paths.withColumn("segments", segments)

    suffixes = paths.select(
        supplier, "path", "products", F.explode(F.sequence(F.lit(1), F.size("segments"))).alias("width"), "segments"
    ).withColumn("suffix", F.array_join(F.slice("segments", -F.col("width"), F.col("width")), " > "))
    holders = F.sum("products") if compat_per_product else F.count(F.lit(1))
    unique = (
        suffixes.groupBy(supplier, "suffix")
        .agg(holders.alias("holders"), F.min("path").alias("path"), F.min("width").alias("width"))
        .filter("holders = 1")
        .groupBy(supplier, "path").agg(F.min("width").alias("width"))
    )
    wide = F.coalesce("width", F.size("segments"))
    suffix = F.array_join(F.slice("segments", -wide, wide), " > ")
    leaf = F.element_at("segments", -1)
    short = F.when(F.length(suffix) <= MAX_NAME, suffix).otherwise(
        F.when(F.length(leaf) <= MAX_NAME, leaf).otherwise(F.rtrim(F.substring(leaf, 1, MAX_NAME)))
    )
    named = paths.join(unique, [supplier, "path"], "left").select(supplier, "path", short.alias("short"))

    # Remaining clashes: the first path in order keeps the name, others get a hash suffix.
    owners = named.groupBy(supplier, "short").agg(F.min("path").alias("owner"))
    base = F.regexp_replace(F.substring("short", 1, MAX_NAME - 7), "[ -]+$", "")
    name = F.when(F.col("path") == F.col("owner"), F.col("short")).otherwise(
        F.concat(base, F.lit("-"), short_hash(F.col("path"), 6))
    )
    return named.join(owners, [supplier, "short"]).select(
        supplier, category_id(F.col("path"), F.col(supplier)).alias("id"), "path", name.alias("name")
    )


def reconcile_categories(local: DataFrame, remote: DataFrame, supplier: str = "supplier_slug") -> DataFrame:
    """Match by id, else by case-folded name, else create.

    Adds `remote_id` (alias target) and `action`: create / update / unchanged / alias.
    `remote` has id, name and ordinal; the last remote category of a name wins.
    """
    folded = F.lower(F.trim("name"))
    by_id = remote.select(F.col("id"), F.col("name").alias("name_by_id"), F.lit(True).alias("known"))
    by_name = (
        remote.filter("name <> ''").groupBy(folded.alias("folded"))
        .agg(F.max_by("id", "ordinal").alias("id_by_name"))
    )
    joined = (
        local.join(by_id, "id", "left").withColumn("folded", F.lower(F.trim("name")))
        .join(by_name, "folded", "left")
    )
    action = (
        F.when(F.col("known") & F.col("name_by_id").eqNullSafe(F.col("name")), "unchanged")
        .when(F.col("known"), "update")
        .when(F.col("id_by_name").isNotNull(), "alias")
        .otherwise("create")
    )
    target = F.when(F.col("known"), F.col("id")).otherwise(F.coalesce("id_by_name", "id"))
    return joined.select(supplier, "id", "name", target.alias("remote_id"), action.alias("action"))


def category_changes(reconciled: DataFrame) -> DataFrame:
    """Categories that must be written before any product."""
    return reconciled.filter(F.col("action").isin("create", "update"))


def remap_categories(payloads: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Replace a payload's category by the remote category it was aliased to.

    Only aliased categories travel.  A category with more payloads than a task's fair part is split by
    measured salts, so one category may hold any share of the catalogue.
    """
    aliases = reconciled.filter("action = 'alias'").select(
        F.col("id").alias("category"), F.col("remote_id").alias("_alias")
    ).dropDuplicates(["category"])
    rows = landed(payloads, "payloads")  # counted by category first
    return (
        salted_join(rows, aliases, "category", F.col("id"), "left")
        .withColumn("category", F.coalesce("_alias", "category")).select(*payloads.columns)
    )
