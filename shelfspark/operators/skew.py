"""Helpers for hot keys, size-checked broadcasts and global row numbers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows that one task sorts to number them: their keys and row ids fit a task's memory with room to spare.
ROWS_PER_SORT = 500_000
# What may be sent to every executor: at most so many lookup rows with so many bytes as JSON.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def key_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, `_rows`): map-side partial sums over the key columns alone."""
    return landed(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")


def hot_keys(counted: DataFrame, keys: list[str], share: int) -> DataFrame:
    """(keys, `_salts`) of the keys with more than 1/share of all rows, from their landed `_rows`; null keys left out.

    There are fewer than `share` of them whatever the input; `_salts` is how many such parts a key fills.
    """
    known = F.lit(True)
    for c in keys:
        known = known & F.col(c).isNotNull()
    total = counted.agg(F.sum("_rows")).first()[0] or 0
    return counted.filter(known & (F.col("_rows") * share > F.lit(total))).select(
        *keys, F.ceil(F.col("_rows") * share / F.lit(total or 1)).cast("int").alias("_salts"))


def salted_join(
    rows: DataFrame, lookup: DataFrame, key: str | list[str], spread: Column, how: str = "inner", counted: DataFrame | None = None
) -> DataFrame:
    """Join many rows to at most one lookup row per key, splitting measured hot keys over tasks.

    `how` is inner or left.  `spread` must vary within a key (a row number or a hash of the row).  A key is hot above
    a shuffle partition's fair part of the rows; it gets as many salts as parts it fills, and only its lookup row is
    copied.  A null key meets nothing and is spread over all partitions.  `counted` has the landed `_rows` of each
    key, where the caller knows them; else `rows`, which should be landed, are counted first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(counted if counted is not None else key_counts(rows, keys), keys, parts))  # fewer rows than shuffle partitions
    empty = F.lit(False)
    for c in keys:
        empty = empty | F.col(c).isNull()
    salts = F.when(empty, F.lit(parts)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("_salts")
    right = lookup.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only a local session gets its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str = "landed") -> DataFrame:
    """Job output written once as a table in the shared checkpoint folder.

    A job's output feeds several consumers (export, audit, validation, diff).  Landing it
    evaluates the rule ladder once, survives lost executors, lets each consumer read only
    its columns, and keeps joins above it planning against plain columns.
    """
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def join_checked(rows: DataFrame, lookup: DataFrame, on, how: str = "left", unsorted: bool = False) -> DataFrame:
    """Join with a lookup that is usually, but not provably, small.

    The lookup is landed, and its rows and bytes are counted first; only below both limits is
    it broadcast, so the wide rows are not shuffled.  A larger lookup takes the ordinary
    shuffled join, in which adaptive execution can split hot keys; with `unsorted` (narrow lookup, one row
    a key) by hash, so the wide rows are not sorted.
    """
    lookup = landed(lookup, "lookup")
    size = lookup.limit(BROADCAST_ROWS + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length(F.to_json(F.struct("*")))).alias("bytes")).first()
    small = size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(lookup) if small else lookup.hint("shuffle_hash") if unsorted else lookup, on, how)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for heavy per-row rules over an input of few splits.

    An input that already has at least as many splits as cores is left alone, so nothing
    is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row aggregates (stacked, then merged)."""
    stacked = one_row[0]
    for other in one_row[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on a derived condition without pushing it down.

    Catalyst moves a filter below projections by copying their expressions into it; for a
    deep rule ladder the copy grows with every stage.  A one-element generator keeps the
    condition above the ladder, inside the same code stage.
    """
    kept = df.select("*", F.explode_outer(F.array(condition)).alias("_keep"))
    return kept.filter("_keep").drop("_keep")


def with_sequence(
    df: DataFrame, order_by: list[Column], name: str, within: list[str] | None = None, start: int = 1
) -> DataFrame:
    """Consecutive numbers in sort order, per `within` group, without a one-task window; ties go by input order.

    The rows are landed as they are, with a row id.  Only group, order and row id are range-partitioned,
    sorted and landed, one partition for each `ROWS_PER_SORT` rows, so a group of any size spans many tasks and the
    split points come from a sample of narrow rows.  One count per (partition, group) turns places into numbers,
    which the wide rows meet on the unique row id: broadcast while small, in an unsorted hash join otherwise.
    """
    within = within or []
    rows = landed(df.withColumn("_seq_row", F.monotonically_increasing_id()), "unnumbered")
    groups = [f"_g{at}" for at in range(len(within))]
    orders = [f"_o{at}" for at in range(len(order_by))]
    narrow = rows.select(*[F.col(c).alias(g) for c, g in zip(within, groups)], *[c.alias(o) for c, o in zip(order_by, orders)], "_seq_row")
    total = rows.count()
    parts = max(1, -(-total // ROWS_PER_SORT))
    sorted_ids = narrow.repartitionByRange(parts, *groups, *orders, "_seq_row").sortWithinPartitions(*groups, *orders, "_seq_row")
    frozen = landed(
        sorted_ids.select(*groups, "_seq_row", F.monotonically_increasing_id().alias("_position")), "sequence",
    ).withColumn("_part", F.shiftrightunsigned("_position", 33).cast("int"))
    # at most (partitions + groups) rows: neighbouring groups share a partition
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frozen.groupBy("_part", *groups)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first"))
        .select(F.col("_part").alias("_in"), *[F.col(g).alias(f"{g}_in") for g in groups], "_first",
                F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    on = F.col("_part") == F.col("_in")
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"{g}_in"))
    number = F.col("_before") + F.col("_position") - F.col("_first") + start
    numbers = join_checked(frozen, offsets, on, "inner").select("_seq_row", number.alias("_number"))
    numbers = F.broadcast(numbers) if total <= BROADCAST_ROWS else numbers.hint("shuffle_hash")  # two longs a row
    return rows.join(numbers, "_seq_row").select(*df.columns, F.col("_number").alias(name))
