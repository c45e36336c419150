"""Exact k-means rounds with Shallot search.

Every vector remembers its nearest and second-nearest centroid, an upper bound of the distance to
the first and a lower bound of the distance to all others.  A round moves the bounds by how far
the centroids went; where the upper one stays below the lower one nothing can have changed.
Otherwise:

1. Both remembered centroids are measured again, and the scan starts from the closer one: its
   neighbours are visited by rising distance from it.
2. A centroid can be among the two nearest only if it is no further from the start than the
   vector's distance to the start plus its distance to the second-nearest so far.  This ball shrinks with
   each centroid that comes closer, and the sorted scan ends at its edge.
3. What survives is compared in whole numbers: squared distances of integer vectors, ties to the
   smaller number.  Floating point only decides what is skipped, with a margin above its rounding.

The state of a round is one table in the shared folder, read by the next round and removed once that one
is written, so a lost executor costs one task and disk holds two rounds.  Centroids (count times
width numbers) are all that is collected or broadcast; their sums are exact and combined where
the rows lie.

Vectors become integers, floor(scale * x).  Cases: vectors that are null, of another width, or hold null,
NaN or infinite components take no part; repeated rows count as often as they occur; rows
without an id are clustered but never drawn as first centroids; fewer drawn vectors than `count` give
fewer centroids; equal first centroids stay apart, the smaller number takes their vectors; an empty
centroid keeps its place; an empty table, or one without a vector to draw, gives no rows.
Squared distances and their sums must fit a long.  Extra columns are left out by `cluster`,
and kept by `assign`, where clashing names get an underscore.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import fresh
from shelfspark.llm.vectors import blocks, is_whole, matrix, scaled
from shelfspark.operators.skew import scratch_folder, spread

COUNT, WIDTH, ROUNDS, SCALE = 40, 64, 5, 256
SEED = "2:"
# Above the rounding of a root and a sum, for what floating point skips.
_MARGIN = 1e-9
# Components up to this have squares whose sum over a million fits a long.
_SMALL = 1 << 20
_STATE = ("cluster", "second", "upper", "lower", "distance")
_KINDS = "cluster int, second int, upper double, lower double, distance long"


def squares(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to their points."""
    apart = rows - points
    if np.abs(apart).max(initial=0) > _SMALL:
        apart = apart.astype(object)
    return (apart * apart).sum(axis=1).astype(np.int64)


def neighbours(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all others by rising distance, and those distances."""
    count = len(centroids)
    apart = np.empty((count, count))
    for at, point in enumerate(centroids):
        apart[at] = np.sqrt(squares(centroids, point).astype(np.float64))
    np.fill_diagonal(apart, -1.0)
    order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(apart, order, axis=1)


def search(rows: np.ndarray, first: np.ndarray, second: np.ndarray, centroids: np.ndarray,
           order: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, ...]:
    """(nearest, second-nearest, both squared distances) of each row, from two remembered centroids."""
    best, other = first.copy(), second.copy()
    near, far = squares(rows, centroids[best]), squares(rows, centroids[other])
    if len(centroids) == 1:
        return best, other, near, far
    turn = (far < near) | ((far == near) & (other < best))
    best[turn], other[turn] = other[turn], best[turn]
    near[turn], far[turn] = far[turn], near[turn]
    start, known, reach = best.copy(), other.copy(), np.sqrt(near.astype(np.float64))
    live = np.arange(len(rows))
    for place in range(len(centroids) - 1):
        ball = reach[live] + np.sqrt(far[live].astype(np.float64))
        live = live[apart[start[live], place] <= ball * (1 + _MARGIN)]
        if not len(live):
            break
        point = order[start[live], place]
        new = point != known[live]
        at, point = live[new], point[new]
        found = squares(rows[at], centroids[point])
        first_ = (found < near[at]) | ((found == near[at]) & (point < best[at]))
        second_ = ~first_ & ((found < far[at]) | ((found == far[at]) & (point < other[at])))
        up, side = at[first_], at[second_]
        other[up], far[up] = best[up], near[up]
        best[up], near[up] = point[first_], found[first_]
        other[side], far[side] = point[second_], found[second_]
    return best, other, near, far


def step(rows: np.ndarray, state: dict[str, np.ndarray], centroids: np.ndarray, moved: np.ndarray,
         order: np.ndarray, apart: np.ndarray, measure: bool) -> dict[str, np.ndarray]:
    """The state after the centroids moved; with `measure`, distances of settled rows are computed as well."""
    out = {name: values.copy() for name, values in state.items()}
    ranked = np.argsort(-moved, kind="stable")
    most = np.where(out["cluster"] == ranked[0], moved[ranked[1]] if len(moved) > 1 else 0.0, moved[ranked[0]])
    out["upper"] = (out["upper"] + moved[out["cluster"]]) * (1 + _MARGIN)
    out["lower"] = np.maximum(out["lower"] - most, 0.0) * (1 - _MARGIN)
    loose = np.flatnonzero(out["upper"] >= out["lower"])
    exact = np.arange(len(rows)) if measure else loose
    out["distance"][exact] = squares(rows[exact], centroids[out["cluster"][exact]])
    out["upper"][exact] = np.sqrt(out["distance"][exact].astype(np.float64)) * (1 + _MARGIN)
    loose = loose[out["upper"][loose] >= out["lower"][loose]]
    best, other, near, far = search(rows[loose], out["cluster"][loose], out["second"][loose], centroids, order, apart)
    out["cluster"][loose], out["second"][loose], out["distance"][loose] = best, other, near
    out["upper"][loose] = np.sqrt(near.astype(np.float64)) * (1 + _MARGIN)
    out["lower"][loose] = np.sqrt(far.astype(np.float64)) * (1 - _MARGIN) if len(centroids) > 1 else np.inf
    return out


def _passed(state: DataFrame, centroids: np.ndarray, moved: np.ndarray, measure: bool) -> DataFrame:
    width = centroids.shape[1]
    sent = state.sparkSession.sparkContext.broadcast((centroids, moved, *neighbours(centroids)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, width):
            old = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in _STATE}
            rows = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            new = step(rows, old, *sent.value, measure)
            columns = [pa.array(new[name], batch.schema.field(name).type) for name in _STATE]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), *columns], names=["id", "v", *_STATE])

    return state.mapInArrow(run, state.schema)


def _remove(spark, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _written(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cluster(table: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COUNT, width: int = WIDTH,
            rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(id, v, cluster, distance, ...) of every vector that takes part, and the final centroids."""
    spark = table.sparkSession
    own = F.col(f"`{vector}`")
    whole = spread(table.select(F.col(f"`{key}`").alias("id"), own.alias("v")).filter(F.size(own) == width)).filter(is_whole(F.col("v")))
    kept = whole.select("id", F.transform("v", lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("v"))
    drawn = kept.filter("id is not null").orderBy(F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256), "v").limit(count).collect()
    centroids = np.array([row.v for row in drawn], np.int64).reshape(len(drawn), width)
    starts = (0, min(1, len(drawn) - 1), float("inf"), 0.0, 0)
    state = kept.select("id", "v", *[F.lit(value).cast(kind).alias(name)
                                     for value, (name, kind) in zip(starts, (x.split() for x in _KINDS.split(", ")))])
    if not len(drawn):
        return state.limit(0), centroids
    moved, before = np.zeros(len(drawn)), None
    for round_ in range(rounds + 1):
        folder = scratch_folder(spark, "clusters")
        state = _written(_passed(state, centroids, moved, round_ == rounds), folder)
        if before:
            _remove(spark, before)
        before = folder
        if round_ < rounds:
            sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[at]).alias(f"s{at}") for at in range(width)])
            new = centroids.copy()
            for row in sums.collect():  # at most one row per centroid
                new[row["cluster"]] = [row[f"s{at}"] // row["n"] for at in range(width)]
            moved = np.sqrt(squares(new, centroids).astype(np.float64)) * (1 + _MARGIN)
            centroids = new
    return state, centroids


def assign(table: DataFrame, centroids: np.ndarray, vector: str = "embedding", scale: int = SCALE) -> tuple[DataFrame, list[str]]:
    """`table` with the nearest centroid and its squared distance (null for vectors that take no part); and those names."""
    names = fresh(table.columns, "cluster", "distance")
    width, at = centroids.shape[1], table.columns.index(vector)
    sent = table.sparkSession.sparkContext.broadcast((centroids, *neighbours(centroids)))
    (flag,) = fresh([*table.columns, *names], "_whole")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, order, apart = sent.value
        for batch in blocks(batches, width):
            takes = np.flatnonzero(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False))
            rows = scaled(matrix(batch.column(at).take(pa.array(takes)), width), scale)
            zero = np.zeros(len(rows), np.int64)
            best, _, near, _ = search(rows, zero, zero + min(1, len(points) - 1), points, order, apart)
            found, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            found[takes], far[takes] = best, near
            none = np.ones(batch.num_rows, bool)
            none[takes] = False
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, mask=none), pa.array(far, mask=none)],
                                             names=[*batch.schema.names[:-1], *names])

    own = F.col(f"`{vector}`")
    fields = [T.StructField(names[0], T.IntegerType()), T.StructField(names[1], T.LongType())]
    takes = is_whole(own) & (F.coalesce(F.size(own), F.lit(-1)) == width) & F.lit(len(centroids) > 0)
    return table.withColumn(flag, takes).mapInArrow(run, T.StructType([*table.schema.fields, *fields])), names


def report(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector with its cluster's and all clusters' sums of squared distances."""
    state, centroids = cluster(table, key, vector)
    spark = table.sparkSession
    totals = {row["cluster"]: row["d"] for row in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, point.tolist())).encode()).hexdigest() for point in centroids]
    about = spark.createDataFrame(  # one row per centroid
        [(at, totals.get(at, 0), sum(totals.values()), digest) for at, digest in enumerate(digests)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(about), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(count: int = COUNT, width: int = WIDTH, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> str:
    """The same rounds by brute force over all centroids."""
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INTEGER) AS cluster, e FROM (
    SELECT sha256('{seed}' || CAST(vec_id AS VARCHAR)) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT {count}))"""]
    for at in range(rounds + 1):
        steps.append(f"""a{at} AS MATERIALIZED (
  SELECT rid, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
    SELECT rid, cluster, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v, c{at} c) GROUP BY rid)""")
        if at < rounds:
            steps.append(f"""s{at} AS MATERIALIZED (
  SELECT cluster, list(m ORDER BY i) AS e FROM (
    SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (
      SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (
        SELECT cluster, unnest(e) AS x, unnest(range({width})) AS i FROM v JOIN a{at} USING (rid)) GROUP BY cluster, i)) GROUP BY cluster)""")
            steps.append(f"c{at + 1} AS MATERIALIZED (SELECT cluster, coalesce(s.e, c.e) AS e FROM c{at} c LEFT JOIN s{at} s USING (cluster))")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (rid) JOIN c{rounds} c USING (cluster)
"""


ORACLE = _oracle()
