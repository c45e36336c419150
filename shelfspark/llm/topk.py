"""Exact top-k inner products by pivot-table elimination.

Scores are inner products of integer vectors (floor of scale times each component).  With squared
norms, score = (|q|^2 + |c|^2 - d(q, c)^2) / 2, and for every pivot p the triangle inequality gives
d(q, c) >= |d(q, p) - d(c, p)|.  The largest of these lower bounds over many pivots is an upper
bound of the score.  A query's candidates are evaluated in the order of that bound, and the
query stops when the next bound is below its k-th best score so far: every candidate left
out is proven worse.  Ties of the k-th score are still evaluated.

Distances to pivots are computed once per vector.  Pivots, and a first k-th best score per
query, come from a sample of bounded size; they change the speed, never the result.
Queries and candidates meet in blocks of bounded size, so memory does not grow with either.

Cases: vectors that are null or hold null, NaN or infinite components take no part; vectors of
different lengths compare over the shared leading components; a row is a candidate of every
query but itself, so another row with the same id is one; fewer than k candidates give fewer
rows; ties go to the smaller id.  Scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, landed

PIVOTS = 32
SAMPLE = 1024
BLOCK = 8192
STEP = 256
SCALE = 256
_EXACT = float(1 << 53)


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Far-apart rows: each is the one furthest from those before."""
    if not len(sample):
        return sample
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _dense(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for at, row in enumerate(rows):
        out[at, :len(row)] = row
    return out


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products: floating point where every partial sum is exact, else longs."""
    top = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[-1])
    if top < _EXACT:
        return np.rint(left @ right).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64)


def search_block(queries: tuple, candidates: tuple, k: int) -> list[tuple[int, int, int, int]]:
    """(query row, candidate row, score, evaluated) of each query's best k in one block.

    Both are (row ids, vec ids, vectors, pivot distances); queries also have a first bound.
    """
    q_row, _, q, q_far, q_floor = queries
    c_row, c_id, c, c_far = candidates
    q_norm, c_norm = (q * q).sum(axis=1), (c * c).sum(axis=1)
    out = []
    for at in range(len(q_row)):
        bound = np.abs(c_far - q_far[at]).max(axis=1) if c_far.shape[1] else np.zeros(len(c_row))
        upper = (q_norm[at] + c_norm - bound * bound) / 2
        upper += 1e-9 * (q_norm[at] + c_norm) + 1  # more than any rounding of roots and squares
        least = float(q_floor[at])
        live = np.flatnonzero((upper >= least) & (c_row != q_row[at]))
        live = live[np.argsort(-upper[live], kind="stable")]
        best: list[tuple[int, int, int]] = []
        done = 0
        while done < len(live) and upper[live[done]] >= least:
            some = live[done:done + STEP]
            done += len(some)
            scores = _products(c[some], q[at])
            good = scores >= least
            best += zip((-scores[good]).tolist(), c_id[some][good].tolist(), c_row[some][good].tolist())
            best = sorted(best)[:k]
            if len(best) == k:
                least = max(least, -best[-1][0])
        out += [(int(q_row[at]), row, vec, -score) for score, vec, row in best]
    return out


def vectors(table: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(row, id, v): integer vectors of the rows that take part, with a number for each row."""
    number = F.col(f"`{vector}`")
    whole = number.isNotNull() & ~F.exists(number, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return table.filter(whole & F.col(f"`{key}`").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("id"),
        F.transform(number, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double")).alias("v"))


def search(table: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE, pivots: int = PIVOTS, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row that `is_query` (a condition on the id) holds for."""
    spark = table.sparkSession
    rows = landed(vectors(table, key, vector, scale), "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = size.n, size.width or 0
    drawn = rows.orderBy(F.xxhash64("row", "id"), "row").limit(sample).collect()
    near = _dense([r.v for r in drawn], width)
    sent = spark.sparkContext.broadcast((choose_pivots(near, pivots), near, np.array([r.row for r in drawn], np.int64)))

    def start():
        points, near, near_rows = sent.value

        def work(values, numbers):
            own = _dense(values, width)
            far = [np.sqrt(((own - p) ** 2).sum(axis=1)) for p in points]
            scores = _products(own, near.T) if len(near) else np.zeros((len(own), 0))
            floors = []
            for row, number in zip(scores, numbers):
                row = row[near_rows != number]
                floors.append(float(np.partition(row, len(row) - k)[len(row) - k]) if len(row) >= k else -1e300)
            return {"far": np.stack(far, axis=1).tolist() if far else [[]] * len(own), "floor": floors}
        return work

    fields = [("far", T.ArrayType(T.DoubleType())), ("floor", T.DoubleType())]
    table = landed(add_columns(rows, "v", fields, start, ("row",)).withColumn("query", F.coalesce(is_query, F.lit(False))), "pivot-table")
    asked = table.filter("query").count()
    q_blocks, c_blocks = max(1, -(-asked // block)), max(1, -(-n // block))
    c_block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(c_blocks)).cast("int")
    q_block = F.pmod(F.xxhash64("row", F.lit(2)), F.lit(q_blocks)).cast("int")
    left = table.filter("query").select(
        "row", "id", "v", "far", "floor", q_block.alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("cb"))
    # other names on the other side, as both come from one table
    right = table.select(
        F.col("row").alias("c_row"), F.col("id").alias("c_id"), F.col("v").alias("c_v"), F.col("far").alias("c_far"),
        c_block.alias("c_cb"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("c_qb"))

    def matrix(part: pd.DataFrame, side: str = ""):
        far = part[f"{side}far"].tolist()
        return (part[f"{side}row"].to_numpy(), part[f"{side}id"].to_numpy(), _dense(part[f"{side}v"].tolist(), width),
                np.stack(far) if len(part) and len(far[0]) else np.zeros((len(part), 0)))

    def meet(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(others):
            found = search_block((*matrix(own), own["floor"].to_numpy()), matrix(others, "c_"), k)
        ids = dict(zip(own["row"], own["id"])) if len(own) else {}
        return pd.DataFrame([(q, ids[q], vec, score, row) for q, row, vec, score in found],
                            columns=["q", "query_id", "vec_id", "score", "c"]).astype(np.int64)

    best = left.groupBy("qb", "cb").cogroup(right.groupBy("c_qb", "c_cb")).applyInPandas(
        meet, "q long, query_id long, vec_id long, score long, c long")
    # at most k rows of each block reach a query's window
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "c")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(table: DataFrame) -> DataFrame:
    return search(table, F.col("id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS crid, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, crid) AS rank FROM s) WHERE rank <= 5
"""
