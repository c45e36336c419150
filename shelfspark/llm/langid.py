"""Language identification by nearest centroid over TF-IDF character n-grams.

Training takes at most `per_language` labelled documents of each language (a documented
bound; which ones depends on a hash of the id alone), turns each whole text into a unit vector
of log-scaled, IDF-weighted counts of hashed 1- to 3-grams of letters (anything else is one space), and clusters every
language's vectors by spherical k-means into up to `clusters` centroids.  A text gets the
language of the centroid with the greatest cosine.  It is marked `rejected` if it lies further
from that centroid than `quantile` of that language's own training texts do, with a slack.

Cases: a null text, or one without a letter, is `und` with score 0; nothing learnt makes every
text `und`; documents without language, or repeated ones, train as they are or not at all;
ties go to the language first in alphabetical order.  Texts are read whole, in pieces, so
memory does not grow with their length.  Extra columns stay, clashing names get an underscore.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.common import add_columns, crc_mod, fresh

BUCKETS = 1 << 12
PER_LANGUAGE = 500
LANGUAGES = 200
CLUSTERS = 4
ROUNDS = 12
QUANTILE, SLACK = 0.01, 0.05
UNDETERMINED = "und"
_PIECE = 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run without letters being one space."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    c = np.where(letter, c, np.uint32(32))
    return c[letter | np.concatenate(([True], letter[:-1]))]


def counts(text: str) -> np.ndarray:
    """Hashed counts of 1- to 3-grams of a whole text."""
    total = np.zeros(BUCKETS)
    before = np.array([32, 32], np.uint32)
    for low in range(0, len(text), _PIECE):
        # two characters of the piece before open the n-grams that reach into this one
        c = np.concatenate((before, letters_only(text[low:low + _PIECE])))
        before = c[-2:]
        c = c.astype(np.uint64)
        one = c * np.uint64(0x9E3779B97F4A7C15)
        two = one[:-1] ^ (c[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
        three = (two[:-1] * np.uint64(0x165667B19E3779F9)) ^ (c[2:] * np.uint64(0x27D4EB2F165667C5))
        for grams in (one[2:], two[1:], three):
            mixed = (grams * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(52)
            total += np.bincount(mixed.astype(np.int64), minlength=BUCKETS)
    return total


def unit(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(rows) * idf
    norms = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.where(norms > 0, norms, 1)


@dataclass
class Centroids:
    languages: list[str]  # of each centroid row
    rows: np.ndarray
    idf: np.ndarray
    floor: dict[str, float]  # least cosine that is not rejected

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [(UNDETERMINED, 0.0, True)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.languages else []
        if at:
            cosines = unit(np.stack([counts(texts[i]) for i in at]), self.idf) @ self.rows.T
            best = np.round(cosines, 12).argmax(axis=1)
            for i, b, row in zip(at, best, cosines):
                language, score = self.languages[b], round(float(min(1.0, max(0.0, row[b]))), 9)
                out[i] = (language, score, score < self.floor[language])
        return out


def cluster(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from far-apart starting rows; fixed for fixed rows."""
    chosen = [int((rows @ rows.mean(axis=0)).argmax())]
    near = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centers = rows[chosen]
    for _ in range(rounds):
        own = (rows @ centers.T).argmax(axis=1)
        sums = np.stack([rows[own == j].sum(axis=0) for j in range(len(centers))])
        kept = np.linalg.norm(sums, axis=1) > 0
        centers = sums[kept] / np.linalg.norm(sums[kept], axis=1, keepdims=True)
    return centers


def train(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS) -> Centroids:
    """Centroids from a bounded sample: count vectors are made in Spark, clusters from those.

    Sampled rows are those with the smallest hash of id and text, per language: the
    fraction follows from one count per language, so nothing is sorted.
    """
    rows = labelled.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(text).alias("t")).filter(
        F.col("l").isNotNull() & F.col("t").isNotNull())
    sizes = {r.l: r.n for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(LANGUAGES).collect()}
    if not sizes:
        return Centroids([], np.zeros((0, BUCKETS)), np.ones(BUCKETS), {})
    steps = 1 << 30
    draw = F.pmod(F.xxhash64("k", "t"), F.lit(steps))
    limit = F.element_at(F.create_map(*[F.lit(x) for l, n in sizes.items() for x in (l, min(steps, steps * per_language // n))]), F.col("l"))
    picked = rows.filter(draw < limit).select("k", "l", "t")
    name = "v"

    def start():
        return lambda texts: {name: [
            {"i": (own := np.flatnonzero(c := counts(t))).tolist(), "c": c[own].astype(int).tolist()} for t in texts]}

    vector = T.StructType([T.StructField("i", T.ArrayType(T.IntegerType())), T.StructField("c", T.ArrayType(T.IntegerType()))])
    sample = add_columns(picked, "t", [(name, vector)], start).select("k", "l", "v").collect()  # about per_language rows each
    sample.sort(key=lambda r: (r.l, str(r.k), r.v.i, r.v.c))
    dense = np.zeros((len(sample), BUCKETS), np.float32)
    for at, row in enumerate(sample):
        dense[at, row.v.i] = row.v.c
    seen = (dense > 0).sum(axis=0)
    idf = np.log((1 + len(sample)) / (1 + seen)) + 0.1
    vectors = unit(dense, idf)
    labels = np.array([r.l for r in sample])
    languages, parts, floor = [], [], {}
    for language in sorted(set(labels)):
        own = vectors[labels == language]
        centers = cluster(own, clusters)
        languages += [str(language)] * len(centers)
        parts.append(centers)
        floor[str(language)] = float(np.quantile((own @ centers.T).max(axis=1), QUANTILE)) - SLACK
    rows_ = np.concatenate(parts) if parts else np.zeros((0, BUCKETS))
    return Centroids(languages, rows_, idf, floor)


def label(docs: DataFrame, model: Centroids, text: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` with predicted language, cosine and rejection; and those names.

    The model has a fixed size (languages x clusters x buckets), so it is broadcast.
    """
    names = fresh(docs.columns, "lang_pred", "score", "rejected")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        own = sent.value

        def work(texts):
            found = own.predict(texts)
            return {name: [row[at] for row in found] for at, name in enumerate(names)}
        return work

    kinds = [T.StringType(), T.DoubleType(), T.BooleanType()]
    return add_columns(docs, text, list(zip(names, kinds)), start), names


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 4) == 2


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict every row."""
    model = train(docs.filter(~held_out(key)), key, text, lang)
    marked, (pred, score, rejected) = label(docs.select(key, text), model, text)
    return marked.select(key, held_out(key).alias("held_out"), F.col(pred).alias("lang_pred"),
                         F.col(score).alias("score"), F.col(rejected).alias("rejected"))
