"""Text quality by a sparse ensemble of rules.

1. Statistics of a whole text are Column expressions.
2. A small random forest is fitted to them; every path from a root to a node is a
   conjunction of thresholds, that is, a rule.
3. A lasso logistic regression weighs the rules; most weights become zero.
4. The rules left are compiled into one Column expression that scores every document.

Training takes at most `SAMPLE` labelled documents (a documented bound; which ones depends on
a hash of the id alone), with a fixed row order, so a fit can be repeated.

Cases: a null or empty text has the statistics of an empty text and gets a score; null
labels, and ids with both labels, are left out; repeated rows train and score as they are; with
one class only the score is that class, without any labels 0.5; ties of a statistic with a
threshold count as below it.  Extra columns stay, clashing names get an underscore.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import crc_mod, fresh, landed
from shelfspark.operators.skew import keep_where

SAMPLE = 20_000
THRESHOLD = 0.3
TREES, DEPTH, LASSO = 12, 3, 0.0005
SEED = 7


def statistics(text: Column) -> list[tuple[str, Column]]:
    """Named statistics; later ones may use the earlier ones' names as columns."""
    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace("_t", pattern, ""))

    words, lines = F.split("_t", r"[ \t\r\n]+"), F.split("_t", "\n")
    return [
        ("_t", F.coalesce(text, F.lit(""))),
        ("_words", words), ("_lines", lines),
        ("chars", F.length("_t").cast("double")),
        ("upper", left(r"[^\p{Lu}]+")), ("lower", left(r"[^\p{Ll}]+")), ("digits", left("[^0-9]+")),
        ("spaces", left(r"[^\s]+")), ("stops", left("[^.,;:?]+")), ("bangs", left("[^!]+")),
        ("words", F.size("_words").cast("double")), ("lines", F.size("_lines").cast("double")),
        ("distinct", F.size(F.array_distinct("_words")).cast("double")),
        ("distinct_lines", F.size(F.array_distinct("_lines")).cast("double")),
        ("marks", F.col("chars") - F.col("upper") - F.col("lower") - F.col("digits") - F.col("spaces")
         - F.col("stops") - F.col("bangs")),
        ("upper_share", share("upper", "chars")), ("lower_share", share("lower", "chars")),
        ("digit_share", share("digits", "chars")), ("space_share", share("spaces", "chars")),
        ("stop_share", share("stops", "words")), ("bang_share", share("bangs", "words")),
        ("mark_share", share("marks", "chars")), ("marks_per_word", share("marks", "words")),
        ("distinct_share", share("distinct", "words")), ("line_share", share("distinct_lines", "lines")),
        ("word_length", share("chars", "words")), ("line_words", share("words", "lines")),
        ("repeat_rate", (F.col("words") - F.col("distinct")) / F.sqrt(F.greatest(F.col("words"), F.lit(1.0)))),
    ]


FEATURES = ["chars", "words", "lines", "upper_share", "lower_share", "digit_share", "space_share", "stop_share",
            "bang_share", "mark_share", "marks_per_word", "distinct_share", "line_share", "word_length", "line_words",
            "repeat_rate"]


def with_statistics(rows: DataFrame, text: Column) -> tuple[DataFrame, str]:
    """`rows` with one struct column of all FEATURES; and its name.  Each text is scanned once per pattern."""
    (name,) = fresh(rows.columns, "_stats")
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), text.alias("_text"))
    for batch in _levels(statistics(F.col("_text"))):
        packed = packed.withColumns(dict(batch))
    return packed.select("_row.*", F.struct(*FEATURES).alias(name)), name


def _levels(named: list[tuple[str, Column]]) -> list[list[tuple[str, Column]]]:
    """Text first, then splits, then counts, then what is derived from counts."""
    ends = [1, 3, 14, 15, len(named)]
    return [named[low:high] for low, high in zip([0, *ends], ends)]


# A rule: (feature, "<=" or ">", threshold) conditions that must all hold.
Rule = tuple[tuple[str, str, float], ...]


@dataclass
class Ensemble:
    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self, stats: str) -> Column:
        """The rules as one expression over a statistics struct: probability of label 1."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def condition(rule: Rule, stats: str) -> Column:
    held = F.lit(True)
    for feature, side, threshold in rule:
        value = F.col(stats)[feature].cast("double")
        held = held & (value <= threshold if side == "<=" else value > threshold)
    return held


_BRANCH = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)$")


def tree_rules(description: str) -> set[Rule]:
    """All paths of the trees in a forest's printed form; one feature and side keeps its tightest bound."""
    found: set[Rule] = set()
    path: list[tuple[int, tuple[str, str, float]]] = []
    for line in description.splitlines():
        match = _BRANCH.match(line)
        if not match:
            continue
        depth = len(match[1])
        path = [step for step in path if step[0] < depth]
        path.append((depth, (FEATURES[int(match[3])], match[4], float(match[5]))))
        tight: dict[tuple[str, str], float] = {}
        for _, (feature, side, threshold) in path:
            old = tight.get((feature, side), threshold)
            tight[feature, side] = min(old, threshold) if side == "<=" else max(old, threshold)
        found.add(tuple(sorted((f, s, t) for (f, s), t in tight.items())))
    return found


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE) -> Ensemble:
    """An ensemble from at most about `sample` labelled documents."""
    known = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
             .filter(F.col("k").isNotNull() & F.col("y").isin(0, 1))
             .groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("top")).filter("y = top").select("k", "y"))
    classes = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = 1 << 30
    part = min(steps, steps * sample // max(1, sum(classes.values())))
    drawn = known.filter(F.pmod(F.xxhash64("k"), F.lit(steps)) < part).limit(sample)  # bounded, so broadcast
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(drawn), "k")
    rows, stats = with_statistics(rows.select("k", "y", "t"), F.col("t"))
    ready = landed(rows.select("k", F.col("y").cast("double").alias("y"), F.array(
        *[F.col(stats)[f].cast("double") for f in FEATURES]).alias("x")), "quality").repartition(4, "k").sortWithinPartitions("k", "x")
    ready = landed(ready, "quality")
    present = {r.y for r in ready.select("y").distinct().collect()}
    if len(present) < 2:
        return Ensemble([], {frozenset(): 0.0, frozenset([1.0]): 20.0, frozenset([0.0]): -20.0}[frozenset(present)])
    forest = RandomForestClassifier(
        labelCol="y", featuresCol="v", numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, subsamplingRate=0.7,
    ).fit(ready.select("y", array_to_vector("x").alias("v")))
    rules = sorted(tree_rules(forest.toDebugString))
    flags = ready.select("y", F.struct(*[F.col("x")[i].alias(f) for i, f in enumerate(FEATURES)]).alias("s")).select(
        "y", array_to_vector(F.array(*[condition(rule, "s").cast("double") for rule in rules])).alias("v"))
    lasso = LogisticRegression(labelCol="y", featuresCol="v", elasticNetParam=1.0, regParam=LASSO, maxIter=40,
                               standardization=False).fit(flags)
    weights = lasso.coefficients.toArray()
    return Ensemble([(rule, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-6], float(lasso.intercept))


def score(docs: DataFrame, model: Ensemble, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with its score; and that column's name."""
    (name,) = fresh(docs.columns, "score")
    rows, stats = with_statistics(docs, F.col(f"`{text}`"))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns], model.score(stats).alias(name)), name


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score at least `threshold`, columns as they were."""
    scored, name = score(docs, train(docs.filter(~held_out()), labels))
    return keep_where(scored, F.col(name) >= threshold).drop(name)


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 5) == 0


def report(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Learn from the rows that are not held out, score every row."""
    model = train(docs.filter(~held_out(key)), labels, key)
    scored, name = score(docs.select(key, "text"), model)
    return scored.select(key, held_out(key).alias("held_out"), F.col(name).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
