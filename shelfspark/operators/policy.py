"""Crawl policy: rule lines per host -> a verdict per URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.urls import path_and_query, url_host
from shelfspark.operators.skew import join_checked

# Characters that mean themselves in a rule and something else in an expression ('*' is a rule's wildcard).
_SPECIAL = r"([()\[\]{}?+\-|^$\\.&~#\s])"


def policy_rules(lines: DataFrame) -> DataFrame:
    """Lines (host, ord, line) of policy files -> rules (host, allow, regex) that every agent must follow.

    A rule belongs to the nearest agent line above it; rules above any agent line count too.
    `*` stands for anything, a final `$` for the end of the address; empty patterns match nothing.
    """
    sides = F.split(F.trim("line"), ":", 2)
    named = lines.filter(F.trim("line").rlike("^[^#:][^:]*:")).select(
        "host", "ord", F.lower(F.trim(sides[0])).alias("name"), F.trim(sides[1]).alias("value"))
    above = Window.partitionBy("host").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    agent = F.last(F.when(F.col("name") == "user-agent", F.col("value")), ignorenulls=True).over(above)
    body = F.replace(F.regexp_replace("value", _SPECIAL, r"\\$1"), F.lit("*"), F.lit(".*"))
    ended = F.concat(F.lit("^"), F.expr("substring(body, 1, length(body) - 2)"), F.lit("$"))
    return (
        named.withColumn("agent", agent).withColumn("body", body)
        .filter(F.coalesce("agent", F.lit("*")).eqNullSafe("*") & F.col("name").isin("allow", "disallow") & (F.col("value") != ""))
        .select("host", (F.col("name") == "allow").alias("allow"),
                F.when(F.col("value").endswith("$"), ended).otherwise(F.concat(F.lit("^"), "body", F.lit(".*"))).alias("regex"))
    )


def with_verdict(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add `allowed`: of the host's rules that match, the longest decides; an allow rule wins a tie.

    A host's rules (one short file) become one row, so pages meet them in one join on the host
    and no page row is multiplied.  Hosts without rules allow everything.
    """
    by_host = rules.groupBy(F.col("host").alias("_host")).agg(F.collect_list(F.struct(F.length("regex").alias("size"), "allow", "regex")).alias("_rules"))
    joined = join_checked(pages.withColumn("_host", url_host(F.col(url))), by_host, "_host")
    path = path_and_query(F.col(url))
    longest = F.array_max(F.transform(F.filter("_rules", lambda r: F.regexp_like(path, r["regex"])), lambda r: F.struct(r["size"], r["allow"])))
    return joined.withColumn("_longest", longest).withColumn("allowed", F.coalesce(F.col("_longest.allow"), F.lit(True))).drop("_host", "_rules", "_longest")
