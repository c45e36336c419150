"""Registered queries of the cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import clean
from shelfspark.plans import oracle_clean
from shelfspark.plans.derived import duck, offer_feed, view

OFFER_GROUP = ["Status", "Vessel unit", "Bundle type"]


def _clean_offers(spark, sf):
    """Cleaning of one row per order line, summarised."""
    cleaned = clean.clean_catalog(offer_feed(spark, sf))
    return cleaned.groupBy(*[F.col(c).alias(c.lower().replace(" ", "_")) for c in OFFER_GROUP]).agg(
        F.count(F.lit(1)).alias("offers"), F.count_if(F.col("Price") != "").alias("priced"),
        F.count_if(F.col("Item ID").contains("-row")).alias("renamed"))


QUERIES = {
    "clean_catalog": lambda spark, sf: clean.clean_catalog(view(spark, sf, "feed")),
    "clean_corrections": lambda spark, sf: clean.clean_corrections(view(spark, sf, "feed")),
    "clean_offers": _clean_offers,
    "corrections_by_reason": lambda spark, sf: clean.corrections_by_reason(
        clean.clean_corrections(view(spark, sf, "feed"))
    ),
}

ORACLES = {
    "clean_catalog": oracle_clean.clean_oracle(),
    "clean_corrections": oracle_clean.corrections_oracle(),
    "clean_offers": (
        "SELECT \"Status\" AS status, \"Vessel unit\" AS vessel_unit, \"Bundle type\" AS bundle_type, count(*) AS offers, "
        "count(*) FILTER (WHERE \"Price\" <> '') AS priced, count(*) FILTER (WHERE contains(\"Item ID\", '-row')) AS renamed FROM "
        f"{oracle_clean.cleaned_subquery(duck('offer_feed') + ' feed')} c GROUP BY 1, 2, 3"
    ),
    "corrections_by_reason": (
        "SELECT field, reason, count(*) AS corrections FROM "
        f"({oracle_clean.corrections_oracle()}) c GROUP BY field, reason"
    ),
}
