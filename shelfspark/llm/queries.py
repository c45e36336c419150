"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm import (
    clustering, decontaminate, htmlmain, langid, linededup, pii, quality, secretscan, sentencepieces, simhash, tokencount,
    topk, whitening,
)
from shelfspark.llm.common import spread_rows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_rows(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": lambda s, d: quality.report(_docs(s, d), _table(s, d, "labels")),
    "op2_topk": lambda s, d: topk.report(_table(s, d, "embeddings")),
    "op3_sentencepiece": lambda s, d: sentencepieces.report(_docs(s, d)),
    "op4_decontaminate": lambda s, d: decontaminate.report(_docs(s, d), _table(s, d, "benchmark")),
    "op5_html_main": lambda s, d: htmlmain.report(spread_rows(_table(s, d, "pages"))),
    "op6_pii": lambda s, d: pii.report(_docs(s, d)),
    "op7_simhash": lambda s, d: simhash.report(_docs(s, d)),
    "op8_line_dedup": lambda s, d: linededup.report(_docs(s, d)),
    "op9_token_counts": lambda s, d: tokencount.report(_docs(s, d)),
    "op10_language": lambda s, d: langid.report(_docs(s, d)),
    "op11_whitening": lambda s, d: whitening.report(_table(s, d, "embeddings")),
    "op12_secrets": lambda s, d: secretscan.report(_docs(s, d)),
    "op13_shallot": lambda s, d: clustering.report(_table(s, d, "embeddings")),
}

ORACLES = {
    "op2_topk": topk.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op13_shallot": clustering.ORACLE,
}
