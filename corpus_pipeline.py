"""A training-corpus pipeline over ``documents``: classify, filter, dedup, pack.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and reread as the next stage's ``docs``.  All but the last return the
columns of their ``docs``.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and
extra columns; what it does with them is what its operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm import best_fit, line_windows, quality_bayes, rule_cascade, simhash_gray
from airshed.llm.common import fresh_name, prepare, read_table, written

SEQUENCE_TOKENS = 2048


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns that an operator adds under the same name put aside, and how to put them back."""
    clash = {c: fresh_name(docs, "in_" + c) for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(clash), {v: k for k, v in clash.items()}


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality reaches one half; host: source, path: language in the source."""
    prepare(spark)
    own, back = _aside(docs, ["p_text", "site_rate", "quality", "kept", "site_host", "site_path"])
    rows = quality_bayes.classify(own, read_table(spark, sf_dir, "labels"), "source", "lang")
    return rows.where("kept").select(*_columns(own)).withColumnsRenamed(back)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    prepare(spark)
    verdict = fresh_name(docs, "rules_kept")
    rows = rule_cascade.cascade(docs, rule_cascade.RULES, first=rule_cascade.BASE_RULES, kept_col=verdict)
    return rows.where(F.col(verdict)).select(*_columns(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines under repeated three-line windows; ``n_chars`` follows the text."""
    prepare(spark)
    own, back = _aside(docs, ["lines_removed"])
    rows = line_windows.dedup_lines(own).select(*_columns(own))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.withColumnsRenamed(back)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest id (of repeated rows of it, one).

    A component of null ids only keeps one row.
    """
    prepare(spark)
    return simhash_gray.one_per_component(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences."""
    prepare(spark)
    pieces = best_fit.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS)
    return best_fit.pack(pieces, SEQUENCE_TOKENS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("best_fit_packing", packing),
]

#: The classifier and the tokenizer cannot be expressed in SQL; ``tests/llm/test_pipeline.py`` holds
#: ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
