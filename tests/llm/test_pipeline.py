"""The pipeline against a plain-Python version of its stages (the classifier's verdict is taken from its
operator, which has tests of its own)."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from airshed.llm import quality_bayes
from airshed.llm import rule_cascade as rc

from conftest import SF0001

from .conftest import ODD
from .test_best_fit import check_bins, cut
from .test_line_windows import brute as brute_lines
from .test_simhash_gray import brute as brute_simhash


def brute_run(rows):
    """(doc_id, text) rows through rules, line dedup and SimHash."""
    kept = [(i, t) for i, t in rows if not any(r.fails(rc.TextStats(t)) for r in rc.BASE_RULES + rc.RULES)]
    lines = [(i, t) for i, t, _ in brute_lines(kept)]
    first = {c for _, _, c in brute_simhash(lines)}
    return [(i, t) for i, t in lines if i in first]


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    good = quality_bayes.classify(docs, labels, "source", "lang").where("kept").select("doc_id", "text")
    want = brute_run([tuple(r) for r in good.collect()])
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = cp.run(spark, SF0001).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(
        (i, *p) for i, t in want for p in cut(tok, t, 2048))
    check_bins(rows, 2048)


def test_each_stage_takes_odd_rows_extra_columns_and_empty_tables(spark, tmp_path):
    docs = (spark.createDataFrame(ODD + [(20 + i, "plain words of a good document number %d " % i + "word%d " % i * 3 + " ".join(f"t{i}{k}" for k in range(80))) for i in range(4)],
                                  "doc_id long, text string")
            .withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.when(F.col("doc_id") > 3, "s"))
            .withColumn("n_chars", F.char_length("text").cast("long")).withColumn("kept", F.lit("mine")).withColumn("lines_removed", F.lit(7))
            .withColumn("rules_kept", F.lit(1)).withColumn("quality", F.lit(0.5)).withColumn("sim_row", F.lit("r")).withColumn("offset_", F.lit(1)))
    spark.createDataFrame([(20, 1, 0), (21, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
        got = out.collect()
        if name == "best_fit_packing":
            assert len(got) >= docs.count()
            continue
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        assert all(r["kept"] == "mine" and r["lines_removed"] == 7 and r["sim_row"] == "r" for r in got)
        if name == "simhash_dedup":
            assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == [1, 4, 5, 6, 7, 8, 9, 20, 21, 22, 23]
        if name == "line_dedup":
            assert len(got) == docs.count() and all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)


def test_one_row_stays_of_each_component(spark):
    t = " ".join(f"w{k}" for k in range(50))
    rows = [(5, t), (5, t), (3, t), (None, t), (None, "other words here"), (None, "other words here"), (9, "")]
    got = cp.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(3, t), (None, "other words here"), (9, "")], key=str)


def test_stage_names_and_hot_groups(spark):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "quality_rules", "line_dedup", "simhash_dedup", "best_fit_packing"]
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 300)]
    rows = [(i, " ".join([*base[:i % 280], f"edit{i}", *base[i % 280:]])) for i in range(400)]    # one large group of near copies
    out = cp.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r["doc_id"] for r in out) == sorted({c for _, _, c in brute_simhash(rows)})
