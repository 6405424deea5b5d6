"""Extra columns may have any name: every operator that hands columns through takes those named like its own
internal columns unchanged, and refuses those named like its outputs."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from airshed.llm import best_fit, line_windows, prefix_shards, quality_bayes, rule_cascade, simhash_gray, toxicity_mil

from .conftest import ODD

#: Names that the operators use inside, and some that could be.
INTERNAL = ["_k", "_t", "_text", "_from", "_ident", "site_h", "site_p", "path_n", "path_sum", "host_rate", "host_n", "host_sum", "site_host", "site_path",
            "_id", "_y", "_label", "_doc", "_h", "_order", "_code", "_entry", "_root", "_r", "_least", "_kept_row", "_part", "_tie", "_end", "_row",
            "_n", "_before", "_total", "_ahead", "_tox_text", "tox_text", "q_text", "sim_text", "sim_row", "sim_kept", "rule_text", "row_no",
            "pack_group", "k", "t", "h", "p", "x", "n", "text_", "c0", "c1", "C2", "host", "path", "code", "node", "root", "place", "row", "w"]


def frame(spark, extra):
    return spark.createDataFrame([(*r, "s", *[f"{c}!" for c in extra]) for r in ODD], "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in extra))


def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 0), (8, 0, 1), (6, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "op3": (lambda s, d: simhash_gray.near_duplicates(d, carry=[c for c in d.columns if c not in ("doc_id", "text")]), ["fingerprint", "component_id"]),
    "op3 rows": (lambda s, d: simhash_gray.one_per_component(d), []),
    "op4": (lambda s, d: best_fit.pack(d.withColumn("length", F.lit(5)), 20), ["sequence_id", "offset"]),
    "op5": (lambda s, d: prefix_shards.contiguous_shards(d.withColumn("size", F.octet_length("text")), 3, "doc_id", "size"), ["shard", "slot"]),
    "op6": (lambda s, d: quality_bayes.classify(d, labels(s), "source", "source"), ["p_text", "site_rate", "quality", "kept"]),
    "op7": (lambda s, d: line_windows.dedup_lines(d), ["lines_removed"]),
    "op8": (lambda s, d: rule_cascade.cascade(d, rule_cascade.RULES, stats=True, first=rule_cascade.BASE_RULES), ["n_words", "base_failed", "kept"]),
    "op9": (lambda s, d: toxicity_mil.score(d, toxicity_mil.train(d, labels(s))), ["score", "predicted", "offending"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_internal_names_pass_through(spark, name):
    run, outputs = OPERATORS[name]
    df = frame(spark, INTERNAL)
    out = run(spark, df)
    assert len({c.lower() for c in out.columns}) == len(out.columns) and set(INTERNAL) <= set(out.columns)
    got = out.select(*[F.col(f"`{c}`") for c in INTERNAL]).collect()
    assert got and all(list(r) == [f"{c}!" for c in INTERNAL] for r in got)
    assert name == "op3 rows" or len(got) == len(ODD)


@pytest.mark.parametrize("name, output", [(n, o) for n, (_, outs) in OPERATORS.items() for o in outs])
def test_output_names_are_refused(spark, name, output):
    with pytest.raises(ValueError):
        OPERATORS[name][0](spark, frame(spark, [output.upper()]))


@pytest.mark.parametrize("stage", [n for n, _ in cp.STAGES])
def test_stages_take_any_name(spark, tmp_path, stage):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    extra = INTERNAL + [o for _, outs in OPERATORS.values() for o in outs if o not in ("sequence_id", "offset")]
    extra = list(dict.fromkeys(extra))
    docs = frame(spark, extra).withColumn("lang", F.lit("l")).withColumn("n_chars", F.char_length("text").cast("long"))
    out = dict(cp.STAGES)[stage](spark, docs, str(tmp_path))
    if stage != "best_fit_packing":
        assert out.columns == docs.columns
        assert all([r[c] for c in extra] == [f"{c}!" for c in extra] for r in out.collect())
    else:
        assert out.count() >= len(ODD)


def test_searches_and_writers_read_named_columns_only(spark, tmp_path):
    """Operators with outputs of their own take any further column."""
    from airshed.llm import ann_forest, sp_chunks, warc
    extra = [F.lit(1).alias(c) for c in INTERNAL]
    pages = spark.createDataFrame([(1, "u", "x" * 200), (2, "u", "x" * 200)], "page_id long, url string, html string")
    warc.write_archives(pages.select("*", *extra), str(tmp_path / "warc"))
    assert warc.salvage(spark, str(tmp_path / "warc")).count() == 2
    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)], "vec_id long, embedding array<double>")
    names = {"vec_id", "query_id", "rank", "score"}
    assert ann_forest.nearest(vectors.select("*", *[c for c, n in zip(extra, INTERNAL) if n not in names]), F.col("id") % 20 == 0, k=3).count() == 9
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert sp_chunks.encode_decode(frame(spark, ["_x"]).select("doc_id", "text"), path, digests=True).count() == len(ODD)
