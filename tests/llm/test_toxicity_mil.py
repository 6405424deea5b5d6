import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from airshed.llm import toxicity_mil as tm

from .conftest import ODD

SF001 = "/root/testdata/sf0.01"


def test_query_on_the_held_out_fold(spark):
    rows = E.queries()["op9_toxicity_mil"](spark, SF001).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert bool(r["offending"]) == bool(r["predicted"] and docs[r["doc_id"]])
        assert all(0 <= s["start"] < s["end"] <= len(docs[r["doc_id"]]) for s in r["offending"])
    held = [(r["score"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) >= 0.8           # area under the curve; some 40 toxic documents to learn from
    assert np.mean([s < 0.3 for s in neg]) >= 0.97


def corpus(n=400, seed=5):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows, where = [], {}
    for d in range(n):
        sents = [" ".join(rng.choice(words, 8)) for _ in range(rng.integers(2, 9))]
        bad = d % 4 == 0
        if bad:
            k = int(rng.integers(0, len(sents)))
            sents[k] = sents[k] + " vileness" + rng.choice(["es", "ed", ""])
            where[d] = k
        rows.append((d, ". ".join(sents) + ".", int(bad)))
    return rows, where


def test_the_offending_sentence_is_located(spark):
    rows, where = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = tm.train(df.select("doc_id", "text"), df.where("doc_id < 300").select("doc_id", "toxic"))
    out = tm.score(df.where("doc_id >= 300").withColumn("z", F.lit(1)), model).collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in out]) >= 0.98
    for r in out:
        if r["predicted"] and r["toxic"]:
            assert ["vileness" in r["text"][s["start"]:s["end"]] for s in r["offending"]] == [True]


def test_noisy_or_by_hand():
    model = tm.Model({tm.feature_hash("bad"): 4.0}, -3.0, 0.05)
    s = model.scorer()
    p = lambda z: 1 / (1 + np.exp(-z))
    assert s.document("Bad, word. fine! bad bad") == pytest.approx(1 - 0.95 * (1 - p(1.0)) ** 2 * (1 - p(-3.0)))
    assert s.document(None) == s.document("") == s.document(" \n. !") == pytest.approx(0.05)
    assert s.offending("ok. So bad\nx", 0.5) == [(3, 10, pytest.approx(p(1.0)))]


def test_gradient_reaches_a_better_fit():
    rng = np.random.default_rng(6)
    y = (rng.random(200) < 0.3).astype(float)
    doc = np.repeat(np.arange(200), 3)
    sent, feat = np.arange(600), np.where((y[doc] > 0) & (np.arange(600) % 3 == 1), 0, rng.integers(1, 6, 600))
    w, bias, leak = tm.fit_noisy_or(doc, sent, feat, np.zeros(200), y, 6)
    assert w[0] > 3 + max(w[1:]) and bias < -1 and 0 < leak < 0.3


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (8, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = tm.train(odd, labels)
    rows = tm.score(odd.withColumn("_y", F.lit("clash")), model).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in rows) == sorted((str(i), str(t)) for i, t in ODD)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert tm.score(empty, model).count() == 0
    assert tm.train(empty, labels).weights == {} and tm.train(odd, labels.limit(0)).weights == {}
    with pytest.raises(ValueError):
        tm.score(odd.withColumn("Score", F.lit(1)), model)


def plain_loss(rows, model, weights, bias, leak, ridge=2e-4):
    """Mean negative log-likelihood of the labels and the ridge, sentence by sentence."""
    total = 0.0
    for _, text, y in rows:
        log_not = np.log1p(-leak)
        for s in tm.sentences(text):
            found = {tm.feature_hash(f) for w in set(s.split()) for f in tm.word_features(w)}
            log_not -= np.logaddexp(0, bias + sum(weights[h] for h in found if h in weights))
        total -= np.log(max(-np.expm1(log_not), 1e-12)) if y else log_not
    return total / len(rows) + ridge / 2 * sum(w * w for w in weights.values())


def test_features_and_fit_against_brute_force(spark):
    """The features chosen are those of a plain count, and no small change of the weights fits the labels better."""
    rows, _ = corpus(240, 9)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(5)
    model = tm.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    seen = {0: {}, 1: {}}
    for _, text, y in rows:
        for h in {tm.feature_hash(f) for w in text.split() for f in tm.word_features(w)}:
            seen[y][h] = seen[y].get(h, 0) + 1
    d1 = sum(y for *_, y in rows)
    d0 = len(rows) - d1
    chosen = set()
    for h in seen[0].keys() | seen[1].keys():
        n1, n0 = seen[1].get(h, 0), seen[0].get(h, 0)
        p = (n1 + n0) / (d1 + d0)
        if n1 + n0 >= tm.MIN_DOCS and abs((n1 / d1 - n0 / d0) / np.sqrt(p * (1 - p) * (1 / d1 + 1 / d0) + 1e-12)) >= tm.MIN_Z:
            chosen.add(h)
    assert set(model.weights) == chosen and chosen
    best = plain_loss(rows, model, model.weights, model.bias, model.leak)
    rng = np.random.default_rng(3)
    for _ in range(25):
        moved = {h: w + 0.3 * rng.normal() for h, w in model.weights.items()}
        assert plain_loss(rows, model, moved, min(model.bias + 0.3 * rng.normal(), -1.0), model.leak) > best - 1e-3
    assert best < 0.6 * plain_loss(rows, model, dict.fromkeys(model.weights, 0.5), -5.0, 0.018)
    again = tm.train(df.select("doc_id", "text").repartition(2), df.select("doc_id", "toxic"))
    assert again.weights == model.weights and again.bias == model.bias            # however the rows are spread
