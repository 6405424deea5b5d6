import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from airshed.llm import quality_bayes as qb

from conftest import SF0001

from .conftest import ODD


def plain_strength(groups, means):
    """Variance of a document within its group over that of the groups' true means; groups: lists of probabilities."""
    n, k = sum(map(len, groups)), len(groups)
    noise = sum(len(g) * np.var(g) for g in groups) / (n - k)
    between = (sum(len(g) * (np.mean(g) - m) ** 2 for g, m in zip(groups, means)) - noise * k) / n
    return min(max(noise / between, 1.0), 1e6) if between > 1e-12 else 1e6


def brute_rates(rows):
    """The site rate of every (host, path, probability), each left out of its own host and path, from plain lists."""
    by = lambda key: {k: [x for r, x in zip(rows, [r[2] for r in rows]) if key(r) == k] for k in {key(r) for r in rows}}
    hosts, paths = by(lambda r: r[0]), by(lambda r: r[:2])
    rate = np.mean([r[2] for r in rows])
    m_host = plain_strength(list(hosts.values()), [rate] * len(hosts))
    whole = {h: (sum(g) + m_host * rate) / (len(g) + m_host) for h, g in hosts.items()}
    m_path = plain_strength(list(paths.values()), [whole[h] for h, _ in paths])
    out = []
    for h, p, x in rows:
        others, own = list(hosts[h]), list(paths[h, p])
        others.remove(x)
        own.remove(x)
        above = (sum(others) + m_host * rate) / (len(others) + m_host)
        out.append((sum(own) + m_path * above) / (len(own) + m_path))
    return out, m_path, m_host


def sites_of_rows(rng):
    rows = []
    for h in range(8):
        for p in range(rng.integers(1, 5)):
            rows += [(None if h == 7 else f"h{h}", None if p == 3 else f"p{p}", float(rng.beta(2 + h, 2 + p))) for _ in range(rng.integers(1, 40))]
    return rows


def test_posteriors_against_brute_force(spark):
    rows = sites_of_rows(np.random.default_rng(4))
    table, m_path, m_host, rate = qb.site_posteriors(spark.createDataFrame(rows, "h string, p string, p_text double"), "h", "p")
    _, want_path, want_host = brute_rates(rows)
    assert (m_path, m_host) == (pytest.approx(want_path), pytest.approx(want_host))
    assert rate == pytest.approx(np.mean([x for *_, x in rows]))
    got = {(r["site_host"], r["site_path"]): (r["path_n"], r["path_sum"], r["host_n"], r["host_sum"]) for r in table.collect()}
    for (h, p), v in got.items():
        host, path = [x for a, _, x in rows if a == h], [x for a, b, x in rows if (a, b) == (h, p)]
        assert v == (len(path), pytest.approx(sum(path)), len(host), pytest.approx(sum(host)))
    assert len(got) == len({r[:2] for r in rows})


def test_sparse_sites_shrink():
    assert qb.strength(10, 1000, 0.0, 200.0) == qb.STRENGTH[1]         # no spread: all sites alike
    assert qb.strength(10, 1000, 200.0, 200.0) < 10                    # wide spread: sites speak for themselves
    assert qb.strength(50, 50, 9.0, 0.0) == qb.STRENGTH[1]             # one document a site: nothing to tell apart


def test_the_only_document_of_a_host_takes_the_global_rate(spark):
    """Its own evidence must not come back to it through its host or its path."""
    rng = np.random.default_rng(2)
    text = lambda i: "word%d and more words, of an even length. " % i * (12 + i % 5)
    docs = [(i, text(i), f"h{i % 6}", f"p{i % 4}") for i in range(240)] + [(900, "!!! ### $$$ " * 40, "alone", "x"), (901, text(7), "lonely", "y")]
    labels = [(i, int(rng.random() < 0.8)) for i in range(240)]
    rows = qb.classify(spark.createDataFrame(docs, "doc_id long, text string, host string, path string"),
                       spark.createDataFrame(labels, "doc_id long, quality int"), "host", "path").collect()
    overall = np.mean([r["p_text"] for r in rows])
    alone = {r["doc_id"]: r for r in rows if r["doc_id"] >= 900}
    assert alone[900]["site_rate"] == pytest.approx(overall) and alone[901]["site_rate"] == pytest.approx(overall)
    want, _, _ = brute_rates([(r["host"], r["path"], r["p_text"]) for r in rows])
    assert [r["site_rate"] for r in rows] == pytest.approx(want)


def test_query_accuracy_and_verdict(spark):
    """Held-out accuracy: the model sees the labels of half of the documents."""
    docs, labels = spark.read.parquet(f"{SF0001}/documents.parquet"), spark.read.parquet(f"{SF0001}/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = qb.classify(docs, labels.where(fold), "source", "lang", carry=["doc_id"]).join(labels.where(~fold), "doc_id").select(
        F.col("kept"), labels["quality"].alias("y")).collect()
    assert len(rows) > 20 and np.mean([r["kept"] == bool(r["y"]) for r in rows]) >= 0.9
    out = E.queries()["op6_quality_bayes"](spark, SF0001).collect()
    assert len(out) == docs.count() and all(r["kept"] == (r["quality"] >= 0.5) and 0 < r["quality"] < 1 for r in out)


def test_combination_of_levels(spark):
    """quality = odds of the text with the training rate replaced by the site's rate without the document."""
    docs = spark.createDataFrame([(i, ("word%d " % i) * 60, "h", "p") for i in range(6)], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    rows = qb.classify(docs, labels, "source", "lang").collect()
    model = qb.train(docs, labels)
    want, _, _ = brute_rates([("h", "p", r["p_text"]) for r in rows])
    for r, site in zip(rows, want):
        z = math.log(r["p_text"] / (1 - r["p_text"])) - math.log(model.rate / (1 - model.rate)) + math.log(site / (1 - site))
        assert r["site_rate"] == pytest.approx(site) and r["quality"] == pytest.approx(1 / (1 + math.exp(-z)))


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (8, 0), (None, 1), (6, None)], "doc_id long, quality int")
    src = odd.withColumn("source", F.when(F.col("doc_id") > 4, "s")).withColumn("lang", F.lit(None).cast("string")).withColumn("x", F.lit([1.0]))
    rows = qb.classify(src, labels, "source", "lang").collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in rows) == sorted((str(i), str(t)) for i, t in ODD)
    assert all(r["quality"] is not None for r in rows)
    none = empty.withColumn("source", F.lit("a")).withColumn("lang", F.lit("b"))
    assert qb.classify(none, labels, "source", "lang").count() == 0
    assert qb.classify(src, labels.limit(0), "source", "lang").count() == len(ODD)   # no label at all
    with pytest.raises(ValueError):
        qb.classify(src.withColumn("KEPT", F.lit(1)), labels, "source", "lang")
