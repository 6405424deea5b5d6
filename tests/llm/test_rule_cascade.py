from collections import Counter

import pytest
import regex

from airshed.llm import rule_cascade as rc

from .conftest import ODD


def brute(text):
    t = text or ""
    words = regex.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if regex.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark, documents, odd, empty):
    for _, text in [*documents, *ODD, (0, "a b c a b c"), (0, "a a a a"), (0, "x\n\nx\n x\nx"), (0, "a b c d")]:
        s = rc.TextStats(text)
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == brute(text)
    rows = rc.cascade(odd, rc.RULES, first=rc.BASE_RULES, stats=True).collect()
    assert sorted((str(r["doc_id"]), *(r[c] for c in rc.STATS)) for r in rows) == sorted((str(i), *brute(t)) for i, t in ODD)
    assert rc.cascade(empty, rc.RULES).count() == 0


def test_short_circuit_order_and_verdict(spark):
    ran = []
    cheap = rc.Rule("cheap", lambda s: ran.append("cheap") or "bad" in s.text)
    dear = rc.Rule("dear", lambda s: ran.append("dear") or len(s.text) > 100)
    measured = [{"rule": 0, "texts": 10, "rejected": 5, "seconds": 9.0}, {"rule": 1, "texts": 10, "rejected": 4, "seconds": 1.0}]
    assert [r.name for r in rc.order_rules([dear, cheap], measured)] == ["cheap", "dear"]
    assert [r.name for r in rc.order_rules([dear, cheap], [])] == ["dear", "cheap"]
    df = spark.createDataFrame([("bad",), ("good",), ("x" * 200,), (None,)], "text string")
    rows = rc.cascade(df, [rc.Rule("bad", lambda s: "bad" in s.text), rc.Rule("long", lambda s: len(s.text) > 100)]).collect()
    assert [r["kept"] for r in rows] == [False, True, False, True]
    with pytest.raises(ValueError):
        rc.cascade(df.selectExpr("text", "true as KEPT"), rc.RULES)


def test_estimate_counts_every_sampled_text(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string")
    m = rc.estimate(df, rc.BASE_RULES)
    assert [x["texts"] for x in m] == [len(documents)] * 2 and all(x["seconds"] > 0 for x in m)
    assert m[0]["rejected"] == sum(brute(t)[0] < 50 for _, t in documents)
