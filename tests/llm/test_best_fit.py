"""Token pieces against the tokenizers library; packing against its constraints and a bound."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from airshed.llm import best_fit
from airshed.llm.word_tokens import WordTokenizer

from conftest import SF0001

from .conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def cut(tok, text, size):
    ids = np.asarray(tok.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
    return [(k, at, len(ids[at:at + size]), zlib.crc32(ids[at:at + size].tobytes())) for k, at in enumerate(range(0, len(ids), size))]


def check_bins(rows, limit, max_documents=None, max_attention=None):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= limit
        assert max_documents is None or len(placed) <= max_documents
        assert max_attention is None or sum(n * n for _, n in placed) <= max_attention
    return len(bins)


def test_query(spark, tok, documents):
    rows = E.queries()["op4_best_fit"](spark, SF0001).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(
        (i, *p) for i, t in documents for p in cut(tok, t, 2048))
    made = check_bins(rows, 2048)
    assert made <= -(-sum(r["length"] for r in rows) // 2048) * 1.02 + 1


def test_words_equal_the_library(tok):
    texts = [t or "" for _, t in ODD] + ["don't 'tis WE'RE '' !'s x's's", "ÉtÉ ß×÷ ªµº", "á ́a é", "12.5% $$$ ***a***",
                                         "\xa0nb sp\x85x", "<|startoftext|>a<|x"]
    w = WordTokenizer(PATH)
    assert w.by_word
    for t, got in zip(texts, w.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t[:40]


def test_odd_rows(spark, tok, odd, empty):
    pieces = best_fit.token_pieces(odd, PATH, 512)
    rows = best_fit.pack(pieces, 512).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(
        (str(i), *p) for i, t in ODD for p in cut(tok, t, 512))
    check_bins(rows, 512)
    assert best_fit.pack(best_fit.token_pieces(empty, PATH, 512), 512).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_binds(spark, rule):
    rng = np.random.default_rng(3)
    pieces = spark.createDataFrame([(int(x), "extra") for x in rng.integers(1, 60, 900)], "length long, pack_group string")
    rows = best_fit.pack(pieces, 100, max_documents=5, max_attention=4000, rule=rule, group_pieces=200).collect()
    assert len(rows) == 900 and {r["pack_group"] for r in rows} == {"extra"}
    made = check_bins(rows, 100, 5, 4000)
    need = max(sum(r["length"] for r in rows) / 100, 900 / 5, sum(r["length"] ** 2 for r in rows) / 4000)
    assert made <= 1.25 * need + 5


def test_decreasing_best_fit_by_hand():
    bins, offsets = best_fit.pack_group(np.array([60, 50, 40, 50, 30]), (100, 100, 10000))
    assert bins[0] == bins[2] and bins[1] == bins[3] and offsets[2] == 60 and offsets[3] == 50 and bins[4] == 2
    with pytest.raises(ValueError):
        best_fit.pack_group(np.array([101]), (100, 10, 100000))


def test_every_capacity_takes_part_in_the_choice():
    """Weights of real size: never more sequences than by tokens alone, fewer where documents or attention bind."""
    rng = np.random.default_rng(11)
    lengths = np.minimum(rng.geometric(1 / 320, 4000), 2047)
    count = lambda cap, weights, rule="norm": best_fit.pack_group(lengths[lengths.astype(float) ** 2 <= cap[2]], cap, weights, rule)[0].max() + 1
    for cap in ((2048, 2048, 2048 ** 2), (2048, 8, 2048 ** 2), (2048, 7, 2048 * 1800)):
        for rule in ("norm", "dot"):
            assert count(cap, best_fit.WEIGHTS, rule) <= count(cap, (1.0, 1e-6, 1e-6), rule)
    assert count((2048, 8, 2048 ** 2), best_fit.WEIGHTS, "dot") < count((2048, 8, 2048 ** 2), (1.0, 1e-6, 1e-6), "dot")
    # two bins with as many tokens left: the piece goes where its documents and attention leave the rounder rest
    a, b = (best_fit.pack_group(np.array([60, 30, 30, 40]), (100, 3, 100 ** 2), w)[0].tolist() for w in ((1.0, 1.0, 1.0), (1.0, 0.0, 0.0)))
    assert a[0] == a[3] and b[0] == b[3]
