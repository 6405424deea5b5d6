"""Context-mixing coder and token files: exact round trips, damage, and the library's ids."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import mixing_coder as C
from airshed.llm import token_files as T
from airshed.llm import word_tokens
from airshed.session import shared_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def same(ids):
    ids = np.asarray(ids, np.uint32)
    return np.array_equal(C.decode(C.encode(ids)), ids)


@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 3), max_size=300))
@settings(max_examples=150, deadline=None)
def test_any_ids_come_back(ids):
    assert same(ids)


@pytest.mark.parametrize("n", [1, 255, 256, 511, 512, 513, 70000])
def test_lanes_of_uneven_length_come_back(n):
    rng = np.random.default_rng(n)
    assert same(rng.integers(0, 49408, n))
    assert same(np.minimum(rng.geometric(0.01, n), 5000))
    assert same(np.zeros(n, int)) and same(np.arange(n) * 61000 % 2 ** 32)


@pytest.mark.parametrize("n, distinct, size, crc", [
    (1, 9, 14, 2652297791), (300, 50, 539, 3205261227), (100_003, 5000, 121176, 2799958606), (1_100_005, 40_000, 1528978, 215670434),
    (70_000, 1 << 23, 166450, 3548141521)])
def test_coded_bytes_stay_as_they_were(n, distinct, size, crc):
    """Blocks written earlier must be read: the bytes of the coder as first written, of lanes of even and uneven length."""
    i = np.arange(n, dtype=np.int64)
    ids = (((i * 2654435761 >> 7) ^ (i >> 3)) % distinct * (i % 5 > 1) + i % 3).astype(np.uint32)
    coded = C.encode(ids)
    assert (len(coded), zlib.crc32(coded)) == (size, crc)
    assert np.array_equal(C.decode(coded), ids)


def test_words_of_letters_alone_are_not_cut(monkeypatch):
    """A word of letters is one piece: the search for pieces, a large part of the cost of a new word, is left out."""
    words = ["river", "Éßøÿ", "straße", "ÀÞ", "x"]
    tok = word_tokens.WordTokenizer(TOKENIZER)
    monkeypatch.setattr(word_tokens, "PIECE", None)
    for w in words:
        assert np.frombuffer(tok.words[w], np.uint32).tolist() == tok.tok.encode(w, add_special_tokens=False).ids
    monkeypatch.undo()
    for w in ("it's", "a1b", "ªº", "a×b", "don't!!"):
        assert np.frombuffer(tok.words[w], np.uint32).tolist() == tok.tok.encode(w, add_special_tokens=False).ids


def test_every_order_helps():
    """Bits an id: frequencies alone, a successor given by one id before, by two before."""
    rng = np.random.default_rng(3)
    n, k = 300_000, 256
    bits = lambda x: 8 * len(C.encode(np.asarray(x, np.uint32))) / len(x)
    flat, steep = rng.integers(0, k, n), np.minimum(rng.geometric(0.2, n), k - 1)
    assert bits(flat) < 8.8 and bits(steep) < 4.4
    after = rng.integers(0, k, k)
    one = [0]
    for r, jump in zip(rng.random(n), rng.integers(0, k, n)):
        one.append(int(after[one[-1]]) if r < 0.9 else int(jump))
    assert bits(one) < 3
    pair = rng.integers(0, k, (k, k))
    two = [0, 1]
    for r, jump in zip(rng.random(n), rng.integers(0, k, n)):
        two.append(int(pair[two[-2], two[-1]]) if r < 0.97 else int(jump))
    assert bits(two) < bits(flat) / 1.7


def test_a_block_checks_itself():
    ids = np.random.default_rng(1).integers(0, 500, 5000).astype(np.uint32)
    data = T.pack_block(3, 7, 11, 2, ids, [(None, 2000, False, True), (-5, 3000, True, True)])
    block = T.Block(data)
    assert (block.part, block.number, block.ids_before, block.docs_before, block.end) == (3, 7, 11, 2, len(data))
    assert np.array_equal(block.ids, ids) and block.pieces == [(None, 2000, False, True), (-5, 3000, True, True)]
    rng = random.Random(2)
    for _ in range(200):
        bad = bytearray(data)
        i = rng.randrange(len(bad))
        bad[i] ^= 1 << rng.randrange(8)
        with pytest.raises(ValueError):
            T.Block(bytes(bad))
    for cut in (0, 10, T.HEADER_BYTES, len(data) - 1):
        with pytest.raises(ValueError):
            T.Block(data[:cut])


@given(st.binary(max_size=60), st.binary(max_size=60))
@settings(max_examples=100, deadline=None)
def test_checksums_join(a, b):
    assert T.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(rows):
    """Rows (key, text) in the files' order up to repeated keys -> key -> list of (n, crc), and the total."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    out = {}
    for key, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.setdefault(key, []).append((len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
    return out


def check(spark, df, rows, **how):
    path = shared_path(spark, "test-token-ids")
    T.write_ids(df, path, TOKENIZER, 1, **how)
    got = T.read_ids(spark, path, with_ids=True).collect()
    want = expected(rows)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got), key=repr) == sorted(((k, *x) for k, v in want.items() for x in v), key=repr)
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # gapless, keys ascending, null first
        assert r.start == at
        at += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    return path


@pytest.mark.parametrize("how", [{}, {"block_ids": 300, "blocks_per_file": 2}])
def test_given_documents_by_the_library(spark, documents, how):
    rows = documents[:] if not how else documents[:60]
    random.Random(4).shuffle(rows)
    check(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, **how)


def test_odd_rows_and_clashing_columns(spark, odd):
    rows = [tuple(r) for r in odd.collect()]
    names = ["key", "tie", "copy", "block", "value", "part", "doc", "ids", "start", "n_tokens"]
    df = spark.createDataFrame([(*r, *[0] * len(names)) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} int" for c in names))
    check(spark, df, rows, block_ids=5000)


def test_empty_table_and_damaged_file(spark, empty, documents):
    import glob
    path = check(spark, empty, [])
    assert T.read_ids(spark, path).count() == 0
    path = check(spark, spark.createDataFrame(documents[:40], "doc_id long, text string").coalesce(1), documents[:40])
    name = max(glob.glob(path.removeprefix("file:") + "/part-*"), key=lambda f: len(open(f, "rb").read()))
    data = bytearray(open(name, "rb").read())
    data[len(data) // 2] ^= 4
    copy = shared_path(spark, "test-token-damaged")
    spark.createDataFrame([(bytes(data),)], "b binary").selectExpr("cast(b as string) value").coalesce(1).write.text(copy)
    with pytest.raises(Exception, match="byte 0: block's checksum is wrong"):
        T.read_ids(spark, copy).count()
