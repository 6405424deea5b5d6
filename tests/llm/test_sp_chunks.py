"""The chunk table against the sentencepiece library on whole texts."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as E
from airshed.llm import sp_chunks

from conftest import SF0001

from .conftest import ODD

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def whole(sp, text):
    ids = sp.encode(text or "", add_bos=True, add_eos=True)
    return ids, sp.decode(ids)


def test_model_allows_chunks(sp):
    assert not sp_chunks.crosses_markers(sp)


@pytest.mark.parametrize("text", ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "a▁b", "▁ ▁a ", "x\n y\n\nz", "\x00 a", "<s> </s> <0x41>",
                                  "\U0001f600 中文 café", "      deep   spaces      ", "tab\there", "1234 5,6.7"])
def test_chunks_equal_the_library(sp, text):
    enc = sp_chunks.ChunkEncoder(MODEL)
    ids, decoded = whole(sp, text)
    got = enc.encode([text])[0]
    assert memoryview(got).cast("I").tolist() == ids
    assert enc.decode(got) == decoded


def test_query_equals_the_library_on_every_document(spark, sp, documents):
    rows = {r["doc_id"]: r for r in E.queries()["op10_sp_chunks"](spark, SF0001).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        ids, decoded = whole(sp, text)
        r = rows[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows_and_extra_columns(spark, sp, odd, empty):
    from pyspark.sql import functions as F
    src = odd.withColumn("sp_text", F.lit("mine")).withColumn("n_chars", F.lit(None).cast("long"))
    rows = sp_chunks.encode_decode(src, MODEL).collect()
    assert sorted((str(r["doc_id"]), str(r["text"]), r["ids"], r["decoded"], r["sp_text"]) for r in rows) == sorted(
        (str(i), str(t), *whole(sp, t), "mine") for i, t in ODD)
    assert sp_chunks.encode_decode(empty, MODEL, digests=True).count() == 0
    with pytest.raises(ValueError):
        sp_chunks.encode_decode(odd.withColumn("IDS", F.lit(1)), MODEL)
    small = sp_chunks.ChunkEncoder(MODEL)
    small.encode(["a b c"])
    assert set(small.table) == {"a", "b", "c"}


def test_head_and_joined_tail_give_the_same(spark, sp, documents):
    """With a head of any size, in groups of any size; every distinct chunk is segmented once."""
    rows = documents[:40]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, *whole(sp, t)) for i, t in rows)
    for head, size in ((0, 1 << 25), (50, 20_000), (10 ** 6, 1)):
        got = sp_chunks.encode_decode(df, MODEL, head_chunks=head, group_bytes=size).collect()
        assert sorted((r["doc_id"], r["ids"], r["decoded"]) for r in got) == want
    table = sp_chunks.chunk_table(df.select("text"), MODEL, 7).collect()
    enc = sp_chunks.ChunkEncoder(MODEL)
    words = [c for cs in enc.split([t for _, t in rows]) for c in cs]
    entries = [e for r in table for e in zip(*sp_chunks.unpacked(r["packed"]))]
    assert {c: n for c, n, _ in entries} == {c: words.count(c) for c in set(words)} and len(entries) == len(set(words))
    assert [list(memoryview(x).cast("I")) for c, _, x in entries if c == "of"] in ([], [sp.encode("of")])


def test_the_head_is_the_most_frequent_and_bounded(spark, documents):
    df = spark.createDataFrame(documents, "doc_id long, text string")
    table = sp_chunks.chunk_table(df.select("text"), MODEL, 5)
    n = {c: k for r in table.collect() for c, k, _ in zip(*sp_chunks.unpacked(r["packed"]))}
    for most in (0, 1, 100, 3000, 10 ** 6):
        head = sp_chunks.unpacked(sp_chunks.head_of(table, most))[0]
        assert len(head) <= most and len(set(head)) == len(head)
        if head and len(head) < len(n):
            assert min(n[c] for c in head) > max(n[c] for c in n if c not in set(head) and len(c) <= sp_chunks.HEAD_CHARS)
    assert len(head) == sum(len(c) <= sp_chunks.HEAD_CHARS for c in n)


def test_no_text_is_shuffled(spark, documents):
    df = spark.createDataFrame(documents[:40], "doc_id long, text string")
    plan = sp_chunks.encode_decode(df, MODEL, digests=True, head_chunks=10)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Exchange" in x and "packed" in x] and "Bucketed: true" in plan
