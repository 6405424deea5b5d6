import zlib

import __spark_entry__ as E
from airshed.llm import prefix_shards as ps

from conftest import SF0001

from .conftest import ODD


def brute(rows, shards):
    total, end, out = sum(s for _, s, _ in rows), 0, []
    seen = {}
    for i, s, c in rows:
        end += s
        k = min(shards - 1, (2 * end - s) * shards // (2 * total)) if total else 0
        out.append((i, s, c, k, seen.setdefault(k, 0)))
        seen[k] += 1
    return out


def size_row(i, t):
    b = (t or "").encode()
    return i, len(b) + 1, zlib.crc32(b)


def test_query_against_brute_force(spark, documents):
    df = E.queries()["op5_prefix_shards"](spark, SF0001)
    got = sorted((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect())
    assert got == sorted(brute([size_row(*d) for d in documents], 8))
    assert {(r["law"], r["grown_shard"]) for r in df.collect()} == {("bytes", None)}


def test_odd_rows_and_one_id_for_all(spark, odd, empty):
    rows = ps.contiguous_shards(ps.document_sizes(odd), 3, "doc_id", "size").collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    want = brute(sorted((size_row(i, t) for i, t in ODD), key=order), 3)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"]) for r in rows) == sorted((str(w[0]), *w[1:4]) for w in want)
    assert ps.contiguous_shards(ps.document_sizes(empty), 3, "doc_id", "size").count() == 0
    same = spark.createDataFrame([(7, 10, 1)] * 1000, "doc_id long, size long, text_crc32 long")
    rows = ps.contiguous_shards(same, 8, "doc_id", "size").collect()
    for k in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(125))
    none = spark.createDataFrame([(1, None), (2, 0)], "doc_id long, size long")
    assert {r["shard"] for r in ps.contiguous_shards(none, 4, "doc_id", "size").collect()} == {0}
