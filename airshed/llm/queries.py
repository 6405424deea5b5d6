"""The operators of this folder over the driver's tables, each with its DuckDB oracle if SQL can
express it (``None``: tested against a brute-force version in ``tests/llm``)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import read_table
from airshed.session import shared_path

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str | None] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        ORACLE[name] = oracle
        return fn
    return deco


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
     g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM g"""


@register("op2_warc_salvage", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back by the salvage reader; a gap in these fresh archives is an error."""
    from airshed.llm import warc
    path = shared_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    gap = F.raise_error(F.format_string("gap in a fresh archive: %s, bytes %d to %d: %s", "file", "start", "end", "reason")).cast("boolean")
    records = warc.salvage(spark, path).where(F.when(F.col("kind") == "record", F.lit(True)).otherwise(gap))
    page = lambda c: F.expr(f"cast(nullif(substring({c}, 9), '') as long)")  # noqa: E731  behind "urn:key:"
    return warc.resolve_revisits(records).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


@register("op4_best_fit")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    from airshed.llm import best_fit
    docs = read_table(spark, sf_dir, "documents")
    pieces = best_fit.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)
    return best_fit.pack(pieces, 2048)


#: CRC-32 of a text in DuckDB, which has no such function: byte by byte through the table of the 256 bytes' remainders (``tab``).
OP5_SQL = """
WITH tb AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda x, z: xor(x >> 1, 3988292384 * (x & 1))) AS c FROM (SELECT unnest(range(256)) AS i))),
     d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
                  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
                      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS text_crc32 FROM documents, tb),
     e AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM d),
     s AS (SELECT *, CAST(least(7, ((2 * upto - size) * 8) // (2 * total)) AS INTEGER) AS shard FROM e)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM s"""


@register("op5_prefix_shards", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 contiguous shards of nearly equal bytes."""
    from airshed.llm import prefix_shards as ps
    placed = ps.contiguous_shards(ps.document_sizes(read_table(spark, sf_dir, "documents")), 8, "doc_id", "size")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


OP8_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
     grams AS (SELECT doc_id, list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS gs FROM w WHERE len(ws) >= 3),
     win AS (SELECT doc_id, unnest(gs) AS g, unnest(range(1, len(gs) + 1)) AS i FROM grams),
     tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
     rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM tri WHERE c > 1) GROUP BY doc_id),
     ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM
              (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
     s AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
              length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
              coalesce(ln.n_dup, 0) AS n_dup_lines, coalesce(ln.n_lines, 0) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words
           FROM w LEFT JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
     b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 2 * n_upper > word_chars OR 2 * n_dup_lines > n_lines) AS kept
FROM b"""


@register("op8_rule_cascade", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality statistics and the verdict of the rule cascade for every document."""
    from airshed.llm import rule_cascade as rc
    return rc.cascade(read_table(spark, sf_dir, "documents"), rc.RULES, first=rc.BASE_RULES, stats=True, carry=["doc_id"])


@register("op10_sp_chunks")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the SentencePiece model, and their decoding, as digests."""
    from airshed.llm import sp_chunks
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sp_chunks.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


@register("op3_simhash_gray")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 3-word shingles, 2 bits."""
    from airshed.llm import simhash_gray
    return simhash_gray.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


OP7_SQL = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
     ws AS (SELECT doc_id, list_transform(range(1, len(ls) - 1), lambda i: ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2]) AS wins FROM l WHERE len(ls) >= 3),
     w AS (SELECT doc_id, unnest(wins) AS win, unnest(range(1, len(wins) + 1)) AS i FROM ws),
     o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS occurrence FROM w),
     c AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM o WHERE occurrence > 1),
     x AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM l),
     k AS (SELECT x.doc_id, string_agg(line, chr(10) ORDER BY p) FILTER (WHERE c.p IS NULL) AS kept, count(c.p) AS gone
           FROM x LEFT JOIN c USING (doc_id, p) GROUP BY x.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text,
       cast(coalesce(k.gone, 0) AS INTEGER) AS lines_removed
FROM documents d LEFT JOIN k USING (doc_id)"""


@register("op7_line_windows", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines under repeated three-line windows."""
    from airshed.llm import line_windows
    return line_windows.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op6_quality_bayes")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of every document; host: its source, path: its language within the source."""
    from airshed.llm import quality_bayes
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality_bayes.classify(docs, labels, "source", "lang", carry=["doc_id", "source", "lang"])


@register("op9_toxicity_mil")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside the held-out fold."""
    from airshed.llm import toxicity_mil
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    model = toxicity_mil.train(docs, labels.where(fold != 2))
    return (toxicity_mil.score(docs, model, carry=["doc_id"])
            .select("doc_id", (fold == 2).alias("held_out"), "score", "predicted", "offending"))


@register("op1_prefix_forest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest others of every embedding whose id is divisible by 20."""
    from airshed.llm import ann_forest
    return ann_forest.nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


#: CRC-32 of a decimal number in DuckDB, which has no such function: bit by bit over its characters.
SQL_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda ch: ord(ch)::BIGINT)), lambda c, ch:
     list_reduce(list_prepend(xor(c, ch), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""
SQL_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
OP12_LEAF = "sha256(" + " || ".join(SQL_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"

OP12_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, """ + OP12_LEAF.format(text="text") + """ AS leaf, """ + OP12_LEAF.format(
    text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """ AS lower_leaf,
         """ + SQL_CRC32.format("doc_id::VARCHAR") + """ % 3 = 0 AS tampered FROM documents),
lv AS (
  SELECT lang, 0 AS k, list(leaf ORDER BY doc_id, leaf) AS h FROM d GROUP BY lang
  UNION ALL
  SELECT lang, k + 1, list_transform(range(0, len(h), 8), lambda i: sha256(array_to_string(h[i + 1:i + 8], ''))) FROM lv WHERE len(h) > 1),
sub AS (SELECT lang, k AS top, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM lv WHERE len(h) = 1),
up AS (
  SELECT 0 AS k, list(subroot ORDER BY i) AS h FROM sub
  UNION ALL
  SELECT k + 1, list_transform(range(0, len(h), 8), lambda i: sha256(array_to_string(h[i + 1:i + 8], ''))) FROM up WHERE len(h) > 1),
fin AS (SELECT k AS top, h[1] AS root FROM up WHERE len(h) = 1),
p AS (SELECT d.*, sub.subroot, sub.top, sub.i AS ui, row_number() OVER (PARTITION BY d.lang ORDER BY doc_id, leaf) - 1 AS i
      FROM d JOIN sub ON d.lang IS NOT DISTINCT FROM sub.lang),
steps AS (
  SELECT doc_id, p.i AS row_i, p.lang, lv.k, lv.h, CAST(floor(p.i / pow(8, lv.k)) AS BIGINT) AS pos FROM p JOIN lv ON p.lang IS NOT DISTINCT FROM lv.lang AND lv.k < p.top
  UNION ALL
  SELECT doc_id, p.i, p.lang, p.top + up.k, up.h, CAST(floor(p.ui / pow(8, up.k)) AS BIGINT) FROM p CROSS JOIN up CROSS JOIN fin WHERE up.k < fin.top),
runs AS (SELECT doc_id, row_i, lang, k, array_to_string(h[pos - pos % 8 + 1:pos], '') AS before, array_to_string(h[pos + 2:pos - pos % 8 + 8], '') AS behind FROM steps),
path AS (SELECT doc_id, row_i, lang, sha256(string_agg(before || behind, '' ORDER BY k)) AS proof,
                list(before ORDER BY k) AS befores, list(behind ORDER BY k) AS behinds FROM runs GROUP BY doc_id, row_i, lang),
q AS (SELECT p.*, coalesce(proof, sha256('')) AS proof, befores, behinds FROM p LEFT JOIN path
      ON p.doc_id IS NOT DISTINCT FROM path.doc_id AND p.i = path.row_i AND p.lang IS NOT DISTINCT FROM path.lang),
f AS (
  SELECT doc_id, i, lang, 0 AS k, CASE WHEN tampered THEN lower_leaf ELSE leaf END AS x, befores, behinds FROM q
  UNION ALL
  SELECT doc_id, i, lang, k + 1, sha256(befores[k + 1] || x || behinds[k + 1]), befores, behinds FROM f WHERE k < coalesce(len(befores), 0))
SELECT q.doc_id, q.leaf, q.subroot, fin.root, q.proof AS proof_sha256, f.x AS folded_root, f.x = fin.root AS verified
FROM q JOIN f ON q.doc_id IS NOT DISTINCT FROM f.doc_id AND q.i = f.i AND q.lang IS NOT DISTINCT FROM f.lang AND f.k = coalesce(len(q.befores), 0)
CROSS JOIN fin"""


@register("op12_merkle_veb", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by language; every leaf, a third of them tampered with, proved against the root."""
    from airshed.llm import merkle_veb
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    manifest = merkle_veb.build(read_table(spark, sf_dir, "documents").select(*columns), columns, "lang", "doc_id", {"text": lower},
                                F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    return merkle_veb.verify(manifest).withColumnRenamed("key", "doc_id")


OP11_SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
     d AS (SELECT doc_id, len(ts) AS n, ts FROM t WHERE len(ts) > 0),
     s AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM d),
     p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS term FROM d) GROUP BY ALL),
     df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * s.N + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df CROSS JOIN s),
     q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
     sc AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * p.n * s.N) // s.L)))) AS BIGINT) AS score
            FROM q JOIN w USING (term) JOIN p USING (term) CROSS JOIN s GROUP BY item_id, doc_id),
     r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM sc WHERE score > 0)
SELECT * FROM r WHERE rank <= 20"""


@register("op11_lexical_hybrid", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    from airshed.llm import lexical_hybrid
    return lexical_hybrid.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 20)


@register("op13_token_files")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written to coded files and read back, as digests."""
    from airshed.llm import token_files
    path = shared_path(spark, "token-ids")
    token_files.write_ids(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_ids(spark, path)
