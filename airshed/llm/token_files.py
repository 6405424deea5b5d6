"""Token ids of a corpus in compressed binary files, in key order, and back.

A file is a run of blocks.  Each block holds at most ``BLOCK_IDS`` ids, coded by ``mixing_coder`` from an empty model, with the
keys and lengths of the documents they belong to.  Its header says which part of the corpus it is from, how many ids and documents
lie before it in the part, and the checksums of its bytes and of its ids, so every block can be found, checked
and decoded without any other.  A document that does not fit goes on in the next block.

Layout of a block, little-endian: ``TIDB``, version (16 bits), 16 bits unused, part, block's number in the part (32 bits each),
ids before it in the part, documents before its first (64 bits each), ids, pieces of documents, bytes of the pieces' table, bytes of the
coded ids, CRC-32 of the ids (as unsigned 32-bit integers), CRC-32 of all that (32 bits each); then the table (zlib: keys as 64 bits, counts
as 32 bits, marks as 8 bits: 1 null key, 2 document begins here, 4 ends here) and the coded ids.

Writing: rows are range-partitioned and sorted by key and encoded where they lie.  Blocks go through Spark's text writer as bytes in a string
column, as committed output on any file system Spark writes to, ``BLOCKS_PER_FILE`` to a file.

Defined results: null keys come first; rows with equal keys are ordered by a hash of the text, so repeated rows are documents of their own;
a null text is empty, and an empty text is its end id alone; an empty table gives no documents.  Texts are
encoded whole.  Only the two named columns are read; further columns may have any name.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.llm import mixing_coder
from airshed.llm.common import prepare, text_or_empty, written
from airshed.llm.word_tokens import tokenizer

MAGIC = b"TIDB"
VERSION = 1
HEADER = "<4sHHIIQQIIIIII"
HEADER_BYTES = struct.calcsize(HEADER)
BLOCKS_PER_FILE = 4
NULL_KEY, BEGINS, ENDS = 1, 2, 4


def pack_block(part: int, number: int, ids_before: int, docs_before: int, ids: np.ndarray, pieces: list[tuple]) -> bytes:
    """A block of ``ids``; ``pieces``: (key or None, count, begins, ends) of the documents in it."""
    keys = np.array([0 if p[0] is None else p[0] for p in pieces], "<i8")
    marks = np.array([NULL_KEY * (p[0] is None) | BEGINS * p[2] | ENDS * p[3] for p in pieces], "u1")
    table = zlib.compress(keys.tobytes() + np.array([p[1] for p in pieces], "<u4").tobytes() + marks.tobytes(), 1)
    coded, plain = mixing_coder.encode(ids), zlib.crc32(ids.astype("<u4").tobytes())
    head = lambda crc: struct.pack(HEADER, MAGIC, VERSION, 0, part, number, ids_before, docs_before, len(ids), len(pieces), len(table), len(coded), plain, crc)
    return head(zlib.crc32(coded, zlib.crc32(table, zlib.crc32(head(0))))) + table + coded


class Block:
    """A decoded block: its header's numbers, ``ids`` and ``pieces`` (key, count, begins, ends); ``end``: the byte behind it."""

    def __init__(self, data, at: int = 0):
        if len(data) - at < HEADER_BYTES:
            raise ValueError("block cut off in its header")
        fields = list(struct.unpack_from(HEADER, data, at))
        magic, version, _, self.part, self.number, self.ids_before, self.docs_before, n_ids, n_pieces, n_table, n_coded, plain, crc = fields
        if magic != MAGIC or version != VERSION:
            raise ValueError("not the beginning of a block")
        middle = at + HEADER_BYTES + n_table
        self.end = middle + n_coded
        if self.end > len(data):
            raise ValueError("block cut off")
        table, coded = bytes(data[at + HEADER_BYTES:middle]), bytes(data[middle:self.end])
        if zlib.crc32(coded, zlib.crc32(table, zlib.crc32(struct.pack(HEADER, *fields[:-1], 0)))) != crc:
            raise ValueError("block's checksum is wrong")
        self.ids = mixing_coder.decode(coded)
        if len(self.ids) != n_ids or zlib.crc32(self.ids.astype("<u4").tobytes()) != plain:
            raise ValueError("checksum of the decoded ids is wrong")
        raw = zlib.decompress(table)
        keys, counts, marks = np.frombuffer(raw, "<i8", n_pieces), np.frombuffer(raw, "<u4", n_pieces, 8 * n_pieces), np.frombuffer(raw, "u1", n_pieces, 12 * n_pieces)
        self.pieces = [(None if m & NULL_KEY else k, c, bool(m & BEGINS), bool(m & ENDS)) for k, c, m in zip(keys.tolist(), counts.tolist(), marks.tolist())]


def _blocks(tokenizer_path: str, end_id: int, block_ids: int):
    """Arrow batches of (key, text) in order -> blocks."""
    end = np.uint32(end_id).tobytes()

    def run(batches):
        part, tok = TaskContext.get().partitionId(), tokenizer(tokenizer_path)
        number = ids_before = docs_before = 0  # of the block being filled
        held, size, pieces = [], 0, []

        def close():
            nonlocal number, ids_before, docs_before, held, size, pieces
            block = pack_block(part, number, ids_before, docs_before, np.frombuffer(b"".join(held), np.uint32), pieces)
            number, ids_before, docs_before = number + 1, ids_before + size, docs_before + sum(p[3] for p in pieces)
            held, size, pieces = [], 0, []
            return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["block"])

        for b in batches:
            for key, ids in zip(b.column(0).to_pylist(), tok.encode(b.column(1).to_pylist())):
                ids, at = memoryview(ids + end), 0
                while at < len(ids):
                    take = min(len(ids) - at, 4 * (block_ids - size))
                    held.append(ids[at:at + take])
                    size += take // 4
                    pieces.append((key, take // 4, at == 0, at + take == len(ids)))
                    at += take
                    if size == block_ids:
                        yield close()
        if size:
            yield close()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
              block_ids: int = mixing_coder.BLOCK_IDS, blocks_per_file: int = BLOCKS_PER_FILE) -> None:
    """Write the ids of every text, each followed by ``end_id``, to files below ``path`` in ascending order of ``key``."""
    prepare(docs.sparkSession)
    rows = (docs.select(F.col(f"`{key}`").cast("long").alias("key"), text_or_empty(F.col(f"`{text}`").cast("string")).alias("text"))
            # the last column spreads a run of identical rows over several partitions
            .withColumns({"tie": F.xxhash64("text"), "copy": F.xxhash64(F.monotonically_increasing_id())}))
    order = ["key", "tie", "copy"]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
     .mapInArrow(_blocks(tokenizer_path, end_id, block_ids), "block binary").select(F.col("block").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", blocks_per_file).text(path))


PIECES = "part int, doc long, key long, at long, n long, crc long, begins boolean, ends boolean, ids binary"


def _pieces(with_ids: bool):
    """Files' bytes -> pieces of documents."""
    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                data, at = content.as_py(), 0
                while at < len(data):
                    try:
                        block = Block(data, at)
                    except (ValueError, zlib.error) as e:
                        raise ValueError(f"{name}, byte {at}: {e}") from e
                    raw, ids_at, doc, rows = memoryview(block.ids.astype("<u4").tobytes()), 0, block.docs_before, []
                    for key, count, begins, ends in block.pieces:
                        own = raw[4 * ids_at:4 * (ids_at + count)]
                        rows.append((block.part, doc, key, block.ids_before + ids_at, count, zlib.crc32(own), begins, ends, bytes(own) if with_ids else None))
                        ids_at, doc = ids_at + count, doc + ends
                    kinds = [pa.int32(), *[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.binary()]
                    names = ["part", "doc", "key", "at", "n", "crc", "begins", "ends", "ids"]
                    for i in range(0, len(rows), 4096):
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows[i:i + 4096]), kinds)], names=names)
                    at = block.end + 1  # a line end stands between blocks
    return run


def crc32_joined(crc1: int, crc2: int, bytes2: int) -> int:
    """CRC-32 of two runs of bytes one after the other, from that of each and the length of the second.

    The first is carried over ``bytes2`` zero bytes: a linear map over bits, raised to that power by squaring.
    """
    def apply(columns, v):
        out = 0
        for c in columns:
            if v & 1:
                out ^= c
            v >>= 1
        return out
    power = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    bits = 8 * bytes2
    while bits:
        if bits & 1:
            crc1 = apply(power, crc1)
        power = [apply(power, c) for c in power]
        bits >>= 1
    return crc1 ^ crc2


def _joined(batches):
    """Documents with their pieces in order -> one row each."""
    for b in batches:
        rows = []
        for part, doc, pieces in zip(*(b.column(c).to_pylist() for c in ("part", "doc", "pieces"))):
            if not (pieces[0]["begins"] and pieces[-1]["ends"]) or any(x["at"] + x["n"] != y["at"] for x, y in zip(pieces, pieces[1:])):
                raise ValueError(f"pieces of document {doc} of part {part} are missing")
            crc, ids = 0, [p["ids"] for p in pieces]
            for p in pieces:
                crc = crc32_joined(crc, p["crc"], 4 * p["n"])
            rows.append((part, doc, pieces[0]["key"], pieces[0]["at"], sum(p["n"] for p in pieces), crc, None if ids[0] is None else b"".join(ids)))
        kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["part", "doc", "key", "at", "n", "crc", "ids"])


def read_ids(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """The documents of the files below ``path``: key, start (ids before it in all files), n_tokens, ids_crc32 and, if asked for,
    ids (unsigned 32-bit little-endian).

    A damaged block is an error that names the file and the byte.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    pieces = written(files.mapInArrow(_pieces(with_ids), PIECES), "token-pieces")
    # one row for each part
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (pieces.groupBy("part").agg(F.sum("n").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")))
    whole = F.col("begins") & F.col("ends")
    fields = ["part", "doc", "key", "at", "n", "crc", "ids"]
    cut = (pieces.where(~whole).groupBy("part", "doc")
           .agg(F.sort_array(F.collect_list(F.struct("at", "n", "crc", "key", "begins", "ends", "ids"))).alias("pieces"))
           .mapInArrow(_joined, "part int, doc long, key long, at long, n long, crc long, ids binary"))
    rows = pieces.where(whole).select(*fields).unionByName(cut).join(parts, "part")
    return rows.select(F.col("key").alias(key), (F.col("ahead") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"),
                       F.col("crc").alias("ids_crc32"), *(["ids"] if with_ids else []))
