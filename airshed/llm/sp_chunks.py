"""SentencePiece encoding and decoding through a table of distinct chunks.

A SentencePiece BPE model whose pieces never have a white-space marker behind another
character cannot merge across the start of a marked word.  So a text falls into chunks, each a
run of markers and the characters up to the next marker, that are segmented independently of
each other.

1. Each task counts its chunks and hands on a packed, compressed list for each of as many buckets (of the chunk's hash) as there are
   shuffle partitions.  A bucket's lists are added up, and every distinct chunk is segmented once: the written chunk table.
2. The table's most frequent short chunks, ``HEAD_CHUNKS`` at most, are sent to the workers.
3. Texts are put together in groups of about ``GROUP_BYTES``, written compressed and bucketed by group, with the lists (by bucket)
   of the group's chunks that the head lacks.
4. These meet the table in a join on the bucket, which gives their ids, and the ids go back to their group in another; the groups
   are bucketed, so no text is shuffled.
5. In its group each text's ids are the entries of head and tail joined in order of position.

The fast path is only taken when the loaded model proves it right (``crosses_markers`` looks at
all pieces and the normaliser); other models are applied to whole texts.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from array import array
from collections import Counter
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import fresh_name, prepare, refuse, worker_cache, written
from airshed.session import shared_path

MARK = "▁"
#: Chunks that a ``ChunkEncoder`` used on its own keeps before its table starts anew (a memory bound, not a cut).
TABLE_CHUNKS = 400_000
#: Chunks sent to the workers at most (some 100 MB in each), of at most this many characters; all others are joined.
HEAD_CHUNKS, HEAD_CHARS = 500_000, 64
#: Bytes of text put together in a group, unless one text is longer; distinct chunks counted in a task before they are handed on.
GROUP_BYTES = 32 << 20
COUNTED = 1_000_000


def crosses_markers(sp) -> bool:
    """True if chunks of this model are not independent: a piece holds a marker behind another
    character, or the normaliser does more than turn spaces into markers."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    proto.ParseFromString(sp.serialized_model_proto())
    norm = proto.normalizer_spec
    if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix
            or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
            or proto.trainer_spec.model_type != pb.TrainerSpec.BPE):
        return True
    own = pb.ModelProto.SentencePiece.USER_DEFINED
    return any(p.type == own or re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces)


class ChunkEncoder:
    """Encodes texts with a bounded table chunk -> ids (as little-endian 32-bit integers)."""

    def __init__(self, model: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.whole = crosses_markers(self.sp)
        self.table: dict[str, bytes] = {}
        self.chunk = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        pack = lambda ids: array("I", ids).tobytes()
        # a model without begin or end id has none in front or behind
        self.pack, self.bos, self.eos = pack, *(pack([i]) if i >= 0 else b"" for i in (self.sp.bos_id(), self.sp.eos_id()))

    def chunks(self, text: str) -> list[str]:
        """The chunks of a non-empty text, without the first marker of each."""
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [c[1:] for c in self.chunk.findall(MARK + text.replace(" ", MARK))]

    def learn(self, new: list[str]) -> None:
        """Segment chunks that the table lacks.  The library puts a marker in front of its input
        itself, so a chunk is passed without its first one; a lone marker is its own piece."""
        self.table.update(zip(new, self.segmented(new)))

    def segmented(self, chunks: list[str]) -> list[bytes]:
        ids = self.sp.encode([c.replace(MARK, " ") for c in chunks], num_threads=1)
        return [self.pack(x) if c else self.pack(self.sp.encode_as_ids("x ")[-1:]) for c, x in zip(chunks, ids)]

    def split(self, texts: list[str]) -> list[list[str]]:
        return [self.chunks(t) if t else [] for t in texts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end ids."""
        if self.whole:
            return [self.bos + self.pack(x) + self.eos for x in self.sp.encode(texts, num_threads=1)]
        if len(self.table) > TABLE_CHUNKS:
            self.table.clear()
        split = self.split(texts)
        new = list({c for cs in split for c in cs if c not in self.table})
        if new:
            self.learn(new)
        get = self.table.__getitem__
        return [self.bos + b"".join(map(get, cs)) + self.eos for cs in split]

    def decode(self, ids: bytes) -> str:
        return self.sp.decode(memoryview(ids).cast("I").tolist())


def encoder(model: str) -> ChunkEncoder:
    kept = worker_cache("sp_chunks")
    if model not in kept:
        kept[model] = ChunkEncoder(model)
    return kept[model]


def encode_decode(df: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids",
                  decoded_col: str = "decoded", digests: bool = False, head_chunks: int = HEAD_CHUNKS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``df`` with the ids (array<int>, begin and end ids included) and the decoded text of each row.

    * null and empty texts have the begin and end ids only and decode to the empty text;
    * ``digests=True`` returns ``n_tokens``, ``ids_sha256`` (of the ids as little-endian 32-bit
      integers) and ``decoded_sha256`` instead, so ids and texts never leave the Python task;
    * other columns pass through, whatever their names; an output name that ``df`` already has
      raises ``ValueError``.
    """
    spark = prepare(df.sparkSession)
    extra = ([("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
             if digests else [(ids_col, T.ArrayType(T.IntegerType())), (decoded_col, T.StringType())])
    refuse(df.columns, [n for n, _ in extra])
    work = fresh_name(df, "sp_text")
    src = df.withColumn(work, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    if digests:  # the text itself is not carried through
        src = src.drop(text_col)
    keep = [c for c in src.columns if c != work]
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(n, t) for n, t in extra])

    def results(b, ids, enc):
        """Output batch of the rows of ``b`` (kept columns and text) with their ids."""
        text = [enc.decode(x) for x in ids]
        cols = [b.column(b.schema.get_field_index(c)) for c in keep]
        if digests:
            cols += [pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in text], pa.string())]
        else:
            cols += [pa.array([memoryview(x).cast("I").tolist() for x in ids], pa.list_(pa.int32())), pa.array(text, pa.string())]
        return pa.RecordBatch.from_arrays(cols, names=keep + [n for n, _ in extra])

    if ChunkEncoder(model).whole:
        def whole(batches):
            enc = encoder(model)
            for b in batches:
                yield results(b, enc.encode(b.column(b.schema.get_field_index(work)).to_pylist()), enc)
        return src.mapInArrow(whole, schema)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = chunk_table(src.select(F.col(f"`{work}`").alias("text")), model, buckets)
    head, name = spark.sparkContext.broadcast(head_of(table, head_chunks)), uuid.uuid4().hex

    def known() -> dict[str, bytes]:
        """The head as a dict, built once in a worker; that of another call makes room."""
        kept = worker_cache("sp_heads")
        if name not in kept:
            kept.clear()
            kept[name] = dict(zip(*unpacked(head.value)))
        return kept[name]

    def groups(batches):
        enc, have, part = encoder(model), known(), TaskContext.get().partitionId() << 32
        held, size, tail = [], 0, set()

        def close():
            nonlocal held, size, tail, part
            wanted = [{"bucket": k, "packed": packed(cs)} for k, cs in by_bucket(tail, buckets).items()]
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([packed_batches(held)], pa.binary()), pa.array([wanted], WANTED)],
                                             names=["grp", "packed", "wanted"])
            part, held, size, tail = part + 1, [], 0, set()
            return out

        for b in batches:
            if held and size + b.nbytes > group_bytes:
                yield close()
            for cs in enc.split(b.column(b.schema.get_field_index(work)).to_pylist()):
                tail.update(c for c in cs if c not in have)
            held.append(b)
            size += b.nbytes
        if held:
            yield close()

    def looked_up(asked: pa.Table, chunks: pa.Table) -> pa.Table:
        """The ids of the chunks that groups ask for in one bucket, in the order of their lists."""
        ids = {c: x for part in chunks.column("packed").to_pylist() for c, _, x in zip(*unpacked(part))}
        found = [packed([ids[c] for c in unpacked(x)[0]]) for x in asked.column("packed").to_pylist()]
        return pa.table({"grp": asked.column("grp"), "bucket": asked.column("bucket"), "found": pa.array(found, pa.binary())})

    def joined(batches):
        enc, have = encoder(model), known()
        for b in batches:
            for rows_of, wanted, found in zip(*(c.to_pylist() for c in b.columns)):
                own, ids_by = {}, {x["bucket"]: x["found"] for x in found or []}
                for w in wanted:
                    own.update(zip(unpacked(w["packed"])[0], unpacked(ids_by[w["bucket"]])[0]))

                def ids_of(c):
                    ids = have.get(c)
                    return own[c] if ids is None else ids

                for rows in batches_of(rows_of):
                    texts = rows.column(rows.schema.get_field_index(work)).to_pylist()
                    yield results(rows, [enc.bos + b"".join(map(ids_of, cs)) + enc.eos for cs in enc.split(texts)], enc)

    stored = f"sp_groups_{name}"
    (src.mapInArrow(groups, "grp long, packed binary, wanted array<struct<bucket: int, packed: binary>>")
     .write.bucketBy(buckets, "grp").option("path", shared_path(spark, "sp-groups")).saveAsTable(stored))
    asked = spark.table(stored).select("grp", F.inline("wanted"))
    found = (asked.groupBy("bucket").cogroup(table.select("bucket", "packed").groupBy("bucket")).applyInArrow(looked_up, "grp long, bucket int, found binary")
             .groupBy("grp").agg(F.collect_list(F.struct("bucket", "found")).alias("found")))  # a row for each bucket at most
    return spark.table(stored).join(found, "grp", "left").select("packed", "wanted", "found").mapInArrow(joined, schema)


WANTED = pa.list_(pa.struct([("bucket", pa.int32()), ("packed", pa.binary())]))
#: Steps of an octave in which counts are told apart when the head is chosen.
STEPS = 8


def packed_batches(batches: list) -> bytes:
    """Arrow batches of one schema, compressed."""
    import zstandard
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema) as w:
        for x in batches:
            w.write_batch(x)
    return zstandard.ZstdCompressor(6).compress(sink.getvalue().to_pybytes())


def batches_of(data: bytes):
    import zstandard
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data))


def packed(*columns: list) -> bytes:
    """Lists of equal length as one compressed Arrow batch."""
    return packed_batches([pa.RecordBatch.from_arrays([pa.array(c) if c else pa.array(c, pa.binary()) for c in columns], names=[str(i) for i in range(len(columns))])])


def unpacked(data: bytes) -> list[list]:
    return [c.to_pylist() for c in batches_of(data).read_all().columns]


def by_bucket(chunks, buckets: int) -> dict[int, list[str]]:
    """Chunks in order, by the bucket of their hash."""
    out: dict[int, list[str]] = {}
    for c in sorted(chunks):
        out.setdefault(zlib.crc32(c.encode()) % buckets, []).append(c)
    return out


def chunk_table(texts: DataFrame, model: str, buckets: int) -> DataFrame:
    """Every distinct chunk of the column ``text``, segmented once: a row for each ``bucket`` with its chunks, their numbers of
    occurrences and ids (``packed``), and how many short chunks occur how often (``often``); written."""
    def count(batches):
        enc, seen = encoder(model), Counter()

        def out():
            rest = iter(by_bucket(seen, buckets).items())
            while part := dict(islice(rest, 256)):
                yield pa.RecordBatch.from_arrays([pa.array(list(part), pa.int32()), pa.array([packed(cs, [seen[c] for c in cs]) for cs in part.values()], pa.binary())],
                                                 names=["bucket", "packed"])

        for b in batches:
            for cs in enc.split(b.column(0).to_pylist()):
                seen.update(cs)
            if len(seen) > COUNTED:
                yield from out()
                seen = Counter()
        yield from out()

    def segment(rows: pa.Table) -> pa.Table:
        enc, seen = encoder(model), Counter()
        for part in rows.column("packed").to_pylist():
            for c, n in zip(*unpacked(part)):
                seen[c] += n
        chunks = sorted(seen)
        ids = []
        for at in range(0, len(chunks), 1 << 14):
            ids += enc.segmented(chunks[at:at + (1 << 14)])
        often = [0] * (64 * STEPS)
        for c, n in seen.items():
            if len(c) <= HEAD_CHARS:
                often[level_of(n)] += 1
        return pa.table({"bucket": rows.column("bucket").slice(0, 1), "often": pa.array([often], pa.list_(pa.int64())),
                         "packed": pa.array([packed(chunks, [seen[c] for c in chunks], ids)], pa.binary())})

    counted = texts.mapInArrow(count, "bucket int, packed binary")
    return written(counted.groupBy("bucket").applyInArrow(segment, "bucket int, often array<long>, packed binary"), "sp-chunks")


def level_of(n: int) -> int:
    return int(STEPS * math.log2(n))


def head_of(table: DataFrame, most: int) -> bytes:
    """The most frequent chunks of at most ``HEAD_CHARS`` characters and their ids, packed: all that occur more often than
    a number chosen so that they are ``most`` at most."""
    often = {r["pos"]: r["k"] for r in table.select(F.posexplode("often").alias("pos", "k")).groupBy("pos").agg(F.sum("k").alias("k")).collect()}
    least, total = 64 * STEPS, 0
    while least > 0 and total + often.get(least - 1, 0) <= most:
        least -= 1
        total += often.get(least, 0)

    def chosen(batches):
        for b in batches:
            for part in b.column(0).to_pylist():
                rows = [(c, x) for c, n, x in zip(*unpacked(part)) if len(c) <= HEAD_CHARS and level_of(n) >= least]
                yield pa.RecordBatch.from_arrays([pa.array([packed([c for c, _ in rows], [x for _, x in rows])] if rows else [], pa.binary())], names=["packed"])

    chunks, ids = [], []
    for r in table.select("packed").mapInArrow(chosen, "packed binary").collect():  # bounded by ``most``
        c, x = unpacked(r["packed"])
        chunks += c
        ids += x
    return packed(chunks, ids)
