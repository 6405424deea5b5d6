"""Vector best-fit packing of documents into training sequences.

A bin (sequence) has three capacities: tokens, documents and attention cost (the sum of squared
lengths).  Pieces are taken in decreasing order of their largest share of a capacity; among the
open bins where a piece fits under EVERY capacity, the one with the smallest weighted residual
norm after placing it (``rule="norm"``) or the largest weighted dot product of demand and residual
(``rule="dot"``) is selected; if none fits, a bin is opened.

At scale the pieces are dealt at random into groups of about ``GROUP_PIECES``, each packed by one
task.  A group of some thousand pieces of mixed lengths leaves less than about one bin unfilled,
so the number of sequences stays within a few hundredths of a percent of packing all pieces
together, and no task or driver ever holds more than a group.  Pieces that fill a sequence by
themselves are bins of their own and are not dealt.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import fresh_name, prepare, refuse, written
from airshed.llm.word_tokens import tokenizer

#: Pieces packed together by one task.
GROUP_PIECES = 8192
#: Weights of the residual shares of tokens, documents and attention cost in the choice of a bin.
WEIGHTS = (1.0, 1.0, 1.0)


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 0) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its token ids and then ``end_id``; one longer than ``max_tokens`` is cut into
    pieces of ``max_tokens``, the last may be shorter.  Null and empty texts are the single ``end_id``.
    """
    prepare(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    width, end = 4 * max_tokens, int(end_id).to_bytes(4, "little")

    def run(batches):
        tok = tokenizer(tokenizer_path)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(tok.encode(b.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=schema.names)

    return src.mapInArrow(run, schema)


def pack_group(lengths: np.ndarray, capacity: tuple[int, int, int], weights=WEIGHTS, rule: str = "norm"):
    """Bin and offset of each piece of one group."""
    n = len(lengths)
    cap = np.asarray(capacity, float)
    demand = np.stack([lengths, np.ones(n), lengths.astype(float) ** 2], axis=1) / cap
    if (demand > 1).any():
        raise ValueError("a piece alone exceeds a capacity")
    w = np.asarray(weights, float)
    order = np.argsort(-demand.max(axis=1), kind="stable")
    left = np.empty((n, 3))  # residual shares of the bins that can still take the smallest piece
    name = np.empty(n, np.int64)
    bins, offsets, used = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    open_, made, least = 0, 0, demand.min(axis=0) if n else cap
    slack = 1e-12
    for i in order:
        d = demand[i]
        at = -1
        if open_:
            r = left[:open_]
            fits = (r[:, 0] + slack >= d[0]) & (r[:, 1] + slack >= d[1]) & (r[:, 2] + slack >= d[2])
            if fits.any():
                if rule == "norm":
                    rest = r - d
                    at = int(np.argmin(np.where(fits, (rest * rest) @ w, np.inf)))
                else:
                    at = int(np.argmax(np.where(fits, r @ (w * d), -np.inf)))
        if at < 0:
            at, open_ = open_, open_ + 1
            left[at], name[at], made = 1.0, made, made + 1
        b = name[at]
        bins[i], offsets[i] = b, used[b]
        used[b] += lengths[i]
        left[at] -= d
        if (left[at] + slack < least).any():  # full: the last open bin takes its place
            open_ -= 1
            left[at], name[at] = left[open_], name[open_]
    return bins, offsets


def pack(pieces: DataFrame, max_tokens: int, max_documents: int | None = None, max_attention: int | None = None,
         weights=WEIGHTS, rule: str = "norm", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (any columns, with ``length`` >= 0) with ``sequence_id`` and ``offset``.

    ``max_documents`` and ``max_attention`` default to the values that ``max_tokens`` implies
    (one token per document, one document as long as the sequence).  A piece that exceeds a
    capacity by itself raises.  Rows are told apart by their place in the written table, so
    repeated rows are packed each on its own; an empty table gives an empty result.  Columns may have any name but
    ``sequence_id`` and ``offset``, which raise ``ValueError``.
    """
    prepare(pieces.sparkSession)
    refuse(pieces.columns, ["sequence_id", "offset"])
    capacity = (max_tokens, max_documents or max_tokens, max_attention or max_tokens * max_tokens)
    row, group = fresh_name(pieces, "row_no"), fresh_name(pieces, "pack_group")
    rows = written(pieces, "pack-pieces").withColumn(row, F.monotonically_increasing_id())
    full = F.col("length") == max_tokens
    alone = rows.where(full).select(*[F.col(f"`{c}`") for c in pieces.columns],
                                    (-1 - F.col(row)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = rows.where(~full)
    groups = max(1, -(-rest.count() // group_pieces))
    rest = rest.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups))).drop(row)
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack_group(pdf["length"].to_numpy(np.int64), capacity, weights, rule)
        pdf["sequence_id"] = int(pdf[group].iloc[0]) * (1 << 32) + bins
        pdf["offset"] = offsets
        return pdf.drop(columns=[group])

    return alone.unionByName(rest.groupBy(group).applyInPandas(one, out))
