"""Line deduplication by overlapping three-line windows.

Every window of ``width`` consecutive lines is hashed (128 bits).  A window that occurs again, in
the same text or in a row with a larger key, is a later occurrence; the lines under all later
occurrences of a text are merged into one set of positions and removed.  The first occurrence
stays.

Repeats inside a text are found while it is read.  Between texts only the first occurrence
in each text takes part: (hash -> smallest key) is a partial aggregation with fixed-size rows, and
the windows of a hash that occurs more than once find it in an equi-join, which Spark splits
where a passage is very frequent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import number_of, numbered, prepare, refuse, written


def line_windows(data: bytes, width: int):
    """(position, high and low half of the hash, occurred before in this text) of every window."""
    import xxhash
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10).tolist() + [len(data)]
    starts = [0] + [e + 1 for e in ends[:-1]]
    seen = set()
    for i in range(len(ends) - width + 1):
        h = xxhash.xxh3_128_intdigest(data[starts[i]:ends[i + width - 1]])
        yield i, h >> 64, h & 0xFFFFFFFFFFFFFFFF, h in seen
        seen.add(h)


def dedup_lines(df: DataFrame, key: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``df`` with the lines under later occurrences removed from ``text_col``, and ``lines_removed``.

    * Lines are what newline characters separate; empty lines count.  Texts of fewer than ``width``
      lines have no window and stay as they are; so do null texts.
    * Rows are ordered by ``key``; a null key comes after all others.  Occurrences in rows of the same
      key (repeated rows, several null keys) are not later than each other.
    * If every line goes, the text is empty; the row stays.  Other columns pass through; they may have any name but
      ``lines_removed``, which raises ``ValueError``.
    """
    prepare(df.sparkSession)
    refuse(df.columns, ["lines_removed"])
    names, key, text_col, df = df.columns, number_of(df, key), number_of(df, text_col), numbered(df)
    k, text = F.col(f"`{key}`"), F.col(f"`{text_col}`").cast("string")
    ident = F.xxhash64(text)  # with the key, names a row; rows equal in both are treated alike
    src = df.where(text.contains("\n")).select(k.alias("k"), ident.alias("t"), text.alias("text"))
    schema = T.StructType([T.StructField("k", src.schema["k"].dataType), T.StructField("t", T.LongType()),
                           T.StructField("pos", T.IntegerType()), T.StructField("h1", T.LongType()),
                           T.StructField("h2", T.LongType()), T.StructField("again", T.BooleanType())])

    def windows(batches):
        for b in batches:
            found = [(i, *w) for i, x in enumerate(b.column(2).to_pylist()) for w in line_windows(x.encode(), width)]
            row, pos, h1, h2, again = zip(*found) if found else [()] * 5
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(row), b.column(1).take(row), pa.array(pos, pa.int32()),
                 pa.array(np.array(h1, np.uint64).view(np.int64)), pa.array(np.array(h2, np.uint64).view(np.int64)),
                 pa.array(again, pa.bool_())], names=schema.names)

    # written: three readers below
    win = written(src.mapInArrow(windows, schema), "line-windows")
    first = win.where("not again")
    known = (first.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2")).agg(F.min("k").alias("least"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and least is not null").drop("n"))
    later = (first.join(known, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).where("not (k <=> least)")
             .select("k", "t", "pos").unionByName(win.where("again").select("k", "t", "pos")))
    covered = later.groupBy(F.col("k").alias("_k"), F.col("t").alias("_t")).agg(F.collect_set("pos").alias("_from"))
    rows = df.withColumn("_text", text).withColumn("_ident", ident)
    rows = (rows.join(covered, k.eqNullSafe(F.col("_k")) & (F.col("_ident") == F.col("_t")), "left")
            .drop("_k", "_t", "_ident", text_col))
    keep = [c for c in df.columns if c != text_col]
    out = T.StructType([T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in df.schema]
                       + [T.StructField("lines_removed", T.IntegerType())])

    def cut(batches):
        for b in batches:
            texts, gone = [], []
            at = {c: i for i, c in enumerate(b.schema.names)}
            for x, start in zip(b.column(at["_text"]).to_pylist(), b.column(at["_from"])):
                drop = 0
                if start.is_valid and len(start):
                    lines = x.split("\n")
                    mark = np.zeros(len(lines) + width, bool)
                    s = start.values.to_numpy(zero_copy_only=False)
                    for j in range(width):
                        mark[s + j] = True
                    stay = np.flatnonzero(~mark[:len(lines)]).tolist()
                    drop = len(lines) - len(stay)
                    x = "\n".join([lines[i] for i in stay])
                texts.append(x)
                gone.append(drop)
            cols = {c: b.column(at[c]) for c in keep} | {text_col: pa.array(texts, pa.string()), "lines_removed": pa.array(gone, pa.int32())}
            yield pa.RecordBatch.from_arrays([cols[c] for c in out.names], names=out.names)

    return rows.select(*[F.col(f"`{c}`") for c in keep], "_text", "_from").mapInArrow(cut, out).toDF(*names, "lines_removed")
