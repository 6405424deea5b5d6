"""Landed JSON feeds.

The reference fetched hourly series as columnar payloads
``{"hourly": {"time": [...], "<col>": [...]}}``; here the landed files are read
with a fixed schema and turned into rows by zipping the parallel arrays and
``inline``: no row leaves the executor that read its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed import schemas as S


def parse_documents(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON documents of all files below ``path``: (documents with column ``d``; rejected with ``file``, ``text``).

    A file holds one document per line, or a single document printed over several lines: a file
    without one readable line is put together again and read as one document.  So every document
    is in exactly one of the two results; blank lines are none.
    """
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parse = lambda c: F.from_json(c, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    bad = F.col("d").isNull() | F.col("d._bad").isNotNull()
    lines = (spark.read.text(path).where(F.trim("value") != "")
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("no"), "value", parse(F.col("value")).alias("d"))
             .withColumn("unreadable", bad))
    files = lines.groupBy(F.col("file").alias("whole_file")).agg(F.bool_and("unreadable").alias("all_bad")).where("all_bad").drop("all_bad")
    of_whole = F.col("file") == F.col("whole_file")
    single = lines.join(files, of_whole, "left_anti")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "no", "value"))), lambda x: x["value"]), "\n")
    whole = (lines.join(files, of_whole, "left_semi").groupBy("file").agg(text.alias("value"))
             .select("file", "value", parse(F.col("value")).alias("d")))
    documents = single.where("NOT unreadable").select("d").unionByName(whole.where(~bad).select("d"))
    rejected = single.where("unreadable").select("file", "value").unionByName(whole.where(bad).select("file", "value"))
    return documents.select(F.col("d").dropFields("_bad").alias("d")), rejected.withColumnRenamed("value", "text")


def reject_or_raise(rejected: DataFrame, path: str, on_bad: str) -> None:
    """``on_bad="fail"``: raise if any document could not be read; ``"drop"``: the caller has looked
    at the rejected documents itself."""
    if on_bad not in ("fail", "drop"):
        raise ValueError("on_bad must be fail or drop")
    if on_bad == "fail" and (n := rejected.count()):
        raise ValueError(f"{path}: {n} unreadable JSON documents, the first: {rejected.first()['text'][:120]!r}")


def hourly_payloads(spark: SparkSession, path: str, columns: list[str], keys=()) -> tuple[DataFrame, DataFrame]:
    """Columnar payloads -> (one row per hour: ``datetime`` + value columns; rejected documents).

    ``keys`` are top-level long columns of each payload (e.g. ``series_id``) carried to every
    row.  An empty payload (no ``hourly`` block or empty arrays) is readable and yields no rows,
    with the schema kept (A15); an unreadable one is rejected.
    """
    keys = list(keys)
    schema = S.hourly_payload_schema(columns)
    for k in keys:
        schema = schema.add(k, T.LongType())
    documents, rejected = parse_documents(spark, path, schema)
    raw = documents.select("d.*")
    h = F.col("hourly")
    zipped = F.arrays_zip(*[h.getField(c).alias(c) for c in ["time"] + columns])
    rows = raw.where(h.isNotNull()).select(*keys, F.inline_outer(zipped)).where(F.col("time").isNotNull())
    return rows.select(*keys, F.to_timestamp_ntz(F.col("time")).alias("datetime"),
                       *[F.col(c).cast("double").alias(c) for c in columns]), rejected


def read_hourly_payloads(spark: SparkSession, path: str, columns: list[str], keys=(), on_bad: str = "fail") -> DataFrame:
    """A9 rows alone; unreadable documents raise unless ``on_bad="drop"``."""
    rows, rejected = hourly_payloads(spark, path, columns, keys)
    reject_or_raise(rejected, path, on_bad)
    return rows


def empty_hourly(spark: SparkSession, columns: list[str]) -> DataFrame:
    """Schema-bearing empty frame for an empty payload."""
    schema = T.StructType([T.StructField("datetime", T.TimestampNTZType())]
                          + [T.StructField(c, T.DoubleType()) for c in columns])
    return spark.createDataFrame([], schema)


def to_hourly_payloads(df: DataFrame, columns: list[str], t: str = "datetime", keys=()) -> DataFrame:
    """Inverse of A9, one payload per (series, day): the shape a landing job writes.

    Each group is one day of one series (at most 24 rows), so the ``collect_list`` is bounded.
    """
    day = F.date_trunc("day", F.col(t))
    g = df.groupBy(*keys, day.alias("_day")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(t).alias("_t"), *[F.col(c) for c in columns]))).alias("_r"))
    def field(name):
        return lambda r: r[name]

    hourly = F.struct(
        F.transform("_r", lambda r: F.date_format(r["_t"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        *[F.transform("_r", field(c)).alias(c) for c in columns])
    return g.select(*keys, F.lit(S.LOCAL_ZONE).alias("timezone"), hourly.alias("hourly"))


def to_nested_locations(stations: DataFrame) -> DataFrame:
    """Stations in the nested API shape (one ``results`` document per station; each station's
    sensors array is bounded by its parameter count)."""
    sensors = F.transform("parameters", lambda p, i: F.struct(
        (F.col("id") * 100 + i).cast("long").alias("id"),
        F.struct(p.alias("name"), F.lit(None).cast("string").alias("units")).alias("parameter")))
    loc = F.struct(
        F.col("id"), F.col("name"), F.col("locality"),
        F.struct(F.col("timezone").alias("name")).alias("timezone"),
        F.struct(F.col("latitude"), F.col("longitude")).alias("coordinates"),
        F.col("is_monitor").alias("isMonitor"),
        F.struct(F.col("provider").alias("name")).alias("provider"),
        sensors.alias("sensors"))
    return stations.select(F.array(loc).alias("results"))


NESTED_LOCATIONS = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("locality", T.StringType()),
        T.StructField("timezone", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("coordinates", T.StructType([T.StructField("latitude", T.DoubleType()),
                                                   T.StructField("longitude", T.DoubleType())])),
        T.StructField("isMonitor", T.BooleanType()),
        T.StructField("provider", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("sensors", T.ArrayType(T.StructType([
            T.StructField("id", T.LongType()),
            T.StructField("parameter", T.StructType([T.StructField("name", T.StringType()),
                                                     T.StructField("units", T.StringType())])),
        ]))),
    ]))),
])


def flatten_locations(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """A10: nested location/sensor JSON (documented in the reference's plan) -> station rows
    in the ``stations`` schema, parameters gathered with ``transform`` (no explode needed).
    Unreadable documents raise unless ``on_bad="drop"``."""
    documents, rejected = parse_documents(spark, path, NESTED_LOCATIONS)
    reject_or_raise(rejected, path, on_bad)
    loc = documents.select(F.explode("d.results").alias("l"))
    return loc.select(
        F.col("l.id").alias("id"), F.col("l.name").alias("name"), F.col("l.locality").alias("locality"),
        F.col("l.timezone.name").alias("timezone"),
        F.col("l.coordinates.latitude").alias("latitude"), F.col("l.coordinates.longitude").alias("longitude"),
        F.col("l.isMonitor").alias("is_monitor"), F.col("l.provider.name").alias("provider"),
        F.transform("l.sensors", lambda s: s["parameter"]["name"]).alias("parameters"),
        F.lit(None).cast("string").alias("ingested_at"))
