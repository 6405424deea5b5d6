"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import configure, shared_path, table_path

#: Rows per Arrow batch handed to Python: whole texts are passed, so a batch of the default
#: 10,000 rows could hold gigabytes of long documents.
ARROW_ROWS = 512
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings these operators rely on: UTC, shipping by value, small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Unlike a cached or locally checkpointed table, it survives the loss of any executor.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process.

    Functions are shipped to workers by value, so their module globals start fresh in each
    task; a loaded tokenizer or a table of seen words is worth keeping between tasks.
    """
    store = sys.modules.setdefault("_airshed_worker_cache", types.ModuleType("_airshed_worker_cache"))
    return store.__dict__.setdefault(name, {})


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (column names are case-insensitive in Spark)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name = "_" + name
    return name


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns called ``c0``, ``c1``, ...: no name of the caller's can meet one of an operator's own."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def number_of(df: DataFrame, name: str) -> str:
    """What ``numbered`` calls the column ``name`` (names are case-insensitive in Spark); an unknown one is an error."""
    have = [c.lower() for c in df.columns]
    if name.lower() not in have:
        raise ValueError(f"no column named {name}")
    return f"c{have.index(name.lower())}"


def refuse(columns, outputs) -> None:
    """``ValueError`` if a column of the caller's has the name of an output."""
    if taken := {c.lower() for c in columns} & {o.lower() for o in outputs}:
        raise ValueError(f"the input already has columns named {sorted(taken)}")


def text_or_empty(col) -> "F.Column":
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
