"""Versioned tables: atomic commits, pinned readers, failed and racing writers, compaction, replayed batches."""

import pytest
from pyspark.sql import functions as F

from airshed.session import shared_path
from airshed.sources.versioned import CommitConflict, VersionedTable


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "k long, v string")


@pytest.fixture()
def table(spark):
    return VersionedTable(spark, shared_path(spark, "test-versioned"), ["k"])


def test_versions_stay_readable_and_the_newest_row_of_a_key_wins(spark, table):
    assert table.version() == 0 and table.versions() == []
    with pytest.raises(ValueError):
        table.read()
    assert table.replace(frame(spark, [(1, "a"), (2, "a")])) == 1
    assert table.upsert(frame(spark, [(2, "b"), (3, "b")])) == 2
    assert table.upsert(frame(spark, [(3, "c")])) == 3
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(table.read(1)) == [(1, "a"), (2, "a")] and rows(table.read(2)) == [(1, "a"), (2, "b"), (3, "b")]
    with pytest.raises(ValueError):
        table.read(9)


def test_compaction_equals_merge_on_read_and_spares_pinned_readers(spark, table):
    table.replace(frame(spark, [(i, "old") for i in range(100)]))
    table.upsert(frame(spark, [(i, "new") for i in range(50, 150)]))
    pinned = table.read(2)
    merged = rows(table.read())
    assert table.compact() == 3 and rows(table.read()) == merged and len(merged) == 150
    assert table.history() == [(1, "replace", 1), (2, "upsert", 2), (3, "compact", 1)]
    assert rows(pinned) == merged                                  # planned before, read after
    assert len(table.vacuum(keep=1)) == 2 and table.versions() == [3] and rows(table.read()) == merged


def test_a_failed_writer_leaves_readers_on_the_old_version(spark, table):
    table.replace(frame(spark, [(1, "a")]))
    bad = frame(spark, [(2, "b")]).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("broken row"))).otherwise("x"))
    with pytest.raises(Exception, match="broken row"):
        table.upsert(bad)
    assert table.version() == 1 and rows(table.read()) == [(1, "a")]
    table.upsert(frame(spark, [(3, "c")]))
    assert rows(table.read()) == [(1, "a"), (3, "c")]
    assert table.vacuum(keep=2) != []                               # what the failed writer left


def test_of_two_writers_of_one_version_one_wins(spark, table):
    table.replace(frame(spark, [(1, "a")]))
    base = table.manifest()
    table._next(frame(spark, [(2, "first")]), "upsert", True, base=base)
    with pytest.raises(CommitConflict):
        table._next(frame(spark, [(2, "second")]), "upsert", True, base=base)
    assert table.version() == 2 and rows(table.read()) == [(1, "a"), (2, "first")]


def test_other_columns_are_refused_and_empty_writes_are_versions(spark, table):
    table.replace(frame(spark, []))
    assert rows(table.read()) == []
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([(1, 2)], "k long, w long"))
    table.upsert(frame(spark, []))
    assert table.version() == 2 and rows(table.read()) == []


def test_replayed_batches_are_written_once(spark, table):
    sink = table.write_batches("q", prepare=lambda b: b.withColumn("v", F.upper("v")))
    sink(frame(spark, [(1, "a")]), 0)
    sink(frame(spark, [(1, "b")]), 1)
    sink(frame(spark, [(1, "b")]), 1)
    sink(frame(spark, [(1, "a")]), 0)
    table.write_batches("other")(frame(spark, [(2, "z")]), 0)
    assert table.version() == 3 and rows(table.read()) == [(1, "B"), (2, "z")]
    table.compact()
    sink(frame(spark, [(1, "again")]), 1)                           # compaction keeps the batches' numbers
    assert rows(table.read()) == [(1, "B"), (2, "z")]
