"""Versioned tables (A11, A14): a manifest names the live version, a commit is one atomic rename.

Layout below the table's folder::

    data/<version>-<id>/   Parquet files of one write, never changed afterwards
    log/<version>.json     the manifest of a version: the data folders it consists of

A writer first writes its rows to a fresh data folder and then puts the next manifest in place by a rename that fails
if the name is taken (``FileContext.rename`` without overwrite, as Spark's own checkpoint files are committed).  A writer that
fails before that, or loses the race to another, leaves readers on the version they had; ``CommitConflict`` tells the
loser to start again from the new version.  Readers take the newest manifest, or pin an older one.

``upsert`` is merge-on-read: it adds a folder, and readers keep the newest row of each key.  ``compact`` writes the merged rows
into one folder and commits it as a version of its own.  ``write_batches`` is a streaming sink: the manifest remembers
the last batch of each query, so a replayed batch is left out.  ``vacuum`` deletes data that no kept version names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.operators.dedup import latest_per_key

DIGITS = 12


class CommitConflict(RuntimeError):
    """Another writer has committed the version this one was about to commit."""


class VersionedTable:
    """A table of ``keys`` (rows with equal keys replace each other) below ``path``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    # ---- log ---------------------------------------------------------------------------

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        uri = jvm.org.apache.hadoop.fs.Path(self.path).toUri()
        return jvm, jvm.org.apache.hadoop.fs.FileSystem.get(uri, conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, conf)

    def _at(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        _, fs, _ = self._fs()
        if not fs.exists(self._at("log")):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(self._at("log"))]
        return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit() and len(n) == DIGITS + 5)

    def version(self) -> int:
        """The live version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "kind": "empty", "folders": [], "schema": None, "batches": {}}
        jvm, fs, _ = self._fs()
        if not fs.exists(self._at(f"log/{version:0{DIGITS}d}.json")):
            raise ValueError(f"{self.path} has no version {version}")
        stream = fs.open(self._at(f"log/{version:0{DIGITS}d}.json"))
        try:
            return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> int:
        jvm, fs, context = self._fs()
        fs.mkdirs(self._at("log"))
        made = self._at(f"log/.{uuid.uuid4().hex}.tmp")
        out = fs.create(made, False)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            out.close()
        option = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        option[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(made, self._at(f"log/{manifest['version']:0{DIGITS}d}.json"), option)
        except Exception as e:
            fs.delete(made, False)
            if "FileAlreadyExists" in str(e):
                raise CommitConflict(f"{self.path}: version {manifest['version']} exists") from e
            raise
        return manifest["version"]

    # ---- writing -----------------------------------------------------------------------

    def _write(self, df: DataFrame, version: int) -> str:
        folder = f"data/{version:0{DIGITS}d}-{uuid.uuid4().hex[:12]}"
        df.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return folder

    def _next(self, df: DataFrame, kind: str, keep: bool, batches: dict | None = None, base: dict | None = None) -> int:
        base = self.manifest() if base is None else base
        if keep and base["schema"] is not None and [f.name for f in df.schema] != [f["name"] for f in base["schema"]["fields"]]:
            raise ValueError(f"{self.path} has other columns: {[f['name'] for f in base['schema']['fields']]}")
        version = base["version"] + 1
        folder = self._write(df, version)
        return self._commit({"version": version, "kind": kind, "folders": [*base["folders"], folder] if keep else [folder],
                             "schema": json.loads(df.schema.json()), "batches": batches or base["batches"]})

    def replace(self, df: DataFrame) -> int:
        """A version of ``df`` alone (one row for each key is the caller's to see to); returns its number."""
        return self._next(df, "replace", keep=False)

    def upsert(self, df: DataFrame) -> int:
        """A version in which ``df`` (one row for each key) replaces and adds rows."""
        return self._next(df, "upsert", keep=True)

    def compact(self) -> int:
        """A version with the same rows in one folder, clustered by key; pinned readers of older versions are not disturbed."""
        base = self.manifest()
        rows = self.read(base["version"]).repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
        return self._next(rows, "compact", keep=False, base=base)

    def write_batches(self, query: str, prepare=None):
        """A ``foreachBatch`` function: each batch (after ``prepare``) is one upsert, once, however often it is replayed."""
        def write(batch: DataFrame, batch_id: int) -> None:
            base = self.manifest()
            if batch_id <= base["batches"].get(query, -1):
                return
            rows = prepare(batch) if prepare else batch
            self._next(rows, "upsert", keep=True, batches=base["batches"] | {query: batch_id}, base=base)
        return write

    # ---- reading -----------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the live version, or of the one given: of each key the row written last."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise ValueError(f"{self.path} has no committed version")
        schema = T.StructType.fromJson(found["schema"])
        rows = self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in found["folders"]])
        if len(found["folders"]) == 1:
            return rows
        # the folder's name says which version wrote a row
        order = F.regexp_extract(F.col("_metadata.file_path"), rf"/data/([0-9]{{{DIGITS}}})-[^/]*/[^/]*$", 1)
        return latest_per_key(rows.select("*", order.alias("_written")), self.keys, ["_written"]).drop("_written")

    def history(self) -> list[tuple[int, str, int]]:
        """(version, kind, folders) of each committed version."""
        return [(v, m["kind"], len(m["folders"])) for v in self.versions() for m in [self.manifest(v)]]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all but the newest ``keep`` versions and delete data folders that these do not name; returns these.

        Readers of forgotten versions and writers at work lose their files: run it when there are none.
        """
        _, fs, _ = self._fs()
        versions = self.versions()
        for v in versions[:-keep]:
            fs.delete(self._at(f"log/{v:0{DIGITS}d}.json"), False)
        named = {f for v in versions[-keep:] for f in self.manifest(v)["folders"]}
        if not fs.exists(self._at("data")):
            return []
        gone = [f"data/{s.getPath().getName()}" for s in fs.listStatus(self._at("data")) if f"data/{s.getPath().getName()}" not in named]
        for f in gone:
            fs.delete(self._at(f), True)
        return gone
