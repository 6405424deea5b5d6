"""Saved models (K4, K7, K8): versions of a fitted pipeline in shared storage, held-out metrics beside each.

``save`` writes a fitted ``pyspark.ml`` model with its own writer and then one row on it (version, inputs, rows, RMSE, MAE, R2) as a
commit of a versioned table; a model without that row is no version.  ``load`` gives a model back by version, the newest by default.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.sources.versioned import VersionedTable

CARD = "version long, inputs array<string>, n_train long, n_test long, rmse double, mae double, r2 double"


def held_out(model, test: DataFrame, label: str) -> dict:
    """Rows, RMSE, MAE and R2 on rows that the model has not seen (nulls where there are none or they are constant)."""
    e = F.col(label) - F.col("prediction")
    r = model.transform(test.where(F.col(label).isNotNull())).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                                                                  F.var_pop(label).alias("v"), F.avg(e * e).alias("mse")).first()
    return {"n_test": r["n"], "rmse": r["rmse"], "mae": r["mae"], "r2": 1 - r["mse"] / r["v"] if r["v"] else None}


class ModelStore:
    """Versions of one model below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.cards = VersionedTable(spark, f"{self.path}/cards", ["version"])

    def save(self, model: PipelineModel, inputs: list[str], train: DataFrame, test: DataFrame, label: str) -> int:
        """Write ``model`` and its card; returns the version."""
        version = self.cards.version() + 1
        model.write().overwrite().save(f"{self.path}/models/{version}")  # what a failed save of this version left is replaced
        h = held_out(model, test, label)
        row = (version, list(inputs), train.count(), h["n_test"], h["rmse"], h["mae"], h["r2"])
        return self.cards.upsert(self.spark.createDataFrame([row], CARD))

    def card(self, version: int | None = None) -> dict:
        version = version or self.cards.version()
        row = self.cards.read().where(F.col("version") == version).first()
        if row is None:
            raise ValueError(f"{self.path} has no model version {version}")
        return row.asDict()

    def load(self, version: int | None = None) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/models/{self.card(version)['version']}")
