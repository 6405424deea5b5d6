"""Quality classifier with hierarchical empirical Bayes over sites.

Three levels of evidence are combined in log-odds:

1. the document: a logistic regression on shape statistics of its whole text, trained on a bounded
   sample of labelled rows (``TRAIN_ROWS``);
2. its path (a group of pages within a host), whose rate of good documents is a Beta posterior
   with the host's posterior as its prior mean;
3. its host, whose rate has the global rate as its prior mean.

How strongly a level shrinks towards the one above is estimated from the data (method of moments
on the spread of the group means), so a path with few documents takes its host's rate and a rare
host the global one.  All counts come from grouped aggregation over all documents: one row per path,
pre-aggregated in each task; the driver sees a few sums only.  A document counts neither for its own path nor for its
own host: the only document of a host takes the global rate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import fresh_name, prepare, refuse, written
from airshed.llm.rule_cascade import TextStats

#: Labelled rows the document classifier is fitted on (a documented bound; drawn by hash of the id).
TRAIN_ROWS = 20_000
#: Prior strengths are kept within these bounds.
STRENGTH = (1.0, 1e6)
EPS = 1e-4


def features(text: str | None) -> list[float]:
    """Shape statistics of a whole text; all zero for a text without words."""
    s = TextStats(text)
    n = s.n_words
    if not n:
        return [0.0] * len(FEATURES)
    data, chars = s.data, max(1, s.word_chars)
    return [np.log1p(n), s.word_chars / n, s.n_symbols / n, data.count(b"!") / n, s.n_upper / chars,
            len(set(s.words)) / n, s.n_dup_lines / s.n_lines, s.n_repeat_words / n, data.count(b"|") / n,
            (data.count(b".") + data.count(b",")) / n, s.n_lines / n, min(n, 50) / 50]


FEATURES = ["log_words", "word_length", "symbols", "exclamations", "upper", "distinct", "repeated_lines",
            "repeated_words", "pipes", "punctuation", "lines", "shortness"]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the intercept
    rate: float  # of good rows in the training sample

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[:-1] + self.weights[-1]
        return np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), EPS, 1 - EPS)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> Model:
    """Ridge logistic regression by Newton steps.  Without rows of both kinds the model is the base
    rate (one half without any row)."""
    width = len(FEATURES)
    rate = float((y.sum() + 1) / (len(y) + 2))
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(width), np.ones(width), np.append(np.zeros(width), np.log(rate / (1 - rate))), rate)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    w = np.zeros(width + 1)
    penalty = np.append(np.full(width, ridge), 1e-6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Model(mean, scale, w, rate)


def _featured(df: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    src = df.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text_col}`").cast("string").alias(fresh_name(df, "q_text")))
    schema = T.StructType([src.schema[c] for c in carry] + [T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in batches:
            x = [features(t) for t in b.column(len(carry)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(carry))] + [pa.array(x, pa.list_(pa.float64()))],
                                             names=schema.names)

    return src.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          train_rows: int = TRAIN_ROWS) -> Model:
    """Fit the document classifier.  ``labels``: id and 0/1 label; rows with a null in either are left
    out, several labels of one id count as their smallest.  The ids of the sample (at most
    ``train_rows`` numbers) are broadcast, so no text is shuffled."""
    prepare(docs.sparkSession)
    labels = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_label"))
    known = labels.where("_label is not null and _id is not null").groupBy("_id").agg(F.min("_label").alias("_y"))
    sample = written(known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows), "quality-sample")
    rows = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(sample), F.col("_doc") == F.col("_id"))
    # an id may occur on several rows: at most train_rows of them are used
    got = _featured(rows, "text", ["_y"]).limit(train_rows).toPandas()
    x = np.stack(got["x"].to_numpy()) if len(got) else np.empty((0, len(FEATURES)))
    return fit(x, got["_y"].to_numpy(float))


def with_probability(df: DataFrame, model: Model, text_col: str = "text", out: str = "p_text", carry: list[str] | None = None) -> DataFrame:
    """``df`` (or ``carry``) with the document classifier's probability of good quality."""
    prepare(df.sparkSession)
    keep = list(df.columns if carry is None else carry)
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(fresh_name(df, "q_text")))
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(out, T.DoubleType())])

    def run(batches):
        for b in batches:
            x = np.array([features(t) for t in b.column(len(keep)).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(model.probability(x), pa.float64())],
                                             names=schema.names)

    return src.mapInArrow(run, schema)


def strength(groups: float, total: float, spread: float, within: float) -> float:
    """Prior strength in documents, by the method of moments: the variance of a document within its group over
    that of the groups' means.

    ``spread`` is the sum over groups of n * (mean - prior mean)^2, ``within`` the sum over documents of their squared
    distance from their group's mean.  What sampling alone would spread (the variance within, for each
    group) is taken off.  If no group has two documents, nothing tells the two variances apart: full shrinkage.
    """
    if total <= groups:
        return STRENGTH[1]
    noise = within / (total - groups)
    between = (spread - noise * groups) / total
    return float(np.clip(noise / between if between > 1e-12 else STRENGTH[1], *STRENGTH))


def site_posteriors(scored: DataFrame, host_col: str, path_col: str, p_col: str = "p_text"):
    """One row per (host, path): ``path_n``, ``path_sum`` (of probabilities), ``host_n``, ``host_sum``; and the path
    level's and the host level's prior strength and the global rate.  Null hosts and paths are sites of their own.
    An empty table gives no rows and a rate of one half."""
    p = F.col(p_col)
    paths = written(scored.groupBy(F.col(f"`{host_col}`").alias("site_host"), F.col(f"`{path_col}`").alias("site_path"))
                    .agg(F.count(F.lit(1)).alias("path_n"), F.sum(p).alias("path_sum"), F.sum(p * p).alias("path_squares")), "quality-paths")
    hosts = paths.groupBy(F.col("site_host").alias("h")).agg(F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"), F.sum("path_squares").alias("squares"))
    around = lambda squares, s, n: F.sum(F.greatest(F.col(squares) - F.col(s) * F.col(s) / F.col(n), F.lit(0.0)))
    n, s = hosts.agg(F.sum("host_n"), F.sum("host_sum")).first()
    rate = float(np.clip(s / n, EPS, 1 - EPS)) if n else 0.5
    k, spread, within = hosts.agg(F.count(F.lit(1)), F.sum(F.col("host_n") * F.pow(F.col("host_sum") / F.col("host_n") - rate, 2)),
                                  around("squares", "host_sum", "host_n")).first()
    m_host = strength(k, n or 0, spread or 0.0, within or 0.0)
    table = written(paths.join(hosts.drop("squares"), F.col("site_host").eqNullSafe(F.col("h"))).drop("h"), "quality-sites")
    host_rate = (F.col("host_sum") + m_host * rate) / (F.col("host_n") + m_host)
    k, spread, within = table.agg(F.count(F.lit(1)), F.sum(F.col("path_n") * F.pow(F.col("path_sum") / F.col("path_n") - host_rate, 2)),
                                  around("path_squares", "path_sum", "path_n")).first()
    return table.drop("path_squares"), strength(k, n or 0, spread or 0.0, within or 0.0), m_host, rate


def classify(docs: DataFrame, labels: DataFrame, host_col: str, path_col: str, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", threshold: float = 0.5, carry: list[str] | None = None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``p_text``, ``site_rate``, ``quality`` and ``kept``.

    ``quality`` is the posterior probability: the classifier's odds with the training rate in them
    replaced by the site's.  ``kept``: it reaches ``threshold``.  Null and empty texts are scored
    like any text (all statistics zero); repeated rows are scored each.  Columns may have any name; an output name that
    the result already has raises ``ValueError``.
    """
    prepare(docs.sparkSession)
    keep = list(docs.columns if carry is None else carry)
    refuse(keep, ["p_text", "site_rate", "quality", "kept"])
    model = train(docs, labels, id_col, text_col, label_col, train_rows)
    own = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(keep, own)], F.col(f"`{host_col}`").alias("host"),
                       F.col(f"`{path_col}`").alias("path"), F.col(f"`{text_col}`").alias("text"))
    # written with its probability: no text is read or measured twice
    rows = written(with_probability(rows, model, carry=[*own, "host", "path"]), "quality-scored")
    sites, m_path, m_host, overall = site_posteriors(rows, "host", "path")
    # the written table of sites is broadcast only if its files are under Spark's size threshold
    rows = rows.join(sites, F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(F.col("site_path")), "left")
    less = lambda s: F.col(s) - F.col("p_text")  # noqa: E731  a document is no evidence for its own site
    host_rate = (less("host_sum") + m_host * overall) / (F.col("host_n") - 1 + m_host)
    rate = F.least(F.greatest((less("path_sum") + m_path * host_rate) / (F.col("path_n") - 1 + m_path), F.lit(EPS)), F.lit(1 - EPS))
    logit = lambda c: F.log(c / (1 - c))
    prior = float(np.log(model.rate / (1 - model.rate)))
    rows = rows.withColumn("site_rate", rate).withColumn("quality", 1 / (1 + F.exp(-(logit(F.col("p_text")) - prior + logit(F.col("site_rate"))))))
    rows = rows.withColumn("kept", F.col("quality") >= threshold)
    return rows.select(*own, "p_text", "site_rate", "quality", "kept").toDF(*keep, "p_text", "site_rate", "quality", "kept")
