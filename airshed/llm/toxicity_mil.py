"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag is labelled.  A sentence's score is a logistic
function of its words; the document's is their noisy-or, 1 - (1 - leak) * product(1 - sentence).
Fitting the noisy-or to document labels moves the blame to the sentences that explain them, so
the same weights then locate the offending sentences.

Features of a word are the word itself and its leading 4 to 8 characters (stems carry over to
words not seen in training).  Features are chosen by how differently often they occur in toxic and
other documents of the training sample, counted in the tasks; the fit sees the chosen features
only (``MAX_FEATURES``) of a bounded sample of labelled rows (``TRAIN_ROWS``).  Scoring is one
narrow pass over whole texts, with a bounded table word -> weight in each worker.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import fresh_name, prepare, refuse, written

#: Labelled rows that features are chosen and weights are fitted on (a documented bound).
TRAIN_ROWS = 10_000
MAX_FEATURES = 4000
#: Least document frequency and least z-score of a feature.
MIN_DOCS, MIN_Z = 5, 4.0
TABLE_WORDS = 300_000
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
LEAST = 1e-9


def word_features(token: str) -> list[str]:
    """Features of a white-space token: each run of letters in lower case, and its beginnings."""
    out = []
    for w in WORD.findall(token.lower()):
        out.append(w)
        out += [w[:k] + "*" for k in range(4, min(8, len(w) - 1) + 1)]
    return out


def feature_hash(name: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) - (1 << 63)


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE.findall(text) if not s.isspace()]


@dataclass
class Model:
    weights: dict[int, float]  # by feature hash
    bias: float
    leak: float

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Scores sentences and documents with a bounded table token -> weight."""

    def __init__(self, model: Model):
        self.model, self.table = model, {}

    def weight(self, token: str) -> float:
        w = self.table.get(token)
        if w is None:
            get = self.model.weights.get
            w = self.table[token] = sum(get(h, 0.0) for h in {feature_hash(f) for f in word_features(token)})
        return w

    def sentence(self, s: str) -> float:
        z = self.model.bias + sum(map(self.weight, set(s.split())))
        return 1 / (1 + np.exp(-min(max(z, -30.0), 30.0)))

    def document(self, text: str | None) -> float:
        """Noisy-or over the sentences; a text without any has the leak alone."""
        if len(self.table) > TABLE_WORDS:
            self.table.clear()
        weight, bias = self.weight, self.model.bias
        z = np.array([sum(map(weight, set(s.split()))) for s in sentences(text or "")]) + bias
        log_not = -np.logaddexp(0, np.clip(z, -30, 30)).sum() + np.log1p(-self.model.leak)
        return float(min(max(-np.expm1(log_not), 0.0), 1.0))

    def offending(self, text: str | None, threshold: float) -> list[tuple[int, int, float]]:
        """(start, end, score) in characters of the sentences that reach ``threshold``."""
        found = ((m.start(), m.end(), float(self.sentence(m[0]))) for m in SENTENCE.finditer(text or "") if not m[0].isspace())
        return [x for x in found if x[2] >= threshold]


def fit_noisy_or(doc: np.ndarray, sent: np.ndarray, feat: np.ndarray, plain: np.ndarray, y: np.ndarray, width: int,
                 steps: int = 400, rate: float = 0.1, ridge: float = 2e-4):
    """Weights, bias and leak by Adam on the log-likelihood of the document labels.

    ``sent``/``feat``: the (sentence, feature) pairs; ``doc``: the document of each sentence;
    ``plain``: sentences without features in each document.
    """
    theta = np.concatenate([np.full(width, 0.5), [-5.0, -4.0]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n, docs = max(1, len(doc)), max(1, len(y))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, steps + 1):
        w, b, c = theta[:-2], theta[-2], theta[-1]
        z = b + np.bincount(sent, w[feat], minlength=len(doc)) if len(doc) else np.empty(0)
        p, p0, leak = sigmoid(z), sigmoid(b), sigmoid(c)
        log_not = -plain * np.logaddexp(0, b) - np.logaddexp(0, c)
        if len(doc):
            log_not = log_not - np.bincount(doc, np.logaddexp(0, z), minlength=len(y))
        log_not = np.minimum(log_not, -LEAST)
        q = np.exp(log_not)
        g = np.where(y > 0, q / (1 - q), -1.0)  # derivative of the loss by log_not
        gz = -p * g[doc] if len(doc) else np.empty(0)
        grad = np.concatenate([(np.bincount(feat, gz[sent], minlength=width) if len(feat) else np.zeros(width)) / docs + ridge * w,
                               [(gz.sum() - (g * plain).sum() * p0) / docs, (-g.sum() * leak) / docs]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        theta[-2:] = np.minimum(theta[-2:], -1.0)
    del n
    return theta[:-2], float(theta[-2]), float(sigmoid(theta[-1]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_rows: int = TRAIN_ROWS, max_features: int = MAX_FEATURES) -> Model:
    """Fit on a sample of the labelled rows (drawn by hash of the id; ids, at most ``train_rows``
    numbers, are broadcast).  Rows with a null id or label are left out; several labels of one id
    count as their largest.  Without labelled rows the model is a constant low score."""
    prepare(docs.sparkSession)
    labels = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_label"))
    known = labels.where("_label is not null and _id is not null").groupBy("_id").agg(F.max("_label").cast("int").alias("_y"))
    sample = written(known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows), "toxic-sample")
    docs = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # an id may occur on several rows: of these the one with the smallest text hash is used, so the bound on ids bounds the rows
    rows = docs.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select("_id", "_y", "text", F.xxhash64("text").alias("_h"))
    rows = rows.groupBy("_id", "_y").agg(F.min_by("text", F.struct("_h", "text")).alias("text"))
    rows = written(rows.select("_y", "text", F.xxhash64("_id").alias("_order")).repartition(max(1, min(train_rows // 128, 4 * docs.sparkSession.sparkContext.defaultParallelism))), "toxic-texts")

    def count(batches):
        """Document frequency of each feature by label, summed up in the task."""
        table: dict[str, np.ndarray] = {}
        parts: list[list[np.ndarray]] = [[], []]
        for b in batches:
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = []
                for w in set(text.split()):
                    h = table.get(w)
                    if h is None:
                        h = table[w] = np.array([feature_hash(f) for f in word_features(w)], np.int64)
                    own.append(h)
                if own:
                    parts[int(y > 0)].append(np.unique(np.concatenate(own)))
            if len(table) > TABLE_WORDS:
                table.clear()
            if sum(map(len, parts[0])) + sum(map(len, parts[1])) > 4_000_000:
                yield from tallies(parts)
                parts = [[], []]
        yield from tallies(parts)

    def tallies(parts):
        for y, p in enumerate(parts):
            if p:
                h, n = np.unique(np.concatenate(p), return_counts=True)
                n = n.astype(np.int64)
                for at in range(0, len(h), 100_000):
                    part = n[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(h[at:at + 100_000]), pa.array(part * y), pa.array(part * (1 - y))],
                                                     names=["h", "n1", "n0"])

    d1, d0 = rows.agg(F.coalesce(F.sum((F.col("_y") > 0).cast("long")), F.lit(0)), F.count(F.lit(1))).first()
    d0 -= d1
    if not d1 or not d0:
        rate = (d1 + 1) / (d1 + d0 + 2) if d1 + d0 else 0.01
        return Model({}, -30.0, float(rate))
    pooled = (F.col("n1") + F.col("n0")) / F.lit(float(d1 + d0))
    z = ((F.col("n1") / float(d1) - F.col("n0") / float(d0)) / F.sqrt(pooled * (1 - pooled) * (1.0 / d1 + 1.0 / d0) + 1e-12))
    chosen = (rows.mapInArrow(count, "h long, n1 long, n0 long").groupBy("h").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
              .where(F.col("n1") + F.col("n0") >= MIN_DOCS).withColumn("z", z).where(F.abs("z") >= MIN_Z)
              .orderBy(F.abs("z").desc(), "h").limit(max_features).select("h").toPandas()["h"].to_numpy(np.int64))
    number = {int(h): i for i, h in enumerate(chosen)}

    def bags(batches):
        """Of each document: label, sentences without features, and the others' feature numbers."""
        table: dict[str, list[int]] = {}

        def of(w):
            if w not in table:
                table[w] = [number[h] for f in word_features(w) if (h := feature_hash(f)) in number]
            return table[w]

        for b in batches:
            plain, found = [], []
            if len(table) > TABLE_WORDS:
                table.clear()
            for text in b.column(1).to_pylist():
                hits = [sorted({x for w in set(s.split()) for x in of(w)}) for s in sentences(text)]
                found.append([x for x in hits if x])
                plain.append(sum(not x for x in hits))
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(0), pa.array(plain, pa.int64()), pa.array(found, pa.list_(pa.list_(pa.int32())))],
                                             names=["place", "y", "plain", "bag"])

    # in a fixed order: sums of floats, and so the weights, depend on it
    got = sorted(rows.mapInArrow(bags, "place long, y int, plain long, bag array<array<int>>").collect(), key=lambda r: (r["place"], r["y"], r["plain"]))
    y, plain = np.array([r["y"] for r in got], float), np.array([r["plain"] for r in got], float)
    doc = [i for i, r in enumerate(got) for _ in r["bag"]]
    sent = [s for s, x in enumerate(x for r in got for x in r["bag"]) for _ in x]
    feat = [f for r in got for x in r["bag"] for f in x]
    w, bias, leak = fit_noisy_or(np.array(doc, np.int64), np.array(sent, np.int64), np.array(feat, np.int64), plain, y, len(chosen))
    return Model({int(h): float(x) for h, x in zip(chosen, w)}, bias, leak)


def score(df: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3, carry: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``carry``) with ``score`` (0 to 1), ``predicted`` (1 from ``threshold``
    on) and ``offending``: start, end and score of the sentences that reach the threshold
    themselves, or else the highest one of a predicted document.

    Null and empty texts score the leak.  An output name that the result already has raises ``ValueError``.
    """
    prepare(df.sparkSession)
    keep = list(df.columns if carry is None else carry)
    refuse(keep, ["score", "predicted", "offending"])
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(fresh_name(df, "tox_text")))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                                                           T.StructField("offending", span)])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        s = model.scorer()
        for b in batches:
            texts = b.column(len(keep)).to_pylist()
            scores = [s.document(t) for t in texts]
            spans = []
            for t, x in zip(texts, scores):
                own = s.offending(t, 0.0) if x >= threshold else []
                spans.append([o for o in own if o[2] >= threshold] or [max(own, key=lambda o: o[2])] if own else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(keep))]
                + [pa.array(scores, pa.float64()), pa.array([int(x >= threshold) for x in scores], pa.int32()),
                   pa.array([[dict(zip(("start", "end", "score"), o)) for o in x] for x in spans], arrow)], names=schema.names)

    return src.mapInArrow(run, schema)
