"""Quality rules as a short-circuit cascade ordered by rejection per cost.

On a sample of the rows each rule's cost (seconds per text, with what it needs computed afresh) and
selectivity (share of texts it rejects) are measured on the executors; rules then run in
decreasing order of rejection per second, and a text leaves the cascade at its first failed
rule, so later (dearer, rarer) rules and the statistics only they need are not computed for it.
A text is kept if no rule rejects it, whatever the order: the order is a matter of cost alone.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.llm.common import fresh_name, prepare

#: Texts the costs and selectivities are estimated on (expected number; a row is drawn by itself).
SAMPLE_TEXTS = 2000
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


class TextStats:
    """Statistics of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # splits bytes at space and \x09-\x0D only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(self.data.count(c) for c in SPACES)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.data.count(c) for c in SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.data.split(b"\n") if x.strip()]

    @cached_property
    def n_lines(self) -> int:
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_upper(self) -> int:
        return len(self.data) - len(self.data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a three-word window found twice or more in the text."""
        n = len(self.words)
        if n < 4:
            return 0
        number: dict[bytes, int] = {}
        c = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, n)
        pair = np.unique(c[:-1] * len(number) + c[1:], return_inverse=True)[1]
        _, which, count = np.unique(pair[:-1] * len(number) + c[2:], return_inverse=True, return_counts=True)
        again = count[which] > 1
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= again
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    """Rejects a text if ``fails`` is true for its statistics."""

    name: str
    fails: Callable[[TextStats], bool]


BASE_RULES = [
    Rule("few_words", lambda s: s.n_words < 50),
    Rule("repeated_words", lambda s: 100 * s.n_repeat_words > 50 * s.n_words),
]
RULES = [
    Rule("symbols", lambda s: 10 * s.n_symbols > s.n_words),
    Rule("short_words", lambda s: s.word_chars < 2 * s.n_words),
    Rule("long_words", lambda s: s.word_chars > 12 * s.n_words),
    Rule("upper_case", lambda s: 2 * s.n_upper > s.word_chars),
    Rule("repeated_lines", lambda s: 2 * s.n_dup_lines > s.n_lines),
]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def estimate(df: DataFrame, rules: list[Rule], text_col: str = "text", sample_texts: int = SAMPLE_TEXTS,
             seed: int = 42) -> list[dict]:
    """Texts, rejections and seconds of each rule on a sample, measured inside the tasks.

    Each rule starts from the bare text, so its cost includes what it needs.  Only sums (one row
    for each rule) reach the driver.
    """
    total = df.count()
    if not total or not rules:
        return [{"rule": i, "texts": 0, "rejected": 0, "seconds": 0.0} for i in range(len(rules))]
    sample = df.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    if total > sample_texts:
        sample = sample.sample(fraction=sample_texts / total, seed=seed)

    def run(batches):
        tally = [[0, 0, 0.0] for _ in rules]
        for b in batches:
            for text in b.column(0).to_pylist():
                for t, rule in zip(tally, rules):
                    began = time.perf_counter()
                    bad = rule.fails(TextStats(text))
                    t[2] += time.perf_counter() - began
                    t[0] += 1
                    t[1] += bool(bad)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules)), pa.int32()), pa.array([t[0] for t in tally], pa.int64()),
             pa.array([t[1] for t in tally], pa.int64()), pa.array([t[2] for t in tally], pa.float64())],
            names=["rule", "texts", "rejected", "seconds"])

    sums = (sample.mapInArrow(run, "rule int, texts long, rejected long, seconds double")
            .groupBy("rule").agg(F.sum("texts").alias("texts"), F.sum("rejected").alias("rejected"),
                                 F.sum("seconds").alias("seconds")))
    return [r.asDict() for r in sums.orderBy("rule").collect()]


def order_rules(rules: list[Rule], measured: list[dict]) -> list[Rule]:
    """Rules by decreasing rejections per second; ties and unmeasured rules keep their order."""
    worth = {m["rule"]: m["rejected"] / max(m["seconds"], 1e-9) if m["texts"] else 0.0 for m in measured}
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: -worth.get(i, 0.0))]


def cascade(df: DataFrame, rules: list[Rule], text_col: str = "text", kept_col: str = "kept",
            first: list[Rule] = (), stats: bool = False, sample_texts: int = SAMPLE_TEXTS,
            carry: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``carry``) with ``kept_col``: no rule rejects the text.

    ``stats=True`` adds the columns of ``STATS`` and ``base_failed`` (a rule of ``first`` rejects);
    these are then computed for every text, and the cascade runs only for texts that pass ``first``.
    Without it the rules of ``first`` take part in the cascade like the others.  Null texts count as
    empty; other columns pass through; an output name that ``df`` already has raises ``ValueError``.
    """
    prepare(df.sparkSession)
    first = list(first)
    ordered = order_rules(rules, estimate(df, rules, text_col, sample_texts)) if stats else \
        order_rules(first + rules, estimate(df, first + rules, text_col, sample_texts))
    extra = ([T.StructField(c, T.LongType()) for c in STATS] + [T.StructField("base_failed", T.BooleanType())]) * stats
    extra = extra + [T.StructField(kept_col, T.BooleanType())]
    keep = list(df.columns if carry is None else carry)
    if taken := {c.lower() for c in keep} & {f.name.lower() for f in extra}:
        raise ValueError(f"the input already has columns named {sorted(taken)}")
    work = fresh_name(df, "rule_text")
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(work))
    schema = T.StructType([src.schema[c] for c in keep] + extra)

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in extra]
            for text in b.column(len(keep)).to_pylist():
                s = TextStats(text)
                if stats:
                    bad = any([r.fails(s) for r in first])
                    row = [getattr(s, c) for c in STATS] + [bad, not bad and not any(r.fails(s) for r in ordered)]
                else:
                    row = [not any(r.fails(s) for r in ordered)]
                for c, v in zip(cols, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(keep))]
                + [pa.array(c, pa.bool_() if isinstance(f.dataType, T.BooleanType) else pa.int64()) for c, f in zip(cols, extra)],
                names=schema.names)

    return src.mapInArrow(run, schema)
