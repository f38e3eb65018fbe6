"""Quality rules: a learned decision list over document statistics.

``learn`` covers the low-quality rows of a labelled sample one rule after another: a rule
grows condition by condition (FOIL gain on two thirds of the rows), is pruned on the last
third, and stays if it is precise enough; the rows it catches leave the sample.  The list
is emitted as one ordered Spark conditional expression over the statistics' columns.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, table, texts
from marketstream.llm.docstats import COUNTS, SHARES, statistics
from marketstream.session import cut

LABELLED_ROWS = 20_000    # labelled rows that learning reads, about (chosen by a hash)
MAX_RULES = 24
MAX_CONDITIONS = 4
LEAST_PRECISION = 0.98    # of a rule, over all rows it catches
LEAST_ROWS = 3            # low-quality rows that a rule must catch
CUTS = 48                 # thresholds tried per statistic
MIN_WORDS = 50            # base rule: shorter texts fail
MAX_REPEAT = 50           # base rule: per cent of words in repeated windows


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool           # value >= cut, else value <= cut
    cut: float

    def column(self) -> Column:
        c = F.col(self.name)
        return c >= self.cut if self.above else c <= self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _caught(rule: Rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for c in rule:
        v = x[:, SHARES.index(c.name)]
        hit &= v >= c.cut if c.above else v <= c.cut
    return hit


def _grow(x: np.ndarray, bad: np.ndarray) -> Rule:
    rule: Rule = ()
    hit = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = int((hit & bad).sum()), int((hit & ~bad).sum())
        if not p0 or not n0:
            break
        best, found = 0.0, None
        base = np.log2(p0 / (p0 + n0))
        for j, name in enumerate(SHARES):
            v = x[hit, j]
            b = bad[hit]
            cuts = np.unique(np.quantile(v[b], np.linspace(0, 1, CUTS)))
            order = np.argsort(v, kind="stable")
            pos = np.concatenate([[0], np.cumsum(b[order])])
            sv = v[order]
            for above in (True, False):
                at = np.searchsorted(sv, cuts, "left" if above else "right")
                p = p0 - pos[at] if above else pos[at]
                n = (len(v) - at if above else at) - p
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - base), -1)
                k = int(gain.argmax())
                if gain[k] > best + 1e-9:
                    best, found = float(gain[k]), Condition(name, above, float(cuts[k]))
        if found is None:
            break
        rule += (found,)
        hit = _caught(rule, x)
    return rule


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    def worth(r: Rule) -> float:
        hit = _caught(r, x)
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    options = [rule[:k] for k in range(len(rule), 0, -1)]
    return max(options, key=lambda r: (worth(r), len(r)))


def learn(x: np.ndarray, bad: np.ndarray) -> list[Rule]:
    """An ordered list of rules that catch rows marked ``bad`` (x: rows of SHARES)."""
    rules: list[Rule] = []
    part = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    while len(rules) < MAX_RULES and (left & bad).any():
        grow, check = left & ~part, left & part
        rule = _grow(x[grow], bad[grow])
        if not rule:
            break
        rule = _prune(rule, x[check], bad[check]) if (check & bad).any() else rule
        hit = _caught(rule, x) & left
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        if p < LEAST_ROWS or p < LEAST_PRECISION * (p + n):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: false at the first rule that holds."""
    out = None
    for rule in rules:
        cond = rule[0].column()
        for c in rule[1:]:
            cond = cond & c.column()
        out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))


def document_statistics(docs: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """(id, COUNTS as long, SHARES as double) of every whole text, a null as none."""

    def make():
        def step(b: pa.RecordBatch):
            got = [statistics(t) for t in texts(b, "text")]
            return [b.column("id"), *zip(*[g[0] for g in got], strict=True),
                    *zip(*[g[1] for g in got], strict=True)]

        return step

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = arrow_map(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, "
                    + ", ".join([f"{c} long" for c in COUNTS] + [f"{s} double" for s in SHARES]))
    return out.withColumnRenamed("id", id_col)


def labelled_sample(stats: DataFrame, labels: DataFrame, label_col: str = "quality",
                    bound: int = LABELLED_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(SHARES, is low quality) of about ``bound`` labelled rows that pass the base rules, in
    a fixed order; repeated labels of an id count once (their largest), null labels and ids
    not at all."""
    y = (labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
         .groupBy("doc_id").agg(F.max(label_col).alias("y")))
    n = y.count()
    h = F.xxhash64(F.col("doc_id").cast("string"), F.lit(8))
    if n > bound:
        y = y.where(F.pmod(h, F.lit(1 << 20)) < int((1 << 20) * bound / n))
    rows = (stats.where(~base_failed()).join(y, "doc_id")
            .select(h.alias("h"), "doc_id", "y", *SHARES)
            .orderBy("h", "doc_id").toPandas())
    return rows[SHARES].to_numpy(float), rows["y"].to_numpy() == 0


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, ``base_failed`` and ``kept``.

    The statistics are taken once and written; the rules learn from the labelled ones.
    Without labels the list is empty and the base rules decide alone.  A null or empty
    text fails the base rules; repeated rows repeat; other columns are left aside."""
    stats = cut(document_statistics(docs))
    rules = learn(*labelled_sample(stats, labels))
    return (stats.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules))
            .select("doc_id", *COUNTS, "base_failed", "kept"))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
