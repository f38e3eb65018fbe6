"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics (docstats) are standardised and mapped to cosines of random
projections, which approximate a Gaussian kernel.  The ridge weights solve the normal
equations, whose matrix is summed over partitions and then by Spark, so that only a matrix
of fixed size comes to the driver.  An isotonic fit on a fold of its own turns the ridge
values into probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, arrow_rows, fold, table, texts
from marketstream.llm.docstats import SHARES, statistics
from marketstream.session import cut

FEATURES = 256            # random Fourier features
WIDTH = 3.0               # of the Gaussian kernel, in standard deviations
RIDGE = 1e-3              # per training row
LABELLED_ROWS = 30_000    # labelled rows that a fit uses, about (chosen by a hash)
THRESHOLD = 0.3           # rows that score lower are rejected
SEED = 7


def _features(rows: list[str]) -> np.ndarray:
    return np.array([statistics(t)[1] for t in rows])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray        # random projections
    b: np.ndarray        # random phases
    beta: np.ndarray     # ridge weights, the constant last
    knots: np.ndarray    # isotonic fit: ridge values ...
    values: np.ndarray   # ... and their probabilities

    def lift(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.w + self.b) * np.sqrt(2.0 / len(self.b))
        return np.hstack([f, np.ones((len(f), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.lift(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and non-decreasing values (ties of x are pooled)."""
    if not len(x):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    xs, at = np.unique(x, return_inverse=True)
    n = np.bincount(at).astype(float)
    mean = np.bincount(at, y) / n
    blocks: list[list[float]] = []     # value, weight, first, last
    for k in range(len(xs)):
        blocks.append([mean[k], n[k], xs[k], xs[k]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, _, last = blocks.pop()
            u = blocks[-1]
            u[0], u[1], u[3] = (u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, last
    ends = [(t, b[0]) for b in blocks for t in ((b[2], b[3]) if b[3] > b[2] else (b[2],))]
    return np.array([e[0] for e in ends]), np.array([e[1] for e in ends])


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    col = b.column("x")
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _bounded(rows: DataFrame, bound: int) -> DataFrame:
    n = rows.count()
    if n <= bound:
        return rows
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED)), F.lit(1 << 20))
    return rows.where(draw < int((1 << 20) * bound / n))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
        bound: int = LABELLED_ROWS) -> Model | None:
    """A model from the whole texts of about ``bound`` labelled rows: folds 1 to 3 (of 5)
    fit the ridge, fold 4 the calibration, fold 0 is held out and never read.  Repeated
    labels of one id count once (their largest); null labels and ids are left aside.  None
    without labelled rows."""
    y = (labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
         .groupBy("doc_id").agg(F.max(label_col).cast("double").alias("y"))
         .where(fold(F.col("doc_id"), 5) != 0))
    y = _bounded(y, bound)          # so it may be broadcast
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    named = own.join(F.broadcast(y), "doc_id").select(fold(F.col("doc_id"), 5).alias("fold"),
                                                      "text", "y")

    def taken():
        def step(b: pa.RecordBatch):
            x = _features(texts(b, "text"))
            ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
            return b.column("fold"), b.column("y"), pa.ListArray.from_arrays(ends, x.ravel())

        return step

    rows = cut(arrow_map(named, taken, "fold int, y double, x array<double>"))
    train, calib = rows.where("fold < 4"), rows.where("fold = 4")
    d = len(SHARES)
    stats = train.agg(F.count(F.lit(1)).alias("n"),
                      *[F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(d)],
                      *[F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(d)]).first()
    if not stats["n"]:
        return None
    draw = np.random.default_rng(SEED)
    scale = np.array([stats[f"s{k}"] for k in range(d)])
    model = Model(np.array([stats[f"m{k}"] for k in range(d)]), np.where(scale > 1e-9, scale, 1.0),
                  draw.normal(size=(d, FEATURES)) / WIDTH, draw.uniform(0, 2 * np.pi, FEATURES),
                  np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0))
    size = FEATURES + 1

    def sums(batches):
        a = np.zeros((size, size + 1))
        for b in batches:
            if b.num_rows:
                f = model.lift(_matrix(b))
                a += f.T @ np.hstack([f, b.column("y").to_numpy()[:, None]])
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(size), pa.int32()),
                                          "v": pa.array(list(a), pa.list_(pa.float64()))})

    def add(pdf):
        import pandas as pd

        return pd.DataFrame({"i": pdf["i"][:1], "v": [np.sum(pdf["v"].tolist(), axis=0)]})

    whole = (train.select("x", "y").mapInArrow(sums, "i int, v array<double>")
             .groupBy("i").applyInPandas(add, "i int, v array<double>").collect())
    a = np.array([r["v"] for r in sorted(whole, key=lambda r: r["i"])])
    ridge = RIDGE * stats["n"] * np.eye(size)
    ridge[-1, -1] = 1e-9
    model.beta = np.linalg.solve(a[:, :size] + ridge, a[:, size])
    held = calib.collect()          # at most about a quarter of LABELLED_ROWS
    if held:
        model.knots, model.values = isotonic(model.raw(np.array([r["x"] for r in held])),
                                             np.array([r["y"] for r in held]))
    else:
        model.knots, model.values = isotonic(np.zeros(0), np.zeros(0))
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, ``score``) of every row of ``docs``, from its whole text; a null text counts as
    empty and is scored as any other; without a model the score is 0.5 throughout.
    Repeated rows repeat, null ids stay null, other columns are left aside, and an empty
    table gives no rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0.5).alias("score"))

    def make():
        def step(b: pa.RecordBatch):
            return b.column("id"), model.score(_features(texts(b, "text")))

        return step

    out = arrow_map(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return out.withColumnRenamed("id", id_col)


def passed(docs: DataFrame, model: Model | None, least: float = THRESHOLD,
           text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores at least ``least``."""
    if model is None:
        return docs

    def make():
        def step(b: pa.RecordBatch):
            return b.filter(pa.array(model.score(_features(texts(b, text_col))) >= least))

        return step

    return arrow_rows(docs, make)


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Every document's quality score; folds by crc32 of the id, see ``fit``."""
    docs = table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
