"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector, less a centre and rotated at random, is kept as the signs of its components
(packed bits) and two scalars: its length, and the inner product of its unit vector with
the code, which corrects the estimate.  A query's inner product with a vector is estimated
from the bits, with a bound on the error; only vectors whose upper bound reaches the k-th
best lower bound are compared exactly.

Queries and vectors meet in blocks of bounded size (a grid of query blocks and vector
blocks); each pair of blocks yields k rows per query, and the last step keeps the best k.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm.common import arrow_map, table
from marketstream.session import cut

QUERY_BLOCK = 2048
VECTOR_BLOCK = 16_384
CENTRE_ROWS = 20_000      # rows that the centre is fitted on, about (chosen by a hash)
BOUND = 3.0               # error bound in standard deviations of the estimate
SEED = 4
_CODE = "vec_id long, vec array<double>, code binary, length float, fit float"
_FOUND = "uid long, query_id long, vec_id long, score double"


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """(packed sign bits, length, fit) of rows of ``x``: the code's unit vector has the
    inner product ``fit`` with the row's; rows at the centre have length 0 and fit 1."""
    d = (x - centre) @ turn
    length = np.sqrt((d * d).sum(axis=1))
    bits = d >= 0
    with np.errstate(invalid="ignore", divide="ignore"):
        fit = np.abs(d).sum(axis=1) / np.sqrt(x.shape[1]) / length
    return np.packbits(bits, axis=1), length, np.where(length > 0, fit, 1.0)


def estimate(bits: np.ndarray, length: np.ndarray, fit: np.ndarray, queries: np.ndarray,
             centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products [query, row] from packed bits, and their error bounds."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (queries @ turn).astype(np.float32)
    scale = (length / fit / np.sqrt(dim)).astype(np.float32)
    est = turned @ signs.T * scale + (queries @ centre)[:, None].astype(np.float32)
    spread = length * np.sqrt(np.maximum(0, 1 - fit * fit)) / fit / np.sqrt(max(1, dim - 1))
    norm = np.sqrt((queries * queries).sum(axis=1))
    return est, (BOUND * norm[:, None] * spread + 1e-5 * norm[:, None] * length).astype(np.float32)


def _rows(col: pa.ChunkedArray, dtype) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in col.chunks]) if col.num_chunks else pa.array([])
    return flat.to_numpy(zero_copy_only=False).astype(dtype).reshape(len(col), -1)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _search_blocks(centre: np.ndarray, turn: np.ndarray, k: int):
    schema = pa.schema([("uid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.float64())])

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and vectors.num_rows:
            q = _rows(queries["query"], np.float64)
            qid, quid = queries["query_id"].to_numpy(), queries["quid"].to_numpy()
            uids = vectors["uid"].to_numpy()
            x = _rows(vectors["vec"], np.float64)
            ids = vectors["vec_id"].to_numpy()
            bits = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.uint8)
            bits = bits.reshape(len(ids), -1)
            length, fit = vectors["length"].to_numpy(), vectors["fit"].to_numpy()
            for a in range(0, len(q), 128):
                est, err = estimate(bits, length, fit, q[a:a + 128], centre, turn)
                for j in range(len(est)):
                    own = uids == quid[a + j]
                    low = np.where(own, -np.inf, est[j] - err[j])
                    floor = (np.partition(low, -k)[-k] if len(low) > k else -np.inf)
                    near = np.flatnonzero((est[j] + err[j] >= floor) & ~own)
                    score = (x[near] * q[a + j]).sum(axis=1)
                    top = _best(ids[near], score, k)
                    out.append((np.full(len(top), quid[a + j]), np.full(len(top), qid[a + j]),
                                ids[near][top], score[top]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], [], []]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema,
                                                                         strict=True)],
                                    schema=schema)

    return run


def usable(vectors: DataFrame, id_col: str = "vec_id",
           vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, vec) of the rows that take part, and their dimension: not those whose id or
    vector is null, that hold a null or non-finite component, that are zero, or whose
    dimension is not the most frequent one (the larger on ties)."""
    vec = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))

    def finite(c):
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()
                      & F.forall("vec", finite) & F.exists("vec", lambda c: c != 0))
    dims = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = dims.orderBy(F.desc("n"), F.desc("d")).first()
    dim = top["d"] if top else 0
    return rows.where(F.size("vec") == dim), dim


def nearest(vectors: DataFrame, queries, k: int = 20, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each query by inner product in double precision:
    query_id, rank (from 1), vec_id, score; ties go to the smaller id.

    ``queries`` is a condition on ``vec_id`` that picks the query rows.  Every other row is a
    candidate, also one of the same id or vector; a repeated query id is searched for once for
    each of its rows (its ranks come as often).  Repeated candidates count one by one.  Fewer than k candidates give fewer rows; an
    empty table none.  Other columns are left aside."""
    spark = vectors.sparkSession
    rows, dim = usable(vectors, id_col, vec_col)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = rows.count()
    draw = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1 << 20))
    part = rows if n <= CENTRE_ROWS else rows.where(draw < int((1 << 20) * CENTRE_ROWS / n))
    means = part.agg(*[F.avg(F.col("vec")[j].cast("double")) for j in range(dim)]).first()
    centre = np.array([m or 0.0 for m in means])
    turn = rotation(dim)

    def make():
        def step(b: pa.RecordBatch):
            x = _rows(pa.chunked_array([b.column("vec")]), np.float64)
            bits, length, fit = encode(x, centre, turn)
            return b.column("vec_id"), b.column("vec"), [r.tobytes() for r in bits], length, fit

        return step

    # row numbers are taken from a checkpoint: they stay when a task runs again
    index = cut(arrow_map(rows, make, _CODE)).withColumn("uid", F.monotonically_increasing_id())
    asked = index.where(queries).select(F.col("uid").alias("quid"), F.col("vec_id").alias("query_id"),
                                        F.col("vec").alias("query"))
    m = asked.count()
    q_blocks, v_blocks = max(1, math.ceil(m / QUERY_BLOCK)), max(1, math.ceil(n / VECTOR_BLOCK))

    def blocks(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    # dealt by row number, so a repeated id cannot fill a block
    left = (asked.withColumn("qb", F.pmod(F.xxhash64("quid"), F.lit(q_blocks)).cast("int"))
            .withColumn("vb", blocks(v_blocks)))
    right = (index.withColumn("vb", F.pmod(F.xxhash64("uid"), F.lit(v_blocks)).cast("int"))
             .withColumn("qb", blocks(q_blocks)))
    found = (left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb"))
             .applyInArrow(_search_blocks(centre, turn, k), _FOUND))
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))


def op4_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
