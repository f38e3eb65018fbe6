"""Exact top-k search by inner product, term at a time over whole posting lists.

Vectors are quantised to integers, ``floor(256 * x)`` of every component, and taken as sparse
rows: a term is a component's place, a weight its integer, and zero weights are not kept.  The
candidates are dealt into shards of a bounded number of components.  A shard holds, for every
term, the places of its rows with that term and their weights.  Every query row visits every
shard: for each of its terms it adds (its weight x the posting's weights) into a dense array
with one score per row of the shard.  The k-th best score is found by partition selection, so
a shard yields at most k rows a query, and the last step merges these.

Candidates travel once, queries once per shard.  Shards are streams sorted by row and cut off
by their id, so a task holds one shard, one Arrow batch of queries and one score array.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm.common import table
from marketstream.session import cut

SCALE = 256
SHARD_COMPONENTS = 1 << 21      # components of a shard, about; longer vectors, fewer rows
_FOUND = "uid long, query_id long, vec_id long, score long"
_LONG = np.iinfo(np.int64)


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as int64, or as Python integers where one of them needs more than 62 bits."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    if not len(scaled) or np.abs(scaled).max() < 2.0 ** 62:
        return scaled.astype(np.int64)
    return np.array([int(v * SCALE) if abs(v) < 1e300 else int(v) * SCALE
                     for v in np.where(np.abs(x) < 2.0 ** 53, scaled / SCALE, x).tolist()], object)


class Shard:
    """Posting lists of some rows: ``ids`` in ascending order, null ids last."""

    def __init__(self, ids: list, uids: np.ndarray, vectors: list[np.ndarray]):
        self.ids, self.uids = ids, uids
        sizes = np.fromiter(map(len, vectors), np.int64, len(vectors))
        weight = np.concatenate(vectors) if vectors else np.array([], np.int64)
        row = np.repeat(np.arange(len(vectors), dtype=np.int32), sizes)
        term = (np.arange(len(weight)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        some = weight != 0
        row, term, weight = row[some], term[some], weight[some]
        order = np.argsort(term, kind="stable")
        row, term, weight = row[order], term[order], weight[order]
        ends = np.searchsorted(term, np.arange(int(term[-1]) + 2)) if len(term) else np.zeros(1, int)
        self.postings = [(row[a:b], weight[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.largest = [int(np.abs(w).max()) if len(w) else 0 for _, w in self.postings]
        self.whole = [len(r) == len(ids) for r, _ in self.postings]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The inner products of a quantised query with all rows, one term after another."""
        terms = np.flatnonzero(query[:len(self.postings)] != 0).tolist()
        top = sum(abs(int(query[t])) * self.largest[t] for t in terms)
        out = np.zeros(len(self.ids), np.int64 if top <= _LONG.max else object)
        for t in terms:
            rows, weights = self.postings[t]
            u = int(query[t])
            if out.dtype == object:
                out[rows] += weights.astype(object) * u
            elif self.whole[t]:
                out += weights * u
            else:
                out[rows] += weights * u
        return out

    def best(self, query: np.ndarray, uid: int, k: int) -> list[tuple]:
        """(vec_id, score) of the k highest scores but the query's own row, smaller ids
        first on ties; rows stand in order of their ids."""
        scores = self.scores(query)
        others = np.flatnonzero(self.uids != uid)
        mine = scores if len(others) == len(scores) else scores[others]
        if len(mine) > k:
            # object scores hold Python integers, which argpartition compares as well
            bar = np.partition(mine, len(mine) - k)[len(mine) - k]
            above = np.flatnonzero(mine > bar)
            take = np.concatenate([above, np.flatnonzero(mine == bar)[:k - len(above)]])
        else:
            take = np.arange(len(mine))
        return [(self.ids[others[j]], min(max(int(mine[j]), _LONG.min), _LONG.max)) for j in take]


def _search(k: int):
    schema = pa.schema([("uid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_id: int | None = None
        rows: list[tuple] = []
        shard: Shard | None = None
        for b in batches:
            out: list[tuple] = []
            cols = [b.column(n).to_pylist() for n in ("shard", "asked", "uid", "vec_id")]
            vec = b.column("vec")
            flat = vec.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(vec.value_lengths().to_numpy())])
            for j, (s, asked, uid, vec_id) in enumerate(zip(*cols, strict=True)):
                if s != shard_id:
                    shard_id, rows, shard = s, [], None
                x = quantised(flat[ends[j]:ends[j + 1]])
                if not asked:                   # candidates of a shard come before its queries
                    rows.append((vec_id, uid, x))
                    continue
                if shard is None:
                    shard = Shard([r[0] for r in rows], np.array([r[1] for r in rows], np.int64),
                                  [r[2] for r in rows])
                    rows = []
                out += [(uid, vec_id, i, score) for i, score in shard.best(x, uid, k)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)],
                    schema=schema)

    return run


def top_k(vectors: DataFrame, asked: Column, k: int, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """The ``k`` rows with the highest integer inner products for each query row: query_id,
    rank (from 1), vec_id, score; ties go to the smaller id.

    ``asked`` is a condition on ``vec_id`` that picks the query rows; every other row of the
    table is a candidate, also one with the same id or the same vector.  A repeated query row
    is searched for each time it stands there (its ranks come as often).  Null vectors and
    vectors with a null, NaN or infinite component take no part.  A row with a null id is no
    query; as a candidate it comes after all ids on ties.  Vectors of different lengths meet in
    the components that both have, an empty one scores 0 with all.  Scores beyond a long are
    cut to its ends.  Fewer than k candidates give fewer rows, an empty table none; other
    columns are left aside."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).cast("array<double>").alias("vec"))

    def finite(c):
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    # row numbers are taken from a checkpoint: they stay when a task runs again
    index = cut(rows.where(F.col("vec").isNotNull() & F.forall("vec", finite))
                ).withColumn("uid", F.monotonically_increasing_id())
    size = index.agg(F.sum(F.size("vec") + 1).alias("n")).first()["n"] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-size // SHARD_COMPONENTS))
    candidates = (index.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
                  .withColumn("asked", F.lit(False)))
    queries = (index.where(asked)
               .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
               .withColumn("asked", F.lit(True)))
    cols = ["shard", "asked", "uid", "vec_id", "vec"]
    dealt = (candidates.select(cols).union(queries.select(cols))
             .repartitionById(shards, F.col("shard"))
             .sortWithinPartitions("shard", "asked", F.col("vec_id").asc_nulls_last(), "uid"))
    found = dealt.mapInArrow(_search(k), _FOUND)
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))


def op11_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every row whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


SQL = """WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT a.uid, a.vec_id AS query_id, b.vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q),
              lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.uid <> b.uid WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""
