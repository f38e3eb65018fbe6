"""Running aggregates over a key in message order, safe for hot keys.

The reference keeps per-symbol and per-order state and updates it message by message.
In batch that is a running aggregate (a window with ``rows unbounded preceding``)
partitioned by the key.  A plain window puts a whole key in one task; with four symbols
(or one hot order book) that is a third of the data in one task.  ``running`` instead
splits every key into chunks of at most ``chunk_rows`` consecutive rows and does a
two-level scan:

1. within (key, chunk): ordinary windows give the local running value;
2. one summary row per (key, chunk) -- the state at the chunk's last row;
3. over the (small) summary table, a window per key gives the state carried *into*
   each chunk;
4. the carry is joined back on (key, chunk) and combined with the local value.

The big side is shuffled by (key, chunk) for its windows.  The local result is
checkpointed (reliable, in the shared checkpoint folder) because both the summary and the
join read it; what is read back has no known partitioning, so a later scan shuffles it
again.  The summary table has one row per (key, chunk), so even a key holding a third of
100 TB yields only ``rows / chunk_rows`` summary rows.  All inputs, also those of a single
chunk, take the same steps.

Supported aggregates are the monoids the book logic needs: ``sum``, ``max`` and ``last``
(last non-null value; wrap a value in a struct to get ``lag`` semantics).  A ``reset``
column starts a new segment at that row (segmented scan), which expresses windows such
as ``partition by (key, epoch)`` where ``epoch`` counts resets, without partitioning on
the derived column.

The state that a scan leaves behind is a row per key, of the same kind as a chunk's summary.
Given to the next scan over later rows (``carry``), it enters the summary table as the chunk
before all others; so a feed may be scanned piece by piece with the same results.  The scans of
a micro-batch, which is bounded, are in streaming/state.py.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marketstream.session import CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS, conf_int, cut

_OPS = ("sum", "max", "last")
_BEFORE = -(1 << 63)         # the chunk number of what came before the rows
#: Carried rows that may meet the big side by a broadcast: some 10 MB.
SMALL_CARRY = 1 << 16


@dataclass(frozen=True)
class Running:
    name: str                    # output column
    value: Column                # the row's contribution (null contributes nothing)
    op: str = "sum"              # sum | max | last
    reset: Column | None = None  # true: the row opens a new segment (its value included)
    exclusive: bool = False      # frame stops one row before the current row

    def __post_init__(self):
        if self.op not in _OPS:
            raise ValueError(f"unsupported running aggregate {self.op!r}")


def _agg(op: str, c: Column) -> Column:
    if op == "sum":
        return F.sum(c)
    if op == "max":
        return F.max(c)
    return F.last(c, ignorenulls=True)


def _combine(op: str, carry: Column, local: Column) -> Column:
    if op == "sum":
        return (F.when(local.isNull(), carry).when(carry.isNull(), local)
                .otherwise(local + carry))
    if op == "max":
        return F.greatest(local, carry)
    return F.coalesce(local, carry)


def running(df: DataFrame, keys: list[str], order: list[str], specs: list[Running],
            chunk_rows: int | None = None, keep_chunk: bool = False) -> DataFrame:
    """Add one column per spec: the running aggregate over ``keys`` in ``order``."""
    return scanned(df, keys, order, specs, chunk_rows, keep_chunk)[0]


def plain(name: str, *args, **kwargs) -> DataFrame:
    """``running`` for operators that name their scans: from the first row on, leaving no
    state.  The live path passes a scan that goes on from the state of that name."""
    return running(*args, **kwargs)


def small(df: DataFrame) -> DataFrame:
    """``df`` written and counted: broadcast to what it meets where it holds few rows, which
    Spark's estimate may not tell, else merged with it."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= SMALL_CARRY else df.hint("merge")


def scanned(df: DataFrame, keys: list[str], order: list[str], specs: list[Running],
            chunk_rows: int | None = None, keep_chunk: bool = False,
            carry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, state): ``running`` after earlier rows, whose state is ``carry``, and the state
    after these: the keys of this scan's rows with one column per spec.

    ``order[0]`` must be an integral column (arrival / offset); rows with equal
    ``order`` values inside one key must be told apart by the remaining order columns.
    Key columns must be non-null (callers quarantine rows without a key first).

    With ``keep_chunk`` the chunk column ``_ck`` stays on the result and a following
    ``running`` over the same keys takes it as it is.
    """
    spark = df.sparkSession
    c_rows = chunk_rows or conf_int(spark, CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS)
    ck = "_ck"
    d = df if ck in df.columns else df.withColumn(
        ck, F.floor(F.col(order[0]) / F.lit(c_rows)).cast("long"))
    by_chunk = Window.partitionBy(*keys, ck).orderBy(*order)
    upto = by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    for i, s in enumerate(specs):
        d = d.withColumn(f"_v{i}", s.value)
        if s.reset is not None:
            flag = F.when(F.coalesce(s.reset.cast("boolean"), F.lit(False)), 1).otherwise(0)
            d = d.withColumn(f"_s{i}", F.sum(flag).over(upto))

    # 1. local running values inside (key, chunk[, local segment])
    for i, s in enumerate(specs):
        part = [*keys, ck] + ([f"_s{i}"] if s.reset is not None else [])
        w = Window.partitionBy(*part).orderBy(*order)
        incl = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = d.withColumn(f"_t{i}", _agg(s.op, F.col(f"_v{i}")).over(incl))
        if s.exclusive:
            excl = w.rowsBetween(Window.unboundedPreceding, -1)
            d = d.withColumn(f"_a{i}", _agg(s.op, F.col(f"_v{i}")).over(excl))

    # The local result feeds both the summary and the final join; materialise it once
    # (partitioned by key and chunk) so neither branch recomputes it and chained scans
    # do not nest their plans.
    seen = Observation()
    d = cut(d.observe(seen, F.count(F.lit(1)).alias("rows")))

    # 2. state at the last row of each (key, chunk)
    payload = [F.col(f"_t{i}").alias(f"t{i}") for i in range(len(specs))]
    payload += [F.col(f"_s{i}").alias(f"s{i}") for i, s in enumerate(specs) if s.reset is not None]
    summary = (d.groupBy(*keys, ck)
               .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_p"))
               .select(*keys, ck, "_p.*"))

    if carry is not None:       # earlier rows, as the chunk before all others
        prior = carry.join(summary.select(*keys).distinct(), keys, "left_semi").select(
            *keys, F.lit(_BEFORE).alias(ck),
            *[F.col(s.name).alias(f"t{i}") for i, s in enumerate(specs)],
            *[F.lit(0).cast("long").alias(f"s{i}") for i, s in enumerate(specs) if s.reset is not None])
        summary = prior.unionByName(summary)

    # 3. state carried into each chunk, from the chunks before it
    per_key = Window.partitionBy(*keys).orderBy(ck)
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    upto_chunk = per_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carries = summary
    for i, s in enumerate(specs):
        if s.reset is None:
            carries = carries.withColumn(f"c{i}", _agg(s.op, F.col(f"t{i}")).over(before))
            carries = carries.withColumn(f"e{i}", _agg(s.op, F.col(f"t{i}")).over(upto_chunk))
        else:
            grp = F.sum(F.when(F.col(f"s{i}") > 0, 1).otherwise(0)).over(
                per_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            carries = carries.withColumn(f"g{i}", grp)
            after = _agg(s.op, F.col(f"t{i}")).over(
                Window.partitionBy(*keys, f"g{i}").orderBy(ck)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
            carries = carries.withColumn(f"e{i}", after)
            carries = carries.withColumn(f"c{i}", F.lag(f"e{i}").over(per_key))
    ends = F.struct(*[F.col(f"e{i}").alias(s.name) for i, s in enumerate(specs)])
    state = carries.groupBy(*keys).agg(F.max_by(ends, ck).alias("_e")).select(*keys, "_e.*")
    carries = carries.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                             F.col(ck).alias("_k_ck"),
                             *[F.col(f"c{i}").alias(f"_c{i}") for i in range(len(specs))])
    # Only keys that straddle a chunk boundary carry anything.  For high-cardinality keys
    # (order ids) that is a small fraction of (key, chunk) pairs, so the table that meets
    # the big side is mostly small enough to broadcast instead of reshuffling the big side.
    any_carry = F.lit(False)
    for i in range(len(specs)):
        any_carry = any_carry | F.col(f"_c{i}").isNotNull()
    carries = carries.where(any_carry)
    # Chunks that hold few rows of a key carry about as many rows as there are.  Spark takes
    # the carry for as small as the compressed input, so it is counted where it may be large.
    if seen.get["rows"] > SMALL_CARRY:
        carries = cut(carries)
        if carries.count() > SMALL_CARRY:
            carries = carries.hint("merge")

    # 4. join the carry back and combine
    cond = [d[k] == carries[f"_k_{k}"] for k in keys] + [d[ck] == carries["_k_ck"]]
    j = d.join(carries, cond, "left")
    temp = ([] if keep_chunk else [ck]) + ["_k_ck", *[f"_k_{k}" for k in keys]]
    for i, s in enumerate(specs):
        local = F.col(f"_a{i}") if s.exclusive else F.col(f"_t{i}")
        carry = F.col(f"_c{i}")
        if s.reset is not None:
            carry = F.when(F.col(f"_s{i}") == 0, carry)
        # a sum of decimals would lose a place of its scale
        j = j.withColumn(s.name, _combine(s.op, carry, local).cast(d.schema[f"_t{i}"].dataType))
        temp += [f"_v{i}", f"_t{i}", f"_a{i}", f"_s{i}", f"_c{i}"]
    return j.drop(*[t for t in temp if t in j.columns]), state
