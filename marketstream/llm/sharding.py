"""Sampled splitters: shards of near-equal bytes, in DataFrame operations alone.

1. A sample of keys is drawn with chances in proportion to size; the key is a hash of the
   text, so equal texts are neighbours.
2. The sample's quantiles become the boundaries of many small ranges, and every record is
   put into its range.
3. Ranges that came out overfull (a text with very many copies) are subdivided.
4. Sums per range give every record its byte position in the order of keys, and the
   position gives shard and slot.  Copies stay in one shard unless they are too many.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketstream.llm.common import table
from marketstream.session import cut

RANGE_BYTES = 1 << 28       # text per range, about
LEAST_RANGES = 64
SAMPLES = 32                # sampled keys per range, about
BROADCAST_RANGES = 1 << 20  # splitter tables beyond this are joined by shuffle
#: Copies whose bytes are at most this share of a shard are kept together.
TOGETHER = 100


def _sums_before(df: DataFrame, bucket: str, order: list[str], value: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over all rows that come earlier by (bucket,
    order).  Rows are summed inside buckets; the sums of buckets are few."""
    per = df.groupBy(bucket).agg(F.sum(value).alias("_s"))
    base = per.select(bucket, F.coalesce(F.sum("_s").over(
        Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_base"))
    inside = Window.partitionBy(bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(base, bucket)
            .withColumn("before", F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_base"))


def _splitters(rows: DataFrame, total: int, ranges: int, bits: int) -> DataFrame:
    """One row per bucket of key space: ``base``, the number of splitters in earlier
    buckets, and ``cuts``, its own in order."""
    wanted = ranges * SAMPLES
    draw = (F.xxhash64("h", "doc_id", F.lit(1)).bitwiseAND(F.lit((1 << 40) - 1))
            / F.lit(float(1 << 40)))
    chance = F.col("size") * F.lit(wanted / total)
    sample = (rows.where(draw < chance)
              .select("h", F.shiftright("h", 64 - bits).alias("bucket"),
                      F.greatest(F.lit(1.0), chance).alias("weight")))
    ranked = _sums_before(sample, "bucket", ["h"], "weight")
    whole = sample.agg(F.sum("weight").alias("whole"))
    cuts = (ranked.join(F.broadcast(whole))          # one row
            .groupBy(F.floor(F.col("before") * ranges / F.col("whole")).alias("q"))
            .agg(F.min("h").alias("h")).where("q > 0").select("h").distinct()
            .groupBy(F.shiftright("h", 64 - bits).alias("bucket"))
            .agg(F.sort_array(F.collect_list("h")).alias("cuts")))
    half = 1 << (bits - 1)
    buckets = (rows.sparkSession.range(-half, half).select(F.col("id").alias("bucket"))
               .join(cuts, "bucket", "left")
               .withColumn("cuts", F.coalesce("cuts", F.array().cast("array<long>"))))
    return buckets.withColumn("base", F.coalesce(F.sum(F.size("cuts")).over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def shards(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
           range_bytes: int = RANGE_BYTES, least_ranges: int = LEAST_RANGES) -> DataFrame:
    """Per row of ``docs``: the id, ``size`` (UTF-8 bytes and 1; a null text has 1),
    ``text_crc32`` (of the empty text for null), ``shard`` and ``slot``.

    The shards' sizes differ from the mean by less than 1 % of it and one record's size.
    Repeated rows and null ids are placed like any other; other columns are left aside; an
    empty table gives no rows.  Text goes no further than the first projection: what is
    sampled, written and shuffled are keys and sizes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # written once: later steps read the same row numbers, also after a loss
    rows = cut(docs.select(F.col(id_col).alias("doc_id"),
                           (F.octet_length(text) + 1).cast("long").alias("size"),
                           F.crc32(text.cast("binary")).alias("text_crc32"),
                           F.xxhash64(text).alias("h")))
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    n, total = whole["n"], whole["bytes"] or 1
    ranges = max(least_ranges, math.ceil(total / range_bytes))
    bits = max(10, math.ceil(math.log2(ranges)))
    lookup = _splitters(rows, total, ranges, bits)
    if (1 << bits) <= BROADCAST_RANGES:     # at most so many rows, and so many splitters
        lookup = F.broadcast(lookup)
    ranged = (rows.withColumn("bucket", F.shiftright("h", 64 - bits)).join(lookup, "bucket")
              .withColumn("range", (F.col("base") + F.size(F.filter(
                  "cuts", lambda c: c <= F.col("h")))).cast("long"))
              .select("doc_id", "size", "text_crc32", "h", "uid", "range"))
    ranged = cut(ranged)

    # overfull ranges, by bytes or by rows, are subdivided by row number
    by_bytes, by_rows = total / ranges, max(1.0, n / ranges)
    parts = F.greatest(F.ceil(F.col("b") / by_bytes), F.ceil(F.col("r") / by_rows))
    sizes = (ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("r"))
             .select("range", F.when((F.col("b") > 2 * by_bytes) | (F.col("r") > 2 * by_rows),
                                     parts).otherwise(F.lit(1)).cast("long").alias("parts")))
    split = (ranged.join(sizes, "range")
             .withColumn("sub", F.pmod(F.xxhash64("uid"), F.col("parts"))))
    per = split.groupBy("range", "sub").agg(F.sum("size").alias("b"))
    earlier = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    bases = per.select("range", "sub", F.coalesce(F.sum("b").over(earlier), F.lit(0))
                       .alias("base"))

    # byte positions inside each (sub)range, and of the group of copies
    order = Window.partitionBy("range", "sub").orderBy("h", "doc_id", "uid")
    group = Window.partitionBy("range", "sub", "h")
    inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    placed = (split.join(bases, ["range", "sub"]).withColumn("at", F.col("base") + inside)
              .withColumn("first", F.min("at").over(group))
              .withColumn("bytes", F.sum("size").over(group)))
    small = (F.col("parts") == 1) & (F.col("bytes") * (TOGETHER * n_shards) <= total)
    start = F.when(small, F.col("first")).otherwise(F.col("at"))
    placed = cut(placed.withColumn("shard", F.least(
        F.lit(n_shards - 1), F.floor(start * n_shards / F.lit(total))).cast("int"))
        .select("doc_id", "size", "text_crc32", "h", "uid", "range", "sub", "shard"))

    # slots: rows of the shard in earlier (sub)ranges, and before this one inside its own
    counts = placed.groupBy("shard", "range", "sub").agg(F.count(F.lit(1)).alias("c"))
    ahead = (Window.partitionBy("shard").orderBy("range", "sub")
             .rowsBetween(Window.unboundedPreceding, -1))
    heads = counts.select("shard", "range", "sub",
                          F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("head"))
    own = Window.partitionBy("range", "sub", "shard").orderBy("h", "doc_id", "uid")
    return (placed.join(heads, ["range", "sub", "shard"])
            .withColumn("slot", F.col("head") + F.row_number().over(own) - 1)
            .select(F.col("doc_id").alias(id_col), "size", "text_crc32", "shard",
                    F.col("slot").cast("long")))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    out = shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
