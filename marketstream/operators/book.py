"""Book views: O2 sorted sides, O3 depth cap, best bid / ask summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def depth(book: DataFrame, n: int) -> DataFrame:
    """O2/O3: the best ``n`` levels per (exchange, symbol, side): bids by price descending, asks
    ascending, with their level number.  ``row_number <= n`` is planned as a window
    group limit, so each task keeps only its top ``n`` per side before the shuffle."""
    key = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy("exchange", "symbol", "side").orderBy(key)
    return (book.withColumn("lvl", F.row_number().over(w).cast("long"))
            .where(F.col("lvl") <= n)
            .select("exchange", "symbol", "side", "price", "amount", "lvl"))


def summary(book: DataFrame) -> DataFrame:
    """Best bid / ask, level counts and sizes per book (a partial aggregation)."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    zero = F.lit(0).cast("decimal(38,18)")
    return book.groupBy("exchange", "symbol").agg(
        F.max(F.when(bid, F.col("price"))).alias("best_bid"),
        F.min(F.when(ask, F.col("price"))).alias("best_ask"),
        F.count(F.when(bid, 1)).alias("bid_levels"),
        F.count(F.when(ask, 1)).alias("ask_levels"),
        F.sum(F.when(bid, F.col("amount")).otherwise(zero)).alias("bid_size"),
        F.sum(F.when(ask, F.col("amount")).otherwise(zero)).alias("ask_size"))
