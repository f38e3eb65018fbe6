"""N1/N2 normalised tickers and trades, J4 symbol normalisation, S12 products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.functions import dec, event_ts_ns, split_product, taker_side, to_ns


def tickers(parsed: DataFrame) -> DataFrame:
    """N1 + P5: (exchange, symbol, bid, ask, ts, receipt_ts, arrival).  Rows whose best
    bid/ask do not parse are left to ``bad_numbers``."""
    t = parsed.where(F.col("route") == "ticker")
    return t.select(
        "exchange", "symbol", dec("best_bid").alias("bid"), dec("best_ask").alias("ask"),
        event_ts_ns("time", "receipt_time").alias("ts"),
        to_ns("receipt_time").alias("receipt_ts"), "arrival",
    ).where(F.col("bid").isNotNull() & F.col("ask").isNotNull())


def trades(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """N2 + P16: one trade per match / last_match: taker side, amount, price, ts (P5),
    trade id as text, maker / taker order ids, sequence and arrival (plus ``keep``)."""
    t = parsed.where(F.col("route") == "trade")
    return t.select(
        "exchange", "symbol", taker_side("side").alias("side"),
        dec("size").alias("amount"), dec("price").alias("price"),
        event_ts_ns("time", "receipt_time").alias("ts"),
        to_ns("receipt_time").alias("receipt_ts"),
        F.col("trade_id").cast("string").alias("trade_id"),
        "maker_order_id", "taker_order_id", F.col("sequence"), "arrival", *(keep or []),
    ).where(F.col("amount").isNotNull() & F.col("price").isNotNull())


def unparsable() -> Column:
    """Whether a parsed message is a ticker or trade whose money fields fail to parse."""
    tick = (F.col("route") == "ticker") & (dec("best_bid").isNull() | dec("best_ask").isNull())
    trade = (F.col("route") == "trade") & (dec("size").isNull() | dec("price").isNull())
    return tick | trade


def bad_numbers(parsed: DataFrame) -> DataFrame:
    """Ticker / trade rows whose money fields fail to parse (quarantine)."""
    return (parsed.where(unparsable())
            .select("arrival", F.lit("bad_number").alias("reason"), "type", "value"))


# ---------------------------------------------------------------- products
def products(product_records: DataFrame) -> DataFrame:
    """Product list records (id, quote_increment) -> one row per product:
    (symbol, product_id, base, quote, tick_size, instrument_type).  Ids that are not
    exactly BASE-QUOTE are left out (see ``bad_products``); repeated ids keep one row."""
    base, quote, ok = split_product("id")
    return (product_records.where(ok)
            .select(F.concat_ws("-", base, quote).alias("symbol"), F.col("id").alias("product_id"),
                    base.alias("base"), quote.alias("quote"),
                    dec("quote_increment").alias("tick_size"),
                    F.lit("spot").alias("instrument_type"))
            .dropDuplicates(["product_id"]))


def bad_products(product_records: DataFrame) -> DataFrame:
    _, _, ok = split_product("id")
    return product_records.where(~ok | F.col("id").isNull())


def symbol_info(prod: DataFrame) -> DataFrame:
    """A4: attribute -> {symbol: value} maps (tick_size, instrument_type), one row."""
    return prod.agg(
        F.map_from_entries(F.collect_list(F.struct("symbol", F.col("tick_size").cast("string"))))
        .alias("tick_size"),
        F.map_from_entries(F.collect_list(F.struct("symbol", "instrument_type")))
        .alias("instrument_type"))


def with_products(df: DataFrame, prod: DataFrame, on: str = "product_id") -> DataFrame:
    """Attach the normalised symbol and product attributes.

    A plain join: Spark broadcasts the product list where its measured size is below the
    session's threshold, and shuffles otherwise."""
    p = prod.select(F.col("product_id").alias(on), F.col("symbol").alias("_psymbol"),
                    "tick_size", "instrument_type")
    j = df.join(p, on, "left")
    return j.withColumn("symbol", F.coalesce("_psymbol", "symbol")).drop("_psymbol")
