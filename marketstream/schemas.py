"""Fixed schemas: raw venue messages, the compatibility trade record, silver rows."""

from __future__ import annotations

from pyspark.sql import types as T

DEC = T.DecimalType(38, 18)

# Fixed values that must equal the venue's: exchange id, the subscribed symbols
# (in this order), the channel names per standard channel, and the message types the
# handler accepts and ignores.
EXCHANGE = "COINBASE"
SYMBOLS = ["BTC-USD", "ETH-USD", "AVAX-USD", "SOL-USD"]
CHANNELS = {"l2_book": "level2", "l3_book": "full", "trades": "matches", "ticker": "ticker"}
CHANNEL_TYPES = {
    "ticker": ["ticker"],
    "matches": ["match", "last_match"],
    "level2": ["snapshot", "l2update"],
    "full": ["received", "open", "done", "match", "change", "activate", "last_match"],
}
HANDLED_TYPES = ["ticker", "match", "last_match", "snapshot", "l2update", "open", "done",
                 "change", "received"]
IGNORED_TYPES = ["activate", "subscriptions"]
# landed L3 snapshots have no ``type``; we tag them when landing
L3_SNAPSHOT_TYPE = "l3snapshot"

_S = T.StringType()
_L = T.LongType()
_LEVELS = T.ArrayType(T.ArrayType(_S))

# One wide nullable struct for every message family.  Money stays a string here and is
# parsed with try_cast, so one bad number quarantines one record, not the batch.
RAW_MESSAGE = T.StructType([
    T.StructField("type", _S), T.StructField("product_id", _S), T.StructField("sequence", _L),
    T.StructField("time", _S),
    # ticker
    T.StructField("price", _S), T.StructField("open_24h", _S), T.StructField("volume_24h", _S),
    T.StructField("low_24h", _S), T.StructField("high_24h", _S), T.StructField("volume_30d", _S),
    T.StructField("best_bid", _S), T.StructField("best_ask", _S), T.StructField("last_size", _S),
    # match / last_match
    T.StructField("trade_id", _L), T.StructField("maker_order_id", _S),
    T.StructField("taker_order_id", _S), T.StructField("side", _S), T.StructField("size", _S),
    # full channel
    T.StructField("order_id", _S), T.StructField("order_type", _S),
    T.StructField("remaining_size", _S), T.StructField("old_size", _S),
    T.StructField("new_size", _S), T.StructField("reason", _S),
    # level2 snapshot / update, L3 snapshot ([price, size(, order_id)])
    T.StructField("bids", _LEVELS), T.StructField("asks", _LEVELS),
    T.StructField("changes", _LEVELS),
    T.StructField("_corrupt", _S),
])

# A raw topic / landed feed: total order, receipt time, the message text.
RAW_FEED = T.StructType([
    T.StructField("arrival", _L), T.StructField("receipt_time", T.TimestampType()),
    T.StructField("value", _S),
])

# The consumer's record schema (JSON) and the 9-column table contract.
TRADE_RECORD = T.StructType([
    T.StructField("exchange", _S), T.StructField("symbol", _S), T.StructField("side", _S),
    T.StructField("price", T.FloatType()), T.StructField("ts", _L),
    T.StructField("receipt_ts", _L), T.StructField("size", T.FloatType()),
    T.StructField("trade_id", _S), T.StructField("epoch", _L),
])
TRADES_TABLE_DDL = ("exchange STRING, symbol STRING, side STRING, price FLOAT, ts BIGINT, "
                    "receipt_ts BIGINT, size DOUBLE, trade_id STRING, epoch BIGINT")
TRADES_TABLE_COLUMNS = ["exchange", "symbol", "side", "price", "ts", "receipt_ts", "size",
                        "trade_id", "epoch"]

PRODUCT = T.StructType([T.StructField("id", _S), T.StructField("quote_increment", _S)])
