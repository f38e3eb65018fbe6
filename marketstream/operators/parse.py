"""S2/S11 parse, P8-P12 routing and P15 quarantine.

``parse_messages`` turns a raw topic ``(arrival, receipt_time, value)`` into one wide,
typed row per message with a ``route``.  Nothing is dropped silently: messages the
handler would skip or choke on get a route the quarantine reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.functions import exchange as venue
from marketstream.schemas import (CHANNEL_TYPES, HANDLED_TYPES, IGNORED_TYPES,
                                  L3_SNAPSHOT_TYPE, RAW_MESSAGE)

# route per handled type (P10); L3 snapshots come from the landed REST responses
ROUTES = {
    "ticker": "ticker", "match": "trade", "last_match": "trade",
    "snapshot": "l2", "l2update": "l2",
    "open": "l3", "done": "l3", "change": "l3",
    "received": "received", L3_SNAPSHOT_TYPE: "l3snapshot",
}
INVALID_ROUTES = ["malformed", "unknown_type", "missing_type"]


def _route(t: Column) -> Column:
    r = F.when(F.lit(False), F.lit(None))
    for typ, route in ROUTES.items():
        r = r.when(t == typ, F.lit(route))
    return r.when(t.isin(*IGNORED_TYPES), F.lit("ignored"))


def parse_once(expr: Column, name: str) -> list[Column]:
    """Evaluate an expensive expression (a JSON parse) once per row.

    Without a barrier the optimizer inlines ``from_json(...)`` into every field access
    and into pushed-down filters, parsing each message once per referenced field.  A
    one-element ``inline`` generator is evaluated once and is not inlined through;
    nested-column pruning still narrows the parsed schema to the fields used."""
    return [F.inline(F.array(F.struct(expr.alias(name))))]


def parse_messages(raw: DataFrame, exchange: str | None = None) -> DataFrame:
    """Raw text -> typed message rows.

    Columns: arrival, receipt_time, value, every field of ``RAW_MESSAGE``, ``exchange``,
    ``symbol`` (normalised; product ids are already BASE-QUOTE), ``route``.
    Routes: ticker, trade, l2, l3, received, l3snapshot, ignored (P11), unknown_type
    (P12: warned), missing_type (P12: silently dropped by the reference), malformed
    (bad JSON, empty or null text, or a field of the wrong JSON type; P15/D4).
    """
    m = F.from_json(F.col("value"), RAW_MESSAGE, {"columnNameOfCorruptRecord": "_corrupt"})
    p = raw.select("arrival", "receipt_time", "value", *parse_once(m, "m")).select(
        "arrival", "receipt_time", "value", "m.*",
        F.col("m").isNull().alias("_empty"))
    t = F.col("type")
    route = (F.when(F.col("_empty") | F.col("_corrupt").isNotNull(), F.lit("malformed"))
             .when(t.isNull(), F.lit("missing_type"))
             .otherwise(F.coalesce(_route(t), F.lit("unknown_type"))))
    return (p.withColumn("route", route)
            .withColumn("exchange", F.lit(exchange) if exchange else venue())
            .withColumn("symbol", F.col("product_id"))
            .drop("_empty"))


def route_counts(parsed: DataFrame) -> DataFrame:
    """Messages per route (partial aggregation; one row per route)."""
    return parsed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def invalid_messages(parsed: DataFrame) -> DataFrame:
    """P12/P15 side output: what the handler warns about or skips, with the reason."""
    return (parsed.where(F.col("route").isin(*INVALID_ROUTES))
            .select("arrival", F.col("route").alias("reason"), "type", "value"))


def subscribe(parsed: DataFrame, channels: list[str], symbols: list[str]) -> DataFrame:
    """Keep the messages a subscription (channel x symbol list) would deliver.

    ``channels`` are standard names (ticker, trades, l2_book, l3_book) mapped to venue
    channels and their message types.  Adds the venue ``channel`` of each message.
    """
    from marketstream.schemas import CHANNELS

    chan = F.when(F.lit(False), F.lit(None))
    types: list[str] = []
    for std in channels:
        venue = CHANNELS[std]
        chan = chan.when(F.col("type").isin(*CHANNEL_TYPES[venue]), F.lit(venue))
        types += CHANNEL_TYPES[venue]
    return (parsed.where(F.col("type").isin(*types) & F.col("symbol").isin(*symbols))
            .withColumn("channel", chan))


__all__ = ["parse_messages", "route_counts", "invalid_messages", "subscribe", "HANDLED_TYPES"]
