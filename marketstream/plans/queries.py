"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame whose columns
match the DuckDB oracle of the same name (marketstream.plans.oracle)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.operators import gate as G
from marketstream.operators import l2 as L2
from marketstream.operators import l3 as L3
from marketstream.operators.normalize import bad_numbers
from marketstream.operators.normalize import products as build_products
from marketstream.operators.normalize import tickers as build_tickers
from marketstream.operators.normalize import trades as build_trades
from marketstream.operators.normalize import with_products
from marketstream.operators.parse import (invalid_messages as build_invalid, parse_messages,
                                          route_counts as build_route_counts, subscribe)
from marketstream.session import fresh_dir
from marketstream.sources import feeds
from marketstream.streaming.consumer import decode_trades, read_trades_table
from marketstream.streaming.sinks import trade_records

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- trades path
def trades_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue match messages -> trades -> trade topic records -> consumer projection,
    newest first (the venue notebook's one SQL read)."""
    recs = trade_records(build_trades(parse_messages(feeds.trades_feed(spark, sf_dir))))
    return decode_trades(recs).orderBy(F.desc("ts"))


def trade_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_records(build_trades(parse_messages(feeds.trades_feed(spark, sf_dir))))


def trades_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records landed as files, consumed as a stream (availableNow, a few files
    per trigger) through the idempotent foreachBatch writer, then read back."""
    from marketstream.streaming.consumer import read_topic, start_trades_stream

    work = fresh_dir(spark, "trades-stream")
    landing, table, ckpt = (os.path.join(work, p) for p in ("landing", "table", "checkpoint"))
    trade_record(spark, sf_dir).select("value").write.mode("overwrite").text(landing)
    stream = read_topic(spark, {}, fmt="text", path=landing, max_files=2)
    q = start_trades_stream(decode_trades(stream), table, ckpt, available_now=True)
    q.awaitTermination()
    name = "trades_" + os.path.basename(work).replace("-", "_")
    return read_trades_table(spark, table, name=name)


#: Rows of a landed venue file in ``pipeline_trades``.
LANDED_ROWS = 1 << 18


def pipeline_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue messages -> trade topic -> trades table, by the two jobs one after the other
    over landed files; read back as the consumer's SQL does."""
    from marketstream import jobs

    work = fresh_dir(spark, "pipeline-trades")
    at = {p: os.path.join(work, p) for p in ("venue", "topics", "table", "ck1", "ck2")}
    # files, and so their row groups, of bounded size: a stream's task reads whole row groups
    (feeds.trades_feed(spark, sf_dir).write.mode("overwrite")
     .option("maxRecordsPerFile", LANDED_ROWS).parquet(at["venue"]))
    drain = ["--available-now", "--max-files", "1000"]
    jobs.main(["venue_to_topics", "--input", at["venue"], "--out", at["topics"],
               "--checkpoint", at["ck1"], *drain], spark=spark)
    jobs.main(["trades_to_table", "--input", os.path.join(at["topics"], "trade"), "--format",
               "parquet", "--table-path", at["table"], "--checkpoint", at["ck2"], *drain],
              spark=spark)
    return read_trades_table(spark, at["table"])


def trade_record_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade records of a feed whose trades lack their id at every seventh row, with
    missing text replaced."""
    t = build_trades(parse_messages(feeds.trades_feed(spark, sf_dir)))
    t = t.withColumn("trade_id", F.when(F.col("arrival") % 7 != 0, F.col("trade_id")))
    return trade_records(t, none_to="none")


def trades_newest(spark: SparkSession, sf_dir: str, n: int = 100) -> DataFrame:
    """O1: the newest trades with their places, newest first."""
    from pyspark.sql import Window

    t = trades_table(spark, sf_dir)
    w = Window.orderBy(F.desc("ts"), F.desc("trade_id"))
    # a limit of the window, so each task keeps its newest n before they meet
    return (t.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
            .select("place", "symbol", "ts", "trade_id"))


def topic_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST10: the trade topic written by a stream whose every batch runs twice (= the trade
    records)."""
    from marketstream.streaming import exactly_once

    work = fresh_dir(spark, "once")
    src, topic = os.path.join(work, "src"), os.path.join(work, "topic")
    trade_record(spark, sf_dir).write.parquet(src)

    def twice(batch: DataFrame, batch_id: int) -> None:
        exactly_once.stage(batch, topic, batch_id)            # an attempt that died
        exactly_once.write_once(batch, batch_id, topic)
        exactly_once.write_once(batch, batch_id, topic)

    q = (spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 4)
         .parquet(src).writeStream.foreachBatch(twice)
         .option("checkpointLocation", os.path.join(work, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    return exactly_once.read(spark, topic)


#: A week of the trades that ``trades_clustered`` asks for (ns).
WEEK = (1_704_672_000_000_000_000, 1_705_276_800_000_000_000)


def trades_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: one symbol and week of the clustered trades table, after four batches and a
    compaction."""
    from marketstream.session import cut
    from marketstream.sources import clustered

    path = os.path.join(fresh_dir(spark, "clustered"), "trades")
    rows = cut(decode_trades(trade_record(spark, sf_dir)))
    for k in range(4):
        clustered.append(rows.where(F.pmod(F.col("trade_id").cast("long"), F.lit(4)) == k), path)
    clustered.compact(spark, path)
    return clustered.read(spark, path, rows.schema, "BTC-USD", *WEEK)


# ---------------------------------------------------------------- routing
def _routed(spark, sf_dir):
    return parse_messages(feeds.routing_feed(spark, sf_dir))


def tickers(spark, sf_dir):
    return build_tickers(_routed(spark, sf_dir)).select(
        "exchange", "symbol", "bid", "ask", "ts", "receipt_ts", "arrival")


def route_counts(spark, sf_dir):
    return build_route_counts(_routed(spark, sf_dir))


def invalid_messages(spark, sf_dir):
    return build_invalid(_routed(spark, sf_dir)).select("arrival", "reason", "type")


def _products(spark, sf_dir):
    recs = (feeds.base(spark, sf_dir)
            .select(feeds.symbol_of("user_id").alias("id")).distinct()
            .select("id", F.lit("0.01").alias("quote_increment")))
    return build_products(recs)


def products(spark, sf_dir):
    return _products(spark, sf_dir)


def trades_normalised(spark, sf_dir):
    p = with_products(_routed(spark, sf_dir), _products(spark, sf_dir))
    return build_trades(p).select("exchange", "symbol", "side", "amount", "price", "ts",
                                  "receipt_ts", "trade_id", "arrival")


def subscription_filter(spark, sf_dir):
    s = subscribe(_routed(spark, sf_dir), ["trades", "ticker"], ["BTC-USD", "SOL-USD"])
    return s.select("arrival", "symbol", "channel")


def feeds_union(spark, sf_dir):
    """Fan-in of two venues' feeds (a second venue's trades derived from the signup
    events) with their own columns, unioned by name."""
    cb = _routed(spark, sf_dir)
    t = build_trades(cb).withColumn("kind", F.lit("trade"))
    k = build_tickers(cb).withColumn("kind", F.lit("ticker"))
    other = feeds.base(spark, sf_dir).where(F.col("event_type") == "signup")
    bs = parse_messages(feeds._raw(other, feeds._match_fields()), exchange="BITSTAMP")
    u = t.unionByName(k, allowMissingColumns=True).unionByName(
        build_trades(bs).withColumn("kind", F.lit("trade")), allowMissingColumns=True)
    return u.groupBy("exchange", "kind").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- level 2
def _l2(spark, sf_dir):
    return L2.build_l2(parse_messages(feeds.l2_feed(spark, sf_dir)))


def l2_book(spark, sf_dir):
    return _l2(spark, sf_dir)["book"].drop("exchange")


#: Rows per chunk in the ``*_chunked`` queries: small, so that every scan carries state.
SMALL_CHUNK = 512


def l2_deltas_chunked(spark, sf_dir):
    """``l2_deltas`` over chunks of SMALL_CHUNK arrivals (same rows)."""
    out = L2.build_l2(parse_messages(feeds.l2_feed(spark, sf_dir)), SMALL_CHUNK)["deltas"]
    return out.select("arrival", "symbol", "side", "price", "amount", "ts")


def two_venue_book(spark, sf_dir):
    """Two venues that send the same level-2 feed: a book for each, under one plan."""
    raw = feeds.l2_feed(spark, sf_dir)
    both = parse_messages(raw).unionByName(parse_messages(raw, exchange="BITSTAMP"))
    return L2.build_l2(both)["book"]


def two_venues_apart(spark, sf_dir):
    """Two venues with the same symbols and different feeds: the second sends every other
    message of the first."""
    raw = feeds.l2_feed(spark, sf_dir)
    both = parse_messages(raw).unionByName(
        parse_messages(raw.where("arrival % 2 = 0"), exchange="BITSTAMP"))
    return L2.build_l2(both)["book"]


def l2_deltas(spark, sf_dir):
    return _l2(spark, sf_dir)["deltas"].select("arrival", "symbol", "side", "price", "amount", "ts")


def l2_depth(spark, sf_dir, depth: int = 10):
    from marketstream.operators.book import depth as book_depth
    return book_depth(_l2(spark, sf_dir)["book"], depth).drop("exchange")


def l2_summary(spark, sf_dir):
    from marketstream.operators.book import summary
    return summary(_l2(spark, sf_dir)["book"]).drop("exchange")


def l2_rejects(spark, sf_dir):
    """D6/P15 quarantine: level-2 changes that cannot be applied (before the symbol's
    first snapshot, or unparsable numbers)."""
    return _l2(spark, sf_dir)["rejects"].select("arrival", "pos", "symbol", "reason")


def book_record(spark, sf_dir):
    """The final L2 book of each symbol as the book topic's record."""
    from marketstream.streaming.sinks import book_record_json, book_records
    l2 = _l2(spark, sf_dir)
    return book_record_json(book_records(l2["book"], L2.last_change(l2["messages"])))


def _records_each(spark, sf_dir, chunk_rows=None, depth=10):
    from marketstream.operators import living_book as B

    msgs = B.book_messages(parse_messages(feeds.l2_feed(spark, sf_dir)), chunk_rows)
    return B.records_json(B.records_each(msgs, depth, chunk_rows))


def book_records_each(spark, sf_dir):
    """The book topic's record after every level-2 message, ten levels a side."""
    return _records_each(spark, sf_dir)


def book_records_each_chunked(spark, sf_dir):
    """``book_records_each`` over chunks of SMALL_CHUNK changes (same rows)."""
    return _records_each(spark, sf_dir, SMALL_CHUNK)


def l2_message_deltas(spark, sf_dir):
    """The delta of every level-2 message, both sides, empty ones included."""
    from marketstream.operators import living_book as B

    return B.deltas_json(B.message_deltas(B.book_messages(
        parse_messages(feeds.l2_feed(spark, sf_dir)))))


# ---------------------------------------------------------------- level 3
def _l3_msgs(spark, sf_dir):
    return L3.with_epoch(parse_messages(feeds.l3_feed(spark, sf_dir)))


def _l3(spark, sf_dir):
    return L3.build_l3(_l3_msgs(spark, sf_dir))


def l3_feed_types(spark, sf_dir):
    p = parse_messages(feeds.l3_feed(spark, sf_dir))
    kind = F.when((F.col("type") == "done") & F.col("price").isNull(), "done_mkt").otherwise(F.col("type"))
    return p.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def l3_book(spark, sf_dir):
    return _l3(spark, sf_dir)["book"].drop("exchange")


def l3_deltas(spark, sf_dir):
    return _l3(spark, sf_dir)["deltas"].select("arrival", "symbol", "side", "price", "order_id",
                                               "size", "sequence", "ts")


def l3_levels(spark, sf_dir):
    return _l3(spark, sf_dir)["levels"].drop("exchange")


def l3_level_maps(spark, sf_dir):
    """A2: price -> {order_id: size}, in parts, with the totals of each level."""
    m = L3.l3_level_maps(_l3(spark, sf_dir)["book"])
    return m.select("symbol", "side", "price", "part", F.to_json(F.transform_values(
        "orders", lambda k, v: v.cast("double"))).alias("orders"), "level_orders", "level_size")


def l3_deltas_chunked(spark, sf_dir):
    """``l3_deltas`` over chunks of SMALL_CHUNK arrivals (same rows)."""
    msgs = L3.with_epoch(parse_messages(feeds.l3_feed(spark, sf_dir)), SMALL_CHUNK)
    return L3.build_l3(msgs, SMALL_CHUNK)["deltas"].select(
        "arrival", "symbol", "side", "price", "order_id", "size", "sequence", "ts")


def partitioned_deltas(spark, sf_dir):
    """The L3 feed dealt over five topic partitions with equal offsets, brought into one
    order again (= ``l3_deltas``)."""
    from marketstream.sources.partitioned import numbered

    raw = feeds.l3_feed(spark, sf_dir)
    dealt = raw.select((F.col("arrival") % 5).cast("int").alias("partition"),
                       F.floor(F.col("arrival") / 5).cast("long").alias("offset"),
                       "receipt_time", "value")
    msgs = L3.with_epoch(parse_messages(numbered(dealt)))
    return L3.build_l3(msgs)["deltas"].select("arrival", "symbol", "side", "price", "order_id",
                                              "size", "sequence", "ts")


def unknown_makers(spark, sf_dir):
    """Matches on makers that are not on the book."""
    return L3.unknown_makers(_l3(spark, sf_dir)["states"]).drop("exchange")


def unknown_makers_lossy(spark, sf_dir):
    """The same over a feed that lost the opens of every thirteenth order."""
    p = parse_messages(feeds.l3_feed(spark, sf_dir))
    lost = (F.col("type") == "open") & (F.col("order_id").cast("long") % 13 == 0)
    states = L3.build_l3(L3.with_epoch(p.where(~lost)))["states"]
    return L3.unknown_makers(states).drop("exchange")


def rejects_all(spark, sf_dir):
    """Every kind of unusable message in one feed, counted by source and reason;
    none of them stops the query."""
    p = parse_messages(feeds.reject_feed(spark, sf_dir))
    l3 = L3.build_l3(L3.with_epoch(p))
    parts = [("message", build_invalid(p)), ("number", bad_numbers(p)),
             ("l2", L2.build_l2(p)["rejects"]), ("l3", L3.l3_rejects(l3["rows"], l3["states"]))]
    out = None
    for source, rows in parts:
        rows = rows.select(F.lit(source).alias("source"), "reason")
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


def trades_with_order_type(spark, sf_dir):
    msgs = _l3_msgs(spark, sf_dir)
    states = L3.l3_states(L3.l3_rows(msgs))
    return L3.trades_with_order_type(msgs, states).select(
        "trade_id", "symbol", "side", "amount", "price", "ts", "order_type")


def trades_without_l3(spark, sf_dir):
    """Typed trades without level-3 upkeep: full fills do not forget an order's type."""
    return L3.trades_with_order_type(_l3_msgs(spark, sf_dir), None).select(
        "trade_id", "symbol", "side", "amount", "price", "ts", "order_type")


# ---------------------------------------------------------------- gate
#: What the verdicts alone need of a message.
_GATE = ["arrival", "exchange", "symbol", "route", "sequence", "value"]


def _verdicts(spark, sf_dir):
    return G.sequence_gate(parse_messages(feeds.gapped_feed(spark, sf_dir)).select(*_GATE))


def seq_verdicts(spark, sf_dir):
    return _verdicts(spark, sf_dir).select(
        F.floor(F.col("arrival") / 8).cast("long").alias("arrival"), "symbol", "sequence",
        F.col("snap").cast("long").alias("snap"), "epoch", "verdict")


def seq_gaps(spark, sf_dir):
    return G.gaps(_verdicts(spark, sf_dir)).withColumn(
        "arrival", F.floor(F.col("arrival") / 8).cast("long"))


def seq_counts(spark, sf_dir):
    return _verdicts(spark, sf_dir).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def seq_verdicts_chunked(spark, sf_dir):
    """``seq_verdicts`` over chunks of SMALL_CHUNK arrivals (same rows)."""
    v = G.sequence_gate(parse_messages(feeds.gapped_feed(spark, sf_dir)).select(*_GATE), SMALL_CHUNK)
    return v.select(F.floor(F.col("arrival") / 8).cast("long").alias("arrival"), "symbol",
                    "sequence", F.col("snap").cast("long").alias("snap"), "epoch", "verdict")


def mixed_gated(spark, sf_dir):
    """A gated feed together with level-2 messages: what the gate accepts and what bypasses
    it, counted by route and verdict."""
    p = parse_messages(feeds.gapped_feed(spark, sf_dir)).unionByName(
        parse_messages(feeds.l2_feed(spark, sf_dir)))
    return (G.gate_and_route(p).groupBy("route", "verdict")
            .agg(F.count(F.lit(1)).alias("n")))


def _accepted_l3(spark, sf_dir):
    """The gapped feed with order-carrying snapshots behind the gate: ok messages and the
    snapshots, each snapshot starting a new epoch; and how a snapshot's lists are read.  The gate
    does not look into them, so they stay in the feed until entries are made of them."""
    raw = feeds.gapped_feed(spark, sf_dir, True)
    parsed = parse_messages(raw).select(*(c for c in L3.FIELDS if c not in L3.LISTS), "value")

    def lists(snaps):
        few = raw.join(snaps.select("arrival"), "arrival", "left_semi")      # before the parse
        return parse_messages(few).where(F.col("route") == "l3snapshot")

    return G.accepted(G.sequence_gate(parsed)), lists


def _gated_l3(spark, sf_dir):
    """L3 behind the gate: only what it accepts reaches the book.  The states of its messages;
    snapshot entries beside them where a message names the order."""
    acc, lists = _accepted_l3(spark, sf_dir)
    return L3.l3_states(L3.l3_named_rows(acc, lists)), acc


def _final_book(acc, lists=None):
    """The book that the accepted messages leave, from those of each book's latest epoch."""
    states = L3.l3_states(L3.l3_rows(L3.latest_epoch(acc), lists))
    return L3.l3_book(states, acc.select("exchange", "symbol", "epoch")).drop("exchange")


def l3_gated_book(spark, sf_dir):
    return _final_book(*_accepted_l3(spark, sf_dir))


def l3_book_landed_snapshots(spark, sf_dir):
    """The gated book where messages and snapshots are two sources: each snapshot landed
    twice, at no particular place, and merged by its sequence (= ``l3_gated_book``)."""
    from marketstream.session import cut
    from marketstream.sources.snapshots import lists_of, merged

    parsed = parse_messages(feeds.gapped_feed(spark, sf_dir, True)).select(*L3.FIELDS)
    snap = F.col("route") == "l3snapshot"

    def landed(df):
        snaps = df.where(snap)
        return snaps.unionByName(snaps).withColumn("arrival", F.lit(0).cast("long"))

    narrow = cut(parsed.drop(*L3.LISTS))         # read more than once
    feed = merged(narrow.where(~snap), landed(narrow))
    acc = G.accepted(G.sequence_gate(feed.withColumn("value", F.lit(None).cast("string"))))
    return _final_book(acc, lambda snaps: lists_of(snaps, landed(parsed)))


def l3_gated_deltas(spark, sf_dir):
    """Deltas of the gated book, snapshot entries excluded."""
    states, _ = _gated_l3(spark, sf_dir)
    return (L3.l3_deltas(states).where(F.col("sub") == 0)
            .select(F.floor(F.col("arrival") / 8).cast("long").alias("arrival"), "symbol", "side",
                    "price", "order_id", "size", "sequence", "epoch"))


def trades_gated_order_type(spark, sf_dir):
    """J1 behind the gate: trades that pass the gate, typed from the orders remembered in
    their symbol's current epoch."""
    states, acc = _gated_l3(spark, sf_dir)
    return L3.trades_with_order_type(acc, states).select(
        "trade_id", "symbol", "side", "amount", "price",
        F.floor(F.col("arrival") / 8).cast("long").alias("arrival"), "order_type")


# ---------------------------------------------------------------- live (streaming) forms
#: Rows of a micro-batch in the ``*_stream`` queries.
LIVE_ROWS = 1 << 15


def _live(spark, feed, gate, l2, l3, name):
    from marketstream.streaming.live import replay
    return replay(spark, feed, gate, l2, l3, name, LIVE_ROWS)


def l2_stream(spark, sf_dir):
    """The L2 deltas of the live books over the landed L2 feed (must equal ``l2_deltas``)."""
    o, _, _ = _live(spark, feeds.l2_feed(spark, sf_dir), False, True, False, "l2-stream")
    return o.where(F.col("kind") == "l2delta").select(
        "arrival", "symbol", "side", "price", F.col("size").alias("amount"), "ts")


def l3_stream(spark, sf_dir):
    """The L3 deltas of the live books over the landed L3 feed (= ``l3_deltas``)."""
    o, _, _ = _live(spark, feeds.l3_feed(spark, sf_dir), False, False, True, "l3-stream")
    return o.where(F.col("kind") == "l3delta").select(
        "arrival", "symbol", "side", "price", "order_id", "size", "sequence", "ts")


def seq_stream(spark, sf_dir):
    """Gate verdicts of the live books over the gapped feed (= ``seq_verdicts``)."""
    o, _, _ = _live(spark, feeds.gapped_feed(spark, sf_dir), True, False, False, "seq-stream")
    return o.where(F.col("kind") == "verdict").select(
        F.floor(F.col("arrival") / 8).cast("long").alias("arrival"), "symbol", "sequence",
        F.col("snap").cast("long").alias("snap"), "epoch", "verdict")


def l3_gated_stream(spark, sf_dir):
    """Gated L3 deltas of the live books over the gapped feed with order-carrying
    snapshots (= ``l3_gated_deltas``)."""
    o, _, _ = _live(spark, feeds.gapped_feed(spark, sf_dir, True), True, False, True, "l3-gated")
    return o.where((F.col("kind") == "l3delta") & (F.col("sub") == 0)).select(
        F.floor(F.col("arrival") / 8).cast("long").alias("arrival"), "symbol", "side",
        "price", "order_id", "size", "sequence", "epoch")


def rejects_stream(spark, sf_dir):
    """P15 live: every kind of unusable message, counted by source and reason
    (= ``rejects_all``)."""
    o, _, _ = _live(spark, feeds.reject_feed(spark, sf_dir), False, True, True, "rejects-stream")
    return (o.where(F.col("kind") == "reject").groupBy("source", "reason")
            .agg(F.count(F.lit(1)).alias("n")))


def l2_book_from_state(spark, sf_dir):
    """ST6/S15: the final L2 book read from the live state (= ``l2_book``)."""
    from marketstream.streaming.state import l2_book as book

    _, state, n = _live(spark, feeds.l2_feed(spark, sf_dir), False, True, False, "l2-state")
    return book(spark, state, n).drop("exchange")


def l3_book_from_state(spark, sf_dir):
    """ST6/S15: the final gated L3 book read from the live state (= ``l3_gated_book``)."""
    from marketstream.streaming.state import l3_book as book

    _, state, n = _live(spark, feeds.gapped_feed(spark, sf_dir, True), True, False, True, "l3-state")
    return book(spark, state, n).drop("exchange")


def _in_utc(q: Query) -> Query:
    """Venue times are UTC on the wire and the driver's naive timestamps are UTC: pin the
    session time zone before planning (the session builder already does this)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return q(spark, sf_dir)
    run.__name__, run.__doc__ = q.__name__, q.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {k: _in_utc(v) for k, v in _registry().items()}


def _registry() -> dict[str, Query]:
    return {
        "trades_table": trades_table,
        "trades_stream": trades_stream,
        "trade_record": trade_record,
        "pipeline_trades": pipeline_trades,
        "trade_record_filled": trade_record_filled,
        "trades_newest": trades_newest,
        "topic_exactly_once": topic_exactly_once,
        "trades_clustered": trades_clustered,
        "tickers": tickers,
        "route_counts": route_counts,
        "invalid_messages": invalid_messages,
        "trades_normalised": trades_normalised,
        "subscription_filter": subscription_filter,
        "products": products,
        "feeds_union": feeds_union,
        "l2_book": l2_book,
        "l2_deltas": l2_deltas,
        "l2_deltas_chunked": l2_deltas_chunked,
        "two_venue_book": two_venue_book,
        "two_venues_apart": two_venues_apart,
        "l2_depth": l2_depth,
        "l2_summary": l2_summary,
        "book_record": book_record,
        "book_records_each": book_records_each,
        "book_records_each_chunked": book_records_each_chunked,
        "l2_message_deltas": l2_message_deltas,
        "l2_rejects": l2_rejects,
        "l3_feed_types": l3_feed_types,
        "l3_book": l3_book,
        "l3_deltas": l3_deltas,
        "l3_levels": l3_levels,
        "l3_deltas_chunked": l3_deltas_chunked,
        "l3_level_maps": l3_level_maps,
        "trades_without_l3": trades_without_l3,
        "partitioned_deltas": partitioned_deltas,
        "unknown_makers": unknown_makers,
        "unknown_makers_lossy": unknown_makers_lossy,
        "rejects_all": rejects_all,
        "trades_with_order_type": trades_with_order_type,
        "seq_verdicts": seq_verdicts,
        "seq_verdicts_chunked": seq_verdicts_chunked,
        "mixed_gated": mixed_gated,
        "seq_gaps": seq_gaps,
        "seq_counts": seq_counts,
        "l3_gated_book": l3_gated_book,
        "l3_gated_deltas": l3_gated_deltas,
        "l3_book_landed_snapshots": l3_book_landed_snapshots,
        "trades_gated_order_type": trades_gated_order_type,
        "l2_stream": l2_stream,
        "l3_stream": l3_stream,
        "seq_stream": seq_stream,
        "l3_gated_stream": l3_gated_stream,
        "rejects_stream": rejects_stream,
        "l2_book_from_state": l2_book_from_state,
        "l3_book_from_state": l3_book_from_state,
    }
