"""Venue message feeds derived from the driver's ``events`` table (FIXTURES.md §3).

Each feed is a raw topic: ``(arrival, receipt_time, value)`` with ``value`` the JSON text
a venue would send, so the whole path from text to book is exercised.  All numbers are
integers so results compare exactly with the DuckDB oracle.  Everything here is
DataFrame work that scales with ``events``; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.functions import iso_time, symbol_of
from marketstream.operators.scan import Running, running
from marketstream.schemas import L3_SNAPSHOT_TYPE


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  When the scan yields fewer splits than the cluster has cores (a
    small file with one row group), spread it round-robin so the JSON work downstream
    runs on every core; a large input already has enough splits and is left as read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        df = df.repartition(cores)
    return df


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base`` of FIXTURES §3, plus the message time text and a receipt time 1 ms later."""
    e = read_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.col("event_id").alias("i"), "user_id", "event_type",
        ts.alias("ts"),
        (ts + F.expr("INTERVAL 1 MILLISECOND")).alias("receipt_time"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("long").alias("k"),
        (F.floor("value").cast("long") + 1).alias("sz"),
    )


def _s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _side(n: Column) -> Column:
    return F.when(n % 2 == 0, F.lit("buy")).otherwise(F.lit("sell"))


def _raw(df: DataFrame, fields: dict[str, Column], arrival: Column | None = None) -> DataFrame:
    """Pack ``fields`` into the JSON text; absent (null) fields are left out."""
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return df.select((arrival if arrival is not None else F.col("i")).alias("arrival"),
                     "receipt_time", body.alias("value"))


# ---------------------------------------------------------------- trades / routing
def trades_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``match`` message per event: symbol user_id%4, price k+1, size sz,
    maker side by i%2, trade id i, time ts."""
    b = base(spark, sf_dir)
    return _raw(b, _match_fields())


def _match_fields() -> dict[str, Column]:
    i = F.col("i")
    return {
        "type": F.lit("match"), "trade_id": i,
        "maker_order_id": F.concat(F.lit("m"), _s(i)),
        "taker_order_id": F.concat(F.lit("t"), _s(i)),
        "side": _side(i), "size": _s("sz"), "price": _s(F.col("k") + 1),
        "product_id": symbol_of("user_id"), "sequence": i, "time": iso_time("ts"),
    }


def routing_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type by event_type: click->ticker, purchase->match, signup->activate,
    view->an unknown type, error->no type at all.  Ticker time is absent when i%10=0."""
    b = base(spark, sf_dir)
    i, et = F.col("i"), F.col("event_type")
    click, purchase = et == "click", et == "purchase"
    m = _match_fields()
    typ = (F.when(click, "ticker").when(purchase, "match").when(et == "signup", "activate")
           .when(et == "view", "bogus"))
    fields = {
        "type": typ,
        "product_id": symbol_of("user_id"), "sequence": i,
        "time": F.when(~click | (i % 10 != 0), iso_time("ts")),
        "price": _s(F.col("k") + 1),
        "best_bid": F.when(click, _s(F.col("k") + 1)),
        "best_ask": F.when(click, _s(F.col("k") + 2)),
        "trade_id": F.when(click | purchase, i),
        "maker_order_id": F.when(purchase, m["maker_order_id"]),
        "taker_order_id": F.when(purchase, m["taker_order_id"]),
        "side": F.when(click | purchase, _side(i)),
        "size": F.when(purchase, _s("sz")),
        "last_size": F.when(click, _s("sz")),
    }
    return _raw(b, fields)


def reject_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that no handler can use, by i%10: a snapshot with a short level, a bad and a
    short change, a bad ticker, a bad trade, a bad order change, an order without an id, a
    match on an unknown maker, broken JSON, and (9) a change with an empty price, which is
    ignored."""
    b = base(spark, sf_dir)
    i = F.col("i")
    m = i % 10
    at = lambda *ks: m.isin(*ks)
    types = ["snapshot", "l2update", "l2update", "ticker", "match", "change", "open", "match",
             "open", "change"]
    typ = F.element_at(F.array(*map(F.lit, types)), (m + 1).cast("int"))
    one, oid = F.lit("1"), F.concat(F.lit("o"), _s(i))
    fields = {
        "type": typ, "product_id": symbol_of("user_id"), "sequence": i, "time": iso_time("ts"),
        "bids": F.when(at(0), F.array(F.array(_s("k"), one))),
        "asks": F.when(at(0), F.array(F.array(F.lit("5")))),
        "changes": F.when(at(1), F.array(F.array(F.lit("buy"), F.lit("abc"), one)))
        .when(at(2), F.array(F.array(F.lit("buy")))),
        "best_bid": F.when(at(3), F.lit("x")), "best_ask": F.when(at(3), one),
        "side": F.lit("buy"),
        "price": F.when(at(9), F.lit("")).when(~at(0, 1, 2), one),
        "size": F.when(at(4), F.lit("bad")).when(at(7), one),
        "trade_id": F.when(at(4, 7), i),
        "maker_order_id": F.when(at(4, 7), F.concat(F.lit("m"), _s(i))),
        "order_id": F.when(at(5, 9), oid),
        "new_size": F.when(at(5), F.lit("zz")).when(at(9), one),
        "remaining_size": F.when(at(6), one),
    }
    return _raw(b, fields).withColumn("value", F.when(F.col("arrival") % 10 == 8, "{broken")
                                      .otherwise(F.col("value")))


# ---------------------------------------------------------------- level 2
def l2_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``l2update`` (one change) per event, and a five-level ``snapshot`` at every
    i%250=0.  Update amount: 0 for errors (removal), -1 for view rows with i%50=7
    (ignored by the book), else sz.  Snapshot level d: side d%2, price (k+7d)%100,
    amount d+1."""
    b = base(spark, sf_dir)
    i, k = F.col("i"), F.col("k")
    snap = i % 250 == 0
    amt = (F.when(F.col("event_type") == "error", 0)
           .when((F.col("event_type") == "view") & (i % 50 == 7), -1)
           .otherwise(F.col("sz")))

    def level(d: int) -> Column:
        return F.array(_s((k + d * 7) % 100), F.lit(str(d + 1)))

    fields = {
        "type": F.when(snap, "snapshot").otherwise("l2update"),
        "product_id": symbol_of("user_id"),
        "time": F.when(~snap, iso_time("ts")),
        "changes": F.when(~snap, F.array(F.array(_side(i), _s(k), _s(amt)))),
        "bids": F.when(snap, F.array(level(0), level(2), level(4))),
        "asks": F.when(snap, F.array(level(1), level(3))),
    }
    return _raw(b, fields)


# ---------------------------------------------------------------- level 3
def l3_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The L3 feed rows of FIXTURES §3 as columns (i, sym, seq, oid, taker, side, price,
    typ, size, otype, ts, receipt_time).

    Row i belongs to order o = i div 4 - 16 (i%4); its phases (received, open, match,
    done/change) are 16 orders apart, so orders overlap.  ``seq`` is 1000 + the row's
    rank within its symbol, computed with the chunked running count (no single-task
    window per symbol).
    """
    b = base(spark, sf_dir)
    j = F.floor(F.col("i") / 4).cast("long")
    m = b.select("i", "ts", "receipt_time", j.alias("j"), (F.col("i") % 4).alias("p"),
                 (j - F.lit(16) * (F.col("i") % 4)).alias("o"))
    a = b.select(F.col("i").alias("a_i"), F.col("k").alias("price"), F.col("sz").alias("osz"))
    f0 = (m.join(a, F.col("a_i") == F.col("o") * 4, "left")
          .withColumn("sym", F.col("j") % 4)
          .withColumn("side", F.col("o") % 2))
    f0 = running(f0, ["sym"], ["i"], [Running("rank", F.lit(1))])
    o, p, price, sz = F.col("o"), F.col("p"), F.col("price"), F.col("osz")
    typ = (F.when((o < 0) | price.isNull(), "activate").when(p == 0, "received")
           .when((o % 7 == 0) & p.isin(1, 2), "activate").when(p == 1, "open")
           .when(p == 2, "match").when(o % 7 == 0, "done_mkt").when(o % 3 == 0, "change")
           .otherwise("done"))
    size = (F.when(p == 2, F.when(o % 5 == 0, sz)
                   .otherwise(F.greatest(F.lit(1), F.floor(sz / 2).cast("long"))))
            .when(p == 3, F.floor(sz / 4).cast("long") + 1).otherwise(sz))
    return f0.select(
        "i", "sym", (F.lit(1000) + F.col("rank")).alias("seq"), o.alias("oid"),
        F.when((o % 11 == 0) & (o >= 32), o - 32).otherwise(F.col("j")).alias("taker"),
        "side", "price", typ.alias("typ"), size.alias("size"),
        F.when(o % 7 == 0, "market").otherwise("limit").alias("otype"),
        "ts", "receipt_time")


def l3_fields() -> dict[str, Column]:
    typ = F.col("typ")
    oid, side = _s("oid"), _side(F.col("side"))
    is_t = typ.isin
    return {
        "type": F.when(typ == "done_mkt", "done").otherwise(typ),
        "product_id": symbol_of("sym"), "sequence": F.col("seq"), "time": iso_time("ts"),
        "order_id": F.when(typ != "match", oid),
        "order_type": F.when(typ == "received", F.col("otype")),
        "side": F.when(typ != "activate", side),
        "price": F.when(is_t("open", "match", "done", "change"), _s("price")),
        "remaining_size": F.when(is_t("open", "done"), _s("size")),
        "size": F.when(typ == "match", _s("size")),
        "new_size": F.when(typ == "change", _s("size")),
        "reason": F.when(typ == "change", "STP").when(typ == "done", "canceled")
                   .when(typ == "done_mkt", "filled"),
        "trade_id": F.when(typ == "match", F.col("i")),
        "maker_order_id": F.when(typ == "match", oid),
        "taker_order_id": F.when(typ == "match", _s("taker")),
    }


def l3_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ungapped full-channel feed as raw messages (arrival = i)."""
    return _raw(l3_rows(spark, sf_dir), l3_fields())


def gapped_feed(spark: SparkSession, sf_dir: str, with_orders: bool = False) -> DataFrame:
    """The L3 feed as delivered with faults, for the sequence gate.

    Rows with i%997=5 are lost; rows with i%499=3 are delivered again 8 rows later; every
    symbol gets an L3 snapshot at each i%2000=0 whose sequence is that of the symbol's
    last row before i.  Arrival is ``8 * a + slot`` with ``a`` the fixture's arrival and
    the snapshot slots (0..3, one per symbol) before the message slot (4).

    Snapshots are empty unless ``with_orders``: then they hold the symbol's resting
    orders of the ungapped book at their sequence, as [price, size, order_id] per side.
    """
    rows = l3_rows(spark, sf_dir)
    fields = l3_fields()
    live = rows.where(F.col("i") % 997 != 5)
    first = _raw(live, fields, F.col("i") * 16 + 12)                       # a = 2i+1
    again = _raw(rows.where(F.col("i") % 499 == 3), fields,
                 (F.col("i") + 8) * 16 + 20)                               # a = 2(i+8)+2
    points = snapshot_points(rows).withColumn("arrival", F.col("i") * 16 + F.col("sym"))
    empty = F.array().cast("array<array<string>>")
    if with_orders:
        points = _with_orders(rows, points)
        bids, asks = F.coalesce("bids", empty), F.coalesce("asks", empty)
    else:
        bids = asks = empty
    snaps = _raw(points, {
        "type": F.lit(L3_SNAPSHOT_TYPE), "product_id": symbol_of("sym"),
        "sequence": F.col("seq"), "bids": bids, "asks": asks,
    }, F.col("arrival"))                                                   # a = 2i
    return first.unionByName(again).unionByName(snaps)


def _with_orders(rows: DataFrame, points: DataFrame) -> DataFrame:
    """The snapshot points with their bids and asks from the ungapped L3 book of ``rows``.  One
    snapshot is one record holding one symbol's book, as the venue's REST reply does."""
    from marketstream.operators import l3 as L3
    from marketstream.operators.parse import parse_messages

    states = L3.l3_states(L3.l3_rows(L3.with_epoch(parse_messages(_raw(rows, l3_fields())))))
    pts = points.select(symbol_of("sym").alias("symbol"), F.struct(*points.columns).alias("point"), "seq")
    return L3.books_as_of(states, pts).select("point.*", "bids", "asks")


def snapshot_points(rows: DataFrame) -> DataFrame:
    """(i, sym, seq, receipt_time) for every symbol at every i%2000=0: the sequence of
    the symbol's last row before i (1000 when there is none).

    As a running max over probes merged into the feed (an as-of lookup), not a cross
    join: each probe row takes the max ``seq`` of earlier rows of its symbol.
    """
    probes = (rows.where(F.col("i") % 2000 == 0)
              .select("i", "receipt_time",
                      F.explode(F.sequence(F.lit(0), F.lit(3)).cast("array<long>")).alias("sym"))
              .select("i", "sym", "receipt_time", F.lit(None).cast("long").alias("seq"),
                      F.lit(0).alias("o")))
    data = rows.select("i", "sym", "receipt_time", "seq", F.lit(1).alias("o"))
    merged = running(probes.unionByName(data), ["sym"], ["i", "o"],
                     [Running("prev", F.col("seq"), "max", exclusive=True)])
    return (merged.where(F.col("o") == 0)
            .select("i", "sym", "receipt_time",
                    F.coalesce(F.col("prev"), F.lit(1000)).alias("seq")))
