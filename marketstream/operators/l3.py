"""Level-3 book and order types: N5-N10, W2, J1-J3, A2, A3, ST6, ST7 in batch (A.3, A.4).

Per order (key = symbol, epoch, order id), in message order:

* ``open`` (and every entry of an L3 snapshot) puts the order on the book at its size;
* ``match`` reduces the maker's size; at <= 0 the order leaves the book;
* ``change`` (with a price) sets the new size; a new size of 0 stays as a 0 entry;
* ``done`` with a price removes the order; ``done`` without one only stops tracking it
  (later messages for it are ignored, its book entry stays);
* messages for orders not on the book are ignored (a match on one is quarantined).

Batch form, all running aggregates over the chunked scan::

    life = running count of opens
    rem  = running sum, reset at open/change: +size (open, change), -size (match), 0 (done)
    fin  = done or kill (done without price) or (match and rem <= 0)
    dead = an earlier row since the last open was fin
    live = life > 0 and not dead and not kill   -> every live row is a delta
    book = last live row per order, unless fin, in the symbol's latest epoch

Order types (J1/ST7): ``received`` remembers an order's type; any ``done`` and a maker's
full fill forget it; a trade takes the remembered type of its taker order, if any.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.functions import book_side, dec, event_ts_ns, to_ns
from marketstream.operators.normalize import trades
from marketstream.operators.scan import Running, plain, running, small

BOOK = ["exchange", "symbol"]     # one book per venue and symbol

#: What level 3, the gate and trades read of a message; scans carry nothing else.
FIELDS = ["arrival", "receipt_time", *BOOK, "route", "type", "sequence", "time", "order_id",
          "order_type", "maker_order_id", "taker_order_id", "trade_id", "side", "price", "size",
          "remaining_size", "new_size", "bids", "asks"]
#: What only a snapshot's entries read: a whole book.
LISTS = ["bids", "asks"]
ROW = "_row"
Lists = Callable[[DataFrame], DataFrame]


def with_epoch(parsed: DataFrame, chunk_rows: int | None = None, scan=plain) -> DataFrame:
    """Per-book epoch = running count of L3 snapshots (no gate: all messages kept).  ``scan``
    may go on from an earlier state of the scan ``l3_epoch``."""
    rel = parsed.where(F.col("route").isin("l3", "trade", "received", "l3snapshot")
                       & F.col("symbol").isNotNull()).select(*FIELDS)
    snap = F.col("route") == "l3snapshot"
    return scan("l3_epoch", rel, BOOK, ["arrival"],
                [Running("epoch", snap.cast("long"), "sum")], chunk_rows)


def l3_rows(msgs: DataFrame, lists: Lists | None = None) -> DataFrame:
    """Book-relevant rows (arrival, sub, symbol, epoch, order_id, kind, side, price, size,
    sequence, ts, bad) from messages that already carry ``epoch``.

    kind: open | match (keyed by the maker) | change | done (priced only).  Snapshot
    entries [price, size, order_id] become opens at the snapshot's arrival, ``sub`` being
    their position (bids first).

    A snapshot's lists hold a whole book, and a scan would write them more than once: messages
    may pass the scans without ``LISTS``.  Then ``lists`` takes the snapshots (arrival,
    exchange, symbol, epoch, sequence, receipt_time) and reads theirs: (arrival, exchange,
    symbol, bids, asks)."""
    return _message_rows(msgs).unionByName(_opens(_entries(_listed(msgs, lists))))


#: 64-bit words of the bit set by which an epoch's snapshot entries are told apart.
NAMED_WORDS = 256


def l3_named_rows(msgs: DataFrame, lists: Lists | None = None) -> DataFrame:
    """``l3_rows`` without the snapshot entries of orders that no message of the same epoch
    names.  Such an order's states are those of its entries alone, so the states of all
    messages (``sub`` 0) are the same, and a feed whose snapshots repeat a large book takes the
    few orders that change through the scans.

    Entries are dropped where they are read: each epoch has a set of bits, one for the hash of
    every order named in it.  Orders that share a bit with a named one go on to the join."""
    one = _message_rows(msgs)
    keys = [*BOOK, "epoch", "order_id"]
    named = one.where(F.col("order_id").isNotNull()).select(*keys).distinct()
    bit = _named_bit("order_id")
    words = (named.select(*BOOK, "epoch", F.floor(bit / 64).cast("int").alias("w"), (bit % 64).cast("int").alias("b"))
             .groupBy(*BOOK, "epoch", "w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("v")))
    sets = (words.groupBy(*BOOK, "epoch").agg(F.map_from_entries(F.collect_list(F.struct("w", "v"))).alias("m"))
            .select(*BOOK, "epoch", F.transform(F.sequence(F.lit(0), F.lit(NAMED_WORDS - 1)), lambda i: F.coalesce(
                F.element_at("m", i), F.lit(0).cast("long"))).alias("_bits")))
    # the text of an entry is narrower than its row
    entries = _entries(_listed(msgs, lists, sets), "_bits")
    return one.unionByName(_opens(entries.join(named, keys, "left_semi")))


def _named_bit(order_id: str) -> Column:
    return F.pmod(F.xxhash64(order_id), F.lit(NAMED_WORDS * 64))


def _listed(msgs: DataFrame, lists: Lists | None, sets: DataFrame | None = None, few=small) -> DataFrame:
    """The snapshots of ``msgs`` with their lists and, given ``sets``, what those hold for their
    epoch (a snapshot without any is left out).  Where messages carry the number of their row
    (``ROW``), lists are told apart by it too."""
    snaps = msgs.where(F.col("route") == "l3snapshot")
    epoch = [*BOOK, "epoch"]
    if lists is None:
        return snaps if sets is None else snaps.join(few(sets), epoch)
    key = ["arrival", *BOOK, *(c for c in (ROW,) if c in snaps.columns)]
    at = snaps.select(*key, "epoch", "sequence", "receipt_time")
    at = few(at if sets is None else at.join(sets, epoch))
    return (lists(at).select(*key, *LISTS).join(at, key)
            .withColumn("route", F.lit("l3snapshot")))


def l3_parts(msgs: DataFrame, lists: Lists | None = None) -> tuple[DataFrame, DataFrame]:
    """``l3_rows`` in two: those of messages, and the opens of snapshot entries.  For a
    micro-batch, whose snapshots are few."""
    return _message_rows(msgs), _opens(_entries(_listed(msgs, lists, few=F.broadcast)))


def usable(rows: DataFrame) -> DataFrame:
    """Rows that reach the book: with numbers and an order id."""
    return rows.where(~F.col("bad") & F.col("order_id").isNotNull())


def opened(opens: DataFrame) -> DataFrame:
    """The states of rows that open their orders, as far as deltas read them: an open puts the
    order on the book at its size, whatever was before."""
    return usable(opens).withColumn("live", F.lit(True)).withColumn("new_size", F.col("size"))


def _message_rows(msgs: DataFrame) -> DataFrame:
    ts = event_ts_ns("time", "receipt_time")
    t = F.col("type")
    single = msgs.where(
        (F.col("route") == "l3") | (F.col("route") == "trade")
    ).where(
        (t == "open") | t.isin("match", "last_match")
        | ((t == "change") & (F.coalesce(F.col("price"), F.lit("")) != ""))   # P14
        | (t == "done")
    )
    # A done without a price only untracks the order ("kill"): later messages for it
    # are ignored, but its book entry stays as it was
    kind = (F.when(t == "last_match", "match")
            .when((t == "done") & F.col("price").isNull(), "kill").otherwise(t))
    size = (F.when(t == "open", F.col("remaining_size")).when(t == "change", F.col("new_size"))
            .when(t.isin("match", "last_match"), F.col("size")))
    return single.select(
        "arrival", F.lit(0).alias("sub"), *BOOK, "epoch",
        F.when(kind == "match", F.col("maker_order_id")).otherwise(F.col("order_id")).alias("order_id"),
        kind.alias("kind"), book_side("side").alias("side"), dec("price").alias("price"),
        F.when(kind.isin("done", "kill"), F.lit(0).cast("decimal(38,18)")).otherwise(dec(size)).alias("size"),
        "sequence", ts.alias("ts"),
        (((kind != "kill") & dec("price").isNull())
         | (~kind.isin("done", "kill") & dec(size).isNull())).alias("bad"))


def _entries(msgs: DataFrame, bits: str | None = None) -> DataFrame:
    """One row per snapshot entry, its price and size as text; with ``bits``, of orders whose bit
    is set."""
    snaps = msgs.where(F.col("route") == "l3snapshot")
    none = F.array().cast("array<array<string>>")
    bids, asks = F.coalesce("bids", none), F.coalesce("asks", none)
    ex = snaps.select("arrival", *BOOK, "epoch", "sequence", "receipt_time", *([bits] if bits else []),
                      F.size(bids).alias("_n"), F.posexplode(F.concat(bids, asks)).alias("sub", "e"))
    ex = ex.withColumn("order_id", F.get("e", F.lit(2)))
    if bits:
        bit = _named_bit("order_id")
        ex = ex.where(F.col("order_id").isNotNull()
                      & (F.getbit(F.get(bits, F.floor(bit / 64).cast("int")), (bit % 64).cast("int")) == 1))
    return ex.select("arrival", (F.col("sub") + 1).alias("sub"), *BOOK, "epoch", "sequence", "receipt_time",
                     "order_id", F.when(F.col("sub") < F.col("_n"), "bid").otherwise("ask").alias("side"),
                     F.get("e", F.lit(0)).alias("price"), F.get("e", F.lit(1)).alias("size"))


def _opens(entries: DataFrame) -> DataFrame:
    """Snapshot entries as rows that open their orders."""
    return entries.select(
        "arrival", "sub", *BOOK, "epoch", "order_id", F.lit("open").alias("kind"), "side",
        dec("price").alias("price"), dec("size").alias("size"),
        "sequence", to_ns("receipt_time").alias("ts"),
        (dec("price").isNull() | dec("size").isNull()).alias("bad"))


def l3_states(rows: DataFrame, chunk_rows: int | None = None, scan=plain) -> DataFrame:
    """Adds life, rem, fin, dead, live, new_size to every book-relevant row.  ``scan`` may go
    on from an earlier state of the scans ``l3_orders`` and ``l3_dead``."""
    rows = usable(rows)
    k = F.col("kind")
    is_open, is_change = k == "open", k == "change"
    signed = (F.when(is_open | is_change, F.col("size")).when(k == "match", -F.col("size"))
              .otherwise(F.lit(0).cast("decimal(38,18)")))
    keys, order = [*BOOK, "epoch", "order_id"], ["arrival", "sub"]
    s = scan("l3_orders", rows, keys, order, [
        Running("life", is_open.cast("long"), "sum"),
        Running("rem", signed, "sum", reset=is_open | is_change),
    ], chunk_rows, keep_chunk=True)
    fin = k.isin("done", "kill") | ((k == "match") & (F.col("rem") <= 0))
    s = scan("l3_dead", s.withColumn("fin", fin), keys, order, [
        Running("dead", F.col("fin").cast("int"), "max", reset=is_open, exclusive=True)],
                chunk_rows)
    live = ((F.col("life") > 0) & (F.coalesce(F.col("dead"), F.lit(0)) == 0)
            & (k != "kill"))
    return (s.withColumn("live", live)
            .withColumn("new_size", F.when(F.col("fin"), F.lit(0).cast("decimal(38,18)"))
                        .otherwise(F.col("rem"))))


def l3_deltas(states: DataFrame) -> DataFrame:
    """One delta per book change: (arrival, sub, symbol, side, price, order_id, size,
    sequence, ts); size 0 = removed.  Snapshot entries are deltas of their epoch too."""
    return (states.where(F.col("live"))
            .select("arrival", "sub", *BOOK, "epoch", "kind", "side", "price", "order_id",
                    F.col("new_size").alias("size"), "sequence", "ts"))


def latest_epoch(msgs: DataFrame) -> DataFrame:
    """The messages of each book's latest epoch: all that the final book depends on, as a
    snapshot opens an epoch with nothing kept."""
    top = msgs.groupBy(*BOOK).agg(F.max("epoch").alias("_top"))
    return msgs.join(top, BOOK).where(F.col("epoch") == F.col("_top")).drop("_top")


def l3_book(states: DataFrame, epochs: DataFrame) -> DataFrame:
    """ST6 final book: (symbol, side, price, order_id, size) in each symbol's latest
    epoch.  Per-order ``max_by`` is a partial aggregation."""
    last = (states.where(F.col("live"))
            .groupBy(*BOOK, "epoch", "order_id")
            .agg(F.max_by(F.struct("side", "price", "new_size", "fin"),
                          F.struct("arrival", "sub")).alias("l"))
            .select(*BOOK, "epoch", "order_id", "l.*"))
    # a feed of one venue may give its epochs by symbol alone
    keys = [k for k in BOOK if k in epochs.columns]
    top = epochs.groupBy(*keys).agg(F.max("epoch").alias("_top"))
    return (last.join(top, keys).where(~F.col("fin") & (F.col("epoch") == F.col("_top")))
            .select(*BOOK, "side", "price", "order_id", F.col("new_size").alias("size")))


def l3_levels(book: DataFrame) -> DataFrame:
    """A2/A3: price levels of the L3 book: order count and total size per level."""
    return (book.groupBy(*BOOK, "side", "price")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("size").alias("size")))


MAP_PARTS = 16


def l3_level_maps(book: DataFrame) -> DataFrame:
    """A2 in the venue's shape, price -> {order_id: size}, in two levels: a price level's orders
    are parted by the last character of their id, so a level with very many orders is the work
    of several tasks and no map holds it whole.  (exchange, symbol, side, price, part, orders,
    level_orders, level_size): each part's map, and the totals of its level, which are sums of
    the parts' totals."""
    level = [*BOOK, "side", "price"]
    part = F.pmod(F.ascii(F.right("order_id", F.lit(1))), F.lit(MAP_PARTS)).cast("int")
    parts = (book.groupBy(*level, part.alias("part"))
             .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("order_id", "size"))))
                  .alias("orders")))
    sums = (book.groupBy(*level, part.alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
            .groupBy(*level).agg(F.sum("n").alias("level_orders"), F.sum("s").alias("level_size")))
    return parts.join(sums, level)


def unknown_makers(states: DataFrame) -> DataFrame:
    """Matches whose maker is not on the book (the venue handler raised here)."""
    return (states.where((F.col("kind") == "match") & ~F.col("live"))
            .select("arrival", *BOOK, "order_id", F.lit("unknown_maker").alias("reason")))


def l3_rejects(rows: DataFrame, states: DataFrame) -> DataFrame:
    """P15/D6 quarantine of the L3 book: (arrival, sub, exchange, symbol, reason) of rows with an
    unparsable price or size, without an order id, or on a maker that is not on the book."""
    reason = (F.when(F.col("bad"), "bad_number")
              .when(F.col("order_id").isNull(), "no_order_id"))
    bad = (rows.withColumn("reason", reason).where(F.col("reason").isNotNull())
           .select("arrival", "sub", *BOOK, "reason"))
    return bad.unionByName(unknown_makers(states).select("arrival", F.lit(0).alias("sub"),
                                                         *BOOK, "reason"))


def trades_with_order_type(msgs: DataFrame, states: DataFrame | None,
                           chunk_rows: int | None = None, scan=plain) -> DataFrame:
    """J1 (A.4): each trade with the type its taker order was ``received`` with, if that
    order is still remembered (not done, not fully filled as a maker).

    Memory is per (book, epoch, order id): a snapshot starts a new epoch with nothing
    remembered, as the venue handler resets its maps before re-snapshotting.  A union of
    set / forget / query rows, then an exclusive running ``last`` per key -- an as-of
    lookup that never materialises pairs.  ``states`` is None when L3 upkeep is off
    (P18): then full fills do not forget."""
    keys = [*BOOK, "epoch", "oid"]

    def ev_rows(df, oid, kind, typ):
        return df.select(*BOOK, "epoch", F.col(oid).alias("oid"), "arrival", F.lit(0).alias("sub"),
                         F.struct(F.lit(kind).alias("k"), typ.cast("string").alias("t")).alias("ev"))

    parts = [ev_rows(msgs.where(F.col("type") == "received"), "order_id", "set", F.col("order_type")),
             ev_rows(msgs.where(F.col("type") == "done"), "order_id", "del", F.lit(None))]
    if states is not None:
        parts.append(ev_rows(states.where(F.col("live") & (F.col("kind") == "match") & F.col("fin")),
                             "order_id", "del", F.lit(None)))
    tr = trades(msgs, keep=["epoch"])
    q = tr.select(*BOOK, "epoch", F.col("taker_order_id").alias("oid"), "arrival",
                  F.lit(1).alias("sub"), F.lit(None).cast("struct<k:string,t:string>").alias("ev"),
                  F.struct(*[c for c in tr.columns if c != "epoch"]).alias("trade"))
    ev = parts[0]
    for p in parts[1:]:
        ev = ev.unionByName(p)
    ev = ev.withColumn("trade", F.lit(None).cast(q.schema["trade"].dataType))
    allrows = ev.unionByName(q).where(F.col("oid").isNotNull() & F.col("symbol").isNotNull())
    r = scan("types", allrows, keys, ["arrival", "sub"],
             [Running("ref", F.col("ev"), "last", exclusive=True)], chunk_rows)
    typed = (r.where(F.col("sub") == 1)
             .select("trade.*", F.when(F.col("ref.k") == "set", F.col("ref.t")).alias("order_type")))
    # trades without a taker id cannot be looked up; they carry no type
    untyped = tr.where(F.col("taker_order_id").isNull()).drop("epoch").withColumn(
        "order_type", F.lit(None).cast("string"))
    return typed.unionByName(untyped)


def book_as_of(states: DataFrame, points: DataFrame) -> DataFrame:
    """The orders resting at given points of a book's history (S10/N5 fixtures: what a
    REST snapshot taken at that sequence would hold).

    ``states`` of one venue; ``points``: (symbol, point, seq) -- a point sees every change with sequence <= seq.
    Each live row of ``states`` holds its state over [its sequence, the order's next
    sequence); a point inside that interval sees the order (unless the row removed it).
    A running count of points per symbol turns each interval into the range of points it
    covers, which is then expanded: the work is the output size, with no pairing of
    orders and points beyond the rows returned.
    Returns (point, symbol, seq, order_id, side, price, size)."""
    iv, ordinals = _intervals(states, points)
    covered = iv.withColumn("k", F.explode(F.sequence(F.col("cs") + 1, F.col("ce"))))
    return (covered.join(ordinals, ["symbol", "k"])
            .select("point", "symbol", "seq", "order_id", "side", "price", "size"))


#: Neighbouring points whose books are made from one list of intervals.
POINTS = 64


def books_as_of(states: DataFrame, points: DataFrame) -> DataFrame:
    """The books of ``book_as_of``, one row per point: (point, symbol, seq, bids, asks), a side
    being its orders as [price, size, order id] in text, best first, ties by id; null where the
    point sees none.

    The intervals that reach into a run of POINTS points meet in one group, sorted once, and each
    point picks its own from them.  So what is shuffled is a POINTS-th of the rows returned, and
    a task holds one symbol's book, as the record of a point does."""
    iv, ordinals = _intervals(states, points)
    run = lambda k: F.floor(k / POINTS).cast("long")
    orders = iv.select("symbol", F.explode(F.sequence(run(F.col("cs")), run(F.col("ce") - 1))).alias("run"), "side",
                       F.struct("price", "order_id", F.array(F.col("price").cast("string"), F.col("size").cast("string"),
                                                             F.col("order_id")).alias("e"), "cs", "ce").alias("x"))
    at = ordinals.select("symbol", run(F.col("k") - 1).alias("run"), F.struct("k", "point", "seq").alias("p"))
    groups = max(1, at.select("symbol", "run").distinct().count())
    # a partition holds few groups, as its lists are in memory together
    met = orders.unionByName(at, allowMissingColumns=True).repartition(groups, "symbol", "run")

    def listed(side: str) -> Column:
        x = F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("x"))), asc=side == "ask")
        return F.transform(x, lambda o: F.struct(o["cs"].alias("cs"), o["ce"].alias("ce"), o["e"].alias("e")))

    met = (met.groupBy("symbol", "run").agg(listed("bid").alias("bids"), listed("ask").alias("asks"),
                                            F.collect_list("p").alias("p"))
           .select("symbol", "bids", "asks", F.explode("p").alias("p")))

    def seen(side: str) -> Column:
        k = F.col("p.k")
        return F.transform(F.filter(side, lambda o: (o["cs"] < k) & (o["ce"] >= k)), lambda o: o["e"])

    return met.select("p.point", "symbol", "p.seq", seen("bids").alias("bids"), seen("asks").alias("asks"))


def _intervals(states: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(symbol, order_id, side, price, size, cs, ce): the states of orders, each seen by its
    symbol's points cs + 1 to ce in order of sequence; and (symbol, point, k, seq): the points with their numbers."""
    live = states.where(F.col("live")).select(
        "symbol", "order_id", "arrival", "sub", F.col("sequence").alias("seq"), "side",
        "price", F.col("new_size").alias("size"), "fin")
    live = running(live.withColumn("_neg", -F.col("arrival")).withColumn("_nsub", -F.col("sub")),
                   ["symbol", "order_id"], ["_neg", "_nsub"],
                   [Running("_next", F.struct(F.col("seq").alias("s")), "last", exclusive=True)])
    iv = live.where(~F.col("fin")).select(
        "symbol", "order_id", "arrival", "side", "price", "size",
        F.col("seq").alias("start"), F.col("_next.s").alias("end"))
    ends = iv.select("symbol", F.struct("order_id", "arrival").alias("iid"),
                     F.explode(F.array(
                         F.struct(F.lit("s").alias("w"), F.col("start").alias("seq")),
                         F.struct(F.lit("e").alias("w"), F.col("end").alias("seq")))).alias("b")
                     ).where(F.col("b.seq").isNotNull())
    ends = ends.select("symbol", "iid", "b.w", "b.seq", F.lit(0).alias("kind"),
                       F.lit(None).cast(points.schema["point"].dataType).alias("point"))
    pts = points.select("symbol", F.lit(None).cast("struct<order_id:string,arrival:long>").alias("iid"),
                        F.lit(None).cast("string").alias("w"), "seq", F.lit(1).alias("kind"), "point")
    # boundaries sort before points at an equal sequence: c(x) = #points with seq < x
    c = running(ends.unionByName(pts), ["symbol"], ["seq", "kind"],
                [Running("c", F.col("kind").cast("long"), "sum")])
    ordinals = c.where(F.col("kind") == 1).select("symbol", "point", F.col("c").alias("k"), "seq")
    span = (c.where(F.col("kind") == 0).groupBy("symbol", "iid")
            .agg(F.max(F.when(F.col("w") == "s", F.col("c"))).alias("cs"),
                 F.max(F.when(F.col("w") == "e", F.col("c"))).alias("ce")))
    # an interval that nothing ends reaches every later point of its symbol
    total = points.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    span = span.join(total, "symbol").withColumn("ce", F.coalesce("ce", "n"))
    attrs = iv.select("symbol", F.struct("order_id", "arrival").alias("iid"), "order_id",
                      "side", "price", "size")
    return (span.where(F.col("ce") > F.col("cs")).join(attrs, ["symbol", "iid"])
            .select("symbol", "order_id", "side", "price", "size", "cs", "ce"), ordinals)


def build_l3(msgs_with_epoch: DataFrame, chunk_rows: int | None = None) -> dict[str, DataFrame]:
    rows = l3_rows(msgs_with_epoch)
    states = l3_states(rows, chunk_rows)
    book = l3_book(states, msgs_with_epoch.select(*BOOK, "epoch"))
    return {"rows": rows, "states": states, "deltas": l3_deltas(states), "book": book,
            "levels": l3_levels(book)}
