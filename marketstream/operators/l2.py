"""Level-2 book: N3, N4, N11, A1, W3, ST5 in batch form (A.2).

A ``snapshot`` replaces both sides of a symbol's book (a repeated price keeps the last,
zero amounts are kept); an ``l2update`` applies its changes in order: amount 0 removes the
level if present, > 0 upserts, < 0 is ignored.  Each update emits the changed levels as
its delta; the snapshot emits none.

Batch form over level rows (one per level change)::

    epoch = running count of snapshot messages                  (per symbol)
    was   = previous row of the same (symbol, side, price) in the same epoch was present
    delta = update row and (amount > 0 or was)
    book  = last row per (symbol, side, price) in the symbol's latest epoch,
            kept if it came from a snapshot or its amount > 0
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.functions import dec, l2_side, to_ns, event_ts_ns
from marketstream.operators.scan import Running, plain

BOOK = ["exchange", "symbol"]     # one book per venue and symbol


def l2_messages(parsed: DataFrame, chunk_rows: int | None = None, scan=plain) -> DataFrame:
    """Level-2 messages with their book's epoch (an empty snapshot still counts).  ``scan``
    may go on from an earlier state of the scan ``l2_epoch``."""
    msgs = (parsed.where((F.col("route") == "l2") & F.col("symbol").isNotNull())
            .select("arrival", *BOOK, "type", "time", "receipt_time", "bids", "asks", "changes"))
    snap = F.col("type") == "snapshot"
    return scan("l2_epoch", msgs.withColumn("snap", snap), BOOK, ["arrival"],
                [Running("epoch", snap.cast("long"), "sum")], chunk_rows)


def l2_level_rows(msgs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per level change: (arrival, pos, exchange, symbol, epoch, snap, side, price, amount,
    ts, receipt_ts, bad) and the message columns of ``keep``.  Snapshot positions run over the
    bids, then the asks."""
    lvl = "struct<side:string,price:string,amount:string>"
    bids = F.transform(F.coalesce("bids", F.array()), lambda x: F.struct(
        F.lit("bid").alias("side"), F.get(x, 0).alias("price"), F.get(x, 1).alias("amount")))
    asks = F.transform(F.coalesce("asks", F.array()), lambda x: F.struct(
        F.lit("ask").alias("side"), F.get(x, 0).alias("price"), F.get(x, 1).alias("amount")))
    changes = F.transform(F.coalesce("changes", F.array()), lambda x: F.struct(
        l2_side(F.get(x, 0)).alias("side"), F.get(x, 1).alias("price"), F.get(x, 2).alias("amount")))
    levels = F.when(F.col("snap"), F.concat(bids.cast(f"array<{lvl}>"), asks.cast(f"array<{lvl}>"))) \
        .otherwise(changes.cast(f"array<{lvl}>"))
    rows = msgs.select("arrival", *BOOK, "epoch", "snap", "time", "receipt_time", *keep,
                       F.posexplode(levels).alias("pos", "lv"))
    price, amount = dec("lv.price"), dec("lv.amount")
    return rows.select(
        "arrival", "pos", *BOOK, "epoch", "snap", F.col("lv.side").alias("side"),
        price.alias("price"), amount.alias("amount"),
        F.when(~F.col("snap"), event_ts_ns("time", "receipt_time")).alias("ts"),
        to_ns("receipt_time").alias("receipt_ts"),
        # also entries that are too short or null
        (F.col("lv.side").isNull() | price.isNull() | amount.isNull()).alias("bad"), *keep)


def l2_kept(levels: DataFrame) -> DataFrame:
    """Rows the book applies: after a snapshot, parsable, amount >= 0."""
    return levels.where(~F.col("bad") & (F.col("epoch") > 0) & (F.col("amount") >= 0))


def l2_rejects(levels: DataFrame) -> DataFrame:
    """Quarantine: updates before any snapshot (D6), unparsable numbers.
    Negative amounts are ignored by the venue handler and not reported."""
    reason = (F.when(F.col("bad"), "bad_number")
              .when(F.col("epoch") == 0, "update_before_snapshot"))
    return (levels.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select("arrival", "pos", *BOOK, "reason"))


def l2_deltas(kept: DataFrame, chunk_rows: int | None = None, scan=plain) -> DataFrame:
    """The changed levels of every update: (arrival, pos, symbol, side, price,
    amount, ts); amount 0 is a removal.  ``was`` is a lag over the level, computed with
    the chunked scan (``l2_levels``) so a hot price level is never one task.  Its state is
    the level's last row: epoch, whether it left the level on the book, and the amount."""
    present = F.col("snap") | (F.col("amount") > 0)
    w = scan("l2_levels", kept, [*BOOK, "side", "price"], ["arrival", "pos"], [
        Running("_prev", F.struct(F.col("epoch").alias("e"), present.alias("p"),
                                  F.col("amount").alias("a")), "last", exclusive=True)], chunk_rows)
    was = F.coalesce((F.col("_prev.e") == F.col("epoch")) & F.col("_prev.p"), F.lit(False))
    return (w.where(~F.col("snap") & ((F.col("amount") > 0) | was))
            .select("arrival", "pos", *BOOK, "side", "price", "amount", "ts"))


def _latest_epoch(msgs: DataFrame) -> DataFrame:
    return msgs.groupBy(*BOOK).agg(F.max("epoch").alias("_top"))


def l2_book(kept: DataFrame, msgs: DataFrame) -> DataFrame:
    """A1/ST5 final book: (exchange, symbol, side, price, amount).  ``max_by`` per level is a
    partial (map-side) aggregation, so a hot level or symbol costs one row per task."""
    last = (kept.groupBy(*BOOK, "side", "price")
            .agg(F.max_by(F.struct("epoch", "snap", "amount"),
                          F.struct("arrival", "pos")).alias("l"))
            .select(*BOOK, "side", "price", "l.*"))
    return (last.join(_latest_epoch(msgs), BOOK)
            .where((F.col("epoch") == F.col("_top")) & (F.col("snap") | (F.col("amount") > 0)))
            .select(*BOOK, "side", "price", "amount"))


def last_change(msgs: DataFrame) -> DataFrame:
    """(exchange, symbol, ts, receipt_ts) of each book's last level-2 message (P5 fallback for
    snapshots, which carry no time)."""
    ts = event_ts_ns("time", "receipt_time")
    return (msgs.groupBy(*BOOK)
            .agg(F.max_by(F.struct(ts.alias("ts"), to_ns("receipt_time").alias("receipt_ts")),
                          F.col("arrival")).alias("l"))
            .select(*BOOK, "l.*"))


class _OnDemand(dict):
    """Outputs that are built when they are first asked for: a book needs no delta scan."""

    def __missing__(self, name: str) -> DataFrame:
        make = self["_make"].get(name)
        if make is None:
            raise KeyError(name)
        self[name] = make()
        return self[name]


def build_l2(parsed: DataFrame, chunk_rows: int | None = None) -> dict[str, DataFrame]:
    """messages, levels, kept, deltas, book and rejects, each built on demand."""
    msgs = l2_messages(parsed, chunk_rows)
    levels = l2_level_rows(msgs)
    kept = l2_kept(levels)
    return _OnDemand(messages=msgs, levels=levels, kept=kept, _make={
        "deltas": lambda: l2_deltas(kept, chunk_rows), "book": lambda: l2_book(kept, msgs),
        "rejects": lambda: l2_rejects(levels)})
