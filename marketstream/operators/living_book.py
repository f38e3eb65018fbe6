"""The level-2 book at every message: S7, P4, N11, O3.

The venue handler emits the book after each message it applies, capped at a depth, and the
changed levels beside it.  Copying a book per message would cost messages x levels, and one
pass per book would put a hot book in one task.  Here:

* the messages of a book are numbered by the level changes before them and cut into chunks of
  at most ``chunk_rows`` changes, so a chunk never holds more however dense the feed is;
* a level's state lives from the message that sets it to the next one that changes it, or to
  the book's next snapshot; it is handed to each chunk that starts inside this lifetime, and
  so every chunk starts with the book as it stands there.  Of each side only the best
  ``depth`` levels and as many as a chunk can remove are handed over;
* within a chunk the rows come sorted; each side keeps its prices in order and each message
  yields the best ``depth`` of both.

What is handed over grows with chunks x levels that rest at their starts, so a chunk should
hold at least as many changes as the book has levels.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream.functions import event_ts_ns, number_text, to_ns
from marketstream.operators.l2 import BOOK, l2_deltas, l2_kept, l2_level_rows
from marketstream.operators.scan import Running, running
from marketstream.schemas import DEC
from marketstream.session import CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS, conf_int

_LEVELS = "array<struct<price:decimal(38,18),size:decimal(38,18)>>"
_RECORDS = (f"exchange string, symbol string, arrival long, ts long, receipt_ts long, "
            f"bid {_LEVELS}, ask {_LEVELS}")
_LAST = (1 << 31) - 1     # the place of a message's end mark, after all its changes


def _changes() -> Column:
    """How many level changes a message holds."""
    return sum((F.coalesce(F.array_size(c), F.lit(0)) for c in ("bids", "asks", "changes")), F.lit(0))


def book_messages(parsed: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Level-2 messages with their book's epoch, whether they are snapshots, and ``chunk``:
    the level changes of the book before the message, by ``chunk_rows``."""
    rows = chunk_rows or conf_int(parsed.sparkSession, CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS)
    msgs = (parsed.where((F.col("route") == "l2") & F.col("symbol").isNotNull())
            .select("arrival", *BOOK, "type", "time", "receipt_time", "bids", "asks", "changes")
            .withColumn("snap", F.col("type") == "snapshot"))
    out = running(msgs, BOOK, ["arrival"], [
        Running("epoch", F.col("snap").cast("long"), "sum"),
        Running("_before", (_changes() + 1).cast("long"), "sum", exclusive=True)], chunk_rows)
    return (out.withColumn("chunk", F.floor(F.coalesce("_before", F.lit(0)) / F.lit(rows)).cast("long"))
            .drop("_before"))


# ---------------------------------------------------------------- what a message changed
def message_deltas(msgs: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """For every message after the book's first snapshot (exchange, symbol, arrival, ts,
    receipt_ts, snap) the changed levels of both sides as arrays of (price, size) in the
    message's order.  An update that changed nothing has empty arrays, a snapshot none."""
    marks = msgs.where(F.col("epoch") > 0).select(
        "arrival", *BOOK, F.struct(event_ts_ns("time", "receipt_time").alias("ts"),
                                   to_ns("receipt_time").alias("receipt_ts"), "snap").alias("m"),
        F.lit(None).cast("struct<pos:int,side:string,price:decimal(38,18),size:decimal(38,18)>").alias("c"))
    deltas = l2_deltas(l2_kept(l2_level_rows(msgs)), chunk_rows).select(
        "arrival", *BOOK, F.lit(None).cast(marks.schema["m"].dataType).alias("m"),
        F.struct("pos", "side", "price", F.col("amount").alias("size")).alias("c"))
    # a group is one message
    both = marks.unionByName(deltas).groupBy(*BOOK, "arrival").agg(
        F.max("m").alias("m"), F.sort_array(F.collect_list("c")).alias("c"))

    def side(name: str) -> Column:
        picked = F.transform(F.filter("c", lambda x: x["side"] == name),
                             lambda x: F.struct(x["price"], x["size"]))
        return F.when(~F.col("m.snap"), picked).alias(name)

    return both.select(*BOOK, "arrival", "m.*", side("bid"), side("ask"))


# ---------------------------------------------------------------- the book at every message
def _handed_over(kept: DataFrame, msgs: DataFrame, most: int, chunk_rows: int | None) -> DataFrame:
    """(exchange, symbol, chunk, side, price, amount): the levels that rest where a chunk
    starts, the best ``most`` of each side."""
    here = F.struct("epoch", "chunk")
    lives = running(
        kept.withColumn("_na", -F.col("arrival")).withColumn("_np", -F.col("pos")),
        [*BOOK, "side", "price"], ["_na", "_np"],
        [Running("_next", here, "last", exclusive=True)], chunk_rows)
    lives = lives.where(F.col("snap") | (F.col("amount") > 0)).select(
        *BOOK, "epoch", "side", "price", "amount", "chunk",
        F.when(F.col("_next.epoch") == F.col("epoch"), F.col("_next.chunk")).alias("_to"))
    # what nothing changes any more rests until the next snapshot, or the book's last chunk
    starts = (msgs.where("snap").select(*BOOK, "arrival", "epoch", "chunk")
              .withColumn("_na", -F.col("arrival")))
    starts = running(starts, BOOK, ["_na"], [Running("_until", F.col("chunk"), "last", exclusive=True)],
                     chunk_rows).select(*BOOK, "epoch", "_until")
    top = msgs.groupBy(*BOOK).agg(F.max("chunk").alias("_top"))
    open_ = (lives.where(F.col("_to").isNull()).drop("_to").join(starts, [*BOOK, "epoch"], "left")
             .join(top, BOOK).withColumn("_to", F.coalesce("_until", "_top")))
    cols = [*BOOK, "side", "price", "amount", "chunk", "_to"]
    spans = lives.where(F.col("_to").isNotNull()).select(cols).unionByName(open_.select(cols))
    held = (spans.where(F.col("_to") > F.col("chunk"))
            .select(*BOOK, "side", "price", "amount",
                    F.explode(F.sequence(F.col("chunk") + 1, F.col("_to"))).alias("chunk")))
    best = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy(*BOOK, "chunk", "side").orderBy(best)
    return held.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


class _Side:
    """One side of a book, best first: its prices as whole numbers (bids below zero) and the
    place of each level's row."""

    def __init__(self):
        self.prices: list[int] = []
        self.at: list[int] = []

    def put(self, price: int, at: int) -> None:
        i = bisect_left(self.prices, price)
        if i < len(self.prices) and self.prices[i] == price:
            self.at[i] = at
        else:
            self.prices.insert(i, price)
            self.at.insert(i, at)

    def drop(self, price: int) -> None:
        i = bisect_left(self.prices, price)
        if i < len(self.prices) and self.prices[i] == price:
            del self.prices[i], self.at[i]


#: What a row of a chunk does to the book.
_MARK, _SNAPSHOT, _PUT_BID, _PUT_ASK, _DROP_BID, _DROP_ASK = range(6)


def _deeds(b: pa.RecordBatch) -> np.ndarray:
    def flags(c) -> np.ndarray:
        return pc.fill_null(c, False).to_numpy(zero_copy_only=False)

    puts = (flags(pc.is_null(b.column("arrival"))) | flags(b.column("snap"))
            | flags(pc.greater(b.column("amount"), pa.scalar(0, b.column("amount").type))))
    out = np.where(puts, _PUT_BID, _DROP_BID) + flags(pc.equal(b.column("side"), "ask"))
    out[flags(pc.is_null(b.column("side")))] = _SNAPSHOT
    out[flags(pc.equal(b.column("pos"), _LAST))] = _MARK
    return out


def _begins(b: pa.RecordBatch, key: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which rows are the first of a chunk, after a batch that ended in ``key``; the last key."""
    cols = [b.column(c) for c in (*BOOK, "chunk")]
    out = np.zeros(b.num_rows, dtype=bool)
    for c in cols:
        out[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    out[0] = tuple(c[0].as_py() for c in cols) != key
    return out, tuple(c[-1].as_py() for c in cols)


def _each(depth: int | None):
    """Sorted rows of chunks -> one record per message.  Levels are places of rows; their prices
    and sizes are taken from the columns, many records at once."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_RECORDS))
    levels = schema.field("bid").type
    head = [*BOOK, "arrival", "ts", "receipt_ts"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bid, ask, key = _Side(), _Side(), None
        none = pa.array([], levels.value_type.field("price").type)
        held = (none, none)           # prices and sizes of the book's levels, bids first
        for b in batches:
            if not b.num_rows:
                continue
            columns = [pa.concat_arrays([h, b.column(c)]) for h, c in zip(held, ("price", "amount"))]
            bid.at = list(range(len(bid.at)))
            ask.at = list(range(len(bid.at), len(bid.at) + len(ask.at)))
            first = len(held[0])
            raw = memoryview(columns[0].buffers()[1]).cast("B")[16 * (columns[0].offset + first):]
            begins, key = _begins(b, key)
            rows: list[int] = []
            places: tuple[list, list] = ([], [])
            ends: tuple[list, list] = ([0], [0])

            def records() -> pa.RecordBatch:
                parts = [b.column(c).take(pa.array(rows, pa.int32())) for c in head]
                for at, end in zip(places, ends):
                    at = pa.array(at, pa.int32())
                    pairs = pa.StructArray.from_arrays([c.take(at) for c in columns],
                                                       fields=list(levels.value_type))
                    parts.append(pa.ListArray.from_arrays(pa.array(end, pa.int32()), pairs, type=levels))
                return pa.RecordBatch.from_arrays(parts, schema=schema)

            for i, (deed, begin) in enumerate(zip(_deeds(b).tolist(), begins.tolist())):
                if begin or deed == _SNAPSHOT:
                    bid, ask = _Side(), _Side()
                if deed == _MARK:
                    rows.append(i)
                    for side, at, end in zip((bid, ask), places, ends):
                        at += side.at[:depth]
                        end.append(len(at))
                    if len(rows) >= 4096:
                        yield records()
                        rows, places, ends = [], ([], []), ([0], [0])
                elif deed != _SNAPSHOT:
                    price = int.from_bytes(raw[16 * i:16 * i + 16], "little", signed=True)
                    if deed == _PUT_BID:
                        bid.put(-price, first + i)
                    elif deed == _PUT_ASK:
                        ask.put(price, first + i)
                    elif deed == _DROP_BID:
                        bid.drop(-price)
                    else:
                        ask.drop(price)
            if rows:
                yield records()
            at = pa.array(bid.at + ask.at, pa.int32())
            held = tuple(c.take(at) for c in columns)

    return run


def records_each(msgs: DataFrame, depth: int | None = 10, chunk_rows: int | None = None) -> DataFrame:
    """The book after every message from its first snapshot on: (exchange, symbol,
    arrival, ts, receipt_ts, bid, ask), each side an array of (price, size), best first, of at
    most ``depth`` levels (None: all).  ``msgs`` as ``book_messages`` gives them.

    A message without a usable change still yields the book; a snapshot without levels an
    empty one.  Messages before the first snapshot yield nothing (they are quarantined)."""
    rows = chunk_rows or conf_int(msgs.sparkSession, CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS)
    msgs = msgs.where(F.col("epoch") > 0)
    kept = l2_kept(l2_level_rows(msgs, keep=("chunk",)))
    none = F.lit(None)
    most = (1 << 31) - 1
    if depth is not None:       # a chunk may go over its bound by its last message
        longest = msgs.agg(F.max(_changes()).alias("n")).first()["n"] or 0
        most = depth + rows + longest
    carried = _handed_over(kept, msgs, most, chunk_rows).select(
        *BOOK, "chunk", none.cast("long").alias("arrival"), F.lit(0).alias("pos"), "side", "price",
        "amount", F.lit(False).alias("snap"), none.cast("long").alias("ts"),
        none.cast("long").alias("receipt_ts"))
    changes = kept.select(*BOOK, "chunk", "arrival", "pos", "side", "price", "amount", "snap",
                          none.cast("long").alias("ts"), none.cast("long").alias("receipt_ts"))

    def marks(pos: int, which: DataFrame) -> DataFrame:
        return which.select(
            *BOOK, "chunk", "arrival", F.lit(pos).alias("pos"), none.cast("string").alias("side"),
            none.cast(DEC).alias("price"), none.cast(DEC).alias("amount"), "snap",
            event_ts_ns("time", "receipt_time").alias("ts"), to_ns("receipt_time").alias("receipt_ts"))

    dealt = (carried.unionByName(changes).unionByName(marks(-1, msgs.where("snap")))
             .unionByName(marks(_LAST, msgs)).repartition(*BOOK, "chunk")
             .sortWithinPartitions(*BOOK, "chunk", F.col("arrival").asc_nulls_first(), "pos"))
    return dealt.mapInArrow(_each(depth), _RECORDS)


def records_json(records: DataFrame) -> DataFrame:
    """(arrival, key, value): the book topic's JSON with both sides as price -> size in
    best-first order; prices are text keys, sizes numbers."""

    def levels(side: str) -> Column:
        return F.map_from_entries(F.transform(side, lambda x: F.struct(
            number_text(x["price"]), x["size"].cast(T.DoubleType())))).alias(side)

    value = F.to_json(F.struct("exchange", "symbol", "ts", "receipt_ts", levels("bid"), levels("ask")))
    return records.select("arrival", F.col("symbol").alias("key"), value.alias("value"))


def deltas_json(deltas: DataFrame) -> DataFrame:
    """(arrival, symbol, ts, delta): the delta of each update as JSON, both sides as lists of
    [price, size] (size 0: removed); null for a snapshot."""

    def levels(side: str) -> Column:
        return F.transform(side, lambda x: F.array(x["price"].cast(T.DoubleType()),
                                                   x["size"].cast(T.DoubleType()))).alias(side)

    both = F.to_json(F.struct(levels("bid"), levels("ask")))
    return deltas.select("arrival", "symbol", "ts", F.when(~F.col("snap"), both).alias("delta"))
