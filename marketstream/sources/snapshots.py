"""Landed level-3 snapshots as a source of their own (S10, N5): merged into the message feed
by sequence.

A snapshot holds the book of one symbol as of its sequence, and may be landed late, more than
once, or out of order.  It belongs before the first message of its symbol that goes beyond its
sequence; where it was landed does not matter.  That place is an as-of lookup: over the rows of
a symbol from the highest sequence down, the least arrival so far -- a running aggregate, so a
symbol with a third of all messages is cut into chunks like any hot key, and no snapshot meets
a message it is not placed at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.operators.l3 import BOOK, FIELDS, LISTS
from marketstream.operators.scan import Running, running

#: Places between two arrivals: snapshots stand in the lower one.
STEP = 2


def merged(messages: DataFrame, snapshots: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Parsed ``messages`` and parsed ``snapshots`` (their own arrival is not read) as one
    feed, ``arrival`` being STEP times the message's, and one less for the snapshots before it.

    Of snapshots with one sequence one stays; of several before the same message the one with
    the highest sequence.  A snapshot that no message goes beyond comes after all messages of
    its symbol.  Snapshots without a symbol or sequence are left out, as no message follows
    them in order.  Both may come without the lists of entries; see ``lists_of``."""
    fields = [c for c in FIELDS if c not in LISTS or c in snapshots.columns]
    msgs = messages.select(*fields)
    snaps = (snapshots.where(F.col("symbol").isNotNull() & F.col("sequence").isNotNull())
             .select(*fields).dropDuplicates([*BOOK, "sequence"]))
    # from the highest sequence down; a snapshot before the messages of its own sequence
    rows = (msgs.where(F.col("symbol").isNotNull() & F.col("sequence").isNotNull())
            .select(*BOOK, "sequence", "arrival", F.lit(1).alias("_kind"))
            .unionByName(snaps.select(*BOOK, "sequence", F.lit(None).cast("long").alias("arrival"),
                                      F.lit(0).alias("_kind")))
            .withColumn("_down", -F.col("sequence")))
    placed = running(rows, BOOK, ["_down", "_kind"],
                     [Running("_first", -F.col("arrival"), "max", exclusive=True)], chunk_rows)
    end = msgs.groupBy(*BOOK).agg(F.max("arrival").alias("_end"))
    at = (placed.where(F.col("_kind") == 0)
          .groupBy(*BOOK, "_first").agg(F.max("sequence").alias("sequence"))
          .join(end, BOOK, "left")
          .select(*BOOK, "sequence", F.coalesce(-F.col("_first") * STEP - 1,
                                                F.col("_end") * STEP + 1, F.lit(0)).alias("_at")))
    # one row per snapshot kept
    kept = (snaps.drop("arrival").join(at, [*BOOK, "sequence"])
            .withColumn("arrival", F.col("_at").cast("long")).select(*fields))
    return msgs.withColumn("arrival", F.col("arrival") * STEP).unionByName(kept)


def lists_of(placed: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The lists of the snapshots ``placed`` by ``merged``, which they went through without, from
    the landed ``snapshots``: (arrival, exchange, symbol, bids, asks)."""
    key = [*BOOK, "sequence"]
    return (snapshots.select(*key, *LISTS).join(placed.select("arrival", *key), key)
            .dropDuplicates(["arrival", *key]))
