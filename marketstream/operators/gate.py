"""ST2-ST4, ST8, W1: the per-symbol sequence gate, as running aggregates (A.1).

With a full-channel (L3) subscription the venue handler accepts a message carrying
product_id and sequence only if its sequence is exactly one past the last accepted one
for that symbol; a lower or equal sequence is dropped as stale, a higher one is a gap:
the symbol resets and nothing is accepted until its next snapshot.  Before the first
snapshot (or after one with sequence 0) nothing is accepted.

Batch form (snapshot rows open a new epoch per symbol)::

    epoch   = running count of snapshots                      (per symbol)
    last    = max(seq) of earlier rows in the epoch
    gap     = not snapshot and seq > last + 1
    lost    = an earlier row of the epoch was a gap (or the epoch's snapshot had seq 0)
    verdict = snapshot | unsynced (epoch 0 or lost) | stale (seq <= last) | gap | ok
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.operators.scan import Running, plain

VERDICTS = ["ok", "stale", "gap", "unsynced", "snapshot"]


def gated_rows(parsed: DataFrame) -> DataFrame:
    """The messages the gate sees: they carry product_id and sequence, or are L3
    snapshots.  Everything else (level-2, untyped-without-sequence...) bypasses it."""
    return parsed.where(_gated()).withColumn("snap", F.col("route") == "l3snapshot").drop("value")


def _gated():
    known = (F.col("route") != "l2") & F.col("symbol").isNotNull()
    return F.coalesce(known & (F.col("sequence").isNotNull() | (F.col("route") == "l3snapshot")),
                      F.lit(False))


def sequence_gate(parsed: DataFrame, chunk_rows: int | None = None, scan=plain) -> DataFrame:
    """Adds epoch, last, verdict to the gated rows; keeps every input column but the raw
    text, which goes through no shuffle.  Each venue's symbol has a gate of its own.
    ``scan`` may go on from an earlier state of the scans ``gate`` and ``gate_lost``."""
    g = gated_rows(parsed)
    snap = F.col("snap")
    seq = F.col("sequence")
    g = scan("gate", g, ["exchange", "symbol"], ["arrival"], [
        Running("epoch", snap.cast("long"), "sum"),
        Running("last", seq, "max", reset=snap, exclusive=True),
    ], chunk_rows, keep_chunk=True)
    gap = ~snap & (seq > F.col("last") + 1)
    lost_here = gap | (snap & (F.coalesce(seq, F.lit(0)) == 0))
    g = scan("gate_lost", g.withColumn("gap", gap), ["exchange", "symbol"], ["arrival"], [
        Running("lost", lost_here.cast("int"), "max", reset=snap, exclusive=True),
    ], chunk_rows)
    verdict = (F.when(snap, "snapshot")
               .when((F.col("epoch") == 0) | (F.coalesce(F.col("lost"), F.lit(0)) == 1), "unsynced")
               .when(seq <= F.col("last"), "stale")
               .when(F.col("gap"), "gap")
               .otherwise("ok"))
    return g.withColumn("verdict", verdict).drop("lost")


def gaps(verdicts: DataFrame) -> DataFrame:
    """ST3 side output: (arrival, symbol, received, expected) per detected gap."""
    return (verdicts.where(F.col("verdict") == "gap")
            .select("arrival", "symbol", F.col("sequence").alias("received"),
                    (F.col("last") + 1).alias("expected")))


def accepted(verdicts: DataFrame) -> DataFrame:
    """Gated rows that reach the handlers: ok messages and the snapshots."""
    return verdicts.where(F.col("verdict").isin("ok", "snapshot"))


def gate_and_route(parsed: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Every row that reaches a handler: what the gate accepts, and what bypasses it --
    level-2 messages and messages without a symbol or sequence (verdict ``bypass``)."""
    passed = accepted(sequence_gate(parsed, chunk_rows))
    bypass = (parsed.where(~_gated()).drop("value")
              .withColumn("verdict", F.lit("bypass")))
    return passed.unionByName(bypass, allowMissingColumns=True)
