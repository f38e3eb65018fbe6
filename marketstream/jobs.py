"""Deployable jobs (thin): each wires a source, the operators and the sinks, then runs
until stopped (ST11) -- or drains what is there with ``--available-now``.

    python -m marketstream.jobs trades_to_table --source kafka --bootstrap B --table-path P --checkpoint C
    python -m marketstream.jobs venue_to_topics --source files --input RAW --out OUT --checkpoint C
    python -m marketstream.jobs books_to_table  --source landed --input RAW --out OUT --checkpoint C --gate

``landed`` is a feed that ``streaming.source.land`` wrote: micro-batches of ``--max-per-trigger``
rows in arrival order.  ``files`` are plain Parquet files, in no order (enough where messages do
not depend on each other).

Paths must be on shared storage; the checkpoint is the restart point (S15).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.operators.normalize import bad_numbers, unparsable
from marketstream.operators.normalize import trades as normalise_trades
from marketstream.operators.parse import INVALID_ROUTES, invalid_messages, parse_messages
from marketstream.schemas import RAW_FEED
from marketstream.streaming.consumer import (decode_trades, dedupe_trades, read_topic,
                                             start_trades_stream, start_trades_with_rejects)
from marketstream.streaming.sinks import (BOOK_TOPIC, TRADE_TOPIC, fan_out, kafka_options,
                                          trade_records, write_records)
from marketstream.streaming.live import LiveBooks, drain
from marketstream.streaming.source import read_landed


def raw_stream(spark: SparkSession, a) -> DataFrame:
    """The raw venue topic as (arrival, receipt_time, value).  Kafka: (partition, offset,
    receipt_time, value), receipt time being the broker timestamp, and the offset as arrival,
    which orders one partition; landed feeds and files already carry their columns."""
    if a.source == "kafka":
        r = (spark.readStream.format("kafka").options(**kafka_options(a.bootstrap, a.user, a.password))
             .option("subscribe", a.topic).option("startingOffsets", "earliest")
             .option("maxOffsetsPerTrigger", a.max_per_trigger).load())
        return r.select("partition", "offset", F.col("offset").alias("arrival"),
                        F.col("timestamp").alias("receipt_time"),
                        F.col("value").cast("string").alias("value"))
    if a.source == "landed":
        return read_landed(spark, a.input, f"{a.checkpoint}-progress", a.max_per_trigger)
    return (spark.readStream.schema(RAW_FEED).option("maxFilesPerTrigger", a.max_files)
            .parquet(a.input))


def _start(writer, a):
    writer = writer.option("checkpointLocation", a.checkpoint)
    if not a.available_now:
        return writer.trigger(processingTime=a.trigger).start()
    if a.source == "landed":               # drained by main()
        return writer.trigger(processingTime="0 seconds").start()
    return writer.trigger(availableNow=True).start()


def trades_to_table(spark: SparkSession, a):
    """Trade topic -> 9-column trades table and, beside it, a quarantine of the records that
    are no trade (both idempotent per micro-batch).  Landed topics are text, or
    (``--format parquet``) what ``venue_to_topics`` writes.  With ``--dedupe`` the decoded
    trades alone are streamed, without the quarantine."""
    opts = kafka_options(a.bootstrap, a.user, a.password) if a.source == "kafka" else {}
    fmt = "kafka" if a.source == "kafka" else a.format
    records = read_topic(spark, opts, topic=a.topic or TRADE_TOPIC, fmt=fmt, path=a.input,
                         max_per_trigger=a.max_per_trigger, max_files=a.max_files)
    if not a.dedupe:
        return start_trades_with_rejects(records, a.table_path, f"{a.table_path}-quarantine",
                                         a.checkpoint, a.trigger, a.available_now)
    decoded = dedupe_trades(decode_trades(records), a.dedupe_delay)
    return start_trades_stream(decoded, a.table_path, a.checkpoint,
                               processing_time=a.trigger, available_now=a.available_now)


#: What the trade topic and the quarantine read of a message, besides its text.
VENUE_FIELDS = ["arrival", "receipt_time", "exchange", "symbol", "route", "type", "sequence", "time",
                "side", "price", "size", "best_bid", "best_ask", "trade_id", "maker_order_id",
                "taker_order_id"]


def venue_to_topics(spark: SparkSession, a):
    """Raw venue messages -> trade topic (Kafka, or files) + quarantine of unusable messages
    and unparsable numbers, written by one foreachBatch that computes each micro-batch
    once (S6, S8, S14).  What both sinks read is kept in memory meanwhile, so it is narrow: the
    text stays with the messages that go to the quarantine only."""
    rejected = F.col("route").isin(*INVALID_ROUTES) | unparsable()
    parsed = (parse_messages(raw_stream(spark, a)).select(*VENUE_FIELDS, "value")
              .withColumn("value", F.when(rejected, F.col("value"))))

    def sink(batch: DataFrame, batch_id: int):
        def trades(df, bid):
            recs = trade_records(normalise_trades(df))
            if a.source == "kafka":            # at least once: a replayed batch is sent again
                write_records(recs, a.sink_topic, options=kafka_options(a.bootstrap, a.user,
                                                                        a.password))
            else:
                recs.write.mode("overwrite").parquet(f"{a.out}/{TRADE_TOPIC}/batch_id={bid}")

        def quarantine(df, bid):
            (invalid_messages(df).unionByName(bad_numbers(df))
             .write.mode("overwrite").parquet(f"{a.out}/quarantine/batch_id={bid}"))

        fan_out(batch, batch_id, [trades, quarantine])

    return _start(parsed.writeStream.foreachBatch(sink), a)


def books_to_table(spark: SparkSession, a):
    """Raw venue messages -> live books -> verdicts, deltas, typed trades and rejects under
    ``OUT/orderbooks``, the books' state under ``OUT/state``.  Kafka messages of several
    partitions (``--partitions``) are brought into one order first."""
    sink = LiveBooks(f"{a.out}/{BOOK_TOPIC}", f"{a.out}/state", gate=a.gate,
                     partitions=a.partitions if a.source == "kafka" else None)
    return _start(raw_stream(spark, a).writeStream.foreachBatch(sink), a)


JOBS = {"trades_to_table": trades_to_table, "venue_to_topics": venue_to_topics,
        "books_to_table": books_to_table}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="marketstream.jobs")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--source", choices=["kafka", "files", "landed"], default="files")
    p.add_argument("--input"), p.add_argument("--out"), p.add_argument("--table-path")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--bootstrap"), p.add_argument("--user"), p.add_argument("--password")
    p.add_argument("--topic", default=None)
    p.add_argument("--sink-topic", default=TRADE_TOPIC)
    p.add_argument("--format", choices=["text", "parquet"], default="text",
                   help="of a landed trade topic")
    p.add_argument("--max-per-trigger", type=int, default=10_000)
    p.add_argument("--partitions", type=int, default=1, help="of the Kafka topic")
    p.add_argument("--max-files", type=int, default=1)
    p.add_argument("--trigger", default="1 minute")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--gate", action="store_true")
    p.add_argument("--dedupe", action="store_true")
    p.add_argument("--dedupe-delay", default="10 minutes",
                   help="event-time lateness kept by --dedupe; later records are dropped")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    a = parser().parse_args(argv)
    if spark is None:
        from marketstream.session import recommended_conf
        b = SparkSession.builder.appName(f"marketstream-{a.job}")
        for k, v in recommended_conf().items():
            b = b.config(k, v)
        spark = b.getOrCreate()
    q = JOBS[a.job](spark, a)
    if a.available_now and a.source == "landed":
        drain(q)
    else:
        q.awaitTermination()      # ST11: runs until stopped (or drained with --available-now)
    return q


if __name__ == "__main__":
    main()
