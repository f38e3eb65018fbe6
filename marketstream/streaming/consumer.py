"""The trade consumer: topic -> parse -> 9-column projection -> trades table (S1-S5, P1,
P2, ST1, ST10, ST11, S15, O1, O4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from marketstream.schemas import TRADE_RECORD, TRADES_TABLE_COLUMNS

_WITH_CORRUPT = T.StructType(TRADE_RECORD.fields + [T.StructField("_corrupt", T.StringType())])
from marketstream.operators.parse import parse_once
from marketstream.streaming.sinks import append_batch, fan_out


def read_topic(spark: SparkSession, options: dict[str, str], topic: str = "trade",
               max_per_trigger: int = 10_000, fmt: str = "kafka", path: str | None = None,
               max_files: int | None = None) -> DataFrame:
    """A streaming ``value`` text column from a topic.  ``kafka`` reads from the
    earliest offset, at most ``max_per_trigger`` records per micro-batch; a file format
    (landed topic, as in tests) reads ``path`` with ``max_files`` per trigger."""
    if fmt == "kafka":
        return (spark.readStream.format("kafka").options(**options)
                .option("subscribe", topic).option("startingOffsets", "earliest")
                .option("maxOffsetsPerTrigger", max_per_trigger).load()
                .select(F.col("value").cast("string").alias("value")))       # F8
    r = spark.readStream.format(fmt).options(**options)
    if fmt == "parquet":                       # a topic that the venue job wrote as files
        r = r.schema("key string, value string")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path).select(F.col("value").cast("string").alias("value"))


def decode_trades(records: DataFrame, strict_compat: bool = False) -> DataFrame:
    """S2 + P2 + P1: parse the trade JSON under the fixed schema and project the table
    columns: price FLOAT, ts LONG, size DOUBLE, and epoch := ts (an incoming ``epoch`` is
    ignored).  Malformed records are dropped here (see ``bad_trade_records``) unless
    ``strict_compat`` keeps the all-null row the original consumer appended (D4)."""
    sch = _WITH_CORRUPT
    p = records.select(*parse_once(
        F.from_json("value", sch, {"columnNameOfCorruptRecord": "_corrupt"}), "data")
    ).select("data.*")
    if not strict_compat:
        p = p.where(F.col("_corrupt").isNull() & F.col("ts").isNotNull())
    return p.select(
        F.col("exchange"), F.col("symbol"), F.col("side"),
        F.col("price").cast("float").alias("price"), F.col("ts").cast("long").alias("ts"),
        F.col("receipt_ts"), F.col("size").cast("double").alias("size"), F.col("trade_id"),
        F.col("ts").cast("long").alias("epoch"))


def bad_trade_records(records: DataFrame) -> DataFrame:
    """P15 quarantine for the consumer: records that are not a trade JSON."""
    sch = _WITH_CORRUPT
    p = records.select("value", *parse_once(
        F.from_json("value", sch, {"columnNameOfCorruptRecord": "_corrupt"}), "d"))
    return p.where(F.col("d").isNull() | F.col("d._corrupt").isNotNull() | F.col("d.ts").isNull()) \
        .select("value", F.lit("malformed").alias("reason"))


def start_trades_with_rejects(records: DataFrame, table_path: str, quarantine_path: str,
                              checkpoint: str, processing_time: str | None = "1 minute",
                              available_now: bool = False):
    """As ``start_trades_stream``, from the undecoded records: each micro-batch is read once
    and goes to the table, and what is no trade goes to the quarantine, both idempotent."""
    def write(batch: DataFrame, batch_id: int):
        fan_out(batch, batch_id, [
            lambda df, n: append_batch(decode_trades(df), n, table_path),
            lambda df, n: (bad_trade_records(df).write.mode("overwrite")
                           .parquet(f"{quarantine_path}/batch_id={n}"))])

    w = (records.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(write))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def dedupe_trades(decoded: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """ST10 (optional, off by default): drop a trade delivered twice -- same exchange,
    symbol and trade id -- within ``delay`` of event time.  State is bounded by the
    watermark, not by the stream's length.  Spark also drops records that arrive later
    than the watermark, so ``delay`` must cover the feed's real lateness; that trade-off
    is why this is off by default (per-batch idempotence already stops replays)."""
    et = F.timestamp_micros(F.floor(F.col("ts") / F.lit(1000))).alias("_event_time")
    return (decoded.withColumn("_event_time", et).withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark(["exchange", "symbol", "trade_id"])
            .drop("_event_time"))


def start_trades_stream(decoded: DataFrame, table_path: str, checkpoint: str,
                        processing_time: str | None = "1 minute", available_now: bool = False):
    """ST1/S4/S15: append-mode micro-batches into the trades table through an
    idempotent ``foreachBatch``; the checkpoint is the restart point."""
    w = (decoded.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: append_batch(df, bid, table_path)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_trades_table(spark: SparkSession, table_path: str, name: str | None = None) -> DataFrame:
    """Register the table over ``table_path`` (if a name is given) and read it
    the way the notebook's SQL does: every column, newest first."""
    if name is None:
        return (spark.read.parquet(table_path).select(*TRADES_TABLE_COLUMNS)
                .orderBy(F.desc("ts")))
    from marketstream.streaming.sinks import create_trades_table

    create_trades_table(spark, name, location=table_path)
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    cols = ", ".join(TRADES_TABLE_COLUMNS)
    return spark.sql(f"SELECT {cols} FROM {name} ORDER BY ts DESC")
