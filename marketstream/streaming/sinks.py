"""Sinks: topic records (S6-S8), console (S9), the trades table (S3, S4, ST10), fan-out.

Topic writers take any DataFrame (batch or streaming) with ``key``/``value`` columns and a
``format`` + options, so the Kafka connector is a configuration choice: without its jar
(as in the tests) the same records go to files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.functions import exchange as venue
from marketstream.schemas import TRADES_TABLE_COLUMNS, TRADES_TABLE_DDL

TRADE_TOPIC = "trade"        # default topics of the trade and book sinks
BOOK_TOPIC = "orderbooks"


# ---------------------------------------------------------------- record shapes
def trade_records(trades: DataFrame, none_to: str | None = None) -> DataFrame:
    """A normalised trade -> the flat JSON record of the trade topic.

    ts / receipt_ts in integer ns (exact, D2), amount -> size, id -> trade_id, prices as
    JSON numbers (numeric type float), the order type dropped (D10).  ``none_to``
    replaces null text fields.  The key is the symbol so a partitioned topic keeps
    per-symbol order."""
    cols = {
        "exchange": F.col("exchange"), "symbol": F.col("symbol"), "side": F.col("side"),
        "price": F.col("price").cast("double"), "ts": F.col("ts"),
        "receipt_ts": F.col("receipt_ts"), "size": F.col("amount").cast("double"),
        "trade_id": F.col("trade_id"),
    }
    if none_to is not None:
        cols = {k: (F.coalesce(v, F.lit(none_to)) if k in ("exchange", "symbol", "side", "trade_id")
                    else v) for k, v in cols.items()}
    rec = F.to_json(F.struct(*[v.alias(k) for k, v in cols.items()]))
    return trades.select(F.col("symbol").alias("key"), rec.alias("value"))


def book_records(book: DataFrame, last: DataFrame | None = None, depth: int | None = None) -> DataFrame:
    """An L2 book (exchange, symbol, side, price, amount) -> one record per book with
    ``bid`` best-first (price descending) and ``ask`` ascending, each an array of
    {price, size}, optionally capped at ``depth`` levels.  ``last`` may give
    (exchange, symbol, ts, receipt_ts) of the book's last change.  One record holds one symbol's
    book -- bounded by its price levels, not by the number of messages."""
    entry = F.struct(F.col("price"), F.col("amount").alias("size"))
    if "exchange" not in book.columns:      # the book of one venue
        book = book.withColumn("exchange", venue())
    if last is not None and "exchange" not in last.columns:
        last = last.withColumn("exchange", venue())
    sides = book.groupBy("exchange", "symbol").agg(
        F.sort_array(F.collect_list(F.when(F.col("side") == "bid", entry)), asc=False).alias("bid"),
        F.sort_array(F.collect_list(F.when(F.col("side") == "ask", entry)), asc=True).alias("ask"))
    if depth is not None:
        sides = sides.select("exchange", "symbol", F.slice("bid", 1, depth).alias("bid"),
                             F.slice("ask", 1, depth).alias("ask"))
    if last is not None:
        sides = sides.join(last, ["exchange", "symbol"], "left")
    return sides


def book_record_json(records: DataFrame) -> DataFrame:
    """Book record -> (key, value) JSON for the book topic; prices and sizes as JSON
    numbers (numeric type float), the book and delta fields left out."""
    as_float = lambda a: F.transform(a, lambda x: F.struct(
        x["price"].cast("double").alias("price"), x["size"].cast("double").alias("size")))
    cols = [F.col(c) for c in ("exchange", "symbol", "ts", "receipt_ts") if c in records.columns]
    cols += [as_float(F.col("bid")).alias("bid"), as_float(F.col("ask")).alias("ask")]
    return records.select(F.col("symbol").alias("key"), F.to_json(F.struct(*cols)).alias("value"))


# ---------------------------------------------------------------- writers
def write_records(df: DataFrame, topic: str, fmt: str = "kafka", options: dict | None = None,
                  path: str | None = None):
    """Write (key, value) records to a topic (batch DataFrame).  ``fmt='kafka'`` needs
    ``kafka.bootstrap.servers`` among the options; any file format writes to ``path``."""
    w = df.select("key", "value").write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        w.option("topic", topic).save()
    else:
        w.mode("append").save(f"{path}/{topic}")


def kafka_options(bootstrap: str, username: str | None = None, password: str | None = None,
                  mechanism: str = "SCRAM-SHA-256", protocol: str = "SASL_SSL") -> dict[str, str]:
    """S1/S6 connection options (replaces the producer client set-up)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "kafka.security.protocol": protocol}
    if username is not None:
        opts["kafka.sasl.mechanism"] = mechanism
        opts["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            f'username="{username}" password="{password}";')
    return opts


def console(df: DataFrame, truncate: bool = False):
    """Print each record (streaming DataFrames)."""
    return df.writeStream.format("console").option("truncate", str(truncate).lower())


# ---------------------------------------------------------------- trades table
def create_trades_table(spark: SparkSession, name: str, location: str | None = None,
                        fmt: str = "parquet"):
    """S3: create the trades table if absent.  With Delta the venue's clustering is
    ``CLUSTER BY (symbol, ts)``; the parquet stand-in is partitioned by batch id (for
    idempotent replays) and each batch is written sorted by (symbol, ts) so row-group
    statistics prune symbol / time filters."""
    if fmt == "delta":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({TRADES_TABLE_DDL}) USING delta "
                  "CLUSTER BY (symbol, ts) TBLPROPERTIES (delta.autoOptimize.autoCompact = 'auto', "
                  "delta.autoOptimize.optimizeWrite = true)"
                  + (f" LOCATION '{location}'" if location else ""))
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({TRADES_TABLE_DDL}, batch_id BIGINT) "
                  "USING parquet PARTITIONED BY (batch_id)"
                  + (f" LOCATION '{location}'" if location else ""))


def append_batch(df: DataFrame, batch_id: int, path: str):
    """S4 + ST10: write one micro-batch into ``path/batch_id=N``, replacing what a
    failed earlier attempt of the same batch left -- a replay adds nothing.  Rows are
    range-partitioned (in as many parts as the session's shuffle and AQE choose) and
    sorted by (symbol, ts), the clustering of the table."""
    out = df.select(*TRADES_TABLE_COLUMNS).repartitionByRange("symbol", "ts")
    (out.sortWithinPartitions("symbol", "ts")
     .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))


def fan_out(batch: DataFrame, batch_id: int,
            sinks: Iterable[Callable[[DataFrame, int], None]]):
    """Several sinks for one micro-batch, computing the batch once."""
    batch.persist()
    try:
        for s in sinks:
            s(batch, batch_id)
    finally:
        batch.unpersist()
