"""The deployable jobs, drained with --available-now over landed files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketstream import jobs
from marketstream.session import fresh_dir
from marketstream.sources import feeds
from marketstream.streaming import source


def test_venue_to_topics_fans_out(spark):
    work = fresh_dir(spark, "job-venue")
    landing = os.path.join(work, "in")
    feeds.routing_feed(spark, SF_SMALL).repartition(3).write.parquet(landing)
    jobs.main(["venue_to_topics", "--input", landing, "--out", os.path.join(work, "out"),
               "--checkpoint", os.path.join(work, "ck"), "--available-now", "--max-files", "2"],
              spark=spark)
    trades = spark.read.parquet(os.path.join(work, "out", "trade"))
    bad = spark.read.parquet(os.path.join(work, "out", "quarantine"))
    base = feeds.base(spark, SF_SMALL)
    assert trades.count() == base.where(F.col("event_type") == "purchase").count()
    assert bad.count() == base.where(F.col("event_type").isin("view", "error")).count()


def test_trades_and_books_jobs(spark):
    from marketstream.plans.queries import trade_record

    work = fresh_dir(spark, "job-trades")
    landing = os.path.join(work, "topic")
    trade_record(spark, SF_SMALL).select("value").write.text(landing)
    jobs.main(["trades_to_table", "--input", landing, "--table-path", os.path.join(work, "t"),
               "--checkpoint", os.path.join(work, "ck"), "--available-now", "--dedupe",
               "--dedupe-delay", "40 days"], spark=spark)
    assert spark.read.parquet(os.path.join(work, "t")).count() == 1000

    landing = source.land(feeds.l3_feed(spark, SF_SMALL), os.path.join(work, "l3"))
    jobs.main(["books_to_table", "--source", "landed", "--input", landing, "--out",
               os.path.join(work, "books"), "--checkpoint", os.path.join(work, "ck2"),
               "--max-per-trigger", "600", "--available-now"], spark=spark)
    out = spark.read.parquet(os.path.join(work, "books", "orderbooks"))
    assert out.where(F.col("kind") == "trade").count() == \
        feeds.l3_rows(spark, SF_SMALL).where(F.col("typ") == "match").count()


def test_what_a_task_of_the_trades_pipeline_reads_is_bounded(spark, monkeypatch):
    """Venue files hold a bounded number of rows, and a batch of the venue job keeps the text of
    rejected messages only."""
    from marketstream.plans import queries

    work = fresh_dir(spark, "job-bounded")
    monkeypatch.setattr(queries, "fresh_dir", lambda *_: work)
    monkeypatch.setattr(queries, "LANDED_ROWS", 60)
    fan_out, seen = jobs.fan_out, []

    def watched(batch, batch_id, sinks):
        seen.append((batch.columns, batch.where("value is not null").count()))
        fan_out(batch, batch_id, sinks)

    monkeypatch.setattr(jobs, "fan_out", watched)
    assert queries.pipeline_trades(spark, SF_SMALL).count() == 1000
    rows = spark.read.parquet(os.path.join(work, "venue")).groupBy("_metadata.file_path").count()
    assert rows.agg(F.max("count")).first()[0] <= 60
    assert seen and all(n == 0 and "bids" not in c for c, n in seen)
