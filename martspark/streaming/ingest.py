"""File-arrival ingest of feed files into staging with Structured Streaming.

``readStream.csv`` on a landing folder discovers new files; each micro-batch
is renamed, stamped and appended to staging by ``foreachBatch``.  The batch
is written with overwrite to a folder of its own, named by feed, country,
query id (kept in the checkpoint) and batch number: a batch replayed after a
failure replaces its own output, and neither another country nor a new
checkpoint over old staging can touch it (the checkpoint records which files
were taken, D24).  Lines that do not parse go, with their file, to a reject folder named
the same way; ``feeds.bad_lines`` tells its columns.
``trigger(availableNow=True)`` processes what has landed and stops, which
suits a scheduled warehouse load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martspark.sources import feeds

TABLES = {"sales": "order_raw", "stock": "stock_raw"}


def start_feed_ingest(spark: SparkSession, feed: str, landing_dir: str, staging_dir: str,
                      country: str, checkpoint_location: str, available_now: bool = True,
                      rejects_dir: str | None = None, empty_text: bool = False) -> StreamingQuery:
    """Without ``rejects_dir`` the first line that does not parse stops the stream."""
    schema, staged = feeds.FEEDS[TABLES[feed]]
    if rejects_dir is None:
        stream = feeds.csv_options(spark.readStream, schema, empty_text=empty_text).csv(landing_dir)
        stream = stream.select("*", F.col("_metadata.file_name").alias("_file"))
    else:
        stream = feeds.feed_columns(feeds.feed_options(spark.readStream, schema, empty_text).csv(landing_dir))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = (f"ingest_feed={feed}/ingest_country={country}"
                  f"/ingest_query={query}/ingest_batch={epoch_id}")
        # The ingest boundary stamps arrival time, like the staging default.
        now = F.current_timestamp()
        if rejects_dir is not None:
            (feeds.bad_lines(batch, TABLES[feed], country, now)
             .write.mode("overwrite").parquet(f"{rejects_dir}/{folder}"))
            batch = feeds.good_lines(batch)
        staged(batch, country, now).write.mode("overwrite").parquet(f"{staging_dir}/{folder}")

    w = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
