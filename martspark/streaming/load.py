"""Incremental warehouse load: a stream over sales staging.

Each micro-batch of newly staged lines runs the batch operators unchanged —
``prepare_sales`` (filter, parse, latest row per key, lookups) and the
guarded upsert of the creation months that change — audits the written rows and
publishes only those partitions.  Lines the load cannot type are stored per micro-batch,
and every micro-batch leaves an audit row in which each line is accounted for:

    lines = service + outside + rejected + superseded + inserted + updated + unchanged

Replaying a micro-batch after a failure is harmless: a batch
whose publish completed is a no-op under the change-hash guard, one that
failed never switched the store pointer, and rejects and audit rows are
overwritten by query and batch number.  ``trigger(availableNow=True)``
processes everything staged so far and stops.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martspark import schemas
from martspark.operators import gate, profile
from martspark.plans import facts, pipeline
from martspark.session import PARQUET, release, tidy
from martspark.sources.store import TableStore

AUDIT = ["lines", "service", "outside", "rejected", "superseded", "inserted", "updated", "unchanged"]


def start_sales_load(spark: SparkSession, staging_dir: str, store: TableStore, status_map: DataFrame,
                     dim_country: DataFrame, fx_rates: DataFrame, checkpoint_location: str,
                     as_of: dt.date | None = None, available_now: bool = True) -> StreamingQuery:
    """Rejects go to ``<root>/stream_rejects``, audit rows to ``<root>/stream_audit``, each in
    a folder named by query and micro-batch."""
    stream = (spark.readStream.schema(schemas.ORDER_RAW_TYPED).parquet(staging_dir))

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"load_query={query}/load_batch={epoch_id}"
        # The load boundary stamps the run time, like the source's now().
        run_ts = F.current_timestamp().cast("timestamp_ntz")
        seen_lines = Observation()
        rows, rejects = facts.prepare_sales(batch, status_map, dim_country, fx_rates, as_of=as_of,
                                            run_ts=run_ts, once=True, lines=seen_lines)
        seen = Observation()  # counted during the write itself
        with tidy(session):
            (rejects.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
             .options(**PARQUET).parquet(f"{store.root}/stream_rejects/{folder}"))
        lines = facts.line_counts(seen_lines)
        staged, actions = pipeline.stage_sales_batch(store, rows, run_ts)
        release(rows)
        checks = gate.Gate()
        hidden = [f"Q8.sales_current.{c}" for c in pipeline.REPORTED_NULLS["sales_current"]]
        checks.add(profile.merged_checks(
            store.read_side(staged, "checks", "written"),
            [c for c in pipeline.sales_constraints() if c.check_id not in hidden]), "sales_current",
            lambda: gate.violations(store.read_staged(staged, written_only=True), "sales_current"))
        checks.close(store.publish)
        if staged.written or store.version("sales_current") is None:
            store.commit(staged)
        went_on = actions["insert"] + actions["update"] + actions["unchanged"]
        too_large = seen.get["n"] - lines["rejected"]  # found after the de-duplication
        audit = {**lines, "rejected": seen.get["n"], "superseded": lines["kept"] - went_on - too_large,
                 "inserted": actions["insert"], "updated": actions["update"], "unchanged": actions["unchanged"]}
        (session.createDataFrame([tuple(audit[c] for c in AUDIT)], ", ".join(f"{c} bigint" for c in AUDIT))
         .coalesce(1).write.mode("overwrite").parquet(f"{store.root}/stream_audit/{folder}"))

    w = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 minutes")
    return w.start()
