"""A load does not leave its shuffles and batches on the disk."""

import glob

from pyspark.sql import functions as F

from martspark.plans import catalog, pipeline, stored
from martspark.plans.driver import RUN_TS, ts
from martspark.session import checkpoint_dir, materialize, materialized_bytes, release
from martspark.sources.store import TableStore

SMALL = "/root/testdata/sf0.001"


def blocks(spark):
    """Shuffle blocks on the disk."""
    all_blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum("shuffle_" in all_blocks.apply(i).name() for i in range(all_blocks.size()))


def test_a_batch_leaves_no_shuffle_files(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, conf = blocks(spark), spark.conf.get(name)
    df = materialize(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert blocks(spark) <= before and spark.conf.get(name) == conf
    assert df.agg(F.sum("count")).first()[0] == 1000 and materialized_bytes(df) > 0
    release(df)


def test_waves_write_the_same_state(spark, tmp_dir, monkeypatch):
    out = []
    for i, most in enumerate((1 << 30, 1)):
        monkeypatch.setattr(pipeline, "WAVE_BYTES", most)
        store, counts = TableStore(spark, f"{tmp_dir}/{i}"), []
        for raw, run_ts in zip(catalog.guarded_loads(spark, SMALL), (catalog.RUN1_TS, RUN_TS)):
            batch, _ = catalog.sales_batch(spark, SMALL, raw=raw, run_ts=run_ts, once=True)
            staged, n = pipeline.stage_sales_batch(store, batch, ts(run_ts))
            store.commit(staged)
            release(batch)
            counts.append(n)
        sides = [sorted(map(repr, store.read_side("sales_current", s).collect())) for s in ("checks", "keys", "key_counts")]
        files = len(store.read("sales_current").inputFiles())
        out.append((sorted(map(repr, store.read("sales_current").collect())), counts, sides, files))
    assert out[0][:3] == out[1][:3]
    assert out[1][3] > out[0][3]  # written in several waves


def test_the_streaming_load_keeps_no_batch(spark):
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/rows-*"))
    assert stored.stream_load_audit(spark, SMALL).count() == 1
    assert set(glob.glob(f"{folder}/rows-*")) <= before
