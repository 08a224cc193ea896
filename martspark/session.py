"""Session helpers.

A cluster names its shared checkpoint folder in ``spark.checkpoint.dir``;
we read it from the session and only choose one ourselves when it is unset
(local runs and tests).
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE re-plans joins with runtime sizes (the
# size check behind every broadcast of a data-derived relation), coalesces
# small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Shuffle/spill blocks: zstd halves the bytes of the sales de-duplication
    # shuffle against the default lz4 at equal speed (measured at sf0.1).
    "spark.io.compression.codec": "zstd",
    # Checkpoints (surrogate-key numbering, batch materialisation) are
    # removed from the shared folder once their data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def sizing_conf(input_bytes: int, partition_bytes: int = 1 << 30,
                max_partitions: int = 100_000) -> dict:
    """Shuffle and scan sizing for a job's input size (cluster runs).

    The initial shuffle partition count follows the data (AQE merges small
    partitions and splits skewed ones, but does not split evenly large
    ones), so each reducer gets about ``partition_bytes``; the cap keeps the
    map x reduce block count manageable.  100 TB at 1 GiB gives ~100k
    partitions.  Scans split at up to 512 MiB.
    """
    n = max(8, min(max_partitions, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(min(partition_bytes, 512 << 20)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "martspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        # Unset: fine for a local run or a test; on a cluster executors would
        # not see the driver's folder.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        path = tempfile.mkdtemp(prefix="martspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Files that this package writes; hashes take half the bytes of Spark's default codec.
PARQUET = {"compression": "zstd"}


@contextlib.contextmanager
def tidy(spark: SparkSession):
    """Jobs inside delete their shuffle files as they end.

    Otherwise these stay until the driver happens to collect garbage, so that a load's steps pile up on the disk.
    For writes, and for frames made and collected inside, once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialize(df: DataFrame) -> DataFrame:
    """``df``, computed once into parquet files under the checkpoint folder.

    For whole batches: a checkpoint writes uncompressed rows, several times the size.
    The files stay until ``release``."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    with tidy(spark):
        df.write.options(**PARQUET).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _materialized(df: DataFrame) -> list:
    """Folders of the ``materialize`` calls that ``df`` reads, each with its file system."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    names = sorted({m[1] for f in df.inputFiles() if (m := re.search(r"/(rows-[0-9a-f]{32})/", f))})
    paths = [jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{name}") for name in names]
    return [(p.getFileSystem(conf), p) for p in paths]


def release(df: DataFrame) -> None:
    """Delete the files of the ``materialize`` calls that ``df`` reads."""
    for fs, path in _materialized(df):
        fs.delete(path, True)


def materialized_bytes(df: DataFrame) -> int:
    """Size of the files of the ``materialize`` calls that ``df`` reads."""
    return sum(fs.getContentSummary(path).getLength() for fs, path in _materialized(df))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Workers started elsewhere than in the repository could not import it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_martspark_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="martspark-py-"), "martspark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    sc._martspark_shipped = True
