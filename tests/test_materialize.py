"""Batches that are written once and deleted after use."""

import os

from martspark.session import checkpoint_dir, materialize, release


def test_materialize_and_release(spark):
    df = materialize(spark.range(1000).selectExpr("id", "repeat('x', 200) AS text"))
    assert df.where("id % 2 = 0").count() == 500
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert os.path.dirname(folder).rstrip("/") == checkpoint_dir(spark).removeprefix("file:").rstrip("/")
    assert sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder)) < 100_000  # 200 KB of text
    release(df.where("id > 5").drop("text"))
    assert not os.path.exists(folder)
