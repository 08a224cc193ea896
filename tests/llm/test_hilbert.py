import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from conftest_llm import texts_of
from martspark.llm import hilbert as H


@pytest.mark.parametrize("bits,dims", [(1, 2), (2, 2), (2, 3), (3, 3), (3, 1)])
def test_curve_visits_each_cell_once_and_moves_one_step(spark, bits, dims):
    axes = [f"a{i}" for i in range(dims)]
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame(cells, ", ".join(f"{a} long" for a in axes))
    rows = sorted((r.h, tuple(r)[:dims]) for r in df.withColumn(
        "h", H.hilbert_index(axes, bits)).collect())
    assert [h for h, _ in rows] == list(range(len(cells)))
    for (_, a), (_, b) in zip(rows, rows[1:]):
        assert sum(abs(x - y) for x, y in zip(a, b)) == 1


def check(rows, n, shards=40):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_odd_rows(odd):
    rows = H.shard_documents(odd).collect()
    check(rows, odd.count())
    want = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                  for i, t in texts_of(odd) if i is not None)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == want


def test_hot_cell_is_split_and_counts_stay_even(make_docs):
    rows = H.shard_documents(make_docs([(i, "same words", "hot") for i in range(3000)])).collect()
    check(rows, 3000)


def test_shards_narrow_the_dimensions(make_docs):
    docs = make_docs([(i, "w " * (i * 37 % 400), f"src{i % 10}") for i in range(2000)])
    placed = docs.select("doc_id", "source").join(H.shard_documents(docs), "doc_id")
    per = placed.groupBy("shard").agg(F.count_distinct("source").alias("k")).collect()
    assert sum(r.k for r in per) / len(per) < 6  # of 10


def test_write_shards(odd, tmp_dir, spark):
    H.write_shards(odd, f"{tmp_dir}/out")
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert set(odd.columns) | {"slot"} == set(back.columns)
    assert sorted(back.select("doc_id", "text").collect(), key=str) == sorted(
        odd.select("doc_id", "text").collect(), key=str)
    assert back.select("shard", "slot").distinct().count() == odd.count()


def test_empty(empty):
    assert H.shard_documents(empty).collect() == []


def test_cells_follow_the_rows(spark):
    def cells(values, bits):
        df = spark.createDataFrame([(v,) for v in values], "v string" if isinstance(values[0], str) else "v long")
        bounds = H.cell_bounds(df, "v", bits, len(values))
        return {r.v: r.q for r in df.select("v", H.quantised("v", bounds, bits).alias("q")).distinct().collect()}

    assert cells(["en"] * 50 + ["es"] * 6 + ["de", "fr"], 2) == {"de": 0, "en": 1, "es": 2, "fr": 3}
    assert cells(["\u00e9", "z", ""], 2) == {"": 0, "z": 1, "\u00e9": 2}  # by bytes
    assert cells(["a", "b"], 2) == {"a": 0, "b": 2}  # spread over the axis
    got = cells([7] * 500 + list(range(100, 600)), 2)  # the hot value has a cell of its own
    assert got[7] == 0 and sorted(set(got.values())) == [0, 1, 2]
    assert [sum(q == c for v, q in got.items() if v != 7) for c in (1, 2)] == [250, 250]


def test_shards_read_per_value(make_docs, spark):
    langs = ["en"] * 12 + ["es"] * 2 + ["de", "fr"]
    docs = make_docs([(i, "w " * (i * 37 % 400), f"src{10 + i * 7 % 10}") for i in range(4000)])
    docs = docs.withColumn("lang", F.element_at(F.array(*map(F.lit, langs)), (F.col("doc_id") * 11 % 16 + 1).cast("int")))
    placed = docs.select("doc_id", "lang", "source").join(H.shard_documents(docs), "doc_id")
    read = lambda c: {r[0]: r.k for r in placed.groupBy(c).agg(F.count_distinct("shard").alias("k")).collect()}
    by_lang, by_source = read("lang"), read("source")
    assert by_lang["es"] <= 16 and by_lang["de"] <= 12 and by_lang["fr"] <= 12  # of 40
    assert max(by_source.values()) <= 24
