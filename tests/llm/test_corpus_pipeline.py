import os
import zlib
from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline as P
from martspark.llm import decontaminate, jaccard_join, mixing, quality
from martspark.llm.common import table

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        frame = stage(spark, docs, SF)
        rows = [tuple(r) for r in frame.collect()]
        out.append((name, docs, rows, frame.columns))
        docs = spark.createDataFrame(rows, frame.schema)
    return out


def test_stages_and_registration(stages):
    assert [n for n, *_ in stages] == ["quality_classifier", "jaccard_join", "decontamination",
                                       "mixing", "token_output"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(c == columns for _, _, _, c in stages[:-1])
    q = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {k.split("_")[0] for k in q}


def test_decisions_take_effect(spark, stages):
    ids = [[r[0] for r in rows] for _, _, rows, _ in stages]
    before = [[r.doc_id for r in docs.select("doc_id").collect()] for _, docs, _, _ in stages]
    labels = table(spark, SF, "labels")
    score = {r.doc_id: r.score for r in quality.with_score(stages[0][1], labels).collect()}
    assert sorted(ids[0]) == sorted(i for i in before[0] if score[i] >= quality.THRESHOLD)
    groups = {r.doc_id: r.class_id for r in jaccard_join.near_duplicates(stages[1][1]).collect()}
    assert sorted(ids[1]) == sorted(set(groups.values()))
    bench = table(spark, SF, "benchmark")
    hit = {r.doc_id for r in decontaminate.with_matches(stages[2][1], bench, "m").collect() if r.m}
    assert sorted(ids[2]) == sorted(set(before[2]) - hit)
    plan = {r.doc_id: -(-r.taken // max(1, r.size)) for r in
            mixing.mix(mixing.sized(stages[3][1])).collect()}
    assert Counter(ids[3]) == {i: c for i, c in plan.items() if c}
    assert sorted(ids[4]) == sorted(before[4])


def test_run_equals_the_stages(spark, stages):
    got = sorted(tuple(r) for r in P.run(spark, SF).collect())
    assert got == sorted(stages[-1][2])


# -- odd rows, empty tables, clashing columns ------------------------------------

ODD = [
    (1, None, "a"), (2, "", "a"), (3, "  \n\t ", None), (3, "  \n\t ", None), (4, "same text here, five words", "b"),
    (5, "same text here, five words", "b"), (5, "same text here, five words", "b"), (6, " ", "a"), (6, " ", "a"),
    (7, "\u001c", "c"), (7, "\u001c", "c"), (None, "no id at all", "b"), (None, "no id at all", "b"), (None, None, None),
    (8, " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000)), "c"), (9, "zero\x00byte <|endoftext|> it's", "c"),
]


def tables(spark, folder, docs, labels, benchmark):
    more = [(i, t, "en", s, 0, "x", "y") for i, t, s in docs]
    frames = {"documents": (more, "doc_id bigint, text string, lang string, source string, n_chars bigint,"
                                  " score string, taken string"),
              "labels": (labels, "doc_id bigint, quality int, toxic int, key string"),
              "benchmark": (benchmark, "item_id bigint, text string, doc_id string")}
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


LABELS = [(1, 0, 0, "k"), (4, 1, 0, "k"), (5, 1, 0, "k"), (None, 1, 0, "k"), (99, None, None, None)]
ITEMS = [(1, "a passage of a benchmark that no document holds anywhere", "x"), (2, None, None), (None, "", "z")]


@pytest.mark.parametrize("docs,labels,items", [(ODD, LABELS, ITEMS), (ODD, [], []), ([], LABELS, ITEMS), ([], [], [])])
def test_stages_on_odd_rows_and_empty_tables(spark, tmp_path, docs, labels, items):
    folder = tables(spark, str(tmp_path / "t"), docs, labels, items)
    frame = table(spark, folder, "documents")
    columns = frame.columns
    for name, stage in P.STAGES:
        before = frame.count()
        out = stage(spark, frame, folder)
        rows = out.collect()
        if name != P.STAGES[-1][0]:
            assert out.columns == columns
            frame = spark.createDataFrame(rows, out.schema)
        if name in ("quality_classifier", "jaccard_join", "decontamination"):
            assert len(rows) <= before
        if not docs:
            assert rows == []
    assert len(rows) == frame.count()  # one row per document written


def test_rows_without_words_stay(spark, make_docs):
    blank = [(1, " "), (1, " "), (2, " \t"), (2, " \t"), (3, "\u001c"), (3, "\u001c"), (4, None), (4, None)]
    kept = jaccard_join.keep_first(make_docs(blank))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == sorted(r for r in blank if r[1])
    assert kept.count() == len(blank)
    words = [(1, "one two three four five six"), (1, "one two three four five six"), (2, "one two three four five six")]
    assert [r.doc_id for r in jaccard_join.keep_first(make_docs(words + blank)).where("text LIKE 'one%'").collect()] == [1]
