from pyspark.sql import functions as F

from martspark.llm.common import components, may_occur, running_sums


def test_may_occur_loses_no_partner_and_few_others_pass(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("__x"))
    members = df.where("__x % 10 = 3 OR __x = 7").select("k")
    got = {r["__x"] for r in may_occur(df, ["k"], members).collect()}
    want = {r["__x"] for r in df.where("__x % 10 = 3 OR __x = 7 OR k IS NULL").collect()}
    assert want <= got and len(got - want) < 20
    assert may_occur(df, ["k"], members.limit(0)).count() == 0
    full = may_occur(df, ["k"], members, bits=8)  # saturated: everything passes
    assert full.count() == 20_000


def test_running_sums_within_groups(spark):
    rows = [(i, "abc"[i % 3] if i % 5 else None, (i * 7919) % 101) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, g string, v long")
    got = {r.i: (r.s, r.k) for r in running_sums(
        df, ["v", "i"], {"s": F.col("v"), "k": F.lit(1)}, ["g"]).collect()}
    for i, g, v in rows:
        before = [x for x in rows if x[1] == g and (x[2], x[0]) < (v, i)]
        assert got[i] == (sum(x[2] for x in before), len(before))


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(200, 201), (201, 202), (202, 200), (300, 300), (7, 5)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(edges, "a int, b int")).collect()}
    want = {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(30)} | {(200 + i, 200) for i in range(3)}
    assert got == want
    assert components(spark.createDataFrame([], "a int, b int")).collect() == []
