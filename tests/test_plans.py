"""Plans at a glance: hot keys, joins and Python."""

from pyspark.sql import functions as F

from lotledger.operators import cascade as K
from lotledger.operators import classify as C
from lotledger.operators import jsonmine as JM
from lotledger.operators import keyed, normalize as N
from lotledger.plans import rendering as R8

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, n=20_000):
    """A third of the rows on one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("k"), (F.col("id") * 7919 % n).alias("v"))


def test_first_by_is_cut_before_the_shuffle(spark):
    df = keyed.first_by(skewed(spark), ["k"], [F.col("v")])
    text = plan(df)
    assert text.index("WindowGroupLimit") > -1 and "Partial" in text
    want = {r["k"]: r["v"] for r in skewed(spark).groupBy("k").agg(F.min("v").alias("v")).collect()}
    assert {r["k"]: r["v"] for r in df.collect()} == want


def test_top_per_group_is_exact_on_a_hot_group(spark):
    rows = skewed(spark)
    got = keyed.top_per_group(rows, ["k"], ["v"], 50)
    brute = {}
    for k, v in rows.collect():
        brute.setdefault(k, []).append(v)
    assert sorted(map(tuple, got.collect())) == sorted((k, v) for k, vs in brute.items() for v in sorted(vs)[:50])


def test_hot_key_join_equals_the_plain_join(spark):
    rows, small = skewed(spark), skewed(spark).select("k").distinct().withColumn("w", F.col("k") * 2).filter("k % 5 <> 1")
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = keyed.join_on_hot_keys(rows, small, ["k"], ["v"], how)
        b = rows.join(small, "k", how)
        assert sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(b.columns)).collect()))


def test_only_script_literals_run_in_python(spark):
    pages = R8.state_pages(spark, SF)
    keep = ["capture_id", "run_id", "dealer_url"]
    mined = JM.embedded_records(pages, keep)
    assert plan(mined).count("ArrowEvalPython") == 1
    clean = [
        JM.response_records(R8.json_pages(spark, SF), keep),
        N.normalize_many(R8.raw_records(spark, SF), ["dealer_url"], ["ord"]),
        C.fingerprint(pages.withColumn("error", F.lit(None).cast("string"))),
    ]
    for df in clean:
        assert "Python" not in plan(df) and "CartesianProduct" not in plan(df)


def test_cascade_never_sorts_a_dealer_in_one_task(spark):
    layers = spark.createDataFrame([("r", "d", "api", 1, True, 2, "x", ["a"])], "run_id string, dealer_url string, strategy string, prio int, ok boolean, n long, reason string, attempts array<string>")
    vehicles = spark.range(100).select(F.lit("r").alias("run_id"), F.lit("d").alias("dealer_url"), F.lit(1).alias("prio"), F.col("id"))
    df = K.winning_vehicles(vehicles, K.winners(layers), ["id"])
    assert "Window" not in plan(df) and df.count() == 100
