"""What the later findings of the third round asked for."""

import numpy as np
from pyspark.sql import functions as F

from lotledger.llm import toxicity
from lotledger.operators import cards as CA
from lotledger.operators.keyed import dealt
from lotledger.plans import inventory_run as IR
from lotledger.streaming import worker as W

RECORD = '{"vin":"FX1GB000000000%03d","stockNumber":"S1","make":"A","model":"B","year":2001,"mileage":5,"price":9}'


def _answers(spark, url, count=1):
    body = '{"vehicles":[' + ",".join(RECORD % i for i in range(3)) + "]}"
    rows = [(i, "r", "https://d.com", f"https://d.com{url}", i, 200, "application/json", body, None, 1) for i in range(count)]
    return spark.createDataFrame(
        rows, "capture_id long, run_id string, dealer_url string, page_url string, page_ord int, status int,"
        " content_type string, body string, error string, attempt int")


def test_answered_records_are_dealt_to_all_cores_before_they_are_normalised(spark):
    found = CA._answered(_answers(spark, "/api/widget/ws-inv-data/getInventory"), 2024, None)
    assert "RepartitionByExpression" in found._jdf.queryExecution().analyzed().toString()
    assert {r["vin"] for r in found.collect()} == {"FX1GB000000000%03d" % i for i in range(3)}
    rows = spark.range(1000).withColumn("none", F.lit(None).cast("long"))
    assert dealt(rows, ["id", "none"], 2).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_a_layer_parses_its_pages_once(spark):
    found = IR.Layers(2024, None, None, 5, None, {1}).api(_answers(spark, "/x", 2))
    assert "posexplode" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["page_ord"], r["strategy"]) for r in found.collect()] == [(0, "api")] * 3


def test_a_file_of_messages_is_dealt_to_all_cores(spark, tmp_path):
    parts = []

    def job(messages):
        parts.append(messages.rdd.getNumPartitions())
        results = messages.select("run_id", F.xxhash64("url").alias("dealer_id"), "url", F.lit("ok").alias("status"),
                                  F.lit(1).alias("vehicles_found"), F.lit(0).alias("ord"))
        return results, None

    made = spark.range(0, 50, 1, 1).selectExpr("""'{"runId":"r","url":"https://d' || id || '.com","totalUrls":50}' as value""")
    made.write.text(f"{tmp_path}/messages")
    worker = W.InventoryWorker(spark, f"{tmp_path}/tables", job)
    worker.run_available(spark.readStream.text(f"{tmp_path}/messages"), f"{tmp_path}/checkpoint")
    assert parts == [spark.sparkContext.defaultParallelism]
    assert worker.ledger.read().count() == 50


def test_the_driver_gets_one_set_of_weights_a_round(spark, monkeypatch):
    words = toxicity.word_hashes("a vile and a fine day").ravel().tolist()
    rows = spark.createDataFrame(
        [(i * 7919, i, i % 2, "en", words) for i in range(200)],
        "draw long, doc_id long, toxic int, lang string, words array<int>")
    known = np.unique(np.array([w for w in words if w >= 0], dtype=np.int32))
    start = toxicity.first_weights(known, 0.5, np.random.default_rng(1))
    sizes, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda df: (got := collect(df), sizes.append(len(got)))[0])
    after = toxicity._trained(rows, known, start, (1.0, 1.0), 5)
    again = toxicity._trained(rows, known, start, (1.0, 1.0), 5)
    assert max(sizes) == 1
    assert [w.shape for w in after] == [w.shape for w in start] and not np.array_equal(after[0], start[0])
    assert all(np.array_equal(a, b) for a, b in zip(after, again))
    assert toxicity._trained(rows.filter("false"), known, start, (1.0, 1.0), 5) is start
