"""What findings of the third round asked for."""

from pyspark.sql import functions as F

from lotledger.llm import toxicity
from lotledger.operators import elements as E
from lotledger.operators.keyed import sized
from lotledger.plans.vehicle_queries import j12, n8b
from lotledger.session import configure

SF = "/root/testdata/sf0.001"


def test_wide_pages_are_read_and_sent_in_small_pieces(spark):
    configure(spark)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 512
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_no_large_key_table_is_broadcast_by_the_driver(spark):
    keys = spark.range(150_000)
    assert sized(keys) is keys


def test_records_are_dealt_before_they_are_parsed(spark):
    for query in (j12, n8b):
        assert "RepartitionByExpression" in query(spark, SF)._jdf.queryExecution().analyzed().toString()


def test_markup_that_repeats_is_read_once():
    page = E.Page('<p class="a&amp;b">x&nbsp;y</p><p class="a&amp;b">x&nbsp;y</p>')
    assert page.attributes[0] is page.attributes[1] and page.attributes[0] == {"class": "a&b"}
    assert page.texts == ["x\xa0y", "x\xa0y"]


def test_every_labelled_text_is_learned_from(spark):
    """Texts beyond the first ones are learned too: their words are known, and weigh."""
    rows = [(i, ("vile day " if i % 2 else "fine day ") + "some words follow", "en") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen = toxicity.train(docs, labels, first_per_class=5, steps=50)
    scorer = toxicity.Scorer(seen)
    assert {toxicity.part_hashes(w)[0] for w in (b"vile", b"fine", b"follow")} <= set(seen.known.tolist())
    assert scorer.score(rows[1][1]) > scorer.score(rows[0][1]) + 0.3
