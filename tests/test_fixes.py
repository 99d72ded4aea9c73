"""Cases in which rows were once wrong."""

from pyspark.sql import functions as F

from lotledger.operators import cards as CA
from lotledger.operators import classify as C
from lotledger.operators import jsonmine as JM
from lotledger.operators import normalize as N
from lotledger.operators import state as S
from lotledger.schemas import VEHICLE_COLUMNS
from lotledger.sources import seeds as SS

PAGE = "dealer_url string, status int, error string, cname string, page_ord int, attempt int, body string"


def test_lines_are_in_order_of_file_then_place(spark, tmp_path):
    (tmp_path / "a.txt").write_text("https://x.com,First\nhttps://y.com,A\n")
    (tmp_path / "b.txt").write_text("https://x.com,Second\n" * 2000 + "https://z.com,B\n")
    lines = SS.read_lines(spark, str(tmp_path))
    first = lines.orderBy("ord").limit(2).collect()
    assert [r["line"] for r in first] == ["https://x.com,First", "https://y.com,A"]
    kept = SS.platform_map_from_lines(lines)
    assert kept.filter("platform = 'First'").count() == 0 and kept.filter("platform = 'A'").count() == 1


def test_one_layer_per_url(spark):
    body = "<html>" + "x" * 2000
    caps = spark.createDataFrame([
        ("https://a.com", 200, None, None, 1, 0, "captcha-delivery " + body),
        ("https://a.com", 403, None, None, 0, 0, body), ("https://b.com", 200, None, None, 0, 1, body),
    ], PAGE)
    labels = spark.createDataFrame(
        [("https://a.com", C.V.LABEL_UNKNOWN), ("https://b.com", C.V.LABEL_UNKNOWN), ("https://c.com", C.V.LABEL_UNKNOWN),
         ("https://d.com", C.V.LABEL_UNREACHABLE)], "url string, platform string")
    got = [(r["url"], r["layer"]) for r in C.cascade_layers(labels, caps).orderBy("url").collect()]
    assert got == [("https://a.com", "antibot"), ("https://b.com", "L3_navegacion"),
                   ("https://c.com", "sin_captura"), ("https://d.com", "sin_captura")]
    assert C.fingerprint(caps).count() == 2


def test_relabel_moves_no_body_and_reads_every_attempt(spark):
    rows = [("https://a.com", i, "x" * 1600 + ("overfuel" if i == 4 else "datadome")) for i in range(1, 5)]
    attempts = spark.createDataFrame(rows, "dealer_url string, attempt int, body string")
    blocked = spark.createDataFrame([("https://a.com", C.V.BLOCKED_LABELS[0], "http", None)], "url string, platform string, via string, cname string")
    out = C.relabel_blocked(blocked, attempts)
    assert out.first()["platform"] == "OverFuel"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert all("body" not in line for line in plan.split("\n") if "Exchange" in line)


def test_vin_in_a_script_and_in_a_card(spark):
    vin = "1FTFW1E50NFA00001"
    body = (f"<script>var v = '{vin}';</script>" + "<p>filler</p>" * 300
            + f"<div><a href='/car/1'>2020 Ford Ranger</a> {vin} <b>$21,000</b></div>")
    df = spark.createDataFrame(
        [(1, "r", "https://d.com", 0, "https://d.com/p", body)],
        "capture_id long, run_id string, dealer_url string, page_ord int, page_url string, body string")
    row = CA.anchored_vins(df).first()
    assert (row["vin"], row["year"], row["make"], row["url"]) == (vin, "2020", "Ford", "https://d.com/car/1")


def test_a_vehicle_without_last_run_is_not_new(spark):
    empty = S.empty_state(spark) if hasattr(S, "empty_state") else None
    fields = {c: None for c in VEHICLE_COLUMNS} | {"vin": "1FTFW1E50NFA00001", "make": "Ford", "model": "F"}
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (empty.schema if empty else [])) if empty else None
    if types is None:
        from lotledger.schemas import VEHICLE_TYPES
        cols = ["dealer_id bigint", "vehicle_key string", *[f"{c} {VEHICLE_TYPES[c]}" for c in VEHICLE_COLUMNS],
                "source_strategy string", "first_seen_run string", "last_seen_run string",
                "first_seen_at timestamp", "last_seen_at timestamp"]
        types = ", ".join(cols)
    old = spark.createDataFrame([(1, "vin:" + fields["vin"], *fields.values(), "api", "r0", None, None, None)], types)
    from lotledger.schemas import VEHICLE_TYPES
    batch = spark.createDataFrame(
        [(1, *fields.values(), "api", "r1", None, 0)],
        "dealer_id bigint, " + ", ".join(f"{c} {VEHICLE_TYPES[c]}" for c in VEHICLE_COLUMNS)
        + ", source_strategy string, run_id string, seen_at timestamp, ord bigint")
    merged = S.merge_vehicles(old, batch)
    assert merged.first()["is_new"] is False


def test_two_labels_of_one_extractor_do_not_double_vehicles(spark):
    labels = spark.createDataFrame([("r", "d", p) for p in ("DealerCenter", "DealerCarSearch")], "run_id string, dealer_url string, platform string")
    extractors = labels.select(CA.extractor_for(F.col("platform")).alias("e")).distinct()
    assert extractors.count() == 1


def test_another_stream_on_the_same_root_keeps_what_is_there(spark, tmp_path):
    from lotledger.streaming import worker as W

    def job(messages):
        results = messages.select(
            "run_id", F.xxhash64("url").alias("dealer_id"), "url", F.lit("api").alias("strategy_used"),
            F.lit("ok").alias("status"), F.lit(1).alias("vehicles_found"), F.lit(0).alias("vehicles_new"),
            F.lit(0).alias("vehicles_updated"), F.lit(None).cast("string").alias("reason"),
            F.monotonically_increasing_id().alias("ord"))
        return results, None

    root = str(tmp_path / "state")
    worker = W.InventoryWorker(spark, root, job, F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    for stream, urls in (("one", ["a", "b"]), ("two", ["b", "c"])):
        folder = tmp_path / stream
        folder.mkdir()
        for k, u in enumerate(urls):
            (folder / f"{k}.txt").write_text('{"runId": "r", "url": "https://%s.com", "totalUrls": 3}\n' % u)
        source = spark.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
        W.InventoryWorker(spark, root, job, worker.now).run_available(source, str(tmp_path / f"check-{stream}"))
    rows = worker.ledger.read().collect()
    assert sorted(r["url"] for r in rows) == ["https://a.com", "https://b.com", "https://c.com"]
    assert worker.runs.read().first()["urls_ok"] == 3


def test_no_vehicle_is_lost_to_a_limit(spark):
    rows = spark.range(2500).selectExpr("'d' as dealer", "id")
    assert N.cap_vehicles(rows, ["dealer"], ["id"]).count() == 2500
    assert N.cap_vehicles(rows, ["dealer"], ["id"], 2000).count() == 2000


def test_depths_end_when_nothing_is_open(spark):
    car = '[{"vin": "1HGCM82633A004352", "make": "M", "model": "X", "price": 1, "year": 2020}]'
    df = spark.createDataFrame([('{"a":' * 12 + car + "}" * 12, '{"a":' * 7 + '{"vin": "deep"}' + "}" * 7)], "t string, raw string")
    got = df.select(
        F.size(JM.vehicle_arrays(F.col("t"))).alias("rule"), F.size(JM.vehicle_arrays(F.col("t"), None)).alias("all"),
        F.size(N.flat_leaves(F.col("raw"))).alias("five"), N.flat_leaves(F.col("raw"), None)["text"].alias("deep"),
    ).first()
    assert (got["rule"], got["all"], got["five"], got["deep"]) == (0, 1, 0, ["deep"])
