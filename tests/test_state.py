from pyspark.sql import functions as F

from lotledger.operators import state as ST
from lotledger.plans.state_queries import _as_batch, empty_state
from lotledger.session import work_folder
from lotledger.sources import sinks as SK

FIELDS = "dealer_id long, vin string, stock_number string, make string, model string, year int, url string, price double, run_id string, ord long"


def batch(spark, *rows, run="r1"):
    full = [(1, r.get("vin"), r.get("stock"), r.get("make"), r.get("model"), r.get("year"), r.get("url"), r.get("price"), run, i)
            for i, r in enumerate(rows)]
    return _as_batch(spark.createDataFrame(full, FIELDS).withColumn("source_strategy", F.lit("api")))


def saved(spark, merged):
    root = work_folder(spark, "state")
    SK.write_snapshot(ST.state_of(merged), root)
    return SK.read_snapshot(spark, root)


def counts(merged):
    row = ST.upsert_counts(merged).first()
    return (row["inserted"], row["updated"])


CAR = dict(make="A", model="B", year=2000)


def test_null_never_erases(spark):
    old = saved(spark, ST.merge_vehicles(empty_state(spark), batch(spark, dict(vin="12345678901", price=5.0))))
    new = ST.merge_vehicles(old, batch(spark, dict(vin="12345678901"), run="r2"))
    row = new.first()
    assert (row["price"], row["first_seen_run"], row["last_seen_run"], counts(new)) == (5.0, "r1", "r2", (0, 1))


def test_duplicate_in_a_batch_inserts_then_updates(spark):
    merged = ST.merge_vehicles(empty_state(spark), batch(
        spark, dict(vin="12345678901", price=1.0), dict(vin="12345678901", price=2.0), dict(vin="12345678901")))
    assert (merged.count(), merged.first()["price"], counts(merged)) == (1, 2.0, (1, 2))


def test_without_vin_by_stock_then_by_model_then_insert(spark):
    old = saved(spark, ST.merge_vehicles(empty_state(spark), batch(
        spark, dict(stock="S1", **CAR), dict(stock="S2", make="C", model="D", year=2001))))
    merged = ST.merge_vehicles(old, batch(
        spark, dict(stock="S1", price=1.0), dict(make="C", model="D", year=2001, price=2.0), dict(make="E", model="F", year=2002), run="r2"))
    got = {r["stock_number"]: r["price"] for r in merged.collect()}
    assert got == {"S1": 1.0, "S2": 2.0, None: None}
    assert counts(merged) == (1, 2)


def test_two_key_chain_in_one_batch_is_one_row(spark):
    merged = ST.merge_vehicles(empty_state(spark), batch(spark, dict(stock="S", price=1.0, **CAR), dict(price=2.0, **CAR)))
    rows = merged.collect()
    assert [(r["stock_number"], r["price"]) for r in rows] == [("S", 2.0)]
    assert counts(merged) == (1, 1)


def test_interleaved_rows_keep_batch_order(spark):
    merged = ST.merge_vehicles(empty_state(spark), batch(
        spark, dict(stock="S", price=1.0, **CAR), dict(price=2.0, **CAR), dict(stock="S", price=3.0, **CAR)))
    assert [(r["price"], r["batch_rows"]) for r in merged.collect()] == [(3.0, 3)]


def test_two_new_stock_numbers_of_one_model_meet(spark):
    merged = ST.merge_vehicles(empty_state(spark), batch(spark, dict(stock="S1", **CAR), dict(stock="S2", **CAR)))
    assert [r["stock_number"] for r in merged.collect()] == ["S2"]


def test_url_is_part_of_the_second_key(spark):
    merged = ST.merge_vehicles(empty_state(spark), batch(spark, dict(url="/1", **CAR), dict(url="/2", **CAR), dict(**CAR)))
    assert merged.count() == 3


def test_same_batch_twice_changes_no_vehicle_column(spark):
    rows = batch(spark, dict(vin="12345678901", price=1.0), dict(stock="S", **CAR), dict(make="Z", model="Y", year=1999))
    once = saved(spark, ST.merge_vehicles(empty_state(spark), rows))
    twice = ST.state_of(ST.merge_vehicles(once, rows))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    assert ST.duplicate_keys(twice, ["dealer_id", "vehicle_key"]).count() == 0


def test_ledger_keeps_the_first_row(spark):
    schema = "run_id string, url string, status string, ord long"
    ledger = spark.createDataFrame([("r", "u", "ok", 0)], schema)
    again = spark.createDataFrame([("r", "u", "failed", 1), ("r", "v", "ok", 2), ("r", "v", "failed", 3)], schema)
    rows = ST.record_results(ledger, again).select("url", "status").collect()
    assert sorted(map(tuple, rows)) == [("u", "ok"), ("v", "ok")]


def test_run_closes_only_with_a_total(spark):
    schema = "id string, started_at timestamp, finished_at timestamp, total_urls int, urls_ok int, urls_failed int, total_vehicles int, status string"
    runs = spark.createDataFrame([("a", None, None, 2, 0, 0, 0, "running"), ("b", None, None, 0, 0, 0, 0, "running"), ("c", None, None, 9, 0, 0, 0, "running")], schema)
    ledger = spark.createDataFrame([("a", "ok", 3), ("a", "failed", 0), ("b", "ok", 1)], "run_id string, status string, vehicles_found int")
    now = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    got = {r["id"]: (r["urls_ok"], r["urls_failed"], r["total_vehicles"], r["status"]) for r in ST.refresh_runs(runs, ledger, now).collect()}
    assert got == {"a": (1, 1, 3, "finished"), "b": (1, 0, 1, "running"), "c": (0, 0, 0, "running")}


def test_snapshots_keep_older_versions(spark):
    root = work_folder(spark, "snap")
    assert SK.read_snapshot(spark, root) is None
    SK.write_snapshot(spark.range(1), root)
    SK.write_snapshot(SK.read_snapshot(spark, root).union(spark.range(2)), root)
    assert (SK.read_snapshot(spark, root).count(), SK.read_snapshot(spark, root, 1).count()) == (3, 1)
