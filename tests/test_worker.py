"""The message worker: counts per run, lost checkpoints, roll-up by deltas, real captures."""

import json
import os

from pyspark.sql import functions as F

from lotledger.operators import state as ST
from lotledger.plans import inventory_run as IR
from lotledger.plans.state_queries import _as_batch, empty_state
from lotledger.sources import captures as SC
from lotledger.streaming import worker as W


def now():
    return F.to_timestamp(F.lit("2024-02-01 00:00:00"))


def one_vehicle_each(messages):
    """Every message shows one vehicle of its dealer; the vehicle's number is in the URL."""
    dealer = F.xxhash64(F.substring_index("url", "?", 1))
    order = F.regexp_extract("url", r"o=(\d+)", 1).try_cast("long")
    vin = F.concat(F.lit("1FTFW1E50NFA"), F.regexp_extract("url", r"v=(\d+)", 1))
    vehicles = _as_batch(messages.select(
        dealer.alias("dealer_id"), "run_id", order.alias("ord"), vin.alias("vin"), F.lit("api").alias("source_strategy"),
    ))
    results = messages.select(
        "run_id", dealer.alias("dealer_id"), "url", F.lit("api").alias("strategy_used"), F.lit("ok").alias("status"),
        F.lit(1).alias("vehicles_found"), F.lit(None).cast("string").alias("reason"), order.alias("ord"),
    )
    return results, vehicles


def deliver(spark, tmp_path, batches, root, checkpoint, source="in", job=one_vehicle_each):
    folder = tmp_path / source
    folder.mkdir(exist_ok=True)
    worker = W.InventoryWorker(spark, root, job, now())
    for messages in batches:
        name = f"{len(list(folder.iterdir())):03}.txt"
        (folder / name).write_text("".join(json.dumps(m) + "\n" for m in messages))
        worker.run_available(spark.readStream.text(str(folder)), checkpoint)
    return worker


def message(run, url, total=4, platform=None):
    return {"runId": run, "url": url, "totalUrls": total, **({"platform": platform} if platform else {})}


def test_two_runs_of_a_dealer_in_one_batch(spark, tmp_path):
    root = str(tmp_path / "root")
    worker = deliver(spark, tmp_path, [
        [message("r1", "https://d.com?v=10001&o=1"), message("r2", "https://d.com?v=10002&o=2")],
        [message("r2", "https://d.com?v=10001&o=3"), message("r1", "https://d.com?v=10003&o=4")],
    ], root, str(tmp_path / "check"))
    rows = {(r["run_id"], r["url"][-3:]): (r["vehicles_found"], r["vehicles_new"], r["vehicles_updated"]) for r in worker.ledger.read().collect()}
    assert rows == {("r1", "o=1"): (1, 1, 0), ("r2", "o=2"): (1, 1, 0), ("r2", "o=3"): (1, 0, 1), ("r1", "o=4"): (1, 1, 0)}


def test_first_row_inserts_the_others_update_in_their_own_run(spark):
    rows = spark.createDataFrame(
        [(1, "1FTFW1E50NFA00001", "r1", 0), (1, "1FTFW1E50NFA00001", "r2", 1), (1, "1FTFW1E50NFA00001", "r2", 2), (1, "1FTFW1E50NFA00002", "r2", 3)],
        "dealer_id long, vin string, run_id string, ord long").withColumn("source_strategy", F.lit("api"))
    merged = ST.merge_vehicles(empty_state(spark), _as_batch(rows), tally=True)
    got = {r["run_id"]: (r["inserted"], r["updated"]) for r in ST.upsert_counts_by_run(merged).collect()}
    assert got == {"r1": (1, 0), "r2": (1, 2)}


def test_a_lost_checkpoint_at_the_same_path_replaces_nothing(spark, tmp_path):
    root, link = str(tmp_path / "root"), str(tmp_path / "check")
    (tmp_path / "one").mkdir()
    os.symlink(tmp_path / "one", link)
    deliver(spark, tmp_path, [[message("r1", "https://a.com?v=10001&o=1")]], root, link)
    os.unlink(link)
    (tmp_path / "two").mkdir()
    os.symlink(tmp_path / "two", link)  # the same path, nothing behind it
    worker = deliver(spark, tmp_path, [[message("r1", "https://b.com?v=10002&o=2")]], root, link, source="in2")
    assert sorted(r["url"][:13] for r in worker.ledger.read().collect()) == ["https://a.com", "https://b.com"]
    assert worker.vehicles.read().count() == 2 and worker.runs.read().first()["urls_ok"] == 2


def test_a_known_checkpoint_goes_on_with_its_numbers(spark, tmp_path):
    root, check = str(tmp_path / "root"), str(tmp_path / "check")
    deliver(spark, tmp_path, [[message("r1", "https://a.com?v=10001&o=1")]], root, check)
    worker = deliver(spark, tmp_path, [[message("r1", "https://b.com?v=10002&o=2")]], root, check)
    assert W.committed(spark, f"{root}/results", "batch") == [0, 1] and worker.ledger.read().count() == 2


def test_runs_roll_up_from_what_a_batch_adds(spark, tmp_path):
    root = str(tmp_path / "root")
    urls = [f"https://d{i}.com?v=1000{i}&o={i}" for i in range(4)]
    worker = deliver(spark, tmp_path, [
        [message("r1", urls[0]), message("r1", urls[1])], [message("r1", urls[1]), message("r2", urls[1])],
        [message("r1", urls[2]), message("r1", urls[3]), {"runId": "r1"}],
    ], root, str(tmp_path / "check"))
    runs = {r["id"]: (r["urls_ok"], r["total_vehicles"], r["status"], r["results"]) for r in worker.runs.read().collect()}
    assert runs == {"r1": (4, 4, "finished", 4), "r2": (1, 1, "running", 1)}
    plan = worker.runs.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("1 paths") >= 1  # one version, whatever came before


def test_dealers_are_kept_by_the_worker(spark, tmp_path):
    root = str(tmp_path / "root")
    worker = deliver(spark, tmp_path, [
        [message("r1", "https://www.a.com", platform="DealerSync")], [message("r1", "https://www.a.com"), message("r1", "bad")],
    ], root, str(tmp_path / "check"), job=lambda m: (one_vehicle_each(m)[0], None))
    rows = worker.dealers.read().collect()
    assert [(r["base_url"], r["domain"], r["platform"]) for r in rows] == [("https://www.a.com", "a.com", "DealerSync")]


def capture(run, dealer, page, body, kind="text/html", attempt=1):
    return (hash((run, dealer, page)) % 10**9, run, dealer, f"{dealer}/inventory?page={page}", page, 200, kind, body, None, attempt, None)


CAPTURES = (
    "capture_id long, run_id string, dealer_url string, page_url string, page_ord int, status int,"
    " content_type string, body string, error string, attempt int, cname string"
)
CARD = '<article data-vin="1HGCM82633A00435{}">20{:02} Ford Focus with words</article>'


def test_vehicles_come_from_the_captures_of_the_batch(spark, tmp_path):
    caps = [capture(run, f"https://d{d}.com", 0, CARD.format(d, 10 + d)) for run in ("r1", "r2") for d in range(4)]
    SC.write_by_dealer(spark.createDataFrame(caps, CAPTURES), str(tmp_path / "caps"))
    job = IR.captured_job(spark, str(tmp_path / "caps"), now())
    worker = deliver(spark, tmp_path, [
        [message("r1", "https://d0.com"), message("r1", "https://d1.com")],
        [message("r2", "https://d1.com"), message("r1", "https://none.com"), message("r1", "nowhere")],
    ], str(tmp_path / "root"), str(tmp_path / "check"), job=job)
    got = {(r["vin"][-1], r["first_seen_run"], r["last_seen_run"]) for r in worker.vehicles.read().collect()}
    assert got == {("0", "r1", "r1"), ("1", "r1", "r2")}
    rows = {(r["run_id"], r["url"]): (r["status"], r["vehicles_new"], r["vehicles_updated"]) for r in worker.ledger.read().collect()}
    assert rows == {
        ("r1", "https://d0.com"): ("ok", 1, 0), ("r1", "https://d1.com"): ("ok", 1, 0), ("r2", "https://d1.com"): ("ok", 0, 1),
        ("r1", "https://none.com"): ("failed", 0, 0), ("r1", "nowhere"): ("failed", 0, 0),
    }


def test_a_batch_reads_the_folders_of_its_dealers(spark, tmp_path):
    caps = [capture("r1", f"https://d{d}.com", 0, "x") for d in range(50)]
    SC.write_by_dealer(spark.createDataFrame(caps, CAPTURES), str(tmp_path / "caps"))
    one = spark.createDataFrame([("r1", "https://d7.com")], "run_id string, dealer_url string")
    found = SC.of_dealers(spark, str(tmp_path / "caps"), one)
    assert [r["dealer_url"] for r in found.collect()] == ["https://d7.com"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dealer_part" in plan or "PartitionFilters: [(dealer_part" in plan


def test_a_run_tells_what_was_tried(spark, tmp_path):
    page = CARD.format(1, 11)
    rendered = json.dumps({"data": [{"vin": "1HGCM82633A004361", "make": "Kia", "model": "Rio", "price": 5, "year": 2012}]})
    caps = spark.createDataFrame([
        capture("r1", "https://cards.com", 0, page), capture("r1", "https://xhr.com", 0, "<p>nothing</p>"),
        capture("r1", "https://xhr.com", 1, rendered, "application/json", 2), capture("r1", "https://empty.com", 0, "<p>none</p>"),
    ], CAPTURES)
    seeds = spark.createDataFrame([(1, "https://cards.com", None), (2, "https://xhr.com", "OverFuel"), (3, "https://empty.com", None), (4, "mailto:x", None)], "ord int, url string, platform string")
    root = str(tmp_path / "tables")
    answers = spark.createDataFrame([("https://empty.com", '```json\n[{"vin": "1HGCM82633A004371", "make": "Kia", "model": "Rio"}]\n```')], "dealer_url string, text string")
    rows = {r["url"]: r for r in IR.run_inventory(spark, seeds, caps, root, "r1", now(), answers=answers).collect()}
    trace = {u: [(t["strategy"], t["ok"]) for t in json.loads(r["strategies_tried"])] for u, r in rows.items()}
    assert trace == {
        "https://cards.com": [("api", False), ("embedded", False), ("navigate", True)],
        "https://xhr.com": [("platform:OverFuel", False), ("api", False), ("embedded", False), ("navigate", True)],
        "https://empty.com": [("api", False), ("embedded", False), ("navigate", False), ("unlocked", False), ("ai", True)],
        "mailto:x": [("setup", False)],
    }
    assert {u: (r["strategy_used"], r["vehicles_new"]) for u, r in rows.items()} == {
        "https://cards.com": ("navigate", 1), "https://xhr.com": ("navigate", 1), "https://empty.com": ("ai", 1), "mailto:x": ("none", 0)}
    tables = IR.read_tables(spark, root)
    assert tables["dealers"].count() == 3 and tables["vehicles"].count() == 3
    run = tables["runs"].first()
    assert (run["total_urls"], run["urls_ok"], run["urls_failed"], run["status"]) == (4, 3, 1, "finished")
    assert {r["base_url"]: r["platform"] for r in tables["dealers"].collect()}["https://xhr.com"] == "OverFuel"


def test_a_version_is_written_once(spark, tmp_path):
    from lotledger.sources import sinks as SK

    root = str(tmp_path / "table")
    assert SK.write_snapshot(spark.range(3), root) == 1
    (tmp_path / "table" / "v=2").mkdir()  # another writer has begun
    assert SK.write_snapshot(spark.range(4), root) == 3
    assert SK.read_snapshot(spark, root).count() == 4
