"""Keyed history: dealers, runs, results, vehicles.

Plain Parquet has no MERGE, so an upsert is a full outer join of state and batch. The
batch is folded to one row per key first (partial aggregation takes care of hot keys), so
neither side of the join ever holds a key twice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import urls as U
from ..schemas import VEHICLE_COLUMNS
from ..session import work_folder
from .keyed import first_by, sized

# Executors get the replay with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEY = ["dealer_id", "vehicle_key"]
_SEEN = ["first_seen_run", "last_seen_run", "first_seen_at", "last_seen_at"]
STATE_COLUMNS = [*_KEY, *VEHICLE_COLUMNS, "source_strategy", *_SEEN]


# --- dealers and runs -----------------------------------------------------------

def upsert_dealers(dealers: DataFrame, batch: DataFrame) -> DataFrame:
    """``batch``: ``base_url, name, platform, seen_at, ord``. The name is only set at
    insert; the platform only changes to a known one."""
    fold = batch.groupBy("base_url").agg(
        F.min_by("name", "ord").alias("b_name"),
        F.expr("max_by(platform, ord) FILTER (WHERE platform IS NOT NULL)").alias("b_platform"),
        F.min("seen_at").alias("b_first"), F.max("seen_at").alias("b_last"),
    )
    joined = dealers.join(fold, "base_url", "full_outer")
    is_new = F.col("id").isNull()
    domain = U.domain(F.col("base_url"))
    return joined.select(
        F.coalesce("id", F.xxhash64("base_url")).alias("id"),
        F.when(is_new, F.coalesce("b_name", domain)).otherwise(F.col("name")).alias("name"),
        "base_url",
        F.coalesce("domain", domain).alias("domain"),
        F.coalesce("b_platform", "platform").alias("platform"),
        F.coalesce("created_at", "b_first").alias("created_at"),
        F.coalesce("b_last", "updated_at").alias("updated_at"),
    )


def set_platforms(dealers: DataFrame, found: DataFrame) -> DataFrame:
    """``found``: ``base_url, platform, prio``. The known platform and the page test both
    write; the later layer's write stays."""
    last = found.filter("platform is not null").groupBy("base_url").agg(
        F.max_by("platform", "prio").alias("_p")
    )
    return dealers.join(last, "base_url", "left").withColumn(
        "platform", F.coalesce("_p", "platform")
    ).drop("_p")


def ensure_runs(runs: DataFrame, opened: DataFrame) -> DataFrame:
    """``opened``: ``run_id, total_urls, seen_at``. New runs start, known ones keep the
    larger total."""
    fold = opened.groupBy("run_id").agg(
        F.max(F.coalesce("total_urls", F.lit(0))).alias("_total"), F.min("seen_at").alias("_at")
    )
    joined = runs.join(fold.withColumnRenamed("run_id", "id"), "id", "full_outer")
    zero = F.lit(0)
    return joined.select(
        "id", F.coalesce("started_at", "_at").alias("started_at"), "finished_at",
        F.greatest("total_urls", "_total").alias("total_urls"),
        *[F.coalesce(c, zero).alias(c) for c in ("urls_ok", "urls_failed", "total_vehicles")],
        F.coalesce("status", F.lit("running")).alias("status"),
    )


def new_results(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the batch the ledger does not have: the first per (run, url)."""
    first = first_by(batch, ["run_id", "url"], [F.col("ord")])
    return first.join(ledger.select("run_id", "url"), ["run_id", "url"], "left_anti")


def record_results(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    return ledger.unionByName(new_results(ledger, batch).select(ledger.columns))


def refresh_runs(runs: DataFrame, ledger: DataFrame, now: Column) -> DataFrame:
    """Totals of each run; a run closes once it has as many results as URLs."""
    sums = ledger.groupBy(F.col("run_id").alias("id")).agg(
        F.count("*").alias("_cnt"), F.count_if(F.col("status") == "ok").alias("_ok"),
        F.count_if(F.col("status") == "failed").alias("_failed"),
        F.sum("vehicles_found").alias("_veh"),
    )
    joined = runs.join(sums, "id", "left").na.fill(0, ["_cnt", "_ok", "_failed", "_veh"])
    closes = (F.col("_cnt") >= F.col("total_urls")) & (F.col("total_urls") > 0)
    return joined.select(
        "id", "started_at", F.when(closes, now).otherwise(F.col("finished_at")).alias("finished_at"),
        "total_urls", F.col("_ok").cast("int").alias("urls_ok"),
        F.col("_failed").cast("int").alias("urls_failed"),
        F.col("_veh").cast("int").alias("total_vehicles"),
        F.when(closes, "finished").otherwise(F.col("status")).alias("status"),
    )


def result_sums(results: DataFrame) -> DataFrame:
    """``id, results, ok, failed, found`` of ledger rows: sums that add up over batches."""
    return results.groupBy(F.col("run_id").alias("id")).agg(
        F.count("*").alias("results"), F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum(F.coalesce("vehicles_found", F.lit(0))).alias("found"),
    )


def roll_up(runs: DataFrame, opened: DataFrame, added: DataFrame, now: Column) -> DataFrame:
    """Runs after a batch, from what the batch adds: no earlier ledger row is read.

    ``runs`` carries ``results``, the number of results so far, ``opened`` is as in
    ``ensure_runs``, ``added`` the ``result_sums`` of newly recorded rows.
    """
    sums = runs.select("id", F.col("results").alias("_results"))
    joined = (
        ensure_runs(runs, opened).join(sums, "id", "left").join(added, "id", "left")
        .na.fill(0, ["_results", "results", "ok", "failed", "found"])
        .withColumn("_results", F.col("_results") + F.col("results"))
    )
    closes = (F.col("_results") >= F.col("total_urls")) & (F.col("total_urls") > 0)
    touched = F.col("results") > 0
    return joined.select(
        "id", "started_at", F.when(closes & touched, now).otherwise(F.col("finished_at")).alias("finished_at"),
        "total_urls", (F.col("urls_ok") + F.col("ok")).cast("int").alias("urls_ok"),
        (F.col("urls_failed") + F.col("failed")).cast("int").alias("urls_failed"),
        (F.col("total_vehicles") + F.col("found")).cast("int").alias("total_vehicles"),
        F.when(closes & touched, "finished").otherwise(F.col("status")).alias("status"),
        F.col("_results").alias("results"),
    )


# --- vehicles ---------------------------------------------------------------------

def fold_batch(batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: of each column the last non-NULL value, in batch order."""
    return batch.groupBy(*keys).agg(
        *[
            F.expr(f"max_by({c}, ord) FILTER (WHERE {c} IS NOT NULL)").alias(c)
            for c in VEHICLE_COLUMNS if c not in keys
        ],
        F.max_by("source_strategy", "ord").alias("source_strategy"),
        F.min_by("run_id", "ord").alias("first_run"), F.max_by("run_id", "ord").alias("last_run"),
        F.min("seen_at").alias("first_at"), F.max("seen_at").alias("last_at"),
        F.sum("rows").alias("rows"), F.min("ord").alias("ord"),
    )


def fold_repeats(keyed: DataFrame) -> DataFrame:
    """``fold_batch`` by ``dealer_id, vehicle_key``, of the keys that repeat alone.

    Keys are counted first. Rows whose key stands once are their own fold and pass straight
    through; while the repeated keys are few enough to be broadcast, no wide row is sorted
    or moved for it. Where they are not, most rows repeat, and all are folded.
    """
    often = _round(keyed.groupBy(*_KEY).agg(F.count("*").alias("n")).filter("n > 1").select(*_KEY))
    few = sized(often)
    if few is often:
        return fold_batch(keyed, _KEY)
    folded = fold_batch(keyed.join(few, _KEY, "left_semi"), _KEY)
    own = {"first_run": "run_id", "last_run": "run_id", "first_at": "seen_at", "last_at": "seen_at"}
    alone = keyed.join(few, _KEY, "left_anti").select(
        *[F.col(own.get(c, c)).cast(folded.schema[c].dataType).alias(c) for c in folded.columns]
    )
    return alone.unionByName(folded)


def resolve_without_vin(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Give each row without VIN its ``vehicle_key``, as if the rows came one after the other.

    A row belongs to the vehicle that has its stock number at that moment, else to the one
    with its make, model, year and URL, else it is a new one; a vehicle takes over what its
    rows say, so both keys of it can change on the way. Rows that cannot meet through any
    chain of keys lie in different components; a component is replayed in order, its rows
    streamed past the vehicles they made.
    """
    owners = batch.select("dealer_id").distinct()
    known = state.filter("vin is null").join(owners, "dealer_id", "left_semi")
    nodes = [
        F.when(F.coalesce(F.col(c), F.lit("")) != "", F.xxhash64(F.lit(c), "dealer_id", c)).alias(f"_{c}")
        for c in ("stock_number", "model")
    ]
    columns = [f.name for f in batch.schema]
    rows = batch.select("*", F.lit(None).cast("string").alias("vehicle_key"), F.lit(1).alias("_late"), *nodes)
    old = known.select(
        *[F.col(c) if c in known.columns else F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in columns],
        "vehicle_key", F.lit(0).alias("_late"), *nodes,
    )
    every = rows.unionByName(old)
    linked = every.filter("_stock_number is not null and _model is not null").select("_stock_number", "_model").distinct()
    labels = key_components(linked)
    node = F.coalesce("_stock_number", "_model")
    # Most keys meet no other: their own hash is their component.
    placed = every.withColumn("_node", node).join(
        labels, F.col("_node") == F.col("node"), "left"
    ).withColumn("_component", F.coalesce("component", "_node", F.xxhash64("dealer_id", "ord", "run_id")))
    placed = placed.drop("node", "component", "_node", "_stock_number", "_model")
    keys = ["_component", "_late", "ord", "vehicle_key"]
    replayed = placed.repartition("_component").sortWithinPartitions(*keys).mapInArrow(
        replay, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    )
    return replayed.filter("_late = 1").select(*columns, "vehicle_key")


def key_components(pairs: DataFrame) -> DataFrame:
    """``node, component`` for pairs of keys: every key's smallest key within reach.

    In rounds, each key takes the smallest label of its neighbours and then its label's own
    label; a round is a written table, and the last one changes nothing.
    """
    pairs = pairs.toDF("a", "b")
    both = _round(pairs.unionAll(pairs.select("b", "a")))
    now = _round(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    if now.isEmpty():
        return now
    while True:
        near = both.join(now, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        least = now.join(near, "node").select("node", F.least("component", "near").alias("low"), "component")
        onward = now.select(F.col("node").alias("low"), F.col("component").alias("onward"))
        after = _round(least.join(onward, "low", "left").select(
            "node", F.least("low", F.coalesce("onward", "low")).alias("new"), "component"
        ))
        now = after.select("node", F.col("new").alias("component"))
        if after.filter("new <> component").isEmpty():
            return now


def _round(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = work_folder(spark, "keys")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by component and order, with the ``vehicle_key`` each one falls to.

    Of a component the vehicles are held, each with its present stock number, make, model,
    year and URL; of several that fit, the first one counts.
    """
    component, vehicles, by_stock, by_model = None, [], {}, {}

    def model_key(v: list) -> tuple | None:
        _, _, make, model, year, url = v
        return (make, model, year, url or "") if make and model and year else None

    def place(at: int, add: bool) -> None:
        for shelf, key in ((by_stock, vehicles[at][1] or None), (by_model, model_key(vehicles[at]))):
            if key is not None:
                held = shelf.setdefault(key, set())
                held.add(at) if add else held.discard(at)

    for batch in batches:
        names = batch.schema.names
        own = {c: batch.column(c).to_pylist() for c in (
            "_component", "_late", "vehicle_key", "dealer_id", "run_id", "ord", "stock_number", "make", "model", "year", "url")}
        keys = []
        for i in range(batch.num_rows):
            if own["_component"][i] != component:
                component, vehicles, by_stock, by_model = own["_component"][i], [], {}, {}
            said = [own[c][i] for c in ("stock_number", "make", "model", "year", "url")]
            key = own["vehicle_key"][i]
            if own["_late"][i]:
                fits = by_stock.get(said[0]) if said[0] else None
                fits = fits or by_model.get(model_key([None, *said]))
                if fits:
                    at = min(fits)
                    place(at, False)
                    vehicles[at][1:] = [old if new is None else new for old, new in zip(vehicles[at][1:], said)]
                    place(at, True)
                    keys.append(vehicles[at][0])
                    continue
                key = f"new:{own['run_id'][i]}:{own['ord'][i]}"
            vehicles.append([key, *said])
            place(len(vehicles) - 1, True)
            keys.append(key)
        columns = [pa.array(keys, pa.string()) if n == "vehicle_key" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(columns, names)


def run_tally(keyed: DataFrame) -> DataFrame:
    """``dealer_id, vehicle_key, tally``: how many rows of each run a vehicle got.

    Two steps of partial aggregation; the map of a vehicle has one entry per run of the batch.
    """
    per_run = keyed.groupBy(*_KEY, "run_id").agg(F.sum("rows").alias("n"))
    entry = F.struct("run_id", "n")
    return per_run.groupBy(*_KEY).agg(F.map_from_entries(F.collect_list(entry)).alias("tally"))


def merge_vehicles(state: DataFrame, batch: DataFrame, tally: bool = False) -> DataFrame:
    """State after the batch, plus ``batch_rows`` (rows of the batch on this vehicle,
    NULL if untouched), ``is_new`` and, if asked for, ``tally`` (rows of the batch by run).

    ``batch``: ``dealer_id``, the 23 vehicle columns, ``source_strategy, run_id, seen_at,
    ord``; ``ord`` is the order the rows are applied in. A new value never erases an old
    one with NULL.
    """
    batch = batch.withColumn("rows", F.lit(1).cast("bigint"))
    has_vin = F.coalesce(F.col("vin"), F.lit("")) != ""
    with_vin = batch.filter(has_vin).withColumn("vehicle_key", F.concat(F.lit("vin:"), F.col("vin")))
    columns = [*_KEY, *VEHICLE_COLUMNS, "source_strategy", "run_id", "seen_at", "rows", "ord"]
    keyed, bare = with_vin.select(columns), batch.filter(~has_vin)
    if not bare.isEmpty():
        keyed = keyed.unionByName(resolve_without_vin(state, bare).select(columns))
    fold = fold_repeats(keyed)
    if tally:
        fold = fold.join(run_tally(keyed), _KEY)
    fold = fold.select(*_KEY, *[F.col(c).alias(f"n_{c}") for c in fold.columns if c not in _KEY])
    known = state.select(*STATE_COLUMNS, F.lit(True).alias("_known"))
    joined = known.join(fold, _KEY, "full_outer")
    is_new = F.col("_known").isNull()
    return joined.select(
        *_KEY,
        *[F.coalesce(f"n_{c}", c).alias(c) for c in VEHICLE_COLUMNS],
        F.coalesce("n_source_strategy", "source_strategy").alias("source_strategy"),
        F.coalesce("first_seen_run", "n_first_run").alias("first_seen_run"),
        F.coalesce("n_last_run", "last_seen_run").alias("last_seen_run"),
        F.coalesce("first_seen_at", "n_first_at").alias("first_seen_at"),
        F.coalesce("n_last_at", "last_seen_at").alias("last_seen_at"),
        F.col("n_rows").alias("batch_rows"), is_new.alias("is_new"),
        *([F.col("n_tally").alias("tally")] if tally else []),
    )


def upsert_counts_by_run(merged: DataFrame) -> DataFrame:
    """``run_id, dealer_id, inserted, updated`` of vehicles merged with their tally.

    The first row of a new vehicle inserts, in the run that saw it first; each further row
    updates, in its own run.
    """
    rows = merged.filter("tally is not null").select(
        "dealer_id", "is_new", "first_seen_run", F.explode("tally").alias("run_id", "n")
    )
    fresh = (F.col("is_new") & (F.col("run_id") == F.col("first_seen_run"))).cast("bigint")
    return rows.groupBy("run_id", "dealer_id").agg(
        F.sum(fresh).alias("inserted"), F.sum(F.col("n") - fresh).alias("updated")
    )


def upsert_counts(merged: DataFrame) -> DataFrame:
    """Per dealer how many rows inserted and how many updated a vehicle: the first row
    of a new vehicle inserts, each further row updates.

    Write ``merged`` and read it back before counting, so the join runs once.
    """
    touched = merged.filter("batch_rows is not null")
    fresh = F.col("is_new").cast("bigint")
    return touched.groupBy("dealer_id").agg(
        F.sum(fresh).alias("inserted"), F.sum(F.col("batch_rows") - fresh).alias("updated")
    )


def state_of(merged: DataFrame) -> DataFrame:
    return merged.select(STATE_COLUMNS)


def left_inventory(state: DataFrame, runs: DataFrame) -> DataFrame:
    """Vehicles the latest run did not see. Rows without a last run are left out."""
    latest = runs.agg(F.max_by("id", F.struct("started_at", "id")).alias("_latest"))  # one row
    return state.join(F.broadcast(latest), F.col("last_seen_run") != F.col("_latest")).drop("_latest")


# --- invariants -------------------------------------------------------------------

def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held more than once: empty on sound tables."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose reference has no parent."""
    keys = parent.select(F.col(parent_key).alias(column))
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")
