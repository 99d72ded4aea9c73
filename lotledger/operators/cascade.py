"""One winning extraction layer per dealer, with a trace of what was tried.

Layers are tiny rows; vehicles are many and a dealer may own a third of them. So the
winner is decided on the layer rows and joined to the vehicles by salted key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions import urls as U
from .keyed import BROADCAST_KEYS, beside, join_on_hot_keys

OWNER = ["run_id", "dealer_url"]


def priority(strategy: Column) -> Column:
    kind = F.get(F.split(strategy, ":"), 0)
    return F.coalesce(*[
        F.when(kind == name, F.lit(prio)) for name, prio in V.STRATEGY_PRIORITY.items()
    ])


def winners(layers: DataFrame) -> DataFrame:
    """Per run and dealer the lowest-priority layer that found vehicles."""
    hit = F.when(F.col("ok") & (F.col("n") > 0), F.struct("prio", "strategy", "reason", "n"))
    return layers.groupBy(*OWNER).agg(F.min(hit).alias("_w")).select(
        *OWNER, F.col("_w.prio").alias("win_prio"), F.col("_w.strategy").alias("win_strategy"),
        F.col("_w.reason").alias("win_reason"), F.col("_w.n").alias("win_n"),
    )


def winning_vehicles(vehicles: DataFrame, won: DataFrame, spread: list[str]) -> DataFrame:
    """Vehicles (with ``prio``) of the winning layer only."""
    short = won.filter("win_prio is not null").select(*OWNER, F.col("win_prio").alias("prio"))
    return join_on_hot_keys(vehicles, short, [*OWNER, "prio"], spread, "left_semi")


def unsolved(captures: DataFrame, solved: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """Captures of dealers no cheaper layer has solved: what a costly layer still reads.

    Up to ``most`` keys are broadcast. More are hashed by bucket; captures stored by
    ``stored_by_owner`` then stay where they lie, unsorted.
    """
    return captures.join(beside(solved.select(*OWNER).distinct(), most), OWNER, "left_anti")


def first_hit(vehicles: DataFrame, place: str, spread: list[str], owner: list[str] = OWNER) -> DataFrame:
    """Vehicles of the first page, endpoint or source (``place``) that has any."""
    least = vehicles.groupBy(*owner).agg(F.min(place).alias("_least"))
    kept = join_on_hot_keys(vehicles, least, owner, spread)
    return kept.filter(F.col(place) == F.col("_least")).drop("_least")


def traces(layers: DataFrame, attempts: int | None = None) -> DataFrame:
    """Per run and dealer the layers tried in order, up to and including the winner.

    A dealer has at most six layers, so the list is short. Of a layer's attempts all are
    kept, or the first ``attempts`` where that is given.
    """
    kept = F.col("attempts") if attempts is None else F.slice("attempts", 1, attempts)
    entry = F.struct("prio", "strategy", "ok", "reason", kept.alias("attempts"))
    hit = F.when(F.col("ok") & (F.col("n") > 0), F.col("prio"))
    listed = layers.groupBy(*OWNER).agg(
        F.sort_array(F.collect_list(entry)).alias("_all"), F.min(hit).alias("_win")
    )
    kept = F.filter("_all", lambda e: F.col("_win").isNull() | (e["prio"] <= F.col("_win")))
    return listed.select(
        *OWNER,
        F.transform(kept, lambda e: F.struct(
            e["strategy"].alias("strategy"), e["ok"].alias("ok"),
            e["reason"].alias("reason"), e["attempts"].alias("attempts"),
        )).alias("strategies_tried"),
    )


def failure_reason(tried: Column) -> Column:
    return F.array_join(
        F.transform(tried, lambda t: F.concat(F.lit("["), t["strategy"], F.lit("] "), F.coalesce(t["reason"], F.lit("")))),
        " || ",
    )


def result_rows(layers: DataFrame, worker_id: str = "spark") -> DataFrame:
    """The ledger row of each dealer."""
    joined = traces(layers).join(winners(layers), OWNER)
    ok = F.col("win_prio").isNotNull()
    # a platform layer is recorded by its platform label
    used = F.regexp_replace("win_strategy", "^platform:", "")
    return joined.select(
        "run_id",
        F.when(U.is_web_url(F.col("dealer_url")), F.xxhash64("dealer_url")).alias("dealer_id"),
        F.col("dealer_url").alias("url"),
        F.coalesce(used, F.lit("none")).alias("strategy_used"),
        "strategies_tried",
        F.when(ok, "ok").otherwise("failed").alias("status"),
        F.coalesce("win_n", F.lit(0)).cast("int").alias("vehicles_found"),
        F.lit(0).alias("vehicles_new"), F.lit(0).alias("vehicles_updated"),
        F.when(ok, F.col("win_reason")).otherwise(failure_reason(F.col("strategies_tried"))).alias("reason"),
        F.lit(None).cast("int").alias("duration_ms"), F.lit(worker_id).alias("worker_id"),
    )


def invalid_seed_rows(seeds: DataFrame, run_id: str | None = None, worker_id: str = "spark") -> DataFrame:
    """Seeds no dealer can be made of become failed rows, not lost rows.

    The run is ``run_id`` or, without one, the column of this name.
    """
    run = F.col("run_id") if run_id is None else F.lit(run_id)
    why = F.concat(F.lit("URL inválida: "), F.col("url"))
    trace = F.array(F.struct(
        F.lit("setup").alias("strategy"), F.lit(False).alias("ok"), why.alias("reason"),
        F.array().cast("array<string>").alias("attempts"),
    ))
    return seeds.filter(~U.is_web_url(F.col("url"))).select(
        run.alias("run_id"), F.lit(None).cast("bigint").alias("dealer_id"), "url",
        F.lit("none").alias("strategy_used"), trace.alias("strategies_tried"),
        F.lit("failed").alias("status"), F.lit(0).alias("vehicles_found"),
        F.lit(0).alias("vehicles_new"), F.lit(0).alias("vehicles_updated"), why.alias("reason"),
        F.lit(None).cast("int").alias("duration_ms"), F.lit(worker_id).alias("worker_id"),
    )


def with_upsert_counts(results: DataFrame, counts: DataFrame) -> DataFrame:
    """Put the upsert's ``(run_id, dealer_id, inserted, updated)`` into the ledger rows."""
    return (
        results.join(counts, ["run_id", "dealer_id"], "left")
        .withColumns({
            "vehicles_new": F.coalesce(F.col("inserted"), F.lit(0)).cast("int"),
            "vehicles_updated": F.coalesce(F.col("updated"), F.lit(0)).cast("int"),
        })
        .drop("inserted", "updated")
    )
