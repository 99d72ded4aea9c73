"""Reports over the four tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions import text as X


def last_runs(runs: DataFrame, k: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("id")).limit(k)


def latest_run_results(runs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Results of the run that started last in order of ``id``, reasons cut at 90 characters."""
    latest = runs.agg(F.max_by("id", F.struct("started_at", "id")).alias("run_id"))  # one row
    results = ledger.join(F.broadcast(latest), "run_id", "left_semi").withColumn(
        "reason", F.left("reason", F.lit(90))
    )
    return results.orderBy("id") if "id" in ledger.columns else results


def dealer_counts(dealers: DataFrame, vehicles: DataFrame, k: int = 25) -> DataFrame:
    """Vehicles per dealer, dealers without any included; the top ``k``."""
    counts = vehicles.groupBy(F.col("dealer_id").alias("id")).agg(F.count("*").alias("vehicles"))
    joined = dealers.join(counts, "id", "left").na.fill(0, ["vehicles"])
    return joined.orderBy(F.desc("vehicles"), "id").limit(k)


def latest_vehicles(vehicles: DataFrame, dealers: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` vehicles seen last, with their dealer: top-k first, then the join, so
    at most ``k`` rows are broadcast."""
    top = vehicles.orderBy(F.desc("last_seen_at"), "vehicle_key").limit(k)
    return dealers.select(F.col("id").alias("dealer_id"), "domain").join(
        F.broadcast(top), "dealer_id"
    )


def field_coverage(vehicles: DataFrame) -> DataFrame:
    """Rounded percent of filled values per field, in one pass."""
    total = F.count("*")
    one = vehicles.agg(*[
        X.rounded_share(F.count(c), F.nullif(total, F.lit(0))).alias(c) for c in V.COVERAGE_FIELDS
    ])
    return one.unpivot([], V.COVERAGE_FIELDS, "field", "pct")


def results_by_status(ledger: DataFrame, run_id: str) -> DataFrame:
    return ledger.filter(F.col("run_id") == run_id).orderBy("status", "url")


def sample_vehicles(vehicles: DataFrame, order: list[str], k: int = 3) -> DataFrame:
    return vehicles.orderBy(*order).limit(k)


def export_rows(vehicles: DataFrame) -> DataFrame:
    return vehicles.select(V.EXPORT_FIELDS)
