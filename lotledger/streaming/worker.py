"""The message worker as Structured Streaming.

Messages ``{runId, url, platform, totalUrls}`` arrive at least once and in any grouping.
Each micro-batch parses them, runs the extraction job given by the caller, upserts dealers and
vehicles, appends to the ledger and adds its counts to the runs. All tables are keyed by batch
id, so a replayed batch writes the same rows to the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import urls as U
from ..operators import cascade, state
from ..schemas import MESSAGE_SCHEMA, VEHICLE_TYPES
from ..sources.sinks import BatchLog, BatchTable, committed

_VEHICLE_SCHEMA = ", ".join(
    ["dealer_id bigint", "vehicle_key string"]
    + [f"{n} {t}" for n, t in VEHICLE_TYPES.items()]
    + ["source_strategy string", "first_seen_run string", "last_seen_run string",
       "first_seen_at timestamp", "last_seen_at timestamp", "batch_rows bigint", "is_new boolean",
       "tally map<string,bigint>"]
)
_OF_BATCH = ["batch_rows", "is_new", "tally"]
_LEDGER_SCHEMA = (
    "run_id string, dealer_id bigint, url string, strategy_used string, strategies_tried string, status string,"
    " vehicles_found int, vehicles_new int, vehicles_updated int, reason string, duration_ms int, worker_id string"
)
_RUN_SCHEMA = (
    "id string, started_at timestamp, finished_at timestamp, total_urls int, urls_ok int,"
    " urls_failed int, total_vehicles int, status string"
)
_RUN_TABLE_SCHEMA = _RUN_SCHEMA + ", results bigint"
_DEALER_SCHEMA = (
    "id bigint, name string, base_url string, domain string, platform string, created_at timestamp,"
    " updated_at timestamp"
)
LEDGER_COLUMNS = [c.split()[0] for c in _LEDGER_SCHEMA.split(", ")]


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Adds the message fields and ``good``: JSON with a run id and a URL."""
    parsed = raw.withColumn("_m", F.from_json(value, MESSAGE_SCHEMA))
    good = (F.coalesce("_m.runId", F.lit("")) != "") & (F.coalesce("_m.url", F.lit("")) != "")
    return parsed.select(
        *raw.columns, F.col("_m.runId").alias("run_id"), F.col("_m.url").alias("url"),
        F.nullif(F.col("_m.platform"), F.lit("")).alias("platform"),
        F.coalesce("_m.totalUrls", F.lit(0)).alias("total_urls"), good.alias("good"),
    )


def dedupe_in_stream(messages: DataFrame, time: str = "captured_at", delay: str = "1 hour") -> DataFrame:
    """Drop redeliveries within the watermark before any work is done on them. State is
    bounded by the delay; the ledger still guards against later ones."""
    return messages.withWatermark(time, delay).dropDuplicatesWithinWatermark(["run_id", "url"])


def ledger_columns(results: DataFrame) -> DataFrame:
    """The stored columns of result rows; the trace as JSON text, what a job leaves out NULL."""
    found = results
    if "strategies_tried" in found.columns and found.schema["strategies_tried"].dataType.typeName() == "array":
        found = found.withColumn("strategies_tried", F.to_json("strategies_tried"))
    for column in _LEDGER_SCHEMA.split(", "):
        name, kind = column.split()
        if name not in found.columns:
            found = found.withColumn(name, F.lit(None).cast(kind))
    return found


class InventoryWorker:
    """``foreachBatch`` body.

    ``job(messages)`` returns ``(results, vehicles)``: ledger rows with ``ord`` and, or
    None, vehicle rows as ``state.merge_vehicles`` takes them. Both are written once per
    batch and read from there.
    """

    def __init__(self, spark: SparkSession, root: str,
                 job: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]],
                 now: Column | None = None):
        self.spark, self.root, self.job = spark, root, job
        self.now = F.current_timestamp() if now is None else now
        self.vehicles = BatchLog(
            spark, f"{root}/vehicles", ["dealer_id", "vehicle_key"], ["dealer_id"], _VEHICLE_SCHEMA
        )
        # Results are looked up by run and URL alone, so a batch reads only the buckets of its own.
        self.ledger = BatchLog(spark, f"{root}/results", ["run_id", "url"], ["run_id", "url"], _LEDGER_SCHEMA)
        self.runs = BatchTable(spark, f"{root}/runs", _RUN_TABLE_SCHEMA)
        self.dealers = BatchLog(spark, f"{root}/dealers", ["base_url"], ["base_url"], _DEALER_SCHEMA)
        self.base = 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch_id += self.base
        # A large file of messages is read by one task; all that follows would be, too.
        dealt = batch.repartition(self.spark.sparkContext.defaultParallelism)
        parsed = parse_messages(dealt).persist()
        try:
            parsed.filter("not good").select("value").write.mode("overwrite").text(
                f"{self.root}/bad/batch={batch_id}"
            )
            self._apply(parsed.filter("good"), batch_id)
        finally:
            parsed.unpersist()

    def _kept(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        """The rows of a step, written in the batch's own folder and read back."""
        path = f"{self.root}/work/{name}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _apply(self, messages: DataFrame, batch_id: int) -> None:
        made, vehicles = self.job(messages)
        results = self._kept(ledger_columns(made), "results", batch_id)
        self._see_dealers(messages, results, batch_id)
        if vehicles is not None:
            results = self._upsert(results, self._kept(vehicles, "vehicles", batch_id), batch_id)
        before = self.ledger.read(batch_id, self.ledger.touched(results))
        self.ledger.write(state.new_results(before, results).select(LEDGER_COLUMNS), batch_id)
        recorded = self.ledger.read_batch(batch_id)
        opened = messages.select("run_id", "total_urls", self.now.alias("seen_at"))
        runs = state.roll_up(self.runs.read(batch_id), opened, state.result_sums(recorded), self.now)
        self.runs.write(runs, batch_id)

    def _see_dealers(self, messages: DataFrame, results: DataFrame, batch_id: int) -> None:
        """Dealers of the batch: known ones keep their name, platforms a message names stay."""
        seen = messages.filter(U.is_web_url(F.col("url"))).select(
            F.col("url").alias("base_url"), F.lit(None).cast("string").alias("name"), "platform",
            self.now.alias("seen_at"), F.lit(0).alias("ord"),
        )
        buckets = self.dealers.touched(seen)
        known = self.dealers.read(batch_id, buckets).join(seen.select("base_url").distinct(), "base_url", "left_semi")
        self.dealers.write(state.upsert_dealers(known, seen), batch_id)

    def _upsert(self, results: DataFrame, vehicles: DataFrame, batch_id: int) -> DataFrame:
        buckets = self.vehicles.touched(vehicles.select("dealer_id").distinct())
        known = self.vehicles.read(batch_id, buckets).drop(*_OF_BATCH)
        merged = state.merge_vehicles(known, vehicles, tally=True).filter("batch_rows is not null")
        self.vehicles.write(merged, batch_id)
        counts = state.upsert_counts_by_run(self.vehicles.read_batch(batch_id))
        return cascade.with_upsert_counts(results, counts)

    def _first_number(self, checkpoint: str) -> int:
        """The number this stream's batch 0 gets.

        It is kept inside the checkpoint folder, so it lives and dies with the batch numbers
        Spark counts there. A checkpoint without one, be it new or made anew at the path of a
        lost one, starts after all batches that are there.
        """
        known = committed(self.spark, f"{checkpoint}/worker", "base")
        if known:
            return known[-1]
        logs = (self.vehicles, self.ledger, self.runs, self.dealers)
        base = max((n for log in logs for n in committed(self.spark, log.root, "batch")), default=-1) + 1
        self.spark.range(1).write.parquet(f"{checkpoint}/worker/base={base}")
        return base

    def run_available(self, stream: DataFrame, checkpoint: str) -> None:
        """Process everything that has arrived, then stop.

        Another stream on the same root, or one whose checkpoint was lost, never replaces
        rows; a known checkpoint goes on with its own numbers. One stream at a time writes a
        root.
        """
        self.base = self._first_number(checkpoint)
        query = (
            stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
