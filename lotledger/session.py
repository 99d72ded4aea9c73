"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the operators rely on. All can be set on a live session.
RUNTIME_CONF = {
    # JSON documents may repeat a key; the last one wins, as in JSON.parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rank-limit filters (first row per key, top 2000 per dealer) are cut on the map
    # side up to this rank, so a hot key ships at most `rank` rows per map task.
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
    # Parsing costs far more per byte than a scan: let small shuffles keep all cores busy.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Bodies are wide rows: keep input splits small, and what is decoded or sent to Python at once.
    "spark.sql.files.maxPartitionBytes": str(64 << 20),
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "lotledger", master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        cores = "".join(ch for ch in master if ch.isdigit()) or "8"
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", cores)
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.driver.memory", os.environ.get("LOTLEDGER_DRIVER_MEMORY", "8g"))
        )
    return configure(builder.getOrCreate())


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables and stream state.

    On a cluster it lies under ``spark.checkpoint.dir``; a machine-local folder is
    used only where that is unset and the master is local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lotledger-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
