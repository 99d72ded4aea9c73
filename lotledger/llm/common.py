"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only where that is unset and the master is local, as in tests, a folder of this
    process is taken and kept in the session for later calls.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "lotledger.local.work", None
    )
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="lotledger-llm-")
        spark.conf.set("lotledger.local.work", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# Arrow batches between the JVM and Python are held on both sides, by every task at once.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From here on the session's Arrow batches are at most ``BATCH_BYTES`` large."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read back.

    Cuts the lineage: what follows survives lost executors and never computes ``df`` again.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    folder = shared_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def forget(df: DataFrame) -> None:
    """Delete the folder of a settled table that is no longer read."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, mod ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with as many underscores before it as make it a new column."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


# Rows of a few numbers up to which a side may be broadcast: some 50 MB.
BROADCAST_ROWS = 1_000_000


def by_size(small: DataFrame) -> DataFrame:
    """A written table of ids and numbers, marked for broadcast if its rows are few enough.

    Beyond the limit the join is left to a shuffle of both sides.
    """
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small
