"""Sinks: CSV and text outputs, versioned table snapshots, and a per-batch log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.keyed import first_by


# --- files ------------------------------------------------------------------------

def write_platform_map(df: DataFrame, path: str) -> None:
    df.select("url", "platform", "via", "cname").na.fill("").write.csv(
        path, header=True, emptyValue=""
    )


def write_layers(df: DataFrame, path: str, columns: list[str]) -> None:
    """``url, platform, layer`` or ``url, layer2``."""
    df.select(columns).write.csv(path, header=True)


def write_tagged_seeds(df: DataFrame, path: str) -> None:
    """``url[,tag]`` lines."""
    df.select(F.concat_ws(",", "url", "tag").alias("value")).write.text(path)


def write_vendor_tally(df: DataFrame, path: str) -> None:
    df.orderBy(F.desc("n"), "vendor").select("n", "vendor").write.csv(path, sep="\t")


# --- versioned snapshots -------------------------------------------------------------

def committed(spark: SparkSession, root: str, prefix: str, begun: bool = False) -> list[int]:
    """Numbers of the committed ``<prefix>=<n>`` folders, or of all that were ``begun``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(
        int(n.split("=")[1]) for n in names
        if n.startswith(prefix + "=") and (begun or fs.exists(done(f"{root}/{n}/_SUCCESS")))
    )


def write_snapshot(df: DataFrame, root: str) -> int:
    """Write the next version. A version counts once its commit marker is there. No folder is
    ever overwritten: of two writers that take the same number, the later one fails."""
    version = max(committed(df.sparkSession, root, "v", begun=True), default=0) + 1
    df.write.mode("errorifexists").parquet(f"{root}/v={version}")
    return version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    versions = committed(spark, root, "v")
    if not versions:
        return None
    return spark.read.parquet(f"{root}/v={version or versions[-1]}")


class BatchTable:
    """A small table, written whole by each batch: ``batch=<id>``.

    A batch reads the newest version before its own number, however many there are.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root, schema

    def read(self, before: int | None = None) -> DataFrame:
        done = [n for n in committed(self.spark, self.root, "batch") if before is None or n < before]
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/batch={done[-1]}")

    def write(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")


# --- per-batch log ---------------------------------------------------------------------

class BatchLog:
    """Rows of a keyed table as written by each micro-batch: ``batch=<id>/bucket=<b>``.

    A batch writes only the keys it touches and reads only the buckets they fall into;
    the newest row per key is the current one. Replaying a batch rewrites its own folder
    from the rows before it, which gives the same rows again.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], bucket_by: list[str],
                 schema: str, buckets: int = 64):
        self.spark, self.root, self.keys = spark, root, keys
        self.bucket_by, self.schema, self.buckets = bucket_by, schema, buckets

    def bucket(self):
        return F.pmod(F.xxhash64(*[F.col(c) for c in self.bucket_by]), F.lit(self.buckets)).cast("int")

    def touched(self, df: DataFrame) -> list[int]:
        """Bucket numbers of a batch: at most ``buckets`` integers."""
        return [r[0] for r in df.select(self.bucket().alias("b")).distinct().collect()]

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        done = [n for n in committed(self.spark, self.root, "batch") if before is None or n < before]
        if not done:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.option("basePath", self.root).schema(
            self.schema + ", batch bigint, bucket int"
        ).parquet(*[f"{self.root}/batch={n}" for n in done])
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin(buckets))
        return first_by(rows, self.keys, [F.desc("batch")]).drop("batch", "bucket")

    def read_batch(self, batch: int) -> DataFrame:
        """The rows one batch wrote."""
        rows = self.spark.read.schema(self.schema + ", bucket int").parquet(f"{self.root}/batch={batch}")
        return rows.drop("bucket")

    def write(self, df: DataFrame, batch: int) -> None:
        # Rows of a bucket meet in one file, or in several where a bucket is large.
        df.withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.root}/batch={batch}"
        )
