"""Incremental state over content hashes, in batch and as a stream.

State rows: resource, hash, observed_at, presence (present, missing, confirmed_missing), missing_count, dirty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def newest(observations: DataFrame) -> DataFrame:
    """Each resource's last observation (ties: the greater hash); map-side combined."""
    last = observations.groupBy("resource").agg(F.max(F.struct("observed_at", "hash")).alias("x"))
    return last.select("resource", "x.hash", "x.observed_at")


def observe(state: DataFrame | None, scan: DataFrame, complete: bool) -> DataFrame:
    """The state after a scan. A changed hash makes a resource dirty; only complete scans infer absence:
    missing the first time, confirmed_missing the second, never deleted."""
    new = newest(scan)
    if state is None:
        return new.select("resource", "hash", "observed_at", F.lit("present").alias("presence"), F.lit(0).alias("missing_count"), F.lit(True).alias("dirty"))
    j = state.alias("o").join(new.alias("n"), "resource", "full_outer")
    seen, gone = F.col("n.hash").isNotNull(), F.lit(complete)
    count = F.when(seen, 0).when(gone, F.col("o.missing_count") + 1).otherwise(F.col("o.missing_count"))
    presence = F.when(seen, "present").when(gone & (F.col("o.missing_count") >= 1), "confirmed_missing").when(gone, "missing").otherwise(F.col("o.presence"))
    dirty = F.when(seen & (F.col("o.hash").isNull() | (F.col("o.hash") != F.col("n.hash"))), True).otherwise(F.coalesce("o.dirty", F.lit(False)))
    return j.select("resource", F.coalesce("n.hash", "o.hash").alias("hash"), F.coalesce("n.observed_at", "o.observed_at").alias("observed_at"), presence.alias("presence"), count.alias("missing_count"), dirty.alias("dirty"))


def published(state: DataFrame, verified: DataFrame) -> DataFrame:
    """Clears dirty where the verified hash is the state's."""
    v = verified.select("resource", F.col("hash").alias("__v")).dropDuplicates(["resource"])
    return state.join(v, "resource", "left").withColumn("dirty", F.col("dirty") & ~F.coalesce(F.col("__v") == F.col("hash"), F.lit(False))).drop("__v")


def due(df: DataFrame, cursor, upper, overlap_seconds: int = 3600, at: str = "observed_at") -> DataFrame:
    """Rows from the cursor less the overlap up to the fixed bound; later ones wait for the next run."""
    return df.where((F.col(at) >= F.lit(cursor) - F.make_interval(secs=F.lit(overlap_seconds))) & (F.col(at) <= F.lit(upper)))


BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, state_path: str, before: int | None = None) -> dict[int, int]:
    """Bucket -> its last version (below ``before``), from the folder names."""
    out: dict[int, int] = {}
    fs, top = _fs(spark, state_path)
    if not fs.exists(top):
        return out
    for b in fs.listStatus(top):
        if not b.getPath().getName().startswith("bucket="):
            continue
        done = [int(v.getPath().getName()[2:]) for v in fs.listStatus(b.getPath()) if v.getPath().getName().startswith("v=") and fs.exists(_fs(spark, v.getPath().toString() + "/_SUCCESS")[1])]
        done = [v for v in done if before is None or v < before]
        if done:
            out[int(b.getPath().getName()[7:])] = max(done)
    return out


def read_state(spark: SparkSession, state_path: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The last state of each bucket (or of some), or None if there is none yet."""
    paths = [f"{state_path}/bucket={b}/v={v}" for b, v in _versions(spark, state_path, before).items() if buckets is None or b in buckets]
    return spark.read.parquet(*paths) if paths else None


def run_stream(spark: SparkSession, source: DataFrame, state_path: str, checkpoint: str, complete: bool = False) -> None:
    """Drain a streaming source into versioned state, a bucket of resources at a time.

    A micro-batch writes a new version of the buckets that it touches and leaves the others; versions go on from
    the last one, also under a new checkpoint, and a batch that runs again writes the same versions again.
    ``complete``: each batch is a complete scan, so every bucket is merged and absence is inferred.
    """
    fs, mark = _fs(spark, f"{checkpoint}/first-version")
    if not fs.exists(mark):
        first = 1 + max(_versions(spark, state_path).values(), default=-1)
        spark.createDataFrame([(first,)], "v int").coalesce(1).write.parquet(mark.toString())
    base = spark.read.parquet(mark.toString()).first()[0]
    bucket = F.pmod(F.xxhash64("resource"), F.lit(BUCKETS)).cast("int")

    def apply(batch: DataFrame, number: int) -> None:
        version = base + number
        rows = batch.select("resource", "hash", "observed_at").withColumn("bucket", bucket).persist()
        # at most BUCKETS numbers
        touched = sorted({r[0] for r in rows.select("bucket").distinct().collect()} | (set(_versions(spark, state_path, version)) if complete else set()))
        for b in touched:
            old = read_state(spark, state_path, version, [b])
            observe(old, rows.where(F.col("bucket") == b), complete).write.mode("overwrite").parquet(f"{state_path}/bucket={b}/v={version}")
        rows.unpersist()

    source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
