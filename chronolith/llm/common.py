"""What the operators share: shipping code, cutting lineage, connected components."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.operators.lineage import folder

#: Words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_shipped: dict[str, bool] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package through Spark's own file server (once an application)."""
    sc = spark.sparkContext
    if _shipped.get(sc.applicationId):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    path = os.path.join(tempfile.mkdtemp(), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for base, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    sc.addPyFile(path)
    _shipped[sc.applicationId] = True


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there: lost executors lose nothing."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_packed(df: DataFrame) -> tuple[DataFrame, str]:
    """As ``cut``, but as a compressed table, for rows of long strings; the caller drops its folder when done."""
    spark = df.sparkSession
    path = f"{folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files that no live plan refers to: they go when the JVM has collected its garbage,
    which takes two rounds, the first for the plans and the second for the shuffles that they held."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def remainder(col, n: int):
    """crc32 of an id's decimal text, modulo ``n``; null stays null."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(n).cast("bigint"))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links (columns a, b): rows (node, component), component the
    smallest node reached. Nodes without a link to another node are absent.

    Alternating large-star and small-star rounds; each is two aggregations with map-side combine and two
    equi-joins with their minima. No list of a node's links is ever built, but the rows of a hub meet its
    minimum in one task of the join, two numbers a row, unless adaptive execution splits it. Self-links and
    repeated links change nothing; no links give no rows.
    """
    e = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        e = cut(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
