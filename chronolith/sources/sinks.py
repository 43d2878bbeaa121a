"""Writers: immutable pages, content-addressed documents, sorted lines, and append-only logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.operators import graph
from chronolith.operators.lineage import cut


def write_pages(pages: DataFrame, path: str, endpoint: str, day: str, run: str) -> str:
    """Pages under endpoint, day and run, never overwritten: the same run again must bring the same rows."""
    spark, target = pages.sparkSession, f"{path}/endpoint={endpoint}/day={day}/run={run}"
    if exists(spark, target):
        if not same(spark.read.parquet(target).select(*pages.columns), pages):
            raise ValueError(f"{target} holds other pages")
        return target
    pages.write.mode("errorifexists").parquet(target)
    return target


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def same(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def write_by_hash(docs: DataFrame, path: str, uri: str = "uri", content: str = "content") -> DataFrame:
    """Adds documents that the store at ``path`` doesn't hold yet, by their hash; gives (uri, sha256) of all of ``docs``."""
    spark = docs.sparkSession
    x = docs.select(F.col(uri).alias("uri"), F.col(content).cast("binary").alias("content"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))
    new = x.select("sha256", "content").dropDuplicates(["sha256"])
    if exists(spark, path):
        new = new.join(spark.read.parquet(path).select("sha256"), "sha256", "left_anti")
    new.write.mode("append").parquet(path)
    return x.select("uri", "sha256")


def write_lines(q: DataFrame, path: str, graphs: bool = False) -> None:
    """Canonical lines, distinct and sorted over the files in order; ``graphs``: with the graph, as quads."""
    x = graph.lines(q)
    line = F.concat(F.regexp_replace("line", r" \.$", " <"), "g", F.lit("> .")) if graphs else F.col("line")
    x.select(line.alias("value")).distinct().orderBy("value").write.mode("errorifexists").text(path)


def rebuild(q: DataFrame, path: str) -> DataFrame:
    """Brings a store of graphs to ``q``: replaces the graphs that differ, and gives those (g) it must lose."""
    spark = q.sparkSession
    if not exists(spark, path):
        graph.replace_graphs(q, path)
        return q.select("g").limit(0)
    old = spark.read.parquet(path)
    before, now = graph.graph_hashes(old), graph.graph_hashes(q)
    changed = now.join(before, ["g", "hash"], "left_anti").select("g")
    stale = cut(before.join(now, "g", "left_anti").select("g"))  # read before the store changes
    graph.replace_graphs(cut(q.join(changed, "g", "left_semi").select(*q.columns)), path)
    return stale


def publish_catalog(entries: DataFrame, path: str, key: str = "resource") -> None:
    """Replaces the provenance catalog after checking it: keys there and unique, times in order."""
    n = entries.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("k"), F.count_if(F.col("finished_at") < F.col("started_at")).alias("late")).first()
    if n["n"] != n["k"] or n["late"]:
        raise ValueError(f"catalog refused: {n.asDict()}")
    entries.write.mode("overwrite").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    """Adds to a log that is only ever appended to (feedback, suggestions, events)."""
    rows.withColumn("logged_at", F.current_timestamp()).write.mode("append").json(path)
