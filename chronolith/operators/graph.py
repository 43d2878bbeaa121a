"""The quad view of the typed tables, canonical lines, graph hashes and set comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

PREFIX = "urn:x:"


def quads(df: DataFrame, family: str, graph: Column, subject: Column, columns: dict[str, str]) -> DataFrame:
    """Rows (g, family, s, p, o, o_dt) from one typed table, a row for each value that isn't null; one scan, no shuffle."""
    cells = F.array(*(F.struct(F.lit(PREFIX + p).alias("p"), F.col(c).cast("string").alias("o"), F.lit(df.schema[c].dataType.simpleString()).alias("o_dt")) for c, p in columns.items()))
    out = df.select(graph.alias("g"), F.lit(family).alias("family"), subject.alias("s"), F.explode(cells).alias("x"))
    return out.select("g", "family", "s", "x.p", "x.o", "x.o_dt").where("o IS NOT NULL")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def lines(q: DataFrame) -> DataFrame:
    """Canonical line of each quad; a string's datatype is left out, as it is the plain literal's."""
    literal = F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace("o", r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'), F.when(F.col("o_dt") == "string", "").otherwise(F.concat(F.lit("^^<"), "o_dt", F.lit(">"))))
    return q.select("g", F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> "), literal, F.lit(" .")).alias("line"))


def graph_hashes(q: DataFrame) -> DataFrame:
    """Rows (g, n, hash), a hash of each graph's sorted distinct lines; a graph is one publication unit."""
    return lines(q).groupBy("g").agg(F.array_sort(F.collect_set("line")).alias("l")).select("g", F.size("l").cast("bigint").alias("n"), F.sha2(F.array_join("l", "\n"), 256).alias("hash"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, tagged; empty if the sets are equal."""
    return a.distinct().exceptAll(b.distinct()).withColumn("side", F.lit("left")).union(b.distinct().exceptAll(a.distinct()).withColumn("side", F.lit("right")))


def replace_graphs(q: DataFrame, path: str) -> None:
    """Replace whole graphs, leaving the others: dynamic partition overwrite by g."""
    q.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("g").parquet(path)
