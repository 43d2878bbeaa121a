"""Nested JSON pages and marked-up documents as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def json_records(spark: SparkSession, path: str, schema: str, envelope: str = "results") -> DataFrame:
    """Rows (page, pointer, record) of pages of an enveloped array; pages that don't parse have a null record and their raw text."""
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("page"), "value")
    page = raw.withColumn("x", F.from_json("value", f"{envelope} array<{schema}>, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    good = page.select("page", F.posexplode_outer(f"x.{envelope}").alias("pos", "record"), F.when(F.col("x._bad").isNotNull(), F.col("value")).alias("quarantined"))
    return good.select("page", F.concat(F.lit(f"/{envelope}/"), F.col("pos").cast("string")).alias("pointer"), "record", "quarantined")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Files by content hash: (sha256, path, length), for exact replay."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("sha256"), "path", "length")


def members(records: DataFrame) -> DataFrame:
    """Memberships of nested member records: one row for each, with open ends null."""
    m = records.select(F.col("record.member.memberCode").alias("member"), F.explode("record.member.memberships.membership").alias("m"))
    return m.select("member", F.col("m.uri").alias("membership"), F.col("m.house.houseNo").alias("term"), F.to_date(F.col("m.dateRange.start").substr(1, 10)).alias("s"), F.to_date(F.col("m.dateRange.end").substr(1, 10)).alias("e"))


def html_text(html):
    """Visible text of a page, roughly: scripts, styles and tags out, white space collapsed."""
    x = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", " "), r"\s+", " "))


def links(pages: DataFrame) -> DataFrame:
    """Rows (page_id, href) of double-quoted links."""
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1)).alias("href"))
