"""Quarantine with retries, an append-only log, drift between pages, and event-time windows over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Tries before a resource is left to review, and the first pause in seconds, doubled each time.
TRIES, PAUSE = 5, 60


def quarantine(held: DataFrame | None, failures: DataFrame, successes: DataFrame, now: str) -> DataFrame:
    """The quarantine (resource, hash, reason, tries, first_at, next_at, status) after a run.

    ``failures``: (resource, hash, reason), ``successes``: (resource, hash). A success releases a resource; a
    failure under the same hash is another try, under a new hash the first again; after ``TRIES`` it waits for
    review and isn't tried. Of several failures of a resource in one run, the greatest hash counts. Resources
    that the run didn't meet stay as they are.
    """
    instant = F.lit(now).cast("timestamp")
    new = failures.groupBy("resource").agg(F.max(F.struct("hash", "reason")).alias("x")).select("resource", F.col("x.hash").alias("new_hash"), F.col("x.reason").alias("new_reason"))
    if held is None:
        held = failures.select("resource", "hash", "reason", F.lit(0).alias("tries"), instant.alias("first_at"), instant.alias("next_at"), F.lit("held").alias("status")).limit(0)
    x = held.join(successes.select("resource").distinct(), "resource", "left_anti").join(new, "resource", "full_outer")
    failed, again = F.col("new_hash").isNotNull(), F.coalesce(F.col("hash") == F.col("new_hash"), F.lit(False))
    tries = F.when(~failed, F.col("tries")).when(again, F.col("tries") + 1).otherwise(1)
    pause = F.make_dt_interval(secs=(F.lit(float(PAUSE)) * F.pow(F.lit(2.0), tries - 1)).cast("decimal(18,6)"))
    return x.select(
        "resource", F.coalesce("new_hash", "hash").alias("hash"), F.coalesce("new_reason", "reason").alias("reason"), tries.alias("tries"),
        F.when(failed & ~again, instant).otherwise(F.col("first_at")).alias("first_at"),
        F.when(failed, instant + pause).otherwise(F.col("next_at")).alias("next_at"), F.when(tries >= TRIES, "review").otherwise("held").alias("status"),
    )


def due(held: DataFrame, now: str) -> DataFrame:
    return held.where((F.col("status") == "held") & (F.col("next_at") <= F.lit(now).cast("timestamp")))


def drift(pages: DataFrame, key: str = "skip", total: str = "advertised") -> DataFrame:
    """Scans whose pages advertise different totals: (scan, least, most); the scan must start again."""
    n = pages.groupBy("scan").agg(F.min(total).alias("least"), F.max(total).alias("most"))
    return n.where("least <> most")


def append_only(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Entries of a log that were changed or removed since ``before``: empty if it was only appended to."""
    return before.exceptAll(after).select(key).distinct()


def counted(stream: DataFrame, at: str = "ts", by: str = "kind", late: str = "1 hour", size: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts by event-time window of a stream (or a table): tumbling, or sliding with ``slide``; later than ``late`` is dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size, slide), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("s"), F.col("window.end").alias("e"), by, "n")


def sessions(stream: DataFrame, at: str = "ts", by: str = "resource", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each key: runs of events less than ``gap`` apart."""
    return stream.withWatermark(at, late).groupBy(F.session_window(at, gap), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("s"), F.col("session_window.end").alias("e"), by, "n")


def matched(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, within: str = "1 hour") -> DataFrame:
    """Pairs of two streams' events of one key, the right one at most ``within`` after the left."""
    a = left.withWatermark(left_at, within).alias("a")
    b = right.withWatermark(right_at, within).alias("b")
    near = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col(f"b.{right_at}") >= F.col(f"a.{left_at}")) & (F.col(f"b.{right_at}") <= F.col(f"a.{left_at}") + F.expr(f"interval {within}"))
    return a.join(b, near).select(F.col(f"a.{key}"), F.col(f"a.{left_at}"), F.col(f"b.{right_at}"))


def newest_in_stream(stream: DataFrame, key: list[str], at: str = "ts", late: str = "1 hour") -> DataFrame:
    """Each observation once: repeats within the watermark are dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(key)
