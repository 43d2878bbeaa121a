"""Dated intervals: inclusive ends, a null end is open, a null start or an end before the start is uncertain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

def forever() -> Column:
    return F.lit("9999-12-31").cast("date")


def certain(s: Column, e: Column) -> Column:
    """Whether the interval can be judged at all."""
    return s.isNotNull() & (e.isNull() | (s <= e))


def overlap(a_s: Column, a_e: Column, b_s: Column, b_e: Column) -> Column:
    return (a_e.isNull() | (b_s <= a_e)) & (b_e.isNull() | (a_s <= b_e))


def contains(s: Column, e: Column, day: Column) -> Column:
    return (s <= day) & (e.isNull() | (day <= e))


def strictly_before(e: Column, later_start: Column) -> Column:
    """An open end never qualifies, and an equal day doesn't either."""
    return e.isNotNull() & (e < later_start)


def window_overlap(s: Column, e: Column, first: Column, last: Column) -> Column:
    """Overlap with the days ``first`` to ``last``, by the exclusive next day."""
    return (s < F.date_add(last, 1)) & (e.isNull() | (e >= first))


def intersection(pairs: list[tuple[Column, Column]]) -> tuple[Column, Column]:
    """Start and end of the common part; the end is null only if all ends are."""
    start = F.greatest(*(s for s, _ in pairs)) if len(pairs) > 1 else pairs[0][0]
    end = F.least(*(e for _, e in pairs)) if len(pairs) > 1 else pairs[0][1]  # least() passes nulls over
    return start, end


def islands(df: DataFrame, key: list[str], s: str = "s", e: str = "e", gap_days: int = 1) -> DataFrame:
    """Rows (key, s, e, n): unions of intervals that overlap or follow one another within ``gap_days``.

    One shuffle by key: a running maximum of ends, then a running latest start of an island. Both run over days, not
    rows, so intervals of one start are never told apart: their order differs from one sort (or spill) to the next.
    """
    order = Window.partitionBy(*key).orderBy("__day")
    df = df.withColumn("__day", F.datediff(F.col(s), F.lit("1970-01-01").cast("date")))
    reach = F.max(F.coalesce(F.col(e), forever())).over(order.rangeBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.when(reach.isNull() | (F.datediff(F.col(s), reach) > gap_days), F.col("__day")))
    grouped = marked.withColumn("__island", F.max("__new").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    out = grouped.groupBy(*key, "__island").agg(F.min(s).alias("s"), F.max(F.coalesce(F.col(e), forever())).alias("e"), F.count(F.lit(1)).alias("n"))
    return out.select(*key, "s", F.when(F.col("e") != forever(), F.col("e")).alias("e"), "n")


def latest_recorded(df: DataFrame, key: list[str], s: str = "s", e: str = "e") -> DataFrame:
    """The rows of the greatest start, where it is unique and every earlier interval is closed and ends before it."""
    by = Window.partitionBy(*key)
    number = F.datediff(F.col(s), F.lit("1970-01-01").cast("date"))
    df = df.withColumn("__d", number).withColumn("__top", F.max("__d").over(by))
    earlier = by.orderBy("__d").rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("__ends", F.max(F.coalesce(F.col(e), forever())).over(earlier))
    df = df.withColumn("__same", F.count(F.lit(1)).over(Window.partitionBy(*key, "__d")))
    out = df.where((F.col("__d") == F.col("__top")) & (F.col("__same") == 1) & (F.col("__ends").isNull() | (F.col("__ends") < F.col(s))))
    return out.drop("__d", "__top", "__ends", "__same")


def current(df: DataFrame, key: list[str], day: Column, s: str = "s", e: str = "e") -> DataFrame:
    """Rows that contain the day, with status: resolved if the key has exactly one, else ambiguous."""
    hit = df.where(contains(F.col(s), F.col(e), day))
    return hit.withColumn("status", F.when(F.count(F.lit(1)).over(Window.partitionBy(*key)) == 1, "resolved").otherwise("ambiguous"))
