"""Validation as DataFrames of violations: an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def cardinality(df: DataFrame, key: list[str], value: str, least: int = 1, most: int = 1) -> DataFrame:
    """Keys with fewer or more distinct values than allowed."""
    n = df.groupBy(*key).agg(F.countDistinct(value).alias("n"))
    return n.where((F.col("n") < least) | (F.col("n") > most))


def unresolved(df: DataFrame, ref: str, owners: DataFrame, owner: str) -> DataFrame:
    """Rows that refer to an owner there isn't."""
    return df.where(F.col(ref).isNotNull()).join(owners.select(F.col(owner).alias(ref)).distinct(), ref, "left_anti")


def broken_ordinals(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """Rows whose ordinal isn't their place, from 1, within the key."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(ordinal))
    return df.withColumn("expected", place).where(F.col("expected") != F.col(ordinal))


def exclusive(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def overlapping_terms(df: DataFrame, key: list[str], s: str = "s", e: str = "e") -> DataFrame:
    """Neighbours of a chronology that overlap, or an open interval that isn't the last."""
    following = F.lead(s).over(Window.partitionBy(*key).orderBy(s))
    return df.withColumn("next_s", following).where(F.col("next_s").isNotNull() & (F.col(e).isNull() | (F.col("next_s") <= F.col(e))))


def contract(df: DataFrame, required: list[str], choices: dict[str, list], kinds: dict[str, str] | None = None, least: dict[str, int] | None = None, known: list[str] | None = None) -> DataFrame:
    """Findings (field, rule, n), one pass: nulls in required columns, values outside a closed list, columns of
    another type than ``kinds`` says, arrays shorter than ``least``, and columns that ``known`` doesn't name."""
    checks: dict[tuple[str, str], Column] = {(c, "required"): F.count_if(F.col(c).isNull()) for c in required}
    checks |= {(c, "choice"): F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(v)) for c, v in choices.items()}
    checks |= {(c, "items"): F.count_if(F.coalesce(F.size(c), F.lit(0)) < n) for c, n in (least or {}).items()}
    found = dict(df.dtypes)
    shape = [(c, "type") for c, t in (kinds or {}).items() if found.get(c) != t] + [(c, "unknown") for c in found if known is not None and c not in known]
    row = df.agg(F.count(F.lit(1)).alias("all"), *(x.alias(f"c{i}") for i, x in enumerate(checks.values())))
    cells = [F.struct(F.lit(c).alias("field"), F.lit(rule).alias("rule"), F.col(f"c{i}").alias("n")) for i, (c, rule) in enumerate(checks)]
    cells += [F.struct(F.lit(c).alias("field"), F.lit(rule).alias("rule"), F.greatest("all", F.lit(1)).alias("n")) for c, rule in shape]
    return row.select(F.explode(F.array(*cells)).alias("x")).select("x.*").where("n > 0")


def owned(q: DataFrame, owners: dict[str, list[str]]) -> DataFrame:
    """Quads (g, family, s, p, o) that a family's graphs may not have: a predicate of another family, which alone
    describes it. ``owners``: family -> its predicates."""
    allowed = [f"{family}|{p}" for family, ps in owners.items() for p in ps]
    return q.where(~F.concat_ws("|", "family", "p").isin(allowed))


def terms_outside(q: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Predicates that no pinned vocabulary has, and how often each is used."""
    return q.where(~F.col("p").isin(vocabulary)).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


def within_budget(spent: dict[str, float], hard: dict[str, float], warn: float = 0.8) -> list[str]:
    """Names near their bound; above it is an error. Measured values of a run, a few numbers."""
    over = {k: v for k, v in spent.items() if k in hard and v > hard[k]}
    if over:
        raise RuntimeError(f"over budget: {over}")
    return sorted(k for k, v in spent.items() if k in hard and v > warn * hard[k])
