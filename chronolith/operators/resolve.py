"""Labels to identities: exact matches only, and every outcome named."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def exact(mentions: DataFrame, owners: DataFrame, mention: Column, label: Column, key: list[str], owner: str, refuse_at: int = 100) -> DataFrame:
    """Rows (key, status, owner, candidates): resolved, ambiguous (candidates sorted), refused or unresolved.

    A label's owners are counted first; only those of labels with fewer than ``refuse_at`` are listed, so no
    array is longer than that, and a label that very many owners have never meets in one row.
    """
    pairs = owners.select(label.alias("__l"), F.col(owner).alias("__o")).distinct()
    counted = pairs.groupBy("__l").agg(F.count("__o").alias("n"), F.min("__o").alias("lowest"))
    few = pairs.join(counted.where((F.col("n") > 1) & (F.col("n") < refuse_at)).select("__l"), "__l", "left_semi")
    listed = few.groupBy("__l").agg(F.array_join(F.transform(F.array_sort(F.collect_list("__o")), lambda x: x.cast("string")), ",").alias("candidates"))
    out = mentions.withColumn("__l", mention).join(counted.join(listed, "__l", "left"), "__l", "left")
    n = F.coalesce("n", F.lit(0))
    status = F.when(n >= refuse_at, "refused").when(n > 1, "ambiguous").when(n == 1, "resolved").otherwise("unresolved")
    return out.select(*key, status.alias("status"), F.when(n == 1, F.col("lowest")).alias(owner), "candidates")


def census(parts: list[tuple[str, DataFrame]], key: str, fields: list[str]) -> DataFrame:
    """Rows (key, field, n_values, status) over the sources' observations: agree, conflict or insufficient."""
    def long(df: DataFrame) -> DataFrame:
        cells = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.lower(F.trim(F.col(f).cast("string"))).alias("value")) for f in fields)))
        return df.select(F.col(key), cells.alias("x")).select(key, "x.field", "x.value")

    rows = reduce(DataFrame.unionByName, (long(df) for _, df in parts))
    out = rows.groupBy(key, "field").agg(F.countDistinct("value").alias("n_values"))
    return out.withColumn("status", F.when(F.col("n_values") > 1, "conflict").when(F.col("n_values") == 1, "agree").otherwise("insufficient"))


#: Decisions that stand whatever the candidates say.
REVIEWED = ("accepted", "rejected")


def reconcile(state: DataFrame, candidates: DataFrame, reviews: DataFrame, now: str, recheck_days: int = 30) -> DataFrame:
    """One round of reconciliation: the state (resource, hash, identity, status, dirty, next_check) after it.

    Due are dirty resources, those whose check is past, and those whose review has changed. A review
    (resource, hash, decision, identity) counts only for the hash that it saw; one of another hash makes the
    resource ``stale review``, which nothing else may change. Without a review, no candidate is pending, one
    accepted and several ambiguous. What isn't due stays as it is. All joins are on the resource.
    """
    n = candidates.groupBy("resource").agg(F.countDistinct("identity").alias("__n"), F.min("identity").alias("__one"))
    r = reviews.select("resource", F.col("hash").alias("__seen"), F.col("decision").alias("__d"), F.col("identity").alias("__i"))
    x = state.join(n, "resource", "left").join(r, "resource", "left")
    instant = F.lit(now).cast("timestamp")
    stale = F.col("__seen").isNotNull() & (F.col("__seen") != F.col("hash"))
    reviewed = F.col("__d").isin(*REVIEWED) & ~stale
    changed = F.col("__d").isNotNull() & ~F.coalesce(F.when(stale, F.col("status") == "stale review").otherwise((F.col("status") == F.col("__d")) & F.col("identity").eqNullSafe(F.when(F.col("__d") == "accepted", F.col("__i")))), F.lit(False))
    due = F.coalesce(F.col("dirty"), F.lit(True)) | F.coalesce(F.col("next_check") <= instant, F.lit(True)) | changed
    k = F.coalesce("__n", F.lit(0))
    status = F.when(stale, "stale review").when(reviewed, F.col("__d")).when(k == 0, "pending").when(k == 1, "accepted").otherwise("ambiguous")
    identity = F.when(stale, F.col("identity")).when(reviewed, F.when(F.col("__d") == "accepted", F.col("__i"))).when(k == 1, F.col("__one"))
    return x.select(
        "resource", "hash", F.when(due, identity).otherwise(F.col("identity")).alias("identity"), F.when(due, status).otherwise(F.col("status")).alias("status"),
        F.when(due, stale).otherwise(F.col("dirty")).alias("dirty"), F.when(due, instant + F.make_dt_interval(days=F.lit(recheck_days))).otherwise(F.col("next_check")).alias("next_check"), due.alias("was_due"),
    )


def name_by_language(names: DataFrame, owner: str, lang: str, label: str, s: str = "s", e: str = "e") -> DataFrame:
    """Rows (owner, lang, label, status): open-ended entries before closed ones, then the greatest start; several
    different labels there (case and outer white space aside) are ambiguous, else the lexically smallest stands."""
    place = F.rank().over(Window.partitionBy(owner, lang).orderBy(F.col(e).isNotNull(), F.desc_nulls_last(s)))
    top = names.where(F.col(label).isNotNull()).withColumn("__place", place).where("__place = 1")
    out = top.groupBy(owner, lang).agg(F.countDistinct(F.lower(F.trim(F.col(label)))).alias("n"), F.min(label).alias("label"))
    return out.select(owner, lang, F.when(F.col("n") == 1, F.col("label")).alias("label"), F.when(F.col("n") == 1, "chosen").otherwise("ambiguous").alias("status"))
