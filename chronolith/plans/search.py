"""A search over contributions, built from what is asked: works, chambers, days, subject and how it was suggested."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronolith.operators import hierarchy


def contributions(
    parts: DataFrame, sittings: DataFrame, links: DataFrame, tree: DataFrame, works: list | None = None, bodies: list[str] | None = None,
    first: str | None = None, last: str | None = None, subjects: list | None = None, narrower: bool = True,
) -> DataFrame:
    """Rows (record, ordinal, kind, body, day, subject) of contributions; what isn't asked doesn't restrict.

    ``parts``: (record, ordinal, kind), ``sittings``: (record, body, day), ``links``: (record, concept), ``tree``:
    (child, parent). Without ``subjects`` the subject is null (the structured control). The lists are parameters
    of a question, short by contract.
    """
    when = sittings.select("record", "body", "day").distinct()
    if bodies is not None:
        when = when.where(F.col("body").isin(bodies))
    if first is not None:
        when = when.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        when = when.where(F.col("day") <= F.lit(last).cast("date"))
    out = parts.select("record", "ordinal", "kind")
    if works is not None:
        out = out.where(F.col("record").isin(works))
    # a sitting is optional unless the question restricts it
    out = out.join(when, "record", "inner" if any(x is not None for x in (bodies, first, last)) else "left")
    if subjects is None:
        return out.withColumn("subject", F.lit(None).cast(dict(links.dtypes)["concept"])).select("record", "ordinal", "kind", "body", "day", "subject")
    found = hierarchy.subject_search(links, tree, "record", "concept", subjects, narrower)
    return out.join(found, "record").select("record", "ordinal", "kind", "body", "day", "subject")
