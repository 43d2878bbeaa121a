"""Closed semantic plans: validated on the driver, compiled to joins over the typed views.

A plan names facts that tie entities together, filters on their fields, a temporal constraint, and an answer
shape. Whatever isn't in the closed vocabulary is refused before anything runs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith import model
from chronolith.functions import intervals as iv

#: Fact -> (view, subject column, object column).
FACTS = {
    "member_membership": ("memberships", "member", "term_no"),
    "member_constituency": ("memberships", "member", "constituency"),
    "member_party": ("memberships", "member", "party"),
    "member_committee": ("committee_memberships", "member", "committee"),
    "member_office": ("office_holdings", "member", "office"),
    "member_name": ("members", "member", "name"),
    "bill_status": ("bills", "bill", "status"),
    "bill_year": ("bills", "bill", "bill_year"),
    "bill_sponsor": ("participations", "bill", "sponsor"),
    "member_home": ("members", "member", "home"),
    "member_collection": ("members", "member", "code"),
    "membership_start": ("memberships", "id", "s"),
    "membership_end": ("memberships", "id", "e"),
    "membership_term": ("memberships", "id", "term_no"),
    "committee_name": ("committees", "committee", "name"),
    "committee_kind": ("committees", "committee", "kind"),
    "constituency_name": ("constituencies", "constituency", "name"),
    "house_name": ("houses", "house", "name"),
    "constituency_house": ("constituencies", "constituency", "house"),
    "office_type": ("office_holdings", "office", "office_type"),
    "bill_kind": ("bills", "bill", "kind"),
    "debate_date": ("sittings", "record", "day"),
    "debate_body": ("sittings", "record", "body"),
    "concept_label": ("concepts", "concept", "label"),
}
#: Facts whose object names its subject.
LABELS = ("member_name", "committee_name", "constituency_name", "house_name", "concept_label")
#: Facts that hold on a day or during a term.
DATED = ("member_membership", "member_constituency", "member_party", "member_committee", "member_office", "office_type")
OPERATORS = {"eq": "=", "ne": "<>", "lt": "<", "le": "<=", "gt": ">", "ge": ">=", "exists": "IS NOT NULL"}
SHAPES = ("list", "count", "boolean", "grouped_result", "entity", "entities", "label", "fact")


@dataclass(frozen=True)
class Requirement:
    fact: str
    subject: str
    object: str


@dataclass(frozen=True)
class Filter:
    target: str
    operator: str
    value: object = None


@dataclass(frozen=True)
class Plan:
    requirements: tuple[Requirement, ...]
    shape: str
    target: str
    filters: tuple[Filter, ...] = ()
    on: str | None = None
    group_by: tuple[str, ...] = field(default=())

    def check(self) -> None:
        names = {x for r in self.requirements for x in (r.subject, r.object)}
        bad = [r.fact for r in self.requirements if r.fact not in FACTS] + [f.operator for f in self.filters if f.operator not in OPERATORS]
        bad += [x for x in (self.target, *self.group_by, *(f.target for f in self.filters)) if x not in names]
        if bad or self.shape not in SHAPES or not self.requirements or (self.shape == "grouped_result") != bool(self.group_by):
            raise ValueError(f"not in the closed vocabulary: {bad or self.shape}")


def answer_role(plan: Plan) -> str:
    """The name that the answer is about: the target, or for a label the entity's own name, which must be one."""
    if plan.shape != "label":
        return plan.target
    names = {r.object for r in plan.requirements if r.fact in LABELS and r.subject == plan.target}
    if len(names) != 1:
        raise ValueError(f"{plan.target} has no single label: {sorted(names)}")
    return names.pop()


def compile_plan(spark: SparkSession, sf_dir: str, plan: Plan) -> DataFrame:
    """Requirements become inner joins on the names they share; two requirements without one are refused, as they would be a cross join."""
    plan.check()
    out, seen = None, set()
    todo = list(plan.requirements)
    while todo:
        r = next((r for r in todo if out is None or {r.subject, r.object} & seen), None)
        if r is None:
            raise ValueError("requirements that share no entity")
        todo.remove(r)
        view, s, o = FACTS[r.fact]
        df = model.view(spark, sf_dir, view)
        if plan.on and r.fact in DATED:
            df = df.where(iv.contains(F.col("s"), F.col("e"), F.lit(plan.on).cast("date")))
        df = df.select(F.col(s).alias(r.subject), F.col(o).alias(r.object)).distinct()
        out = df if out is None else out.join(df, sorted({r.subject, r.object} & seen))
        seen |= {r.subject, r.object}
    for f in plan.filters:
        c = F.col(f.target)
        value = F.lit(f.value)
        out = out.where({"eq": c == value, "ne": c != value, "lt": c < value, "le": c <= value, "gt": c > value, "ge": c >= value, "exists": c.isNotNull()}[f.operator])
    if plan.shape in ("list", "entities", "label", "fact"):
        return out.select(answer_role(plan)).distinct()
    if plan.shape == "entity":
        one = out.agg(F.countDistinct(plan.target).alias("n"), F.min(plan.target).alias(plan.target))
        return one.select(F.when(F.col("n") == 1, F.col(plan.target)).alias(plan.target), F.when(F.col("n") == 1, "resolved").when(F.col("n") > 1, "ambiguous").otherwise("unresolved").alias("status"))
    if plan.shape == "count":
        return out.agg(F.countDistinct(plan.target).alias("n"))
    if plan.shape == "boolean":
        return out.agg((F.count(F.lit(1)) > 0).alias("answer"))
    return out.groupBy(*plan.group_by).agg(F.countDistinct(plan.target).alias("n"))
