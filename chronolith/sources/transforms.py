"""Nested service records to typed rows. Every transform gives (facts, rejected): what can't be read is reported
with its reason, never dropped silently and never guessed.

Records come as a column ``record`` of the struct that the service's JSON has; ends are null while open.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronolith.functions import intervals as iv
from chronolith.operators.mentions import strict_day

#: The record that stands for both houses together.
COMBINED = "dail & seanad"
#: Kinds of representation and the house that each belongs to.
REPRESENTS = {"constituency": "dail", "panel": "seanad"}

C = F.col


def split(rows: DataFrame, reasons: dict[str, Column], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows without a reason against them, and the others with the first one that holds."""
    why = F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(reason)) for reason, bad in reasons.items()))
    marked = rows.withColumn("reason", why)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL").select(*keep, "reason")


def houses(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (term, house, term_no, label, seats, s, e); the combined record is reported."""
    h = C("record.house")
    x = records.select(h["uri"].alias("term"), h["houseCode"].alias("house"), h["houseNo"].cast("int").alias("term_no"), F.trim(h["showAs"]).alias("label"), h["seats"].cast("int").alias("seats"), strict_day(h["dateRange"]["start"]).alias("s"), strict_day(h["dateRange"]["end"]).alias("e"), h["dateRange"]["end"].alias("raw_end"))
    good, bad = split(x, {"combined record": C("house") == COMBINED, "unknown house": ~C("house").isin("dail", "seanad"), "no identity": C("term").isNull(), "no start": C("s").isNull(), "unreadable end": C("raw_end").isNotNull() & C("e").isNull()}, ["term", "house"])
    return good.drop("raw_end"), bad


def parties(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (party, term, code, label, independent), one for each party and term."""
    p = C("record.party")
    x = records.select(p["uri"].alias("party"), C("record.house.uri").alias("term"), p["partyCode"].alias("code"), F.trim(p["showAs"]).alias("label"))
    good, bad = split(x, {"no identity": C("party").isNull(), "no term": C("term").isNull(), "no code": C("code").isNull()}, ["party", "term"])
    return good.distinct().withColumn("independent", C("code") == "Independent"), bad


def constituencies(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (constituency, term, kind, code, label); a kind under the wrong house is reported."""
    r, kinds = C("record.constituencyOrPanel"), F.create_map(*(F.lit(v) for kv in REPRESENTS.items() for v in kv))
    x = records.select(r["uri"].alias("constituency"), C("record.house.uri").alias("term"), r["representType"].alias("kind"), r["representCode"].alias("code"), F.trim(r["showAs"]).alias("label"), C("record.house.houseCode").alias("house"))
    good, bad = split(x, {"no identity": C("constituency").isNull(), "unknown kind": ~C("kind").isin(*REPRESENTS), "kind of the other house": F.element_at(kinds, C("kind")) != C("house")}, ["constituency", "kind"])
    return good.drop("house").distinct(), bad


def committees(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (committee, term_no, house, code, s, e), rows (committee, lang, label, s, e) of its names, and rejected ones."""
    r = C("record")
    x = records.select(r["uri"].alias("committee"), r["houseNo"].cast("int").alias("term_no"), r["houseCode"].alias("house"), r["committeeCode"].alias("code"), strict_day(r["committeeDateRange"]["start"]).alias("s"), strict_day(r["committeeDateRange"]["end"]).alias("e"), r["committeeDateRange"].isNotNull().alias("dated"), r["committeeName"].alias("names"))
    good, bad = split(x, {"no identity": C("committee").isNull(), "no term": C("term_no").isNull() | C("house").isNull(), "range without start": C("dated") & C("s").isNull()}, ["committee"])
    name = F.explode("names").alias("n")
    each = good.select("committee", name)
    day = lambda k: strict_day(C("n.dateRange")[k])
    labels = reduce(DataFrame.unionByName, (each.select("committee", F.lit(lang).alias("lang"), F.trim(C(f"n.{field}")).alias("label"), day("start").alias("s"), day("end").alias("e")) for lang, field in (("en", "nameEn"), ("ga", "nameGa"))))
    return good.drop("dated", "names"), labels.where("label IS NOT NULL AND label <> ''"), bad


def members(records: DataFrame) -> dict[str, DataFrame]:
    """Tables people, memberships, representations, parties, committees, offices and rejected, each row with its member.

    One explosion of memberships, and one of each list below it; a party or office without a readable range
    goes to ``rejected`` with its place (pointer), the rest of the member stays.
    """
    m = C("record.member")
    ok, bad_people = split(records.select("record", m["memberCode"].alias("member")), {"no member code": C("member").isNull()}, ["member"])
    people = ok.select("member", F.coalesce(m["fullName"], m["showAs"]).alias("name"), m["firstName"].alias("first_name"), m["lastName"].alias("last_name"), m["gender"].alias("gender")).distinct()
    one = ok.select("member", F.posexplode("record.member.memberships.membership").alias("i", "m"))
    day = lambda x, k: strict_day(x["dateRange"][k])
    base = one.select("member", C("m.uri").alias("membership"), C("m.house.houseCode").alias("house"), C("m.house.houseNo").cast("int").alias("term_no"), day(C("m"), "start").alias("s"), day(C("m"), "end").alias("e"), F.concat(F.lit("/member/memberships/"), C("i").cast("string")).alias("pointer"))
    memberships, bad = split(base, {"no identity": C("membership").isNull(), "no term": C("term_no").isNull(), "no start": C("s").isNull()}, ["member", "pointer"])

    def below(field: str, inner: str, columns: dict[str, Column], dated: bool) -> tuple[DataFrame, DataFrame]:
        x = one.select("member", C("m.uri").alias("membership"), "i", F.posexplode(C(f"m.{field}.{inner}")).alias("j", "x"))
        place = F.concat(F.lit("/member/memberships/"), C("i").cast("string"), F.lit(f"/{field}/"), C("j").cast("string")).alias("pointer")
        dates = [day(C("x"), "start").alias("s"), day(C("x"), "end").alias("e"), C("x.dateRange.end").alias("raw_end")] if dated else []
        rows = x.select("member", "membership", place, *(c.alias(n) for n, c in columns.items()), *dates)
        reasons = {"no identity": C(next(iter(columns))).isNull()}
        if dated:
            reasons |= {"no start": C("s").isNull(), "unreadable end": C("raw_end").isNotNull() & C("e").isNull(), "ends before it starts": F.coalesce(C("e") < C("s"), F.lit(False))}
        good, wrong = split(rows, reasons, ["member", "pointer"])
        return good.drop("pointer", "raw_end"), wrong

    representations, r1 = below("represents", "represent", {"constituency": C("x.uri"), "kind": C("x.representType")}, False)
    party, r2 = below("parties", "party", {"party": C("x.uri"), "code": C("x.partyCode")}, True)
    office, r3 = below("offices", "office", {"office": C("x.officeName.showAs")}, True)
    rejected = reduce(DataFrame.unionByName, [bad_people.withColumn("pointer", F.lit("/member")).select("member", "pointer", "reason"), bad, r1, r2, r3])
    # cabinet and committee memberships are derived: see episodes() and committee_memberships()
    return {"people": people, "memberships": memberships.drop("pointer"), "representations": representations, "parties": party, "offices": office, "rejected": rejected}


def keep_prior_parties(parties_now: DataFrame, rejected: DataFrame, prior: DataFrame) -> DataFrame:
    """Party rows, with a member's earlier ones kept where the new evidence of that member was rejected."""
    lost = rejected.where(F.contains(C("pointer"), F.lit("/parties/"))).select("member").distinct()
    kept = prior.join(lost, "member", "left_semi").join(parties_now.select("member", "party", "s"), ["member", "party", "s"], "left_anti")
    return parties_now.withColumn("retained", F.lit(False)).unionByName(kept.withColumn("retained", F.lit(True)))


def bills(records: DataFrame) -> dict[str, DataFrame]:
    """Tables bills, stages, events, sponsors and rejected. Stages and events that are repeated word for word count once;
    a sponsor is a person (its address) or an office (the capacity's words)."""
    b = C("record.bill")
    head = records.select("record", b["uri"].alias("bill"), b["billYear"].cast("int").alias("bill_year"), b["billNo"].alias("bill_no"), b["shortTitleEn"].alias("title"), b["status"].alias("status"), F.try_to_timestamp(b["lastUpdated"]).alias("updated"))
    good, bad = split(head, {"no identity": C("bill").isNull(), "no year": C("bill_year").isNull(), "no stages": F.coalesce(F.size("record.bill.stages"), F.lit(0)) <= 0}, ["bill"])
    dated = lambda path, kind: good.select("bill", F.explode(path).alias("x")).select("bill", F.lit(kind).alias("kind"), C("x.uri").alias("activity"), C("x.showAs").alias("label"), F.explode_outer("x.dates").alias("d")).select("bill", "kind", "activity", "label", strict_day(C("d.date")).alias("day"))
    stages, no_day = split(dated("record.bill.stages.event", "stage").distinct(), {"no identity": C("activity").isNull(), "no date": C("day").isNull()}, ["bill"])
    events, no_event = split(dated("record.bill.events.event", "event").distinct(), {"no identity": C("activity").isNull(), "no date": C("day").isNull()}, ["bill"])
    s = good.select("bill", F.posexplode("record.bill.sponsors.sponsor").alias("place", "x"))
    s = s.select("bill", C("place").cast("int").alias("place"), C("x.by.uri").alias("person"), F.nullif(F.trim(C("x.as.showAs")), F.lit("")).alias("capacity"), C("x.isPrimary").alias("is_primary"))
    sponsors, nobody = split(s, {"neither person nor office": C("person").isNull() & C("capacity").isNull()}, ["bill"])
    return {"bills": good.drop("record"), "stages": stages, "events": events, "sponsors": sponsors, "rejected": reduce(DataFrame.unionByName, [bad, no_day, no_event, nobody])}


def offices(registry: DataFrame) -> DataFrame:
    """Rows (office, kind, unit, label, s, e) of the registry, and a row for each unit that an office names."""
    own = registry.select("office", "kind", "unit", F.trim("label").alias("label"), strict_day(C("s")).alias("s"), strict_day(C("e")).alias("e"))
    units = own.where("unit IS NOT NULL").select(C("unit").alias("office"), F.lit("unit").alias("kind"), F.lit(None).cast("string").alias("unit"), C("unit").alias("label"), F.lit(None).cast("date").alias("s"), F.lit(None).cast("date").alias("e")).distinct()
    return own.unionByName(units.join(own.select("office"), "office", "left_anti"))


def sponsor_links(sponsors: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows (bill, place, target, by): accepted decisions (capacity, identity, status) turn capacities into offices;
    persons stand for themselves. Anything else stays unlinked and isn't in the result."""
    person = sponsors.where("person IS NOT NULL").select("bill", "place", C("person").alias("target"), F.lit("person").alias("by"))
    accepted = decisions.where("status = 'accepted'").select("capacity", C("identity").alias("target")).distinct()
    return person.unionByName(sponsors.where("person IS NULL").join(accepted, "capacity").select("bill", "place", "target", F.lit("office").alias("by")))


def references(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows (kind, target, n): what members' records refer to, of every kind, in one table."""
    parts = [("constituency", "representations", "constituency"), ("party", "parties", "party"), ("office", "offices", "office")]
    rows = reduce(DataFrame.unionByName, (tables[t].select(F.lit(kind).alias("kind"), C(c).alias("target")) for kind, t, c in parts))
    return rows.groupBy("kind", "target").agg(F.count(F.lit(1)).alias("n"))


def observations(offices_of: DataFrame) -> DataFrame:
    """Rows (key, member, membership, office, s, e): office occurrences under a key that their content makes, once each."""
    body = F.to_json(F.struct("e", "member", "membership", "office", "s"), {"ignoreNullFields": "false"})
    return offices_of.select(F.sha2(body, 256).alias("key"), "member", "membership", "office", "s", "e").dropDuplicates(["key"])


def resolve_references(parts: DataFrame, owners: DataFrame, ref: str = "by") -> DataFrame:
    """``parts`` with owner and status: a reference is resolved by one owner of that source address or path key,
    ambiguous with several, unresolved with none, and absent if the part has none. ``owners``: (alias, owner)."""
    n = owners.groupBy("alias").agg(F.countDistinct("owner").alias("n"), F.min("owner").alias("one"))
    key = F.regexp_replace(F.url_decode(C(ref)), r"^#", "")
    x = parts.withColumn("alias", key).join(n, "alias", "left")
    status = F.when(C(ref).isNull(), "absent").when(C("n") == 1, "resolved").when(C("n") > 1, "ambiguous").otherwise("unresolved")
    return x.withColumn("owner", F.when(C("n") == 1, C("one"))).withColumn("status", status).drop("alias", "n", "one")


def episodes(holdings: DataFrame, key: list[str], holding: str, s: str = "s", e: str = "e") -> DataFrame:
    """Rows (key, s, e, n, support): unions of holdings in office; a day's end reaches the next morning, so a holding
    that starts on that morning goes on with the episode. ``support``: the holdings in it, sorted, by comma."""
    order = Window.partitionBy(*key).orderBy(s, holding)
    reach = F.max(F.coalesce(F.date_add(C(e), 1), iv.forever())).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = holdings.withColumn("__new", F.when(reach.isNull() | (C(s) > reach), 1).otherwise(0))
    marked = marked.withColumn("__episode", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    out = marked.groupBy(*key, "__episode").agg(F.min(s).alias("s"), F.max(F.coalesce(C(e), iv.forever())).alias("e"), F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set(C(holding).cast("string"))), ",").alias("support"))
    return out.select(*key, "s", F.when(C("e") < iv.forever(), C("e")).alias("e"), "n", "support")
