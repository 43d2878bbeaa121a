"""Intervals, resolution, plans and incremental state on small invented rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronolith.functions import intervals as iv
from chronolith.operators import checks, gate, graph, hierarchy, mentions, resolve
from chronolith.plans import search, semantic
from chronolith.sources import documents
from chronolith.streaming import quarantine, state

D = lambda m, d: date(2020, m, d)


@pytest.mark.parametrize(
    "a, b, over, start_in, before",
    [
        ((D(1, 1), D(1, 10)), (D(1, 10), D(1, 20)), True, False, False),
        ((D(1, 1), D(1, 10)), (D(1, 11), D(1, 20)), False, False, True),
        ((D(1, 1), None), (D(5, 1), D(5, 2)), True, False, False),
        ((D(1, 1), None), (D(1, 1), None), True, True, False),
    ],
)
def test_interval_truth(spark, a, b, over, start_in, before):
    df = spark.createDataFrame([(*a, *b)], "s date, e date, t date, f date")
    c = F.col
    r = df.select(iv.overlap(c("s"), c("e"), c("t"), c("f")), iv.contains(c("t"), c("f"), c("s")), iv.strictly_before(c("e"), c("t"))).first()
    assert tuple(r) == (over, start_in, before)


def test_uncertain_and_islands(spark):
    df = spark.createDataFrame([(1, D(1, 1), D(1, 10)), (1, D(1, 11), D(1, 20)), (1, D(2, 1), None), (1, D(3, 1), D(3, 2))], "k int, s date, e date")
    assert sorted(map(tuple, iv.islands(df, ["k"]).collect())) == [(1, D(1, 1), D(1, 20), 2), (1, D(2, 1), None, 2)]
    bad = spark.createDataFrame([(None, D(1, 1)), (D(2, 1), D(1, 1)), (D(1, 1), None)], "s date, e date")
    assert [r[0] for r in bad.select(iv.certain(F.col("s"), F.col("e"))).collect()] == [False, False, True]


def test_islands_whose_ties_are_sorted_otherwise(spark):
    """Sorts that spill merge equal rows in any order: many intervals of one start and end are one island all the same."""
    rows = [(1, D(m, 1), D(m, 3)) for m in range(1, 13) for _ in range(50)] + [(2, D(m, 1), D(m, 1 + i % 20)) for m in range(1, 13) for i in range(60)]
    want = [(1, D(m, 1), D(m, 3), 50) for m in range(1, 13)] + [(2, D(m, 1), D(m, 20), 60) for m in range(1, 13)]
    conf, name = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    conf.set(name, "7")
    try:
        assert sorted(map(tuple, iv.islands(spark.createDataFrame(rows, "k int, s date, e date"), ["k"]).collect())) == want
    finally:
        conf.remove(name)


def test_latest_refuses_ties_and_open_earlier(spark):
    rows = [(1, D(1, 1), D(1, 5)), (1, D(2, 1), None), (2, D(1, 1), None), (2, D(2, 1), None), (3, D(1, 1), D(1, 2)), (3, D(1, 1), D(1, 3))]
    df = spark.createDataFrame(rows, "k int, s date, e date")
    assert [tuple(r) for r in iv.latest_recorded(df, ["k"]).collect()] == [(1, D(2, 1), None)]


def test_resolution_outcomes(spark):
    owners = spark.createDataFrame([(1, "ann"), (2, "bob"), (3, "bob")], "owner int, name string")
    said = spark.createDataFrame([(10, "ann"), (11, "bob"), (12, "cyd"), (13, None)], "m int, said string")
    got = {r["m"]: (r["status"], r["owner"], r["candidates"]) for r in resolve.exact(said, owners, F.col("said"), F.col("name"), ["m"], "owner").collect()}
    assert got == {10: ("resolved", 1, None), 11: ("ambiguous", None, "2,3"), 12: ("unresolved", None, None), 13: ("unresolved", None, None)}


def test_closure_of_diamond_and_cycle(spark):
    e = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4), (4, 1)], "child int, parent int")
    out = hierarchy.closure(e, e.select("child"))
    assert out.count() == 16 and out.where("node = 1 AND ancestor = 4").first()["depth"] == 2


def test_graph_hash_ignores_order_and_repeats(spark):
    rows = [("g", "f", "s", "p", "b", "string"), ("g", "f", "s", "p", "a", "string")]
    names = "g string, family string, s string, p string, o string, o_dt string"
    one, two = spark.createDataFrame(rows, names), spark.createDataFrame(rows[::-1] + rows[:1], names)
    assert graph.graph_hashes(one).first() == graph.graph_hashes(two).first()
    assert graph.differences(one, two).count() == 0


def test_plans_are_closed(spark):
    r = semantic.Requirement
    with pytest.raises(ValueError):
        semantic.Plan((r("anything", "a", "b"),), "list", "a").check()
    with pytest.raises(ValueError):
        semantic.compile_plan(spark, "/root/testdata/sf0.001", semantic.Plan((r("member_party", "m", "p"), r("bill_status", "b", "s")), "list", "m"))


def test_contract_findings(spark):
    df = spark.createDataFrame([(None, "x"), (1, "y")], "a int, b string")
    assert sorted(map(tuple, checks.contract(df, ["a"], {"b": ["x"]}).collect())) == [("a", "required", 1), ("b", "choice", 1)]


def test_two_scans_before_absence_is_confirmed(spark):
    scan = lambda *rows: spark.createDataFrame([(r, h, datetime(2024, 1, 1)) for r, h in rows], "resource string, hash string, observed_at timestamp")
    s = state.observe(None, scan(("a", "1"), ("b", "1")), True)
    s = state.published(s, s.select("resource", "hash"))
    s = state.observe(s, scan(("a", "2")), True)
    assert {r["resource"]: (r["presence"], r["dirty"]) for r in s.collect()} == {"a": ("present", True), "b": ("missing", False)}
    assert {r["presence"] for r in state.observe(s, scan(("a", "2")), False).collect()} == {"present", "missing"}
    assert {r["presence"] for r in state.observe(s, scan(("a", "2")), True).collect()} == {"present", "confirmed_missing"}


def test_stream_drains_into_state(spark, tmp_path):
    names, src, at = "resource string, hash string, observed_at timestamp", str(tmp_path / "in"), str(tmp_path / "state")
    run = lambda checkpoint: state.run_stream(spark, spark.readStream.schema(names).parquet(src), at, str(tmp_path / checkpoint))
    spark.createDataFrame([("a", "1", datetime(2024, 1, 1)), ("a", "2", datetime(2024, 1, 2)), ("b", "1", datetime(2024, 1, 1))], names).write.parquet(src)
    run("c1")
    assert {r["resource"]: r["hash"] for r in state.read_state(spark, at).collect()} == {"a": "2", "b": "1"}
    spark.createDataFrame([("a", "3", datetime(2024, 1, 3))], names).write.mode("append").parquet(src)
    run("c1")
    assert {r["resource"]: r["hash"] for r in state.read_state(spark, at).collect()} == {"a": "3", "b": "1"}
    run("c2")  # another checkpoint reads everything again, and goes on from the versions there are
    assert {r["resource"]: r["hash"] for r in state.read_state(spark, at).collect()} == {"a": "3", "b": "1"}


def test_quarantine_lifecycle(spark):
    fail = lambda *rows: spark.createDataFrame(list(rows), "resource string, hash string, reason string")
    none = spark.createDataFrame([], "resource string, hash string")
    q = quarantine.quarantine(None, fail(("a", "1", "bad"), ("b", "1", "bad")), none, "2024-01-01 00:00:00")
    q = quarantine.quarantine(q, fail(("a", "1", "bad")), spark.createDataFrame([("b", "1")], "resource string, hash string"), "2024-01-01 01:00:00")
    assert [(r["resource"], r["tries"], r["status"]) for r in q.collect()] == [("a", 2, "held")]
    assert quarantine.due(q, "2024-01-01 01:01:00").count() == 0 and quarantine.due(q, "2024-01-01 01:02:00").count() == 1
    for n in range(3):
        q = quarantine.quarantine(q, fail(("a", "1", "bad")), none, "2024-01-02 00:00:00")
    assert q.first()["status"] == "review" and quarantine.due(q, "2025-01-01 00:00:00").count() == 0
    assert quarantine.quarantine(q, fail(("a", "2", "bad")), none, "2024-01-03 00:00:00").first()["tries"] == 1


def test_windows_of_streams(spark, tmp_path):
    names, src = "ts timestamp, kind string, resource string", str(tmp_path / "in")
    rows = [(datetime(2024, 1, 1, 0, m), "k", "a") for m in (1, 2, 15, 50)] + [(datetime(2024, 1, 1, 0, 3), "k", "b")]
    spark.createDataFrame(rows, names).write.parquet(src)

    def drained(f, name):
        q = f(spark.readStream.schema(names).parquet(src)).writeStream.format("memory").queryName(name).outputMode("complete" if name == "tumbling" else "append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert sorted(r["n"] for r in drained(quarantine.counted, "tumbling")) == [1, 1, 3]
    assert sorted((r["resource"], r["n"]) for r in quarantine.sessions(spark.createDataFrame(rows, names)).collect()) == [("a", 1), ("a", 3), ("b", 1)]
    pairs = drained(lambda s: quarantine.matched(s.where("resource = 'a'").withColumnRenamed("ts", "t1"), s.where("resource = 'b'").withColumnRenamed("ts", "t2"), "kind", "t1", "t2", "5 minutes"), "pairs")
    assert sorted(r["t1"].minute for r in pairs) == [1, 2]
    assert len(drained(lambda s: quarantine.newest_in_stream(s, ["resource"]), "once")) == 2
    scans = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (2, 11)], "scan int, advertised int")
    assert [tuple(r) for r in quarantine.drift(scans).collect()] == [(2, 10, 11)]
    assert [r["scan"] for r in quarantine.append_only(scans, scans.where("scan = 1"), "scan").collect()] == [2]


def test_json_pages_and_members(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"results": [{"member": {"memberCode": "m1", "memberships": [{"membership": {"uri": "u1", "house": {"houseNo": "3"}, "dateRange": {"start": "2020-01-01", "end": null}}}]}}]}')
    schema = "struct<member struct<memberCode string, memberships array<struct<membership struct<uri string, house struct<houseNo string>, dateRange struct<start string, `end` string>>>>>>"
    rows = documents.json_records(spark, str(tmp_path / "p.json"), schema)
    assert rows.first()["pointer"] == "/results/0"
    assert [tuple(r) for r in documents.members(rows).collect()] == [("m1", "u1", "3", D(1, 1), None)]


def test_mentions_longest_first(spark):
    owners = spark.createDataFrame([(1, "Cork"), (2, "Cork City"), (3, "City Hall"), (4, "cork"), (5, None)], "o int, l string")
    texts = spark.createDataFrame([(1, "In Cork City Hall"), (2, "Corkscrew, CORK!"), (3, None), (4, "")], "k int, t string")
    got = sorted((r["k"], r["owner"], r["at"]) for r in mentions.detect(texts, owners, "k", "t", "o", "l").collect())
    # an earlier match that ends within "City Hall" stays, as it isn't inside it
    assert got == [(1, 2, 2), (1, 3, 3), (2, 1, 2), (2, 4, 2)]
    assert mentions.detect(texts, owners.limit(0), "k", "t", "o", "l").count() == 0


def test_mentions_keep_letters_apart_that_sql_does(spark, tmp_path):
    """Sharp s and ss, a last sigma, a dotted I, a long s, a composed text and letters of late Unicode: as the query's SQL has them."""
    import duckdb

    from chronolith import catalog

    labels = ["gro\u00dfe stra\u00dfe neun", "grosse strasse acht", "kos\u03c3 odos\u03c3 hier", "istanbul bei nacht", "lang\u017fam ist es", "caf\u00e9 am markt", "\u0870\u0871 a b", "x y"]
    texts = [*labels, *(x.upper() for x in labels), "Grosse Strasse neun", "GRO\u1e9eE STRA\u1e9eE NEUN", "gro\u00dfe stra\u00dfe acht", "KOS\u03a3 ODOS\u03a3 hier", "\u0130stanbul bei nacht", "langsam ist es", "Cafe\u0301 am Markt", "a\u0870\u0871 a b", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(labels)), "item_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    with duckdb.connect() as c:
        for t in ("documents", "benchmark"):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
        want = sorted(c.sql(catalog.ORACLE["e04_mentions"]).fetchall())
    assert sorted(map(tuple, catalog.QUERIES["e04_mentions"](spark, str(tmp_path)).collect())) == want


def test_names_sets_and_context(spark):
    people = spark.createDataFrame([(1, "Mary Ann Roe", True), (2, "John Roe", False), (3, "Ann Poe", True)], "o int, n string, ok boolean")
    said = spark.createDataFrame([(1, "mary ann roe"), (2, "Deputy Roe"), (3, "Roe"), (4, "Ann Mary Roe"), (5, "Deputy Ann"), (6, None)], "k int, s string")
    got = {r["k"]: (r["status"], r["o"]) for r in mentions.by_name(said, people, "k", "s", "o", "n", F.col("ok")).collect()}
    assert got == {1: ("resolved", 1), 2: ("resolved", 1), 3: ("refused", None), 4: ("unresolved", None), 5: ("ambiguous", None), 6: ("refused", None)}
    candidates = spark.createDataFrame([(1, 1, "x"), (1, 2, "x"), (2, 1, None), (2, 2, None), (3, 3, "z")], "k int, o int, clue string")
    context = spark.createDataFrame([(1, "x"), (2, "y")], "o int, clue string")
    assert {r["k"]: (r["status"], r["o"]) for r in mentions.narrow(candidates, context, "k", "o", "clue").collect()} == {1: ("resolved by context", 1), 2: ("ambiguous", None), 3: ("resolved", 3)}


def test_text_columns(spark):
    def one(f, value):
        return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]

    assert one(mentions.strip_preposition, "representing Cork") == "Cork"
    assert one(mentions.committee_core, "Joint Committee on the Environment") == "environment"
    assert one(mentions.names_a_set, "Members named Roe") is True and one(mentions.names_a_set, None) is False
    assert one(mentions.days_said, "on 4 March 1999.") == date(1999, 3, 4) and one(mentions.days_said, "on 31 June 1999") is None
    assert one(mentions.strict_day, "2020-01-01T00:00:00Z") == D(1, 1) and one(mentions.strict_day, "2020-01-01x") is None and one(mentions.strict_day, "2020-02-30") is None
    assert one(mentions.redact, "http://u:p@h/x Bearer abc password=1 q=2") == "http://***@h/x Bearer *** password=*** q=2"
    assert one(mentions.percent_encoded, "a b/ü~") == "a%20b%2F%C3%BC~"
    assert one(mentions.is_ncname, "a-b.1") is True and one(mentions.is_ncname, "1a") is False


def test_gate(spark):
    frame = spark.createDataFrame([(i, "x") for i in range(150)], "a int, b string")
    tables, frames = {"things": {"a"}}, {"things": frame}
    assert gate.run(spark, "SELECT count(*) AS n FROM things WHERE a > 3", tables, frames) == [(146,)]
    for bad in ("DROP TABLE things", "SELECT * FROM other", "SELECT a FROM things; SELECT 1", "SELECT a FROM things WHERE a IN (SELECT a FROM things)", "SELECT a FROM things LIMIT 500", "SELECT a FROM things", "WITH t AS (SELECT 1) SELECT * FROM t", "SELECT explode(array(1))", "INSERT INTO things SELECT 1", "x" * 40_000):
        with pytest.raises(gate.Refused):
            gate.run(spark, bad, tables, frames)
    with pytest.raises(Exception, match="b"):
        gate.run(spark, "SELECT b FROM things", tables, frames)


def test_reconciliation_round(spark):
    names = "resource string, hash string, identity string, status string, dirty boolean, next_check timestamp"
    old = spark.createDataFrame([(r, "h", None, "pending", d, datetime(2030, 1, 1)) for r, d in (("none", True), ("one", True), ("many", True), ("clean", False), ("stale", False), ("kept", False))], names)
    candidates = spark.createDataFrame([("one", "x"), ("many", "x"), ("many", "y"), ("clean", "x")], "resource string, identity string")
    reviews = spark.createDataFrame([("stale", "g", "accepted", "z"), ("kept", "h", "accepted", "z")], "resource string, hash string, decision string, identity string")
    out = resolve.reconcile(old, candidates, reviews, "2024-01-01")
    assert {r["resource"]: (r["status"], r["identity"], r["was_due"]) for r in out.collect()} == {
        "none": ("pending", None, True), "one": ("accepted", "x", True), "many": ("ambiguous", None, True), "clean": ("pending", None, False), "stale": ("stale review", None, True), "kept": ("accepted", "z", True)}
    again = resolve.reconcile(out.drop("was_due"), candidates, reviews.where("resource = 'kept'"), "2024-01-02")
    assert not again.where("resource = 'kept'").first()["was_due"]


def test_names_by_language(spark):
    rows = [(1, "en", "Old", D(1, 1), D(2, 1)), (1, "en", "New", D(2, 2), None), (1, "en", "new ", D(2, 2), None), (1, "ga", "A", D(1, 1), D(2, 1)), (1, "ga", "B", D(1, 1), D(2, 1))]
    got = resolve.name_by_language(spark.createDataFrame(rows, "o int, lang string, l string, s date, e date"), "o", "lang", "l").collect()
    assert {r["lang"]: (r["label"], r["status"]) for r in got} == {"en": ("New", "chosen"), "ga": (None, "ambiguous")}


def test_deep_closure(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(12)], "child int, parent int")
    out = hierarchy.closure(e, e.select("child"))
    assert out.count() == sum(range(2, 14)) and out.agg(F.max("depth")).first()[0] == 12
    with pytest.raises(ValueError, match="deeper"):
        hierarchy.closure(e, e.select("child"), max_depth=5)
    links = spark.createDataFrame([(10, 3), (11, 9)], "item int, concept int")
    assert sorted(r["item"] for r in hierarchy.subject_search(links, e, "item", "concept", [5]).collect()) == [10]
    assert hierarchy.subject_search(links, e, "item", "concept", [5], narrower=False).count() == 0


def test_search_is_built_from_the_question(spark):
    parts = spark.createDataFrame([(1, 1, "speech"), (1, 2, "question"), (2, 1, "speech"), (3, 1, "speech")], "record int, ordinal int, kind string")
    sittings = spark.createDataFrame([(1, "dail", D(1, 1)), (2, "seanad", D(2, 1))], "record int, body string, day date")
    links = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "record int, concept int")
    tree = spark.createDataFrame([(11, 10), (12, 99)], "child int, parent int")
    ask = lambda **q: sorted({r["record"] for r in search.contributions(parts, sittings, links, tree, **q).collect()})
    assert ask() == [1, 2, 3] and ask(bodies=["dail"]) == [1] and ask(first="2020-01-15") == [2] and ask(works=[3]) == [3]
    assert ask(subjects=[10]) == [1, 2] and ask(subjects=[10], narrower=False) == [1] and ask(subjects=[10], last="2020-01-15") == [1]


def test_plan_answers(spark):
    r, sf = semantic.Requirement, "/root/testdata/sf0.001"
    label = semantic.Plan((r("member_name", "m", "name"), r("member_membership", "m", "t")), "label", "m", (semantic.Filter("t", "eq", 3),))
    assert semantic.answer_role(label) == "name" and semantic.compile_plan(spark, sf, label).columns == ["name"]
    with pytest.raises(ValueError, match="label"):
        semantic.answer_role(semantic.Plan((r("member_party", "m", "p"),), "label", "m"))
    one = semantic.Plan((r("member_name", "m", "name"),), "entity", "m", (semantic.Filter("name", "eq", "Customer#000000007"),))
    assert tuple(semantic.compile_plan(spark, sf, one).first()) == (7, "resolved")
    many = semantic.Plan((r("committee_kind", "c", "k"),), "entity", "c", (semantic.Filter("k", "exists"),))
    assert semantic.compile_plan(spark, sf, many).first()["status"] == "ambiguous"
    for fact in semantic.FACTS:
        assert semantic.compile_plan(spark, sf, semantic.Plan((r(fact, "x", "y"),), "count", "x")).first()["n"] >= 0


def test_contract_types_items_and_unknown(spark):
    df = spark.createDataFrame([(1, ["a"], "q")], "a int, b array<string>, c string")
    got = checks.contract(df, ["a"], {}, {"a": "bigint"}, {"b": 2}, ["a", "b"])
    assert sorted(map(tuple, got.collect())) == [("a", "type", 1), ("b", "items", 1), ("c", "unknown", 1)]
    q = spark.createDataFrame([("g", "member", "s", "name", "o"), ("g", "member", "s", "title", "o")], "g string, family string, s string, p string, o string")
    assert [r["p"] for r in checks.owned(q, {"member": ["name"], "bill": ["title"]}).collect()] == ["title"]
    assert [tuple(r) for r in checks.terms_outside(q, ["name"]).collect()] == [("title", 1)]
    assert checks.within_budget({"mb": 9}, {"mb": 10}) == ["mb"]
    with pytest.raises(RuntimeError):
        checks.within_budget({"mb": 11}, {"mb": 10})
