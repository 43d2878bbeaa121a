"""Paged services, captures, marked-up documents, transforms and writers on small invented rows."""

import hashlib
import json
import threading
from datetime import date
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from chronolith.sources import paged, sinks, transforms, xml

D = lambda m, d: date(2020, m, d)


@pytest.fixture
def service():
    """A service of 23 records that is busy at the first request of each page."""
    seen = set()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: int(v[0]) for k, v in parse_qs(urlsplit(self.path).query).items()}
            if q["skip"] not in seen:
                seen.add(q["skip"])
                self.send_response(503)
                self.end_headers()
                return
            body = json.dumps({"results": [{"id": i} for i in range(23)][q["skip"] : q["skip"] + q["limit"]]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/things"
    server.shutdown()


def test_pages_are_harvested_whole(spark, service):
    rows = paged.harvest(spark, service, limit=5, lanes=2).collect()
    assert sorted(json.loads(r["record"])["id"] for r in rows) == list(range(23))
    assert {r["pointer"] for r in rows if r["page"] == 4} == {"/results/0", "/results/1", "/results/2"}


def write_capture(tmp_path, sizes, limit=2):
    rows, skip = [], 0
    for i, n in enumerate(sizes):
        body = json.dumps({"results": [{"n": skip + j} for j in range(n)]})
        (tmp_path / f"p{i}.json").write_text(body)
        rows.append((f"p{i}.json", skip, limit, n, hashlib.sha256(body.encode()).hexdigest()))
        skip += limit
    return rows


def test_replay_needs_a_complete_set(spark, tmp_path):
    rows = write_capture(tmp_path, [2, 2, 1])
    manifest = lambda r: spark.createDataFrame(r, "file string, skip int, limit int, count int, sha256 string")
    got = paged.replay(spark, str(tmp_path), manifest(rows)).collect()
    assert sorted((r["skip"], r["pointer"], json.loads(r["record"])["n"]) for r in got) == [(0, "/results/0", 0), (0, "/results/1", 1), (2, "/results/0", 2), (2, "/results/1", 3), (4, "/results/0", 4)]
    for bad in (rows[:1] + rows[2:], rows[1:], [(*rows[0][:4], "0"), *rows[1:]], [(*rows[0][:3], 1, rows[0][4]), *rows[1:]], [("none", 0, 2, 2, "0")], []):
        with pytest.raises(ValueError, match="incomplete"):
            paged.replay(spark, str(tmp_path), manifest(bad))


def test_capture_choice_and_batches(spark):
    runs = [("a", "x", "2020-01-01", True, False), ("b", "x", "2020-02-01", True, True), ("c", "x", None, False, False), ("d", "y", "2020-01-01", False, False), ("e", "y", "2019-01-01", True, False)]
    df = spark.createDataFrame(runs, "run string, endpoint string, completed_at string, complete boolean, filtered boolean")
    assert {r["run"] for r in paged.choose_capture(df).collect()} == {"a", "e"}
    assert {r["run"] for r in paged.choose_capture(df, authoritative=False).collect()} == {"b", "d"}
    assert {r["run"] for r in paged.choose_capture(df, {"x": "c"}).collect()} == {"c", "e"}
    assert paged.batches([("a", 3), ("b", 3), ("c", 5), ("d", 1)], 2, 6) == [["a", "b"], ["c", "d"]]
    with pytest.raises(ValueError):
        paged.batches([("a", 7)], 2, 6)


def test_registry_and_windows(spark, tmp_path):
    (tmp_path / "ok.json").write_text('{"offices": [{"office": "a", "kind": "minister"}]}')
    (tmp_path / "bad.json").write_text('{"offices": [{"office": "a", "office": "b"}]}')
    assert [tuple(r) for r in paged.registry(spark, str(tmp_path / "ok.json"), "office string,kind string", "offices").collect()] == [("a", "minister")]
    with pytest.raises(ValueError, match="repeated key"):
        paged.registry(spark, str(tmp_path / "bad.json"), "office string", "offices")
    w = [tuple(r) for r in paged.month_windows(spark, "2020-01-15", "2020-03-02").orderBy("s").collect()]
    assert w == [(D(1, 15), D(1, 31)), (D(2, 1), D(2, 29)), (D(3, 1), D(3, 2))]


DEBATE = """<akomaNtoso xmlns="http://x"><debate><debateSection eId="s1"><speech eId="p1" by="#A" as="#chair">
<recordedTime time="10:00"/>Good  <b>morning</b></speech><debateSection eId="s2"><question eId="q1" by="#B">Why?</question></debateSection></debateSection>
<division eId="d1"><ta><person refersTo="#A"/></ta><nil><person refersTo="#B"/><person refersTo="#C"/></nil></division></debate></akomaNtoso>"""


def test_debate_parts_and_votes(spark):
    docs = spark.createDataFrame([("u", DEBATE.encode()), ("bad", b"<a>"), ("none", None)], "uri string, content binary")
    rows = {r["eid"]: r for r in xml.debate_parts(docs).collect() if r["uri"] == "u"}
    assert {k: (r["ordinal"], r["kind"], r["parent"]) for k, r in rows.items()} == {"s1": (1, "debateSection", None), "p1": (1, "speech", "s1"), "s2": (2, "debateSection", "s1"), "q1": (1, "question", "s2"), "d1": (2, "division", None)}
    assert (rows["p1"]["text"], rows["p1"]["at"], rows["p1"]["by"], rows["q1"]["text"]) == ("Good morning", "10:00", "#A", "Why?")
    assert [r["uri"] for r in xml.debate_parts(docs).where("error IS NOT NULL").collect()] == ["bad"]
    assert sorted((r["side"], r["member"]) for r in xml.divisions(docs).collect()) == [("nil", "#B"), ("nil", "#C"), ("ta", "#A")]
    assert xml.debate_parts(docs.limit(0)).count() == 0


def test_taxonomy(spark):
    text = """<r:RDF xmlns:r="r" xmlns:s="s"><s:Concept r:about="c1"><s:prefLabel xml:lang="en">Tax</s:prefLabel>
    <s:prefLabel xml:lang="ga">Cain</s:prefLabel><s:altLabel r:resource="l1"/><s:broader r:resource="c0"/></s:Concept>
    <s:Concept r:about="c2"><s:status>RETIRED</s:status><s:prefLabel xml:lang="en">Old</s:prefLabel></s:Concept>
    <s:Label r:about="l1"><s:literalForm xml:lang="en">Levy</s:literalForm></s:Label></r:RDF>"""
    rows = xml.taxonomy(spark.createDataFrame([(text.encode(),), (None,)], "content binary")).collect()
    assert sorted(map(tuple, rows)) == [("c1", "Levy", False, "c0"), ("c1", "Tax", True, "c0")]


RANGE = "dateRange struct<start string, `end` string>"
MEMBER = f"""record struct<member struct<memberCode string, fullName string, showAs string, firstName string, lastName string, gender string,
    memberships array<struct<membership struct<uri string, house struct<houseCode string, houseNo string>, {RANGE},
    represents array<struct<represent struct<uri string, representType string>>>, parties array<struct<party struct<uri string, partyCode string, {RANGE}>>>,
    offices array<struct<office struct<officeName struct<showAs string>, {RANGE}>>>>>>>>"""


def from_json(spark, rows, schema):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.from_json("j", schema).alias("x")).select("x.*")


def test_members_in_full(spark):
    span = lambda s, e=None: {"start": s, "end": e}
    m = {"membership": {"uri": "m1", "house": {"houseCode": "dail", "houseNo": "33"}, "dateRange": span("2020-02-08"), "represents": [{"represent": {"uri": "k1", "representType": "constituency"}}],
         "parties": [{"party": {"uri": "p1", "partyCode": "P", "dateRange": span("2020-02-08")}}, {"party": {"uri": "p2", "partyCode": "Q", "dateRange": span("2020-13-40")}}, {"party": {"uri": "p3", "partyCode": "R", "dateRange": span("2020-05-02", "2020-05-01")}}],
         "offices": [{"office": {"officeName": {"showAs": "Chair"}, "dateRange": span("2020-03-01", "2020-04-01")}}]}}
    rows = [{"record": {"member": {"memberCode": "A", "fullName": "Ann A", "memberships": [m]}}}, {"record": {"member": {"fullName": "No code", "memberships": []}}}]
    t = transforms.members(from_json(spark, rows, MEMBER))
    assert [tuple(r) for r in t["memberships"].collect()] == [("A", "m1", "dail", 33, D(2, 8), None)]
    assert [r["party"] for r in t["parties"].collect()] == ["p1"]
    assert [(r["office"], r["e"]) for r in t["offices"].collect()] == [("Chair", D(4, 1))]
    assert sorted((r["pointer"], r["reason"]) for r in t["rejected"].collect()) == [("/member", "no member code"), ("/member/memberships/0/parties/1", "no start"), ("/member/memberships/0/parties/2", "ends before it starts")]
    prior = t["parties"].withColumn("party", F.lit("p2"))
    kept = transforms.keep_prior_parties(t["parties"], t["rejected"], prior)
    assert sorted((r["party"], r["retained"]) for r in kept.collect()) == [("p1", False), ("p2", True)]
    assert sorted(map(tuple, transforms.references(t).collect())) == [("constituency", "k1", 1), ("office", "Chair", 1), ("party", "p1", 1)]
    assert transforms.observations(t["offices"].union(t["offices"])).count() == 1


def test_houses_parties_and_constituencies(spark):
    house = f"record struct<house struct<uri string, houseCode string, houseNo string, showAs string, seats string, {RANGE}>>"
    h = lambda uri, code, start="2020-02-08": {"record": {"house": {"uri": uri, "houseCode": code, "houseNo": "33", "showAs": "33rd", "seats": "160", "dateRange": {"start": start, "end": None}}}}
    good, bad = transforms.houses(from_json(spark, [h("t1", "dail"), h("t2", "dail & seanad"), h("t3", "lords"), h("t4", "seanad", "soon")], house))
    assert [r["term"] for r in good.collect()] == ["t1"]
    assert {r["term"]: r["reason"] for r in bad.collect()} == {"t2": "combined record", "t3": "unknown house", "t4": "no start"}
    party = "record struct<party struct<uri string, partyCode string, showAs string>, house struct<uri string>>"
    good, bad = transforms.parties(from_json(spark, [{"record": {"party": {"uri": "p", "partyCode": "Independent", "showAs": " I "}, "house": {"uri": "t"}}}, {"record": {"party": {"uri": "q"}, "house": {"uri": "t"}}}], party))
    assert [tuple(r) for r in good.collect()] == [("p", "t", "Independent", "I", True)] and [r["reason"] for r in bad.collect()] == ["no code"]
    seat = "record struct<constituencyOrPanel struct<uri string, representType string, representCode string, showAs string>, house struct<uri string, houseCode string>>"
    s = lambda kind, code: {"record": {"constituencyOrPanel": {"uri": kind + code, "representType": kind, "representCode": "c", "showAs": "C"}, "house": {"uri": "t", "houseCode": code}}}
    good, bad = transforms.constituencies(from_json(spark, [s("constituency", "dail"), s("panel", "dail"), s("ward", "dail")], seat))
    assert good.count() == 1 and {r["kind"]: r["reason"] for r in bad.collect()} == {"panel": "kind of the other house", "ward": "unknown kind"}


BILL = """record struct<bill struct<uri string, billYear string, billNo string, shortTitleEn string, status string, lastUpdated string,
    stages array<struct<event struct<uri string, showAs string, dates array<struct<date string>>>>>, events array<struct<event struct<uri string, showAs string, dates array<struct<date string>>>>>,
    sponsors array<struct<sponsor struct<`by` struct<uri string>, `as` struct<showAs string>, isPrimary boolean>>>>>"""


def test_bills(spark):
    stage = {"event": {"uri": "s1", "showAs": "First", "dates": [{"date": "2020-01-02"}]}}
    one = {"uri": "b1", "billYear": "2020", "billNo": "1", "stages": [stage, stage], "events": [{"event": {"uri": "e1", "showAs": "Published", "dates": [{"date": "x"}]}}],
           "sponsors": [{"sponsor": {"by": {"uri": "A"}, "isPrimary": True}}, {"sponsor": {"as": {"showAs": "Minister"}, "isPrimary": False}}, {"sponsor": {"as": {"showAs": " "}}}]}
    t = transforms.bills(from_json(spark, [{"record": {"bill": one}}, {"record": {"bill": {"uri": "b2", "billYear": "2020"}}}], BILL))
    assert [tuple(r) for r in t["stages"].collect()] == [("b1", "stage", "s1", "First", D(1, 2))] and t["events"].count() == 0
    assert sorted((r["bill"], r["reason"]) for r in t["rejected"].collect()) == [("b1", "neither person nor office"), ("b1", "no date"), ("b2", "no stages")]
    decisions = spark.createDataFrame([("Minister", "office/1", "accepted"), ("Minister", "office/2", "rejected")], "capacity string, identity string, status string")
    assert sorted(map(tuple, transforms.sponsor_links(t["sponsors"], decisions).collect())) == [("b1", 0, "A", "person"), ("b1", 1, "office/1", "office")]


def test_committees_offices_and_references(spark):
    schema = f"""record struct<uri string, houseNo string, houseCode string, committeeCode string, committeeDateRange struct<start string, `end` string>, committeeName array<struct<nameEn string, nameGa string, {RANGE}>>>"""
    rows = [{"record": {"uri": "c1", "houseNo": "33", "houseCode": "dail", "committeeDateRange": {"start": "2020-01-01"}, "committeeName": [{"nameEn": "Health", "nameGa": None, "dateRange": {"start": "2020-01-01"}}]}}, {"record": {"uri": "c2", "houseNo": "33", "houseCode": "dail", "committeeDateRange": {"end": "2020-01-01"}}}]
    good, labels, bad = transforms.committees(from_json(spark, rows, schema))
    assert [r["committee"] for r in good.collect()] == ["c1"] and [(r["lang"], r["label"]) for r in labels.collect()] == [("en", "Health")]
    assert [tuple(r) for r in bad.collect()] == [("c2", "range without start")]
    reg = spark.createDataFrame([("o1", "minister", "u1", "Minister", "2020-01-01", None)], "office string, kind string, unit string, label string, s string, e string")
    assert sorted((r["office"], r["kind"]) for r in transforms.offices(reg).collect()) == [("o1", "minister"), ("u1", "unit")]
    parts = spark.createDataFrame([("#A",), ("#B",), ("#Z",), (None,)], "by string")
    owners = spark.createDataFrame([("A", "m1"), ("B", "m2"), ("B", "m3")], "alias string, owner string")
    assert {r["by"]: (r["owner"], r["status"]) for r in transforms.resolve_references(parts, owners).collect()} == {"#A": ("m1", "resolved"), "#B": (None, "ambiguous"), "#Z": (None, "unresolved"), None: (None, "absent")}


def test_cabinet_episodes(spark):
    rows = [(1, "h1", D(1, 1), D(1, 10)), (1, "h2", D(1, 11), D(1, 20)), (1, "h3", D(1, 22), None), (1, "h4", D(2, 1), D(2, 2))]
    got = transforms.episodes(spark.createDataFrame(rows, "m int, h string, s date, e date"), ["m"], "h").orderBy("s").collect()
    assert [tuple(r) for r in got] == [(1, D(1, 1), D(1, 20), 2, "h1,h2"), (1, D(1, 22), None, 2, "h3,h4")]


def test_immutable_pages_and_hash_store(spark, tmp_path):
    pages = spark.createDataFrame([(0, "a"), (1, "b")], "page int, body string")
    path = str(tmp_path / "raw")
    assert sinks.write_pages(pages, path, "x", "2020-01-01", "r") == sinks.write_pages(pages, path, "x", "2020-01-01", "r")
    with pytest.raises(ValueError, match="other pages"):
        sinks.write_pages(pages.limit(1), path, "x", "2020-01-01", "r")
    docs, store = spark.createDataFrame([("u", "t"), ("v", "t"), ("w", "z")], "uri string, content string"), str(tmp_path / "store")
    assert sinks.write_by_hash(docs, store).count() == 3
    sinks.write_by_hash(docs, store)
    assert spark.read.parquet(store).count() == 2
    expected = sinks.write_by_hash(docs, store).where("uri = 'u'").union(spark.createDataFrame([("q", "0")], "uri string, sha256 string"))
    files = tmp_path / "files"
    files.mkdir()
    (files / "a.xml").write_text("t")
    assert {r["uri"]: r["status"] for r in paged.documents_by_hash(spark, str(files), expected).collect()} == {"u": "present", "q": "missing"}


def test_lines_rebuild_and_catalog(spark, tmp_path):
    names = "g string, family string, s string, p string, o string, o_dt string"
    old = spark.createDataFrame([("g1", "f", "s", "p", "a", "string"), ("g2", "f", "s", "p", "b", "string"), ("g3", "f", "s", "p", "c", "string")], names)
    new = spark.createDataFrame([("g1", "f", "s", "p", "a", "string"), ("g2", "f", "s", "p", "x", "int")], names)
    path = str(tmp_path / "store")
    sinks.rebuild(old, path)
    assert [r["g"] for r in sinks.rebuild(new, path).collect()] == ["g3"]
    assert sorted((r["g"], r["o"]) for r in spark.read.parquet(path).collect()) == [("g1", "a"), ("g2", "x"), ("g3", "c")]
    sinks.write_lines(new, str(tmp_path / "lines"), graphs=True)
    assert [r["value"] for r in spark.read.text(str(tmp_path / "lines")).collect()] == ['<s> <p> "a" <g1> .', '<s> <p> "x"^^<int> <g2> .']
    entries = spark.createDataFrame([("a", 1, 2), ("a", 1, 2)], "resource string, started_at int, finished_at int")
    with pytest.raises(ValueError, match="refused"):
        sinks.publish_catalog(entries, str(tmp_path / "catalog"))
    sinks.publish_catalog(entries.limit(1), str(tmp_path / "catalog"))
    sinks.append(entries, str(tmp_path / "log"))
    sinks.append(entries, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
