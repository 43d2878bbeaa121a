"""The training-data operators against brute force, and on awkward rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronolith.llm import automata, dart, descent, importance, licences, mixing, pieces, quality_rules, queries, recurrent, toxicity
from chronolith.llm.common import components, cut

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key int, h string, c int, n int, size int, v string, y int, rep int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), "x", 1, "h", 2, 3, 4, "v", 5, 6) for i, t, lang, src in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    r = np.random.Generator(np.random.PCG64(1))
    words = ["".join(r.choice(list("abcdefgh"), 4)) for _ in range(300)]
    text = lambda k: " ".join(r.choice(words, k))
    out = [(i, text(int(r.integers(5, 80))), "en", f"src{i % 3}") for i in range(40)]
    passage = text(40)
    out += [(100, passage + " " + text(5), "en", "src0"), (101, text(3) + " " + passage, "de", None), (102, out[0][1], "en", "src1"), (103, out[0][1] + " tail", "en", "src1")]
    out += [(200, None, "en", "src0"), (201, "", None, "src0"), (202, " \n\t", "en", "src2"), (203, "é", "fr", "src2"), (104, out[1][1], "en", "src1"), (104, out[1][1], "en", "src1")]
    out += [(300, text(20_000), "en", "src0"), (None, "null id here", "en", "src0"), (None, None, None, None)]
    return out


def labels_of(spark, ids):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in ids], "doc_id bigint, quality int, toxic int")


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_awkward_and_empty_tables(spark, rows):
    labels = labels_of(spark, range(40))
    runs = {
        "mix": lambda d: mixing.mix(d, F.array("source"), lambda s: [1.0] * len(s)),
        "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels, epochs=1)),
        "dart": dart.near_duplicates,
        "pieces": lambda d: pieces.encode(d, ids=False),
        "lm": lambda d: recurrent.score(d, epochs=1),
        "importance": lambda d: importance.classify(d, labels),
        "passages": lambda d: automata.remove_repeats(d, digest=True),
        "licences": licences.recognise,
        "rules": quality_rules.assess,
    }
    docs, none = table(spark, rows), table(spark, [])
    for name, run in runs.items():
        assert run(docs).count() == len(rows), name
        assert run(none).count() == 0, name


def test_mix_reaches_targets(spark, rows):
    got = mixing.mix(table(spark, rows), F.array("source"), lambda s: [3.0, 1.0, 2.0, 3.0][: len(s)]).collect()
    taken = Counter()
    for r in got:
        assert r["taken"] <= 2 * r["size"]
        taken[r["sources"][0]["source"]] += r["taken"]
    for r in got:
        assert abs(taken[r["sources"][0]["source"]] - r["sources"][0]["target"]) <= 1


def test_mix_of_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e f g h i j", "s"), (5, "k l", "s"), (None, "m n o p q r s t", "s"), (None, "u v", "s"), (6, "w x y", "t"), (6, "w x y", "t"), (7, None, "t"), (None, None, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, source string, size int")
    mixed = mixing.materialise(cut(docs), F.array("source"), lambda s: [1.0] * len(s)).collect()
    words = Counter()
    for r in mixed:
        words[r["source"]] += len(r["text"].split())
    # 150 % of 28 words in equal shares, of which the second source can only give 12
    assert dict(words) == {"s": 30, "t": 12}
    assert {(r["doc_id"], r["text"][0]) for r in mixed} <= {(5, "a"), (5, "k"), (None, "m"), (None, "u"), (6, "w")} and len(mixed) > 8


def test_flow_with_overlapping_sources(spark):
    """Least repetition cost, against all ways to route small patterns."""
    r = np.random.Generator(np.random.PCG64(4))
    for _ in range(30):
        patterns = [(["a"], int(r.integers(0, 4))), (["b"], int(r.integers(0, 4))), (["a", "b"], int(r.integers(1, 4)))]
        quotas = {"a": int(r.integers(0, 7)), "b": int(r.integers(0, 7))}
        got = Counter()
        for p, s, lo, hi in mixing.route(patterns, quotas, 2):
            assert s in patterns[p][0] and 0 <= lo < hi <= 2 * patterns[p][1]
            got[p, s] += hi - lo
        cost = lambda used: sum(max(0, u - size) for u, (_, size) in zip(used, patterns))
        best = None
        for only_a in range(min(quotas["a"], 2 * patterns[0][1]) + 1):
            for only_b in range(min(quotas["b"], 2 * patterns[1][1]) + 1):
                for both_a in range(min(quotas["a"] - only_a, 2 * patterns[2][1]) + 1):
                    for both_b in range(min(quotas["b"] - only_b, 2 * patterns[2][1] - both_a) + 1):
                        x = (-(only_a + only_b + both_a + both_b), cost((only_a, only_b, both_a + both_b)))
                        best = x if best is None or x < best else best
        used = [sum(v for (q, _), v in got.items() if q == p) for p in range(3)]
        assert (-sum(used), cost(used)) == best


def test_vectors_against_brute_force(spark):
    r = np.random.Generator(np.random.PCG64(2))
    x = r.normal(size=(300, 16))
    x[100:180] = x[0] + 0.03 * r.normal(size=(80, 16))
    x[200:205] = 2 * x[1]
    rows = [(i, [float(y) for y in v.astype(np.float32)]) for i, v in enumerate(x)]
    rows += [(400, None), (401, [0.0] * 16), (402, [math.nan] + [1.0] * 15), (403, [None] + [1.0] * 15), (404, []), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 9) for i, v in rows], "vec_id bigint, embedding array<float>, rep int")
    got = {r["vec_id"]: r for r in descent.near_duplicates(df).collect() if r["vec_id"] is not None}
    m = np.array([v for _, v in rows[:300]])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    links = (m @ m.T >= 0.95) & ~np.eye(300, dtype=bool)
    assert [got[i]["n_links"] for i in range(300)] == links.sum(1).tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(400, 405))
    assert got[150]["component_id"] == 0 and not got[150]["kept"]
    assert descent.near_duplicates(df.limit(0)).count() == 0


def test_links_between_tight_groups(spark):
    r = np.random.Generator(np.random.PCG64(5))
    x = r.normal(size=(700, 16))
    turn = lambda v, w, by: np.cos(by) * v / np.linalg.norm(v) + np.sin(by) * w / np.linalg.norm(w)
    # groups of near copies, two by two at an angle whose cosine is above 0.95
    for at, size in ((0, 40), (80, 300)):
        a = x[at] / np.linalg.norm(x[at])
        w = r.normal(size=16)
        w -= (w @ a) * a
        for g in range(2):
            x[at + g * size : at + (g + 1) * size] = turn(a, w, 0.3 * g) + 0.0005 * r.normal(size=(size, 16))
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r for r in descent.near_duplicates(df).collect()}
    m = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (m @ m.T >= 0.95) & ~np.eye(700, dtype=bool)
    assert links[0, 40:80].all() and links[80, 380:680].all()
    assert [got[i]["n_links"] for i in range(700)] == links.sum(1).tolist()
    assert {got[i]["component_id"] for i in range(80)} == {0} and {got[i]["component_id"] for i in range(80, 680)} == {80}


def test_low_recall_fails(spark):
    df = spark.createDataFrame([(i, [1.0, i / 100]) for i in range(10)], "vec_id bigint, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall"):
        descent.near_duplicates(df, min_recall=1.1, max_rounds=1)


def test_components(spark):
    df = spark.createDataFrame([(3, 2), (2, 1), (7, 8), (5, 5)], "a bigint, b bigint")
    assert dict(map(tuple, components(df).collect())) == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7}


def test_toxic_words_are_learned(spark):
    r = np.random.Generator(np.random.PCG64(3))
    words = ["".join(r.choice(list("abcdefghij"), 5)) for _ in range(400)]
    text = lambda i: " ".join([*r.choice(words, 60), *(["vile"] * (i % 4 == 0)), *r.choice(words, 20)])
    docs = table(spark, [(i, text(i), "en", "s") for i in range(800)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, train_on=F.col("doc_id") < 600)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    right = sum((got[i] >= 0.3) == (i % 4 == 0) for i in range(600, 800))
    assert right >= 194


def test_near_duplicates_found(spark, rows):
    got = {r["doc_id"]: r for r in dart.near_duplicates(table(spark, rows)).collect() if r["doc_id"] is not None}
    assert got[102]["component_id"] == 0 and got[104]["component_id"] == 1 and not got[102]["kept"]
    assert got[200]["kept"] and got[300]["kept"]


def test_sampled_segmentations_follow_the_lattice(spark):
    """Many draws of one short text against all of its segmentations: samples, their probabilities, and inclusion."""
    text, n = "dogs", 6000
    v = pieces.load()["pieces"]
    whole = " " + text

    def ways(at):
        if at == len(whole):
            yield (), 0.0
        for z in range(at + 1, len(whole) + 1):
            if whole[at:z] in v:
                i, rank = v[whole[at:z]]
                for ids, w in ways(z):
                    yield (i, *ids), w - math.log(rank + 2.0)

    weight = dict(ways(0))
    total = math.log(sum(math.exp(w) for w in weight.values()))
    p = {ids: math.exp(w - total) for ids, w in weight.items()}
    assert len(p) > 5
    rows = pieces.encode(spark.range(n).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))).collect()
    first, second = Counter(tuple(r["ids_1"]) for r in rows), Counter(tuple(r["ids_2"]) for r in rows)
    assert all(tuple(r["ids_1"]) != tuple(r["ids_2"]) for r in rows)
    for r in rows[:50]:
        assert abs(r["log_prob_1"] - math.log(p[tuple(r["ids_1"])])) < 1e-9 and abs(r["log_prob_2"] - math.log(p[tuple(r["ids_2"])])) < 1e-9
    for ids, q in p.items():
        then = sum(q * p[other] / (1 - p[other]) for other in p if other != ids)
        for count, want in ((first[ids], q), (second[ids], then)):
            assert abs(count - n * want) < 5 * math.sqrt(n * want * (1 - want)) + 1
        # what a sample weighs by its inclusion adds up to the text's whole mass of that segmentation
        if q > 0.02:
            hits = [math.exp(r[f"log_prob_{i}"] - r[f"log_inclusion_{i}"]) for r in rows for i in (1, 2) if tuple(r[f"ids_{i}"]) == ids]
            assert abs(sum(hits) / n - q) < 0.1 * q + 0.01


def test_lattice_room_is_dropped_and_filled_again():
    """Units kept from slice to slice give the samples that a lattice of their own gives."""
    v = pieces.Vocabulary(pieces.load(), 1.0)
    r = np.random.Generator(np.random.PCG64(12))
    texts = [" ".join("".join(r.choice(list("abcdefgh"), 5)) for _ in range(40)) for _ in range(30)]
    kept = pieces.Lattice(v, room=3000)
    for text in texts:
        out = []
        for lat in (kept, pieces.Lattice(v)):
            raw = np.frombuffer(text.encode(), np.uint8)
            data, starts, ends, row = pieces.units_of(raw, np.array([0, len(raw)]))
            units = lat.units(automata.bt.hashes(data, starts, ends), data, starts, ends)
            *samples, _ = pieces.sample(lat, units, row, np.array([7], np.uint64), 2)
            out.append([(lat.id[s["edges"]].tolist(), s["log_prob"].tolist()) for s in samples])
        assert out[0] == out[1] and kept.edges <= 3000


def jaccard(a, b):
    x, y = (Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (a.split(), b.split()))
    return sum((x & y).values()) / sum((x | y).values())


def test_near_duplicates_against_brute_force(spark):
    """A chain of ever further copies, many of them unlinked with the smallest of their bucket, small groups, and an id with two texts."""
    r = np.random.Generator(np.random.PCG64(8))
    words = ["".join(r.choice(list("abcdefgh"), 4)) for _ in range(500)]
    base = list(r.choice(words, 120))
    texts = {}
    for i in range(150):
        copy = list(base)
        for at in r.choice(120, int(r.integers(1, 7)), replace=False):
            copy[at] = str(r.choice(words))
        texts[i] = copy
    for i in range(150, 240, 3):
        one = list(r.choice(words, 60))
        for j in range(3):
            texts[i + j] = one[: 59 - j] + list(r.choice(words, 1 + 2 * j))
    rows = [(i, " ".join(w)) for i, w in texts.items()]
    other = list(r.choice(words, 80))
    rows += [(900, " ".join(other)), (900, " ".join(texts[239])), (901, " ".join(other[:79]))]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, key int, pivot int")
    parent = {i: i for i, _ in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    linked = 0
    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if a != b and jaccard(x, y) >= 0.8:
                linked += 1
                lo, hi = sorted((top(a), top(b)))
                parent[hi] = lo
    assert linked > 300 and len({top(i) for i in range(150)}) > 5
    got = {r["doc_id"]: r["component_id"] for r in dart.near_duplicates(df).collect()}
    assert got == {i: top(i) for i, _ in rows}


def test_encoding_round_trip(spark, rows):
    out = pieces.encode(table(spark, rows), k=2)
    for i in (1, 2):
        back = pieces.decode(out.withColumnRenamed("doc_id", "d"), f"ids_{i}")
        want = Counter((d, t or "") for d, t, _, _ in rows)
        assert all((r["d"], r["text"]) in want for r in back.collect() if r["text"] is not None)
    assert out.where("array_join(ids_1, ' ') = array_join(ids_2, ' ') AND size(ids_1) > 0").count() == 0


def test_sampled_pieces_query_gives_whole_encodings(spark, rows, tmp_path):
    """The query's own rows hold every id of both samples: each text comes back from them, and the digests are theirs."""
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op5_sampled_pieces(spark, str(tmp_path)).cache()
    want = sorted((str(i), t or "") for i, t, _, _ in rows)
    for i in (1, 2):
        some = out.where(f"ids_{i} IS NOT NULL")
        got = sorted((str(r["doc_id"]), r["text"]) for r in pieces.decode(some, f"ids_{i}").collect())
        assert (got == want) if i == 1 else not Counter(got) - Counter(want)
        assert some.where(f"size(ids_{i}) <> n_pieces_{i} OR digest_{i} <> xxhash64(ids_{i}) OR digest_{i} IS NULL").count() == 0
        assert out.where(f"ids_{i} IS NULL AND digest_{i} IS NOT NULL").count() == 0


def removals(docs):
    """What is left of each of (id, words): number of words, number removed, hash of the rest."""
    seen, want = {}, {}
    for i, w in docs:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            seen[key] = min(seen.get(key, i), i)
    for i, w in docs:
        gone = set()
        for k in range(len(w) - 12):
            if seen[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        left = [x for k, x in enumerate(w) if k not in gone]
        want[i] = (len(w), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest())
    return want


def test_passages_against_brute_force(spark, rows):
    want = removals([(i, WORD.findall(t or "")) for i, t, _, _ in rows if i is not None])
    got = {r["doc_id"]: tuple(r)[1:] for r in automata.remove_repeats(table(spark, rows), digest=True).collect() if r["doc_id"] is not None}
    assert got == want


def test_frequent_passages_against_brute_force(spark, monkeypatch):
    """Anchors above the bound on frequency, parts of passages in documents before and after the whole."""
    monkeypatch.setattr(automata, "HOT", 3)
    r = np.random.Generator(np.random.PCG64(9))
    words = ["".join(r.choice(list("abcdefgh"), 3)) for _ in range(200)]
    passage = list(r.choice(words, 60))
    docs = []
    for i in range(80):
        a, z = sorted(int(x) for x in r.integers(0, 61, 2))
        docs.append((i, [*r.choice(words, int(r.integers(0, 20))), *passage[a:z], *r.choice(words, int(r.integers(0, 20)))]))
    got = automata.remove_repeats(spark.createDataFrame([(i, "  ".join(w)) for i, w in docs], "doc_id int, text string"), digest=True)
    assert {x["doc_id"]: tuple(x)[1:] for x in got.collect()} == removals(docs)


def test_automaton_of_segments():
    segs = ["a b c d e f", "x a b c d", "a b c d y", "c  d\ne f", "q r s t"]
    lo, hi = np.array([5, 2, 9, 1, 4]), np.array([5, 2, 9, 1, 4])
    seg, place, first = automata._locate(pa.array([s.encode() for s in segs], pa.binary()), lo, hi, 3)
    got = set(zip(seg.tolist(), place.tolist(), first.tolist()))
    want = set()
    for i, s in enumerate(segs):
        w = s.split()
        for k in range(len(w) - 2):
            least = min(lo[j] for j, t in enumerate(segs) if any(t.split()[m : m + 3] == w[k : k + 3] for m in range(len(t.split()))))
            if least < hi[i]:
                want.add((i, k, int(least)))
    assert got == want and len(got) == len(seg) and (0, 0, 2) in got
    assert automata._pieces(np.array([1, 1, 2, 2, 2, 3]), 1) == [(0, 2), (2, 5), (5, 6)]


def test_lm_base_score_and_distribution(spark, rows):
    docs = table(spark, rows)
    train = F.coalesce(F.col("doc_id") < 35, F.lit(False))
    got = {r["doc_id"]: r for r in recurrent.score(docs, train_on=train, epochs=2).collect() if r["doc_id"] is not None}
    toks = lambda t: [w.translate(str.maketrans(licences.UPPER, licences.LOWER)) for w in WORD.findall(t or "")] + [None]
    count = Counter(w for i, t, _, _ in rows if i is not None and i < 35 for w in toks(t))
    n, v = sum(count.values()), len(count)
    for i, t, _, _ in rows:
        if i is not None:
            base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in toks(t))
            assert got[i]["n_tokens"] == len(toks(t)) and got[i]["n_known"] == sum(w in count for w in toks(t)) and got[i]["train_tokens"] == n
            assert abs(got[i]["base_score"] - base) < 1e-6 * max(1, -base)
    # all next words together have probability 1
    counts, c, net = recurrent.learn(docs.where(train).select(F.col("doc_id").alias("id"), "text"), 100, 10_000, 1, 1)
    place = np.arange(len(c.listed))
    cls, rank, inside = c.of(np.append(place, -1), np.append(c.counts, 0))
    h = np.full((len(cls), recurrent.HIDDEN), 0.1, np.float32)
    assert abs(np.exp(net.log_probs(h, cls, rank, inside).astype(float)).sum() - 1) < 1e-4


def test_lm_learns_from_every_document(spark):
    r = np.random.Generator(np.random.PCG64(7))
    words = [f"w{i}" for i in range(10)]
    ordered = lambda i: " ".join(words * 20)
    mixed = lambda i: " ".join(["w0", *r.permutation(words * 20)[:-1]])
    score = {}
    for text in (ordered, mixed):
        docs = table(spark, [(i, text(i), "en", "s") for i in range(200)] + [(1000, ordered(0), "en", "s")])
        got = recurrent.score(docs, train_on=F.col("doc_id") < 1000, max_words=1).where("doc_id = 1000").first()
        score[text] = got["score"]
    # no document fits the starting sample: what the order of words tells comes from all documents
    assert score[ordered] > score[mixed] + 1


def test_importance_on_held_out_labels(spark):
    """The quality classifier learns from a third of the labels and is judged on the others."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    kept = {r["doc_id"]: r["kept"] for r in importance.classify(docs, labels.where(learned)).collect()}
    held = labels.where(~learned).where("quality IS NOT NULL").collect()
    good = [kept[r["doc_id"]] for r in held if r["quality"] == 1]
    bad = [kept[r["doc_id"]] for r in held if r["quality"] == 0]
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.5 * len(bad), (sum(good), len(good), sum(bad), len(bad))


@pytest.mark.parametrize("quality", [None, 0, 1])
def test_one_sided_labels_keep_everything(spark, rows, quality):
    labels = spark.createDataFrame([] if quality is None else [(i, quality, quality) for i in range(20)], "doc_id bigint, quality int, toxic int")
    got = importance.classify(table(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(r["kept"] for r in got)
    scored = toxicity.score(table(spark, rows), toxicity.train(table(spark, rows), labels, epochs=1)).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)


def test_importance_rejects_bad(spark):
    r = np.random.Generator(np.random.PCG64(4))
    good, bad = ([x + "".join(r.choice(list("abcdef"), 4)) for _ in range(200)] for x in "gz")
    docs = table(spark, [(i, " ".join(r.choice(bad if i % 5 == 0 else good, 120)), "en", "s") for i in range(300)])
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(200)], "doc_id bigint, quality int")
    kept = {r["doc_id"] for r in importance.classify(docs, labels).where("kept").collect()}
    assert len([i for i in range(300) if i % 5 and i in kept]) >= 230 and len([i for i in range(0, 300, 5) if i in kept]) <= 6


def test_licence_rules(spark):
    texts = [licences.SENTENCES["apache.copy"][1] + " x.\n" + licences.SENTENCES["apache.disclaimer"][0], "a.\nReleased under the  MIT license!\nb", licences.SENTENCES["mit.grant"][0] + "\nq.\n" * 5 + licences.SENTENCES["mit.include"][0], "released under no licence.", None]
    got = {r["doc_id"]: r["licences"] for r in licences.recognise(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    assert got[1] == "mit" and got[2] == "" and got[3] == "" and got[4] == ""


def test_wrapped_licences(spark):
    """Texts as they are published: wrapped, numbered, in comments; and the same sentences too far apart or out of order."""
    import textwrap

    wrap = lambda *names, start="": "\n\n".join(textwrap.fill(licences.SENTENCES[n][-1], 72, initial_indent=start, subsequent_indent=start) for n in names)
    texts = {
        "mit": "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + wrap("mit.grant", "mit.include"),
        "apache-2.0": '/*\n' + wrap("apache.notice", start=" * ") + "\n *\n * You may obtain a copy of the License at\n *\n *     http://www.apache.org/licenses/LICENSE-2.0\n */",
        "bsd-2-clause bsd-3-clause": wrap("bsd.grant") + "\n\n1. " + wrap("bsd.source") + "\n2. " + wrap("bsd.binary") + "\n3. " + wrap("bsd.endorse"),
        "gpl-2.0": wrap("gpl2.notice", "gpl.warranty", start="# "),
        "lgpl-3.0": wrap("lgpl3.notice", "lgpl.warranty", start="// "),
        "zlib": wrap("zlib.as_is", "zlib.grant"),
        "": wrap("mit.include") + "\n\nOne.\n\nTwo.\n\nThree.\n\nFour.\n\n" + wrap("mit.grant"),
    }
    rows = [(i, t, "en", "s") for i, t in enumerate(texts.values())]
    got = {r["doc_id"]: r["licences"] for r in licences.recognise(table(spark, rows)).collect()}
    assert [got[i] for i in range(len(texts))] == list(texts)
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    assert {r[0]: r[4] for r in con.execute(licences.oracle()).fetchall()} == got


def test_rules_base_counts(spark, rows):
    extra = rows + [(500, "a b\na b\n\na b $$\nc " * 30, "en", "s")]
    got = {r["doc_id"]: r for r in quality_rules.assess(table(spark, extra)).collect() if r["doc_id"] is not None}
    for i, t, _, _ in extra:
        if i is None:
            continue
        w = WORD.findall(t or "")
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        rep = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 10 or 100 * len(rep) > 20 * len(w))


def test_distances_by_brute_force(spark):
    """Histograms, references, distances and verdicts of a few documents, character by character."""
    r = np.random.Generator(np.random.PCG64(21))
    q = quality_rules
    docs = []
    for i in range(40):
        lang = [*q.COMMON, "xx", None][i % 6]
        common = q.COMMON.get(lang, ["zzz"])
        words = [str(r.choice(common)) if r.random() < 0.5 else "".join(r.choice(list("abcdefghijÀéß"), 5)) for _ in range(int(r.integers(5, 120)))]
        text = " ".join(words) + ("|#{}~ 12, É." * int(r.integers(0, 60)))
        docs.append((i, text, lang, "s"))
    docs += [(90, None, "en", "s"), (91, "", "de", "s")]
    kinds = lambda c: 3 if c in " \t\n\v\f\r" else 7 if ord(c) > 127 else 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 4 if c in ".,;:!?'\"-()" else 5 if c in q.SYMBOLS else 6

    def histograms(text, lang):
        chars = np.bincount([kinds(c) for c in text or ""], minlength=8).astype(float)
        words = np.zeros(q.N_WORDS)
        for w in re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", text or ""):
            w = "".join(c.lower() if ord(c) < 128 else c for c in w)
            if lang in q.COMMON:
                words[q.COMMON[lang].index(w) if w in q.COMMON[lang] else -1] += 1
        return chars, words

    def js(p, m):
        p = p / p.sum()
        mid = (p + m) / 2
        kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, mid) if x > 0)
        return math.sqrt(max(0.0, (kl(p) + kl(m)) / 2))

    hist = {i: histograms(t, lang) for i, t, lang, _ in docs}
    mean = lambda k, least, langs: np.mean([h[k] / h[k].sum() for i, _, lang, _ in docs if lang in langs and (h := hist[i])[k].sum() >= least], axis=0)
    every = {*q.COMMON, "xx", None}
    got = {x["doc_id"]: x for x in q.assess(table(spark, docs)).collect()}
    for i, t, lang, _ in docs:
        chars, words = hist[i]
        own = {lang} if lang in q.COMMON else every
        dc = js(chars, mean(0, 200, own)) if chars.sum() else 0.0
        dw = js(words, mean(1, 50, own)) if lang in q.COMMON and words.sum() else 0.0
        assert abs(got[i]["class_distance"] - dc) < 1e-6 and abs(got[i]["word_distance"] - dw) < 1e-6, i
        # fewer documents than make a fence: the fixed distances hold
        bad = chars.sum() >= 200 and dc > 0.26 or words.sum() >= 50 and dw > 0.5
        assert got[i]["kept"] == (not got[i]["base_failed"] and not bad)
    assert len({x["kept"] for x in got.values()}) == 2


def test_rules_reject_planted_junk(spark):
    r = np.random.Generator(np.random.PCG64(6))
    listed = quality_rules.COMMON["en"]
    other = ["".join(r.choice(list("abcdefghijklmnop"), 6)) for _ in range(2000)]
    text = lambda share, n=300: " ".join(r.choice(listed) if r.random() < share else r.choice(other) for _ in range(n))
    rows = [(i, text(0.4), "en", "s") for i in range(400)]
    rows += [(1000 + i, text(0.06), "en", "s") for i in range(10)]
    rows += [(2000 + i, text(0.4).replace(" ", "|", 60), "en", "s") for i in range(10)]
    got = {r["doc_id"]: r for r in quality_rules.assess(table(spark, rows)).collect()}
    assert not any(r["base_failed"] or r["class_distance"] > 0.26 or r["word_distance"] > 0.5 for r in got.values())
    assert not any(got[i]["kept"] for i in got if i >= 1000)
    assert sum(got[i]["kept"] for i in range(400)) >= 380
