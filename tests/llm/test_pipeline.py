"""Each stage of the pipeline against a brute-force version, on the rows that the stage before kept."""

import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from chronolith.llm import pieces
from chronolith.llm.common import cut

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """The table and what each stage made of it, as lists of rows."""
    r = np.random.Generator(np.random.PCG64(6))
    good, bad = ([x + "".join(r.choice(list("abcdefgh"), 5)) for _ in range(400)] for x in "gz")
    text = lambda words, k: " ".join(r.choice(words, k))
    sure = {i: text(bad if i % 5 == 0 else good, int(r.integers(80, 160))) for i in range(240)}
    passage = text(good, 60)
    for i in (11, 21, 31, 41):
        sure[i] = text(good, 40) + " " + passage + " " + text(good, 40)
    near = sure[3].split()
    near[40] = "other"
    sure |= {300: sure[1], 301: sure[1], 302: " ".join(near), 303: sure[4] + "\n"}
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in sure.items()] + [(400, None, None, None, None), (401, "", "en", "src0", 0), (402, " \n", "en", "src1", 2)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(200)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(cut(stage(spark, made[-1], folder)))
    return made, corpus_pipeline.run(spark, folder).count()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_columns_stay(results):
    made, count = results
    assert all(df.columns == made[0].columns for df in made[:-1])
    assert made[-1].count() == count


def test_quality_rejects_bad_and_keeps_good(results):
    made, _ = results
    before, after = {r[0] for r in rows_of(made[0])}, {r[0] for r in rows_of(made[1])}
    good = {i for i in before if i >= 300 or i % 5} - {400, 401, 402}
    assert len(good & after) >= 0.95 * len(good)
    assert len([i for i in after if i < 240 and i % 5 == 0]) <= 2


def test_near_duplicates_by_brute_force(results):
    made, _ = results
    docs = {r[0]: WORD.findall(r[1] or "") for r in rows_of(made[1])}
    cells = {i: Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for i, w in docs.items() if w}
    root = {i: i for i in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in cells:
        for b in cells:
            if a < b and (cells[a] & cells[b]).total() >= 0.8 * (cells[a] | cells[b]).total():
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert {r[0] for r in rows_of(made[2])} == {i for i in docs if top(i) == i}


def test_passages_by_brute_force(results):
    made, _ = results
    docs, first = {r[0]: (r[1], WORD.findall(r[1] or "")) for r in rows_of(made[2])}, {}
    for i, (_, w) in docs.items():
        for k in range(len(w) - 12):
            first[tuple(w[k : k + 13])] = min(first.get(tuple(w[k : k + 13]), i), i)
    want = {}
    for i, (t, w) in docs.items():
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        want[i] = " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t
    got = {r[0]: r[1] for r in rows_of(made[3])}
    assert got == want and any(want[i] != docs[i][0] for i in want)


def test_mix_by_brute_force(results):
    made, _ = results
    before, after = rows_of(made[3]), rows_of(made[4])
    size, taken = Counter(), Counter()
    for r in before:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    for r in after:
        taken[r[3]] += len(WORD.findall(r[1]))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, goal = 1.5 * sum(size.values()), set(names), {}
    while over := [s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * size[s]]:
        goal |= {s: 2 * size[s] for s in over}
        left -= sum(2 * size[s] for s in over)
        free -= set(over)
    goal |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    assert all(abs(taken[s] - goal[s]) <= 1 for s in names)
    whole = {r[0]: WORD.findall(r[1] or "") for r in before}
    assert all((w := WORD.findall(r[1])) == whole[r[0]][: len(w)] for r in after)
    assert max(Counter(r[0] for r in after).values()) <= 2


def test_encoding_decodes_to_the_mix(results):
    made, _ = results
    back = pieces.decode(made[5].withColumnRenamed("doc_id", "d"), "ids_1")
    assert Counter((r["d"], r["text"]) for r in back.collect()) == Counter((r[0], r[1]) for r in rows_of(made[4]))


def test_stages_on_awkward_and_empty_tables(spark, tmp_path):
    """Repeated rows of one id, several texts under one id, null ids, and columns named like the operators' own."""
    r = np.random.Generator(np.random.PCG64(16))
    words = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(400)]
    text = lambda k: " ".join(r.choice(words, k))
    rows = [(i, text(60)) for i in range(30)]
    rows += [(50, rows[1][1]), (60, a := text(50)), (60, a), (61, text(40)), (61, text(45)), (None, text(30)), (None, text(35)), (None, None), (70, None), (71, ""), (71, "")]
    names = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key int, size int, taken int, rep string, c0 int, h string, starts int, kept_text string, n_words int, kept boolean"
    docs = spark.createDataFrame([(i, t, "en", ["a", "b", None][n % 3], len(t or ""), "x", 1, 2, 3, "y", 4, "z", 5, "k", 6, None) for n, (i, t) in enumerate(rows)], names)
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    made = [cut(docs)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made.append(cut(stage(spark, made[-1], folder)))
        assert made[-1].dtypes == docs.dtypes and made[-1].where("id <> 'x' OR starts <> 5").count() == 0
    ids = Counter(x["doc_id"] for x in made[2].collect())
    assert made[1].count() == len(rows)  # without labels nothing is rejected
    assert ids[None] == 3 and {ids[i] for i in (60, 61, 70, 71)} == {1} and 50 not in ids and len(ids) == 35
    assert made[3].count() == made[2].count()
    taken = Counter()
    for x in made[4].collect():
        taken[x["source"]] += len(x["text"].split())
    sizes = Counter()
    for x in made[3].collect():
        sizes[x["source"]] += len((x["text"] or "").split())
    from chronolith.llm import mixing

    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = mixing.targets([sizes[s] for s in order], [3.0, 1.0, 2.0], 1.5, 2.0)
    assert all(abs(taken[s] - t) <= 1 for s, t in zip(order, want))
    out = corpus_pipeline.encode(spark, made[4], folder)
    assert out.count() == made[4].count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, cut(docs.limit(0)), folder).count() == 0
