"""Toxicity by a convolutional text classifier, trained in numpy.

Words (runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased) are hashed into 2**22 buckets. The
buckets that ``min_docs`` or more sampled documents have get an embedding each (at most ``max_rows``, those of most
documents); all others share one. Filters of widths 1, 2 and 3 slide over the embedded words, a text keeps each
filter's maximum over all its places, and a logistic layer makes the score of these. Training: Adam on a sample of
at most ``max_labelled`` labelled documents, half of them toxic at most, weighted back to the rate
of all labels, from embeddings whose first number is how the word leans in the sample. A held-back fifth of the sample then gives each language the threshold of its best F1.

Scores come from the words alone. At scoring, embeddings and filters are multiplied out beforehand, so a word
costs six table rows.

Null and empty texts have no words: their score is that of blanks. Repeated rows get the same score. A document
that is labelled twice counts as toxic if any label says so. With labels of one kind or none the score is that rate
(0 without labels) for every text. An empty table gives no rows; other columns are not read; very long texts count
whole; words of equally many documents get their rows in the order of their buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as bt
from .common import ship

WIDTHS, FILTERS, DIM, BITS = (1, 2, 3), 16, 16, 22
#: Row 0 is the blank put after a text, row 1 stands for all buckets without a row of their own.
BLANK, RARE = 0, 1


def buckets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word."""
    s, e, doc = bt.spans(data, off, bt.NOT_ALNUM)
    return (bt.hashes(data, s, e, lower=True) >> bt.U(64 - BITS)).astype(np.int32), doc


def padded(idx: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of words with blanks for a widest filter after each text, and where each text begins (n + 1 places)."""
    at, blanks = bt.runs(doc, n), max(WIDTHS)
    begin = at + blanks * np.arange(n + 1)
    out = np.full(begin[-1], BLANK, np.int64)
    out[np.arange(len(idx)) + blanks * doc] = idx
    return out, begin


class Network:
    """Embeddings ``e``, filters ``w[width][place]`` (DIM x FILTERS), biases, and the logistic layer."""

    def __init__(self, rows: int, seed: int):
        r = np.random.Generator(np.random.PCG64(seed))
        f = np.float32
        self.p = {"e": r.normal(0, 0.3, (rows, DIM)).astype(f), "v": r.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(f), "c": np.zeros(1, f)}
        self.p["e"][BLANK] = 0
        for w in WIDTHS:
            self.p[f"b{w}"] = np.zeros(FILTERS, f)
            for j in range(w):
                self.p[f"w{w}.{j}"] = r.normal(0, (2 / (w * DIM)) ** 0.5, (DIM, FILTERS)).astype(f)
        self.m = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in self.p.items()}
        self.steps = 0

    def tables(self) -> dict[str, np.ndarray]:
        """Every row's share of each filter at each of its places."""
        return {k: self.p["e"] @ x for k, x in self.p.items() if k.startswith("w")}

    def pooled(self, tables: dict, idx: np.ndarray, begin: np.ndarray, places: bool = False):
        """Each text's maxima by filter, and with ``places`` where they stand."""
        out, where = [], []
        for w in WIDTHS:
            n = len(idx) - w + 1
            z = tables[f"w{w}.0"][idx[:n]]
            for j in range(1, w):
                z += tables[f"w{w}.{j}"][idx[j : j + n]]
            for j in range(1, w):  # windows that reach into the next text
                last = begin[1:] - j
                z[last[last < n]] = -np.inf
            if places:
                at = np.stack([a + z[a : min(b, n)].argmax(0) for a, b in zip(begin[:-1], begin[1:])])
                where.append(at)
                top = z[at, np.arange(FILTERS)]
            else:
                top = np.maximum.reduceat(z, begin[:-1])
            out.append(np.maximum(top + self.p[f"b{w}"], 0))
        return (np.hstack(out), where) if places else np.hstack(out)

    def prob(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.p["v"] + self.p["c"], -30, 30).astype(float)))

    def step(self, idx: np.ndarray, begin: np.ndarray, y: np.ndarray, weight: np.ndarray, rate: float) -> None:
        seen, local = np.unique(idx, return_inverse=True)
        e = self.p["e"][seen]
        pooled, where = self.pooled({k: e @ x for k, x in self.p.items() if k.startswith("w")}, local, begin, True)
        d = ((self.prob(pooled) - y) * weight / weight.sum()).astype(np.float32)
        grad = {"v": pooled.T @ d, "c": d.sum(keepdims=True), "e": np.zeros_like(self.p["e"])}
        back = d[:, None] * self.p["v"] * (pooled > 0)
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            grad[f"b{w}"] = g.sum(0)
            for j in range(w):
                token = idx[where[k] + j]
                grad[f"w{w}.{j}"] = np.einsum("bfd,bf->df", self.p["e"][token], g)
                np.add.at(grad["e"], token.reshape(-1), (g[:, :, None] * self.p[f"w{w}.{j}"].T).reshape(-1, DIM))
        grad["e"][BLANK] = 0
        self.steps += 1
        for k, g in grad.items():
            m, v = self.m[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.p[k] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


def leanings(texts: list[np.ndarray], y: np.ndarray, rows: int) -> np.ndarray:
    """How many standard errors each row's log odds of being in a toxic text lie from those of the others."""
    docs = np.zeros((2, rows))
    for t, label in zip(texts, y.astype(int)):
        docs[label, np.unique(t)] += 1
    n = np.array([(y == 0).sum(), (y == 1).sum()])[:, None] + 1
    odds = np.log((docs + 0.5) / n)
    return (odds[1] - odds[0]) / np.sqrt((1 / (docs + 0.5)).sum(0))


def fit(texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rows: int, epochs: int, seed: int, batch: int = 32, min_steps: int = 600) -> Network:
    net, r = Network(rows, seed), np.random.Generator(np.random.PCG64(seed + 1))
    per_epoch = -(-len(y) // batch)
    epochs = max(epochs, -(-min_steps // per_epoch))
    steps, done = epochs * per_epoch, 0
    net.p["e"][:, 0] = np.clip(leanings(texts, y, rows), -5, 5) / 2
    net.p["e"][BLANK] = 0
    for _ in range(epochs):
        order = r.permutation(len(y))
        for k in range(0, len(order), batch):
            part = order[k : k + batch]
            doc = np.repeat(np.arange(len(part)), [len(texts[i]) for i in part])
            words = np.concatenate([texts[i] for i in part])
            idx, begin = padded(words, doc, len(part))
            net.step(idx, begin, y[part], weight[part], 0.01 * (1 - 0.9 * done / steps))
            done += 1
    return net


def best_cut(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The score from which calling a text toxic gives the best weighted F1."""
    order = np.argsort(-p, kind="stable")
    hit, all_ = np.cumsum(y[order] * weight[order]), np.cumsum(weight[order])
    f1 = 2 * hit / (all_ + (y * weight).sum())
    last = np.append(p[order][1:] != p[order][:-1], True)
    k = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def train(
    docs: DataFrame, labels: DataFrame, train_on: Column | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic",
    max_labelled: int = 4500, min_docs: int = 3, max_rows: int = 1 << 15, epochs: int = 4, min_calibration: int = 20, seed: int = 3,
) -> dict:
    """The model: known buckets, network, rate, and thresholds by language ("" for all others).

    ``train_on``: which rows of ``labels`` may be learned from. ``max_labelled`` bounds the sample: of either label the
    rows with the smallest hashed ids.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = labels.where(train_on) if train_on is not None else labels
    rows = rows.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).groupBy("id").agg(F.max("y").alias("y"))
    have = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = have.get(1, 0) / max(1, sum(have.values()))
    none = {"known": np.zeros(0, np.int32), "net": None, "rate": rate, "cuts": {"": 0.5}}
    if len(have) < 2:
        return none
    toxic = min(max_labelled // 2, have[1])
    picked = [tuple(r) for y, most in ((0, max_labelled - toxic), (1, toxic)) for r in rows.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most).collect()]
    sample = spark.createDataFrame(picked, rows.schema)

    def words(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(0)):
                bucket, doc = buckets(data, off)
                lists = pa.ListArray.from_arrays(pa.array(bt.runs(doc, j - i).astype(np.int32)), pa.array(bucket))
                yield pa.RecordBatch.from_arrays([b.column(1).slice(i, j - i), b.column(2).slice(i, j - i), lists], names=["lang", "y", "words"])

    found = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).join(F.broadcast(sample), "id")  # at most max_labelled rows
    got = found.select("text", "lang", "y").mapInArrow(words, "lang string, y int, words array<int>").toArrow().sort_by("y")
    if not got.num_rows:
        return none
    lists = got.column("words").combine_chunks()
    flat, at = np.asarray(lists.flatten()), np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
    y, langs = np.asarray(got.column("y")).astype(float), got.column("lang").to_pylist()
    # rows come in no fixed order: order them by what they hold
    order = sorted(range(len(y)), key=lambda i: (y[i], int(at[i + 1] - at[i]), flat[at[i] : at[i + 1]].tobytes()))
    texts, y, langs = [flat[at[i] : at[i + 1]] for i in order], y[order], [langs[i] for i in order]
    seen, count = np.unique(np.concatenate([np.unique(t) for t in texts]), return_counts=True)
    keep = count >= min_docs
    seen, count = seen[keep], count[keep]
    known = np.sort(seen[np.lexsort((seen, -count))[:max_rows]])
    texts = [rows_of(known, t) for t in texts]
    weight = np.where(y == 1, have[1] / max(1, (y == 1).sum()), have[0] / max(1, (y == 0).sum()))
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held])) < 2:
        held[:] = False
    use = np.flatnonzero(~held)
    net = fit([texts[i] for i in use], y[use], weight[use], len(known) + 2, epochs, seed)
    test = np.flatnonzero(held) if len(set(y[held])) == 2 else use
    idx, begin = padded(np.concatenate([texts[i] for i in test]), np.repeat(np.arange(len(test)), [len(texts[i]) for i in test]), len(test))
    p = net.prob(net.pooled(net.tables(), idx, begin))
    cuts = {"": best_cut(p, y[test], weight[test])}
    of = np.array([langs[i] or "" for i in test], dtype=object)
    for name in set(of) - {""}:
        mine = of == name
        if mine.sum() >= min_calibration and 0 < y[test][mine].sum() < mine.sum():
            cuts[name] = best_cut(p[mine], y[test][mine], weight[test][mine])
    return {"known": known, "net": net, "rate": rate, "cuts": cuts}


def rows_of(known: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.full(len(bucket), RARE, np.int64)
    at = np.minimum(np.searchsorted(known, bucket), len(known) - 1)
    return np.where(known[at] == bucket, at + 2, RARE)


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (id, score, lang_threshold, toxic), one for each input row, without a shuffle; toxic: score >= the language's threshold."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most max_rows rows

    def work(batches):
        m = shared.value
        net, known, cuts = m["net"], m["known"], m["cuts"]
        tables = net.tables() if net else {}
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1), bt.LIMIT // 2):
                if net:
                    bucket, doc = buckets(data, off)
                    idx, begin = padded(rows_of(known, bucket), doc, j - i)
                    p = net.prob(net.pooled(tables, idx, begin))
                else:
                    p = np.full(j - i, m["rate"])
                cut = np.array([cuts.get(x, cuts[""]) for x in b.column(2).slice(i, j - i).to_pylist()], float)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(p), pa.array(cut), pa.array(p >= cut)], names=["id", "score", "lang_threshold", "toxic"])

    kind = dict(docs.dtypes)[doc_id]
    out = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(work, f"id {kind}, score double, lang_threshold double, toxic boolean")
    return out.withColumnRenamed("id", doc_id)
