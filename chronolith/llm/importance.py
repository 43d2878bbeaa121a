"""Quality classifier by importance resampling of hashed n-gram models.

Two generative bag-of-n-grams models over hashed buckets are fitted: the target's on labelled good
documents (a bounded sample, ``max_labelled`` rows), the raw one on every document. A document's log
importance weight is the sum over its n-grams of log(target / raw). Documents are sampled without
replacement by Gumbel top-k on those log weights: k is the number of documents whose weight reaches the
cut that best parts good from bad in the labelled sample, so the sample rejects what the target model
finds unlikely; within a few nats of the cut, chance decides (seeded by id).

n-grams are of lower-cased words (1, 2) and of word shapes (1, 2, 3), a shape being the kind of the first
and last bytes, the case and whether the word or its 4-gram was there before. The target's counts are
shrunk towards the raw distribution so that small samples don't overfit.

Null and empty texts have no n-grams: log weight 0. Repeated rows share their fate. Ties at the k-th key
are all kept. With no labelled good or no labelled bad row, nothing tells documents apart: all are kept. An id
that is labelled twice counts as good if it ever is. An empty table gives no rows; other columns are carried
along if asked for (``keep``), whatever their names. Very long texts count whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .common import cut, ship

WORD_BUCKETS, SHAPE_BUCKETS = 1 << 16, 1 << 13
#: Pseudo-counts a bucket by which the target is drawn to the raw model.
SHRINK = 20.0

_KIND = np.full(256, 5, np.int64)
_KIND[[*range(97, 123)]] = 0
_KIND[[*range(65, 91)]] = 1
_KIND[[*range(48, 58)]] = 2
_KIND[[ord(c) for c in ".,;:?!"]] = 3
_KIND[[ord(c) for c in "'\"()-"]] = 4
_KIND[128:] = 6


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every n-gram; shape buckets come after the word buckets."""
    rows, buckets = [], []

    def add(h, row, n_buckets, first):
        rows.append(row)
        buckets.append((h % bt.U(n_buckets)).astype(np.int64) + first)

    s, e, doc = bt.spans(data, off, bt.NOT_ALNUM)
    h = bt.hashes(data, s, e, lower=True)
    add(h, doc, WORD_BUCKETS, 0)
    g, ok = bt.grams(h, doc, 2)
    add(g[ok], doc[:-1][ok] if len(doc) else doc, WORD_BUCKETS, 0)
    s, e, doc = bt.spans(data, off)
    if len(s):
        h = bt.hashes(data, s, e)
        long = e - s > 1
        shape = _KIND[data[s]] * 512 + _KIND[data[e - 1]] * 64 + np.where(long, _KIND[data[np.maximum(e - 2, s)]], 7) * 8
        shape += np.where(long, _KIND[data[np.minimum(s + 1, e - 1)]], 7)
        before = np.zeros(len(h), np.int64)
        before[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        g, ok = bt.grams(h, doc, 4)
        at = np.flatnonzero(ok)
        key = bt.mix(g[at] ^ bt.mix(doc[at].astype(np.uint64)))
        _, firsts = np.unique(key, return_index=True)
        again = np.ones(len(at), bool)
        again[firsts] = False
        before[at[again]] += 2
        token = bt.mix((shape * 4 + before + 1).astype(np.uint64))
        add(token, doc, SHAPE_BUCKETS, WORD_BUCKETS)
        for k in (2, 3):
            g, ok = bt.grams(token, doc, k)
            add(g[ok], doc[: len(ok)][ok], SHAPE_BUCKETS, WORD_BUCKETS)
    return np.concatenate(rows), np.concatenate(buckets)


def _counts(df: DataFrame) -> np.ndarray:
    """Bucket counts over all texts (column text): a row a bucket from each task, as many rows here as buckets."""
    n = WORD_BUCKETS + SHAPE_BUCKETS

    def partial(batches):
        total = np.zeros(n, np.int64)
        for b in batches:
            for _, _, data, off in bt.slices(b.column(0)):
                total += np.bincount(features(data, off)[1], minlength=n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "c"])

    out = np.zeros(n)
    x = df.select("text").mapInArrow(partial, "i bigint, c bigint").groupBy("i").agg(F.sum("c").alias("c")).toPandas()
    out[x["i"]] = x["c"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(target / raw) by bucket, words and shapes each a distribution of their own."""
    out = []
    for part in (slice(0, WORD_BUCKETS), slice(WORD_BUCKETS, None)):
        t, r = target[part], raw[part] + 0.5
        r = r / r.sum()
        k = SHRINK * len(r)
        out.append(np.log((t + k * r) / (t.sum() + k) / r))
    return np.concatenate(out).astype(np.float32)


def weigh(docs: DataFrame, ratios: np.ndarray, text: str, keep: list[str]) -> DataFrame:
    """Columns c0, c1, ... (those of ``keep``) and log_weight, row by row, without a shuffle."""
    schema = docs.select(*keep).schema
    names = [f"c{i}" for i in range(len(keep))]
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # of fixed size

    def score(batches):
        lr = shared.value.astype(float)
        for b in batches:
            for i, j, data, off in bt.slices(b.column(0)):
                row, bucket = features(data, off)
                w = np.bincount(row, weights=lr[bucket], minlength=j - i)
                yield pa.RecordBatch.from_arrays([*(b.column(k + 1).slice(i, j - i) for k in range(len(names))), pa.array(w)], names=[*names, "log_weight"])

    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema))
    out = docs.select(F.col(text).alias("text"), *(F.col(c).alias(n) for c, n in zip(keep, names)))
    return out.mapInArrow(score, f"{kinds}, log_weight double")


def gumbel_key(doc_id: str, seed: int):
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id)), 11) + 0.5) / float(1 << 53)
    return F.col("log_weight") - F.log(-F.log(u))


def kth_largest(keys: DataFrame, k: int, bins: int = 4096, small: int = 10_000) -> float:
    """The k-th largest of a double column ``key``, by counting in ever finer bins."""
    lo, hi = keys.agg(F.min("key"), F.max("key")).first()
    above = 0
    while True:
        inside = keys.where(F.col("key").between(lo, hi))
        n = inside.count()
        if n <= small or lo == hi:
            top = sorted((r[0] for r in inside.select("key").collect()), reverse=True) if n <= small else [lo] * n
            return top[k - above - 1]
        b = F.least(F.floor((F.col("key") - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).alias("b")
        rows = inside.groupBy(b).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        for r in sorted(rows, key=lambda r: -r["b"]):
            if above + r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]


def classify(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    keep: list[str] | None = None, max_labelled: int = 20_000, reject_cost: float = 8.0, seed: int = 7, only_kept: bool = False,
) -> DataFrame:
    """Columns ``keep`` (the id by default), log_weight, key and kept, one row for each input row; with ``only_kept``
    just the columns ``keep`` of the rows kept, whatever their names.

    ``labels``: id and 1 (target) or 0; of these the ``max_labelled`` rows with the smallest hashed ids are
    used. ``reject_cost``: how many bad documents kept weigh as much as one good document rejected.
    """
    spark = docs.sparkSession
    ship(spark)
    keep = keep or [doc_id]
    if not only_kept and {"log_weight", "key", "kept"} & set(keep):
        raise ValueError("columns log_weight, key and kept are the operator's own")
    some = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).groupBy("id").agg(F.max("y").alias("y"))
    some = spark.createDataFrame([tuple(r) for r in some.orderBy(F.xxhash64("id"), "id").limit(max_labelled).collect()], some.schema)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    good = texts.join(F.broadcast(some.where("y = 1")), "id", "left_semi")  # at most max_labelled ids
    ratios = log_ratios(_counts(good), _counts(texts))
    scored = cut(weigh(docs, ratios, text, [doc_id]))
    fit = scored.join(F.broadcast(some), scored["c0"] == some["id"]).select("log_weight", "y").toPandas()
    threshold = -np.inf
    if fit["y"].nunique() == 2:
        w, y = fit["log_weight"].to_numpy(), fit["y"].to_numpy()
        order = np.argsort(w, kind="stable")
        w, y = w[order], y[order]
        cost = np.concatenate([[0], np.cumsum(y * reject_cost)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
        i = int(np.flatnonzero(cost == cost.min()).mean())
        threshold = -np.inf if i == 0 else np.inf if i == len(w) else (w[i - 1] + w[i]) / 2
    keys = scored.select(gumbel_key("c0", seed).alias("key"))
    k = scored.where(F.col("log_weight") >= float(threshold)).count()
    bar = kth_largest(keys, k) if k else np.inf
    carried = keep if doc_id in keep else [*keep, doc_id]
    out = scored if carried == [doc_id] else weigh(docs, ratios, text, carried)
    key = gumbel_key(f"c{carried.index(doc_id)}", seed)
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(keep)]
    if only_kept:
        return out.where(key >= F.lit(float(bar))).select(*own)
    return out.select(*own, "log_weight", key.alias("key"), (key >= F.lit(float(bar))).alias("kept"))
