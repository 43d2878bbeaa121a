"""Text enrichment: whole-phrase matches and nearest labels by cosine."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Labels that are sent to every executor, at most; more are joined by hash.
BROADCAST_LABELS = 100_000
WORDS = r"[\p{L}\p{N}]+"


def tokens(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(x), F.lit(WORDS), 0)


def phrases(docs: DataFrame, concepts: DataFrame, doc: str, text: str, concept: str, label: str, best: int = 5, min_single: int = 7) -> DataFrame:
    """Rows (doc, concept, words, chars, rank): labels whose tokens stand side by side in the text, ``best`` a document.

    Texts become n-grams of the labels' lengths, so the match is an equi-join. One-word labels under ``min_single`` characters don't count.
    """
    named = concepts.select(F.col(concept).alias("concept"), tokens(F.col(label)).alias("t")).where("size(t) > 0")
    named = named.select("concept", F.array_join("t", " ").alias("phrase"), F.size("t").alias("words")).where((F.col("words") > 1) | (F.length("phrase") >= min_single)).distinct()
    known = named.groupBy("words").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each length of a label
    sizes, count = sorted(r["words"] for r in known), sum(r["n"] for r in known)
    t = docs.select(F.col(doc).alias("doc"), tokens(F.coalesce(F.col(text), F.lit(""))).alias("t"))

    def of_size(n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size("t") - n + 1, F.lit(1)))
        return F.when(F.size("t") >= n, F.transform(at, lambda i: F.array_join(F.slice("t", i, n), " "))).otherwise(F.array().cast("array<string>"))

    grams = [of_size(n) for n in sizes]
    rows = t.select("doc", F.explode(F.concat(*grams) if grams else F.array().cast("array<string>")).alias("phrase"))
    # few labels go to the texts, so that no n-gram of a text is shuffled; many meet them by hash
    hit = rows.join(F.broadcast(named) if count <= BROADCAST_LABELS else named, "phrase").select("doc", "concept", "words", F.length("phrase").alias("chars")).distinct()
    one = hit.groupBy("doc", "concept").agg(F.max(F.struct("words", "chars")).alias("x")).select("doc", "concept", "x.words", "x.chars")
    rank = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("words"), F.desc("chars"), "concept"))
    return one.withColumn("rank", rank).where(F.col("rank") <= best)


def nearest(chunks: DataFrame, labels: DataFrame, doc: str, vec: str, concept: str, label: str, label_vec: str, threshold: float = 0.54, best: int = 5, block: int = 1024) -> DataFrame:
    """Rows (doc, concept, label, score, rank): the ``best`` concepts of a document by cosine, each by its nearest
    label over all of the document's chunks, at ``threshold`` or more; ties by label, then concept.

    Both sides are packed into blocks of about ``block`` vectors; each block of chunks meets each block of labels
    once, and only what reaches the threshold comes out. Null, empty, zero and non-finite vectors match nothing.
    """
    def packed(df: DataFrame, names: list[str], v: str, side: str) -> tuple[DataFrame, int]:
        df = df.where(F.col(v).isNotNull() & (F.size(v) > 0))
        n = max(1, -(-df.count() // block))
        row = F.struct(*(F.col(c).alias(f"k{i}") for i, c in enumerate(names)), F.col(v).cast("array<double>").alias("v"))
        own = F.pmod(F.xxhash64(*names, F.col(v)), F.lit(n))
        return df.groupBy(own.alias(f"{side}_block")).agg(F.collect_list(row).alias(side)), n

    x, _ = packed(chunks, [doc], vec, "x")
    y, n = packed(labels, [concept, label], label_vec, "y")
    pairs = x.withColumn("y_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))).join(y, "y_block").select("x", "y")
    kinds = [dict(chunks.dtypes)[doc], dict(labels.dtypes)[concept], dict(labels.dtypes)[label]]

    def unit(rows: list, size: int):
        v = np.zeros((len(rows), size))
        for i, r in enumerate(rows):
            a = np.array([np.nan if q is None else q for q in r["v"]], float)
            if len(a) == size and np.isfinite(a).all() and (norm := np.linalg.norm(a)) > 0:
                v[i] = a / norm
        return v

    def compare(frames):
        for f in frames:
            for a, b in zip(f["x"], f["y"]):
                size = max(len(r["v"]) for r in b)
                score = unit(list(a), size) @ unit(list(b), size).T
                i, j = np.nonzero(score >= threshold)
                yield pd.DataFrame({"doc": [a[k]["k0"] for k in i], "concept": [b[k]["k0"] for k in j], "label": [b[k]["k1"] for k in j], "score": score[i, j]})

    found = pairs.mapInPandas(compare, f"doc {kinds[0]}, concept {kinds[1]}, label {kinds[2]}, score double")
    found = found.withColumn("score", F.round("score", 6))
    top = found.groupBy("doc", "concept").agg(F.min(F.struct((-F.col("score")).alias("score"), "label")).alias("x"))
    top = top.select("doc", "concept", F.col("x.label").alias("label"), (-F.col("x.score")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("score"), "label", "concept"))
    return top.withColumn("rank", rank).where(F.col("rank") <= best)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)
