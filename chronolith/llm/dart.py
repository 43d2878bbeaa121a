"""Near-duplicate documents by DartMinHash over weighted word shingles.

A document is a weighted set: its runs of ``width`` consecutive words (a shorter text: all its words as one
run), each weighing the number of times it occurs. Darts are thrown by hash into the plane of every
element's weight and a rank axis, one Poisson process a unit of weight; those below a rank limit that fits
the document's total weight hit one of ``k`` coordinates each, and a coordinate keeps its earliest dart. Two
documents agree at a coordinate with the probability of their weighted Jaccard similarity. Bands of six
coordinates make buckets; similarity in the buckets is then computed exactly.

Exact copies fold into one representative first (texts with the same two 64-bit hashes of their words and the
same number of shingles). In a bucket, every member is compared with the smallest one. What that leaves open,
pairs of members in different components, is settled exactly: in buckets of up to ``SMALL`` members pair by
pair, in larger ones by blocks of about ``BLOCK`` members, those outside the bucket's largest component against
all, so that rows grow with members times blocks and no bucket is capped or gathered in one task. (The
arithmetic of a bucket grows with its members times those outside its largest component.)

Texts that are null, empty or have no word have no shingles: each is its own class. Repeated rows of one id
are one document with all their texts. Rows with a null id come back with a null class, kept. An empty table
gives no rows; other columns are not read, whatever their names. Very long texts are worked on whole.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .common import components, cut, release, ship

K, BANDS, ROWS = 128, 40, 6
#: Members of a bucket that are settled pair by pair; else members, and unit cells, of a block.
SMALL, BLOCK, BLOCK_CELLS = 16, 1024, 1_000_000
#: Which coordinates make up each band: a fixed seeded choice without repeats.
_DESIGN = np.stack([np.random.Generator(np.random.PCG64(100 + b)).permutation(K)[:ROWS] for b in range(BANDS)])


def shingle_cells(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit cells (hash of shingle and number of its occurrence), their rows, and two hashes of each row's word sequence."""
    n = len(off) - 1
    s, e, doc = bt.spans(data, off)
    h = bt.hashes(data, s, e)
    at = bt.runs(doc, n)
    count = np.diff(at)
    g, ok = bt.grams(h, doc, width)
    cell, row = g[ok], doc[: len(ok)][ok]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            has = count[short] > j
            own[has] = bt.mix(own[has] * bt.U(31) + h[at[short[has]] + j])
        cell, row = np.concatenate([cell, own]), np.concatenate([row, short])
    order = np.lexsort((cell, row))
    cell, row = cell[order], row[order]
    if len(cell):
        fresh = np.ones(len(cell), bool)
        fresh[1:] = (cell[1:] != cell[:-1]) | (row[1:] != row[:-1])
        starts = np.flatnonzero(fresh)
        nth = np.arange(len(cell)) - np.repeat(starts, np.diff(np.append(starts, len(cell))))
        cell = bt.mix(cell ^ bt.mix(nth.astype(np.uint64) + bt.U(1)))
    place = np.arange(len(h)) - at[doc] if len(doc) else doc
    whole = np.zeros((n, 2), np.uint64)
    for k in range(2):
        term = np.cumsum(bt.mix(h ^ bt.mix(place.astype(np.uint64) * bt.U(2) + bt.U(k))))
        whole[:, k] = np.diff(np.concatenate([np.zeros(1, np.uint64), term])[at])
    return cell, row, whole


def _bytes16(pairs: np.ndarray) -> pa.Array:
    """Two 64-bit numbers a row as 16 bytes."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(pairs), [None, pa.py_buffer(np.ascontiguousarray(pairs).tobytes())]).cast(pa.binary())


def signatures(cell: np.ndarray, row: np.ndarray, n: int, part: np.ndarray | None = None, k: int = K) -> np.ndarray:
    """(n, k) hashes of the earliest dart at each coordinate; rows without cells get zeros.

    ``part``: how much of each unit cell the element's weight covers (a weight of 2.5 is three cells, the
    last with 0.5); darts beyond it miss.
    """
    total = np.bincount(row, weights=part, minlength=n)
    key = np.zeros((n, k), np.uint64)
    todo = total > 0
    theta = k * (math.log(k) + 4)
    while todo.any():
        limit = np.where(todo, theta / np.maximum(total, 1e-12), 0)
        live = np.flatnonzero(todo[row])
        best = np.full(n * k, np.inf)
        rank, d, thrown = np.zeros(len(live)), 1, []
        while len(live):
            dart = bt.mix(cell[live] + bt.U(d * 0x9E3779B97F4A7C15 % 2**64))
            rank = rank - np.log(bt.unit(dart))
            near = rank < limit[row[live]]
            live, rank, dart = live[near], rank[near], dart[near]
            aim = bt.mix(dart ^ bt.U(0xA5A5A5A5A5A5A5A5))
            hit = slice(None) if part is None else bt.unit(bt.mix(aim)) < part[live]
            slot = row[live][hit] * k + (aim[hit] % bt.U(k)).astype(np.int64)
            thrown.append((slot, rank[hit], dart[hit]))
            np.minimum.at(best, slot, rank[hit])
            d += 1
        for slot, r, dart in thrown:
            first = r == best[slot]
            key.reshape(-1)[slot[first]] = dart[first]
        todo &= ~np.isfinite(best.reshape(n, k)).all(1)
        theta *= 2
    return key


def sketch(docs: DataFrame, width: int = 5) -> DataFrame:
    """Rows (id, n, whole, w, bands) from columns id, text; n: shingles, whole: two hashes of the words, w: the first
    of them, which tells the texts of one id apart, bands: bucket keys."""
    def work(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1)):
                cell, row, whole = shingle_cells(data, off, width)
                sig = signatures(cell, row, j - i)
                bands = np.zeros((j - i, BANDS), np.uint64)
                for band in range(BANDS):
                    x = np.full(j - i, band + 1, np.uint64)
                    for c in _DESIGN[band]:
                        x = bt.mix(x * bt.U(0x9FB21C651E98DF25) + sig[:, c])
                    bands[:, band] = x
                n = np.bincount(row, minlength=j - i)
                keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)), pa.array(bands[n > 0].reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n), _bytes16(whole), pa.array(whole[:, 0].copy().view(np.int64)), keys], names=["id", "n", "whole", "w", "bands"])

    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(work, f"id {kind}, n bigint, whole binary, w bigint, bands array<bigint>")


def _cells(texts: DataFrame, width: int) -> DataFrame:
    """Rows (id, w, cells), the unit cells of each text, from columns id, text."""
    def work(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1)):
                cell, row, whole = shingle_cells(data, off, width)
                order = np.argsort(row, kind="stable")
                at = np.searchsorted(row[order], np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(whole[:, 0].copy().view(np.int64)), pa.ListArray.from_arrays(pa.array(at), pa.array(cell[order].view(np.int64)))], names=["id", "w", "cells"])

    return texts.select("id", "text").mapInArrow(work, f"id {dict(texts.dtypes)['id']}, w bigint, cells array<bigint>")


def _similarities(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows (a, b, sim) of pairs (a, a_w, b, b_w), with the exact weighted Jaccard similarity of their unit cells."""
    side = lambda x: cells.select(F.col("id").alias(x), F.col("w").alias(f"{x}_w"), F.col("cells").alias(f"{x}_cells"))
    both = pairs.join(side("b"), ["b", "b_w"]).join(side("a"), ["a", "a_w"])
    common = F.size(F.array_intersect("a_cells", "b_cells"))
    return both.select("a", "b", (common / (F.size("a_cells") + F.size("b_cells") - common)).alias("sim"))


def _block_links(parts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the two sides of each (key, bx, by): rows (side, id, c, cells), c being the component, which differs."""
    def compare(pdf):
        x, y = pdf[~pdf["side"]], pdf[pdf["side"]]
        rows = [np.repeat(np.arange(len(z)), [len(c) for c in z["cells"]]) for z in (x, y)]
        flat = [np.concatenate(list(z["cells"])) if len(z) else np.zeros(0, np.int64) for z in (x, y)]
        common = np.intersect1d(*flat)
        for k in range(2):
            at = np.minimum(np.searchsorted(common, flat[k]), max(len(common) - 1, 0))
            has = common[at] == flat[k] if len(common) else np.zeros(len(flat[k]), bool)
            order = np.argsort(at[has], kind="stable")
            rows[k], flat[k] = rows[k][has][order], at[has][order]
        inter = np.zeros((len(x), len(y)), np.float32)
        for lo in range(0, len(common), 4096):
            dense = []
            for k, z in enumerate((x, y)):
                m = np.zeros((len(z), 4096), np.float32)
                a, b = np.searchsorted(flat[k], [lo, lo + 4096])
                m[rows[k][a:b], flat[k][a:b] - lo] = 1
                dense.append(m)
            inter += dense[0] @ dense[1].T
        size = [z["cells"].map(len).to_numpy(np.float64) for z in (x, y)]
        sim = inter / (size[0][:, None] + size[1][None, :] - inter)
        i, j = np.nonzero((sim >= threshold) & (x["c"].to_numpy()[:, None] != y["c"].to_numpy()[None, :]))
        # two components need one link
        return pd.DataFrame({"a": x["id"].to_numpy()[i], "b": y["id"].to_numpy()[j], "p": x["c"].to_numpy()[i], "q": y["c"].to_numpy()[j]}).drop_duplicates(["p", "q"])[["a", "b"]]

    kind = dict(parts.dtypes)["id"]
    return parts.groupBy("key", "bx", "by").applyInPandas(compare, f"a {kind}, b {kind}")


def _open_links(buckets: DataFrame, comp: DataFrame, cells: DataFrame, threshold: float) -> DataFrame:
    """Links between members of a bucket in different components, other than those with its pivot, which are known."""
    named = comp.select(F.col("node").alias("id"), "component")
    nodes = buckets.join(named, "id", "left").withColumn("c", F.coalesce("component", "id"))
    per = nodes.groupBy("key", "c").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("cells"))
    per = per.groupBy("key").agg(F.max(F.struct("k", "c", "cells")).alias("top"), F.sum("k").alias("k"), F.sum("cells").alias("all_cells"))
    per = per.where("k > 2 AND k > top.k").select("key", "k", "all_cells", F.col("top.c").alias("top_c"), (F.col("k") - F.col("top.k")).alias("minor"), (F.col("all_cells") - F.col("top.cells")).alias("minor_cells"))
    rest = cut(nodes.where("id <> pivot").join(per, "key").select("key", "id", "w", "n", "c", "k", "all_cells", "minor", "minor_cells", (F.col("c") != F.col("top_c")).alias("is_minor")))
    few = rest.where(F.col("k") <= SMALL)
    x, y = few.where("is_minor").alias("x"), few.alias("y")
    # no similarity is above the ratio of sizes
    near = F.least("x.n", "y.n") >= threshold * F.greatest("x.n", "y.n")
    pairs = x.join(y, F.col("x.key") == F.col("y.key")).where((F.col("x.c") != F.col("y.c")) & (~F.col("y.is_minor") | (F.col("x.id") > F.col("y.id"))) & near)
    pairs = pairs.select(F.col("x.id").alias("a"), F.col("x.w").alias("a_w"), F.col("y.id").alias("b"), F.col("y.w").alias("b_w")).distinct()
    found = _similarities(pairs, cells).where(F.col("sim") >= threshold).select("a", "b")
    blocks = lambda k, n: F.greatest(F.ceil(F.col(k) / BLOCK), F.ceil(F.col(n) / BLOCK_CELLS))
    many = rest.where(F.col("k") > SMALL).withColumn("nx", blocks("minor", "minor_cells")).withColumn("ny", blocks("k", "all_cells"))
    own = lambda n: F.pmod(F.xxhash64("id", "w"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    sides = many.where("is_minor").select("key", "id", "w", "c", own("nx").alias("bx"), every("ny").alias("by"), F.lit(False).alias("side"))
    sides = sides.unionByName(many.select("key", "id", "w", "c", every("nx").alias("bx"), own("ny").alias("by"), F.lit(True).alias("side")))
    parts = sides.join(cells, ["id", "w"]).select("key", "bx", "by", "side", "id", "c", "cells")
    return found.union(_block_links(parts, threshold))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Rows (id, n_shingles, copy_of, component_id, kept), one for each input row.

    ``copy_of``: smallest id with the same words; ``component_id``: smallest id reachable by links, a link
    being a weighted Jaccard similarity of ``threshold`` or more; ``kept``: id = component_id.
    """
    spark = docs.sparkSession
    ship(spark)
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    base = cut(sketch(d, width))
    same = cut(base.where("n > 0 AND id IS NOT NULL").groupBy("whole", "n").agg(F.min("id").alias("rep"), F.max("id").alias("top")).where("rep < top").drop("top"))
    ids = base.select("id", "whole", "n").join(same, ["whole", "n"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep"))
    reps = base.where("n > 0 AND id IS NOT NULL").join(same, ["whole", "n"], "left").where("rep IS NULL OR id = rep")
    rows = reps.select("id", "w", "n", F.explode("bands").alias("key"))
    full = cut(rows.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("top")).where("pivot < top").drop("top"))
    buckets = cut(rows.join(full, "key").distinct())
    release(spark)
    wanted = buckets.select("id").distinct().hint("shuffle_hash")
    cells = cut(_cells(d.join(wanted, "id", "left_semi"), width).dropDuplicates(["id", "w"]))
    release(spark)
    pivots = buckets.where("id = pivot").select("key", F.col("w").alias("b_w"), F.col("n").alias("b_n"))
    near = F.least("n", "b_n") >= threshold * F.greatest("n", "b_n")  # no similarity is above the ratio of sizes
    pairs = buckets.where("id <> pivot").join(pivots, "key").where(near).select(F.col("id").alias("a"), F.col("w").alias("a_w"), F.col("pivot").alias("b"), "b_w").distinct()
    links = cut(_similarities(pairs, cells).where(F.col("sim") >= threshold).select("a", "b"))
    # an id that has several texts links the classes of all of them
    several = ids.where("id IS NOT NULL").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("id")
    links = links.union(ids.join(several.hint("shuffle_hash"), "id", "left_semi").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    comp = cut(components(links))
    release(spark)
    more = cut(_open_links(buckets, comp, cells, threshold))
    if more.take(1):
        comp = cut(components(links.union(more)))
    out = ids.join(comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
    out = out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("rep").alias("copy_of"), F.coalesce("component", "rep").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(doc_id) == F.col("component_id"), F.lit(True)))
