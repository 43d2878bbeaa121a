"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern (the set of their
sources); the flow routes each pattern's words to its sources' quotas, where the r-th use of a word costs
r - 1, so repeats are spread evenly and taken only when fresh words have run out. The network has a node a
pattern and a node a source and is solved on the driver: patterns are counted first, and more than
``max_patterns`` is an error, never a cut.

Within a pattern, documents lie on a line in seeded order, each as long as its size; a routed amount is a
stretch of that line, and a document gives what of it lies on the stretch. So amounts come out to the word,
and at most one document at each end of a stretch is taken in part (its leading words).

Null and empty texts have size 0 and are never taken. A null source is a source of its own, last in order.
Documents without any source are taken 0 words. Repeated rows, and rows with a null id, are documents of their
own, each with its own taken words. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, cut


def targets(sizes: list[float], weights: list[float], share: float, cap: float) -> list[float]:
    """``share`` of the total by weight; what exceeds ``cap`` times a size is reshared until none is above."""
    budget = share * sum(sizes)
    out = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        per = (budget - sum(out[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
        over = {i for i in free if per * weights[i] > cap * sizes[i]}
        for i in free:
            out[i] = cap * sizes[i] if i in over else per * weights[i]
        if not over:
            break
        free -= over
    return out


def min_cost_flow(n: int, arcs: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each arc (tail, head, capacity, cost >= 0) of a maximum flow of least cost, by shortest augmenting paths."""
    heads, caps, costs, out = [], [], [], [[] for _ in range(n)]
    for u, v, c, w in arcs:
        for a, b, cap, cost in ((u, v, c, w), (v, u, 0, -w)):
            out[a].append(len(heads))
            heads.append(b)
            caps.append(cap)
            costs.append(cost)
    height = [0] * n
    while True:
        dist, via = [math.inf] * n, [-1] * n
        dist[source] = 0
        queue = [(0, source)]
        while queue:
            d, u = heapq.heappop(queue)
            if d > dist[u]:
                continue
            for k in out[u]:
                if caps[k] and (x := d + costs[k] + height[u] - height[heads[k]]) < dist[heads[k]]:
                    dist[heads[k]], via[heads[k]] = x, k
                    heapq.heappush(queue, (x, heads[k]))
        if via[sink] < 0:
            return [caps[2 * i + 1] for i in range(len(arcs))]
        top = max(d for d in dist if d < math.inf)
        height = [h + min(d, top) for h, d in zip(height, dist)]
        v, least = sink, math.inf
        while v != source:
            least, v = min(least, caps[via[v]]), heads[via[v] ^ 1]
        v = sink
        while v != source:
            caps[via[v]] -= least
            caps[via[v] ^ 1] += least
            v = heads[via[v] ^ 1]


def route(patterns: list[tuple[list, int]], quotas: dict, repeats: int) -> list[tuple[int, object, int, int]]:
    """Stretches (pattern number, source, from, to) of each pattern's line, which is ``repeats`` sizes long."""
    names = list(quotas)
    at = {s: i for i, s in enumerate(names)}
    n, first = 2 + len(patterns) + len(names), 2 + len(patterns)
    arcs, free = [], []
    for p, (members, size) in enumerate(patterns):
        arcs += [(0, 2 + p, size, level) for level in range(repeats)]
        free += [(p, s) for s in members if s in at]
    begin = len(arcs)
    arcs += [(2 + p, first + at[s], repeats * patterns[p][1], 0) for p, s in free]
    arcs += [(first + at[s], 1, quotas[s], 0) for s in names]
    flow = min_cost_flow(n, arcs, 0, 1)
    used, out = [0] * len(patterns), []
    for (p, s), f in zip(free, flow[begin:]):
        if f:
            out.append((p, s, used[p], used[p] + f))
            used[p] += f
    return out


def mix(
    docs: DataFrame, sources, weight_of: Callable[[list], list[float]], doc_id: str = "doc_id", text: str = "text",
    share: float = 1.5, cap: float = 2.0, repeats: int = 2, seed: int = 11, max_patterns: int = 100_000, keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (the id by default), size, sources (array of source, source_size, target), uses (array of source, words)
    and taken (words, repeats counted), one row for each input row.

    ``sources``: a column, the array of a document's sources; ``weight_of``: weights for the ordered sources.
    """
    spark = docs.sparkSession
    keep = keep or [doc_id]
    carried = [f"k{i}" for i in range(len(keep))]
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
    members = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    order = F.xxhash64(F.lit(seed), doc_id, text)  # ties are equal rows, which may change places
    slim = cut(docs.select(order.alias("h"), size.alias("size"), F.to_json(members).alias("pattern"), members.alias("members"), *(F.col(c).alias(n) for c, n in zip(keep, carried))))
    per = slim.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).limit(max_patterns + 1).collect()
    if len(per) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    per.sort(key=lambda r: r["pattern"])
    total: dict = {}
    for r in per:
        for s in r["members"]:
            total[s] = total.get(s, 0) + r["size"]
    names = sorted(total, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, targets([total[s] for s in names], weight_of(names), share, cap)))
    stretches = route([(list(r["members"]), r["size"]) for r in per], {s: round(goal[s]) for s in names}, repeats)
    plans = {r["pattern"]: [] for r in per}
    for p, s, lo, hi in stretches:
        # level by level, where the stretch lies on the pattern's own line
        length = per[p]["size"]
        for level in range(lo // length, (hi - 1) // length + 1):
            plans[per[p]["pattern"]].append((s, max(lo - level * length, 0), min(hi - level * length, length)))
    rows = [(r["pattern"], [(s, total[s], goal[s]) for s in r["members"]], plans[r["pattern"]]) for r in per]
    plan = spark.createDataFrame(rows, "pattern string, sources array<struct<source string, source_size bigint, target double>>, stretches array<struct<source string, lo bigint, hi bigint>>")
    # the line: order by hash, with sums by bucket first, so that no task holds a whole pattern
    buckets = max(64, 4 * math.isqrt(sum(r["n"] for r in per)))
    placed = slim.where("size > 0").select(*carried, "size", "h", "pattern", F.pmod(F.shiftrightunsigned("h", 20), F.lit(buckets)).alias("bucket"))
    sums = placed.groupBy("pattern", "bucket").agg(F.sum("size").alias("length"))
    before = sums.select("pattern", "bucket", (F.sum("length").over(Window.partitionBy("pattern").orderBy("bucket")) - F.col("length")).alias("before"))
    inner = Window.partitionBy("pattern", "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    lined = placed.withColumn("within", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(before, ["pattern", "bucket"])
    lined = lined.join(F.broadcast(plan), "pattern")  # at most max_patterns rows
    start, end = F.col("before") + F.col("within"), F.col("before") + F.col("within") + F.col("size")
    overlap = lambda x: F.greatest(F.lit(0), F.least(end, x["hi"]) - F.greatest(start, x["lo"])).cast("bigint")
    uses = F.filter(F.transform("stretches", lambda x: F.struct(x["source"].alias("source"), overlap(x).alias("words"))), lambda x: x["words"] > 0)
    out = lined.select(*carried, "size", "sources", uses.alias("uses"))
    # rows without words have no place on the line
    none = F.array().cast("array<struct<source string, words bigint>>")
    out = out.union(slim.where("size = 0").join(F.broadcast(plan), "pattern").select(*carried, "size", "sources", none))
    out = out.withColumn("taken", F.aggregate("uses", F.lit(0).cast("bigint"), lambda a, x: a + x["words"]))
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, carried)), "size", "sources", "uses", "taken")


def materialise(docs: DataFrame, sources, weight_of: Callable[[list], list[float]], doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix itself: each row as many times as it is taken whole, and once its leading words if taken in part.

    A whole copy keeps its text; n_chars, where there is such a column, follows the text. ``docs`` must be a
    table that reads alike twice (files or a checkpoint): rows are told apart by their place in it. The words
    taken of each row are written down before they are joined to the texts.
    """
    row, size, taken, copy = (f"__{x}_{len(docs.columns)}_{'_'.join(docs.columns)}" for x in ("row", "size", "taken", "copy"))
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    mixed = cut(mix(rows, sources, weight_of, doc_id, text, keep=[row], **options).where("taken > 0").select(row, F.col("size").alias(size), F.col("taken").alias(taken)))
    rows = rows.join(mixed.hint("shuffle_hash"), row)
    whole, rest = F.floor(F.col(taken) / F.col(size)), F.col(taken) % F.col(size)
    part = F.array_join(F.slice(F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+"), 1, rest.cast("int")), " ")
    rows = rows.withColumn(copy, F.explode(F.sequence(F.lit(1), (whole + F.when(rest > 0, 1).otherwise(0)).cast("int"))))
    rows = rows.withColumn(text, F.when(F.col(copy) <= whole, F.col(text)).otherwise(part))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length(text).cast(dict(docs.dtypes)["n_chars"]))
    return rows.select(*docs.columns)
