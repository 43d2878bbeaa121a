"""Near-duplicate vectors by NN-descent.

Vectors are normalised in double precision; equal ones fold into the smallest id first. A neighbour graph of ``k``
neighbours a vector starts from short runs of vectors ordered by seeded random hyperplanes, and is refined by
joins of neighbours with neighbours: each vector's neighbours, forward and backward, meet in chunks of bounded size
and pass each other on, until few lists change. Edges at or above the threshold are the links.

A list that is full of links is saturated: it may have more to hold. Lists of a linked group are therefore enlarged
to all that their links reach: the group's members meet block by block, where links are counted, never listed.
Links between groups with more members than a list holds are sought exactly, as full lists may lack them all.

Recall is audited against brute force for a fixed number of seeded vectors; below ``min_recall`` the search goes on
with new hyperplanes, its links added to those found, and fails when ``max_rounds`` don't reach it.

Null and zero vectors and those with null or non-finite components, or of another length than most, link with
nothing. Rows of one id are one vertex; its smallest distinct vector counts. Rows with a null id come back unlinked.
An empty table gives no rows; of equal similarities the smaller id comes first in a list; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import components, cut, release, ship

#: Vectors of a run in the start graph, of a chunk in a join of neighbours, and of a block in a group.
RUN, CHUNK, BLOCK = 48, 40, 256
AUDITED = 400


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of 8-byte floats from a binary column of equal lengths."""
    raw = column.cast(pa.large_binary())
    off = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2], np.uint8)[off[0] : off[-1]].view(np.float64).reshape(len(raw), -1)


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """Rows (id, v) of the usable vectors from columns id, e; v: the normalised components as bytes."""
    def work(batches):
        for b in batches:
            e = b.column(1)
            sizes = np.asarray(e.value_lengths().fill_null(0))
            flat = e.flatten()
            whole = np.ones(len(e), bool)
            if flat.null_count:
                whole[np.repeat(np.arange(len(e)), sizes)[np.asarray(flat.is_null())]] = False
            x = np.asarray(flat.fill_null(0).cast(pa.float64()))
            at = np.concatenate([[0], np.cumsum(sizes)])
            ids, out = [], []
            for size in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero((sizes == size) & whole)
                m = x[at[rows][:, None] + np.arange(size)]
                with np.errstate(all="ignore"):
                    top = np.abs(m).max(1, initial=0)
                    m = m / top[:, None]
                    m /= np.sqrt((m * m).sum(1))[:, None]
                ok = np.isfinite(m).all(1) & (top > 0)
                ids.extend(rows[ok])
                out.extend(r.tobytes() for r in m[ok] + 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ids, pa.int64())), pa.array(out, pa.binary())], names=["id", "v"])

    return vectors.mapInArrow(work, f"id {dict(vectors.dtypes)['id']}, v binary")


def _pairs_of_groups(rows: DataFrame, key: list[str], best: int, chunk: int, floor: bool) -> DataFrame:
    """Rows (u, v, sim): for each member its ``best`` others of the same run of equal keys, at most ``chunk`` rows of it at a time.

    ``rows`` come sorted by key with columns id, v, low (floor: only sims above it) after the keys.
    """
    kind = dict(rows.dtypes)["id"]
    n_keys = len(key)

    def work(batches):
        for b in batches:
            if not len(b):
                continue
            ids, m = b.column(n_keys), _matrix(b.column(n_keys + 1)).astype(np.float32)
            low = np.asarray(b.column(n_keys + 2)) if floor else np.full(len(b), -2.0)
            new = np.zeros(len(b), bool)
            new[0] = True
            for c in range(n_keys):
                x = np.asarray(b.column(c))
                new[1:] |= x[1:] != x[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(b))
            us, vs, ss = [], [], []
            for a, z in zip(starts, ends):
                for i in range(a, z, chunk):
                    j = min(i + chunk, z)
                    if j - i < 2:
                        continue
                    s = m[i:j] @ m[i:j].T
                    np.fill_diagonal(s, -3)
                    take = min(best, j - i - 1)
                    top = np.argpartition(-s, take - 1, axis=1)[:, :take]
                    val = np.take_along_axis(s, top, 1)
                    r, c = np.nonzero(val > low[i:j, None])
                    us.append(i + r), vs.append(i + top[r, c]), ss.append(val[r, c])
            u, v, s = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((us, np.int64), (vs, np.int64), (ss, np.float32)))
            u, v = ids.take(pa.array(u)), ids.take(pa.array(v))
            keep = pa.compute.not_equal(u, v)
            yield pa.RecordBatch.from_arrays([u, v, pa.array(s, pa.float32())], names=["u", "v", "sim"]).filter(keep)

    return rows.mapInArrow(work, f"u {kind}, v {kind}, sim float")


def _top(edges: DataFrame, k: int) -> DataFrame:
    """Each vector's k best neighbours: rows (u, nb), nb an array of (d = -sim, v), best first.

    One shuffle by u; a hub's candidates are sorted, which can spill, and only its k best ever stand in one row.
    """
    one = edges.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    best = one.withColumn("place", place).where(F.col("place") <= k)
    return best.groupBy("u").agg(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("d"), "v"))).alias("nb"))


def start_graph(reps: DataFrame, size: int, tables: int, k: int, seed: int) -> DataFrame:
    """Candidate edges from runs of vectors in the order of ``tables`` seeded sign codes."""
    kind = dict(reps.dtypes)["id"]

    def codes(batches):
        planes = None
        for b in batches:
            if not len(b):
                continue
            m = _matrix(b.column(1))
            if planes is None:
                planes = np.random.Generator(np.random.PCG64(seed)).normal(size=(m.shape[1], tables * 30))
            bits = (m @ planes > 0).reshape(len(m), tables, 30)
            code = (bits * (1 << np.arange(29, -1, -1, dtype=np.int64))).sum(2)
            t = np.tile(np.arange(tables, dtype=np.int64) << 30, len(m))
            rows = pa.array(np.repeat(np.arange(len(m)), tables))
            yield pa.RecordBatch.from_arrays([pa.array(t + code.reshape(-1)), b.column(0).take(rows), b.column(1).take(rows)], names=["code", "id", "v"])

    coded = reps.select("id", "v").mapInArrow(codes, f"code bigint, id {kind}, v binary")
    tie = F.xxhash64("code", "id")
    parts = max(4, -(-size * tables // 20_000))
    run = coded.repartitionByRange(parts, "code", tie).sortWithinPartitions("code", tie)
    return _pairs_of_groups(run.select(F.shiftright("code", 30).alias("t"), "id", "v"), ["t"], k, RUN, False)


def refine(graph: DataFrame, reps: DataFrame, k: int, seed: int) -> DataFrame:
    """One join of neighbours with neighbours: new candidate edges above each list's lowest."""
    flat = graph.select("u", F.explode("nb").alias("n")).select("u", F.col("n.v").alias("v"))
    around = flat.union(flat.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    # a vector that very many have as a neighbour has them meet in seeded chunks
    degree = around.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK)
    salted = around.join(degree, "u", "left").withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed), "u", "v"), F.coalesce(F.ceil(F.col("n") / CHUNK), F.lit(1))))
    lows = graph.select(F.col("u").alias("id"), F.when(F.size("nb") >= k, -F.element_at("nb", -1)["d"]).otherwise(F.lit(-2.0)).cast("double").alias("low"))
    members = reps.select("id", "v").join(lows, "id", "left").select(F.col("id").alias("w"), F.col("v").alias("vec"), F.coalesce("low", F.lit(-2.0)).alias("low"))
    rows = salted.select("u", "chunk", F.col("v").alias("w")).join(members.hint("shuffle_hash"), "w")
    rows = rows.withColumn("g", F.xxhash64("u", "chunk")).select("g", F.col("w").alias("id"), F.col("vec").alias("v"), "low")
    return _pairs_of_groups(rows.repartition("g").sortWithinPartitions("g"), ["g"], 5, 2 * CHUNK, True)


def exact(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Those of rows (a, b) whose cosine in double precision reaches the threshold."""
    def work(batches):
        for b in batches:
            if len(b):
                s = np.einsum("ij,ij->i", _matrix(b.column(2)), _matrix(b.column(3)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(s >= threshold))

    kind = dict(pairs.dtypes)["a"]
    full = pairs.join(reps.select(F.col("id").alias("a"), F.col("v").alias("va")), "a").join(reps.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b")
    return full.select("a", "b", "va", "vb").mapInArrow(work, f"a {kind}, b {kind}")


def _reaches(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of x and of y have a cosine at or above the threshold; at the threshold as ``exact`` sees it."""
    c = x @ y.T
    hit = c >= threshold
    i, j = np.nonzero(np.abs(c - threshold) < 1e-12)
    if len(i):
        hit[i, j] = np.einsum("ij,ij->i", x[i], y[j]) >= threshold
    return hit


def _blocks(members: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Rows (g, left, own, cols) from rows with columns key, id, cols: all rows of a key in blocks of BLOCK, g a meeting of two blocks."""
    sizes = members.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    m = members.join(sizes, key) if key else members.crossJoin(F.broadcast(sizes))
    m = m.withColumn("mine", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    rows = m.select(*key, "mine", other, *cols)
    return rows.select(F.xxhash64(*key, F.least("mine", "o"), F.greatest("mine", "o")).alias("g"), (F.col("mine") <= F.col("o")).alias("left"), (F.col("mine") == F.col("o")).alias("own"), *cols)


def _meet(rows: DataFrame, meet, schema: str) -> DataFrame:
    """What ``meet`` makes of the rows of each g, as one table."""
    def work(batches):
        key, held = None, []
        for b in batches:
            g = np.asarray(b.column(0))
            cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                if held and g[i] != key:
                    yield from meet(pa.Table.from_batches(held).combine_chunks())
                    held = []
                key = g[i]
                held.append(b.slice(i, j - i))
        if held:
            yield from meet(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(work, schema)


def group_links(members: DataFrame, threshold: float) -> DataFrame:
    """Rows (id, n_links) from rows (component, id, v, n), all members of a linked group against all, block by block.

    Each row travels once for every block of its group that it meets, and comes back as one count for each.
    """
    def count(b):
        x, n = _matrix(b.column("v").combine_chunks()), np.asarray(b.column("n")).astype(float)
        ids, left = b.column("id").combine_chunks(), np.asarray(b.column("left"))
        a, z = np.flatnonzero(left), np.flatnonzero(~left)
        if b.column("own")[0].as_py():
            c = _reaches(x, x, threshold)
            np.fill_diagonal(c, False)
            found = [(ids, c @ n)]
        elif not len(a) or not len(z):
            found = [(ids, np.zeros(len(n)))]
        else:
            c = _reaches(x[a], x[z], threshold)
            found = [(ids.take(pa.array(a)), c @ n[z]), (ids.take(pa.array(z)), n[a] @ c)]
        for i, c in found:
            yield pa.RecordBatch.from_arrays([i, pa.array(np.rint(c).astype(np.int64))], names=["id", "n_links"])

    counted = _meet(_blocks(members, ["component"], ["id", "v", "n"]), count, f"id {dict(members.dtypes)['id']}, n_links bigint")
    return counted.groupBy("id").agg(F.sum("n_links").alias("n_links"))


def between_groups(members: DataFrame, threshold: float, k: int) -> DataFrame | None:
    """Links (a, b) between linked groups of more than ``k`` members, from rows (component, id, v): at least one for
    every two groups that have any, or None with less than two such groups.

    Lists of such groups' members may be full of their own group. The search is exact: by the triangle inequality of
    angles a link needs centres no farther apart than both radii and the threshold's angle, and a member that near to
    the other centre; those members meet block by block, and a meeting gives its closest pair only.
    """
    kind, reach = dict(members.dtypes)["id"], float(np.arccos(min(1.0, max(-1.0, threshold)))) + 1e-6
    large = members.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > k).select("component")
    large = cut(members.join(large, "component").select("component", "id", "v"))
    # a group's smallest id is its centre
    centres = large.where("id = component").select("component", F.col("v").alias("centre"))

    def angle(x, y):
        return np.arccos(np.clip(np.einsum("ij,ij->i", x, y), -1, 1))

    def radius(batches):
        for b in batches:
            if len(b):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(angle(_matrix(b.column(1)), _matrix(b.column(2))))], names=["component", "radius"])

    far = large.join(centres, "component").select("component", "v", "centre").mapInArrow(radius, f"component {kind}, radius double")
    centres = cut(centres.join(far.groupBy("component").agg(F.max("radius").alias("radius")), "component"))
    if centres.limit(2).count() < 2:
        return None

    def near(b):
        x, r, ids, left = _matrix(b.column("centre").combine_chunks()), np.asarray(b.column("radius")), b.column("id").combine_chunks(), np.asarray(b.column("left"))
        own = b.column("own")[0].as_py()
        a, z = (np.arange(len(r)),) * 2 if own else (np.flatnonzero(left), np.flatnonzero(~left))
        hit = np.arccos(np.clip(x[a] @ x[z].T, -1, 1)) <= r[a][:, None] + r[z] + reach
        i, j = np.nonzero(np.triu(hit, 1) if own else hit)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(a[i])), ids.take(pa.array(z[j]))], names=["a", "b"])

    pairs = _meet(_blocks(centres.withColumnRenamed("component", "id"), [], ["id", "centre", "radius"]), near, f"a {kind}, b {kind}")
    pairs = cut(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))

    def close(batches):
        for b in batches:
            if len(b):
                yield b.filter(pa.array(angle(_matrix(b.column(4)), _matrix(b.column(5))) <= np.asarray(b.column(6)) + reach)).select([0, 1, 2, 3, 4])

    both = pairs.select("a", "b", F.lit(True).alias("left"), F.col("a").alias("mine"), F.col("b").alias("component")).union(pairs.select("a", "b", F.lit(False), "b", "a"))
    rows = both.join(centres, "component").drop("component").join(large.withColumnRenamed("component", "mine"), "mine")
    rows = cut(rows.select("a", "b", "left", "id", "v", "centre", "radius").mapInArrow(close, f"a {kind}, b {kind}, left boolean, id {kind}, v binary"))
    blocks = lambda side: F.ceil(F.count(F.when(side, 1)) / BLOCK).cast("int")
    sizes = rows.groupBy("a", "b").agg(blocks(F.col("left")).alias("l"), blocks(~F.col("left")).alias("r")).where("l > 0 AND r > 0")
    rows = rows.join(sizes, ["a", "b"]).withColumn("m", F.pmod(F.xxhash64("id"), F.when(F.col("left"), F.col("l")).otherwise(F.col("r"))).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.when(F.col("left"), F.col("r")).otherwise(F.col("l")) - 1)))
    g = F.xxhash64("a", "b", F.when(F.col("left"), F.col("m")).otherwise(F.col("o")), F.when(F.col("left"), F.col("o")).otherwise(F.col("m")))

    def best(b):
        x, ids, left = _matrix(b.column("v").combine_chunks()), b.column("id").combine_chunks(), np.asarray(b.column("left"))
        a, z = np.flatnonzero(left), np.flatnonzero(~left)
        if len(a) and len(z):
            c = x[a] @ x[z].T
            i, j = np.unravel_index(np.argmax(c), c.shape)
            if c[i, j] >= threshold:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array([a[i]])), ids.take(pa.array([z[j]]))], names=["a", "b"])

    found = _meet(rows.select(g.alias("g"), "left", "id", "v"), best, f"a {kind}, b {kind}")
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def audit(reps: DataFrame, linked: DataFrame, threshold: float, seed: int) -> tuple[float, int]:
    """Share of the links of AUDITED seeded vectors that brute force finds and ``linked`` (id, n_links) has, and their number."""
    spark = reps.sparkSession
    some = reps.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(AUDITED)
    some = some.join(F.broadcast(some.select("id").join(linked, "id", "left").groupBy("id").agg(F.coalesce(F.sum("n_links"), F.lit(0)).alias("n_links"))), "id")
    got = some.select("id", "v", "n_links", "n").toArrow()
    if not got.num_rows:
        return 1.0, 0
    shared = spark.sparkContext.broadcast(_matrix(got.column("v").combine_chunks()))

    def work(batches):
        q = shared.value
        total = np.zeros(len(q))
        for b in batches:
            if len(b):
                total += _reaches(_matrix(b.column(0)), q, threshold).T @ np.asarray(b.column(1)).astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(q))), pa.array(total)], names=["i", "n"])

    true = np.zeros(got.num_rows)
    for r in reps.select("v", "n").mapInArrow(work, "i bigint, n double").groupBy("i").agg(F.sum("n").alias("n")).collect():
        true[r["i"]] = r["n"]
    true -= np.asarray(got.column("n"))
    have = np.minimum(np.asarray(got.column("n_links")), true)
    return (float(have.sum() / true.sum()) if true.sum() else 1.0), int(true.sum())


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.95, k: int = 10,
    tables: int = 8, max_joins: int = 4, settled: float = 0.02, min_recall: float = 0.995, max_rounds: int = 3, seed: int = 17,
) -> DataFrame:
    """Rows (id, n_links, component_id, kept, audit_recall), one for each input row.

    ``settled``: refining ends when a join changes a smaller share of the lists' places; ``max_joins`` bounds the
    joins of a round and ``max_rounds`` the rounds. audit_recall is what the last audit found.
    """
    spark = vectors.sparkSession
    ship(spark)
    d = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("e"))
    units = unit_vectors(d.where("id IS NOT NULL")).groupBy("id").agg(F.min("v").alias("v"))
    common = units.groupBy(F.length("v").alias("l")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").first()
    units = cut(units.where(F.length("v") == (common["l"] if common else 0)))
    reps = cut(units.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    size = reps.count()
    links, found = None, None
    recall = 1.0
    for turn in range(max_rounds if size > 1 else 0):
        graph = cut(_top(start_graph(reps, size, tables, k, seed + 101 * turn), k))
        release(spark)
        for join in range(max_joins):
            old = graph.select("u", F.explode("nb").alias("x")).select("u", F.col("x.v").alias("v"), (-F.col("x.d")).cast("float").alias("sim"))
            new = cut(_top(old.union(refine(graph, reps, k, seed + 1000 * turn + join)), k))
            moved = new.join(graph.select("u", F.col("nb").alias("was")), "u", "left").agg(F.sum(F.size(F.array_except("nb", F.coalesce("was", F.array().cast(dict(new.dtypes)["nb"])))))).first()[0] or 0
            graph = new
            release(spark)
            if moved <= settled * k * size:
                break
        near = graph.select("u", F.explode("nb").alias("x")).where(-F.col("x.d") >= threshold - 1e-4)
        near = near.select(F.greatest("u", "x.v").alias("a"), F.least("u", "x.v").alias("b")).distinct()
        now = exact(near, reps, threshold)
        links = cut(now if links is None else links.union(now).distinct())
        found = cut(components(links))
        more = between_groups(found.join(reps, found["node"] == reps["id"]).select("component", "id", "v"), threshold, k)
        if more is not None:
            more = cut(more)
            if more.limit(1).count():
                links = cut(links.union(more).distinct())
                found = cut(components(links))
        members = found.join(reps, found["node"] == reps["id"]).select("component", "id", "v", "n")
        linked = cut(group_links(members, threshold))
        release(spark)
        recall, _ = audit(reps, linked, threshold, seed + turn)
        if recall >= min_recall:
            break
    if recall < min_recall:
        raise RuntimeError(f"recall {recall:.4f} of the last audit is below {min_recall} after {max_rounds} rounds")
    if links is None:
        empty = spark.createDataFrame([], f"id {dict(d.dtypes)['id']}, n_links bigint, component {dict(d.dtypes)['id']}")
        by_rep = empty
    else:
        by_rep = linked.join(found.withColumnRenamed("node", "id"), "id")
    reps = reps.select("v", F.col("id").alias("rep"), "n").join(by_rep.withColumnRenamed("id", "rep"), "rep", "left")
    out = units.join(reps, "v").select("id", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = d.select("id").join(out.hint("shuffle_hash"), "id", "left").select(F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(vec_id) == F.col("component_id"), F.lit(True))).withColumn("audit_recall", F.lit(float(recall)))
