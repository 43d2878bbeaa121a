"""Language-model scoring of whole documents by a gated recurrent network.

Tokens are words (A-Z lower-cased) and one end a document. Every word's count over all training documents is an
exact aggregation by the word's 64-bit hash, as large as the vocabulary. The output is factored by class: the
network gives the probability of the next token's class, and within a class

* of frequent words (the ``HEAD`` most frequent, in classes of 64 at most): a softmax of the network's state;
* of a band of rarer words (counts within a factor of sqrt 2): the word's share of the band's count;
* of words that no training document has: 1, as the base model counts them as one word.

So the probabilities of all next tokens sum to 1. The network is trained by backpropagation truncated to windows of
``STEPS`` tokens, the state carried from window to window; there each word's count is less what its own document has,
so that the classes of rare and unknown words are met as often as in documents that weren't counted. It starts from a
sample of at most ``max_docs`` whole documents and ``max_words`` words; from there every partition goes once over all
of its training documents, and the weights are averaged, each partition's by its number of tokens.

Scoring runs whole documents side by side, longest first, in windows that carry the state on. Counts of words come
from a broadcast table of fixed size for the most frequent ones and from a join on hashes for all others.

Null and empty texts are one end. Repeated rows are scored each by itself, and counted each. Rows with a null id
are scored. With nothing to learn from, every count is 0 and every score 0 (one unknown word is sure). An empty
table gives no rows; words of equal counts are ranked by hash; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as bt
from .common import cut, release, ship

HEAD, LISTED, HIDDEN, STEPS = 1024, 65_536, 16, 32
#: Documents that a partition's training reads side by side.
LANES = 512
#: Stands for the end of a document among the hashes of words.
END = np.uint64(0xE17D0FD0C5A11ED5)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every token, ends included."""
    s, e, doc = bt.spans(data, off)
    n = len(off) - 1
    last = bt.runs(doc, n)[1:]
    out = np.full(len(s) + n, END)
    at = np.arange(len(s)) + doc
    out[at] = bt.hashes(data, s, e, lower=True)
    row = np.empty(len(out), np.int64)
    row[at] = doc
    row[last + np.arange(n)] = np.arange(n)
    return out, row


def count_tokens(docs: DataFrame) -> DataFrame:
    """Rows (h, c) over all rows of column text."""
    def work(batches):
        for b in batches:
            for _, _, data, off in bt.slices(b.column(0)):
                h, c = np.unique(tokens(data, off)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    return docs.select("text").mapInArrow(work, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


class Classes:
    """Which class a count belongs to, and a token's share of it.

    Classes 0 to ``n_head`` - 1 hold the head words by rank; then one for each band of counts; the last is the unknown.
    """

    def __init__(self, listed: np.ndarray, counts: np.ndarray, words_by_band: dict[int, tuple[int, int]], total: int, distinct: int):
        order = np.lexsort((listed, -counts))
        head = order[:HEAD]
        self.total, self.distinct, self.size = total, distinct, len(head)
        by_hash = np.argsort(listed)
        self.listed, self.counts = listed[by_hash], counts[by_hash]
        rank = np.full(len(listed), -1)
        rank[head] = np.arange(len(head))
        self.rank = rank[by_hash]
        edges, step = [0], 1
        while edges[-1] < len(head):
            edges.append(min(edges[-1] + step, len(head)))
            step = min(max(1, edges[-1]), 64)
        self.edges = np.array(edges)
        self.n_head = len(edges) - 1
        taken: dict[int, int] = {}
        for c in counts[head]:
            taken[self.band(c)] = taken.get(self.band(c), 0) + int(c)
        #: what the words of each band that aren't head words count together
        self.mass = {k: mass - taken.get(k, 0) for k, (_, mass) in words_by_band.items() if mass > taken.get(k, 0)}
        self.bands = np.array(sorted(self.mass), np.int64)
        self.n = self.n_head + len(self.bands) + 1
        self.log_mass = np.log([self.mass[k] for k in self.bands.tolist()] or [1.0])

    @staticmethod
    def band(c):
        return np.floor(2 * np.log2(np.maximum(c, 1)) + 1e-9).astype(np.int64) if isinstance(c, np.ndarray) else int(math.floor(2 * math.log2(max(c, 1)) + 1e-9))

    def place(self, h: np.ndarray) -> np.ndarray:
        """Where the hash stands in the list, or -1."""
        if not len(self.listed):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.listed, h), len(self.listed) - 1)
        return np.where(self.listed[at] == h, at, -1)

    def of(self, place: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, rank (-1: not a head word) and log share within a band's class (0 for head words) of tokens by place and count."""
        rank = np.where(place >= 0, self.rank[place] if len(self.rank) else -1, -1)
        cls = np.full(len(c), self.n - 1)
        inside = np.zeros(len(c))
        is_head = rank >= 0
        cls[is_head] = np.searchsorted(self.edges, rank[is_head], "right") - 1
        rare = np.flatnonzero(~is_head & (c > 0))
        if len(rare) and len(self.bands):
            k = np.minimum(np.searchsorted(self.bands, self.band(c[rare])), len(self.bands) - 1)
            cls[rare] = self.n_head + k
            inside[rare] = np.log(c[rare]) - self.log_mass[k]
        return cls, rank, inside

    def symbols(self, cls: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Input rows: head words by rank, then the other classes, then the start."""
        return np.where(rank >= 0, rank, self.size + cls - self.n_head)

    @property
    def start(self) -> int:
        return self.size + self.n - self.n_head


def _sigmoid(x):
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _bounded(h: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Logits, shifted so that their exponentials neither overflow nor all vanish; states lie in -1 to 1."""
    x = h @ w
    x += b
    if float((np.abs(b) + np.abs(w).sum(0)).max()) > 60:
        x -= x.max(1, keepdims=True)
    return x


class Network:
    def __init__(self, c: Classes, seed: int, dim: int = 24):
        r, f, h = np.random.Generator(np.random.PCG64(seed)), np.float32, HIDDEN
        self.c = c
        draw = lambda *s, by: r.normal(0, by, s).astype(f)
        self.p = {"e": draw(c.start + 1, dim, by=0.3), "wx": draw(dim, 3 * h, by=dim**-0.5), "bx": np.zeros(3 * h, f), "u": draw(h, 3 * h, by=h**-0.5), "oc": draw(h, c.n, by=0.1), "bc": np.zeros(c.n, f), "ow": draw(h, c.size, by=0.1), "bw": np.zeros(c.size, f)}
        if c.size:
            n = c.counts[c.rank >= 0][np.argsort(c.rank[c.rank >= 0])].astype(float)
            self.p["bw"][:] = np.log(n / n.max())
        mass = [n[a:b].sum() for a, b in zip(c.edges[:-1], c.edges[1:])] + [c.mass[k] for k in c.bands.tolist()] + [max(1.0, c.mass.get(0, 1.0))]
        self.p["bc"][:] = np.log(np.array(mass) / sum(mass))
        self.begin()

    def begin(self) -> None:
        self.m = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in self.p.items()}
        self.steps = 0

    def inputs(self) -> np.ndarray:
        return self.p["e"] @ self.p["wx"] + self.p["bx"]

    def next(self, h: np.ndarray, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """The state after inputs ``x`` (rows of ``inputs()``)."""
        k = HIDDEN
        a = h @ self.p["u"]
        g = _sigmoid(x[:, : 2 * k] + a[:, : 2 * k])
        n = np.tanh(x[:, 2 * k :] + g[:, k:] * a[:, 2 * k :])
        if keep is not None:
            keep.append((h, g, n, a[:, 2 * k :]))
        return n + g[:, :k] * (h - n)

    def log_probs(self, h: np.ndarray, cls: np.ndarray, rank: np.ndarray, inside: np.ndarray, back: bool = False):
        """Natural log probability of each token at its state; with ``back`` also the gradients of their negated sum."""
        p, c = self.p, self.c
        x = _bounded(h, p["oc"], p["bc"])
        at = np.arange(len(cls))
        own = x[at, cls]
        np.exp(x, out=x)
        total = x @ np.ones(c.n, np.float32)
        out = own - np.log(total) + inside
        if back:
            x /= total[:, None]
            x[at, cls] -= 1
            grad = {"oc": h.T @ x, "bc": np.ones(len(x), np.float32) @ x, "ow": np.zeros_like(p["ow"]), "bw": np.zeros_like(p["bw"])}
            dh = x @ p["oc"].T
        heads = np.flatnonzero(rank >= 0)
        heads = heads[np.argsort(cls[heads].astype(np.int16 if c.n < 1 << 15 else np.int64), kind="stable")]
        cuts = np.searchsorted(cls[heads], np.arange(c.n_head + 1))
        for k in range(c.n_head):
            a, b = c.edges[k], c.edges[k + 1]
            rows = heads[cuts[k] : cuts[k + 1]]
            if b - a < 2 or not len(rows):
                continue
            own_h = h.take(rows, axis=0)
            y = _bounded(own_h, p["ow"][:, a:b], p["bw"][a:b])
            i, t = np.arange(len(rows)), rank[rows] - a
            own = y[i, t]
            np.exp(y, out=y)
            total = y @ np.ones(b - a, np.float32)
            out[rows] += own - np.log(total)
            if back:
                y /= total[:, None]
                y[i, t] -= 1
                grad["ow"][:, a:b] = own_h.T @ y
                grad["bw"][a:b] = np.ones(len(y), np.float32) @ y
                dh[rows] += y @ p["ow"][:, a:b].T
        return (out, grad, dh) if back else out

    def train_window(self, h: np.ndarray, sym: np.ndarray, cls: np.ndarray, rank: np.ndarray, inside: np.ndarray, rate: float) -> np.ndarray:
        """One step on a window: sym (steps, lanes) are the tokens before the targets; the start resets the state. Gives the state after it."""
        p, k = self.p, HIDDEN
        f, (steps, lanes) = np.float32, sym.shape
        n = steps * lanes
        flat = sym.reshape(-1).astype(np.int16 if self.c.start < 1 << 15 else np.int64)
        # units first, then steps, then lanes, so that each gate is one block of memory
        x = np.ascontiguousarray(self.inputs().take(flat, axis=0).T).reshape(3 * k, steps, lanes)
        alive = (sym != self.c.start).astype(f)
        before, states, new, an = (np.empty((k, steps, lanes), f) for _ in range(4))
        g, ut = np.empty((2 * k, steps, lanes), f), np.ascontiguousarray(p["u"].T)
        h = np.ascontiguousarray(h.T)
        for t in range(steps):
            h = h * alive[t]
            a = ut @ h
            gate = a[: 2 * k]
            gate += x[: 2 * k, t]
            _sigmoid(gate)
            m = gate[k:] * a[2 * k :]
            m += x[2 * k :, t]
            np.tanh(m, out=m)
            before[:, t], g[:, t], an[:, t], new[:, t] = h, gate, a[2 * k :], m
            h = h - m
            h *= gate[:k]
            h += m
            states[:, t] = h
        _, grad, dout = self.log_probs(np.ascontiguousarray(states.reshape(k, n).T), cls.reshape(-1), rank.reshape(-1), inside.reshape(-1), True)
        dout = np.ascontiguousarray(dout.T).reshape(k, steps, lanes)
        # what doesn't depend on later steps, for all steps at once
        z, r = g[:k], g[k:]
        rest = 1 - z
        by_z = (before - new) * z
        by_z *= rest
        by_n = new * new
        np.subtract(1, by_n, out=by_n)
        by_n *= rest
        by_r = 1 - r
        by_r *= r
        by_r *= an
        da, carried = np.empty((3 * k, steps, lanes), f), np.zeros((k, lanes), f)
        part = np.empty((3 * k, lanes), f)
        for t in range(steps - 1, -1, -1):
            d = dout[:, t] + carried
            np.multiply(d, by_z[:, t], out=part[:k])
            dn = d * by_n[:, t]
            np.multiply(dn, by_r[:, t], out=part[k : 2 * k])
            np.multiply(dn, r[:, t], out=part[2 * k :])
            carried = p["u"] @ part
            d *= z[:, t]
            carried += d
            carried *= alive[t]
            da[:, t] = part
            by_n[:, t] = dn
        da = da.reshape(3 * k, n)
        grad["u"] = before.reshape(k, n) @ da.T
        da[2 * k :] = by_n.reshape(k, n)
        grad["wx"], grad["bx"] = p["e"].take(flat, axis=0).T @ da.T, da @ np.ones(n, f)
        grad["e"] = np.zeros_like(p["e"])
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        cuts = np.flatnonzero(np.diff(flat, prepend=-1))
        grad["e"][flat[cuts]] = np.add.reduceat((da.T @ p["wx"].T).take(order, axis=0), cuts)
        scale = 1 / cls.size
        norm = math.sqrt(sum(float((g * g).sum()) for g in grad.values())) * scale
        scale *= min(1.0, 1.0 / max(norm, 1e-9))
        self.steps += 1
        for name, g in grad.items():
            g = g * scale
            m, v = self.m[name]
            m += 0.1 * (g - m)
            v += 0.005 * (g * g - v)
            p[name] -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.995**self.steps)) + 1e-7)
        return h.T

    def fit(self, docs: list[tuple], epochs: int, lanes: int, seed: int, rate: float = 0.01, last: float = 0.05) -> None:
        """``docs``: (cls, rank, inside) of each document's tokens. The rate falls to its share ``last``."""
        r = np.random.Generator(np.random.PCG64(seed))
        words = sum(len(d[0]) for d in docs)
        lanes = max(1, min(lanes, words // (4 * STEPS)))
        steps = -(-words // (lanes * STEPS))
        done, planned = 0, max(1, epochs * steps)
        for _ in range(epochs):
            order = r.permutation(len(docs))
            cls, rank, inside = (np.concatenate([docs[i][k] for i in order]) for k in range(3))
            sym = np.concatenate([np.concatenate([[self.c.start], self.c.symbols(docs[i][0], docs[i][1])[:-1]]) for i in order])
            n = steps * STEPS
            # the last window is filled up from the first tokens
            lane = lambda x: np.resize(x, n * lanes).reshape(lanes, n).T
            s, c, k, v = lane(sym), lane(cls), lane(rank), lane(inside)
            h = np.zeros((lanes, HIDDEN), np.float32)
            for t in range(0, n, STEPS):
                part = slice(t, t + STEPS)
                h = self.train_window(h, s[part], c[part], k[part], v[part], rate * (1 - (1 - last) * done / planned))
                done += 1

    def score(self, cls: np.ndarray, rank: np.ndarray, inside: np.ndarray, row: np.ndarray, n: int, window: int = 96) -> np.ndarray:
        """Natural log probability of each document; tokens one document after another."""
        out, table = np.zeros(n), self.inputs()
        at = bt.runs(row, n)
        size = np.diff(at)
        order = np.argsort(-size, kind="stable")
        size, first = size[order], at[:-1][order]
        sym = self.c.symbols(cls, rank)
        h, t, longest = np.zeros((n, HIDDEN), np.float32), 0, int(size[0]) if n else 0
        left = n
        while t < longest:
            places, states = [], []
            for t in range(t, min(t + window, longest)):
                while size[left - 1] <= t:
                    left -= 1
                place = first[:left] + t
                x = table[sym[place - 1]] if t else np.broadcast_to(table[self.c.start], (left, table.shape[1]))
                h = self.next(h[:left], x)
                places.append(place)
                states.append(h)
            t += 1
            place = np.concatenate(places)
            lp = self.log_probs(np.concatenate(states), cls[place], rank[place], inside[place])
            out += np.bincount(row[place], weights=lp, minlength=n)
        return out


def _key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.when(F.col(doc_id).isNull(), F.col(text)))


def _counts(c: Classes, h: np.ndarray, row: np.ndarray, hs: pa.Array, cs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Place and count of every token; hs and cs: each row's words outside the list and their counts."""
    place = c.place(h)
    n = np.where(place >= 0, c.counts[place] if len(c.counts) else 0, 0)
    sizes = np.asarray(hs.value_lengths().fill_null(0))
    if sizes.sum():
        owner = np.repeat(np.arange(len(hs)), sizes).astype(np.uint64)
        at = bt.mix(np.asarray(hs.flatten()).view(np.uint64) ^ bt.mix(owner))
        order = np.argsort(at)
        at, value = at[order], np.asarray(cs.flatten())[order]
        new = np.flatnonzero(place < 0)
        mine = bt.mix(h[new] ^ bt.mix(row[new].astype(np.uint64)))
        k = np.minimum(np.searchsorted(at, mine), len(at) - 1)
        n[new] = np.where(at[k] == mine, value[k], 0)
    return place, n


def _own(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """How often each token occurs in its own document."""
    _, inverse, own = np.unique(bt.mix(h ^ bt.mix(row.astype(np.uint64))), return_inverse=True, return_counts=True)
    return own[inverse]


def rare_counts(docs: DataFrame, counts: DataFrame, classes: Classes) -> DataFrame:
    """Rows (key, h, c): the counted words of each text of rows (key, text) that aren't in the list, and their counts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(classes)

    def rare(batches):
        c = shared.value
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1)):
                h, row = tokens(data, off)
                new = c.place(h) < 0
                h, row = h[new], row[new]
                _, first = np.unique(bt.mix(h ^ bt.mix(row.astype(np.uint64))), return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), b.column(0).slice(i, j - i).take(pa.array(row[first]))], names=["h", "key"])

    pairs = docs.select("key", "text").mapInArrow(rare, "h bigint, key bigint")
    found = cut(pairs.join(counts, "h").groupBy("key").agg(F.collect_list("h").alias("h"), F.collect_list("c").alias("c")))
    release(spark)
    return found


def train_on_all(net: Network, docs: DataFrame, found: DataFrame, seed: int, rate: float = 0.004) -> None:
    """Go on from ``net`` over every document of rows (key, text), each partition by itself, and average."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(batches):
        net, seen = shared.value, 0
        net.p = {k: x.copy() for k, x in net.p.items()}  # the worker may go on to another partition
        net.begin()
        for b in batches:
            for i, j, data, off in bt.slices(b.column(0)):
                h, row = tokens(data, off)
                place, n = _counts(net.c, h, row, b.column(1).slice(i, j - i), b.column(2).slice(i, j - i))
                cls, rank, inside = net.c.of(place, np.maximum(n - _own(h, row), 0))
                at = bt.runs(row, j - i)
                net.fit([(cls[a:z], rank[a:z], inside[a:z]) for a, z in zip(at[:-1], at[1:])], 1, LANES, seed, rate, 1.0)
                seen += len(h)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([np.concatenate([x.ravel() for x in net.p.values()]).astype(np.float32).tobytes()])], names=["n", "p"])

    def alone(batches):
        start = shared.value.p
        try:
            yield from work(batches)
        finally:
            shared.value.p = start

    joined = docs.join(found.hint("shuffle_hash"), "key", "left").sortWithinPartitions("key", F.xxhash64("text")).select("text", "h", "c")
    total, words = 0.0, 0
    # one row of fixed size for each partition, one at a time
    for r in cut(joined.mapInArrow(alone, "n bigint, p binary")).toLocalIterator():
        total = total + r["n"] * np.frombuffer(r["p"], np.float32).astype(float)
        words += r["n"]
    if words:
        at = 0
        for k, x in net.p.items():
            net.p[k] = (total[at : at + x.size] / words).astype(np.float32).reshape(x.shape)
            at += x.size
    release(docs.sparkSession)


def fit_all(docs: DataFrame, scored: DataFrame, max_docs: int, max_words: int, epochs: int, seed: int) -> tuple[DataFrame, Classes, Network | None, DataFrame]:
    """Counts of all tokens of column text, classes, the network, and ``rare_counts`` of ``scored`` (columns key, text), from ``docs`` (columns key, id, text)."""
    spark = docs.sparkSession
    counts = cut(count_tokens(docs))
    release(spark)
    band = F.floor(2 * F.log2("c") + 1e-9).cast("int")
    bands = {r["k"]: (r["words"], r["mass"]) for r in counts.groupBy(band.alias("k")).agg(F.count(F.lit(1)).alias("words"), F.sum("c").alias("mass")).collect()}
    have, low = 0, None
    for k in sorted(bands, reverse=True):
        have += bands[k][0]
        if have > LISTED:
            break
        low = k
    listed = counts.where(band >= low).toPandas() if low is not None else None  # LISTED rows at most
    h = listed["h"].to_numpy(np.int64).view(np.uint64) if low is not None else np.zeros(0, np.uint64)
    c = Classes(h, listed["c"].to_numpy(np.int64) if low is not None else np.zeros(0, np.int64), bands, sum(x[1] for x in bands.values()), sum(x[0] for x in bands.values()))
    found_rare = rare_counts(scored, counts, c)
    if not bands:
        return counts, c, None, found_rare

    def work(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1)):
                h, row = tokens(data, off)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(bt.runs(row, j - i).astype(np.int32)), pa.array(h.view(np.int64)))], names=["k", "h"])

    picked = docs.select(F.xxhash64(F.lit(seed), "id").alias("k"), "text").where("k IS NOT NULL")
    smallest = picked.select("k").orderBy("k").limit(max_docs).agg(F.max("k")).first()[0]
    rows, words = [], 0
    for r in picked.where(F.col("k") <= smallest).mapInArrow(work, "k bigint, h array<bigint>").orderBy("k", F.size("h")).toLocalIterator():
        x = np.array(r["h"], np.int64).view(np.uint64)
        # whole documents; those that don't fit are met with all others below
        if words + len(x) <= max_words:
            rows.append(x)
            words += len(x)
    rare = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.uint64)
    rare = rare[c.place(rare) < 0].view(np.int64)
    found = counts.join(F.broadcast(spark.createDataFrame(pa.table({"h": rare}))), "h").toPandas() if len(rare) else None  # max_words rows at most
    known = found["h"].to_numpy(np.int64).view(np.uint64) if found is not None else np.zeros(0, np.uint64)
    order = np.argsort(known)
    known, value = known[order], found["c"].to_numpy(np.int64)[order] if found is not None else known
    sample = []
    for x in rows:
        place = c.place(x)
        n = np.where(place >= 0, c.counts[place] if len(c.counts) else 0, 0)
        if len(known):
            at = np.minimum(np.searchsorted(known, x), len(known) - 1)
            n = np.where((place < 0) & (known[at] == x), value[at], n)
        _, inverse, own = np.unique(x, return_inverse=True, return_counts=True)
        sample.append(c.of(place, np.maximum(n - own[inverse], 0)))
    net = Network(c, seed)
    if sample:
        net.fit(sample, epochs, 64, seed)
    del net.m
    train_on_all(net, docs.select("key", "text"), found_rare, seed)
    return counts, c, net, found_rare


def learn(docs: DataFrame, max_docs: int, max_words: int, epochs: int, seed: int) -> tuple[DataFrame, Classes, Network | None]:
    """Counts of all tokens of column text, classes, and the network, from ``docs`` (columns id, text)."""
    docs = docs.withColumn("key", _key("id", "text"))
    return fit_all(docs, docs, max_docs, max_words, epochs, seed)[:3]


def score(
    docs: DataFrame, train_on: Column | None = None, doc_id: str = "doc_id", text: str = "text",
    max_docs: int = 2000, max_words: int = 1_000_000, epochs: int = 3, seed: int = 13,
) -> DataFrame:
    """Rows (id, n_tokens, n_known, train_tokens, base_score, score), one for each input row.

    ``train_on``: which rows are learned from (all by default). base_score is the log10 probability by counts plus
    one, score the network's; ``max_docs`` and ``max_words`` bound the sample that the network starts from, never the
    counts or the documents it learns from.
    """
    spark = docs.sparkSession
    ship(spark)
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), _key(doc_id, text).alias("key"))
    learned = docs.where(train_on) if train_on is not None else docs
    learned = learned.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), _key(doc_id, text).alias("key"))
    _, classes, net, found = fit_all(learned, d, max_docs, max_words, epochs, seed)
    release(spark)
    shared = spark.sparkContext.broadcast((classes, net))  # LISTED rows and the network, whatever the input

    def work(batches):
        c, net = shared.value
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1), 2 * bt.LIMIT):
                h, row = tokens(data, off)
                place, n = _counts(c, h, row, b.column(2).slice(i, j - i), b.column(3).slice(i, j - i))
                size = np.bincount(row, minlength=j - i)
                base = np.bincount(row, weights=np.log10(n + 1.0), minlength=j - i) - size * math.log10(c.total + c.distinct + 1)
                known = np.bincount(row[n > 0], minlength=j - i)
                s = net.score(*c.of(place, n), row, j - i) / math.log(10) if net else np.zeros(j - i)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(size), pa.array(known), pa.array(np.full(j - i, c.total)), pa.array(base), pa.array(s)], names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = dict(d.dtypes)["id"]
    joined = d.join(found.hint("shuffle_hash"), "key", "left").select("id", "text", "h", "c")
    return joined.mapInArrow(work, f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").withColumnRenamed("id", doc_id)
