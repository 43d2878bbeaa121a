"""SentencePiece encoding by sampling segmentations without replacement, and decoding.

The lattice of a text has an edge for every vocabulary piece that matches at a place (bytes for characters
that no piece has). A piece weighs (rank + 2) ** -alpha by its rank in the vocabulary file, and a
segmentation the product of its pieces' weights, normalised over the lattice (backward sums). ``k`` distinct
segmentations are drawn as the k largest Gumbel-perturbed log probabilities, by best-first search: the root
draws its Gumbel value, a path hands its value down to the edge drawn, and at each of its decisions the
other edges together hold a Gumbel value truncated at it. The largest of these values over all paths so far
is the next sample, where it leaves its path. So only paths that come out are ever walked.

No piece has white space after other characters, so the lattice falls into units (blanks and the word after
them), and the edges of each distinct unit are worked out once and kept for later texts, in bounded room. Texts
are sampled about a megabyte at a time (a longer text at once), so memory follows the longest text.

A sample's log_inclusion is the log of the probability that its perturbed value beats the (k+1)-th one;
0 where fewer than k + 1 segmentations exist. Missing samples have null ids.

Everything is seeded by the row's key: repeated rows get the same samples, and rows with a null id share one
key. Null and empty texts have no pieces: one empty segmentation. An empty table gives no rows; other columns
are not read. ``decode`` gives back every text exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .common import ship

#: Bytes of text that are sampled at once.
SLICE = 1 << 20
#: Nodes and edges of units that are kept from slice to slice (about 30 bytes each).
ROOM = 6 << 20


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str | None = None) -> dict:
    """Pieces (blank for the mark of word starts) by text with id and rank, and the ids of the 256 bytes."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or default_model())
    pieces, byte_ids = {}, [0] * 256
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            p = p.replace("▁", " ")
            if " " not in p.lstrip(" "):
                pieces[p] = (i, -sp.get_score(i))
    ranks = {p: r for r, p in enumerate(sorted(pieces, key=lambda p: (pieces[p][1], pieces[p][0])))}
    return {"pieces": {p: (i, ranks[p]) for p, (i, _) in pieces.items()}, "bytes": byte_ids}


class Vocabulary:
    """Piece lookup by hash of bytes: a bitmap first, then the sorted hashes."""

    def __init__(self, vocabulary: dict, alpha: float):
        items = [(p.encode(), i, r) for p, (i, r) in vocabulary["pieces"].items()]
        ends = np.cumsum([len(b) for b, _, _ in items])
        starts = ends - [len(b) for b, _, _ in items]
        data = np.frombuffer(b"".join(b for b, _, _ in items), np.uint8)
        h = self.spans(self.sums(data), starts, ends)
        order = np.argsort(h)
        self.hash = h[order]
        self.ids = np.array([i for _, i, _ in items])[order]
        self.weights = -alpha * np.log(np.array([r for _, _, r in items]) + 2.0)[order]
        self.table = np.full(1 << 22, -1, np.int32)
        self.table[self.slot(self.hash)] = np.arange(len(items))
        #: slots that more than one piece has
        self.shared = np.bincount(self.slot(self.hash), minlength=1 << 22) > 1
        self.lengths = sorted({len(b) for b, _, _ in items})
        self.byte_ids = np.array(vocabulary["bytes"])
        self.byte_weight = -alpha * np.log(len(items) + 2.0)
        #: the longest piece by its first two bytes (a single byte: the longest that begins with it)
        self.reach = np.zeros((256, 256), np.int64)
        for b, _, _ in items:
            at = (b[0], slice(None)) if len(b) == 1 else (b[0], b[1])
            self.reach[at] = np.maximum(self.reach[at], len(b))

    @staticmethod
    def sums(data: np.ndarray) -> np.ndarray:
        p, _ = bt._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(bt._TABLE[data] * p[: len(data)], out=out[1:])
        return out

    @staticmethod
    def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, inv = bt._powers(len(sums))
        return (sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * bt.U(0xD6E8FEB86659FD93)

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return ((h * bt.U(0x9E3779B97F4A7C15)) >> bt.U(42)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and these pieces' numbers."""
        slot = self.slot(h)
        k = self.table[slot]
        some = np.flatnonzero(k >= 0)
        k = k[some]
        twice = self.shared[slot[some]]
        if twice.any():
            k[twice] = np.minimum(np.searchsorted(self.hash, h[some[twice]]), len(self.hash) - 1)
        hit = self.hash[k] == h[some]
        return some[hit], k[hit]


class Lattice:
    """Edges of distinct units: a node is a byte place of a unit, the place after its last byte its end.

    Units are kept from one slice of text to the next, up to ``room`` edges (more only if one slice needs
    more); then all are dropped, so memory is bounded whatever the vocabulary of the texts.
    """

    #: Array name -> (type, whether it has an entry a node; else one an edge).
    ARRAYS = {"is_end": (bool, True), "count": (np.int32, True), "first": (np.int64, True), "next": (np.int32, False), "id": (np.int32, False), "logp": (np.float64, False), "cum": (np.float32, False)}

    def __init__(self, v: Vocabulary, room: int = ROOM):
        self.v = v
        self._allot(room)

    def _allot(self, room: int) -> None:
        self.room = room
        self._all = {k: np.empty(room + 1, t) for k, (t, _) in self.ARRAYS.items()}  # pages are only mapped when written
        self._empty()

    def _empty(self) -> None:
        self.nodes = self.edges = 0
        self.known, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._show()

    def _show(self) -> None:
        self._all["first"][self.nodes] = self.edges
        for k, (_, of_node) in self.ARRAYS.items():
            setattr(self, k, self._all[k][: self.nodes + (k == "first") if of_node else self.edges])

    def units(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """First nodes of the units data[starts : ends] with hashes ``h``; units not known yet are added."""
        own, where, which = np.unique(h, return_index=True, return_inverse=True)
        out = self._find(own)
        new = np.flatnonzero(out < 0)
        if len(new):
            parts = [self._part(data, s, e) for s, e in self._chunks(starts[where[new]], ends[where[new]])]
            n, m = sum(len(x["count"]) for _, x in parts), sum(len(x["id"]) for _, x in parts)
            if max(self.nodes + n, self.edges + m) > self.room:
                self._empty()
                if len(new) < len(own):  # the others have gone too
                    return self.units(h, data, starts, ends)
                if max(n, m) > self.room:
                    self._allot(max(n, m))
            begins = []
            for begin, x in parts:
                begins.append(begin + self.nodes)
                x["next"] += self.nodes
                x["first"] += self.edges
                n, m = len(x["count"]), len(x["id"])
                for k, (_, of_node) in self.ARRAYS.items():
                    at = self.nodes if of_node else self.edges
                    self._all[k][at : at + (n if of_node else m)] = x[k]
                self.nodes += n
                self.edges += m
            self._show()
            known, start = np.concatenate([self.known, own[new]]), np.concatenate([self.start, *begins])
            order = np.argsort(known)
            self.known, self.start = known[order], start[order]
            out = self._find(own)
        return out[which]

    def _find(self, h: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.start[at], -1)

    @staticmethod
    def _chunks(starts: np.ndarray, ends: np.ndarray, limit: int = 1 << 18):
        """Units in runs of about ``limit`` bytes, which bound the arrays worked with at once."""
        total = np.cumsum(ends - starts)
        cuts = [0, *(np.flatnonzero(np.diff(total // limit)) + 1).tolist(), len(starts)]
        return [(starts[a:z], ends[a:z]) for a, z in zip(cuts[:-1], cuts[1:]) if a < z]

    def _part(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, dict]:
        """First nodes of some units, and their arrays, numbered from 0."""
        v = self.v
        length = ends - starts
        base = np.concatenate([[0], np.cumsum(length + 1)])
        n = int(base[-1])
        unit = np.repeat(np.arange(len(length)), length + 1)
        place = np.arange(n) - base[unit]
        is_end = place == length[unit]
        buf = np.zeros(n, np.uint8)
        buf[~is_end] = data[(starts[unit] + place)[~is_end]]
        stop = base[unit] + length[unit]
        sums = v.sums(buf)
        _, inv = bt._powers(n + 1)
        lead = bt.LEADS[buf] & ~is_end
        follow = np.append(buf[1:], 0)
        reach = np.where(lead, np.minimum(v.reach[buf, follow], stop - np.arange(n)), 0)
        count = np.zeros(n, np.int64)
        found = []
        live = np.flatnonzero(reach)
        width = np.where(buf < 0xC0, 1, np.where(buf < 0xE0, 2, np.where(buf < 0xF0, 3, 4)))
        single = np.zeros(n, bool)
        for size in v.lengths:
            live = live[reach[live] >= size]
            if not len(live):
                break
            where, k = v.find((sums[live + size] - sums[live]) * inv[live] + bt.U(size * 0xD6E8FEB86659FD93 % 2**64))
            at = live[where]
            single[at[width[at] == size]] = True
            found.append((at, count[at].copy(), at + size, v.ids[k], v.weights[k]))
            count[at] += 1
        # bytes where no piece has the character
        bare = lead & ~single
        inside = ~is_end & bt.LEADS[buf]
        owner = np.maximum.accumulate(np.where(inside, np.arange(n), 0))
        spell = np.flatnonzero(~is_end & bare[owner] & (np.arange(n) < stop))
        found.append((spell, count[spell].copy(), spell + 1, v.byte_ids[buf[spell]], np.full(len(spell), v.byte_weight)))
        count[spell] += 1
        first = np.concatenate([[0], np.cumsum(count)])
        m = int(first[-1])
        to_node, ident_of, w = np.zeros(m, np.int32), np.zeros(m, np.int32), np.zeros(m)
        for at, rank, to, ident, weight in found:
            e = first[at] + rank
            to_node[e], ident_of[e], w[e] = to, ident, weight
        del found, sums
        beta = np.zeros(n)
        away = np.where(count > 0, stop - np.arange(n), 0).astype(np.int32 if (stop - base[unit]).max(initial=0) >= 1 << 15 else np.int16)
        order = np.argsort(away, kind="stable")
        cuts = np.searchsorted(away[order], np.arange(1, away.max(initial=0) + 2))
        logp = w
        for a, z in zip(cuts[:-1], cuts[1:]):
            if a == z:
                continue
            group = order[a:z]
            size = count[group]
            offs = np.cumsum(size) - size
            edge = np.arange(offs[-1] + size[-1]) + np.repeat(first[group] - offs, size)
            x = w[edge] + beta[to_node[edge]]
            top = np.maximum.reduceat(x, offs)
            total = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, size)), offs))
            beta[group] = total
            logp[edge] = x - np.repeat(total, size)
        cum = np.cumsum(np.exp(logp))
        if m:
            cum -= np.repeat(np.concatenate([[0.0], cum])[first[:-1]], count)
            cum[first[1:][count > 0] - 1] = 2.0
        return base[:-1], {"is_end": is_end, "count": count, "first": first[:-1], "next": to_node, "id": ident_of, "logp": logp, "cum": cum}

    def walk(self, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each node to its unit's end, by drawn edges: edges one walk after another, and their numbers."""
        live = np.argsort(node, kind="stable")
        live = live[~self.is_end[node[live]]]
        at, step, steps = node[live], 0, []
        count = np.zeros(len(node), np.int64)
        while len(live):
            edge = self.first[at]
            many = np.flatnonzero(self.count[at] > 1)
            u = bt.unit(bt.mix(key[live[many]] + bt.U(step * 0x9E3779B97F4A7C15 % 2**64)))
            while len(many):
                on = u >= self.cum[edge[many]]
                many, u = many[on], u[on]
                edge[many] += 1
            steps.append((live, edge))
            count[live] += 1
            at = self.next[edge]
            go = ~self.is_end[at]
            live, at, step = live[go], at[go], step + 1
        begin = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(begin[-1], np.int64)
        for s, (who, edge) in enumerate(steps):
            out[begin[who] + s] = edge
        return out, count

    def leave(self, edges: np.ndarray, begin: np.ndarray, count: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For walks edges[begin : begin + count], a drawn place to leave each and another edge there: heads up to that edge, one
        after another, and their lengths."""
        lp = self.logp[edges[_spread(begin, count)]]
        ends = np.cumsum(count)
        who = np.repeat(np.arange(len(count)), count)
        before = np.cumsum(lp) - lp
        before -= before[ends - count][who]
        mass = np.exp(before) * -np.expm1(np.minimum(lp, 0.0))
        run = np.cumsum(mass)
        low = (run - mass)[ends - count]
        u = bt.unit(bt.mix(key))
        passed = run - low[who] <= (u * (run[ends - 1] - low))[who]
        step = np.minimum(np.bincount(who, weights=passed, minlength=len(count)).astype(np.int64), count - 1)
        # the last place with other edges, should rounding lead beyond it
        at = ends - count + step
        while (bad := mass[at] <= 0).any():
            at[bad] -= 1
            step[bad] -= 1
        old = edges[begin + step]
        node = np.searchsorted(self.first, old, "right") - 1
        p = np.exp(self.logp[old])
        u = bt.unit(bt.mix(key ^ bt.U(0x5DEECE66D))) * -np.expm1(np.minimum(self.logp[old], 0.0))
        skip = np.where(old > self.first[node], self.cum[np.maximum(old - 1, 0)], 0.0)
        u = np.where(u >= skip, u + p, u)
        new, last = self.first[node].copy(), self.first[node + 1] - 1
        last = np.where(last == old, last - 1, last)
        while len(on := np.flatnonzero((new < last) & ((u >= self.cum[new]) | (new == old)))):
            new[on] += 1
        size = step + 1
        head = edges[_spread(begin, size)]
        head[np.cumsum(size) - 1] = new
        return head, size

    def others(self, node: int, shut: list[tuple]) -> float:
        """Mass of the segmentations from ``node`` on that aren't in ``shut`` (edge sequences), summed without cancellation."""
        if self.is_end[node]:
            return 0.0
        mass = 0.0
        for e in range(self.first[node], self.first[node + 1]):
            under = [x[1:] for x in shut if x[0] == e]
            mass += float(np.exp(self.logp[e])) * (self.others(int(self.next[e]), under) if under else 1.0)
        return mass

    def another(self, node: int, shut: list[tuple], key: int) -> list[int]:
        """A drawn segmentation from ``node`` on that isn't in ``shut``, or as far as it is told apart from all of it."""
        out, step = [], 0
        while shut:
            edges, masses = [], []
            for e in range(self.first[node], self.first[node + 1]):
                under = [x[1:] for x in shut if x[0] == e]
                edges.append(e)
                masses.append(float(np.exp(self.logp[e])) * (self.others(int(self.next[e]), under) if under else 1.0))
            u = float(bt.unit(bt.mix(np.array([key + step], np.uint64)))[0]) * sum(masses)
            i = 0
            while u >= masses[i] and i + 1 < len(edges) and any(masses[i + 1 :]):
                u -= masses[i]
                i += 1
            out.append(edges[i])
            shut = [x[1:] for x in shut if x[0] == edges[i]]
            node, step = int(self.next[edges[i]]), step + 1
        return out


def _spread(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its size."""
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def sample(lat: Lattice, units: np.ndarray, doc: np.ndarray, keys: np.ndarray, k: int) -> list[dict]:
    """``units``: start nodes of all units, ``doc``: their rows. A dict a sample: edges, count (of edges by unit), log_prob,
    value (perturbed) and there, by row; then one with the (k+1)-th value, ``bar``.

    A decision is a whole unit: beside the segmentation drawn, all its others together hold one Gumbel value.
    """
    n = len(keys)
    at_unit = bt.runs(doc, n)
    place = (np.arange(len(units)) - at_unit[doc]).astype(np.uint64)

    def gumbels(phi, cap, h):
        return -np.logaddexp(-cap, np.log(-np.log(bt.unit(h))) - phi)

    def by_unit(values, count):
        total = np.concatenate([[0.0], np.cumsum(values)])
        ends = np.cumsum(count)
        return total[ends] - total[ends - count]

    def finish(edges, count, value, there, begin, salt):
        lp = by_unit(lat.logp[edges], count)
        before = np.cumsum(lp) - lp
        before -= before[at_unit[doc]] if len(doc) else 0.0
        with np.errstate(divide="ignore"):
            phi = before + np.log(np.maximum(-np.expm1(np.minimum(lp, 0.0)), 0.0))
        g = np.full(len(units), -np.inf)
        ok = np.isfinite(phi) & (place.astype(np.int64) >= begin[doc])
        g[ok] = gumbels(phi[ok], value[doc[ok]], bt.mix(keys[doc[ok]] + bt.mix(place[ok] * bt.U(977) + bt.U(salt))))
        return {"edges": edges, "count": count, "log_prob": np.bincount(doc, weights=lp, minlength=n), "value": value, "there": there, "g": g, "lp": lp, "before": before, "ends": np.cumsum(count)}

    root = -np.log(-np.log(bt.unit(bt.mix(keys ^ bt.U(0x1234567)))))
    edges, count = lat.walk(units, bt.mix(keys[doc] + bt.mix(place * bt.U(31) + bt.U(1))))
    out = [finish(edges, count, root, np.ones(n, bool), np.zeros(n, np.int64), 1)]
    barred: dict[tuple[int, int], list[tuple]] = {}
    full = np.flatnonzero(np.diff(at_unit) > 0)
    for m in range(1, k + 1):
        best, path = np.full(n, -np.inf), np.zeros(n, np.int64)
        for q, x in enumerate(out):
            top = np.full(n, -np.inf)
            if len(full):
                top[full] = np.maximum.reduceat(x["g"], at_unit[full])
            path[top > best] = q
            best = np.maximum(best, top)
        there = np.isfinite(best)
        if m == k:
            out.append({"bar": best})
            break
        begin = np.full(n, 1 << 60)
        source = np.zeros(len(units), np.int64)
        spots, sizes_, flats, fresh_at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for q, x in enumerate(out):
            mine = there & (path == q)
            if not mine.any():
                continue
            hit = np.flatnonzero(mine[doc] & (x["g"] == best[doc]))
            hit = hit[np.unique(doc[hit], return_index=True)[1]]
            begin[doc[hit]] = hit - at_unit[doc[hit]] + 1
            source[mine[doc]] = q
            salt = keys[doc[hit]] + (hit - at_unit[doc[hit]]).astype(np.uint64) * bt.U(8191) + bt.U(m * 0x51ED2701)
            again = np.array([(q, u) in barred for u in hit.tolist()], bool)
            for u, key in zip(hit[again].tolist(), salt[again].tolist()):
                head = lat.another(int(units[u]), barred[q, u], key % 2**63)
                spots.append(np.array([u])), sizes_.append(np.array([len(head)])), flats.append(np.array(head))
            hit, salt = hit[~again], salt[~again]
            if len(hit):
                head, size = lat.leave(x["edges"], x["ends"][hit] - x["count"][hit], x["count"][hit], salt)
                spots.append(hit), sizes_.append(size), flats.append(head)
                fresh_at.append((q, hit))
        spot, hsize = np.concatenate(spots), np.concatenate(sizes_)
        hflat, hend = np.concatenate(flats), np.cumsum(hsize)
        walk_from = there[doc] & (place.astype(np.int64) >= begin[doc] - 1)
        new = np.flatnonzero(walk_from)
        nodes = units[new].copy()
        extra = np.zeros(len(units), np.int64)
        extra[spot] = hsize
        nodes[np.searchsorted(new, spot)] = lat.next[hflat[hend - 1]]
        e2, c2 = lat.walk(nodes, bt.mix(keys[doc[new]] + bt.mix(place[new] * bt.U(31) + bt.U(m * 1_000_003 + 1))))
        count = np.zeros(len(units), np.int64)
        old = there[doc] & ~walk_from
        for q, x in enumerate(out):
            pick = old & (source == q)
            count[pick] = x["count"][pick]
        count[new] = c2 + extra[new]
        ends = np.cumsum(count)
        edges = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for q, x in enumerate(out):
            pick = np.flatnonzero(old & (source == q))
            sizes = x["count"][pick]
            edges[_spread(ends[pick] - sizes, sizes)] = x["edges"][_spread(x["ends"][pick] - sizes, sizes)]
        edges[_spread(ends[new] - c2, c2)] = e2
        edges[_spread(ends[spot] - count[spot], hsize)] = hflat
        sampled = finish(edges, count, best, there, begin, m + 1)
        # what of those units is still open on the path that was left
        lp = by_unit(lat.logp[edges], count)
        fresh = set()
        for q, hit in fresh_at:
            x = out[q]
            left = -np.expm1(np.minimum(x["lp"][hit], 0.0)) - np.exp(lp[hit])
            slight = left < 1e-9
            h = bt.mix(keys[doc[hit]] + (hit - at_unit[doc[hit]]).astype(np.uint64) * bt.U(0x2545F491) + bt.U(m))
            x["g"][hit] = np.where(slight, -np.inf, gumbels(x["before"][hit] + np.log(np.where(slight, 1.0, left)), best[doc[hit]], h))
            fresh |= set() if m + 1 < k else {(q, u) for u in hit[~slight].tolist()}
        for u in spot.tolist():
            q, r = int(source[u]), int(doc[u])
            if (q, u) in fresh:
                continue
            x = out[q]
            shut = barred.setdefault((q, u), [tuple(x["edges"][x["ends"][u] - x["count"][u] : x["ends"][u]].tolist())])
            shut.append(tuple(edges[ends[u] - count[u] : ends[u]].tolist()))
            left = lat.others(int(units[u]), shut)
            h = bt.mix(np.array([(int(keys[r]) + (u - int(at_unit[r])) * 0x2545F491 + m) % 2**64], np.uint64))
            x["g"][u] = gumbels(np.array([x["before"][u] + np.log(left)]), best[r : r + 1], h)[0] if left > 0 else -np.inf
        out.append(sampled)
    return out


def units_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with a blank put before each non-empty row, and start, end and row of the units."""
    size = np.diff(off)
    rows = np.flatnonzero(size)
    data = np.insert(data, off[rows], 32)
    begin = off[rows] + np.arange(len(rows))
    blank = data == 32
    first = np.zeros(len(data), bool)
    first[1:] = blank[1:] & ~blank[:-1]
    first[begin] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(data))[: len(starts)]
    return data, starts, ends, rows[np.searchsorted(begin, starts, "right") - 1] if len(rows) else starts


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 2, alpha: float = 1.0, seed: int = 5, model: str | None = None, ids: bool = True) -> DataFrame:
    """Rows (id, n_units, then for each sample i: n_pieces_i, log_prob_i, log_inclusion_i and ids_i), one for each input row.

    ``ids=False`` gives digest_i, a 64-bit hash of the ids in order, in place of ids_i.
    """
    spark = docs.sparkSession
    ship(spark)
    vocabulary = spark.sparkContext.broadcast(load(model))  # as large as the vocabulary file

    def work(batches):
        lat = Lattice(Vocabulary(vocabulary.value, alpha))
        for b in batches:
            for i, j, data, off in bt.slices(b.column(2), SLICE):
                data, starts, ends, row = units_of(data, off)
                units = lat.units(bt.hashes(data, starts, ends), data, starts, ends)
                keys = np.asarray(b.column(1).slice(i, j - i)).view(np.uint64)
                *samples, last = sample(lat, units, row, keys, k)
                cols = [b.column(0).slice(i, j - i), pa.array(np.bincount(row, minlength=j - i))]
                for s in samples:
                    x = np.minimum(s["log_prob"] - last["bar"], 700)
                    with np.errstate(divide="ignore", over="ignore"):
                        inc = np.where(x < -30, x, np.log(-np.expm1(-np.exp(x))))
                    inc = np.where(np.isfinite(last["bar"]), np.minimum(inc, 0.0), 0.0)
                    no = ~s["there"]
                    pieces = np.bincount(row, weights=s["count"], minlength=j - i).astype(np.int64)
                    at = np.concatenate([[0], np.cumsum(pieces)])
                    flat = lat.id[s["edges"]]
                    cols += [pa.array(pieces, mask=no), pa.array(s["log_prob"], mask=no), pa.array(inc, mask=no)]
                    if ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32), mask=np.append(no, False)), pa.array(flat)))
                    else:
                        own = np.repeat(np.arange(j - i), pieces)
                        term = bt.mix(flat.astype(np.uint64) * bt.U(0x9E3779B97F4A7C15) + (np.arange(len(flat)) - at[own]).astype(np.uint64))
                        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(term)])
                        cols.append(pa.array((total[at[1:]] - total[at[:-1]]).view(np.int64), mask=no))
                yield pa.RecordBatch.from_arrays(cols, names=[f"c{x}" for x in range(len(cols))])

    kind = dict(docs.dtypes)[doc_id]
    tail = ", ".join(f"n_pieces_{i} bigint, log_prob_{i} double, log_inclusion_{i} double, " + (f"ids_{i} array<int>" if ids else f"digest_{i} bigint") for i in range(1, k + 1))
    out = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.lit(seed), doc_id).alias("key"), F.col(text).alias("text")).mapInArrow(work, f"id {kind}, n_units bigint, {tail}")
    return out.withColumnRenamed("id", doc_id)


def decode(rows: DataFrame, ids: str, model: str | None = None, out: str = "text") -> DataFrame:
    """``rows`` with the texts of its id arrays in column ``out``; null ids give null."""
    spark = rows.sparkSession
    ship(spark)
    v = load(model)
    table = {i: p.encode() for p, (i, _) in v["pieces"].items()} | {i: bytes([b]) for b, i in enumerate(v["bytes"])}
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("string")
    def text_of(x):
        t = shared.value
        return x.map(lambda a: None if a is None else b"".join(t[i] for i in a)[1:].decode())

    return rows.withColumn(out, text_of(F.col(ids)))
