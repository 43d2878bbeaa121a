"""Passages that repeat across documents, removed after their first document, by repeated-phrase automata.

A window is ``width`` consecutive words of one document. Every window picks an anchor, the smallest hashed
gram of ``GRAM`` words in it; equal windows pick equal anchors, and anchors are a quarter as many as words.

1. Count every anchor's documents; those with two or more are the only places where windows can recur.
2. Around each occurrence of such an anchor, cut out the segment of words whose windows picked it, and
   route it by anchor to a shard. (A window under an anchor with over ``HOT`` occurrences goes alone, by its
   own words, so that a frequent line before ever different text doesn't fill one shard.)
3. Equal segments are folded before they travel. A shard confirms the windows that two documents or more
   have, compiles them into an Aho-Corasick automaton over words (piece after piece of bounded size), and
   streams its segments through: each occurrence comes out with the first document that has it.
4. Occurrences later than their first document mark the words of their document.

Words are compared whole in the automata. A hash of an anchor only routes; what is found for a segment goes back
to its copies under two 64-bit hashes of its bytes. Null, empty and short texts have no
window and lose nothing. Rows of one id count as one document, and rows with a null id are left as they are.
An empty table gives no rows; other columns are carried along if asked for (``keep``), whatever their names.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .common import cut, cut_packed, drop, release, ship

GRAM = 7
HOT = 1000
#: Segments that one automaton is compiled from, at most (and at least one anchor's).
PIECE = 20_000


def anchors(data: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, first and last window (word number within the row) of every anchor occurrence."""
    s, e, doc = bt.spans(data, off)
    h = bt.hashes(data, s, e)
    n = len(h) - width + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, z
    g, _ = bt.grams(h, doc, GRAM)
    best, pos = g[:n].copy(), np.arange(n)
    for j in range(1, width - GRAM + 1):
        less = g[j : j + n] < best
        best[less] = g[j : j + n][less]
        pos[less] = np.flatnonzero(less) + j
    ok = doc[:n] == doc[width - 1 : width - 1 + n]
    at = np.flatnonzero(ok)
    if not len(at):
        return at.astype(np.uint64), at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (pos[at][1:] != pos[at][:-1]) | (doc[at][1:] != doc[at][:-1])
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
    base = bt.runs(doc, len(off) - 1)[doc[first]]
    return best[first], doc[first], first - base, last - base


def _occurrences(docs: DataFrame, width: int, places: bool) -> DataFrame:
    def work(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1)):
                h, row, a, z = anchors(data, off, width)
                out = [pa.array(h.view(np.int64)), b.column(0).slice(i, j - i).take(pa.array(row))]
                if places:
                    out.append(pa.array(a * 256 + (z - a)))
                yield pa.RecordBatch.from_arrays(out, names=["h", "id", "place"][: len(out)])

    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(work, f"h bigint, id {kind}" + ", place bigint" * places)


def _segments(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Rows (key, seg, id, at): the words around recurring anchors; at: number of the segment's first word."""
    def work(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1), bt.LIMIT // 2):
                s, e, doc = bt.spans(data, off)
                base = bt.runs(doc, j - i)
                raw = data.tobytes()
                marks = b.column(2).slice(i, j - i)
                owner = np.repeat(np.arange(j - i), pc_lengths(marks))
                flat = marks.flatten()
                h, place, hot = (np.asarray(flat.field(k)) for k in range(3))
                a = place // 256
                z = a + place % 256
                ok = z + width <= (base[owner + 1] - base[owner])
                key, seg, at, who = [], [], [], []
                lo, hi, own = s[base[owner[ok]] + a[ok]], e[base[owner[ok]] + z[ok] + width - 1], owner[ok]
                hot, h, a, z = hot[ok], h[ok], a[ok], z[ok]
                for x in np.flatnonzero(~hot):
                    seg.append(raw[lo[x] : hi[x]])
                key.extend(h[~hot])
                at.extend(a[~hot])
                who.extend(own[~hot])
                for x in np.flatnonzero(hot):
                    first = base[own[x]]
                    for w in range(a[x], z[x] + 1):
                        piece = b" ".join(raw[s[first + w] : e[first + w + width - 1]].split())
                        seg.append(piece)
                        key.append(int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True))
                        at.append(w)
                        who.append(own[x])
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(seg, pa.binary()), b.column(0).slice(i, j - i).take(pa.array(who, pa.int64())), pa.array(at, pa.int32())], names=["key", "seg", "id", "at"])

    def pc_lengths(lists):
        return np.diff(np.asarray(lists.offsets))

    kind = dict(docs.dtypes)["id"]
    return docs.join(wanted.hint("shuffle_hash"), "id").select("id", "text", "marks").mapInArrow(work, f"key bigint, seg binary, id {kind}, at int")


class Piece:
    """Distinct segments of whole anchors, as one string of word codes, each segment ended by a code that no word has."""

    def __init__(self, segs: pa.Array, width: int):
        off = np.frombuffer(segs.buffers()[1], np.int32)[segs.offset : segs.offset + len(segs) + 1].astype(np.int64)
        data = np.frombuffer(segs.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
        s, e, self.seg = bt.spans(data, off - off[0])
        code = _codes(data, s, e)
        count = np.bincount(self.seg, minlength=len(segs))
        #: the place of each segment's first code, and of its end
        self.begin = np.concatenate([[0], np.cumsum(count + 1)])
        self.line = np.ones(int(self.begin[-1]), np.uint32)
        at = np.arange(len(code)) + self.seg
        # word codes from 2 on, without the surrogates
        code = code + 2
        self.line[at] = np.where(code < 0xD800, code, code + 0x800)
        self.text = self.line.tobytes().decode("utf-32-le")
        self.start = np.flatnonzero((count >= width)[self.seg] & (at + width <= self.begin[self.seg + 1] - 1))
        self.owner, self.start = self.seg[self.start], at[self.start]


def _codes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A number for each word, the same for equal words only: by hash, then byte by byte."""
    h = bt.hashes(data, s, e)
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    mine, its = e - s, (e - s)[first][code]
    same = mine == its
    size = np.where(same, mine, 0)
    spread = np.repeat(np.arange(len(s)), size)
    step = np.arange(len(spread)) - np.repeat(np.cumsum(size) - size, size)
    differs = data[s[spread] + step] != data[s[first][code][spread] + step]
    same[spread[differs]] = False
    if not same.all():  # two words of one hash: number these words by themselves
        extra: dict[bytes, int] = {}
        for i in np.flatnonzero(~same):
            code[i] = len(first) + extra.setdefault(data[s[i] : e[i]].tobytes(), len(extra))
    return code


def _locate(segs: pa.Array, lo: np.ndarray, hi: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments, word places in them, and first documents: every window that an earlier document has, by one automaton.

    ``lo``, ``hi``: lowest and highest id that has each segment. Windows that two documents have are confirmed;
    neighbours in a segment that have the same first document are chained into a passage; the automaton of the
    distinct passages is then run over the whole piece, so each occurrence of a passage is found, in whatever
    segment, together with the first document of its windows.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), lo[:0]
    p = Piece(segs, width)
    if not len(p.start):
        return none
    words = np.lib.stride_tricks.sliding_window_view(p.line, width)
    g, _ = bt.grams(bt.mix(p.line.astype(np.uint64)), np.zeros(len(p.line), np.int64), width)
    _, first, which = np.unique(g[p.start], return_index=True, return_inverse=True)
    if (words[p.start] != words[p.start[first]][which]).any():  # two windows of one hash
        _, which = np.unique(words[p.start], axis=0, return_inverse=True)
    order = np.argsort(which, kind="stable")
    cuts = np.flatnonzero(np.diff(which[order], prepend=-1))
    least, most = np.minimum.reduceat(lo[p.owner][order], cuts)[which], np.maximum.reduceat(hi[p.owner][order], cuts)[which]
    recurs = least < most
    start, owner, least = p.start[recurs], p.owner[recurs], least[recurs]
    if not len(start):
        return none
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 1) | (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])
    a, z = start[new], start[np.append(np.flatnonzero(new)[1:], len(start)) - 1] + width
    passages = dict(zip(map(p.text.__getitem__, map(slice, a.tolist(), z.tolist())), least[new].tolist()))
    machine = ahocorasick.Automaton()
    for words, value in passages.items():
        machine.add_word(words, (len(words), value))
    machine.make_automaton()
    found = [(end, size, value) for end, (size, value) in machine.iter(p.text)]
    end, size, value = np.array([x[0] for x in found]), np.array([x[1] for x in found]), np.array([x[2] for x in found], lo.dtype)
    # the windows of each passage found
    n = size - width + 1
    at = np.repeat(end - size + 1, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    value, seg = np.repeat(value, n), np.searchsorted(p.begin, at, "right") - 1
    keep = value < hi[seg]
    at, seg, value = at[keep], seg[keep], value[keep]
    _, once = np.unique(at, return_index=True)  # a window found in several passages has one first document
    return seg[once], at[once] - p.begin[seg[once]], value[once]


def _pieces(key: np.ndarray, limit: int | None = None) -> list[tuple[int, int]]:
    """Stretches of about ``limit`` rows that end where the key changes."""
    n = len(key)
    change = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, n)
    out, a = [], 0
    while a < n:
        z = int(change[min(np.searchsorted(change, a + (limit or PIECE)), len(change) - 1)])
        out.append((a, z))
        a = z
    return out


def repeated_windows(docs: DataFrame, width: int = 13) -> DataFrame:
    """From columns id, text: rows (id, starts), the windows of a document that a smaller id has too."""
    spark = docs.sparkSession
    ship(spark)
    kind = dict(docs.dtypes)["id"]
    arrow_kind = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    docs = docs.where("id IS NOT NULL")
    seen = _occurrences(docs, width, False).groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n"))
    recurring = cut(seen.where("lo < hi").select("h", (F.col("n") > HOT).alias("hot")))
    release(spark)
    marks = _occurrences(docs, width, True).join(recurring, "h").groupBy("id").agg(F.collect_set(F.struct("h", "place", "hot")).alias("marks"))
    marks, marks_path = cut_packed(marks)
    release(spark)
    segments, path = cut_packed(_segments(docs, marks, width))
    drop(spark, marks_path)
    del seen, recurring, marks  # and their files with them
    release(spark)
    folded = segments.groupBy("key", "seg").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))

    def compile_and_stream(batches):
        def out(rows):
            seg, place, first = _locate(rows.column(1).combine_chunks(), *(rows.column(k).to_numpy() for k in (2, 3)), width)
            own, count = np.unique(seg, return_counts=True)
            at = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(at, pa.array(place.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(first, arrow_kind))
            return pa.RecordBatch.from_arrays([rows.column(1).combine_chunks().take(pa.array(own)), *lists], names=["seg", "places", "firsts"])

        held, n = [], 0
        for b in batches:
            # whole anchors only: what follows the last change of the key waits for the next batch
            held.append(b)
            n += len(b)
            if n < PIECE:
                continue
            rows = pa.Table.from_batches(held)
            key = rows.column(0).to_numpy()
            last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            for a, z in _pieces(key[:last]):
                yield out(rows.slice(a, z - a))
            held, n = rows.slice(last).to_batches(), len(rows) - last
        if n:
            rows = pa.Table.from_batches(held)
            for a, z in _pieces(rows.column(0).to_numpy()):
                yield out(rows.slice(a, z - a))

    shards = folded.repartition("key").sortWithinPartitions("key").select("key", "seg", "lo", "hi")
    found = shards.mapInArrow(compile_and_stream, f"seg binary, places array<int>, firsts array<{kind}>")
    # a segment names its anchor, so two hashes of it stand for key and words
    names = [F.xxhash64("seg").alias("sh"), F.xxhash64(F.lit(1), "seg").alias("sh2")]
    found = found.select(*names, F.arrays_zip("places", "firsts").alias("hits"))
    rows = segments.select(*names, "id", "at").join(found, ["sh", "sh2"])
    later = rows.select("id", F.transform(F.filter("hits", lambda x: x["firsts"] < F.col("id")), lambda x: x["places"] + F.col("at")).alias("s")).where(F.size("s") > 0)
    out = cut(later.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("s"))).alias("starts")))
    drop(spark, path)
    return out


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 13, keep: list[str] | None = None, digest: bool = False) -> DataFrame:
    """Columns ``keep`` (the id by default), n_words, n_removed and kept_text, one row for each input row.

    kept_text: the text as it was if nothing is removed, else the words left, joined by one space.
    ``digest``: instead kept_sha256, of the words left joined by one space, in every case.
    """
    keep = keep or [doc_id]
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    starts = repeated_windows(d, width)
    release(docs.sparkSession)
    names = [f"c{i}" for i in range(len(keep))]
    name, kind = ("kept_sha256", "string") if digest else ("kept_text", "string")
    d = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *(F.col(c).alias(n) for c, n in zip(keep, names)))
    kinds = ", ".join(f"{n} {t}" for n, t in d.dtypes[2:])

    def work(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(0)):
                texts = b.column(0).slice(i, j - i)
                counts, removed, out = [], [], []
                for k, found in enumerate(b.column(1).slice(i, j - i).to_pylist()):
                    raw = data[off[k] : off[k + 1]].tobytes()
                    words = raw.split()
                    n = len(words)
                    if found:
                        at = np.array(found)
                        at = at[at + width <= n]
                        cover = np.zeros(n + 1, np.int64)
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + width, -1)
                        words = [words[x] for x in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
                    counts.append(n)
                    removed.append(n - len(words))
                    if digest:
                        out.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    else:
                        out.append(b" ".join(words).decode() if removed[-1] else texts[k].as_py())
                yield pa.RecordBatch.from_arrays([*(b.column(2 + k).slice(i, j - i) for k in range(len(names))), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())], names=[*names, "n_words", "n_removed", name])

    joined = d.join(starts.hint("shuffle_hash"), "id", "left").select("text", "starts", *names)
    out = joined.mapInArrow(work, f"{kinds}, n_words bigint, n_removed bigint, {name} {kind}")
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), "n_words", "n_removed", name)
