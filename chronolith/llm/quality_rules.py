"""Quality rules by distribution divergence.

Each document's histograms of character classes and of its language's common words are compared with
references by Jensen-Shannon distance. A reference is the mean histogram of all documents of the language
(so it covers all data, and one very long document weighs no more than another). Fixed word lists say
which words are common; guards keep short texts from being judged by histograms too small to tell.
A distance is too large beyond a fence drawn from the quartiles of the distances of all judged documents of the
language, so it follows how far good texts of the language lie from their mean.

Null and empty texts have no words: all counts are 0 and the base rule fails them. A null or unlisted
language is judged by the reference of all documents together and only by character classes.
Repeated rows are judged each by itself. Other columns of the input are neither read nor returned. An empty
table gives no rows; very long texts count whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .common import ship

#: Function words that are common in each language, in lower case.
COMMON = {
    "de": "als auf aus bei das dem den der des die ein eine einer er es für ich im in ist mit nicht sich sie und von war wie zu".split(),
    "en": "a and are as at be but by for from had he his i in is it not of on or that the this to was were which with you".split(),
    "es": "al como con de del el en es fue ha la las lo los más no para pero por que se sin su sus un una y".split(),
    "fr": "au avec ce dans de des du elle en est et il je la le les mais ne pas plus pour qui sa se sur un une".split(),
}
#: The symbols that the base rule counts.
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other_ascii", "beyond_ascii")
N_WORDS = max(map(len, COMMON.values())) + 1
#: Steps of a distance from 0 to 1 when documents are counted by distance, and documents that make a fence of a language's own.
BINS, FEWEST = 2000, 100

_CLASS = np.full(256, 6)
_CLASS[[*range(97, 123)]] = 0
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(48, 58)]] = 2
_CLASS[bt.SPACE] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 4
_CLASS[[ord(c) for c in SYMBOLS]] = 5
_CLASS[192:] = 7
_CLASS[128:192] = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    h = bt.hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends, lower=True)
    order = np.argsort(h)
    return h[order], order


def _histograms(data, off, langs: list) -> tuple[np.ndarray, np.ndarray]:
    """Counts by class, and by common word of the row's own language with all others last."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    chars = np.bincount(row * 9 + _CLASS[data], minlength=n * 9).reshape(n, 9)[:, :8]
    starts, ends, doc = bt.spans(data, off, bt.NOT_ALNUM)
    h = bt.hashes(data, starts, ends, lower=True)
    words = np.zeros((n, N_WORDS), np.int64)
    of_row = np.array([x if x in COMMON else "" for x in langs], dtype=object)
    for lang, listed in COMMON.items():
        mine = np.flatnonzero((of_row == lang)[doc]) if len(doc) else doc
        if len(mine):
            known, slot = _of(listed)
            at = np.minimum(np.searchsorted(known, h[mine]), len(known) - 1)
            col = np.where(known[at] == h[mine], slot[at], N_WORDS - 1)
            words += np.bincount(doc[mine] * N_WORDS + col, minlength=n * N_WORDS).reshape(n, N_WORDS)
    return chars, words


def _base(data, off) -> dict[str, np.ndarray]:
    n = len(off) - 1
    starts, ends, doc = bt.spans(data, off)
    count = lambda d, w=None: np.bincount(d, weights=w, minlength=n).astype(np.int64)
    out = {"n_words": count(doc)}
    row = np.repeat(np.arange(n), np.diff(off))
    out["word_chars"] = count(row, (bt.LEADS & ~bt.SPACE)[data].astype(float))
    out["n_symbols"] = count(row, _SYMBOL[data].astype(float))
    h = bt.hashes(data, starts, ends)
    # words in 5-word windows that the text has twice or more
    g, whole = bt.grams(h, doc, 5)
    covered = np.zeros(len(doc) + 1, np.int64)
    at = np.flatnonzero(whole)
    if len(at):
        key = bt.mix(g[at] ^ bt.mix(doc[at].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + 5, -1)
    out["n_repeat_words"] = count(doc[np.cumsum(covered)[:-1] > 0])
    # lines with a word that equal an earlier line of the text
    ls, le, ld = bt.spans(data, off, bt.NEWLINE)
    has = np.searchsorted(starts, le) > np.searchsorted(starts, ls) if len(ls) else np.zeros(0, bool)
    ls, le, ld = ls[has], le[has], ld[has]
    key = bt.mix(bt.hashes(data, ls, le) ^ bt.mix(ld.astype(np.uint64)))
    _, firsts = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[firsts] = False
    out["n_dup_lines"] = count(ld[again])
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence in bits, row by row; rows that sum to 0 are at distance 0."""
    sums = p.sum(1, keepdims=True)
    p = p / np.where(sums, sums, 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda x: np.where(x > 0, x * np.log2(x / m), 0).sum(1)
        return np.where(sums[:, 0] > 0, np.sqrt(np.maximum((kl(p) + kl(q)) / 2, 0)), 0.0)


def references(docs: DataFrame, text: str = "text", lang: str = "lang", min_chars: int = 200, min_words: int = 50) -> dict[str, tuple[list, list]]:
    """Mean histograms by listed language ("" for all documents) over every document that the guards let be judged."""
    ship(docs.sparkSession)
    width = len(CLASSES) + N_WORDS + 2

    def partial(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for i, j, data, off in bt.slices(b.column(0)):
                langs = b.column(1).slice(i, j - i).to_pylist()
                chars, words = _histograms(data, off, langs)
                nc, nw = chars.sum(1), words.sum(1)
                c = np.where((nc >= min_chars)[:, None], chars / np.maximum(nc, 1)[:, None], 0)
                w = np.where((nw >= min_words)[:, None], words / np.maximum(nw, 1)[:, None], 0)
                full = np.hstack([c, w, (nc >= min_chars)[:, None], (nw >= min_words)[:, None]]).astype(float)
                for lang_ in {x if x in COMMON else "" for x in langs}:
                    pick = [k for k, x in enumerate(langs) if (x if x in COMMON else "") == lang_]
                    total[lang_] = total.get(lang_, np.zeros(width)) + full[pick].sum(0)
        if total:
            rows = [(k, i, v) for k, x in total.items() for i, v in enumerate(x)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.float64())], names=["lang", "i", "v"])

    parts = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(partial, "lang string, i int, v double")
    sums: dict[str, np.ndarray] = {}
    # as many rows as languages times slots, whatever the input; sums in decimals don't depend on the order
    for r in parts.groupBy("lang", "i").agg(F.sum(F.col("v").cast("decimal(38,12)")).cast("double").alias("v")).collect():
        sums.setdefault(r["lang"], np.zeros(width))[r["i"]] = r["v"]
    every = sum(sums.values(), np.zeros(width))
    out = {}
    for k in {*sums, ""}:
        x = every if k == "" else sums[k]
        out[k] = ((x[:8] / max(x[-2], 1)).tolist(), (x[8:-2] / max(x[-1], 1)).tolist())
    return out


def _distances(data, off, langs: list, refs: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both distances of each row, and its numbers of characters and words."""
    chars, words = _histograms(data, off, langs)
    keys = [x if x in refs else "" for x in langs]
    dc = js_distance(chars, np.array([refs[k][0] for k in keys]))
    dw = js_distance(words, np.array([refs[k][1] for k in keys]))
    return dc, np.where([x in COMMON for x in langs], dw, 0.0), chars.sum(1), words.sum(1)


def _fence(counts: np.ndarray, ranges: float, most: float) -> float:
    """Upper quartile plus ``ranges`` times the quartiles' range of distances counted by step, at most ``most``."""
    low, high = ((np.searchsorted(np.cumsum(counts), x * counts.sum()) + 1) / BINS for x in (0.25, 0.75))
    return min(most, float(high + ranges * (high - low)))


def fences(docs: DataFrame, refs: dict, class_ranges: float, word_ranges: float, max_class: float, max_word: float, text: str = "text", lang: str = "lang", min_chars: int = 200, min_words: int = 50) -> dict[str, tuple[float, float]]:
    """Largest distances by listed language over every judged document; those of all documents ("") where a language has few."""
    ship(docs.sparkSession)

    def partial(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for i, j, data, off in bt.slices(b.column(0)):
                langs = [x if x in COMMON else "" for x in b.column(1).slice(i, j - i).to_pylist()]
                dc, dw, nc, nw = _distances(data, off, langs, refs)
                own = np.array(langs, dtype=object)
                for k in set(langs):
                    mine = own == k
                    at = [np.minimum(d[mine & ok] * BINS, BINS - 1).astype(int) for d, ok in ((dc, nc >= min_chars), (dw, (nw >= min_words) & (k != "")))]
                    total[k] = total.get(k, 0) + np.stack([np.bincount(x, minlength=BINS) for x in at])
        rows = [(k, int(i), int(x.reshape(-1)[i])) for k, x in total.items() for i in np.flatnonzero(x)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "i", "n"])

    parts = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(partial, "lang string, i int, n bigint")
    counts: dict[str, np.ndarray] = {k: np.zeros((2, BINS)) for k in COMMON}
    every = np.zeros((2, BINS))
    # as many rows as languages times steps, whatever the input
    for r in parts.groupBy("lang", "i").agg(F.sum("n").alias("n")).collect():
        every.reshape(-1)[r["i"]] += r["n"]
        if r["lang"] in counts:
            counts[r["lang"]].reshape(-1)[r["i"]] = r["n"]
    limits = ((class_ranges, max_class), (word_ranges, max_word))

    def one(x: np.ndarray, k: int) -> float:
        full = next((y[k] for y in (x, every) if y[k].sum() >= FEWEST), None)
        return _fence(full, *limits[k]) if full is not None else limits[k][1]

    return {k: (one(x, 0), one(x, 1)) for k, x in {**counts, "": every}.items()}


def assess(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_class_distance: float = 0.26,
    max_word_distance: float = 0.5,
    min_chars: int = 200,
    min_words: int = 50,
    class_ranges: float = 4.0,
    word_ranges: float = 1.0,
) -> DataFrame:
    """Rows (id, base counts, base_failed, class_distance, word_distance, kept), one for each input row.

    A distance is judged only from ``min_chars`` characters or ``min_words`` alphanumeric words on. ``class_ranges``
    and ``word_ranges``: how many quartile ranges above the upper quartile a language's fence stands, at most at
    ``max_class_distance`` and ``max_word_distance``, which hold alone while under FEWEST documents are judged.
    """
    ship(docs.sparkSession)
    refs = references(docs, text, lang, min_chars, min_words)
    most = fences(docs, refs, class_ranges, word_ranges, max_class_distance, max_word_distance, text, lang, min_chars, min_words)

    def score(batches):
        for b in batches:
            for i, j, data, off in bt.slices(b.column(1)):
                langs = b.column(2).slice(i, j - i).to_pylist()
                base = _base(data, off)
                dc, dw, nc, nw = _distances(data, off, langs, refs)
                top = np.array([most[x if x in COMMON else ""] for x in langs]).reshape(-1, 2)
                failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
                bad = (nc >= min_chars) & (dc > top[:, 0]) | (nw >= min_words) & (dw > top[:, 1])
                cols = [b.column(0).slice(i, j - i), *(pa.array(base[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), pa.array(failed), pa.array(dc), pa.array(dw), pa.array(~failed & ~bad)]
                yield pa.RecordBatch.from_arrays(cols, names=[f"c{k}" for k in range(10)])

    kind = dict(docs.dtypes)[doc_id]
    out = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(
        score, f"id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, class_distance double, word_distance double, kept boolean"
    )
    return out.withColumnRenamed("id", doc_id)
