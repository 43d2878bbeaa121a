"""Labels found in free text: whole words, longest match first, narrowed by context; never a guess."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from chronolith.functions import text as tx
from chronolith.operators.enrich import BROADCAST_LABELS, tokens

#: Titles that allow a part of a name.
TITLES = "deputy senator minister taoiseach tanaiste".split()
#: Words that make a mention a set of people.
SET_WORDS = "members deputies senators tds people".split()


def folded_words(x: Column) -> Column:
    """NFC, case folded, split at what is neither letter nor digit."""
    return tokens(tx.nfc_casefold(x))


def detect(
    texts: DataFrame, owners: DataFrame, key: str, text: str, owner: str, label: str,
    text_words: Callable[[Column], Column] = folded_words, label_words: Callable[[Column], Column] = folded_words,
) -> DataFrame:
    """Rows (key, owner, label, at, words): labels whose words stand in the text, without those inside a longer match.

    Texts become word runs of the labels' lengths, so the match is an equi-join of the words that ``text_words`` and
    ``label_words`` make (array<string>). Null texts, null and blank labels match nothing. Owners with equal labels
    all come out.
    """
    named = owners.select(F.col(owner).alias("owner"), F.col(label).alias("label"), label_words(F.col(label)).alias("w")).where("size(w) > 0")
    named = named.select("owner", "label", F.array_join("w", " ").alias("run"), F.size("w").alias("words")).distinct()
    known = named.groupBy("words").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each length of a label
    sizes, count = sorted(r["words"] for r in known), sum(r["n"] for r in known)
    if not sizes:
        return named.select(F.lit(None).cast(dict(texts.dtypes)[key]).alias("key"), "owner", "label", F.lit(0).alias("at"), "words").where("false").withColumnRenamed("key", key)
    t = texts.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), text_words(F.col(text)).alias("t"))

    def runs(n: int) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size("t") - n + 1, F.lit(1)))
        return F.when(F.size("t") >= n, F.transform(at, lambda i: F.struct(i.alias("at"), F.array_join(F.slice("t", i, n), " ").alias("run")))).otherwise(F.array().cast("array<struct<at:int,run:string>>"))

    rows = t.select("key", F.explode(F.concat(*(runs(n) for n in sizes))).alias("x")).select("key", "x.at", "x.run")
    # few labels go to the texts, so that no word run of a text is shuffled; many meet them by hash
    hits = rows.join(F.broadcast(named) if count <= BROADCAST_LABELS else named, "run").select("key", "owner", "label", "at", "words")
    # a match lies inside a longer one if an earlier or equal start reaches at least as far with more words
    end = F.col("at") + F.col("words")
    before = Window.partitionBy("key").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("key", "at")
    hits = hits.withColumn("__reach", F.coalesce(F.max(end).over(before), F.lit(0))).withColumn("__own", F.max(end).over(same))
    return hits.where((F.col("__reach") < end) & (F.col("__own") == end)).select(F.col("key").alias(key), "owner", "label", "at", "words")


def names_a_set(text: Column) -> Column:
    """Whether a mention means everyone of a name ("members named X")."""
    return F.coalesce(F.regexp_like(F.lower(text), F.lit(r"\b(" + "|".join(SET_WORDS) + r")\s+(named|called)\b")), F.lit(False))


def strip_preposition(text: Column) -> Column:
    """A place phrase without its leading preposition; null stays null."""
    return F.regexp_replace(F.trim(text), r"(?i)^(in|for|from|representing)\s+", "")


def committee_core(text: Column) -> Column:
    """A committee's name without its kind: what tells it apart."""
    return F.regexp_replace(F.lower(F.trim(text)), r"^(joint |select )?committee (on|of) (the )?", "")


def by_name(mentions: DataFrame, people: DataFrame, key: str, said: str, owner: str, name: str, serving: Column | None = None) -> DataFrame:
    """Rows (key, status, owner): full names need the same words in the same order; only a titled mention may match
    a part of the words, and then only people for whom ``serving`` holds; one bare word is refused.

    Statuses: resolved, ambiguous, unresolved, refused (one bare word, or nothing). An equi-join on the full name,
    and one on single words for titled mentions; candidates are counted, never gathered.
    """
    m = mentions.select(F.col(key).alias("key"), tokens(tx.nfc_casefold(F.col(said))).alias("w"))
    titled = F.array_contains(F.array(*map(F.lit, TITLES)), F.get("w", F.lit(0)))
    m = m.withColumn("titled", F.coalesce(titled, F.lit(False))).withColumn("w", F.when(F.col("titled"), F.slice("w", 2, 1_000_000)).otherwise(F.col("w")))
    m = m.withColumn("lone", F.coalesce(F.size("w") == 0, F.lit(True)) | (~F.col("titled") & (F.size("w") < 2))).withColumn("run", F.array_join("w", " "))
    p = people.select(F.col(owner).alias("owner"), tokens(tx.nfc_casefold(F.col(name))).alias("n"), (serving if serving is not None else F.lit(True)).alias("ok"))
    whole = m.where("NOT lone").join(p.select("owner", F.array_join("n", " ").alias("run")).distinct(), "run").select("key", "owner")
    word = p.where("ok").select("owner", "n", F.explode(F.array_distinct("n")).alias("word"))
    part = m.where("NOT lone AND titled").withColumn("word", F.get("w", F.size("w") - 1)).join(word, "word")
    part = part.where(F.size(F.array_except("w", "n")) == 0).select("key", "owner")
    n = whole.union(part).groupBy("key").agg(F.countDistinct("owner").alias("n"), F.min("owner").alias("o"))
    out = m.select("key", "lone").join(n, "key", "left")
    status = F.when(F.col("lone"), "refused").when(F.col("n") == 1, "resolved").when(F.col("n") > 1, "ambiguous").otherwise("unresolved")
    return out.select(F.col("key").alias(key), status.alias("status"), F.when(~F.col("lone") & (F.col("n") == 1), F.col("o")).alias(owner))


def narrow(candidates: DataFrame, context: DataFrame, key: str, owner: str, clue: str) -> DataFrame:
    """Rows (key, status, owner): candidates (key, owner) narrowed by (owner, clue) where the mention's own clue
    (a column of ``candidates``, null if it has none) leaves exactly one; a clue never widens."""
    n = candidates.groupBy(key).agg(F.countDistinct(owner).alias("__n"), F.min(owner).alias("__o"))
    fits = candidates.where(F.col(clue).isNotNull()).join(context.select(owner, clue).distinct(), [owner, clue])
    f = fits.groupBy(key).agg(F.countDistinct(owner).alias("__m"), F.min(owner).alias("__p"))
    status = F.when(F.col("__n") == 1, "resolved").when(F.col("__m") == 1, "resolved by context").otherwise("ambiguous")
    return n.join(f, key, "left").select(key, status.alias("status"), F.when(F.col("__n") == 1, F.col("__o")).when(F.col("__m") == 1, F.col("__p")).alias(owner))


def days_said(text: Column) -> Column:
    """The first calendar day written in a text ("4 March 1999", "1999-03-04"); an impossible one is null."""
    words = F.regexp_extract(text, r"\b(\d{1,2}) (January|February|March|April|May|June|July|August|September|October|November|December) (\d{4})\b", 0)
    iso = F.regexp_extract(text, r"\b\d{4}-\d{2}-\d{2}\b", 0)
    return F.coalesce(F.try_to_date(F.nullif(iso, F.lit("")), "yyyy-MM-dd"), F.try_to_date(F.nullif(words, F.lit("")), "d MMMM yyyy"))


def strict_day(text: Column) -> Column:
    """A day only if the whole value is one, with or without midnight UTC; anything else is null."""
    ok = F.regexp_like(text, F.lit(r"^\d{4}-\d{2}-\d{2}(T00:00:00(\.0+)?(Z|\+00:00)?)?$"))
    return F.when(ok, F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def redact(text: Column) -> Column:
    """Credentials out of a line: user information in addresses, bearer tokens, and values of secret-looking keys."""
    x = F.regexp_replace(text, r"(?i)(://)[^/@\s:]+:[^/@\s]+@", "$1***@")
    x = F.regexp_replace(x, r"(?i)\b(bearer)\s+[A-Za-z0-9._~+/=-]+", "$1 ***")
    return F.regexp_replace(x, r"(?i)\b(password|passwd|secret|token|api[_-]?key)(\s*[=:]\s*)\S+", "$1$2***")


def percent_encoded(text: Column) -> Column:
    """URI component encoding, with %20 for a blank."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def is_ncname(text: Column) -> Column:
    """Whether a value may be an XML name without a colon."""
    return F.regexp_like(text, F.lit(r"^[\p{L}_][\p{L}\p{N}_.·\-]*$"))
