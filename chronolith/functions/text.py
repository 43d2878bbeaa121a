"""Text and identity columns."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

#: Words that a title's tokens leave out.
TITLE_STOP = "the a an bill of for and".split()
_WORD = re.compile(r"[^\W_]+")


@F.pandas_udf(StringType())
def nfc_casefold(x: pd.Series) -> pd.Series:
    """NFC, then case folding, diacritics kept. Spark has no built-in for either."""
    return x.map(lambda v: None if v is None else unicodedata.normalize("NFC", v).casefold())


def lower_words(x: Column, nfc: bool = False) -> Column:
    """Runs of letters and digits (Python's Unicode tables), each character in lower case: not folded, so that sharp s
    and ss stay apart, as SQL's lower has them. ``nfc`` composes characters before."""

    @F.pandas_udf(StringType())
    def runs(texts: pd.Series) -> pd.Series:
        def of(v):
            v = unicodedata.normalize("NFC", v) if nfc else v
            # a character at a time: str.lower() alone makes a last sigma another letter and two characters of a dotted I
            return " ".join(_WORD.findall(v.replace("\u0130", "i").replace("\u03a3", "\u03c3").lower()))

        return texts.map(lambda v: None if v is None else of(v))

    run = runs(x)
    return F.when(run == "", F.array().cast("array<string>")).otherwise(F.split(run, " "))


def label(x: Column) -> Column:
    """White space collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))


def title(x: Column) -> Column:
    """A title without parentheses and trailing year."""
    return F.trim(F.regexp_replace(F.regexp_replace(label(x), r"\s*\([^()]*\)", ""), r"\s+(1[89]|20)\d\d$", ""))


def title_tokens(x: Column) -> Column:
    return F.array_except(F.array_distinct(F.regexp_extract_all(label(x), F.lit(r"[a-z0-9]+"), 0)), F.array(*map(F.lit, TITLE_STOP)))


def chunks(x: Column, size: int = 180) -> Column:
    """Runs of ``size`` words each."""
    words = F.filter(F.split(x, r"\s+"), lambda w: w != "")
    n = F.size(words)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), lambda i: F.array_join(F.slice(words, i * size + 1, size), " "))).otherwise(F.array().cast("array<string>"))


def identity(parent: Column, kind: str, fields: dict[str, Column]) -> Column:
    """An identifier derived from canonical JSON (keys sorted, compact)."""
    body = F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})
    return F.concat(parent, F.lit(f"#{kind}-"), F.sha2(body, 256))
