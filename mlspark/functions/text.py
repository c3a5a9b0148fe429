"""Text normalisation and word extraction."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.functions.columns import to_column

# fixed values: patterns of the text clean-up
URL = r"https?://[-_a-zA-Z0-9./]+"
DIGITS = r"[0-9]+"
WORD_CHAR = r"[\p{L}\p{N}]"
WORD = WORD_CHAR + "+"


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode compatibility form; Spark has no such built-in, so this runs on Arrow batches."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def normalize_text(col: str | Column, compatibility: bool = True) -> Column:
    """Compatibility form, URLs removed, digit runs as one ``0``, lower case."""
    c = to_column(col)
    base = nfkc(c) if compatibility else c
    return F.lower(F.regexp_replace(F.regexp_replace(base, URL, ""), DIGITS, "0"))


def tokenize(col: str | Column, min_len: int = 2, stop_words: Column | None = None) -> Column:
    """Lower-case Unicode words of at least ``min_len`` characters, stop words dropped, order kept."""
    words = F.regexp_extract_all(F.lower(to_column(col)), F.lit(f"({WORD_CHAR}{{{min_len},}})"))
    if stop_words is None:
        return words
    return F.filter(words, lambda w: ~F.array_contains(stop_words, w))


# fixed values: function words left out per language
STOP_WORDS = {
    "en": "the and of to in is that for it as was with be by on not he his but at are this have from or had an they",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec",
    "es": "de la que el en los se del las un por con no una su para es al lo como más pero sus le ya",
}


def stop_words_for(lang: str | Column) -> Column:
    """Array of stop words for a language column, empty for others."""
    c = to_column(lang)
    out = F.array().cast("array<string>")
    for code, words in STOP_WORDS.items():
        out = F.when(c == code, F.array(*[F.lit(w) for w in words.split()])).otherwise(out)
    return out
