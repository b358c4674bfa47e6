"""Healing of members and their similarity. NFKC, case folding and sequence similarity have no built-in form in Spark, so these
are Arrow UDFs; callers apply them to distinct members, never to facts."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

#: Characters without width, and those a licence for punctuation removes.
ZERO_WIDTH = re.compile("[​‌‍﻿]")
PUNCTUATION = re.compile(r"[-_./\\]")


def heal_text(text: str) -> str:
    return " ".join(ZERO_WIDTH.sub("", unicodedata.normalize("NFKC", text)).split())


def key_of(text: str, punctuation: bool, case: bool) -> str:
    out = heal_text(text)
    out = PUNCTUATION.sub("", out) if punctuation else out
    return out.casefold() if case else out


def ratio_of(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def _each(f, kind=StringType()):
    def run(column: pd.Series) -> pd.Series:
        return column.map(f, na_action="ignore")

    return F.pandas_udf(run, kind)


def heal_universal(text: Column) -> Column:
    """NFKC, no zero-width characters, white space collapsed and trimmed."""
    return _each(heal_text)(text.cast("string"))


def member_key(text: Column, punctuation: bool = False, case: bool = False) -> Column:
    """The healed text, less what the licence lets go."""
    return _each(lambda t: key_of(t, punctuation, case))(text.cast("string"))


def fuzzy_ratio(a: Column, b: Column) -> Column:
    """Similarity of two texts (twice the matching characters by both lengths), to three places; null if either is null."""

    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) or pd.isna(y) else round(ratio_of(x, y), 3) for x, y in zip(left, right, strict=True)], dtype="float64")

    return F.pandas_udf(run, DoubleType())(a, b)


def nearest(text: Column, pool: Sequence[str]) -> Column:
    """(name, ratio) of the pool's most similar name, the earliest of equals; ``pool`` is a declaration, not data."""
    pool = list(pool)

    def run(column: pd.Series) -> pd.DataFrame:
        best = []
        for t in column:
            ratios = [] if pd.isna(t) else [ratio_of(t, p) for p in pool]
            top = max(range(len(ratios)), key=ratios.__getitem__, default=None)
            best.append((pool[top], round(ratios[top], 3)) if top is not None and ratios[top] > 0 else (None, None))
        return pd.DataFrame(best, columns=["name", "ratio"]).astype({"ratio": "float64"})

    return F.pandas_udf(run, StructType([StructField("name", StringType()), StructField("ratio", DoubleType())]))(text)
