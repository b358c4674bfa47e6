"""Scalar functions over cells, headers and members, in Spark's own expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: a number with optional sign, currency, brackets and thousands separators. Sign and currency stand together.
NUMBER = r"(?U)^\s*(?:\(\s*[$£€]?[\d,]*\.?\d+\s*\)|[-+]?[$£€]?\s*[\d,]*\.?\d+)\s*$"
#: Decimal digits of all scripts in the basic plane, by their value.
DIGITS = [(chr(c), str(unicodedata.decimal(chr(c)))) for c in range(128, 0x10000) if unicodedata.category(chr(c)) == "Nd"]


def to_number(cell: Column) -> Column:
    """A cell's number as a double; null for anything that isn't one. Brackets mean negative."""
    plain = F.translate(cell, "".join(d for d, _ in DIGITS), "".join(v for _, v in DIGITS))
    digits = F.regexp_replace(plain, r"[^0-9.]", "").try_cast("double")
    negative = F.regexp_like(cell, F.lit(r"(?U)^\s*[(-]"))
    return F.when(F.regexp_like(cell, F.lit(NUMBER)), F.when(negative, -digits).otherwise(digits))


def collapse(text: Column) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def norm_header(text: Column, prefixes: Sequence[str] = ()) -> Column:
    """Lower case, collapsed, with one leading aggregation prefix removed."""
    out = F.lower(collapse(text))
    if prefixes:
        out = F.regexp_replace(out, "^(?:" + "|".join(map(re.escape, prefixes)) + ") ", "")
    return out


def is_blank(text: Column) -> Column:
    """Null, or white space of any kind alone."""
    return text.isNull() | (F.regexp_replace(text, r"(?U)\s+", "") == "")


def row_key(*columns: str) -> Column:
    """The first 16 hex digits of the SHA-256 of the columns, joined by bars, nulls as a tilde."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in columns]), 256), 1, 16)
