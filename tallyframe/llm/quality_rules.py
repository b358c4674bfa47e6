"""Quality rules: a table of thresholds compiled into one projection.

A rule names a ratio, a lower and an upper bound. ``compile_rules`` turns the whole table into one boolean column over
the ratios, and ``measure`` computes what the ratios need from the text with Spark's own string and array functions: one
narrow projection, no shuffle, no user functions. Ratios are compared by integer cross-multiplication, so the verdict
never depends on rounding.

Defined results: a null text counts as an empty one (all counts 0, base_failed). Extra columns pass through ``apply``
unless they clash with the names that it adds, which win; names with a leading "_quality_" are refused. Repeated rows are
judged one by one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Splits text into words ``[^\x20\x09-\x0D]+``.
WORD_GAP = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
BULLET = r"^[\x20\x09-\x0D]*[-*•]"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09-\x0D]*$"
#: Low bits of a long that hold the place of a window, in texts of up to so many words.
PLACE = (1 << 26) - 1
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "with", "be", "on", "are", "this", "was", "as", "by", "from",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "dans", "pour", "est", "en", "au", "sur", "pas",
    "der", "die", "das", "und", "ist", "von", "zu", "den", "mit", "nicht", "ein", "eine", "für", "auf", "im", "dem", "sich",
    "el", "los", "las", "y", "a", "se", "no", "por", "con", "para", "una", "su", "al", "lo", "como",
)


class Rule(NamedTuple):
    """Keeps a document if low * of <= what <= high * of; a bound of None doesn't apply. Bounds are in thousandths."""

    what: str
    of: str
    low: int | None
    high: int | None


#: The production table. Bounds are thousandths of the second column.
RULES = (
    Rule("word_chars", "n_words", 2_000, 15_000),
    Rule("n_symbols", "n_words", None, 250),
    Rule("n_stop_words", "n_words", 20, None),
    Rule("n_dup_lines", "n_lines", None, 500),
    Rule("n_bullet_lines", "n_lines", None, 900),
    Rule("n_ellipsis_lines", "n_lines", None, 300),
)


def _sized(array: Column) -> Column:
    return F.size(array).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts that rules use. All are longs over the whole text.

    n_repeat_words: positions inside any window of three words that occurs twice or more in the text. Equal windows are
    found by sorting the windows' 64-bit hashes, so a text of any length costs n log n.
    """
    if clash := [c for c in docs.columns if c.startswith("_quality_")]:
        raise ValueError(f"reserved column names: {clash}")
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(whole, WORD_GAP), "")
    lines = F.filter(F.split(whole, "\n"), lambda s: s.rlike(A_WORD))
    out = docs.withColumns({"_quality_text": whole, "_quality_words": words, "_quality_lines": lines})
    out = out.withColumn("_quality_hashed", F.transform("_quality_words", lambda w: F.xxhash64(w)))
    hashed = lambda i: F.get("_quality_hashed", i)
    starts = F.slice("_quality_hashed", 1, F.greatest(F.size("_quality_hashed") - 2, F.lit(0)))
    out = out.withColumn("_quality_grams", F.transform(starts, lambda g, i: F.xxhash64(g, hashed(i + 1), hashed(i + 2))))
    # A window's hash with its low bits replaced by its place: sorting plain longs brings equal windows together.
    placed = F.transform("_quality_grams", lambda g, i: g.bitwiseAND(~PLACE).bitwiseOR(i.cast("long")))
    short = F.size("_quality_grams") <= PLACE
    out = out.withColumn("_quality_sorted", F.when(short, F.sort_array(placed)))
    gram = lambda x: F.get("_quality_grams", x.bitwiseAND(PLACE).cast("int"))
    at = lambda k: F.get("_quality_sorted", k)
    # Longer texts, and those where different windows agree in the high bits, sort whole hashes with their places.
    mixed = F.exists(F.transform("_quality_sorted", lambda x, k: (at(k + 1) <= x.bitwiseOR(PLACE)) & (gram(at(k + 1)) != gram(x))), lambda x: x)
    out = out.withColumn("_quality_exact", F.coalesce(~mixed, F.lit(False)) | (F.size("_quality_grams") == 0))
    whole_hashes = F.sort_array(F.transform("_quality_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    out = out.withColumn("_quality_pairs", F.when(~F.col("_quality_exact"), whole_hashes))
    pair = lambda k: F.get("_quality_pairs", k)["g"]
    twice = F.filter("_quality_sorted", lambda x, k: (at(k + 1) <= x.bitwiseOR(PLACE)) | (at(k - 1).bitwiseOR(PLACE) >= x))
    places = F.when(F.col("_quality_exact"), F.transform(twice, lambda x: x.bitwiseAND(PLACE).cast("int"))).otherwise(
        F.transform(F.filter("_quality_pairs", lambda x, k: (pair(k + 1) == x["g"]) | (pair(k - 1) == x["g"])), lambda x: x["i"])
    )
    covered = F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2))))
    counts = {
        "n_words": _sized(F.col("_quality_words")),
        "word_chars": F.length(F.array_join("_quality_words", "")).cast("long"),
        "n_symbols": (F.length("_quality_text") - F.length(F.regexp_replace("_quality_text", f"[{SYMBOLS}]", ""))).cast("long"),
        "n_lines": _sized(F.col("_quality_lines")),
        "n_dup_lines": (F.size("_quality_lines") - F.size(F.array_distinct("_quality_lines"))).cast("long"),
        "n_repeat_words": _sized(covered),
        "n_stop_words": _sized(F.filter("_quality_words", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_bullet_lines": _sized(F.filter("_quality_lines", lambda s: s.rlike(BULLET))),
        "n_ellipsis_lines": _sized(F.filter("_quality_lines", lambda s: s.rlike(ELLIPSIS))),
    }
    # A generator of one row: a filter on the counts stays above it and is not rewritten into the arrays they come from.
    once = F.inline(F.array(F.struct(*[c.alias(name) for name, c in counts.items()])))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in counts], once)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """One boolean column: every bound of the table holds."""
    verdict = F.lit(True)
    for r in rules:
        if r.low is not None:
            verdict &= 1000 * F.col(r.what) >= r.low * F.col(r.of)
        if r.high is not None:
            verdict &= 1000 * F.col(r.what) <= r.high * F.col(r.of)
    return verdict


def apply(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with the counts, base_failed and kept."""
    out = measure(docs, text).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
