"""Identity of members: closed, registered and observed levels, approvals, drift and parentage.

Members are (source_file, level, member). Everything that needs Python runs on distinct members; the value to write back is
joined to the facts on (level, member). Registers are tables: registry_members (level, member, approved, approved_by,
first_seen, parents map<string,long>) and registry_levels (level, cardinality).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import members as m
from tallyframe.plans.report import HIGH, OK, findings

#: Fixed value: what a printed blank member becomes.
NOT_PROVIDED = "NA - Not Provided"


def distinct_members(facts: DataFrame, levels: Sequence[str]) -> DataFrame:
    """(source_file, level, member): the members of the levels, without nulls. One scan, one aggregation."""
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("level"), F.col(f"`{c}`").cast("string").alias("member")) for c in levels]))
    return facts.select("source_file", rows).where("member IS NOT NULL").distinct()


def judge(members: DataFrame, known: DataFrame, *, mode: str, punctuation: bool = False, case: bool = False, bootstrap: bool = False, blank: str = "(blank)", near: float = 0.4) -> DataFrame:
    """``members`` with value (to write back), method, matched_against, confidence, review_priority, hint; method is null where nothing is to say.

    ``known`` (level, member) is the vocabulary of a closed level or the approved members of a registry; observed levels are healed only.
    """
    healed = members.withColumns({"healed": m.heal_universal(F.col("member")), "key": m.member_key(F.col("member"), punctuation, case)})
    if mode == "observed":
        return healed.select("source_file", "level", "member", F.col("healed").alias("value"), *[F.lit(None).cast(t).alias(c) for c, t in (("method", "string"), ("matched_against", "string"), ("confidence", "double"), ("review_priority", "string"), ("hint", "string"))])
    vocabulary = known.where("member IS NOT NULL").select("level", F.col("member").alias("canonical")).distinct()
    keyed = vocabulary.withColumn("key", m.member_key(F.col("canonical"), punctuation, case)).groupBy("level", "key").agg(F.max("canonical").alias("canonical"))
    found = healed.join(keyed, ["level", "key"], "left")
    is_blank = F.lower("healed") == blank.lower()
    strange = found.where(F.col("canonical").isNull() & ~is_blank).select("level", "healed").distinct()
    ratios = strange.join(vocabulary, "level").select("level", "healed", "canonical", m.fuzzy_ratio(F.col("healed"), F.col("canonical")).alias("r"))
    closest = ratios.where("r > 0").groupBy("level", "healed").agg(F.min(F.struct((-F.col("r")).alias("r"), "canonical")).alias("best"))
    out = found.join(closest, ["level", "healed"], "left")
    new = "member_registered" if bootstrap else "member_pending_approval"
    unknown = F.lit("member_undeclared" if mode == "closed" else new)
    method = F.when(is_blank, "member_blank_literal").when(F.col("canonical").isNull(), unknown).when(F.col("canonical") != F.col("member"), "member_normalized")
    value = F.when(is_blank, NOT_PROVIDED).otherwise(F.coalesce("canonical", "member" if mode == "closed" else "healed"))
    blocks = F.col("canonical").isNull() & ~is_blank & F.lit(not (mode == "registry" and bootstrap))
    matched = F.when(is_blank, None).otherwise(F.coalesce("canonical", F.when(blocks, F.col("best.canonical"))))
    ratio = F.when(is_blank, None).when(F.col("canonical").isNotNull(), 1.0).when(blocks, -F.col("best.r"))
    out = out.withColumns({"method": method, "matched_against": F.when(method.isNotNull(), matched), "confidence": F.when(method.isNotNull(), ratio)})
    hint = F.when(blocks & (F.col("confidence") >= near), F.col("matched_against"))
    return out.select("source_file", "level", "member", value.alias("value"), "method", "matched_against", "confidence", F.when(method.isNotNull(), F.when(blocks, HIGH).otherwise(OK)).alias("review_priority"), hint.alias("hint"))


def member_findings(judged: DataFrame) -> DataFrame:
    note = F.concat_ws("; ", F.concat(F.lit("level "), "level"), F.concat(F.lit("closest known member is "), "hint"))
    return findings(judged.where("method IS NOT NULL"), source_header=F.col("level"), resolved_name=F.col("member"), note=note)


def write_back(facts: DataFrame, judged: DataFrame, levels: Sequence[str]) -> DataFrame:
    """``facts`` with the judged values. Only members that change are joined, one level after another; the optimizer sizes the join."""
    changed = judged.where("member <> value").select("level", "member", "value").distinct()
    for level in levels:
        one = changed.where(F.col("level") == level).select(F.col("member").alias(level), F.col("value").alias("_value"))
        facts = facts.join(one, level, "left").withColumn(level, F.coalesce("_value", F.col(f"`{level}`"))).drop("_value")
    return facts


def license_check(vocabulary: DataFrame, punctuation: bool = True, case: bool = True) -> DataFrame:
    """(level, folded, members): known members that the licence would merge; an empty result proves it safe."""
    folded = vocabulary.select("level", "member").distinct().withColumn("folded", m.member_key(F.col("member"), punctuation, case))
    return folded.groupBy("level", "folded").agg(F.array_join(F.array_sort(F.collect_set("member")), ", ").alias("members"), F.count("*").alias("n")).where("n > 1")


def registry_after(registry: DataFrame, judged: DataFrame, now: str) -> DataFrame:
    """The register with a batch's new members appended: approved where they came by bootstrap."""
    new = judged.where("method IN ('member_pending_approval', 'member_registered')").groupBy("level", F.col("value").alias("member")).agg(F.bool_or(F.col("method") == "member_registered").alias("approved"))
    rows = new.join(registry.select("level", "member"), ["level", "member"], "left_anti")
    return registry.unionByName(rows.withColumn("first_seen", F.lit(now)), allowMissingColumns=True)


def pending_members(registry: DataFrame, level: str | None = None) -> DataFrame:
    rows = registry.where("NOT approved").select("level", "member")
    return rows if level is None else rows.where(F.col("level") == level)


def approved_members(registry: DataFrame, level: str) -> DataFrame:
    return registry.where("approved").where(F.col("level") == level).select("level", "member")


def approve_members(registry: DataFrame, level: str, members: Sequence[str] | None = None, approver: str | None = None) -> DataFrame:
    """The register with members of a level approved: all of them if ``members`` is None, none if it is empty. Unknown names are added."""
    this = F.col("level") == level
    chosen = this & ~F.col("approved") & (F.lit(True) if members is None else F.col("member").isin(*members))
    out = registry.withColumns({"approved_by": F.when(chosen, approver).otherwise(F.col("approved_by")), "approved": F.col("approved") | chosen})
    if members:
        names = registry.sparkSession.createDataFrame([(level, x, True, approver) for x in dict.fromkeys(members)], "level string, member string, approved boolean, approved_by string")
        out = out.unionByName(names.join(registry.select("level", "member"), ["level", "member"], "left_anti"), allowMissingColumns=True)
    return out


def cardinality_drift(members: DataFrame, before: DataFrame, tolerance: float = 0.25) -> DataFrame:
    """Levels whose number of members changed by more than ``tolerance`` since ``before`` (level, cardinality); no finding without a count before."""
    now = members.groupBy("level").agg(F.count_distinct("member").alias("n"))
    both = now.join(before.where("cardinality > 0"), "level")
    change = F.abs(F.col("n") - F.col("cardinality")) / F.col("cardinality")
    return both.withColumn("change", F.bround(change, 3)).where(change > tolerance).select("level", "cardinality", "n", "change", F.lit("cardinality_drift").alias("method"), F.lit(HIGH).alias("review_priority"))


def parent_change(pairs: DataFrame, registry: DataFrame) -> DataFrame:
    """Pairs (level, member, parent) new to a member that has a parent on record as the batch begins, with how often each was seen."""
    seen = pairs.dropna(subset=["level", "member", "parent"]).groupBy("level", "member", "parent").agg(F.count("*").alias("n"))
    known = registry.select("level", "member", F.explode("parents").alias("parent", "_times")).drop("_times")
    old = known.select("level", "member").distinct()
    new = seen.join(old, ["level", "member"], "left_semi").join(known, ["level", "member", "parent"], "left_anti")
    return new.withColumns({"method": F.lit("member_parent_change"), "review_priority": F.lit(HIGH)})


def blank_literal(text: Column, blank: str = "(blank)") -> Column:
    """Printed blanks as the sentinel; anything else unchanged."""
    return F.when(F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " "))) == blank.lower(), NOT_PROVIDED).otherwise(text)
