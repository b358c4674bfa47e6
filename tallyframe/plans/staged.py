"""Staged budget and cost facts: the contract they meet, and the pair that the star tables make.

A staged table has the five key columns, a period, a value and the stream it belongs to. Here values are whole cents, so
sums are exact whatever the order in which partitions are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ("DEPT", "Service", "Variant", "DEPT DESCRIPTION", "Project")
PERIOD, VALUE, STREAM = "FiscalYear", "Value", "meta_report_type"
REQUIRED = (*KEY, PERIOD, VALUE, STREAM)
LEVELS = KEY


def check_contract(facts: DataFrame) -> DataFrame:
    """``facts`` unchanged; raises if a required column is missing."""
    missing = [c for c in REQUIRED if c not in facts.columns]
    if missing:
        raise ValueError(f"staged table lacks {missing}")
    return facts


def contract_report(facts: DataFrame) -> DataFrame:
    """One row for each required column: whether it is there, its null count and the number of rows. One pass."""
    present = [c for c in REQUIRED if c in facts.columns]
    counts = facts.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in present])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(c in present).alias("present"), (F.col(f"`{c}`") if c in present else F.lit(None).cast("long")).alias("n_null"), "n_rows") for c in REQUIRED]
    return counts.select(F.inline(F.array(*rows)))


def star_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair at line grain: nation and region are small by definition, and their size is left to the optimizer to check."""
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("long").alias(VALUE))
    orders = t("orders").select("o_orderkey", "o_custkey", F.concat(F.lit("FY"), F.year("o_orderdate")).alias(PERIOD))
    customers = t("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    parts = t("part").select("p_partkey", "p_brand")
    who = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    all_rows = lines.join(who, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return all_rows.select(
        F.col("r_name").alias("DEPT"),
        F.col("c_mktsegment").alias("Service"),
        F.col("l_returnflag").alias("Variant"),
        F.col("n_name").alias("DEPT DESCRIPTION"),
        F.col("p_brand").alias("Project"),
        PERIOD,
        VALUE,
        F.when(F.col("l_linestatus") == "F", "Cost").otherwise("Budget").alias(STREAM),
    )


def real_periods(facts: DataFrame) -> DataFrame:
    """Without the pseudo-periods that hold row totals."""
    return facts.where(~F.col(PERIOD).startswith("Total"))


def with_row_totals(facts: DataFrame) -> DataFrame:
    """``facts`` at key grain plus a pseudo-period 'Total Cost' or 'Total Budget' for each key, as exports have them.

    One shuffle: the totals come from the grain by a second, smaller aggregation.
    """
    grain = facts.groupBy(*KEY, PERIOD, STREAM).agg(F.sum(VALUE).alias(VALUE))
    totals = grain.groupBy(*KEY, STREAM).agg(F.sum(VALUE).alias(VALUE)).withColumn(PERIOD, F.concat(F.lit("Total "), STREAM))
    return grain.unionByName(totals)


def identify_streams(files: DataFrame) -> DataFrame:
    """(source_file, n_types, stream): the one report type of each file, or null where a file mixes or lacks them."""
    types = F.collect_set(STREAM)
    return files.groupBy("source_file").agg(types.alias("t")).select("source_file", F.size("t").alias("n_types"), F.when((F.size("t") == 1) & F.get("t", F.lit(0)).isin("Cost", "Budget"), F.get("t", F.lit(0))).alias("stream"))
