"""Robust percentile rank: average ranks of ties over n - 1, 0.5 for missing values and for a single distinct value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Distinct values that a range has on average, and most ranges.
RANGE_VALUES, MOST_RANGES = 1 << 20, 4096


def robust_rank(df: DataFrame, value: str, name: str, higher: bool = True, of: DataFrame | None = None) -> DataFrame:
    """df with `name`. Values are counted, cut into ranges at quantiles, and ranked within ranges; no task sorts all of them.

    The number of ranges follows that of the values; their totals, at most MOST_RANGES rows, are what is broadcast.
    Infinities and NaN are missing values. of: a DataFrame with the same rows' values that is cheaper to compute than df,
    as when df has other ranks already; without it each rank would repeat those before.
    """
    v = F.when(F.abs(F.col(value).cast("double")) < float("inf"), F.col(value).cast("double"))
    counts = (df if of is None else of).select(v.alias("_v")).where("_v IS NOT NULL").groupBy("_v").agg(F.count("*").alias("_c"))
    n = min(MOST_RANGES, 1 + counts.count() // RANGE_VALUES)
    cuts = sorted(set(counts.approxQuantile(["_v"], [i / n for i in range(1, n)], min(0.005, 0.2 / n))[0])) if n > 1 else []
    # how many cuts are under the value: a search in a short sorted array
    counts = counts.withColumn("_b", F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("_v"))) if cuts else F.lit(0))
    totals = counts.groupBy("_b").agg(F.sum("_c").alias("_t"), F.count("*").alias("_k"))
    w = Window.partitionBy(F.lit(0)).orderBy("_b")
    totals = totals.select("_b", (F.sum("_t").over(w) - F.col("_t")).alias("_before"), F.sum("_t").over(Window.partitionBy(F.lit(0))).alias("_n"), F.sum("_k").over(Window.partitionBy(F.lit(0))).alias("_distinct"))
    within = F.sum("_c").over(Window.partitionBy("_b").orderBy("_v")) - F.col("_c")
    ranks = counts.select("_b", "_v", "_c", within.alias("_w")).join(F.broadcast(totals), "_b")
    share = (F.col("_before") + F.col("_w") + (F.col("_c") - 1) / 2) / (F.col("_n") - 1)
    share = F.when(F.col("_distinct") <= 1, 0.5).otherwise(share if higher else 1 - share)
    rows = df.withColumn("_v", v).join(ranks.select("_v", share.alias("_r")), "_v", "left")
    return rows.withColumn(name, F.coalesce("_r", F.lit(0.5))).drop("_v", "_r")
