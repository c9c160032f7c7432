"""Exact order statistics that never hold one key's rows in one buffer, and ANSI-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def pearson(x: Column, y: Column) -> Column:
    """Correlation; NULL for a single row or zero variance, where ``corr`` would divide by zero."""
    x, y = x.cast("double"), y.cast("double")
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def mean_of_present(columns: list[Column]) -> tuple[Column, Column]:
    """Row-wise mean that skips NULLs, and how many values it used."""
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    present = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return F.try_divide(total, present), present


def most_frequent(counts: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """Per key the value with the largest weight, the lowest value on ties; NULL values do not count.

    The buffer is one struct per key, however many distinct values a key has.
    """
    best = F.min(
        F.when(F.col(value).isNotNull(), F.struct((-F.col(weight)).alias("rank"), F.col(value).alias("value")))
    )
    return counts.groupBy(key).agg(best.alias("_best")).select(key, F.col("_best.value").alias(value))


def weighted_median(counts: DataFrame, key: str, value: str, weight: str, output: str, width: int = 100) -> DataFrame:
    """Exact per-key median of a positive decimal column given as (key, value, weight) rows.

    Two bounded passes replace one buffer of all distinct values of a key. Buckets of ``width`` are
    summed and ranked first; then only the values in the one or two buckets that hold the middle
    ranks are. With values up to 100,000 and four decimals a window sees at most 1,000 buckets or
    two buckets of a million values of a key, also when one key holds a large share of the data.
    The plan is lazy; both passes start from the same counts, so their shuffle is reused.
    """
    bucketed = counts.withColumn("_bucket", F.floor(F.col(value) / width))
    ranked = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(key)
    middle = (
        bucketed.groupBy(key, "_bucket")
        .agg(F.sum(weight).alias("_n"))
        .select(
            key,
            "_bucket",
            (F.sum("_n").over(ranked) - F.col("_n")).alias("_before"),
            F.sum("_n").over(ranked).alias("_upto"),
            F.sum("_n").over(whole).alias("_total"),
        )
        .withColumn("_low", F.floor((F.col("_total") + 1) / 2))
        .withColumn("_high", F.floor((F.col("_total") + 2) / 2))
        .where((F.col("_before") < F.col("_high")) & (F.col("_upto") >= F.col("_low")))
    )
    place = [key, "_bucket", "_before", "_low", "_high"]
    near = bucketed.join(middle.select(*place), [key, "_bucket"])
    values = near.groupBy(*place, value).agg(F.sum(weight).alias("_n"))
    inside = Window.partitionBy(key, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    positions = values.withColumn("_reached", F.col("_before") + F.sum("_n").over(inside))
    low = F.min(F.when(F.col("_reached") >= F.col("_low"), F.col(value)))
    high = F.min(F.when(F.col("_reached") >= F.col("_high"), F.col(value)))
    return positions.groupBy(key).agg(((low + high) / 2).alias(output))
