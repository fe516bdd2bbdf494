"""Profiling tables: distributions, descriptions, outliers, crosstabs, class ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewright.contracts import Catalog
from casewright.operators.metrics import CUT
from casewright.operators.ranking import WINDOW_ROWS, exact_quantiles

MISSING_LABEL = "(missing)"


def long_numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., column, value)``; one narrow unpivot, no shuffle."""
    cast = [F.col(c).cast("double").alias(c) for c in columns]
    return df.select(*keep, *cast).unpivot(list(keep), list(columns), "column", "value")


def long_levels(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    cast = [F.col(c).cast("string").alias(c) for c in columns]
    return df.select(*keep, *cast).unpivot(list(keep), list(columns), "column", "level")


def target_distribution(df: DataFrame, target: str, cut: int = CUT) -> DataFrame:
    """Count and share (%) per class, and a last row for the classes from ``cut`` up.

    The shares of the last row are the sum of the rounded class shares.
    """
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))  # over one row per class
    shares = counts.select(
        F.col(target).cast("int").alias("class"),
        "n",
        F.bround(F.col("n") / F.sum("n").over(everything) * 100, 2).alias("share_pct"),
    )
    total = shares.where(F.col("class") >= cut).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.bround(F.coalesce(F.sum("share_pct"), F.lit(0.0)), 2).alias("share_pct"),
    )
    return shares.select(F.col("class").cast("string").alias("class"), "n", "share_pct").unionByName(
        total.select(F.lit(f"progressed (>={cut})").alias("class"), "n", "share_pct")
    )


def missingness_pair(train: DataFrame, other: DataFrame) -> DataFrame:
    """Two missingness tables side by side; columns without gaps in the first are left out."""
    right = other.select("column", F.col("missing_pct").alias("missing_pct_other"))
    return train.select("column", "missing", "missing_pct").join(right, "column", "left")


def describe(df: DataFrame, columns: Sequence[str], *, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Count, mean, median, deviation, range and (adjusted) skew, raw and after log1p."""

    def adjusted(skew, n):
        # A constant column has no skew; Spark gives NaN for it.
        value = F.when(~F.isnan(skew), skew)
        return F.when(n > 2, value * F.sqrt(n * (n - 1)) / (n - 2))

    long = long_numbers(df, columns)
    n = F.count("value")
    logs = F.log1p(F.greatest(F.col("value"), F.lit(0.0)))
    logged = F.when(F.col("value").isNotNull(), logs)
    moments = long.groupBy("column").agg(
        n.alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        adjusted(F.skewness("value"), n).alias("skew"),
        adjusted(F.skewness(logged), n).alias("log1p_skew"),
    )
    middle = exact_quantiles(long, "value", {"median": 0.5}, ["column"], window_rows=window_rows)
    return moments.join(F.broadcast(middle), "column", "left")  # a row per column


def iqr_outliers(
    df: DataFrame, columns: Sequence[str], *, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Cells beyond 1.5 interquartile ranges of the quartiles, per column."""
    long = long_numbers(df, columns)
    quartiles = exact_quantiles(
        long, "value", {"q1": 0.25, "q3": 0.75}, ["column"], window_rows=window_rows
    )
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    outside = (F.col("value") < F.col("q1") - reach) | (F.col("value") > F.col("q3") + reach)
    return (
        long.join(F.broadcast(quartiles), "column")
        .groupBy("column")
        .agg(F.count_if(outside).alias("iqr_outliers"))
    )


def z_outliers(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Cells more than ``limit`` population deviations from the mean, per column."""
    long = long_numbers(df, columns)
    centre = long.groupBy("column").agg(
        F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_std")
    )
    distance = F.abs(F.col("value") - F.col("_mean"))
    far = (F.col("_std") > 0) & (distance > F.lit(float(limit)) * F.col("_std"))
    return (
        long.join(F.broadcast(centre), "column")
        .groupBy("column")
        .agg(F.count_if(far).alias("z_outliers"))
    )


def tail_weight(
    df: DataFrame, columns: Sequence[str], *, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Largest value over the 99th percentile (at least 1e-9), per column."""
    long = long_numbers(df, columns)
    tops = long.groupBy("column").agg(F.max("value").alias("_max"))
    p99 = exact_quantiles(long, "value", {"p99": 0.99}, ["column"], window_rows=window_rows)
    return tops.join(F.broadcast(p99), "column").select(
        "column", (F.col("_max") / F.greatest(F.col("p99"), F.lit(1e-9))).alias("max_over_p99")
    )


def level_counts(df: DataFrame, columns: Sequence[str], catalog: Catalog) -> DataFrame:
    """Rows per level; ``position`` orders ordinal levels low to high, others by text."""
    counts = (
        long_levels(df, columns)
        .where(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = F.lit(None).cast("int")
    for c in columns:
        if catalog[c].kind == "ordinal":
            levels = F.array(*[F.lit(x) for x in catalog.levels(c)])
            place = F.array_position(levels, F.col("level")).cast("int") - 1
            order = F.when(F.col("column") == c, place).otherwise(order)
    by_text = Window.partitionBy("column").orderBy("level")  # over the levels of a column
    return counts.select(
        "column", "level", "n", F.coalesce(order, F.row_number().over(by_text) - 1).alias("position")
    )


def yes_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of Yes per flag; a missing flag counts as not Yes."""
    row = df.agg(
        *[F.avg(F.coalesce(F.col(c) == "Yes", F.lit(False)).cast("double")).alias(c) for c in columns]
    )
    return row.unpivot([], list(columns), "column", "share_yes").orderBy(
        F.desc("share_yes"), "column"
    )


def class_ranges(
    df: DataFrame, column: str, target: str, *, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Range and quantiles of a numeric column per class."""
    narrow = df.select(target, F.col(column).cast("double").alias("value"))
    ends = narrow.groupBy(target).agg(F.min("value").alias("min"), F.max("value").alias("max"))
    inner = exact_quantiles(
        narrow,
        "value",
        {"p5": 0.05, "median": 0.5, "p95": 0.95},
        [target],
        window_rows=window_rows,
    )
    return ends.join(F.broadcast(inner), target, "left")  # a row per class


def crosstab(df: DataFrame, row: str, target: str, classes: Sequence[int]) -> DataFrame:
    """Counts of each class per row label; missing labels are left out."""
    return (
        df.where(F.col(row).isNotNull())
        .groupBy(F.col(row).alias("label"))
        .agg(*[F.count_if(F.col(target) == c).alias(f"class_{c}") for c in classes])
    )


def row_shares(counts: DataFrame, classes: Sequence[int]) -> DataFrame:
    """A crosstab with each row divided by its sum."""
    total = sum((F.col(f"class_{c}") for c in classes), F.lit(0))
    return counts.select(
        "label", *[(F.col(f"class_{c}") / total).alias(f"class_{c}") for c in classes]
    )


def leak_check(
    df: DataFrame, columns: Sequence[str], target: str, cut: int = CUT
) -> DataFrame:
    """Per column: cells off the best one-to-one match with ``target >= cut``.

    A column that restates the outcome has every level on one side of the cut
    and so zero mismatches, however many levels it has.
    """
    long = long_levels(df.withColumn("_up", F.col(target) >= cut), columns, ["_up"])
    sides = (
        long.where(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(F.count_if("_up").alias("up"), F.count_if(~F.col("_up")).alias("down"))
    )
    return sides.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_levels"),
        F.sum(F.col("up") + F.col("down")).alias("n"),
        F.sum(F.least("up", "down")).alias("off_diagonal"),
    )


def subgroup_rates(
    df: DataFrame, columns: Sequence[str], target: str, cut: int = CUT
) -> DataFrame:
    """Share at or over the cut and size of each level; missing is a level of its own."""
    long = long_levels(df.withColumn("_up", F.col(target) >= cut), columns, ["_up"])
    return long.groupBy("column", F.coalesce("level", F.lit(MISSING_LABEL)).alias("level")).agg(
        F.avg(F.col("_up").cast("double")).alias("rate"), F.count(F.lit(1)).alias("n")
    )


def date_range(frames: dict[str, DataFrame], column: str) -> DataFrame:
    """First and last date per named table."""
    parts = [
        df.agg(
            F.lit(name).alias("dataset"),
            F.min(column).cast("date").alias("first_date"),
            F.max(column).cast("date").alias("last_date"),
        )
        for name, df in frames.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
