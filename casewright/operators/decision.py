"""From class probabilities to close / investigate decisions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.probability import argmax_class, tail_probability
from casewright.operators.metrics import CLASSES, CUT, point_metrics
from casewright.operators.ranking import WINDOW_ROWS, cumulative
from casewright.session import small_table, staged

# Sweep grid, cost ratios, capacity shares, decision texts.
GRID = tuple(round(i / 100, 2) for i in range(2, 99))
COST_RATIOS = (3.0, 5.0, 10.0)
CAPACITIES = (0.25, 0.30, 0.35, 0.40)
PROGRESSED, NOT_PROGRESSED = "Progressed for further investigation", "Not progressed"


def cost_name(ratio: float) -> str:
    return f"cost_ratio_{ratio:g}"


def expected_cost(df: DataFrame, positive: Column, flagged: Column, ratio: float) -> DataFrame:
    """Mean cost per case when a miss costs ``ratio`` false alarms."""
    missed = F.count_if(positive & ~flagged)
    alarms = F.count_if(~positive & flagged)
    return df.agg(
        ((F.lit(float(ratio)) * missed + alarms) / F.count(F.lit(1))).alias("expected_cost")
    )


def threshold_sweep(
    df: DataFrame,
    positive: Column,
    score: str,
    *,
    ratios: Sequence[float] = COST_RATIOS,
    grid: Sequence[float] = GRID,
) -> DataFrame:
    """Recall, precision, share and cost of ``score >= t`` for every threshold of the grid.

    One histogram over the grid replaces a pass per threshold: each row falls in
    the bucket of the highest threshold it reaches, and suffix sums over the
    (grid + 1) buckets give every confusion count.
    """
    points = sorted(float(t) for t in grid)
    narrow = df.select(positive.alias("_pos"), F.col(score).cast("double").alias("_score"))
    edges = Bucketizer(
        splits=[-math.inf, *points, math.inf], inputCol="_score", outputCol="_bucket"
    )
    hist = (
        edges.transform(narrow)
        .groupBy(F.col("_bucket").cast("int").alias("_bucket"))
        .agg(F.count_if("_pos").alias("pos"), F.count_if(~F.col("_pos")).alias("neg"))
    )
    # Bucket 0 lies under the whole grid; buckets without rows still need a line.
    zero = [(i, 0, 0) for i in range(len(points) + 1)]
    lines = small_table(df.sparkSession, zero, "_bucket int, pos bigint, neg bigint")
    full = (
        hist.unionByName(lines)
        .groupBy("_bucket")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .withColumn("threshold", F.get(F.array(*[F.lit(t) for t in points]), F.col("_bucket") - 1))
    )
    everything = Window.partitionBy(F.lit(0))  # over len(grid) + 1 rows
    upward = everything.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, 0)
    tp, fp = F.sum("pos").over(upward), F.sum("neg").over(upward)
    counted = full.select(
        "threshold",
        tp.alias("tp"),
        fp.alias("fp"),
        F.sum("pos").over(everything).alias("p"),
        F.sum(F.col("pos") + F.col("neg")).over(everything).alias("n"),
    ).where(F.col("threshold").isNotNull())
    fn = F.col("p") - F.col("tp")
    flagged = F.col("tp") + F.col("fp")
    return counted.select(
        "threshold",
        F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(0.0).alias("severe_recall"),
        F.when(flagged > 0, F.col("tp") / flagged).otherwise(0.0).alias("severe_precision"),
        fn.alias("false_negatives"),
        F.col("fp").alias("false_positives"),
        (flagged / F.col("n")).alias("progressed_share"),
        *[
            ((F.lit(float(r)) * fn + F.col("fp")) / F.col("n")).alias(cost_name(r))
            for r in ratios
        ],
    )


def operating_points(sweep: DataFrame, ratios: Sequence[float] = COST_RATIOS) -> DataFrame:
    """Cheapest threshold per cost ratio; the highest one wins a tie.

    Costs are compared as ``ratio * misses + alarms``, not as divided floats.
    """
    absent = [r for r in ratios if cost_name(r) not in sweep.columns]
    if absent:
        raise KeyError(f"the sweep has no cost column for {absent}")
    priced = [
        F.struct(F.lit(float(r)).alias("cost_ratio"), F.col(cost_name(r)).alias("cost"))
        for r in ratios
    ]
    long = sweep.withColumn("_c", F.explode(F.array(*priced))).select("*", "_c.*")
    units = F.col("cost_ratio") * F.col("false_negatives") + F.col("false_positives")
    best = Window.partitionBy("cost_ratio").orderBy(units, F.desc("threshold"))
    return (
        long.withColumn("_r", F.row_number().over(best))
        .where(F.col("_r") == 1)
        .select(
            "cost_ratio",
            "threshold",
            "severe_recall",
            "severe_precision",
            "progressed_share",
            F.col("cost").alias("expected_cost_per_case"),
        )
    )


@dataclass(frozen=True)
class OperatingPoint:
    cost_ratio: float
    threshold: float
    severe_recall: float
    severe_precision: float
    progressed_share: float
    expected_cost_per_case: float


def select_operating_point(sweep: DataFrame, ratio: float) -> OperatingPoint:
    """The operating point of one ratio, as a driver-side value (one row)."""
    return OperatingPoint(**operating_points(sweep, [ratio]).first().asDict())


def capacity_analysis(
    df: DataFrame,
    positive: Column,
    score: str,
    key: str,
    *,
    fractions: Sequence[float] = CAPACITIES,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """What is caught when only the top share of cases, by score, can be progressed.

    The boundary case is found on running totals per distinct score.  Cases tied
    with it (there may be very many) are admitted in key order, by running totals
    over the keys of the tied rows, for all fractions in one job.
    """
    spark = df.sparkSession
    # Three narrow columns, written once because two or three passes follow.
    rows = staged(
        df.select(F.col(key).alias("_key"), positive.alias("_pos"), F.col(score).alias("_score"))
    )
    weights = {"n": F.lit(1), "pos": F.col("_pos").cast("bigint")}
    cum = cumulative(rows, "_score", weights, window_rows=window_rows)
    n_above = F.col("n_total") - F.col("n_before") - F.col("n")
    pos_above = F.col("pos_total") - F.col("pos_before") - F.col("pos")
    wanted = F.bround(F.col("f") * F.col("n_total")).cast("bigint")
    # One boundary row per fraction: the score whose rows straddle the capacity.
    boundary = (
        cum.withColumn("f", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
        .withColumn("k", wanted)
        .where((n_above < F.col("k")) & (F.col("k") <= n_above + F.col("n")))
        .select(
            "f",
            "k",
            "_score",
            "n",
            "pos",
            (F.col("k") - n_above).alias("take"),
            pos_above.alias("pos_above"),
            F.col("pos_total").alias("p"),
        )
    )
    edges = {r["f"]: r for r in boundary.collect()}
    p = next((e["p"] for e in edges.values()), None)
    if p is None:
        p = rows.agg(F.count_if("_pos")).first()[0]

    split = [e for e in edges.values() if 0 < e["pos"] and e["take"] < e["n"]]
    inside = {}
    if split:
        ends = small_table(
            spark, [(e["f"], e["_score"], e["take"]) for e in split], "f double, _score double, take bigint"
        )
        tied = rows.withColumn("_score", F.col("_score").cast("double")).join(F.broadcast(ends), "_score")
        run = cumulative(
            tied, "_key", weights, ["f", "take"], window_rows=window_rows, distinct=max(e["n"] for e in split)
        )
        caught = run.groupBy("f").agg(F.sum(F.when(F.col("n_before") < F.col("take"), F.col("pos")).otherwise(0)))
        inside = dict(caught.collect())
    out = []
    for f in map(float, fractions):
        edge = edges.get(f)
        if edge is None:  # no capacity at all
            out.append((f, 0, 1.0, 0, int(p)))
            continue
        caught = edge["pos_above"] + inside.get(f, edge["pos"])
        out.append((f, int(edge["k"]), float(edge["_score"]), int(caught), int(p)))
    table = small_table(
        spark,
        out,
        "capacity_fraction double, cases_progressed bigint, implied_threshold double, "
        "caught bigint, p bigint",
    )
    k, caught, p = F.col("cases_progressed"), F.col("caught"), F.col("p")
    return table.select(
        "capacity_fraction",
        "cases_progressed",
        "implied_threshold",
        F.when(p > 0, caught / p).otherwise(0.0).alias("severe_recall"),
        F.when(k > 0, caught / k).otherwise(0.0).alias("severe_precision"),
        (p - caught).alias("severe_missed"),
    )


def cost_aware_columns(
    proba: Column, threshold: float, *, classes: Sequence[int] = CLASSES, cut: int = CUT
) -> dict[str, Column]:
    """Argmax class, decision, and the class made consistent with the decision.

    Where the argmax contradicts the decision, the likeliest class on the
    decided side of the cut replaces it.
    """
    severe = [c for c in classes if c >= cut]
    mild = [c for c in classes if c < cut]
    severe_part = F.slice(proba, len(mild) + 1, len(severe))
    mild_part = F.slice(proba, 1, len(mild))
    mass = F.aggregate(severe_part, F.lit(0.0), lambda acc, v: acc + v)
    progress = mass >= F.lit(float(threshold))
    top = argmax_class(proba, classes)
    adjusted = (
        F.when(progress & (top < cut), argmax_class(severe_part, severe))
        .when(~progress & (top >= cut), argmax_class(mild_part, mild))
        .otherwise(top)
    )
    return {"argmax": top, "adjusted": adjusted, "progress": progress}


def compare_rules(
    df: DataFrame,
    y: str,
    proba: str,
    threshold: float,
    *,
    classes: Sequence[int] = CLASSES,
    cut: int = CUT,
) -> DataFrame:
    """Point metrics of the likeliest class and of the cost-aware class, a row per ``rule``."""
    made = cost_aware_columns(F.col(proba), threshold, classes=classes, cut=cut)
    rules = df.select(F.col(y).alias("y"), made["argmax"].alias("argmax"), made["adjusted"].alias("cost_aware"))
    long = rules.unpivot(["y"], ["argmax", "cost_aware"], "rule", "pred")
    return point_metrics(long, by=["rule"], classes=classes, cut=cut)


def prediction_table(
    df: DataFrame,
    key: str,
    proba: str,
    threshold: float,
    *,
    classes: Sequence[int] = CLASSES,
    cut: int = CUT,
) -> DataFrame:
    """One line per case: decided class, decision text, probabilities at four digits."""
    p = F.col(proba)
    made = cost_aware_columns(p, threshold, classes=classes, cut=cut)
    return df.select(
        key,
        made["adjusted"].cast("int").alias("predicted_severity"),
        F.when(made["progress"], PROGRESSED).otherwise(NOT_PROGRESSED).alias("decision"),
        F.bround(tail_probability(p, classes, cut), 4).alias("p_severe"),
        made["argmax"].cast("int").alias("argmax_severity"),
        *[F.bround(F.get(p, F.lit(i)), 4).alias(f"p_{c}") for i, c in enumerate(classes)],
    )


def predicted_distribution(predictions: DataFrame) -> DataFrame:
    """Cases and share per predicted class, with the overall progressed share."""
    by_class = predictions.groupBy("predicted_severity").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("decision") == PROGRESSED).alias("_progressed"),
    )
    everything = Window.partitionBy(F.lit(0))  # over one row per class
    total = F.sum("n").over(everything)
    return by_class.select(
        "predicted_severity",
        "n",
        (F.col("n") / total).alias("share"),
        (F.sum("_progressed").over(everything) / total).alias("progressed_share"),
    )
