"""Ordinal, nominal and decision metrics as single-pass Spark aggregates.

Every metric of the first block is a function of sums, so one ``groupBy`` with
map-side combining serves any grouping (fold, scenario, subgroup) and hot groups
cost one partial row per task.  Only the two ranking metrics need sorted order;
they work on one row per distinct probability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.probability import tail_probability
from casewright.operators.ranking import WINDOW_ROWS, cumulative
from casewright.session import small_table

CLASSES = (1, 2, 3, 4, 5, 6)
CUT = 4
# Fixed value: smallest probability the log loss takes a logarithm of.
LOG_FLOOR = 2.220446049250313e-16


def _ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    out = F.when(bottom > 0, top / bottom)
    return out if empty is None else out.otherwise(F.lit(empty))


def kappa_from_sums(
    n: Column, sum_y: Column, sum_p: Column, sum_yy: Column, sum_pp: Column, sum_d2: Column
) -> Column:
    """Quadratic weighted kappa; the confusion matrix is not needed.

    Expected disagreement under independence is ``sum_yy + sum_pp - 2 sum_y sum_p / n``.
    Null where it is zero.  Classes are taken at their numeric distance.
    """
    expected = sum_yy + sum_pp - F.lit(2.0) * sum_y * sum_p / n
    return F.when(expected != 0, F.lit(1.0) - sum_d2 / expected)


def qwk(y: Column, pred: Column) -> Column:
    """Quadratic weighted kappa as one aggregate expression."""
    y, p = y.cast("bigint"), pred.cast("bigint")
    return kappa_from_sums(
        F.count(y), F.sum(y), F.sum(p), F.sum(y * y), F.sum(p * p), F.sum((y - p) * (y - p))
    )


def _sums(
    y: Column, pred: Column, classes: Sequence[int], cut: int, proba: Column | None
) -> dict[str, Column]:
    y, p = y.cast("bigint"), pred.cast("bigint")
    severe, flagged = y >= cut, p >= cut
    out = {
        "n": F.count(y),
        "s_y": F.sum(y),
        "s_p": F.sum(p),
        "s_yy": F.sum(y * y),
        "s_pp": F.sum(p * p),
        "s_d2": F.sum((y - p) * (y - p)),
        "s_abs": F.sum(F.abs(y - p)),
        "hit": F.count_if(y == p),
        "near": F.count_if(F.abs(y - p) <= 1),
        "tp": F.count_if(severe & flagged),
        "fn": F.count_if(severe & ~flagged),
        "fp": F.count_if(~severe & flagged),
    }
    for c in classes:
        out[f"y_{c}"] = F.count_if(y == c)
        out[f"p_{c}"] = F.count_if(p == c)
        out[f"h_{c}"] = F.count_if((y == c) & (p == c))
    if proba is not None:
        ps = tail_probability(proba, classes, cut)
        gap = ps - severe.cast("double")
        labels = F.array(*[F.lit(int(c)).cast("bigint") for c in classes])
        own = F.element_at(proba, F.array_position(labels, y).cast("int"))
        out["s_brier"] = F.sum(gap * gap)
        out["s_log"] = F.sum(-F.log(F.greatest(own, F.lit(LOG_FLOOR))))
    return out


def _finish(classes: Sequence[int], with_proba: bool) -> dict[str, Column]:
    col = F.col
    f1_parts = [
        _ratio(F.lit(2.0) * col(f"h_{c}"), col(f"y_{c}") + col(f"p_{c}")) for c in classes
    ]
    seen = sum(((col(f"y_{c}") > 0).cast("int") for c in classes), F.lit(0))
    recalls = {c: _ratio(col(f"h_{c}"), col(f"y_{c}"), None) for c in classes}
    recall_total = sum((F.coalesce(r, F.lit(0.0)) for r in recalls.values()), F.lit(0.0))
    out = {
        "qwk": kappa_from_sums(*[col(c) for c in ("n", "s_y", "s_p", "s_yy", "s_pp", "s_d2")]),
        "mae": col("s_abs") / col("n"),
        "macro_f1": sum(f1_parts, F.lit(0.0)) / F.lit(float(len(classes))),
        "balanced_accuracy": _ratio(recall_total, seen, None),
        "accuracy": _ratio(col("hit"), col("n"), None),
        "exact_or_adjacent": _ratio(col("near"), col("n"), None),
        "severe_recall": _ratio(col("tp"), col("tp") + col("fn")),
        "severe_precision": _ratio(col("tp"), col("tp") + col("fp")),
        "severe_f1": _ratio(
            F.lit(2.0) * col("tp"), F.lit(2) * col("tp") + col("fn") + col("fp")
        ),
        "severe_missed": col("fn").cast("double"),
        "non_severe_progressed": col("fp").cast("double"),
    }
    out.update({f"recall_{c}": r for c, r in recalls.items()})
    if with_proba:
        out["severe_brier"] = col("s_brier") / col("n")
        out["log_loss"] = col("s_log") / col("n")
    return out


def point_metrics(
    df: DataFrame,
    y: str = "y",
    pred: str = "pred",
    proba: str | None = None,
    *,
    by: Sequence[str] = (),
    classes: Sequence[int] = CLASSES,
    cut: int = CUT,
) -> DataFrame:
    """Every metric that does not need sorted order, one row per group, one aggregate."""
    column = F.col(proba) if proba else None
    sums = df.groupBy(*by).agg(
        *[a.alias(n) for n, a in _sums(F.col(y), F.col(pred), classes, cut, column).items()]
    )
    made = _finish(classes, proba is not None)
    return sums.select(*by, "n", *[e.alias(n) for n, e in made.items()])


def ranking_metrics(
    df: DataFrame,
    positive: Column,
    score: str,
    *,
    by: Sequence[str] = (),
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """ROC AUC (ties at average rank) and average precision (step sum), one row per group."""
    weights = {"pos": positive.cast("bigint"), "neg": (~positive).cast("bigint")}
    cum = cumulative(df, score, weights, by, window_rows=window_rows)
    pos, neg = F.col("pos"), F.col("neg")
    all_pos, all_neg = F.max("pos_total"), F.max("neg_total")
    wins = F.sum(pos * (F.col("neg_before") + neg / F.lit(2.0)))
    above_pos = F.col("pos_total") - F.col("pos_before")
    above_neg = F.col("neg_total") - F.col("neg_before")
    steps = F.sum(pos * (above_pos / (above_pos + above_neg)))
    return cum.groupBy(*by).agg(
        F.when((all_pos > 0) & (all_neg > 0), wins / all_pos / all_neg).alias("severe_roc_auc"),
        F.when(all_pos > 0, steps / all_pos).alias("severe_pr_auc"),
    )


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two small per-group tables; without groups both are single rows."""
    if by:
        return left.join(F.broadcast(right), list(by), "left")
    one = F.lit(1)
    return (
        left.withColumn("_one", one)
        .join(F.broadcast(right.withColumn("_one", one)), "_one", "left")
        .drop("_one")
    )


def compute_metrics(
    df: DataFrame,
    y: str = "y",
    pred: str = "pred",
    proba: str | None = "proba",
    *,
    by: Sequence[str] = (),
    classes: Sequence[int] = CLASSES,
    cut: int = CUT,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """All metrics, one row per group."""
    points = point_metrics(df, y, pred, proba, by=by, classes=classes, cut=cut)
    if proba is None:
        return points
    scored = df.select(
        *by,
        (F.col(y) >= cut).alias("_severe"),
        tail_probability(F.col(proba), classes, cut).alias("_score"),
    )
    ranks = ranking_metrics(
        scored, F.col("_severe"), "_score", by=by, window_rows=window_rows
    )
    return join_groups(points, ranks, by)


def metric_names(df: DataFrame, by: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in (*by, "n")]


def long_metrics(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., metric, value)`` rows."""
    names = metric_names(metrics, by)
    wide = metrics.select(*by, *[F.col(n).cast("double").alias(n) for n in names])
    return wide.unpivot(list(by), names, "metric", "value")


# --- Error structure --------------------------------------------------------------------


def confusion(
    df: DataFrame, y: str = "y", pred: str = "pred", classes: Sequence[int] = CLASSES
) -> DataFrame:
    """Rows ``severity, pred_1 .. pred_K`` for every class, zero-filled."""
    grid = small_table(df.sparkSession, [(int(c),) for c in classes], "severity int")
    cells = {f"pred_{c}": F.count_if(F.col(pred) == c) for c in classes}
    counts = df.groupBy(F.col(y).cast("int").alias("severity")).agg(
        *[cell.alias(name) for name, cell in cells.items()]
    )
    return _zero_filled(counts, grid, "severity")


def boundary_confusion(df: DataFrame, y: str = "y", pred: str = "pred", cut: int = CUT) -> DataFrame:
    """Two rows: true side of the cut, with counts of the predicted side."""
    grid = small_table(df.sparkSession, [(False,), (True,)], "progressed boolean")
    counts = df.groupBy((F.col(y) >= cut).alias("progressed")).agg(
        F.count_if(F.col(pred) < cut).alias("pred_not_progressed"),
        F.count_if(F.col(pred) >= cut).alias("pred_progressed"),
    )
    return _zero_filled(counts, grid, "progressed")


def _zero_filled(counts: DataFrame, grid: DataFrame, key: str) -> DataFrame:
    """Counts for every key of the grid; keys outside the grid are left out.

    Zero rows are added and summed away: no join, so no null filter on a
    computed key is pushed back into (and evaluated again under) the counts.
    """
    names = [c for c in counts.columns if c != key]
    zeros = grid.select(
        key, *[F.lit(0).cast("bigint").alias(n) for n in names], F.lit(1).alias("_grid")
    )
    every = counts.withColumn("_grid", F.lit(0)).unionByName(zeros)
    summed = every.groupBy(key).agg(*[F.sum(n).alias(n) for n in (*names, "_grid")])
    return summed.where(F.col("_grid") > 0).drop("_grid")


def error_analysis(df: DataFrame, y: str = "y", pred: str = "pred", cut: int = CUT) -> DataFrame:
    """``(bucket, n, share)`` of errors by size and direction; the last two overlap the rest."""
    gap = F.col(pred) - F.col(y)
    severe, flagged = F.col(y) >= cut, F.col(pred) >= cut
    buckets = {
        "exact": gap == 0,
        "under_by_1": gap == -1,
        "over_by_1": gap == 1,
        "under_by_2_or_more": gap <= -2,
        "over_by_2_or_more": gap >= 2,
        "crossed_boundary_downwards (severe -> not)": severe & ~flagged,
        "crossed_boundary_upwards (not -> severe)": ~severe & flagged,
    }
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(c).alias(b) for b, c in buckets.items()]
    )
    return row.unpivot(["_rows"], list(buckets), "bucket", "n").select(
        "bucket", "n", F.bround(F.col("n") / F.col("_rows"), 4).alias("share")
    )


def calibration_table(df: DataFrame, positive: Column, score: str, bins: int = 10) -> DataFrame:
    """Reliability per equal-width bin of the predicted probability; empty bins are absent."""
    place = F.greatest(
        F.lit(0), F.least(F.lit(bins - 1), F.floor(F.col(score) * bins).cast("int"))
    )
    return (
        df.groupBy(place.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(score).alias("mean_predicted"),
            F.avg(positive.cast("double")).alias("observed_rate"),
        )
        .withColumn("gap", F.bround(F.col("observed_rate") - F.col("mean_predicted"), 4))
    )


def subgroup_performance(
    df: DataFrame,
    columns: Sequence[str],
    y: str = "y",
    pred: str = "pred",
    *,
    cut: int = CUT,
    min_size: int = 20,
) -> DataFrame:
    """Severe rate, recall, precision and kappa per level of each column."""
    long = df.select(y, pred, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [y, pred], list(columns), "column", "level"
    )
    sums = long.groupBy("column", F.coalesce("level", F.lit("(missing)")).alias("level")).agg(
        *[a.alias(k) for k, a in _sums(F.col(y), F.col(pred), (), cut, None).items()],
        F.min(y).alias("low"),
        F.max(y).alias("high"),
    )
    severe = F.col("tp") + F.col("fn")
    kappa = kappa_from_sums(*[F.col(c) for c in ("n", "s_y", "s_p", "s_yy", "s_pp", "s_d2")])
    return sums.where(F.col("n") >= min_size).select(
        "column",
        "level",
        "n",
        (severe / F.col("n")).alias("severe_rate"),
        _ratio(F.col("tp"), severe, None).alias("severe_recall"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp"), None).alias("severe_precision"),
        F.when(F.col("low") < F.col("high"), kappa).alias("qwk"),
    )


def weakest_subgroup(table: DataFrame) -> DataFrame:
    """Lowest subgroup recall."""
    return table.agg(F.min("severe_recall").alias("min_severe_recall"))


# --- Tables of results --------------------------------------------------------------------


def fold_summary(folds: DataFrame, by: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of every metric over folds, one wide row per group."""
    names = [c for c in folds.columns if c not in (*by, *skip, "n")]
    return folds.groupBy(*by).agg(
        *[F.avg(c).alias(c) for c in names], *[F.stddev_samp(c).alias(f"{c}_std") for c in names]
    )


def gain_over_previous(ladder: DataFrame, rung: str = "rung", metric: str = "qwk") -> DataFrame:
    steps = Window.partitionBy(F.lit(0)).orderBy(rung)  # a handful of rungs
    return ladder.withColumn(
        "qwk_gain_vs_previous", F.bround(F.col(metric) - F.lag(metric).over(steps), 4)
    )
