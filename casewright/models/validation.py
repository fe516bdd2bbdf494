"""Cross-validation, comparison, tuning, calibration and robustness around the families."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.probability import (
    argmax_class,
    hash_normal,
    hash_uniform,
)
from casewright.models import baselines, families
from casewright.models.families import Scorer, in_parallel, registry_table
from casewright.models.isotonic import Curve, isotonic_curves
from casewright.operators import metrics as M
from casewright.operators import splits
from casewright.operators.features import FeatureSpec
from casewright.session import ensure_staged, small_table, staged


def with_folds(
    df: DataFrame, key: str, label: str, *, k: int = 5, repeats: int = 3, seed: int = 42
) -> tuple[DataFrame, list[str]]:
    """Stage the table once with its fold columns; every fold's fit reads from it."""
    rows = ensure_staged(df)
    folded = splits.repeated_stratified_folds(rows, key, label, k=k, repeats=repeats, seed=seed)
    return staged(folded), [f"fold_{r}" for r in range(repeats)]


def out_of_fold(
    folded: DataFrame,
    family: str,
    spec: FeatureSpec,
    label: str,
    key: str,
    fold_columns: Sequence[str],
    k: int,
    *,
    classes: Sequence[int] = M.CLASSES,
    params: Mapping[str, Any] | None = None,
    seed: int = 42,
    scorer=None,
) -> DataFrame:
    """``(id, repeat, fold, y, proba)`` of a family, or of ``scorer(rows, seed)``."""
    return families.out_of_fold(
        folded, family, spec, label, key, fold_columns, k, classes=classes, seed=seed, params=params, fit=scorer
    )


def fold_metrics(
    oof: DataFrame, classes: Sequence[int] = M.CLASSES, cut: int = M.CUT
) -> DataFrame:
    """All metrics per repeat and fold, from one pass over the out-of-fold rows."""
    scored = oof.withColumn("pred", argmax_class(F.col("proba"), classes))
    return M.compute_metrics(scored, by=["repeat", "fold"], classes=classes, cut=cut)


def spec_metrics(
    folded: DataFrame,
    family: str,
    specs: Sequence[FeatureSpec],
    label: str,
    key: str,
    fold_columns: Sequence[str],
    k: int,
    *,
    classes: Sequence[int] = M.CLASSES,
    cut: int = M.CUT,
    params: Mapping[str, Any] | None = None,
    seed: int = 42,
    scorer=None,
) -> DataFrame:
    """All metrics per feature set (its position ``spec``), repeat and fold."""
    oof = families.out_of_fold_specs(
        folded, family, specs, label, key, fold_columns, k, classes=classes, seed=seed, params=params, fit=scorer
    )
    scored = staged(oof).withColumn("pred", argmax_class(F.col("proba"), classes))
    return staged(M.compute_metrics(scored, by=["spec", "repeat", "fold"], classes=classes, cut=cut))


def averaged(oof: DataFrame, n_classes: int) -> DataFrame:
    """One row per id: probabilities averaged over repeats."""
    means = [F.avg(F.get("proba", F.lit(i))) for i in range(n_classes)]
    return oof.groupBy(F.col("id")).agg(F.first("y").alias("y"), F.array(*means).alias("proba"))


def cross_validate(
    df: DataFrame,
    family: str,
    spec: FeatureSpec,
    label: str,
    key: str,
    *,
    k: int = 5,
    repeats: int = 3,
    seed: int = 42,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """(fold metrics with the model name, out-of-fold rows); the latter staged."""
    folded, columns = with_folds(df, key, label, k=k, repeats=repeats, seed=seed)
    oof = staged(out_of_fold(folded, family, spec, label, key, columns, k, seed=seed, **options))
    return fold_metrics(oof).withColumn("model", F.lit(family)), oof


def run_families(
    df: DataFrame,
    names: Sequence[str],
    spec: FeatureSpec,
    label: str,
    key: str,
    *,
    k: int = 5,
    repeats: int = 3,
    seed: int = 42,
    params: Mapping[str, Mapping[str, Any]] | None = None,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fold metrics of several families on the same folds, and each one's out-of-fold rows.

    The table is staged once with its folds; all families read from it.
    """
    folded, columns = with_folds(df, key, label, k=k, repeats=repeats, seed=seed)
    oof, folds = {}, []
    for name in names:
        options = (params or {}).get(name)
        oof[name] = staged(
            out_of_fold(folded, name, spec, label, key, columns, k, seed=seed, params=options)
        )
        folds.append(fold_metrics(oof[name]).withColumn("model", F.lit(name)))
    return staged(reduce(DataFrame.unionByName, folds)), oof


def compare_families(
    folds: Sequence[DataFrame], metric: str = "qwk"
) -> DataFrame:
    """Summaries of several families with their registry labels, best first."""
    everything = reduce(DataFrame.unionByName, folds)
    summary = M.fold_summary(everything, ["model"], ["repeat", "fold"])
    return with_registry(summary).orderBy(F.desc(metric), "model")


def with_registry(comparison: DataFrame) -> DataFrame:
    """Label, ordinal flag and complexity per row; tuned rows borrow their family's."""
    tuned = F.col("model").endswith("_tuned")
    base = comparison.withColumn("_family", F.regexp_replace("model", "_tuned$", ""))
    known = registry_table(comparison.sparkSession).select(
        F.col("model").alias("_family"), F.col("label").alias("_label"), "ordinal_aware", "complexity"
    )
    joined = base.join(F.broadcast(known), "_family", "left")
    label = F.concat(F.col("_label"), F.when(tuned, " (tuned)").otherwise(""))
    return joined.withColumn("label", label).drop("_family", "_label")


def select_model(
    comparison: DataFrame,
    *,
    metric: str = "qwk",
    n_folds: int = 15,
    tolerance_se: float = 1.0,
    floor: float = 0.005,
    rule: str = "one_se",
    fixed: str | None = None,
) -> DataFrame:
    """One row: the chosen model, how many were near the best, and the tolerance.

    One-standard-error rule with a practical floor; the simplest model within
    the tolerance wins, ties by the metric.  ``rule="best"`` takes the top row.
    """
    whole = Window.partitionBy(F.lit(0))  # over one row per candidate
    top = whole.orderBy(F.desc(metric), "model").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    se = F.first(f"{metric}_std").over(top) / F.sqrt(F.lit(float(n_folds)))
    ranked = comparison.select(
        "model",
        metric,
        "complexity",
        F.first("model").over(top).alias("best_model"),
        F.first(metric).over(top).alias("_best"),
        F.greatest(F.lit(float(tolerance_se)) * se, F.lit(float(floor))).alias("tolerance"),
    )
    if fixed:
        chosen = ranked.where(F.col("model") == fixed)
    elif rule == "best":
        chosen = ranked.where(F.col("model") == F.col("best_model"))
    else:
        chosen = ranked.where(F.col(metric) >= F.col("_best") - F.col("tolerance"))
    return (
        chosen.withColumn("n_within", F.count(F.lit(1)).over(whole))
        .orderBy("complexity", F.desc(metric), "model")
        .limit(1)
        .select("model", metric, "complexity", "best_model", "tolerance", "n_within")
    )


# --- Tuning -----------------------------------------------------------------------------------


def draw_trials(
    space: Mapping[str, tuple[float, float, str]], n: int, seed: int = 42
) -> list[dict[str, Any]]:
    """Seeded random candidates from a search space; the same list for the same seed."""
    rng = random.Random(seed)

    def draw(low: float, high: float, scale: str):
        u = rng.random()
        if scale == "log":
            return math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
        if scale == "linear":
            return low + u * (high - low)
        step = 50 if scale == "step50" else 1
        return int(low + step * int(u * (int((high - low) // step) + 1)))

    return [{name: draw(*limits) for name, limits in space.items()} for _ in range(n)]


def trial_log(trials: DataFrame) -> DataFrame:
    """Adds the best kappa so far, in trial order (and rung order, where there are rungs)."""
    order = Window.partitionBy("model").orderBy(*[c for c in ("rung", "trial") if c in trials.columns])
    return trials.withColumn(
        "best_so_far",
        F.max("cv_qwk").over(order.rowsBetween(Window.unboundedPreceding, 0)),
    )


# Rounds at which trials are compared and the worse half is dropped.
RUNGS = (3, 6, 12)


def tune_family(
    df: DataFrame,
    family: str,
    spec: FeatureSpec,
    label: str,
    key: str,
    *,
    trials: Sequence[Mapping[str, Any]],
    k: int = 5,
    seed: int = 42,
    rungs: Sequence[int] = RUNGS,
    classes: Sequence[int] = M.CLASSES,
    cut: int = M.CUT,
) -> DataFrame:
    """Successive halving: ``(model, rung, trial, rounds, params, n, cv_qwk, cv_severe_recall, kept, best_so_far)``.

    All trials share the staged folds, the bins and every pass. At each rung the
    live trials are measured on the rows their folds left out (mean of the fold
    values) and the worse half is dropped, of equals the later ones; a row is
    kept of every measurement. Each trial is fitted with the values it was drawn
    with; a model that stopped by itself before a rung is measured as it is.
    """
    folded, columns = with_folds(df, key, label, k=k, repeats=1, seed=seed)
    boosted = families.FAMILIES[family].boosted
    series, places, masks = boosted.trials(
        folded, spec, label, key, columns, k, trials, classes=classes, seed=seed
    )
    width, live, rows = len(classes), list(range(len(trials))), []
    for rung, rounds in enumerate(rungs):
        series.advance(rounds)
        models = [[series.model(places[m][t]) for t in live] for m in range(len(masks))]
        held = staged(families.score_held_out(series.table, models, masks, classes))
        values = F.array(
            *[
                F.struct(F.lit(t).alias("trial"), F.slice("outputs", 1 + i * width, width).alias("proba"))
                for i, t in enumerate(live)
            ]
        )
        long = held.select("fold", "y", F.inline(values))
        scored = long.withColumn("pred", argmax_class(F.col("proba"), classes))
        found = M.point_metrics(scored, by=["trial", "fold"], classes=classes, cut=cut)
        means = found.groupBy("trial").agg(
            F.sum("n").alias("n"), F.avg("qwk").alias("qwk"), F.avg("severe_recall").alias("recall")
        )
        measured = {r["trial"]: r for r in means.collect()}  # a row per trial
        ranked = sorted(live, key=lambda t: (-(measured[t]["qwk"] or 0.0), t))
        stay = ranked if rung + 1 == len(rungs) else ranked[: -(-len(live) // 2)]
        for t in live:
            made = max(len(series.tasks[own[t]].rounds) for own in places)
            m = measured[t]
            rows.append(
                (family, rung, t, made, json.dumps(dict(trials[t])), int(m["n"]), m["qwk"], m["recall"], t in stay)
            )
        series.drop([own[t] for own in places for t in live if t not in stay])
        live = sorted(stay)
    schema = (
        "model string, rung int, trial int, rounds int, params string, n bigint, "
        "cv_qwk double, cv_severe_recall double, kept boolean"
    )
    return trial_log(small_table(df.sparkSession, rows, schema))


def best_params(log: DataFrame, trials: Sequence[Mapping[str, Any]]) -> dict[str, Any]:
    """The drawn parameters of the best trial of the last rung, the first of equals."""
    best = log.orderBy(F.desc("rung"), F.desc("cv_qwk"), "trial").select("trial").first()
    return dict(trials[best["trial"]])


def top_trials(trials: DataFrame, n: int = 5) -> DataFrame:
    """Best ``n`` trials per model (a report top-n), and which one is the best."""
    order = Window.partitionBy("model").orderBy(F.desc("cv_qwk"), "trial")
    ranked = trials.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= n).withColumn("is_best", F.col("rank") == 1)


# --- Ladder, ablation, regimes ----------------------------------------------------------------

LADDER_METRICS = ("qwk", "mae", "macro_f1", "severe_recall", "severe_precision")


def mean_metrics(folds: DataFrame, names: Sequence[str]) -> DataFrame:
    return folds.agg(*[F.avg(n).alias(n) for n in names])


def baseline_ladder(
    df: DataFrame,
    spec: FeatureSpec,
    raw_spec: FeatureSpec,
    rule_feature: str,
    label: str,
    key: str,
    *,
    k: int = 5,
    seed: int = 42,
    params: Mapping[str, Mapping[str, Any]] | None = None,
) -> DataFrame:
    """Cross-validated metrics of six approaches of rising effort, with the gain of each step."""
    params = params or {}
    folded, columns = with_folds(df, key, label, k=k, repeats=1, seed=seed)

    def run(family: str, use: FeatureSpec, scorer=None) -> DataFrame:
        oof = out_of_fold(
            folded, family, use, label, key, columns, k,
            seed=seed, params=params.get(family), scorer=scorer,
        )
        return fold_metrics(oof)

    rungs = [
        ("majority class", run("", spec, lambda rows, s: baselines.fit_majority(rows, label))),
        (
            "single-feature rule",
            run("", spec, lambda rows, s: baselines.fit_one_feature_rule(rows, rule_feature, label)),
        ),
        ("logistic, raw columns", run("logistic", raw_spec)),
        ("logistic, engineered features", run("logistic", spec)),
        ("ordered logit, engineered features", run("ordered_logit", spec)),
        ("boosted trees, engineered features", run("lightgbm", spec)),
    ]
    rows = [
        mean_metrics(folds, LADDER_METRICS).select(
            F.lit(i).alias("rung"), F.lit(name).alias("approach"), *LADDER_METRICS
        )
        for i, (name, folds) in enumerate(rungs)
    ]
    return M.gain_over_previous(reduce(DataFrame.unionByName, rows))


def ablation(
    df: DataFrame,
    family: str,
    spec: FeatureSpec,
    label: str,
    key: str,
    groups: Sequence[str],
    *,
    k: int = 5,
    seed: int = 42,
    **options,
) -> DataFrame:
    """Metrics without each feature block, and their change, on the folds of a single repeat.

    All variants are fitted and scored in shared passes where the family can.
    """
    folded, columns = with_folds(df, key, label, k=k, repeats=1, seed=seed)
    variants = [("(none)", spec)]
    variants += [(g, spec.without_groups(g)) for g in groups if spec.in_group(g)]
    folds = spec_metrics(folded, family, [use for _, use in variants], label, key, columns, k, seed=seed, **options)
    names = ("qwk", "severe_recall", "macro_f1")
    table = folds.groupBy("spec").agg(*[F.avg(n).alias(n) for n in names]).select(
        F.get(F.array(*[F.lit(name) for name, _ in variants]), F.col("spec")).alias("dropped_group"),
        F.get(F.array(*[F.lit(len(use.columns)) for _, use in variants]), F.col("spec")).alias("n_features"),
        *names,
    )
    whole = Window.partitionBy(F.lit(0))  # a row per variant
    base = F.col("dropped_group") == "(none)"

    def change(metric: str) -> Column:
        return F.bround(F.col(metric) - F.max(F.when(base, F.col(metric))).over(whole), 4)

    return table.withColumns(
        {"delta_qwk": change("qwk"), "delta_severe_recall": change("severe_recall")}
    )


def regime_comparison(runs: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Mean fold metrics per regime from ``{regime: (fold metrics, number of features)}``."""
    names = ("qwk", "mae", "macro_f1", "severe_recall", "severe_pr_auc")
    rows = [
        mean_metrics(folds, names).select(
            F.lit(regime).alias("regime"), F.lit(n).alias("n_features"), *names
        )
        for regime, (folds, n) in runs.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def monotone_comparison(
    df: DataFrame,
    spec: FeatureSpec,
    label: str,
    key: str,
    directions: Mapping[str, int],
    *,
    k: int = 5,
    seed: int = 42,
    classes: Sequence[int] = M.CLASSES,
    cut: int = M.CUT,
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """``(variant, n_constrained, cv_qwk_mean, cv_qwk_std)`` without and with monotone columns.

    The model is the ordinal decomposition: each chance of a class above k is
    itself one output, so a direction (1 rises, -1 falls) holds for all of them.
    Directions of columns that are not numeric features are left out. Both
    variants use the same folds; the deviation is that of the folds (ddof 0).
    """
    folded, columns = with_folds(df, key, label, k=k, repeats=1, seed=seed)
    held = {c: int(d) for c, d in directions.items() if c in spec.numeric and d}
    rows = []
    for variant, bound in (("unconstrained", {}), ("monotone_constrained", held)):
        oof = out_of_fold(
            folded, "frank_hall", spec, label, key, columns, k,
            seed=seed, classes=classes, params={**(params or {}), "monotone": bound},
        )
        folds = fold_metrics(staged(oof), classes, cut)
        rows.append(
            folds.agg(
                F.lit(variant).alias("variant"),
                F.lit(len(bound)).alias("n_constrained"),
                F.avg("qwk").alias("cv_qwk_mean"),
                F.stddev_pop("qwk").alias("cv_qwk_std"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


# --- Calibration ------------------------------------------------------------------------------


class CalibratedModel:
    """Mean over folds of per-class isotonic curves, renormalised."""

    def __init__(self, members: Sequence[tuple[Scorer, Sequence[Curve]]], classes: Sequence[int]):
        self.members = list(members)
        self.classes = list(classes)

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        """Rows without probabilities, or with a null or NaN among them, get null."""
        n = len(self.classes)
        curves = [list(own) for _, own in self.members]

        @F.pandas_udf("array<double>")
        def calibrated(raw: pd.Series) -> pd.Series:
            if not len(raw):
                return raw
            stacked = np.stack([np.asarray(v, dtype=float) for v in raw]).reshape(len(raw), len(curves), n)
            mean = np.zeros((len(raw), n))
            for m, own in enumerate(curves):
                value = np.column_stack([curve.at(stacked[:, m, i]) for i, curve in enumerate(own)])
                total = value.sum(axis=1, keepdims=True)
                # All-zero curves fall back to equal shares.
                mean += np.where(total > 0, value / np.where(total > 0, total, 1.0), 1.0 / n)
            rows = list(mean / len(curves))
            gaps = np.isnan(stacked).any(axis=(1, 2))
            return pd.Series([None if gap else row for gap, row in zip(gaps, rows)])

        wide, made = df, []
        for m, (model, _) in enumerate(self.members):
            made.append(f"_raw{m}")
            wide = model.score(wide, made[-1])
        filled = F.transform(F.flatten(F.array(*made)), lambda v: F.coalesce(v, F.lit(float("nan"))))
        empty = F.array_repeat(F.lit(float("nan")), n * len(made))
        return wide.withColumn(out, calibrated(F.coalesce(filled, empty))).drop(*made)


def fit_calibrated(
    df: DataFrame,
    fit,
    label: str,
    key: str,
    *,
    classes: Sequence[int] = M.CLASSES,
    k: int = 5,
    seed: int = 42,
    fit_folds=None,
) -> CalibratedModel:
    """Fit on k-1 folds, learn one isotonic curve per class on the fold left out.

    ``fit_folds(rows, fold column, k)`` fits the models of all folds together; without
    it ``fit`` is called on the rows of each. The curves of all folds and classes come
    from one series of jobs.
    """
    folded = staged(splits.stratified_folds(df, key, label, k=k, seed=seed, name="_fold"))
    models = fit_folds(folded, "_fold", k) if fit_folds else in_parallel([lambda f=f: fit(folded.where(F.col("_fold") != f)) for f in range(k)])
    held = [
        model.score(folded.where(F.col("_fold") == f)).select("_fold", F.col(label).cast("int").alias("y"), "proba")
        for f, model in enumerate(models)
    ]
    cells = [
        F.struct(
            F.lit(i).alias("_class"),
            F.get("proba", F.lit(i)).alias("x"),
            (F.col("y") == c).cast("double").alias("t"),
        )
        for i, c in enumerate(classes)
    ]
    long = reduce(DataFrame.unionByName, held).select("_fold", F.explode(F.array(*cells)).alias("c"))
    curves = isotonic_curves(long.select("_fold", "c.*"), "x", "t", ["_fold", "_class"])
    nothing = Curve((), ())
    return CalibratedModel(
        [(model, [curves.get((f, i), nothing) for i in range(len(classes))]) for f, model in enumerate(models)],
        classes,
    )


def calibration_summary(variants: Mapping[str, DataFrame], cut: int = M.CUT) -> DataFrame:
    """Brier score and log loss per named scored table ``(y, proba)``."""
    rows = []
    for name, df in variants.items():
        scored = df.withColumn("pred", F.col("y"))
        points = M.point_metrics(scored, proba="proba", cut=cut)
        rows.append(points.select(F.lit(name).alias("variant"), "severe_brier", "log_loss"))
    return reduce(DataFrame.unionByName, rows)


# --- Robustness --------------------------------------------------------------------------------

ROBUST_METRICS = ("qwk", "macro_f1", "severe_recall", "severe_pr_auc")


def _rescored(
    df: DataFrame,
    changed: Mapping[str, Column],
    scenarios: Sequence[float],
    name: str,
    model: Scorer,
    label: str,
    classes: Sequence[int],
    cut: int,
) -> DataFrame:
    """Every scenario's copy of the rows, changed, scored and measured in one grouped job."""
    copies = df.withColumn(name, F.explode(F.array(*[F.lit(float(s)) for s in scenarios])))
    kept = [c for c in copies.columns if c not in changed]
    altered = copies.select(*kept, *[v.alias(c) for c, v in changed.items()])
    scored = model.score(altered).select(
        name,
        F.col(label).cast("int").alias("y"),
        argmax_class(F.col("proba"), classes).alias("pred"),
        "proba",
    )
    scored = staged(scored)  # measured in several passes
    table = M.compute_metrics(scored, by=[name], classes=classes, cut=cut)
    return table.select(name, "n", *ROBUST_METRICS)


def blanked_cells(spec: FeatureSpec, key: str, fraction: Column, seed: int = 42) -> dict[str, Column]:
    """Every feature cell, null with chance ``fraction`` by a draw on its id and column."""
    return {c: F.when(hash_uniform(seed, F.col(key), F.lit(c)) >= fraction, F.col(c)) for c in spec.columns}


def spreads(df: DataFrame, spec: FeatureSpec) -> dict[str, float | None]:
    """Deviation of every numeric column."""
    return df.agg(*[F.stddev_samp(c).alias(c) for c in spec.numeric]).first().asDict()


def noisy_cells(
    df: DataFrame, spec: FeatureSpec, key: str, scale: Column, seed: int = 42, spread: Mapping[str, float | None] | None = None
) -> dict[str, Column]:
    """Every numeric cell that varies, plus a normal draw of ``scale`` deviations of its column.

    ``spread`` is that of ``spreads(df, spec)`` where it is known.
    """
    spread = spreads(df, spec) if spread is None else spread
    return {
        c: F.col(c) + hash_normal(seed, F.col(key), F.lit(c), scale) * scale * F.lit(float(spread[c]))
        for c in spec.numeric
        if spread[c]
    }


def missingness_injection(
    df: DataFrame,
    model: Scorer,
    spec: FeatureSpec,
    label: str,
    key: str,
    *,
    fractions: Sequence[float] = (0.10, 0.20, 0.30),
    seed: int = 42,
    classes: Sequence[int] = M.CLASSES,
    cut: int = M.CUT,
) -> DataFrame:
    """Blank each feature cell with a given chance and measure again.

    A cell's draw depends on its id and column, so the cells blanked at 10 % are
    blanked at 20 % too, and the result does not depend on partitioning.
    """
    name = "missing_fraction"
    changed = blanked_cells(spec, key, F.col(name), seed)
    return _rescored(df, changed, (0.0, *fractions), name, model, label, classes, cut)


def noise_perturbation(
    df: DataFrame,
    model: Scorer,
    spec: FeatureSpec,
    label: str,
    key: str,
    *,
    scales: Sequence[float] = (0.1, 0.2, 0.5),
    seed: int = 42,
    classes: Sequence[int] = M.CLASSES,
    cut: int = M.CUT,
    spread: Mapping[str, float | None] | None = None,
) -> DataFrame:
    """Add seeded Gaussian noise, a multiple of each numeric column's deviation."""
    name = "noise_scale"
    changed = noisy_cells(df, spec, key, F.col(name), seed, spread)
    return _rescored(df, changed, (0.0, *scales), name, model, label, classes, cut)
