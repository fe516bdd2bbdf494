"""Candidate model families, each fitted on a feature frame and scored as columns.

Every family returns an object with ``score(df, out)`` that adds an array of
class probabilities, so cross-validation, calibration and explanation treat all
of them alike.  Imputation, encoding and scaling are fitted inside ``fit``.
Families with a ``cross`` fit all folds and repeats in shared passes, those with
``cross_specs`` several feature sets as well.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.functions.probability import FLOOR, count_below, share_of_total
from casewright.models import forest, ordered_logit, softmax
from casewright.models.boosting import (
    Boosted,
    Options,
    Problem,
    fit_boosted,
    open_series,
    score_held_out,
)
from casewright.operators import splits
from casewright.operators.features import FeatureSpec
from casewright.operators.metrics import CLASSES
from casewright.operators.prep import Preprocessor, fit_preprocessor
from casewright.session import ensure_staged, small_table, staged

# Independent fits submitted to Spark at the same time.
PARALLEL_FITS = 4


class Scorer(Protocol):
    def score(self, df: DataFrame, out: str = "proba") -> DataFrame: ...


def in_parallel(calls: Sequence[Callable[[], Any]], width: int = PARALLEL_FITS) -> list[Any]:
    """Run driver-side fits side by side; each is its own set of Spark jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(width, len(calls) or 1))) as pool:
        return [f.result() for f in [pool.submit(c) for c in calls]]


def training_table(
    df: DataFrame,
    spec: FeatureSpec,
    label: str,
    classes: Sequence[int],
    *,
    scaled: bool,
    balanced: bool = True,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, Preprocessor]:
    """Staged ``(keep..., severity, label, weight, features)`` and its preprocessor.

    ``label`` is the 0-based position of the class; weights are balanced.
    """
    df = ensure_staged(df)  # fitted statistics and the training rows both read it
    prep = fit_preprocessor(df, spec, scaled=scaled)
    place = F.array_position(F.array(*[F.lit(int(c)) for c in classes]), F.col(label).cast("int"))
    rows = df.where(F.col(label).isNotNull()).select(
        *keep,
        F.col(label).cast("int").alias("severity"),
        (place - 1).cast("double").alias("label"),
        array_to_vector(prep.array()).alias("features"),
    )
    if balanced:
        rows = splits.with_class_weight(rows, "severity")
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    return staged(rows), prep


def _vectors(df: DataFrame, prep: Preprocessor) -> DataFrame:
    return df.withColumn("_features", array_to_vector(prep.array()))


def _scored(model: Any, df: DataFrame, probability: str) -> DataFrame:
    """Transform with private column names, so several models can be chained."""
    params = {model.featuresCol: "_features", model.predictionCol: "_prediction"}
    if model.hasParam("probabilityCol"):
        params |= {model.probabilityCol: probability, model.rawPredictionCol: "_raw"}
        return model.transform(df, params).drop("_raw", "_prediction")
    params[model.predictionCol] = probability
    return model.transform(df, params)


# --- Multinomial families -----------------------------------------------------------------


@dataclass(frozen=True)
class Multinomial:
    """A Spark ML classifier whose probability vector is in class order."""

    prep: Preprocessor
    model: Any

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        scored = _scored(self.model, _vectors(df, self.prep), "_probability")
        return scored.withColumn(out, vector_to_array("_probability")).drop(
            "_features", "_probability"
        )


def _logistic_options(params: Mapping[str, Any] | None) -> dict[str, Any]:
    options = {"C": 0.5, "maxIter": 500, "tol": 1e-9, "balanced": True, **(params or {})}
    return {"c": options["C"], "max_iter": options["maxIter"], "tol": options["tol"], "even": options["balanced"]}


def fit_logistic(df, spec, label, key, *, classes=CLASSES, seed=42, params=None) -> softmax.SoftmaxScorer:
    """Multinomial logistic, ridge of strength 1/C on the total loss, balanced weights."""
    return softmax.fit_softmax(df, spec, label, classes, **_logistic_options(params))


def cross_logistic(df, spec, label, key, folds, k, *, classes=CLASSES, seed=42, params=None) -> DataFrame:
    return softmax.cross_softmax(df, spec, label, key, folds, k, classes, **_logistic_options(params))[0]


def fit_random_forest(df, spec, label, key, *, classes=CLASSES, seed=42, params=None) -> forest.Forest:
    names = {"numTrees": "trees", "maxDepth": "depth", "maxBins": "bins", "minInstancesPerNode": "min_rows"}
    options = forest.ForestOptions(**{names[k]: v for k, v in (params or {}).items()})
    return forest.fit_forest(df, spec, label, key, classes, options, seed)


# --- Boosted families ---------------------------------------------------------------------------

# The presets. A round is a pass a level over the data, so they take larger steps and fewer
# rounds than is usual on one machine, stop when held-out loss stops falling, and best-first
# trees are at most six splits deep.
HIST_GB = Options(leaves=15, depth=6, min_rows=15)
XGBOOST = Options(leaves=None, depth=4, min_rows=1, min_weight=3.0, row_share=0.8, column_share=0.8)
LIGHTGBM = Options(leaves=15, depth=6, min_rows=15, row_share=0.8, column_share=0.8)
SMALL_GB = Options(rounds=50, leaves=15, depth=6, min_rows=15)


def softmax_problem(classes: Sequence[int]) -> Problem:
    return Problem("softmax", tuple(float(i) for i in range(len(classes))))


@dataclass(frozen=True)
class BoostedFamily:
    """Multiclass boosted trees; ``params`` replace fields of the preset."""

    preset: Options

    def trials(
        self, df, spec, label, key, folds, k, trials: Sequence[Mapping[str, Any]], *, classes=CLASSES, seed=42
    ) -> tuple[Any, list[list[int]], list[tuple[int, int]]]:
        """A series of every trial on every fold, not yet grown; places ``[fold][trial]`` and the folds."""
        masks = fold_masks(folds, k)
        options = [replace(self.preset, **t) for t in trials]
        series, places, _ = open_series(
            df, spec, label, key, [softmax_problem(classes)] * len(options), options,
            classes=classes, masks=masks, folds=folds, seed=seed,
        )
        return series, places, masks

    def fit(self, df, spec, label, key, *, classes=CLASSES, seed=42, params=None) -> Boosted:
        options = replace(self.preset, **(params or {}))
        models, _ = fit_boosted(
            df, spec, label, key, [softmax_problem(classes)], [options], classes=classes, seed=seed
        )
        return models[0][0]

    def cross(self, df, spec, label, key, folds, k, *, classes=CLASSES, seed=42, params=None) -> DataFrame:
        options = replace(self.preset, **(params or {}))
        masks = fold_masks(folds, k)
        models, table = fit_boosted(
            df, spec, label, key, [softmax_problem(classes)], [options],
            classes=classes, masks=masks, folds=folds, seed=seed,
        )
        return score_held_out(table, models, masks, classes).withColumnRenamed("outputs", "proba")


def fold_masks(folds: Sequence[str], k: int) -> list[tuple[int, int]]:
    return [(r, f) for r in range(len(folds)) for f in range(k)]


# --- Frank and Hall -----------------------------------------------------------------------


def recombine(exceed: Sequence[Column]) -> Column:
    """Class probabilities from P(y > k): running minimum, differences, floor, normalise."""
    falling = [F.least(*exceed[: i + 1]) if i else exceed[0] for i in range(len(exceed))]
    parts = [F.lit(1.0) - falling[0]]
    parts += [a - b for a, b in zip(falling, falling[1:])]
    parts.append(falling[-1])
    return share_of_total(F.array(*[F.greatest(p, F.lit(FLOOR)) for p in parts]))


def exceedance_problems(classes: Sequence[int]) -> list[Problem]:
    """One binary problem for each class but the last: more severe than it."""
    known = sorted(classes)
    return [Problem("logistic", tuple(float(c > cut) for c in known)) for cut in known[:-1]]


@dataclass(frozen=True)
class FrankHall:
    """K-1 binary models of "more severe than k"; a constant stands in for a one-sided fold."""

    models: tuple[Any, ...]

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        wide, exceed, made = df, [], []
        for i, model in enumerate(self.models):
            if isinstance(model, float):
                exceed.append(F.lit(model))
                continue
            made.append(f"_p{i}")
            wide = model.score(wide, made[-1])
            exceed.append(F.get(made[-1], F.lit(0)))
        return wide.withColumn(out, recombine(exceed)).drop(*made)


def fit_frank_hall(df, spec, label, key, *, classes=CLASSES, seed=42, params=None) -> FrankHall:
    """All binary models are grown in one series of passes."""
    problems = exceedance_problems(classes)
    options = [replace(SMALL_GB, **(params or {}))] * len(problems)
    models, _ = fit_boosted(df, spec, label, key, problems, options, classes=classes, seed=seed)
    return FrankHall(tuple(models[0]))


def cross_frank_hall(df, spec, label, key, folds, k, *, classes=CLASSES, seed=42, params=None) -> DataFrame:
    problems, masks = exceedance_problems(classes), fold_masks(folds, k)
    options = [replace(SMALL_GB, **(params or {}))] * len(problems)
    models, table = fit_boosted(
        df, spec, label, key, problems, options, classes=classes, masks=masks, folds=folds, seed=seed
    )
    scored = score_held_out(table, models, masks, classes)
    proba = recombine([F.get("outputs", F.lit(i)) for i in range(len(problems))])
    return scored.withColumn("proba", proba).drop("outputs")


# --- Regression with learned cut-points -----------------------------------------------------


def candidate_kappas(
    df: DataFrame, y: str, score: str, cuts: Sequence[float], position: int, trials: Sequence[float]
) -> list[float | None]:
    """Kappa of each trial value for one cut, from one histogram of the scores.

    Rows fall between the fixed cuts and the trial values; the histogram has at
    most (cuts + trials + 1) x classes rows, and all trials are read off it.
    """
    fixed = [c for i, c in enumerate(cuts) if i != position]
    edges = sorted({*fixed, *trials})
    hist = (
        df.groupBy(count_below(F.col(score), edges).alias("b"), F.col(y).cast("int").alias("y"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    out = []
    for value in trials:
        chosen = sorted([*fixed, value])
        # A row in bucket b lies above the first b edges.
        rank = [sum(c in edges[:b] for c in chosen) for b in range(len(edges) + 1)]
        n = sy = sp = syy = spp = sd = 0.0
        for r in hist:
            p = rank[r["b"]] + 1
            n += r["n"]
            sy += r["n"] * r["y"]
            sp += r["n"] * p
            syy += r["n"] * r["y"] ** 2
            spp += r["n"] * p * p
            sd += r["n"] * (r["y"] - p) ** 2
        expected = syy + spp - 2 * sy * sp / n if n else 0.0
        out.append(1 - sd / expected if expected else None)
    return out


def optimise_cuts(
    df: DataFrame, y: str, score: str, cuts: Sequence[float], *, sweeps: int = 3, steps: int = 41
) -> tuple[list[float], float]:
    """Coordinate ascent of kappa: per step one pass, first strict improvement order kept."""
    low, high = df.agg(F.min(score), F.max(score)).first()
    best = [float(c) for c in cuts]
    best_kappa = candidate_kappas(df, y, score, best, 0, [best[0]])[0] or 0.0
    for _ in range(sweeps):
        for i in range(len(best)):
            start = best[i - 1] if i else low
            end = best[i + 1] if i + 1 < len(best) else high
            width = (end - start) / (steps - 1)
            trials = [start + width * j for j in range(1, steps - 1)]
            kappas = candidate_kappas(df, y, score, best, i, trials)
            # The largest kappa, the first of equals, if it beats the current one.
            top, value = max(
                ((k, -j) for j, k in enumerate(kappas) if k is not None), default=(None, 0)
            )
            if top is not None and top > best_kappa:
                best[i], best_kappa = trials[-value], top
    return best, best_kappa


def _erfc_curve() -> np.polynomial.Chebyshev:
    """Smooth part of erfc: log(erfc(x) / t) + x * x over t = 2 / (2 + x), fitted to the exact function."""
    exact = np.vectorize(lambda t: math.log(math.erfc(2 / t - 2) / t) + (2 / t - 2) ** 2)
    return np.polynomial.Chebyshev.interpolate(exact, 40, domain=[2 / 27, 1])


_ERFC = _erfc_curve()


def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of an array, to about twelve digits; 0 beyond 25."""
    size = np.abs(x)
    t = 2 / (2 + np.minimum(size, 25.0))
    upper = np.where(size > 25.0, 0.0, t * np.exp(_ERFC(t) - np.minimum(size, 25.0) ** 2))
    return np.where(x < 0, 2 - upper, upper)


def interval_probabilities(score: Column, cuts: Sequence[float], sigma: float) -> Column:
    """Normal mass of the residual between the cuts, floored and normalised."""
    edges = [float(c) for c in cuts]

    @F.pandas_udf("array<double>")
    def run(values: pd.Series) -> pd.Series:
        z = (np.array(edges)[None, :] - values.to_numpy()[:, None]) / sigma
        below = 0.5 * erfc(-z / math.sqrt(2.0))
        padded = np.hstack([np.zeros((len(z), 1)), below, np.ones((len(z), 1))])
        parts = np.maximum(np.diff(padded, axis=1), FLOOR)
        return pd.Series(list(parts / parts.sum(axis=1, keepdims=True)))

    return run(score)


@dataclass(frozen=True)
class RegressionCuts:
    model: Any
    cuts: tuple[float, ...]
    sigma: float
    kappa: float = 0.0

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        scored = self.model.score(df, "_score").withColumn("_score", F.get("_score", F.lit(0)))
        return scored.withColumn(
            out, interval_probabilities(F.col("_score"), self.cuts, self.sigma)
        ).drop("_score")

    def predict(self, score: Column, classes: Sequence[int] = CLASSES) -> Column:
        return F.get(F.array(*[F.lit(c) for c in classes]), count_below(score, self.cuts))


def fit_regression_cuts(
    df, spec, label, key, *, classes=CLASSES, seed=42, params=None
) -> RegressionCuts:
    """Regress the class, learn cuts on out-of-fold scores, keep their residual spread.

    The models of the inner folds and the one of all rows are grown together.
    """
    options = {"inner_folds": 3, **(params or {})}
    inner = options.pop("inner_folds")
    folded = splits.plain_folds(ensure_staged(df), key, k=inner, seed=seed, name="_inner")
    masks = [(0, f) for f in range(inner)]
    known = sorted(int(c) for c in classes)
    models, table = fit_boosted(
        staged(folded), spec, label, key, [Problem("squared", tuple(float(c) for c in known))],
        [replace(SMALL_GB, **options)], classes=classes, masks=[*masks, None], folds=["_inner"], seed=seed,
    )
    held = score_held_out(table, models[:-1], masks, classes)
    oof = staged(held.select(F.col("y").alias("severity"), F.get("outputs", F.lit(0)).alias("score")))
    middle = [(a + b) / 2 for a, b in zip(known, known[1:])]
    cuts, kappa = optimise_cuts(oof, "severity", "score", middle)
    sigma = oof.agg(F.stddev_pop(F.col("severity") - F.col("score"))).first()[0] or 1.0
    return RegressionCuts(models[-1][0], tuple(cuts), float(sigma), kappa)


# --- Ordered logit and stacking ---------------------------------------------------------------


def fit_ordered(df, spec, label, key, *, classes=CLASSES, seed=42, params=None):
    return ordered_logit.fit_ordered_logit(
        df, spec, label, classes=tuple(classes), **{"alpha": 1.0, **(params or {})}
    )


def cross_ordered(df, spec, label, key, folds, k, *, classes=CLASSES, seed=42, params=None) -> DataFrame:
    return ordered_logit.cross_fit(df, spec, label, key, folds, k, classes=classes, **(params or {}))[0]


def cross_ordered_specs(df, specs, label, key, folds, k, *, classes=CLASSES, seed=42, params=None) -> DataFrame:
    return ordered_logit.cross_fit_specs(df, specs, label, key, folds, k, classes=classes, **(params or {}))[0]


@dataclass(frozen=True)
class Stacked:
    bases: tuple[Scorer, ...]
    blend: Scorer

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        wide = df
        names = [f"_base{i}" for i in range(len(self.bases))]
        for name, base in zip(names, self.bases):
            wide = base.score(wide, name)
        parts = _blend_columns(names, len(self.blend.model.classes))
        return self.blend.score(wide.withColumns(parts), out).drop(*names, *parts)


def _blend_columns(bases: Sequence[str], classes: int) -> dict[str, Column]:
    """A number for each base and class, by name."""
    return {f"{b}_p{i}": F.get(b, F.lit(i)) for b in bases for i in range(classes)}


# The base families of the stack.
STACK_BASES = ("xgboost", "lightgbm", "logistic", "ordered_logit")


def out_of_fold(
    folded, family: str, spec, label, key, folds: Sequence[str], k: int, *, classes=CLASSES, seed=42, params=None, fit=None
) -> DataFrame:
    """``(id, repeat, fold, y, proba)``: each row scored by models that did not see it.

    Families with a ``cross`` fit all folds in shared passes; for others, and for a
    ``fit`` given, there is one fit per fold, a few at a time. The seed is
    ``seed + repeat``.
    """
    if fit is None and FAMILIES[family].cross:
        return FAMILIES[family].cross(
            folded, spec, label, key, folds, k, classes=classes, seed=seed, params=params
        )
    fit = fit or (
        lambda rows, s: FAMILIES[family].fit(
            rows, spec, label, key, classes=classes, seed=s, params=params
        )
    )

    def one(repeat: int, fold: int) -> DataFrame:
        held = F.col(folds[repeat]) == fold
        model = fit(folded.where(~held), seed + repeat)
        return model.score(folded.where(held & F.col(label).isNotNull())).select(
            F.col(key).alias("id"),
            F.lit(repeat).alias("repeat"),
            F.lit(fold).alias("fold"),
            F.col(label).cast("int").alias("y"),
            "proba",
        )

    return reduce(DataFrame.unionByName, in_parallel([lambda m=m: one(*m) for m in fold_masks(folds, k)]))


def out_of_fold_specs(
    folded, family: str, specs: Sequence[FeatureSpec], label, key, folds: Sequence[str], k: int, *, classes=CLASSES, seed=42, params=None, fit=None
) -> DataFrame:
    """``out_of_fold`` of several feature sets, by their position ``spec``.

    A family with ``cross_specs`` fits all of them in shared passes.
    """
    if fit is None and FAMILIES[family].cross_specs:
        return FAMILIES[family].cross_specs(
            folded, specs, label, key, folds, k, classes=classes, seed=seed, params=params
        )
    parts = [
        out_of_fold(folded, family, s, label, key, folds, k, classes=classes, seed=seed, params=params, fit=fit)
        for s in specs
    ]
    return reduce(DataFrame.unionByName, [p.withColumn("spec", F.lit(i)) for i, p in enumerate(parts)])


def _boosted_bases(
    folded, spec, label, key, per_base: Mapping[str, Any], k: int, classes, seed
) -> dict[str, tuple[DataFrame, Boosted]]:
    """Out-of-fold scores and the model of all rows of every boosted base, all grown in one series."""
    names = [n for n in per_base if FAMILIES[n].boosted]
    if not names:
        return {}
    masks = fold_masks(["_fold"], k)
    presets = [replace(FAMILIES[n].boosted.preset, **(per_base[n] or {})) for n in names]
    models, table = fit_boosted(
        folded, spec, label, key, [softmax_problem(classes)] * len(names), presets,
        classes=classes, masks=[*masks, None], folds=["_fold"], seed=seed,
    )
    held = [score_held_out(table, [[own[j]] for own in models[:-1]], masks, classes) for j in range(len(names))]
    return {n: (h.withColumnRenamed("outputs", "proba"), models[-1][j]) for j, (n, h) in enumerate(zip(names, held))}


def fit_stacked(
    df, spec, label, key, *, classes=CLASSES, seed=42, params=None
) -> Stacked:
    """Out-of-fold probabilities of the bases feed a multinomial logistic; bases refit on all.

    Folds are stratified; every base scores a row with the model that did not see
    it, and the bases' tables are joined on the key.
    """
    options = {"folds": 3, "bases": STACK_BASES, **(params or {})}
    per_base = {n: options.get(n) for n in options["bases"]}
    k = options["folds"]
    folded = staged(splits.stratified_folds(df, key, label, k=k, seed=seed, name="_fold"))
    names = [f"_base{i}" for i in range(len(options["bases"]))]
    grown = _boosted_bases(folded, spec, label, key, per_base, k, classes, seed)
    oof = None
    for column, base in zip(names, options["bases"]):
        part = grown[base][0] if base in grown else out_of_fold(
            folded, base, spec, label, key, ["_fold"], k, classes=classes, seed=seed, params=per_base[base]
        )
        part = staged(part.select("id", F.col("y").alias(f"{column}_y"), F.col("proba").alias(column)))
        oof = part if oof is None else oof.join(part, "id")
    parts = _blend_columns(names, len(classes))
    meta = staged(oof.select(F.col("_base0_y").alias("severity"), *[v.alias(n) for n, v in parts.items()]))
    kinds = FeatureSpec(tuple(parts), (), dict.fromkeys(parts, "base"))
    blend = softmax.fit_softmax(meta, kinds, "severity", classes, even=False, scaled=False, c=1.0)
    bases = [
        grown[n][1] if n in grown else FAMILIES[n].fit(folded, spec, label, key, classes=classes, seed=seed, params=per_base[n])
        for n in options["bases"]
    ]
    return Stacked(tuple(bases), blend)


# --- Registry ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Family:
    """One candidate: how to fit it and what the selection rule needs to know."""

    name: str
    label: str
    fit: Callable[..., Scorer]
    scaled: bool
    ordinal: bool
    complexity: int
    space: dict[str, tuple[float, float, str]] = field(default_factory=dict)
    cross: Callable[..., DataFrame] | None = None
    boosted: BoostedFamily | None = None
    cross_specs: Callable[..., DataFrame] | None = None


# Tuning ranges of the two tuned families (low, high, scale); rounds are set by the rungs.
# All but the step, which goes with the presets' larger one.
BOOST_SPACE = {
    "step": (0.05, 0.5, "log"),
    "row_share": (0.6, 1.0, "linear"),
    "column_share": (0.5, 1.0, "linear"),
    "l2": (0.1, 10.0, "log"),
    "l1": (1e-3, 5.0, "log"),
}
XGBOOST_SPACE = {**BOOST_SPACE, "depth": (2, 7, "int"), "min_weight": (1, 10, "int")}
LIGHTGBM_SPACE = {**BOOST_SPACE, "leaves": (7, 63, "int"), "min_rows": (5, 40, "int")}

_HIST_GB, _XGBOOST, _LIGHTGBM = BoostedFamily(HIST_GB), BoostedFamily(XGBOOST), BoostedFamily(LIGHTGBM)

# Names, labels, scaling, ordinal flag and complexity of the nine families.
FAMILIES: dict[str, Family] = {
    f.name: f
    for f in (
        Family("logistic", "Multinomial logistic regression", fit_logistic, True, False, 1, cross=cross_logistic),
        Family(
            "ordered_logit",
            "Proportional-odds (ordered) logit",
            fit_ordered,
            True,
            True,
            2,
            cross=cross_ordered,
            cross_specs=cross_ordered_specs,
        ),
        Family(
            "frank_hall",
            "Frank and Hall ordinal decomposition (boosted base)",
            fit_frank_hall,
            False,
            True,
            6,
            cross=cross_frank_hall,
        ),
        Family(
            "regression_threshold",
            "Regression with learned cut-points",
            fit_regression_cuts,
            False,
            True,
            5,
        ),
        Family("random_forest", "Random forest", fit_random_forest, False, False, 3),
        Family("hist_gb", "Boosted trees, best first, all rows and columns", _HIST_GB.fit, False, False, 4, cross=_HIST_GB.cross, boosted=_HIST_GB),
        Family("xgboost", "Boosted trees, by depth, sampled", _XGBOOST.fit, False, False, 4, XGBOOST_SPACE, _XGBOOST.cross, _XGBOOST),
        Family("lightgbm", "Boosted trees, best first, sampled", _LIGHTGBM.fit, False, False, 4, LIGHTGBM_SPACE, _LIGHTGBM.cross, _LIGHTGBM),
        Family("stacked", "Stacked ensemble", fit_stacked, True, False, 7),
    )
}


def registry_table(spark: SparkSession) -> DataFrame:
    """The registry as a small table for joins."""
    rows = [(f.name, f.label, f.scaled, f.ordinal, f.complexity) for f in FAMILIES.values()]
    return small_table(
        spark,
        rows,
        "model string, label string, needs_scaling boolean, ordinal_aware boolean, complexity int",
    )
