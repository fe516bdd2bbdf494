"""The stages of a batch run, each a function of tables and small fitted values.

``run_all`` chains them: validate, train, evaluate, explain, predict. What a stage
hands on is a staged table or a small record, so each can be run on its own.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.contracts import Catalog
from casewright.functions.probability import argmax_class, tail_probability
from casewright.models import validation as V
from casewright.models import ordered_logit as O
from casewright.models.families import FAMILIES, Scorer
from casewright.operators import decision as D
from casewright.operators import explain as X
from casewright.operators import metrics as M
from casewright.operators import splits
from casewright.operators.features import (
    FeaturePlan,
    FeatureSpec,
    engineer,
    require_same_columns,
)
from casewright.operators.prep import fit_preprocessor
from casewright.operators.quality import CleanResult, clean
from casewright.session import small_table, staged
from casewright.sources.artefacts import table_digest


@dataclass(frozen=True)
class Bundle:
    """Cleaned tables and feature frames of a training and a holdback set."""

    train: CleanResult
    holdback: CleanResult
    features: DataFrame
    holdback_features: DataFrame
    spec: FeatureSpec


def validate(
    training: DataFrame, holdback: DataFrame, catalog: Catalog, plan: FeaturePlan
) -> Bundle:
    """Clean both sets and derive the same features from both; staged for later stages."""
    train = clean(training, catalog, is_training=True)
    hold = clean(holdback, catalog, is_training=False)
    key, target = catalog.identifier, catalog.target
    features, spec = engineer(train.frame, plan, keep=[key, target])
    hold_features, hold_spec = engineer(hold.frame, plan, keep=[key])
    require_same_columns(spec, hold_spec)
    return Bundle(train, hold, staged(features), staged(hold_features), spec)


# --- Train ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Training:
    """Families cross-validated on the training rows; the holdout rows are untouched."""

    rows: DataFrame
    holdout: DataFrame
    folds: DataFrame
    oof: dict[str, DataFrame]
    params: dict[str, dict[str, Any]]
    k: int
    repeats: int
    seed: int


def train(
    bundle: Bundle,
    catalog: Catalog,
    *,
    families: Sequence[str] = tuple(FAMILIES),
    k: int = 5,
    repeats: int = 3,
    seed: int = 42,
    params: Mapping[str, dict[str, Any]] | None = None,
) -> Training:
    """Set a stratified holdout aside and cross-validate every family on the rest.

    Rows without a class are in neither part.
    """
    key, label = catalog.identifier, catalog.target
    split = staged(splits.stratified_holdout(bundle.features, key, label, seed=seed))
    rows = staged(split.where(~F.col("is_test")).drop("is_test"))
    holdout = staged(split.where("is_test").drop("is_test"))
    folds, oof = V.run_families(
        rows, families, bundle.spec, label, key, k=k, repeats=repeats, seed=seed, params=params
    )
    return Training(rows, holdout, folds, oof, dict(params or {}), k, repeats, seed)


# --- Evaluate -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Selection:
    """What evaluation decided and prediction needs: family, its parameters and the rule."""

    model: str
    family: str
    params: dict[str, Any] | None
    threshold: float
    cost_ratio: float
    regime: str
    seed: int
    k: int
    repeats: int


def save_selection(spark: SparkSession, selection: Selection, path: str) -> None:
    small_table(spark, [(json.dumps(asdict(selection)),)], "selection string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_selection(spark: SparkSession, path: str) -> Selection:
    return Selection(**json.loads(spark.read.text(path).first()["value"]))


@dataclass(frozen=True)
class Evaluation:
    """The selection and the tables it rests on."""

    selection: Selection
    point: D.OperatingPoint
    comparison: DataFrame
    trials: DataFrame | None
    sweep: DataFrame
    holdout_metrics: DataFrame
    rules: DataFrame
    missingness: DataFrame
    noise: DataFrame


def evaluate(
    bundle: Bundle,
    catalog: Catalog,
    training: Training,
    *,
    ratio: float = 5.0,
    metric: str = "qwk",
    rule: str = "one_se",
    fixed: str | None = None,
    trials: int = 0,
    classes: Sequence[int] = M.CLASSES,
    cut: int = M.CUT,
) -> Evaluation:
    """Tune, compare and select; set the threshold; measure the refitted model on the holdout.

    ``trials`` candidates are drawn for each trained family that has a search
    space; the best joins the comparison as ``<family>_tuned``.
    """
    key, label, seed = catalog.identifier, catalog.target, training.seed
    folds, oof, params = [training.folds], dict(training.oof), dict(training.params)
    logs = []
    for name in [n for n in training.oof if trials and FAMILIES[n].space]:
        drawn = V.draw_trials(FAMILIES[name].space, trials, seed)
        log = staged(V.tune_family(training.rows, name, bundle.spec, label, key, trials=drawn, k=training.k, seed=seed))
        best = V.best_params(log, drawn)
        more, scored = V.run_families(
            training.rows, [name], bundle.spec, label, key,
            k=training.k, repeats=training.repeats, seed=seed, params={name: best},
        )
        tuned = f"{name}_tuned"
        folds.append(more.withColumn("model", F.lit(tuned)))
        oof[tuned], params[tuned] = scored[name], best
        logs.append(log)
    comparison = staged(V.compare_families(folds, metric))
    chosen = V.select_model(
        comparison, metric=metric, n_folds=training.k * training.repeats, rule=rule, fixed=fixed
    ).first()
    if chosen is None:
        raise ValueError(f"no model named {fixed!r} was trained")
    name = chosen["model"]
    family = name.removesuffix("_tuned")

    point, sweep = _threshold(oof[name], ratio, classes, cut)
    model = FAMILIES[family].fit(
        training.rows, bundle.spec, label, key, classes=classes, seed=seed, params=params.get(name)
    )
    held = model.score(training.holdout).select(
        F.col(label).cast("int").alias("y"), argmax_class(F.col("proba"), classes).alias("pred"), "proba"
    )
    held = staged(held)
    selection = Selection(
        name, family, params.get(name), point.threshold, ratio, bundle.spec.regime, seed, training.k, training.repeats
    )
    tests = (training.holdout, model, bundle.spec, label, key)
    return Evaluation(
        selection,
        point,
        comparison,
        reduce(DataFrame.unionByName, logs) if logs else None,
        sweep,
        M.compute_metrics(held, classes=classes, cut=cut),
        D.compare_rules(held, "y", "proba", point.threshold, classes=classes, cut=cut),
        V.missingness_injection(*tests, seed=seed, classes=classes, cut=cut),
        V.noise_perturbation(*tests, seed=seed, classes=classes, cut=cut),
    )


def _threshold(
    oof: DataFrame, ratio: float, classes: Sequence[int], cut: int
) -> tuple[D.OperatingPoint, DataFrame]:
    mean = V.averaged(oof, len(classes)).withColumn(
        "p", tail_probability(F.col("proba"), classes, cut)
    )
    sweep = staged(D.threshold_sweep(mean, F.col("y") >= cut, "p"))
    return D.select_operating_point(sweep, ratio), sweep


# --- Explain --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Explanation:
    importance: DataFrame
    attributions: DataFrame
    mean_attributions: DataFrame
    cases: DataFrame
    rules: str
    agreement: float
    coefficients: DataFrame | None


def explain(
    bundle: Bundle,
    catalog: Catalog,
    selection: Selection,
    *,
    explained: int = 200,
    background: int = 20,
    repeats: int = 10,
    classes: Sequence[int] = M.CLASSES,
    cut: int = M.CUT,
) -> Explanation:
    """Refit the selected model and explain it; ``explained`` cases get attributions."""
    key, label, spec = catalog.identifier, catalog.target, bundle.spec
    rows = staged(bundle.features.where(F.col(label).isNotNull()))
    model = FAMILIES[selection.family].fit(
        rows, spec, label, key, classes=classes, seed=selection.seed, params=selection.params
    )
    p = tail_probability(F.col("proba"), classes, cut)
    scored = staged(model.score(rows).withColumn("p", p).drop("proba"))
    sample = staged(splits.seeded_sample(rows, key, explained, selection.seed))
    others = splits.seeded_sample(rows, key, background, selection.seed + 1)
    given = staged(X.model_attributions(sample, key, model, spec.columns, others, seed=selection.seed, classes=classes))
    fills = fit_preprocessor(rows, spec, scaled=False).fill
    text, agreement = X.surrogate_rules(
        scored, spec.numeric, F.col("p") >= selection.threshold, fills=fills, seed=selection.seed
    )
    linear = isinstance(model, O.Scorer)
    return Explanation(
        X.permutation_importance(
            rows, model, spec.columns, label, key, repeats=repeats, seed=selection.seed, classes=classes
        ),
        given,
        X.mean_absolute(given, "values", spec.columns),
        X.illustrative_cases(scored, key, "p", selection.threshold),
        text,
        agreement,
        X.coefficient_ranking(X.coefficients(rows.sparkSession, model.model.names, model.model.beta)) if linear else None,
    )


# --- Predict --------------------------------------------------------------------------------


def oof_threshold(
    features: DataFrame,
    family: str,
    spec: FeatureSpec,
    label: str,
    key: str,
    *,
    ratio: float = 5.0,
    k: int = 5,
    repeats: int = 3,
    seed: int = 42,
    cut: int = M.CUT,
    classes: Sequence[int] = M.CLASSES,
    **options,
) -> tuple[D.OperatingPoint, DataFrame, DataFrame]:
    """Cheapest threshold on repeat-averaged out-of-fold probabilities of every row."""
    folds, oof = V.cross_validate(
        features, family, spec, label, key, k=k, repeats=repeats, seed=seed, **options
    )
    point, sweep = _threshold(oof, ratio, classes, cut)
    return point, folds, sweep


@dataclass(frozen=True)
class Prediction:
    model: Scorer
    point: D.OperatingPoint
    folds: DataFrame
    table: DataFrame


def predict(
    bundle: Bundle,
    catalog: Catalog,
    *,
    family: str = "ordered_logit",
    ratio: float = 5.0,
    k: int = 5,
    repeats: int = 3,
    seed: int = 42,
    params: dict | None = None,
) -> Prediction:
    """Threshold from out-of-fold rows, then refit on all rows and score the holdback."""
    key, label = catalog.identifier, catalog.target
    options = {"params": params} if params else {}
    point, folds, _ = oof_threshold(
        bundle.features, family, bundle.spec, label, key,
        ratio=ratio, k=k, repeats=repeats, seed=seed, **options,
    )
    model = FAMILIES[family].fit(bundle.features, bundle.spec, label, key, seed=seed, params=params)
    scored = model.score(bundle.holdback_features)
    return Prediction(model, point, folds, D.prediction_table(scored, key, "proba", point.threshold))


def predict_selected(bundle: Bundle, catalog: Catalog, selection: Selection) -> Prediction:
    """``predict`` with the family, parameters, ratio and folds of a selection record."""
    return predict(
        bundle, catalog, family=selection.family, ratio=selection.cost_ratio, k=selection.k,
        repeats=selection.repeats, seed=selection.seed, params=selection.params,
    )


@dataclass(frozen=True)
class Run:
    bundle: Bundle
    training: Training
    evaluation: Evaluation
    explanation: Explanation
    prediction: Prediction


def run_all(
    training: DataFrame,
    holdback: DataFrame,
    catalog: Catalog,
    plan: FeaturePlan,
    *,
    train_options: Mapping[str, Any] | None = None,
    evaluate_options: Mapping[str, Any] | None = None,
    explain_options: Mapping[str, Any] | None = None,
) -> Run:
    """All stages, one after the other, on one validated bundle."""
    bundle = validate(training, holdback, catalog, plan)
    trained = train(bundle, catalog, **(train_options or {}))
    judged = evaluate(bundle, catalog, trained, **(evaluate_options or {}))
    told = explain(bundle, catalog, judged.selection, **(explain_options or {}))
    return Run(bundle, trained, judged, told, predict_selected(bundle, catalog, judged.selection))


def run_record(bundle: Bundle, prediction: Prediction, family: str, seed: int = 42) -> DataFrame:
    """One row of facts about a run: sizes, model, decision rule, quality, output digest."""
    point = prediction.point
    sizes = bundle.features.agg(F.count(F.lit(1)).alias("n_training_rows"))
    quality = prediction.folds.agg(
        *[F.avg(m).alias(f"cv_{m}") for m in ("qwk", "mae", "severe_recall", "severe_precision")]
    )
    output = table_digest(prediction.table)
    share = prediction.table.agg(
        F.avg((F.col("decision") == D.PROGRESSED).cast("double")).alias("progressed_share")
    )
    row = sizes.withColumns(
        {
            "n_features": F.lit(len(bundle.spec.columns)),
            "family": F.lit(family),
            "seed": F.lit(seed),
            "regime": F.lit(bundle.spec.regime),
            "threshold": F.lit(point.threshold),
            "cost_ratio": F.lit(point.cost_ratio),
        }
    )
    for part in (quality, output, share):
        row = M.join_groups(row, part, [])
    return row
