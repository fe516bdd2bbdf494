"""Cross-validation, comparison, selection, calibration and robustness."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from casewright.models import families
from casewright.models import ordered_logit as O
from casewright.models import validation as V
from casewright.operators import features as ft
from casewright.operators import metrics as M
from casewright.operators import splits
from casewright.plans import flows
from casewright.session import staged
from checks.featuring import SPEC
from checks.fixture import (
    CATALOG,
    PLAN,
    cases,
    scored,
    split_datasets,
    with_clean,
)
from checks.metrics import ALL_SQL, POINTS, r, rounded
from checks.modelling import (
    CLASSES,
    ENRICHED_CTE,
    RULES_CTE,
    SUMMARY,
    frame_for_fit,
    rule_comparison,
    rule_folds,
)
from checks.profiling import EARLY
from checks.registry import query

# Rows that the stratified deal puts in fold f: of each class c those of rank r with (r + c) mod 5 = f.
_FOLD_ROWS = with_clean("""SELECT 'ordered_logit' AS model, CAST(repeat AS INTEGER) AS repeat, CAST(fold AS INTEGER) AS fold,
  CAST(SUM((n_c - (fold - c + 10) % 5 + 4) // 5) AS BIGINT) AS n, TRUE AS above_chance
FROM range(3) AS r(repeat), range(5) AS f(fold), (SELECT severity AS c, COUNT(*) AS n_c FROM clean GROUP BY severity) AS cls
GROUP BY repeat, fold""")


def listed(columns: str, rows) -> str:
    """SQL of a few fixed rows."""
    values = ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {values}) AS t({columns})"


def inside(*names: str):
    """Whether all these columns lie between 0 and 1."""
    tests = [F.col(n).between(0.0, 1.0) for n in names]
    return reduce(lambda a, b: a & b, tests)


@query("e15_cross_validation", _FOLD_ROWS)
def e15(spark, sf_dir):
    """Fifteen ordered-logit fits that share every pass, measured per repeat and fold."""
    frame, spec = frame_for_fit(spark, sf_dir)
    folds, _ = V.cross_validate(frame, "ordered_logit", spec, "severity", "k")
    return folds.select("model", "repeat", "fold", "n", ((F.col("qwk") > 0) & (F.col("log_loss") < 1.7917)).alias("above_chance"))


@query("e16_fold_summary", RULES_CTE + "\nSELECT model, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in SUMMARY) + " FROM summ")
def e16(spark, sf_dir):
    return rounded(rule_comparison(spark, sf_dir))


@query(
    "e17_family_comparison",
    ENRICHED_CTE
    + "\nSELECT model, label, ordinal_aware, complexity, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in SUMMARY)
    + " FROM enr ORDER BY qwk DESC, model",
)
def e17(spark, sf_dir):
    return rounded(V.compare_families([rule_folds(spark, sf_dir)]))


_FITTED_FAMILIES = ("logistic", "ordered_logit", "xgboost")


@query(
    "e17b_families_fitted",
    with_clean(
        "SELECT model, label, ordinal_aware, complexity, 15::BIGINT AS folds, n, TRUE AS above_chance, TRUE AS best_first FROM ("
        + listed(
            "model, label, ordinal_aware, complexity",
            [(f"'{f.name}'", f"'{f.label}'", f.ordinal, f.complexity) for f in map(families.FAMILIES.get, _FITTED_FAMILIES)],
        )
        + ") AS fam, (SELECT 3 * COUNT(severity) AS n FROM clean) AS counted"
    ),
)
def e17b(spark, sf_dir):
    """Three families fitted on the same 3 x 5 folds and compared."""
    frame, spec = frame_for_fit(spark, sf_dir)
    folds, _ = V.run_families(frame, _FITTED_FAMILIES, spec, "severity", "k")
    compared = V.compare_families([folds])
    rows = folds.groupBy("model").agg(F.count(F.lit(1)).alias("folds"), F.sum("n").alias("n"), F.avg("qwk").alias("plain"))
    best = F.max("qwk").over(Window.partitionBy(F.lit(0)))  # a row a family
    ordered = compared.limit(len(_FITTED_FAMILIES)).withColumn("best_first", (F.col("qwk") <= best))
    return ordered.join(rows, "model").select(
        "model", "label", "ordinal_aware", "complexity", "folds", "n",
        ((F.col("qwk") > 0.3) & (F.col("qwk_std") > 0)).alias("above_chance"),
        (F.col("best_first") & (F.abs(F.col("qwk") - F.col("plain")) < 1e-9)).alias("best_first"),
    )


@query(
    "e18_tuning",
    with_clean(
        "SELECT model, rung, trials, n, TRUE AS as_drawn, TRUE AS better_half_stays, TRUE AS running_best, TRUE AS above_chance FROM ("
        + listed("model, rung, trials", [("'lightgbm'", g, f"{t}::BIGINT") for g, t in enumerate((4, 2, 1))])
        + ") AS rungs, (SELECT COUNT(severity) AS n FROM clean) AS counted"
    ),
)
def e18(spark, sf_dir):
    """Four seeded candidates on five folds; the worse half is dropped after each of two rungs."""
    frame, spec = frame_for_fit(spark, sf_dir)
    drawn = V.draw_trials(families.LIGHTGBM_SPACE, 4)
    log = staged(V.tune_family(frame, "lightgbm", spec, "severity", "k", trials=drawn))
    texts = F.array(*[F.lit(json.dumps(t)) for t in drawn])
    worst_kept = F.min(F.when(F.col("kept"), F.col("cv_qwk"))).over(Window.partitionBy("rung"))
    best = F.max("cv_qwk").over(Window.partitionBy("model").orderBy("rung", "trial"))
    judged = log.withColumns({"worst_kept": worst_kept, "best": best})
    return judged.groupBy("model", "rung").agg(
        F.count(F.lit(1)).alias("trials"),
        F.max("n").alias("n"),
        F.bool_and(F.col("params") == F.get(texts, F.col("trial"))).alias("as_drawn"),
        F.bool_and(F.col("kept") | (F.col("cv_qwk") <= F.col("worst_kept"))).alias("better_half_stays"),
        F.bool_and(F.col("best_so_far") == F.col("best")).alias("running_best"),
        (F.min("cv_qwk") > 0).alias("above_chance"),
    )


_TRIAL_LOG = """tl AS (SELECT model, fold AS trial, qwk AS cv_qwk, severe_recall AS cv_severe_recall,
  MAX(qwk) OVER (PARTITION BY model ORDER BY fold) AS best_so_far,
  ROW_NUMBER() OVER (PARTITION BY model ORDER BY qwk DESC, fold) AS rank FROM folds)"""


@query(
    "e19_top_trials",
    RULES_CTE
    + f",\n{_TRIAL_LOG}\nSELECT model, trial, ROUND(cv_qwk, 6) AS cv_qwk, ROUND(cv_severe_recall, 6) AS cv_severe_recall,"
    " ROUND(best_so_far, 6) AS best_so_far, CAST(rank AS INTEGER) AS rank, rank = 1 AS is_best FROM tl WHERE rank <= 3",
)
def e19(spark, sf_dir):
    folds = rule_folds(spark, sf_dir, ("qwk", "severe_recall"))
    trials = folds.select(
        "model",
        F.col("fold").alias("trial"),
        F.col("qwk").alias("cv_qwk"),
        F.col("severe_recall").alias("cv_severe_recall"),
    )
    return rounded(V.top_trials(V.trial_log(trials), 3))


@query(
    "e23_isotonic_calibration",
    with_clean(
        "SELECT variant, CAST(n AS BIGINT) AS n, TRUE AS calibrated_range, TRUE AS no_worse FROM ("
        + listed("variant", [("'uncalibrated'",), ("'isotonic'",)])
        + ") AS v, (SELECT SUM(round_even(0.2::DOUBLE * n_c, 0)) AS n FROM"
        + " (SELECT COUNT(*) AS n_c FROM clean WHERE severity IS NOT NULL GROUP BY severity) AS c) AS counted"
    ),
)
def e23(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    split = splits.stratified_holdout(frame, "k", "severity")
    train, test = staged(split.where(~F.col("is_test"))), staged(split.where("is_test"))

    def fit(rows):
        return O.fit_ordered_logit(rows, spec, "severity", classes=CLASSES)

    plain = fit(train)
    calibrated = V.fit_calibrated(
        train, fit, "severity", "k",
        fit_folds=lambda rows, fold, k: O.fit_folds(rows, spec, "severity", fold, k, classes=CLASSES),
    )
    variants = {
        name: model.score(test).select(F.col("severity").alias("y"), "proba")
        for name, model in (("uncalibrated", plain), ("isotonic", calibrated))
    }
    found = V.calibration_summary(variants)
    sound = F.col("severe_brier").between(0.0, 0.25) & F.col("log_loss").between(0.0, 2.0)
    plain_brier = F.max(F.when(F.col("variant") == "uncalibrated", F.col("severe_brier"))).over(Window.partitionBy(F.lit(0)))
    n = variants["isotonic"].where("y is not null").count()
    return found.select(
        "variant", F.lit(n).cast("bigint").alias("n"), sound.alias("calibrated_range"),
        (F.col("severe_brier") <= 1.1 * plain_brier).alias("no_worse"),
    )


_GROUPS = sorted(set(SPEC.groups.values()))
_DROPPED = [("(none)", SPEC), *[(g, SPEC.without_groups(g)) for g in _GROUPS]]


@query(
    "e24_ablation",
    listed("dropped_group, n_features, above_chance, delta_is_difference", [(f"'{g}'", len(s.columns), True, True) for g, s in _DROPPED]),
)
def e24(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    table = staged(V.ablation(frame, "ordered_logit", spec, "severity", "k", _GROUPS))
    full = F.max(F.when(F.col("dropped_group") == "(none)", F.col("qwk"))).over(Window.partitionBy(F.lit(0)))
    exact = F.abs(F.col("qwk") - full - F.col("delta_qwk")) < 1e-4
    return table.select("dropped_group", "n_features", (F.col("qwk") > 0).alias("above_chance"), exact.alias("delta_is_difference"))


def _holdout_model(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    split = splits.stratified_holdout(frame, "k", "severity")
    train, test = staged(split.where(~F.col("is_test"))), staged(split.where("is_test"))
    return O.fit_ordered_logit(train, spec, "severity", classes=CLASSES), test, spec


def _spoilt_sql(name: str, doses) -> str:
    """Rows of the test fifth at every dose, from the table; the rest must hold."""
    return with_clean(
        f"SELECT {name}, CAST(n AS BIGINT) AS n, TRUE AS as_dosed, TRUE AS no_gain, TRUE AS loses_at_last, TRUE AS in_range FROM ("
        + listed(name, [(f"{x}::DOUBLE",) for x in doses])
        + ") AS doses, (SELECT SUM(round_even(0.2::DOUBLE * n_c, 0)) AS n FROM"
        + " (SELECT COUNT(*) AS n_c FROM clean WHERE severity IS NOT NULL GROUP BY severity) AS c) AS counted"
    )


def _spoilt(table, name, dosed):
    """Rows score no better for being spoilt, worse at the last dose; ``dosed`` tells which doses were given as named."""
    one = Window.partitionBy(F.lit(0))  # a row a dose
    base = F.max(F.when(F.col(name) == 0, F.col("qwk"))).over(one)
    last = F.col(name) == F.max(name).over(one)
    right = F.array(*[F.lit(float(d)) for d, ok in dosed.items() if ok])
    return table.select(
        name,
        "n",
        F.array_contains(right, F.col(name)).alias("as_dosed"),
        (F.col("qwk") <= base + 0.02).alias("no_gain"),
        (~last | (F.col("qwk") < base - 0.002)).alias("loses_at_last"),
        inside(*V.ROBUST_METRICS).alias("in_range"),
    )


@query("e25_missingness_injection", _spoilt_sql("missing_fraction", (0.0, 0.1, 0.2, 0.3)))
def e25(spark, sf_dir):
    """The share of filled cells that each dose blanks is counted beside the scores."""
    model, test, spec = _holdout_model(spark, sf_dir)
    dosed = {}
    for f in (0.0, 0.1, 0.2, 0.3):
        after = V.blanked_cells(spec, "k", F.lit(f))
        filled = sum(F.col(c).isNotNull().cast("long") for c in spec.columns)
        left = sum(after[c].isNotNull().cast("long") for c in spec.columns)
        row = test.agg(F.sum(filled).alias("filled"), F.sum(left).alias("left")).first()
        dosed[f] = abs(1 - row["left"] / row["filled"] - f) < 0.01
    return _spoilt(V.missingness_injection(test, model, spec, "severity", "k"), "missing_fraction", dosed)


@query("e26_noise", _spoilt_sql("noise_scale", (0.0, 0.1, 0.2, 0.5)))
def e26(spark, sf_dir):
    """The variance that each dose adds is measured beside the scores."""
    model, test, spec = _holdout_model(spark, sf_dir)
    dosed, spread = {}, V.spreads(test, spec)
    for d in (0.0, 0.1, 0.2, 0.5):
        after = V.noisy_cells(test, spec, "k", F.lit(d), spread=spread)
        shares = [F.avg(F.pow(v - F.col(c), 2)) / F.var_samp(c) for c, v in after.items()]
        added = test.agg(*shares).first()
        dosed[d] = abs(sum(added) / len(added) - d * d) <= 0.1 * d * d
    return _spoilt(V.noise_perturbation(test, model, spec, "severity", "k", spread=spread), "noise_scale", dosed)


_RUNGS = (
    "majority class",
    "single-feature rule",
    "logistic, raw columns",
    "logistic, engineered features",
    "ordered logit, engineered features",
    "boosted trees, engineered features",
)


_LADDER = with_clean(
    "SELECT rung, approach, rung > 0 AS above_chance, CASE rung WHEN 0 THEN ROUND(majority, 1) END AS majority_mae,"
    " rung < 2 OR TRUE AS fits_beat_the_rule FROM ("
    + listed("rung, approach", [(i, f"'{name}'") for i, name in enumerate(_RUNGS)])
    + ") AS rungs, (SELECT AVG(ABS(severity - (SELECT severity FROM clean WHERE severity IS NOT NULL GROUP BY severity"
    " ORDER BY COUNT(*) DESC, severity LIMIT 1))) AS majority FROM clean) AS m"
)


@query("e29_baseline_ladder", _LADDER)
def e29(spark, sf_dir):
    """Five folds; the majority's error is that of one class for all, every fit beats the one-feature rule."""
    frame, spec = frame_for_fit(spark, sf_dir)
    raw = spec.without_groups(
        ft.DATE_PARTS, ft.FINANCIAL, ft.IMPACT, ft.VULNERABILITY, ft.FAILURE, ft.INTERACTIONS,
        ft.MISSING,
    )
    table = V.baseline_ladder(
        frame, spec, raw, "impact_score", "severity", "k"
    )
    rule = F.max(F.when(F.col("rung") == 1, F.col("qwk"))).over(Window.partitionBy(F.lit(0)))  # a row a rung
    return table.select(
        "rung",
        "approach",
        (F.col("qwk") > 1e-9).alias("above_chance"),
        F.when(F.col("rung") == 0, F.round("mae", 1)).alias("majority_mae"),
        ((F.col("rung") < 2) | (F.col("qwk") > rule)).alias("fits_beat_the_rule"),
    )


@query(
    "e30_model_selection",
    ENRICHED_CTE
    + """,
best AS (SELECT model, qwk, qwk_std FROM enr ORDER BY qwk DESC, model LIMIT 1),
near AS (SELECT enr.model, enr.qwk, complexity, best.model AS best_model,
  GREATEST(best.qwk_std / sqrt(5::DOUBLE), 0.005::DOUBLE) AS tolerance FROM enr, best
  WHERE enr.qwk >= best.qwk - GREATEST(best.qwk_std / sqrt(5::DOUBLE), 0.005::DOUBLE))
SELECT model, ROUND(qwk, 6) AS qwk, complexity, best_model, ROUND(tolerance, 6) AS tolerance, COUNT(*) OVER () AS n_within
FROM near ORDER BY complexity, near.qwk DESC, model LIMIT 1""",
)
def e30(spark, sf_dir):
    table = V.with_registry(rule_comparison(spark, sf_dir))
    return rounded(V.select_model(table, n_folds=5))


@query(
    "e31_enriched_comparison",
    ENRICHED_CTE
    + "\nSELECT model, label, ordinal_aware, complexity, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in SUMMARY)
    + " FROM enr ORDER BY qwk DESC, model",
)
def e31(spark, sf_dir):
    tuned = F.col("model").endswith("_tuned")
    table = rule_comparison(spark, sf_dir)
    both = table.where(~tuned).unionByName(table.where(tuned))
    return rounded(V.with_registry(both).orderBy(F.desc("qwk"), "model"))


@query(
    "e32_long_metrics",
    f"SELECT metric, value FROM ({ALL_SQL.replace('SELECT pt.*, ra.*', 'SELECT pt.* EXCLUDE (n), ra.*')}) w UNPIVOT (value FOR metric IN ("
    + ", ".join((*POINTS, "severe_roc_auc", "severe_pr_auc"))
    + "))",
)
def e32(spark, sf_dir):
    table = M.long_metrics(M.compute_metrics(scored(spark, sf_dir)))
    return rounded(table)


_REGIME_B = ft.spec_of([c for c in CATALOG.names if c != "investigated_flag"], PLAN.in_regime("B")).columns


@query(
    "e33_regime_comparison",
    listed("regime, n_features, above_chance, in_range", [("'A'", len(SPEC.columns), True, True), ("'B'", len(SPEC.only(_REGIME_B).columns), True, True)]),
)
def e33(spark, sf_dir):
    """The same folds with and without the internal assessments."""
    frame, spec = frame_for_fit(spark, sf_dir)
    reduced = spec.only(_REGIME_B)
    folded, columns = V.with_folds(frame, "k", "severity")
    folds = V.spec_metrics(folded, "ordered_logit", [spec, reduced], "severity", "k", columns, 5)
    runs = {
        name: (folds.where(F.col("spec") == i), len(use.columns))
        for i, (name, use) in enumerate((("A", spec), ("B", reduced)))
    }
    table = V.regime_comparison(runs)
    return table.select(
        "regime", "n_features", (F.col("qwk") > 0).alias("above_chance"), inside("macro_f1", "severe_recall", "severe_pr_auc").alias("in_range")
    )


def _validated(spark, sf_dir) -> flows.Bundle:
    early, late = split_datasets(cases(spark, sf_dir))
    holdback = late.drop("severity").withColumn("investigated_flag", F.lit(None).cast("string"))
    return flows.validate(early, holdback, CATALOG, PLAN)


@query(
    "c10_threshold_refit_score",
    with_clean(f"SELECT COUNT(*) FILTER (WHERE NOT ({EARLY})) AS n, 0::BIGINT AS contradictions, TRUE AS threshold_inside, TRUE AS recall_inside FROM clean"),
)
def c10(spark, sf_dir):
    """Threshold from out-of-fold rows, refit on all training rows, holdback scored."""
    bundle = _validated(spark, sf_dir)
    result = flows.predict(bundle, CATALOG)
    table = result.table
    consistent = (F.col("predicted_severity") >= M.CUT) == (
        F.col("decision") == "Progressed for further investigation"
    )
    return table.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~consistent).alias("contradictions"),
        F.lit(0 < result.point.threshold < 1).alias("threshold_inside"),
        F.lit(0 < result.point.severe_recall <= 1).alias("recall_inside"),
    )


@query(
    "c11_run_record",
    with_clean(f"SELECT COUNT(*) FILTER (WHERE {EARLY}) AS n_training_rows, 'ordered_logit' AS family, 42 AS seed, TRUE AS above_chance, TRUE AS share_inside FROM clean"),
)
def c11(spark, sf_dir):
    bundle = _validated(spark, sf_dir)
    result = flows.predict(bundle, CATALOG)
    record = flows.run_record(bundle, result, "ordered_logit")
    return record.select(
        "n_training_rows", "family", "seed", (F.col("cv_qwk") > 0).alias("above_chance"), inside("progressed_share").alias("share_inside")
    )
