"""Explanation operators: fixed coefficients against SQL, fitted models as invariants."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from casewright.functions import cells
from casewright.functions.probability import array_sum, expected_class, tail_probability
from casewright.models import ordered_logit as O
from casewright.models.baselines import fit_one_feature_rule
from casewright.operators import explain as X
from casewright.operators import metrics as M
from casewright.operators import splits
from casewright.operators.prep import medians
from casewright.session import small_table, staged
from checks.evaluation import listed
from checks.featuring import SPEC
from checks.fixture import (
    NUMERIC_COLUMNS,
    PRIORITIES,
    cleaned,
    feature_frame,
    scored,
    with_clean,
    with_features,
    with_scored,
)
from checks.metrics import r, rounded
from checks.modelling import CLASSES, frame_for_fit, holds
from checks.profiling import class_range_sql, long_sql
from checks.registry import query

THRESHOLD = 0.2


@query(
    "x1_permutation_importance",
    with_clean(
        "SELECT feature, n, TRUE AS in_range, TRUE AS unused_is_zero, TRUE AS used_matters FROM ("
        + listed("feature", [(f"'{c}'",) for c in SPEC.columns])
        + ") AS names, (SELECT COUNT(severity) AS n FROM clean) AS counted"
    ),
)
def x1(spark, sf_dir):
    """Drops of every feature; one that the model gives no weight has none, the strongest has one."""
    frame, spec = frame_for_fit(spark, sf_dir)
    model = O.fit_ordered_logit(frame, spec, "severity", classes=CLASSES)
    table = X.permutation_importance(frame, model, spec.columns, "severity", "k")
    weight = dict(zip(model.model.names, model.model.beta))
    used = set(model.terms()[1])
    strongest = max(model.prep.numeric, key=lambda c: abs(weight[c]))
    sound = F.col("importance_mean").between(-1.0, 2.0) & (F.col("importance_std") >= 0)
    zero = F.col("feature").isin(sorted(used)) | (F.abs("importance_mean") < 1e-12)
    matters = (F.col("feature") != strongest) | (F.col("importance_mean") > 0.01)
    n = frame.where("severity is not null").count()
    return table.select(
        "feature", F.lit(n).cast("bigint").alias("n"), sound.alias("in_range"),
        zero.alias("unused_is_zero"), matters.alias("used_matters"),
    )


_CORR = [c for c in SPEC.numeric]
_CORR_CTE = (
    with_features("")[:-1]
    + ",\nco AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND(COALESCE(CORR({c}, severity), 0), 6) AS coefficient FROM features"
        for c in _CORR
    )
    + ")"
)


def correlations(spark, sf_dir):
    """A coefficient per feature that both engines compute alike: its correlation."""
    frame, spec = feature_frame(spark, sf_dir)
    wide = frame.agg(
        *[
            F.round(F.coalesce(F.nanvl(F.corr(c, "severity"), F.lit(None)), F.lit(0.0)), 6).alias(c)
            for c in spec.numeric
        ]
    )
    return wide.unpivot([], list(spec.numeric), "feature", "coefficient")


@query(
    "x2_negligible_features",
    _CORR_CTE
    + "\nSELECT COUNT(*) FILTER (WHERE coefficient < 0.001::DOUBLE) AS n_negligible, COUNT(*) AS n_features FROM co",
)
def x2(spark, sf_dir):
    return X.negligible_features(correlations(spark, sf_dir), "coefficient")


def _attributed(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    fitted = O.fit_ordered_logit(frame, spec, "severity", classes=CLASSES)
    rows = staged(frame.select("k", fitted.prep.array().alias("x")))
    sample = splits.seeded_sample(rows, "k", 30).collect()  # the background, a fixed 30 rows
    background = np.array([row["x"] for row in sample])
    beta, cuts = np.array(fitted.model.beta), np.array(fitted.model.cuts)
    values = np.array(CLASSES, dtype=float)

    def expected(score: np.ndarray) -> np.ndarray:
        return O.expected_classes(score, cuts, values)

    return X.severity_attributions(rows, "k", "x", background, expected, weights=beta), fitted


@query("x3_severity_attributions", with_clean(holds("clean", "additive", "within_classes")))
def x3(spark, sf_dir):
    """Attributions of every row; base plus their sum must equal the prediction."""
    table, _ = _attributed(spark, sf_dir)
    gap = F.abs(F.col("base") + array_sum(F.col("values")) - F.col("prediction"))
    return table.agg(
        F.count(F.lit(1)).alias("n"),
        (F.max(gap) < 1e-9).alias("additive"),
        ((F.min("prediction") >= CLASSES[0]) & (F.max("prediction") <= CLASSES[-1])).alias("within_classes"),
    )


# Fixed coefficients of the scoring fixture, in latent units.
BETA = {"impact": 0.1, "priority": 0.8, "flag": 0.6, "failures": 0.2}


def _inputs():
    return {
        "impact": F.coalesce("impact_score", F.lit(48.0)),
        "priority": F.coalesce(cells.level_code(F.col("priority_level"), PRIORITIES), F.lit(2.0)),
        "flag": cells.flag(F.col("repeated_flag")),
        "failures": F.col("n_failures"),
    }


_PRIO = "CASE priority_level " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(PRIORITIES)) + " END"
_CONTRIB = (
    with_clean("")[:-1]
    + f""",
inp AS (SELECT k, COALESCE(impact_score, 48) AS impact, CAST(COALESCE({_PRIO}, 2) AS DOUBLE) AS priority,
  CAST(repeated_flag = 'Yes' AS DOUBLE) AS flag, n_failures AS failures FROM clean),
con AS (SELECT k, """
    + ", ".join(f"{b}::DOUBLE * ({n} - AVG({n}) OVER ()) AS {n}" for n, b in BETA.items())
    + " FROM inp)"
)


@query(
    "x4_mean_absolute_attribution",
    _CONTRIB
    + "\n"
    + " UNION ALL ".join(f"SELECT '{n}' AS feature, ROUND(AVG(ABS({n})), 6) AS mean_abs FROM con" for n in BETA),
)
def x4(spark, sf_dir):
    table = X.latent_contributions(cleaned(spark, sf_dir), "k", _inputs(), BETA)
    return rounded(X.mean_absolute(table, "values", list(BETA)))


@query(
    "x5_latent_contributions",
    _CONTRIB + "\nSELECT k, " + ", ".join(f"ROUND({n}, 6) AS {n}" for n in BETA) + " FROM con",
)
def x5(spark, sf_dir):
    table = X.latent_contributions(cleaned(spark, sf_dir), "k", _inputs(), BETA)
    return rounded(
        table.select("k", *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(BETA)])
    )


_EXPECTED_SQL = " + ".join(f"{c} * p{c}" for c in CLASSES)


@query(
    "x6_illustrative_cases",
    with_scored("")[:-1]
    + f""",
rk AS (SELECT k, ROUND(p, 6) AS p_severe, y, pred, ROUND({_EXPECTED_SQL}, 6) AS expected_severity FROM scored),
pick AS (SELECT *, ROW_NUMBER() OVER (ORDER BY p_severe, k) AS a, ROW_NUMBER() OVER (ORDER BY p_severe DESC, k) AS b,
  ROW_NUMBER() OVER (ORDER BY ABS(p_severe - {THRESHOLD}::DOUBLE), k) AS c FROM rk)
SELECT 'clearly_not_severe' AS case_type, k, p_severe, y, pred, expected_severity FROM pick WHERE a = 1
UNION ALL SELECT 'clearly_severe', k, p_severe, y, pred, expected_severity FROM pick WHERE b = 1
UNION ALL SELECT 'borderline', k, p_severe, y, pred, expected_severity FROM pick WHERE c = 1""",
)
def x6(spark, sf_dir):
    df = scored(spark, sf_dir).select(
        "k",
        F.round("p", 6).alias("p_severe"),
        "y",
        "pred",
        F.round(expected_class(F.col("proba"), CLASSES), 6).alias("expected_severity"),
    )
    return X.illustrative_cases(
        df, "k", "p_severe", THRESHOLD, ["y", "pred", "expected_severity"]
    )


@query("x7_surrogate_rules", with_clean(holds("clean", "at_least_majority", "has_rules")))
def x7(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    model = O.fit_ordered_logit(frame, spec, "severity", classes=CLASSES)
    scored_df = model.score(frame)
    decision = tail_probability(F.col("proba"), CLASSES, M.CUT) >= THRESHOLD
    fills = {row["column"]: row["median"] for row in medians(frame, spec.numeric).collect()}
    text, fidelity = X.surrogate_rules(scored_df, spec.numeric, decision, fills=fills)
    return scored_df.agg(
        F.count(F.lit(1)).alias("n"),
        (F.lit(fidelity + 1e-9) >= F.greatest(F.avg(decision.cast("int")), 1 - F.avg(decision.cast("int")))).alias("at_least_majority"),
        F.lit("\n" in text.strip()).alias("has_rules"),
    )


_AUDITED = ["impact_score", "risk_score", "loss_gbp", "duration_days", "n_failures", "delay_days"]


@query(
    "x8_monotone_audit",
    with_scored("")[:-1]
    + f""", feats AS (SELECT clean.*, scored.p FROM clean JOIN scored ON scored.k = clean.k),
long AS ({long_sql(_AUDITED, 'feats', 'p')}),
q AS (SELECT col, """
    + ", ".join(f"quantile_cont(v, {i / 10}) AS q{i}" for i in range(1, 10))
    + """ FROM long GROUP BY col),
bn AS (SELECT long.col, """
    + " + ".join(f"CAST(v > q{i} AS INTEGER)" for i in range(1, 10))
    + """ AS bin, p FROM long JOIN q ON q.col = long.col WHERE v IS NOT NULL),
mn AS (SELECT col, bin, AVG(p) AS m FROM bn GROUP BY col, bin),
st AS (SELECT col, m - LAG(m) OVER (PARTITION BY col ORDER BY bin) AS step FROM mn)
SELECT col AS "column", COUNT(step) AS n_steps, COUNT(*) FILTER (WHERE step < 0) AS n_falls,
  ROUND(CAST(COUNT(*) FILTER (WHERE step < 0) AS DOUBLE) / COUNT(step), 6) AS share_falling FROM st GROUP BY col""",
)
def x8(spark, sf_dir):
    df = scored(spark, sf_dir, tuple(c for c in _AUDITED))
    return rounded(X.monotone_audit(df, _AUDITED, "p"))


@query(
    "x9_latent_per_class",
    with_scored(
        f"SELECT y AS severity, COUNT(*) AS n, {r('AVG(eta)', 'latent_mean')}, {r('quantile_cont(eta, 0.05)', 'latent_p5')}, {r('quantile_cont(eta, 0.95)', 'latent_p95')} FROM scored GROUP BY y"
    ),
)
def x9(spark, sf_dir):
    return rounded(X.latent_per_class(scored(spark, sf_dir), "eta", "y"))


@query(
    "x10_recovered_boundaries",
    with_clean("SELECT severity, TRUE AS above_the_last FROM clean WHERE impact_score IS NOT NULL GROUP BY severity"),
)
def x10(spark, sf_dir):
    table = X.recovered_boundaries(cleaned(spark, sf_dir), "impact_score", "severity")
    upper = F.coalesce("recovered_upper_boundary", F.lit(float("inf")))
    last = F.lag(upper, 1, float("-inf")).over(Window.partitionBy(F.lit(0)).orderBy("severity"))  # a row a class
    return table.select("severity", (upper > last).alias("above_the_last"))


@query(
    "x11_boundary_spacing",
    with_clean("")[:-1]
    + """,
med AS (SELECT severity, quantile_cont(CAST(impact_score AS DOUBLE), 0.5) AS m FROM clean GROUP BY severity),
cut AS (SELECT severity, (m + LEAD(m) OVER (ORDER BY severity)) / 2 AS boundary FROM med)
SELECT severity, ROUND(boundary, 6) AS boundary, ROUND(boundary - LAG(boundary) OVER (ORDER BY severity), 6) AS spacing
FROM cut WHERE boundary IS NOT NULL""",
)
def x11(spark, sf_dir):
    rule = fit_one_feature_rule(cleaned(spark, sf_dir), "impact_score", "severity")
    rows = list(zip(rule.classes, rule.cuts))
    return rounded(
        X.boundary_spacing(
            small_table(spark, rows, "severity int, boundary double"), "severity", "boundary"
        )
    )


@query(
    "x12_coefficient_ranking",
    _CORR_CTE
    + """\n(SELECT feature, coefficient, 'top' AS side FROM co ORDER BY coefficient DESC, feature LIMIT 15)
UNION ALL (SELECT feature, coefficient, 'bottom' AS side FROM co ORDER BY coefficient, feature LIMIT 10)""",
)
def x12(spark, sf_dir):
    return X.coefficient_ranking(correlations(spark, sf_dir))


@query("x12b_fitted_coefficients", listed("side, n, finite", [("'top'", "15::BIGINT", True), ("'bottom'", "10::BIGINT", True)]))
def x12b(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    model = O.fit_ordered_logit(frame, spec, "severity", classes=CLASSES).model
    ranking = X.coefficient_ranking(X.coefficients(spark, model.names, model.beta))
    return ranking.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), (F.max(F.abs("coefficient")) < 1e3).alias("finite")
    )
