"""Models: fixed coefficients against SQL, and fits as invariant tables.

Every family is fitted on the whole table with its preset.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.functions.probability import (
    argmax_class,
    array_sum,
    count_below,
    dot,
    ordered_probabilities,
)
from casewright.models import baselines, families
from casewright.models import ordered_logit as O
from casewright.models import validation as V
from casewright.operators import features as ft
from casewright.operators import metrics as M
from casewright.operators import splits
from casewright.session import staged
from casewright.sources.artefacts import Artefact, load_artefact, save_artefact
from checks.fixture import (
    STEEPNESS,
    THETA,
    cleaned,
    feature_frame,
    scored,
    table,
    with_clean,
    with_features,
    with_scored,
)
from checks.metrics import r, rounded
from checks.registry import query
from checks.sources import scratch

CLASSES = M.CLASSES
def frame_for_fit(spark, sf_dir) -> tuple[DataFrame, ft.FeatureSpec]:
    frame, spec = feature_frame(spark, sf_dir)
    return staged(frame), spec


def holds(n_from: str, *invariants: str) -> str:
    """SQL of a row count and of invariants that must all hold."""
    return f"SELECT COUNT(*) AS n, {', '.join(f'TRUE AS {i}' for i in invariants)} FROM {n_from}"


def quality(scored_df: DataFrame, label: str = "severity") -> DataFrame:
    """Invariants of a scored table: rows, probabilities that are some, more than chance."""
    rows = scored_df.select(
        F.col(label).cast("int").alias("y"),
        "proba",
        argmax_class(F.col("proba"), CLASSES).alias("pred"),
        array_sum(F.col("proba")).alias("mass"),
    )
    kappa = M.qwk(F.col("y"), F.col("pred"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"),
        ((F.min(F.array_min("proba")) >= 0) & (F.max(F.array_max("proba")) <= 1 + 1e-9)).alias("bounded"),
        (F.max(F.abs(F.col("mass") - 1)) < 1e-9).alias("mass_is_one"),
        ((kappa > 0) & (kappa <= 1)).alias("above_chance"),
    )


QUALITY = ("bounded", "mass_is_one", "above_chance")
FITTED = with_clean(holds("clean", *QUALITY))


_M1 = """cnt AS (SELECT severity, COUNT(*) AS n FROM clean GROUP BY severity)"""


@query(
    "m1_majority",
    with_clean("")[:-1]
    + f""",\n{_M1}
SELECT severity, {r('CAST(n AS DOUBLE) / SUM(n) OVER ()', 'prior')}, n = MAX(n) OVER () AS predicted FROM cnt""",
)
def m1(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    model = baselines.fit_majority(frame, "severity")
    one = model.score(frame.select("severity")).select("proba").limit(1)
    long = one.select(F.posexplode("proba").alias("i", "prior"))
    labels = F.array(*[F.lit(c) for c in model.classes])
    return rounded(
        long.select(
            F.get(labels, F.col("i")).alias("severity"),
            "prior",
            (F.get(labels, F.col("i")) == model.winner).alias("predicted"),
        )
    )


_M2 = """med AS (SELECT severity, quantile_cont(CAST(impact_score AS DOUBLE), 0.5) AS m FROM clean GROUP BY severity),
cut AS (SELECT severity, (m + LEAD(m) OVER (ORDER BY severity)) / 2 AS c FROM med),
maj AS (SELECT severity AS s FROM clean GROUP BY severity ORDER BY COUNT(*) DESC, severity LIMIT 1),
rule AS (SELECT k, clean.severity, impact_score, CASE WHEN impact_score IS NULL THEN (SELECT s FROM maj)
  ELSE CAST(1 + (SELECT COUNT(*) FROM cut WHERE c < impact_score) AS INTEGER) END AS pred FROM clean)"""


@query(
    "m2_single_feature_rule",
    with_clean("")[:-1]
    + f",\n{_M2}\nSELECT k, pred, ROUND(CAST(1.0 AS DOUBLE) / 1.1, 6) AS p_top FROM rule",
)
def m2(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    rule = baselines.fit_one_feature_rule(frame, "impact_score", "severity")
    out = rule.score(frame.select("k", "impact_score"))
    return rounded(
        out.select(
            "k",
            argmax_class(F.col("proba"), rule.classes).alias("pred"),
            F.array_max("proba").alias("p_top"),
        )
    )


def _family(name: str):
    def run(spark, sf_dir):
        frame, spec = frame_for_fit(spark, sf_dir)
        model = families.FAMILIES[name].fit(frame, spec, "severity", "k")
        return quality(model.score(frame))

    return run


query("m3_multinomial_logistic", FITTED)(_family("logistic"))


@query("m3b_logistic_on_embeddings", holds("embeddings", "mass_is_one", "above_chance"))
def m3b(spark, sf_dir):
    """A ten-class fit on the 64 components of the embedding table."""
    rows = table(spark, sf_dir, "embeddings")
    names = [f"e{i}" for i in range(64)]
    wide = staged(
        rows.select(
            "label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]
        )
    )
    spec = ft.FeatureSpec(tuple(names), (), dict.fromkeys(names, "component"))
    classes = list(range(10))
    model = families.fit_logistic(wide, spec, "label", "k", classes=classes)
    out = model.score(wide).withColumn("pred", argmax_class(F.col("proba"), classes))
    return out.agg(
        F.count(F.lit(1)).alias("n"),
        (F.max(F.abs(array_sum(F.col("proba")) - 1)) < 1e-9).alias("mass_is_one"),
        (F.avg((F.col("pred") == F.col("label")).cast("double")) > 1 / len(classes)).alias("above_chance"),
    )


@query("m4_ordered_logit_fit", with_clean(holds("clean", *QUALITY, "converged", "score_near_zero", "cuts_ordered")))
def m4(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    fitted = O.fit_ordered_logit(frame, spec, "severity", classes=CLASSES)
    model = fitted.model
    ordered = all(a < b for a, b in zip(model.cuts, model.cuts[1:]))
    return quality(fitted.score(frame)).withColumns(
        {
            "converged": F.lit(model.converged),
            "score_near_zero": F.lit(model.gradient_norm < 1e-6),
            "cuts_ordered": F.lit(ordered),
        }
    )


@query(
    "m5_ordered_probabilities",
    with_scored("SELECT k, " + ", ".join(f"ROUND(p{c}, 6) AS p{c}" for c in CLASSES) + " FROM scored"),
)
def m5(spark, sf_dir):
    df = scored(spark, sf_dir)
    p = ordered_probabilities(F.lit(STEEPNESS) * F.col("eta"), [STEEPNESS * t for t in THETA])
    return rounded(
        df.withColumn("q", p).select("k", *[F.get("q", F.lit(c - 1)).alias(f"p{c}") for c in CLASSES])
    )


@query("m6_latent_score", with_scored("SELECT k, ROUND(eta, 6) AS eta FROM scored"))
def m6(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    from checks.fixture import PRIORITIES
    from casewright.functions import cells

    x = F.array(
        F.coalesce("impact_score", F.lit(48.0)),
        F.coalesce(cells.level_code(F.col("priority_level"), PRIORITIES), F.lit(2.0)),
        cells.flag(F.col("repeated_flag")),
        F.col("n_failures"),
        F.lit(1.0),
    )
    return rounded(frame.select("k", dot(x, [0.1, 0.8, 0.6, 0.2, 1.0]).alias("eta")))


query("m7_frank_hall", FITTED)(_family("frank_hall"))

# Noisy P(y > k): the running minimum has something to repair.
_EXCEED = [
    "GREATEST(0, LEAST(1, p2+p3+p4+p5+p6 - 0.3 * CAST(k % 3 = 0 AS INTEGER)))",
    "p3+p4+p5+p6",
    "GREATEST(0, LEAST(1, p4+p5+p6 + 0.2 * CAST(k % 4 = 0 AS INTEGER)))",
    "p5+p6",
    "p6",
]


def _falling(i: int) -> str:
    return f"LEAST({', '.join(f'g{j}' for j in range(i + 1))})" if i else "g0"


_PARTS = (
    ["1 - g0"] + [f"{_falling(i)} - {_falling(i + 1)}" for i in range(4)] + [_falling(4)]
)


@query(
    "m7b_frank_hall_recombine",
    with_scored("")[:-1]
    + ",\ngt AS (SELECT k, "
    + ", ".join(f"CAST({e} AS DOUBLE) AS g{i}" for i, e in enumerate(_EXCEED))
    + " FROM scored),\nraw AS (SELECT k, "
    + ", ".join(f"GREATEST({p}, 1e-12::DOUBLE) AS q{i}" for i, p in enumerate(_PARTS, 1))
    + " FROM gt)\nSELECT k, "
    + ", ".join(f"ROUND(q{c} / (q1+q2+q3+q4+q5+q6), 6) AS p{c}" for c in CLASSES)
    + " FROM raw",
)
def m7b(spark, sf_dir):
    df = scored(spark, sf_dir)
    wide = df.select("k", *[F.get("proba", F.lit(c - 1)).alias(f"p{c}") for c in CLASSES])
    exceed = [f"DOUBLE({e})".replace("0.3 *", "0.3D *").replace("0.2 *", "0.2D *") for e in _EXCEED]
    wide = wide.select("k", *[F.expr(e).alias(f"g{i}") for i, e in enumerate(exceed)])
    out = wide.withColumn("q", families.recombine([F.col(f"g{i}") for i in range(5)]))
    return rounded(out.select("k", *[F.get("q", F.lit(c - 1)).alias(f"p{c}") for c in CLASSES]))


query("m8_regression_cuts", FITTED)(_family("regression_threshold"))

_TRIALS = [6.0 + 0.2 * i for i in range(13)]


@query(
    "m8b_cut_step",
    with_scored("")[:-1]
    + ",\ntr AS (SELECT UNNEST(["
    + ", ".join(f"{t!r}::DOUBLE" for t in _TRIALS)
    + "]) AS t),\ncutd AS (SELECT t, y, 1 + CAST(eta > 4.2 AS INTEGER) + CAST(eta > 6.4 AS INTEGER) + CAST(eta > t AS INTEGER)"
    + " + CAST(eta > 10.6 AS INTEGER) + CAST(eta > 12.5 AS INTEGER) AS pred FROM scored, tr)\n"
    + f"SELECT ROUND(t, 6) AS trial, {r('1 - SUM((y-pred)*(y-pred)) / (CAST(SUM(y*y) + SUM(pred*pred) AS DOUBLE) - 2.0::DOUBLE * SUM(y) * SUM(pred) / COUNT(*))', 'qwk')} FROM cutd GROUP BY t",
)
def m8b(spark, sf_dir):
    df = scored(spark, sf_dir)
    kappas = families.candidate_kappas(df, "y", "eta", THETA, 2, _TRIALS)
    from casewright.session import small_table

    return rounded(small_table(spark, list(zip(_TRIALS, kappas)), "trial double, qwk double"))


@query("m8c_cut_search", with_scored(holds("scored", "never_lower", "measured_alike", "cuts_sorted")))
def m8c(spark, sf_dir):
    """Coordinate ascent never lowers kappa and keeps the cuts sorted."""
    df = staged(scored(spark, sf_dir).select("y", "eta"))
    start = families.candidate_kappas(df, "y", "eta", THETA, 0, [THETA[0]])[0]
    cuts, kappa = families.optimise_cuts(df, "y", "eta", THETA)
    pred = count_below(F.col("eta"), cuts) + 1
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(kappa >= start).alias("never_lower"),
        (F.abs(M.qwk(F.col("y"), pred) - F.lit(kappa)) < 1e-9).alias("measured_alike"),
        F.lit(list(cuts) == sorted(cuts)).alias("cuts_sorted"),
    )


query("m9_random_forest", FITTED)(_family("random_forest"))
query("m10_hist_gradient_boosting", FITTED)(_family("hist_gb"))
query("m11_xgboost_preset", FITTED)(_family("xgboost"))
query("m12_lightgbm_preset", FITTED)(_family("lightgbm"))


@query("m13_stacked_ensemble", FITTED)
def m13(spark, sf_dir):
    frame, spec = frame_for_fit(spark, sf_dir)
    model = families.fit_stacked(frame, spec, "severity", "k")
    return quality(model.score(frame))


@query(
    "m14_label_offset_weights",
    with_clean(
        f"SELECT CAST(severity - 1 AS INTEGER) AS label, COUNT(*) AS n, {r('CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / 6 / COUNT(*)', 'weight')} FROM clean GROUP BY severity"
    ),
)
def m14(spark, sf_dir):
    rows = splits.with_class_weight(cleaned(spark, sf_dir).select("severity"), "severity")
    return rounded(
        rows.groupBy((F.col("severity") - 1).alias("label")).agg(
            F.count(F.lit(1)).alias("n"), F.avg("weight").alias("weight")
        )
    )


# --- A table of fold results of five named rules, exact in SQL -----------------------------------

RULES = {
    "ordered_logit": "pred",
    "logistic": "CASE WHEN k % 7 = 0 THEN GREATEST(1, pred - 1) ELSE pred END",
    "random_forest": "CASE WHEN k % 3 = 0 THEN LEAST(6, pred + 1) ELSE pred END",
    "xgboost": "CASE WHEN k % 11 = 0 THEN 3 ELSE pred END",
    "xgboost_tuned": "CASE WHEN k % 23 = 0 THEN 3 ELSE pred END",
}


def rule_folds(spark, sf_dir, metrics=("qwk", "mae", "severe_recall")) -> DataFrame:
    """(model, repeat, fold, metrics) of every rule; folds deal the whole table."""
    df = scored(spark, sf_dir)
    wide = df.select("k", "y", *[F.expr(e).cast("int").alias(n) for n, e in RULES.items()])
    long = wide.unpivot(["k", "y"], list(RULES), "model", "pred").withColumn(
        "fold", F.pmod(F.col("k"), F.lit(5)).cast("int")
    )
    table_ = M.point_metrics(long, by=["model", "fold"])
    return table_.select("model", F.lit(0).alias("repeat"), "fold", *metrics)


_KAPPA = "1 - SUM((y-pred)*(y-pred)) / (CAST(SUM(y*y) + SUM(pred*pred) AS DOUBLE) - 2.0::DOUBLE * SUM(y) * SUM(pred) / COUNT(*))"
_RECALL = "CAST(COUNT(*) FILTER (WHERE y >= 4 AND pred >= 4) AS DOUBLE) / COUNT(*) FILTER (WHERE y >= 4)"
RULES_CTE = (
    with_scored("")[:-1]
    + ",\nlongp AS ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS model, k % 5 AS fold, y, CAST({e} AS INTEGER) AS pred FROM scored"
        for n, e in RULES.items()
    )
    + f"),\nfolds AS (SELECT model, CAST(fold AS INTEGER) AS fold, {_KAPPA} AS qwk, AVG(ABS(y - pred)) AS mae, {_RECALL} AS severe_recall FROM longp GROUP BY model, fold),\n"
    + "summ AS (SELECT model, AVG(qwk) AS qwk, AVG(mae) AS mae, AVG(severe_recall) AS severe_recall, STDDEV_SAMP(qwk) AS qwk_std, STDDEV_SAMP(mae) AS mae_std, STDDEV_SAMP(severe_recall) AS severe_recall_std FROM folds GROUP BY model)"
)
_REGISTRY = ", ".join(
    f"('{f.name}', '{f.label}', {str(f.ordinal).lower()}, {f.complexity})"
    for f in families.FAMILIES.values()
)
ENRICHED_CTE = (
    RULES_CTE
    + f",\nreg(family, flabel, ordinal_aware, complexity) AS (VALUES {_REGISTRY}),\n"
    + "enr AS (SELECT summ.*, flabel || CASE WHEN model LIKE '%_tuned' THEN ' (tuned)' ELSE '' END AS label, ordinal_aware, CAST(complexity AS INTEGER) AS complexity"
    + " FROM summ JOIN reg ON reg.family = REPLACE(model, '_tuned', ''))"
)
SUMMARY = ["qwk", "mae", "severe_recall", "qwk_std", "mae_std", "severe_recall_std"]


def rule_comparison(spark, sf_dir) -> DataFrame:
    return M.fold_summary(rule_folds(spark, sf_dir), ["model"], ["repeat", "fold"])


@query(
    "m15_registry",
    ENRICHED_CTE
    + "\nSELECT model, label, ordinal_aware, complexity, ROUND(qwk, 6) AS qwk FROM enr WHERE model NOT LIKE '%_tuned'",
)
def m15(spark, sf_dir):
    plain = rule_comparison(spark, sf_dir).where(~F.col("model").endswith("_tuned"))
    joined = plain.join(F.broadcast(families.registry_table(spark)), "model")
    return rounded(joined.select("model", "label", "ordinal_aware", "complexity", "qwk"))


@query(
    "m16_out_of_fold",
    with_clean(holds("clean", *QUALITY).replace("COUNT(*) AS n", "3 * COUNT(severity) AS n, COUNT(DISTINCT k) AS n_ids")),
)
def m16(spark, sf_dir):
    """Every row is scored once a repeat, by a model that did not see it; fifteen fits share every pass."""
    frame, spec = frame_for_fit(spark, sf_dir)
    folded, columns = V.with_folds(frame, "k", "severity")
    oof = V.out_of_fold(folded, "logistic", spec, "severity", "k", columns, 5)
    counts = staged(oof).withColumnRenamed("y", "severity")
    ids = counts.agg(F.count_distinct("id").alias("n_ids"))
    return M.join_groups(quality(counts), ids, [])


@query("m17_argmax_class", with_scored("SELECT k, pred FROM scored"))
def m17(spark, sf_dir):
    return scored(spark, sf_dir).select("k", argmax_class(F.col("proba"), CLASSES).alias("pred"))


@query("m18_refit", with_clean(holds("clean", "agree")))
def m18(spark, sf_dir):
    """Two fits of the same rows agree."""
    frame, spec = frame_for_fit(spark, sf_dir)
    first, second = (
        O.fit_ordered_logit(frame, spec, "severity", classes=CLASSES).model for _ in range(2)
    )
    gap = max(abs(a - b) for a, b in zip(first.beta + first.cuts, second.beta + second.cuts))
    return frame.agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(gap < 1e-9).alias("agree"),
    )


@query(
    "s11_model_artefact",
    with_clean("SELECT COUNT(*) AS n, TRUE AS same_scores, 0.2::DOUBLE AS threshold, 'ordered_logit' AS family FROM clean"),
)
def s11(spark, sf_dir):
    """A saved and reloaded model scores every row as before."""
    frame, spec = frame_for_fit(spark, sf_dir)
    fitted = O.fit_ordered_logit(frame, spec, "severity", classes=CLASSES)
    path = f"{scratch(spark)}/artefact"
    save_artefact(spark, Artefact(fitted, "ordered_logit", 0.2, 5.0, 4, "A"), path)
    loaded = load_artefact(spark, path)
    both = loaded.scorer.score(fitted.score(frame, "before"), "after")
    gap = F.max(array_sum(F.zip_with("before", "after", lambda a, b: F.abs(a - b))))
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        (gap < 1e-12).alias("same_scores"),
        F.lit(loaded.threshold).alias("threshold"),
        F.lit(loaded.family).alias("family"),
    )
