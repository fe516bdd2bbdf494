"""Metric and evaluation operators on the scored case table (constant coefficients)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.functions.probability import tail_probability
from casewright.operators import metrics as M
from checks.fixture import scored, with_scored
from checks.registry import query

CLASSES = M.CLASSES
POINTS = ("qwk", "mae", "macro_f1", "balanced_accuracy", "accuracy", "exact_or_adjacent",
          "severe_recall", "severe_precision", "severe_f1", "severe_missed",
          "non_severe_progressed", *[f"recall_{c}" for c in CLASSES], "severe_brier", "log_loss")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at six digits, so both engines print the same value."""
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


QWK_SQL = """1 - SUM((y-pred)*(y-pred)) / (CAST(SUM(y*y) + SUM(pred*pred) AS DOUBLE)
  - 2.0::DOUBLE * SUM(y) * SUM(pred) / COUNT(*))"""


def r(expr: str, name: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6) AS {name}"


def div(a: str, b: str, empty: str = "0") -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF({b}, 0), {empty})"


TP = "COUNT(*) FILTER (WHERE y >= 4 AND pred >= 4)"
FN = "COUNT(*) FILTER (WHERE y >= 4 AND pred < 4)"
FP = "COUNT(*) FILTER (WHERE y < 4 AND pred >= 4)"


def _f1(c: int) -> str:
    return div(f"2 * COUNT(*) FILTER (WHERE y = {c} AND pred = {c})",
               f"(COUNT(*) FILTER (WHERE y = {c}) + COUNT(*) FILTER (WHERE pred = {c}))")


def _recall(c: int) -> str:
    return f"AVG(CASE WHEN y = {c} THEN CAST(pred = {c} AS DOUBLE) END)"


PROBA_Y = "CASE y " + " ".join(f"WHEN {c} THEN p{c}" for c in CLASSES) + " END"
MACRO = "(" + " + ".join(_f1(c) for c in CLASSES) + ") / 6"
BALANCED = ("(" + " + ".join(f"COALESCE({_recall(c)}, 0)" for c in CLASSES) + ") / ("
            + " + ".join(f"CAST(COUNT(*) FILTER (WHERE y = {c}) > 0 AS INTEGER)" for c in CLASSES) + ")")

POINT_SQL = {
    "qwk": QWK_SQL,
    "mae": "AVG(ABS(y - pred))",
    "macro_f1": MACRO,
    "balanced_accuracy": BALANCED,
    "accuracy": "AVG(CAST(y = pred AS DOUBLE))",
    "exact_or_adjacent": "AVG(CAST(ABS(y - pred) <= 1 AS DOUBLE))",
    "severe_recall": div(TP, f"({TP} + {FN})"),
    "severe_precision": div(TP, f"({TP} + {FP})"),
    "severe_f1": div(f"2 * {TP}", f"(2 * {TP} + {FN} + {FP})"),
    "severe_missed": FN,
    "non_severe_progressed": FP,
    **{f"recall_{c}": _recall(c) for c in CLASSES},
    "severe_brier": "AVG((p - CAST(y >= 4 AS DOUBLE)) * (p - CAST(y >= 4 AS DOUBLE)))",
    "log_loss": f"AVG(-ln(GREATEST(2.220446049250313e-16::DOUBLE, {PROBA_Y})))",
}

RANK_CTE = """,
rk AS (SELECT p, COUNT(*) FILTER (WHERE y >= 4) AS pos, COUNT(*) FILTER (WHERE y < 4) AS neg FROM scored GROUP BY p),
rc AS (SELECT p, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg,
  CAST(SUM(pos) OVER (ORDER BY p) AS DOUBLE) AS cpos, CAST(SUM(neg) OVER (ORDER BY p) AS DOUBLE) AS cneg,
  CAST(SUM(pos) OVER () AS DOUBLE) AS np, CAST(SUM(neg) OVER () AS DOUBLE) AS nn FROM rk)"""
AUC_SQL = "SUM(pos * (cneg - neg + neg / 2)) / MAX(np) / MAX(nn)"
AP_SQL = "SUM(pos * ((np - cpos + pos) / ((np - cpos + pos) + (nn - cneg + neg)))) / MAX(np)"


def points(*names: str) -> str:
    return with_scored("SELECT " + ", ".join(r(POINT_SQL[n], n) for n in names) + " FROM scored")


def _points(names):
    def run(spark, sf_dir):
        table = M.point_metrics(scored(spark, sf_dir), proba="proba")
        return rounded(table.select(*names))

    return run


@query("e1_tail_probability", with_scored("SELECT k, ROUND(p, 6) AS p_severe FROM scored"))
def e1(spark, sf_dir):
    df = scored(spark, sf_dir)
    return df.select(
        "k", F.round(tail_probability(F.col("proba"), CLASSES, M.CUT), 6).alias("p_severe")
    )


for _name, _cols in {
    "e2_quadratic_kappa": ["qwk"],
    "e3_mean_absolute_error": ["mae"],
    "e4_macro_f1": ["macro_f1"],
    "e5_balanced_accuracy": ["balanced_accuracy"],
    "e6_accuracy": ["accuracy", "exact_or_adjacent"],
    "e7_severe_binary": ["severe_recall", "severe_precision", "severe_f1"],
    "e8_boundary_counts": ["severe_missed", "non_severe_progressed"],
    "e9_recall_per_class": [f"recall_{c}" for c in CLASSES],
    "e12_brier": ["severe_brier"],
    "e13_log_loss": ["log_loss"],
}.items():
    query(_name, points(*_cols))(_points(_cols))


def _ranks(df):
    return M.ranking_metrics(df, F.col("y") >= M.CUT, "p")


@query("e10_roc_auc",
       f"{with_scored('')[:-1]}{RANK_CTE}\nSELECT {r(AUC_SQL, 'severe_roc_auc')} FROM rc")
def e10(spark, sf_dir):
    return rounded(_ranks(scored(spark, sf_dir)).select("severe_roc_auc"))


@query("e11_average_precision",
       f"{with_scored('')[:-1]}{RANK_CTE}\nSELECT {r(AP_SQL, 'severe_pr_auc')} FROM rc")
def e11(spark, sf_dir):
    return rounded(_ranks(scored(spark, sf_dir)).select("severe_pr_auc"))


ALL_SQL = (
    f"{with_scored('')[:-1]}{RANK_CTE},\nra AS (SELECT {r(AUC_SQL, 'severe_roc_auc')}, {r(AP_SQL, 'severe_pr_auc')} FROM rc),\n"
    "pt AS (SELECT COUNT(*) AS n, " + ", ".join(r(POINT_SQL[n], n) for n in POINTS)
    + " FROM scored)\nSELECT pt.*, ra.* FROM pt, ra"
)


@query("e14_all_metrics", ALL_SQL)
def e14(spark, sf_dir):
    return rounded(M.compute_metrics(scored(spark, sf_dir)))


@query(
    "e20_confusion_severity",
    with_scored(
        "SELECT g.severity, "
        + ", ".join(f"COUNT(s.k) FILTER (WHERE s.pred = {c}) AS pred_{c}" for c in CLASSES)
        + " FROM (SELECT CAST(UNNEST([1,2,3,4,5,6]) AS INTEGER) AS severity) g"
        " LEFT JOIN scored s ON s.y = g.severity GROUP BY g.severity"
    ),
)
def e20(spark, sf_dir):
    return M.confusion(scored(spark, sf_dir))


@query(
    "e20b_confusion_boundary",
    with_scored(
        "SELECT g.progressed, COUNT(s.k) FILTER (WHERE s.pred < 4) AS pred_not_progressed,"
        " COUNT(s.k) FILTER (WHERE s.pred >= 4) AS pred_progressed"
        " FROM (SELECT UNNEST([false, true]) AS progressed) g"
        " LEFT JOIN scored s ON (s.y >= 4) = g.progressed GROUP BY g.progressed"
    ),
)
def e20b(spark, sf_dir):
    return M.boundary_confusion(scored(spark, sf_dir))


_BUCKETS = {
    "exact": "pred = y",
    "under_by_1": "pred - y = -1",
    "over_by_1": "pred - y = 1",
    "under_by_2_or_more": "pred - y <= -2",
    "over_by_2_or_more": "pred - y >= 2",
    "crossed_boundary_downwards (severe -> not)": "y >= 4 AND pred < 4",
    "crossed_boundary_upwards (not -> severe)": "y < 4 AND pred >= 4",
}


@query(
    "e21_error_analysis",
    with_scored(
        " UNION ALL ".join(
            f"SELECT '{b}' AS bucket, COUNT(*) FILTER (WHERE {c}) AS n, "
            f"round_even(CAST(COUNT(*) FILTER (WHERE {c}) AS DOUBLE) / COUNT(*), 4) AS share FROM scored"
            for b, c in _BUCKETS.items()
        )
    ),
)
def e21(spark, sf_dir):
    return M.error_analysis(scored(spark, sf_dir))


@query(
    "e22_reliability",
    with_scored(
        "SELECT LEAST(9, CAST(FLOOR(p * 10) AS INTEGER)) AS bin, COUNT(*) AS n,"
        " ROUND(AVG(p), 6) AS mean_predicted, ROUND(AVG(CAST(y >= 4 AS DOUBLE)), 6) AS observed_rate,"
        " round_even(AVG(CAST(y >= 4 AS DOUBLE)) - AVG(p), 4) AS gap FROM scored GROUP BY 1"
    ),
)
def e22(spark, sf_dir):
    df = scored(spark, sf_dir)
    return rounded(M.calibration_table(df, F.col("y") >= M.CUT, "p"))


SUBGROUP_COLUMNS = ("route", "segment", "priority_level", "scale_level")
_SEVERE = "COUNT(*) FILTER (WHERE y >= 4)"
_FLAGGED = "COUNT(*) FILTER (WHERE pred >= 4)"


def _subgroup_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS col, COALESCE({c}, '(missing)') AS level, y, pred FROM scored"
        for c in SUBGROUP_COLUMNS
    )
    return f"""{with_scored('')[:-1]},
long AS ({long}),
sub AS (SELECT col AS "column", level, COUNT(*) AS n,
  {r(f'CAST({_SEVERE} AS DOUBLE) / COUNT(*)', 'severe_rate')},
  {r(f'CAST({TP} AS DOUBLE) / NULLIF({_SEVERE}, 0)', 'severe_recall')},
  {r(f'CAST({TP} AS DOUBLE) / NULLIF({_FLAGGED}, 0)', 'severe_precision')},
  {r(f'CASE WHEN MIN(y) < MAX(y) THEN {QWK_SQL} END', 'qwk')}
  FROM long GROUP BY col, level HAVING COUNT(*) >= 20)"""


@query("e27_subgroup_performance", _subgroup_sql() + "\nSELECT * FROM sub")
def e27(spark, sf_dir):
    df = scored(spark, sf_dir, SUBGROUP_COLUMNS)
    return rounded(M.subgroup_performance(df, SUBGROUP_COLUMNS))


@query("e28_weakest_subgroup", _subgroup_sql()
       + "\nSELECT MIN(severe_recall) AS min_severe_recall FROM sub")
def e28(spark, sf_dir):
    df = scored(spark, sf_dir, SUBGROUP_COLUMNS)
    return M.weakest_subgroup(rounded(M.subgroup_performance(df, SUBGROUP_COLUMNS)))
