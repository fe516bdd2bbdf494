"""Decision operators on the scored case table."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.operators import decision as D
from casewright.operators import metrics as M
from checks.fixture import scored, with_scored
from checks.metrics import POINT_SQL, r, rounded
from checks.registry import query



def severe():
    return F.col("y") >= M.CUT


THRESHOLD = 0.2
GRID_SQL = "(SELECT CAST(i AS DOUBLE) / 100 AS t FROM range(2, 99) g(i))"

COST_SQL = (
    "(CAST({r} AS DOUBLE) * COUNT(*) FILTER (WHERE y >= 4 AND NOT flagged)"
    " + COUNT(*) FILTER (WHERE y < 4 AND flagged)) / COUNT(*)"
)


@query(
    "c1_expected_cost",
    with_scored(
        f"SELECT {r(COST_SQL.format(r=5), 'expected_cost')} FROM (SELECT *, pred >= 4 AS flagged FROM scored) t"
    ),
)
def c1(spark, sf_dir):
    return rounded(D.expected_cost(scored(spark, sf_dir), severe(), F.col("pred") >= M.CUT, 5.0))


def _sweep_cte() -> str:
    """Suffix counts over the distinct probabilities a threshold reaches."""
    return f"""{with_scored('')[:-1]},
gp AS (SELECT p, COUNT(*) FILTER (WHERE y >= 4) AS pos, COUNT(*) FILTER (WHERE y < 4) AS neg FROM scored GROUP BY p),
tot AS (SELECT CAST(SUM(pos) AS BIGINT) AS np, CAST(SUM(pos + neg) AS BIGINT) AS n FROM gp),
sw AS (SELECT t, CAST(COALESCE(SUM(pos), 0) AS BIGINT) AS tp, CAST(COALESCE(SUM(neg), 0) AS BIGINT) AS fp
  FROM {GRID_SQL} g LEFT JOIN gp ON gp.p >= g.t GROUP BY t),
sweep AS (SELECT t AS threshold, tp, fp, np - tp AS fn, np, n FROM sw, tot)"""


_SWEEP_OUT = ", ".join(
    [
        "threshold",
        r("COALESCE(CAST(tp AS DOUBLE) / NULLIF(np, 0), 0)", "severe_recall"),
        r("COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0)", "severe_precision"),
        "fn AS false_negatives",
        "fp AS false_positives",
        r("CAST(tp + fp AS DOUBLE) / n", "progressed_share"),
        *[r(f"({x}::DOUBLE * fn + fp) / n", f"cost_ratio_{x}") for x in (3, 5, 10)],
    ]
)


@query("c2_threshold_sweep", f"{_sweep_cte()}\nSELECT {_SWEEP_OUT} FROM sweep")
def c2(spark, sf_dir):
    return rounded(D.threshold_sweep(scored(spark, sf_dir), severe(), "p"))


def _points_sql(ratios) -> str:
    listed = ", ".join(f"({x}::DOUBLE)" for x in ratios)
    return f"""{_sweep_cte()},
priced AS (SELECT *, c.ratio * fn + fp AS units,
  ROW_NUMBER() OVER (PARTITION BY c.ratio ORDER BY c.ratio * fn + fp, threshold DESC) AS rn
  FROM sweep, (VALUES {listed}) c(ratio))
SELECT ratio AS cost_ratio, threshold, {r('CAST(tp AS DOUBLE) / np', 'severe_recall')},
  {r('COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0)', 'severe_precision')},
  {r('CAST(tp + fp AS DOUBLE) / n', 'progressed_share')},
  {r('units / n', 'expected_cost_per_case')} FROM priced WHERE rn = 1"""


@query("c3_operating_point", _points_sql([5]))
def c3(spark, sf_dir):
    sweep = D.threshold_sweep(scored(spark, sf_dir), severe(), "p")
    return rounded(D.operating_points(sweep, [5.0]))


@query("c4_operating_points", _points_sql([3, 5, 10]))
def c4(spark, sf_dir):
    sweep = D.threshold_sweep(scored(spark, sf_dir), severe(), "p")
    return rounded(D.operating_points(sweep))


@query(
    "c5_capacity",
    f"""{with_scored('')[:-1]},
ranked AS (SELECT y, p, ROW_NUMBER() OVER (ORDER BY p DESC, k) AS rn, COUNT(*) OVER () AS n,
  COUNT(*) FILTER (WHERE y >= 4) OVER () AS np FROM scored),
cap AS (SELECT f, y, p, rn, np, CAST(round_even(f * n, 0) AS BIGINT) AS cap
  FROM ranked, (VALUES (0.25::DOUBLE), (0.30::DOUBLE), (0.35::DOUBLE), (0.40::DOUBLE)) c(f))
SELECT f AS capacity_fraction, MAX(cap) AS cases_progressed,
  ROUND(MIN(p) FILTER (WHERE rn <= cap), 6) AS implied_threshold,
  {r('CAST(COUNT(*) FILTER (WHERE y >= 4 AND rn <= cap) AS DOUBLE) / MAX(np)', 'severe_recall')},
  {r('CAST(COUNT(*) FILTER (WHERE y >= 4 AND rn <= cap) AS DOUBLE) / MAX(cap)', 'severe_precision')},
  COUNT(*) FILTER (WHERE y >= 4 AND rn > cap) AS severe_missed
FROM cap GROUP BY f""",
)
def c5(spark, sf_dir):
    # Scores are compared at full precision; only the report is rounded.
    return rounded(D.capacity_analysis(scored(spark, sf_dir), severe(), "p", "k"))


def _side(classes) -> str:
    best = "GREATEST(" + ",".join(f"p{c}" for c in classes) + ")"
    return "CASE " + " ".join(f"WHEN p{c} = {best} THEN {c}" for c in classes) + " END"


def _decided(threshold: float) -> str:
    return (
        f"{with_scored('')[:-1]},\ndec AS (SELECT *, p4 + p5 + p6 >= {threshold}::DOUBLE AS progress FROM scored),\n"
        "adj AS (SELECT *, CAST(CASE WHEN progress AND pred < 4 THEN "
        + _side((4, 5, 6))
        + " WHEN NOT progress AND pred >= 4 THEN "
        + _side((1, 2, 3))
        + " ELSE pred END AS INTEGER) AS adjusted FROM dec)"
    )


@query(
    "c6_cost_aware_class",
    _decided(THRESHOLD) + "\nSELECT k, pred AS argmax, adjusted, progress FROM adj",
)
def c6(spark, sf_dir):
    df = scored(spark, sf_dir)
    made = D.cost_aware_columns(F.col("proba"), THRESHOLD)
    return df.select("k", *[c.alias(n) for n, c in made.items()])


COMPARED = ("qwk", "macro_f1", "severe_recall", "severe_precision", "severe_missed",
            "non_severe_progressed")


@query(
    "c7_rule_comparison",
    _decided(THRESHOLD)
    + ",\nboth_rules AS (SELECT 'argmax' AS rule, y, pred FROM adj UNION ALL SELECT 'cost_aware', y, adjusted FROM adj)\n"
    + "SELECT rule, "
    + ", ".join(r(POINT_SQL[n], n) for n in COMPARED)
    + " FROM both_rules GROUP BY rule",
)
def c7(spark, sf_dir):
    return rounded(D.compare_rules(scored(spark, sf_dir), "y", "proba", THRESHOLD).select("rule", *COMPARED))


_PRED_SQL = (
    _decided(THRESHOLD)
    + ",\npredicted AS (SELECT k, adjusted AS predicted_severity, "
    + f"CASE WHEN progress THEN '{D.PROGRESSED}' ELSE '{D.NOT_PROGRESSED}' END AS decision, "
    + "round_even(p, 4) AS p_severe, pred AS argmax_severity, "
    + ", ".join(f"round_even(p{c}, 4) AS p_{c}" for c in M.CLASSES)
    + " FROM adj)"
)


@query("c8_prediction_table", _PRED_SQL + "\nSELECT * FROM predicted")
def c8(spark, sf_dir):
    return D.prediction_table(scored(spark, sf_dir), "k", "proba", THRESHOLD)


@query(
    "c9_predicted_distribution",
    _PRED_SQL
    + f"""\nSELECT predicted_severity, COUNT(*) AS n,
  {r('CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER ()', 'share')},
  {r(f"SUM(COUNT(*) FILTER (WHERE decision = '{D.PROGRESSED}')) OVER () / CAST(SUM(COUNT(*)) OVER () AS DOUBLE)", 'progressed_share')}
FROM predicted GROUP BY predicted_severity""",
)
def c9(spark, sf_dir):
    table = D.prediction_table(scored(spark, sf_dir), "k", "proba", THRESHOLD)
    return rounded(D.predicted_distribution(table))
