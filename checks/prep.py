"""Fitted preprocessing, splits and weights on the feature frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.operators import prep as T
from casewright.operators import splits as R
from casewright.operators.features import FeatureSpec
from casewright.session import staged
from checks.featuring import SPEC
from checks.fixture import cleaned, feature_frame, with_clean, with_features
from checks.metrics import r, rounded
from checks.profiling import long_sql
from checks.registry import query

NUMERIC = list(SPEC.numeric)
K, REPEATS = 5, 3


@query(
    "t1_median_imputation",
    with_features(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 'median')}, "
            f"COUNT(*) - COUNT({c}) AS n_filled FROM features"
            for c in NUMERIC
        )
    ),
)
def t1(spark, sf_dir):
    frame, spec = feature_frame(spark, sf_dir)
    frame = staged(frame)
    table = T.medians(frame, spec.numeric)
    gaps = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in spec.numeric])
    filled = gaps.unpivot([], list(spec.numeric), "column", "n_filled")
    return rounded(table.join(filled, "column"))


_SPREAD = ["loss_gbp", "impact_score", "delay_days"]


@query("t1b_fold_medians")
def t1b(spark, sf_dir):
    """Medians of fifteen training sets in one pass: spread per column."""
    frame = staged(cleaned(spark, sf_dir).select("k", "severity", *_SPREAD))
    folded = R.repeated_stratified_folds(frame, "k", "severity", k=K, repeats=REPEATS)
    masks = {f"m{i}_{f}": F.col(f"fold_{i}") != f for i in range(REPEATS) for f in range(K)}
    table = T.medians(folded, _SPREAD, masks)
    return rounded(
        table.select(
            "column", F.least(*masks).alias("lowest"), F.greatest(*masks).alias("highest")
        )
    )


def _masked_medians_sql() -> str:
    sets = ", ".join(f"quantile_cont(v, 0.5) FILTER (WHERE k % {K} <> {f}) AS m{f}" for f in range(K))
    out = ", ".join(r(f"m{f}", f"m{f}") for f in range(K))
    return f"""{with_clean('')[:-1]}, long AS ({long_sql(_SPREAD, keep='k')}),
med AS (SELECT col, {sets} FROM long GROUP BY col)
SELECT col AS "column", {out} FROM med"""


@query("t1c_masked_medians", _masked_medians_sql())
def t1c(spark, sf_dir):
    """Medians of five training sets, masks by remainder of the key, in one pass."""
    frame = cleaned(spark, sf_dir).select("k", *_SPREAD)
    masks = {f"m{f}": F.col("k") % K != f for f in range(K)}
    return rounded(T.medians(frame, _SPREAD, masks))


_MODE_SQL = """cnt AS ({long}),
best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY col ORDER BY n DESC, v) AS rn FROM cnt)
SELECT col AS "column", v AS mode FROM best WHERE rn = 1"""
_MODE_COLUMNS = ["route", "segment", "priority_level", "scale_level"]


@query(
    "t2_mode_imputation",
    with_clean("")[:-1]
    + ",\n"
    + _MODE_SQL.format(
        long=" UNION ALL ".join(
            f"SELECT '{c}' AS col, {c} AS v, COUNT(*) AS n FROM clean WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in _MODE_COLUMNS
        )
    ),
)
def t2(spark, sf_dir):
    return T.modes(T.level_counts(cleaned(spark, sf_dir), _MODE_COLUMNS))


_SCALED = ["impact_score", "loss_gbp", "duration_days", "priority_level_code", "flag_count",
           "balance_to_loss", "segment_missing"]


def _filled(c: str) -> str:
    return f"COALESCE(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM features))"


@query(
    "t3_standard_scaling",
    with_features(
        "SELECT k, "
        + ", ".join(f"ROUND((f_{c} - m_{c}) / COALESCE(NULLIF(s_{c}, 0), 1), 6) AS {c}" for c in _SCALED)
        + " FROM (SELECT k, "
        + ", ".join(f"{_filled(c)} AS f_{c}" for c in _SCALED)
        + " FROM features) x, (SELECT "
        + ", ".join(f"AVG({_filled(c)}) AS m_{c}, STDDEV_POP({_filled(c)}) AS s_{c}" for c in _SCALED)
        + " FROM features) y"
    ),
)
def t3(spark, sf_dir):
    frame, spec = feature_frame(spark, sf_dir)
    prep = T.fit_preprocessor(frame, spec.only(_SCALED))
    return rounded(prep.select(frame, ["k"]).select("k", *_SCALED))


_RARE_LIST = "(SELECT list(label) FROM lev WHERE n < 5)"


@query(
    "t4_one_hot",
    with_clean("")[:-1]
    + """,
lab AS (SELECT k, CASE WHEN k % 17 <> 0 THEN 'L' || CAST(CAST(n_failures AS BIGINT) AS VARCHAR) END AS label FROM clean),
lev0 AS (SELECT label, COUNT(*) AS n FROM lab WHERE label IS NOT NULL GROUP BY label),
md AS (SELECT label FROM lev0 ORDER BY n DESC, label LIMIT 1),
lev AS (SELECT label, n + CASE WHEN label = (SELECT label FROM md) THEN (SELECT COUNT(*) FROM lab WHERE label IS NULL) ELSE 0 END AS n FROM lev0),
fil AS (SELECT k, COALESCE(label, (SELECT label FROM md)) AS label FROM lab)
SELECT CASE WHEN lev.n < 5 THEN 'infrequent' ELSE fil.label END AS output, COUNT(*) AS n_ones, CAST(SUM(k) AS BIGINT) AS key_sum
FROM fil JOIN lev ON lev.label = fil.label GROUP BY 1""",
)
def t4(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    label = F.concat(F.lit("L"), F.col("n_failures").cast("bigint").cast("string"))
    rows = frame.select("k", F.when(F.col("k") % 17 != 0, label).alias("label"))
    prep = T.fit_preprocessor(rows, FeatureSpec(nominal=("label",)))
    made = prep.select(rows, ["k"])
    long = made.unpivot(["k"], prep.names, "output", "value").where(F.col("value") == 1)
    return long.groupBy(F.regexp_replace("output", "^label_", "").alias("output")).agg(
        F.count(F.lit(1)).alias("n_ones"), F.sum("k").alias("key_sum")
    )


@query(
    "t5_column_transform",
    with_features(
        "SELECT k, "
        + ", ".join(f"ROUND({_filled(c)}, 6) AS {c}" for c in ("impact_score", "total_loss", "vulnerability"))
        + ", "
        + ", ".join(f"CAST(COALESCE(route, (SELECT route FROM features WHERE route IS NOT NULL GROUP BY route ORDER BY COUNT(*) DESC, route LIMIT 1)) = '{v}' AS DOUBLE) AS route_{v}" for v in "FOP")
        + " FROM features"
    ),
)
def t5(spark, sf_dir):
    frame, spec = feature_frame(spark, sf_dir)
    chosen = spec.only(["impact_score", "total_loss", "vulnerability", "route"])
    prep = T.fit_preprocessor(frame, chosen, scaled=False)
    return rounded(prep.select(frame, ["k"]))


@query(
    "r1_stratified_holdout",
    with_clean(
        "SELECT severity, COUNT(*) AS n, CAST(round_even(0.2::DOUBLE * COUNT(*), 0) AS BIGINT) AS n_test FROM clean GROUP BY severity"
    ),
)
def r1(spark, sf_dir):
    split = R.stratified_holdout(cleaned(spark, sf_dir), "k", "severity")
    return split.groupBy("severity").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test")
    )


def _fold_sizes(remainder: str) -> str:
    return f"CAST(FLOOR(n / {K}) AS BIGINT) + CAST({remainder} < n % {K} AS BIGINT) AS n"


@query(
    "r2_stratified_folds",
    with_clean(
        f"""SELECT CAST(rep AS INTEGER) AS "repeat", severity, CAST(fold AS INTEGER) AS fold,
  {_fold_sizes(f'(((fold - severity) % {K}) + {K}) % {K}')}
FROM (SELECT severity, COUNT(*) AS n FROM clean GROUP BY severity) c, range({REPEATS}) a(rep), range({K}) b(fold)"""
    ),
)
def r2(spark, sf_dir):
    folded = R.repeated_stratified_folds(cleaned(spark, sf_dir), "k", "severity", k=K, repeats=REPEATS)
    long = folded.unpivot(["severity"], [f"fold_{i}" for i in range(REPEATS)], "r", "fold")
    return long.groupBy(
        F.regexp_replace("r", "fold_", "").cast("int").alias("repeat"), "severity", "fold"
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "r3_plain_folds",
    with_clean(
        f"SELECT CAST(fold AS INTEGER) AS fold, {_fold_sizes('fold')} FROM (SELECT COUNT(*) AS n FROM clean) c, range({K}) b(fold)"
    ),
)
def r3(spark, sf_dir):
    folded = R.plain_folds(cleaned(spark, sf_dir), "k", k=K)
    return folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "r4_class_weights",
    with_clean(
        f"SELECT severity, COUNT(*) AS n, {r('CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (COUNT(*) OVER () * COUNT(*))', 'weight')} FROM clean GROUP BY severity"
    ),
)
def r4(spark, sf_dir):
    return rounded(R.class_weights(cleaned(spark, sf_dir), "severity"))


@query(
    "r5_seeded_sample",
    with_clean("SELECT LEAST(500, COUNT(*)) AS n, LEAST(500, COUNT(*)) AS n_keys FROM clean"),
)
def r5(spark, sf_dir):
    sample = R.seeded_sample(cleaned(spark, sf_dir), "k", 500)
    return sample.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("n_keys"))
