"""Profiling, association and drift operators on the cleaned case table."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.operators import association as A
from casewright.operators import profile as P
from casewright.operators import quality as Q
from casewright.operators.prep import medians
from checks.fixture import (
    BOOLEAN_COLUMNS,
    CATALOG,
    HOLDBACK_FROM,
    NOMINAL_COLUMNS,
    NUMERIC_COLUMNS,
    ORDINAL_COLUMNS,
    cases,
    cleaned,
    feature_frame,
    split_datasets,
    with_cases,
    with_clean,
    with_features,
)
from checks.metrics import r, rounded
from checks.quality import CONTRACT_COLUMNS, _RAW_TYPES, missingness_sql
from checks.registry import query

CLASSES = range(1, 7)
LEVELLED = [*NOMINAL_COLUMNS, *ORDINAL_COLUMNS]
CATEGORICAL = [*LEVELLED, *BOOLEAN_COLUMNS]
EARLY = "created_serial < TIMESTAMP '2000-01-01'"


def long_sql(columns, relation="clean", keep="", cast="DOUBLE") -> str:
    extra = keep and keep + ", "
    return " UNION ALL ".join(
        f"SELECT {extra}'{c}' AS col, CAST({c} AS {cast}) AS v FROM {relation}" for c in columns
    )


@query(
    "p1_target_distribution",
    with_clean(
        """SELECT class, n, share_pct FROM (
  SELECT CAST(severity AS VARCHAR) AS class, COUNT(*) AS n,
    round_even(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100, 2) AS share_pct FROM clean GROUP BY severity
  UNION ALL
  SELECT 'progressed (>=4)', CAST(SUM(n) AS BIGINT), round_even(SUM(s), 2) FROM (
    SELECT severity, COUNT(*) AS n, round_even(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () * 100, 2) AS s
    FROM clean GROUP BY severity) x WHERE severity >= 4) t"""
    ),
)
def p1(spark, sf_dir):
    return P.target_distribution(cleaned(spark, sf_dir), "severity")


_NO_TARGET = [c for c in CONTRACT_COLUMNS if c not in ("severity", "investigated_flag")]


@query(
    "p2_missingness_pair",
    with_cases(
        f"""SELECT a."column", a.missing, a.missing_pct, b.missing_pct AS missing_pct_other
FROM ({missingness_sql(f'(SELECT * FROM cases WHERE created_serial < {HOLDBACK_FROM}) e', _NO_TARGET, _RAW_TYPES)}) a
LEFT JOIN ({missingness_sql(f'(SELECT * FROM cases WHERE created_serial >= {HOLDBACK_FROM}) e', _NO_TARGET, _RAW_TYPES)}) b
ON a."column" = b."column" """
    ),
)
def p2(spark, sf_dir):
    early, late = split_datasets(cases(spark, sf_dir))
    return P.missingness_pair(Q.missingness(early, _NO_TARGET), Q.missingness(late, _NO_TARGET))


def chi2_sql(counts: str, by: str = "col") -> str:
    """Chi-square from (by, a, b, n) over the full grid of levels, Yates at 2 x 2."""
    return f"""cnt AS ({counts}),
ra AS (SELECT {by}, a, CAST(SUM(n) AS DOUBLE) AS r FROM cnt GROUP BY {by}, a),
cb AS (SELECT {by}, b, CAST(SUM(n) AS DOUBLE) AS c FROM cnt GROUP BY {by}, b),
tt AS (SELECT {by}, CAST(SUM(n) AS DOUBLE) AS t, COUNT(DISTINCT a) AS ka, COUNT(DISTINCT b) AS kb FROM cnt GROUP BY {by}),
cell AS (SELECT ra.{by}, COALESCE(cnt.n, 0) AS o, r * c / t AS e, t, ka, kb
  FROM ra JOIN cb ON ra.{by} = cb.{by} JOIN tt ON tt.{by} = ra.{by}
  LEFT JOIN cnt ON cnt.{by} = ra.{by} AND cnt.a = ra.a AND cnt.b = cb.b),
chi AS (SELECT {by}, CAST(MAX(t) AS BIGINT) AS n, MAX(ka) AS n_rows, MAX(kb) AS n_columns,
  CAST(MAX((ka - 1) * (kb - 1)) AS INTEGER) AS dof,
  SUM(CASE WHEN ka = 2 AND kb = 2 THEN (ABS(o - e) - LEAST(0.5, ABS(o - e))) * (ABS(o - e) - LEAST(0.5, ABS(o - e))) / e
      ELSE (o - e) * (o - e) / e END) AS chi2 FROM cell GROUP BY {by})"""


_GAPPY = ["impact_score", "risk_score", "loss_gbp", "duration_days", "priority_level",
          "scale_level", "route", "segment"]
_MISSING_COUNTS = (
    "SELECT col, a, b, COUNT(*) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} IS NULL AS a, severity AS b FROM clean" for c in _GAPPY
    )
    + ") z GROUP BY col, a, b"
)


@query(
    "p3_missing_vs_target",
    f"{with_clean('')[:-1]},\n{chi2_sql(_MISSING_COUNTS)}\n"
    f"SELECT col AS \"column\", n, dof, {r('chi2', 'chi2')} FROM chi",
)
def p3(spark, sf_dir):
    table = A.missing_vs_target(cleaned(spark, sf_dir), _GAPPY, "severity")
    return rounded(table.select("column", "n", "dof", "chi2"))


def chi_p_sql(chi2: str = "chi2", dof: str = "dof") -> str:
    """Upper tail of chi-square: one minus the series of the lower incomplete gamma function."""
    half, a = f"(CAST({chi2} AS DOUBLE) / 2)", f"(CAST({dof} AS DOUBLE) / 2)"
    series = f"(SELECT SUM(exp(({a} + i) * ln({half}) - {half} - lgamma({a} + i + 1))) FROM range(2000) g(i))"
    # Beyond 700 the tail is below any digit shown and the series would need more terms.
    return (
        f"CASE WHEN {half} <= 0 THEN 1::DOUBLE WHEN {half} > 700 THEN 0::DOUBLE "
        f"ELSE GREATEST(0::DOUBLE, LEAST(1::DOUBLE, 1 - {series})) END"
    )


def ks_p_sql() -> str:
    """Asymptotic two-sample tail: the alternating series, from (statistic, n_a, n_b)."""
    scaled = "(statistic * sqrt(CAST(n_a AS DOUBLE) * n_b / (n_a + n_b)))"
    series = f"(SELECT SUM((CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END) * exp(-2 * j * j * {scaled} * {scaled})) FROM range(1, 101) g(j))"
    return f"CASE WHEN {scaled} < 0.2 THEN 1::DOUBLE ELSE GREATEST(0::DOUBLE, LEAST(1::DOUBLE, {series})) END"


@query(
    "p3b_missing_vs_target_p",
    f"{with_clean('')[:-1]},\n{chi2_sql(_MISSING_COUNTS)}\n"
    f"SELECT col AS \"column\", {r(chi_p_sql(), 'p_value')} FROM chi",
)
def p3b(spark, sf_dir):
    table = A.missing_vs_target(cleaned(spark, sf_dir), _GAPPY, "severity")
    return rounded(table.select("column", "p_value"))


@query(
    "p4_describe",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(NUMERIC_COLUMNS)})
SELECT col AS "column", COUNT(v) AS count, {r('AVG(v)', 'mean')}, {r('STDDEV_SAMP(v)', 'std')}, {r('MIN(v)', 'min')},
  {r('MAX(v)', 'max')}, {r('SKEWNESS(v)', 'skew')}, {r('SKEWNESS(CASE WHEN v IS NOT NULL THEN ln(1 + GREATEST(v, 0)) END)', 'log1p_skew')},
  {r('quantile_cont(v, 0.5)', 'median')} FROM long GROUP BY col""",
)
def p4(spark, sf_dir):
    return rounded(P.describe(cleaned(spark, sf_dir), NUMERIC_COLUMNS))


@query(
    "p5_iqr_outliers",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(NUMERIC_COLUMNS)}),
q AS (SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY col)
SELECT long.col AS "column", COUNT(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS iqr_outliers
FROM long JOIN q ON q.col = long.col GROUP BY long.col""",
)
def p5(spark, sf_dir):
    return P.iqr_outliers(cleaned(spark, sf_dir), NUMERIC_COLUMNS)


@query(
    "p6_z_outliers",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(NUMERIC_COLUMNS)}),
q AS (SELECT col, AVG(v) AS m, STDDEV_POP(v) AS s FROM long GROUP BY col)
SELECT long.col AS "column", COUNT(*) FILTER (WHERE s > 0 AND ABS(v - m) > 3 * s) AS z_outliers
FROM long JOIN q ON q.col = long.col GROUP BY long.col""",
)
def p6(spark, sf_dir):
    return P.z_outliers(cleaned(spark, sf_dir), NUMERIC_COLUMNS)


@query(
    "p7_max_over_p99",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(NUMERIC_COLUMNS)})
SELECT col AS "column", {r('MAX(v) / GREATEST(quantile_cont(v, 0.99), 1e-9)', 'max_over_p99')} FROM long GROUP BY col""",
)
def p7(spark, sf_dir):
    return rounded(P.tail_weight(cleaned(spark, sf_dir), NUMERIC_COLUMNS))


def _position_sql() -> str:
    cases_ = []
    for c in ORDINAL_COLUMNS:
        for i, v in enumerate(CATALOG.levels(c)):
            cases_.append(f"WHEN col = '{c}' AND v = '{v}' THEN {i}")
    return (
        "CAST(CASE " + " ".join(cases_)
        + " ELSE ROW_NUMBER() OVER (PARTITION BY col ORDER BY v) - 1 END AS INTEGER) AS position"
    )


@query(
    "p8_level_counts",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(LEVELLED, cast='VARCHAR')})
SELECT col AS "column", v AS level, COUNT(*) AS n, {_position_sql()} FROM long WHERE v IS NOT NULL GROUP BY col, v""",
)
def p8(spark, sf_dir):
    return P.level_counts(cleaned(spark, sf_dir), LEVELLED, CATALOG)


@query(
    "p9_yes_share",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(BOOLEAN_COLUMNS, cast='VARCHAR')})
SELECT col AS "column", {r("AVG(CAST(COALESCE(v = 'Yes', false) AS DOUBLE))", 'share_yes')} FROM long GROUP BY col""",
)
def p9(spark, sf_dir):
    return rounded(P.yes_shares(cleaned(spark, sf_dir), BOOLEAN_COLUMNS))


def class_range_sql(column: str, relation: str = "clean") -> str:
    return (
        f"SELECT severity, MIN({column}) AS min, MAX({column}) AS max, "
        + ", ".join(
            r(f"quantile_cont(CAST({column} AS DOUBLE), {q})", n)
            for n, q in (("p5", 0.05), ("median", 0.5), ("p95", 0.95))
        )
        + f" FROM {relation} GROUP BY severity"
    )


@query("p10_class_ranges", with_clean(class_range_sql("impact_score")))
def p10(spark, sf_dir):
    return rounded(P.class_ranges(cleaned(spark, sf_dir), "impact_score", "severity"))


def _crosstab(column: str) -> str:
    return (
        f"SELECT {column} AS label, "
        + ", ".join(f"COUNT(*) FILTER (WHERE severity = {c}) AS class_{c}" for c in CLASSES)
        + f" FROM clean WHERE {column} IS NOT NULL GROUP BY {column}"
    )


@query("p11_crosstab", with_clean(_crosstab("priority_level")))
def p11(spark, sf_dir):
    return P.crosstab(cleaned(spark, sf_dir), "priority_level", "severity", CLASSES)


_LEAKY = ["investigated_flag", *BOOLEAN_COLUMNS, "route", "segment", "priority_level", "scale_level"]


@query(
    "p12_leak_check",
    f"""{with_cases('')[:-1]}, long AS ({long_sql(_LEAKY, 'cases', 'severity', 'VARCHAR')}),
side AS (SELECT col, v, COUNT(*) FILTER (WHERE severity >= 4) AS up, COUNT(*) FILTER (WHERE severity < 4) AS down
  FROM long WHERE v IS NOT NULL GROUP BY col, v)
SELECT col AS "column", COUNT(*) AS n_levels, CAST(SUM(up + down) AS BIGINT) AS n,
  CAST(SUM(LEAST(up, down)) AS BIGINT) AS off_diagonal FROM side GROUP BY col""",
)
def p12(spark, sf_dir):
    return P.leak_check(cases(spark, sf_dir), _LEAKY, "severity")


@query(
    "p13_row_shares",
    with_clean(
        "SELECT label, "
        + ", ".join(
            r(f"CAST(class_{c} AS DOUBLE) / (class_1+class_2+class_3+class_4+class_5+class_6)", f"class_{c}")
            for c in CLASSES
        )
        + f" FROM ({_crosstab('route')}) t"
    ),
)
def p13(spark, sf_dir):
    counts = P.crosstab(cleaned(spark, sf_dir), "route", "severity", CLASSES)
    return rounded(P.row_shares(counts, CLASSES))


_SPEARMAN = [
    *[("severity", c) for c in (*NUMERIC_COLUMNS, "priority_level_code", "scale_level_code")],
    ("impact_score", "risk_score"),
    ("discount_gbp", "tax_gbp"),
    ("duration_days", "n_failures"),
]


def _spearman_sql(pairs) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y "
        f"FROM features WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        for a, b in pairs
    )
    return f"""{with_features('')[:-1]}, pr AS ({parts}),
rk AS (SELECT a, b, RANK() OVER (PARTITION BY a, b ORDER BY x) + (COUNT(*) OVER (PARTITION BY a, b, x) - 1) / CAST(2 AS DOUBLE) AS rx,
  RANK() OVER (PARTITION BY a, b ORDER BY y) + (COUNT(*) OVER (PARTITION BY a, b, y) - 1) / CAST(2 AS DOUBLE) AS ry FROM pr)
SELECT a, b, COUNT(*) AS n, {r('CORR(rx, ry)', 'spearman')} FROM rk GROUP BY a, b"""


@query("p14_spearman", _spearman_sql(_SPEARMAN))
def p14(spark, sf_dir):
    frame, _ = feature_frame(spark, sf_dir)
    return rounded(A.spearman(frame, _SPEARMAN))


_MATRIX = ["severity", *NUMERIC_COLUMNS, "priority_level_code", "scale_level_code"]


@query(
    "p14b_spearman_matrix",
    _spearman_sql([(a, b) for i, a in enumerate(_MATRIX) for b in _MATRIX[i + 1 :]]),
)
def p14b(spark, sf_dir):
    """All pairs of the class, the numeric columns and the ordinal codes, each column ranked once."""
    frame, _ = feature_frame(spark, sf_dir)
    return rounded(A.spearman_matrix(frame, _MATRIX))


@query("p15_variance_inflation")
def p15(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    fills = {row["column"]: row["median"] for row in medians(frame, NUMERIC_COLUMNS).collect()}
    table = A.variance_inflation(frame, fills)
    return rounded(table.withColumn("above_5", F.col("vif") > 5))


_VIF_PAIR = ("impact_score", "duration_days")


def _vif_pair_sql() -> str:
    a, b = _VIF_PAIR
    filled = ", ".join(
        f"COALESCE(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM clean)) AS {n}"
        for c, n in ((a, "x"), (b, "y"))
    )
    vif = r("xx * yy / (xx * yy - xy * xy)", "vif")
    return f"""{with_clean('')[:-1]}, fil AS (SELECT {filled} FROM clean),
g AS (SELECT SUM(x * x) AS xx, SUM(x * y) AS xy, SUM(y * y) AS yy FROM fil)
SELECT '{a}' AS "column", {vif} FROM g UNION ALL SELECT '{b}' AS "column", {vif} FROM g"""


@query("p15b_variance_inflation_pair", _vif_pair_sql())
def p15b(spark, sf_dir):
    """Two columns, whose inverse SQL can write out."""
    frame = cleaned(spark, sf_dir)
    fills = {row["column"]: row["median"] for row in medians(frame, _VIF_PAIR).collect()}
    return rounded(A.variance_inflation(frame, fills))


def _assoc_counts(columns) -> str:
    return (
        "SELECT col, COALESCE(v, '(missing)') AS a, severity AS b, COUNT(*) AS n FROM ("
        + long_sql(columns, keep="severity", cast="VARCHAR")
        + ") z GROUP BY ALL"
    )


@query(
    "p16_cramers_v",
    f"""{with_clean('')[:-1]},\n{chi2_sql(_assoc_counts(CATEGORICAL))}
SELECT col AS "column", n, {r('chi2', 'chi2')}, {r('sqrt(chi2 / (n * (LEAST(n_rows, n_columns) - 1)))', 'cramers_v')}
FROM chi WHERE LEAST(n_rows, n_columns) > 1""",
)
def p16(spark, sf_dir):
    table = A.cramers_v(cleaned(spark, sf_dir), CATEGORICAL, "severity")
    return rounded(table.select("column", "n", "chi2", "cramers_v"))


@query(
    "p17_mutual_information",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(NUMERIC_COLUMNS, keep='severity')}),
q AS (SELECT col, """
    + ", ".join(f"quantile_cont(v, {i / 10}) AS q{i}" for i in range(1, 10))
    + """ FROM long GROUP BY col),
binned AS (SELECT long.severity, long.col, CASE WHEN v IS NULL THEN '(missing)' ELSE CAST("""
    + " + ".join(f"CAST(v > q{i} AS INTEGER)" for i in range(1, 10))
    + f""" AS VARCHAR) END AS lev FROM long JOIN q ON q.col = long.col
  UNION ALL SELECT severity, col, COALESCE(v, '(missing)') FROM ({long_sql(CATEGORICAL, keep='severity', cast='VARCHAR')}) z),
jc AS (SELECT col, lev, severity, CAST(COUNT(*) AS DOUBLE) AS o FROM binned GROUP BY ALL),
mg AS (SELECT *, SUM(o) OVER (PARTITION BY col, lev) AS rr, SUM(o) OVER (PARTITION BY col, severity) AS cc,
  SUM(o) OVER (PARTITION BY col) AS tt FROM jc)
SELECT col AS "column", {r('SUM(o / tt * ln(o * tt / (rr * cc)))', 'mi')} FROM mg GROUP BY col""",
)
def p17(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    return rounded(A.mutual_information(frame, NUMERIC_COLUMNS, CATEGORICAL, "severity"))


@query(
    "p18_subgroup_rates",
    f"""{with_clean('')[:-1]}, long AS ({long_sql(LEVELLED, keep='severity', cast='VARCHAR')})
SELECT col AS "column", COALESCE(v, '(missing)') AS level, {r('AVG(CAST(severity >= 4 AS DOUBLE))', 'rate')}, COUNT(*) AS n
FROM long GROUP BY ALL""",
)
def p18(spark, sf_dir):
    return rounded(P.subgroup_rates(cleaned(spark, sf_dir), LEVELLED, "severity"))


_KS_SQL = f"""both_sets AS ({long_sql(NUMERIC_COLUMNS, keep=EARLY + ' AS early')}),
vals AS (SELECT col, v, COUNT(*) FILTER (WHERE early) AS a, COUNT(*) FILTER (WHERE NOT early) AS b
  FROM both_sets WHERE v IS NOT NULL GROUP BY col, v),
cdf AS (SELECT col, SUM(a) OVER w / CAST(SUM(a) OVER (PARTITION BY col) AS DOUBLE) AS fa,
  SUM(b) OVER w / CAST(SUM(b) OVER (PARTITION BY col) AS DOUBLE) AS fb,
  SUM(a) OVER (PARTITION BY col) AS na, SUM(b) OVER (PARTITION BY col) AS nb
  FROM vals WINDOW w AS (PARTITION BY col ORDER BY v)),
ks AS (SELECT col, MAX(ABS(fa - fb)) AS statistic, CAST(MAX(na) AS BIGINT) AS n_a, CAST(MAX(nb) AS BIGINT) AS n_b FROM cdf GROUP BY col)"""


@query(
    "p19_kolmogorov_smirnov",
    f"""{with_clean('')[:-1]},\n{_KS_SQL}
SELECT col AS "column", {r('statistic', 'statistic')}, n_a, n_b FROM ks""",
)
def p19(spark, sf_dir):
    early, late = split_datasets(cleaned(spark, sf_dir))
    table = A.kolmogorov_smirnov(early, late, NUMERIC_COLUMNS)
    return rounded(table.select("column", "statistic", "n_a", "n_b"))


_SHIFT_COUNTS = (
    f"SELECT col, early AS a, v AS b, COUNT(*) AS n FROM ({long_sql(LEVELLED, keep=EARLY + ' AS early', cast='VARCHAR')}) z"
    " WHERE v IS NOT NULL GROUP BY ALL"
)


@query(
    "p20_chi_square_shift",
    f"""{with_clean('')[:-1]},\n{chi2_sql(_SHIFT_COUNTS)}
SELECT col AS "column", n, dof, {r('chi2', 'chi2')} FROM chi""",
)
def p20(spark, sf_dir):
    early, late = split_datasets(cleaned(spark, sf_dir))
    table = A.chi_square_shift(early, late, LEVELLED)
    return rounded(table.select("column", "n", "dof", "chi2"))


@query(
    "p21_shift_table",
    f"""{with_clean('')[:-1]},\n{_KS_SQL},\n{chi2_sql(_SHIFT_COUNTS)},
both_tests AS (SELECT col, 'KS' AS test, statistic, {ks_p_sql()} AS p FROM ks
  UNION ALL SELECT col, 'chi2' AS test, chi2 AS statistic, {chi_p_sql()} AS p FROM chi)
SELECT col AS "column", test, {r('statistic', 'statistic')}, {r('p', 'p_value')}, p < 0.05 AS shifted FROM both_tests""",
)
def p21(spark, sf_dir):
    early, late = split_datasets(cleaned(spark, sf_dir))
    table = A.shift_table(
        A.kolmogorov_smirnov(early, late, NUMERIC_COLUMNS),
        A.chi_square_shift(early, late, LEVELLED),
    )
    return rounded(table.withColumn("shifted", F.col("p_value") < 0.05))


@query(
    "p22_date_range",
    with_clean(
        f"""SELECT CASE WHEN {EARLY} THEN 'train' ELSE 'holdback' END AS dataset,
  CAST(MIN(created_serial) AS DATE) AS first_date, CAST(MAX(created_serial) AS DATE) AS last_date FROM clean GROUP BY 1"""
    ),
)
def p22(spark, sf_dir):
    early, late = split_datasets(cleaned(spark, sf_dir))
    return P.date_range({"train": early, "holdback": late}, "created_serial")
