"""Feature operators on the cleaned case table."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright.contracts import observed_values
from casewright.operators import features as ft
from checks.fixture import (
    FEATURES_CTE,
    NOMINAL_COLUMNS,
    NUMERIC_COLUMNS,
    PLAN,
    cases,
    cleaned,
    feature_frame,
    split_datasets,
    with_clean,
    with_features,
)
from checks.metrics import rounded
from checks.quality import _count_union
from checks.registry import query

# Every feature of the plan: column types are known without reading data.
CLEAN_COLUMNS = [c for c in PLAN.catalog.names if c not in PLAN.catalog.leaks]
SPEC = ft.spec_of(CLEAN_COLUMNS, PLAN)
SPEC_B = ft.spec_of(CLEAN_COLUMNS, PLAN.in_regime("B"))


def _chosen(names) -> str:
    return with_features(
        "SELECT k, "
        + ", ".join(c if c in NOMINAL_COLUMNS else f"ROUND({c}, 6) AS {c}" for c in names)
        + " FROM features"
    )


def _run(names, regime="A"):
    def run(spark, sf_dir):
        frame, _ = feature_frame(spark, sf_dir, regime)
        return rounded(frame.select("k", *names))

    return run


_LOGS = [c for c in SPEC.numeric if c.startswith("log_")]
_DATES = ["case_year", "case_month", "case_quarter", "case_dayofweek"]
for _name, _cols in {
    "f1_numeric_passthrough": NUMERIC_COLUMNS,
    "f2_ordinal_code": ["priority_level_code", "scale_level_code"],
    "f3_boolean_flag": ["repeated_flag", "disputed_flag", "open_flag"],
    "f4_nominal_passthrough": ["route", "segment"],
    "f5_case_age": ["case_age_days"],
    "f6_date_parts": _DATES,
    "f7_null_skipping_sum": ["total_loss"],
    "f8_log1p": _LOGS,
    "f9_safe_ratio": ["balance_to_loss", "failures_per_organisation", "delay_to_duration"],
    "f10_flag_count": ["flag_count"],
    "f11_level_sum": ["level_sum"],
    "f12_vulnerability": ["vulnerability"],
    "f13_extremity": ["priority_extremity"],
    "f14_failure_intensity": ["failure_intensity"],
    "f15_has_other_category": ["has_segment"],
    "f16_products": ["scale_x_logduration", "vulnerability_x_level"],
    "f17_proxy_mean_and_gap": ["impact_risk_mean", "impact_risk_gap"],
    "f18_missing_indicators": [f"{c}_missing" for c in PLAN.indicators],
    "f20_regime_a": SPEC.columns,
}.items():
    query(_name, _chosen(_cols))(_run(_cols))

query("f20b_regime_b", _chosen(SPEC_B.columns))(_run(SPEC_B.columns, "B"))


def _spec_sql(spec, extra="") -> str:
    groups = ", ".join(
        f"('{c}', '{g}', {str(c in spec.nominal).lower()})" for c, g in spec.groups.items()
    )
    return (
        f"SELECT g.feature, g.feature_group, g.nominal, o.n_values{extra} FROM (VALUES {groups}) g(feature, feature_group, nominal)"
        f" JOIN ({_count_union(spec.columns, 'features')}) o ON o.col = g.feature"
    )


@query("f19_feature_spec", with_features(_spec_sql(SPEC)))
def f19(spark, sf_dir):
    frame, spec = feature_frame(spark, sf_dir)
    seen = observed_values(frame, spec.columns).withColumnRenamed("column", "feature")
    return spec.group_table(spark).join(F.broadcast(seen), "feature")


_DROPPED = SPEC.without_groups(ft.DATE_PARTS, ft.MISSING)


@query(
    "f19b_without_groups",
    with_features(
        f"SELECT feature_group, COUNT(*) AS n_features, CAST(SUM(n_values) AS BIGINT) AS n_values FROM ({_spec_sql(_DROPPED)}) t GROUP BY feature_group"
    ),
)
def f19b(spark, sf_dir):
    frame, spec = feature_frame(spark, sf_dir)
    left = spec.without_groups(ft.DATE_PARTS, ft.MISSING)
    seen = observed_values(frame, left.columns).withColumnRenamed("column", "feature")
    return (
        left.group_table(spark)
        .join(F.broadcast(seen), "feature")
        .groupBy("feature_group")
        .agg(F.count(F.lit(1)).alias("n_features"), F.sum("n_values").alias("n_values"))
    )


@query(
    "f21_split_target",
    with_clean(
        "SELECT x.*, y.severity AS target FROM (SELECT case_ref, impact_score, route, priority_level FROM clean) x"
        " JOIN (SELECT case_ref, severity FROM clean) y ON y.case_ref = x.case_ref"
    ),
)
def f21(spark, sf_dir):
    x, y = ft.split_target(cleaned(spark, sf_dir), PLAN.catalog)
    assert "severity" not in x.columns
    left = x.select("case_ref", "impact_score", "route", "priority_level")
    return left.join(y.withColumnRenamed("severity", "target"), "case_ref")


@query(
    "f22_same_columns",
    with_features(
        "SELECT CASE WHEN case_year < 2000 THEN 'train' ELSE 'score' END AS dataset, "
        f"{len(SPEC.columns)} AS n_features, COUNT(*) AS n_rows FROM features GROUP BY 1"
    ),
)
def f22(spark, sf_dir):
    early, late = split_datasets(cleaned(spark, sf_dir))
    train, spec = ft.engineer(early, PLAN, keep=["k"])
    score, other = ft.engineer(late.drop("severity"), PLAN, keep=["k"])
    ft.require_same_columns(spec, other)
    parts = [
        d.agg(
            F.lit(n).alias("dataset"),
            F.lit(len(s.columns)).alias("n_features"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for n, d, s in (("train", train, spec), ("score", score, other))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "f23_spec_from_schema",
    with_features(
        "SELECT feature, feature_group, n_values FROM (" + _spec_sql(SPEC_B) + ") t"
    ),
)
def f23(spark, sf_dir):
    # The spec comes from column names; only the counts beside it read the table.
    frame = cleaned(spark, sf_dir)
    spec = ft.spec_of(frame.columns, PLAN.in_regime("B"))
    made, _ = ft.engineer(frame, PLAN.in_regime("B"))
    seen = observed_values(made, spec.columns).withColumnRenamed("column", "feature")
    table = spec.group_table(spark).drop("nominal")
    return table.join(F.broadcast(seen), "feature")
