"""Case records derived from the order tables, in Spark and in SQL.

The driver tables hold no nulls and no bad cells, so the case view plants them
by rules on the order key that both engines evaluate alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.contracts import (
    DATE,
    ID,
    IDENTIFIER,
    LEAK,
    NUMERIC,
    TARGET,
    Catalog,
    ColumnContract,
    nominal,
    numeric,
    ordinal,
    yes_no,
)
from casewright.functions import cells
from casewright.functions.probability import argmax_class, ordered_probabilities, tail_probability
from casewright.operators import features as ft
from casewright.operators.quality import clean

# Fixed values of the fixture: levels, cuts of the latent score, scoring constants.
PRIORITIES = ("5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT")
SCALES = ("None", "Minor", "Moderate", "Severe")
SEGMENTS = ("None", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
LATENT_CUTS = (420, 640, 840, 1060, 1250)
THETA = (4.2, 6.4, 8.4, 10.6, 12.5)
STEEPNESS = 2.0
REFERENCE_DATE = "2002-01-01"
HOLDBACK_FROM = 36526  # day number of 2000-01-01

CATALOG = Catalog(
    [
        ColumnContract("case_ref", IDENTIFIER, role=ID),
        numeric("impact_score", 1, 100, integer=True),
        numeric("risk_score", 1, 100, integer=True),
        numeric("loss_gbp", 0, 500000),
        numeric("discount_gbp", 0, 100000),
        numeric("tax_gbp", 0, 100000),
        numeric("balance_gbp", 0, 10000),
        numeric("duration_days", 1, 3000, integer=True),
        numeric("delay_days", 0, 3000, integer=True),
        numeric("n_failures", 0, 20, integer=True),
        numeric("n_organisations", 1, 20, integer=True),
        ordinal("priority_level", *PRIORITIES),
        ordinal("scale_level", *SCALES),
        nominal("route", "F", "O", "P"),
        nominal("segment", *SEGMENTS),
        yes_no("repeated_flag"),
        yes_no("disputed_flag"),
        yes_no("open_flag", documented=False),
        ColumnContract("created_serial", DATE),
        yes_no("investigated_flag", role=LEAK),
        ColumnContract("severity", NUMERIC, role=TARGET, low=1, high=6, integer=True),
    ]
)

MONEY = ("loss_gbp", "discount_gbp", "tax_gbp")

PLAN = ft.FeaturePlan(
    catalog=CATALOG,
    reference_date=REFERENCE_DATE,
    internal=("impact_score", "risk_score"),
    derived=(
        ft.summed("total_loss", ft.FINANCIAL, *[f"num:{c}" for c in MONEY]),
        ft.logged("log_total_loss", ft.FINANCIAL, "total_loss"),
        *[ft.logged(f"log_{c}", ft.FINANCIAL, f"num:{c}") for c in (*MONEY, "balance_gbp")],
        ft.ratio("balance_to_loss", ft.FINANCIAL, "num:balance_gbp", "total_loss"),
        ft.summed(
            "flag_count", ft.IMPACT, "flag:repeated_flag", "flag:disputed_flag", "flag:open_flag"
        ),
        ft.logged("log_duration", ft.IMPACT, "num:duration_days"),
        ft.logged("log_delay", ft.IMPACT, "num:delay_days"),
        ft.plain_sum("level_sum", ft.IMPACT, "priority_level_code", "scale_level_code"),
        ft.has_other_than("has_segment", ft.VULNERABILITY, "segment", "None"),
        ft.summed(
            "vulnerability",
            ft.VULNERABILITY,
            "priority_level_code",
            "has_segment",
            "flag:repeated_flag",
            "flag:disputed_flag",
        ),
        ft.distance("priority_extremity", ft.VULNERABILITY, "priority_level_code", 2.5),
        ft.summed(
            "failure_intensity",
            ft.FAILURE,
            "num:n_failures",
            "num:n_organisations",
            "flag:repeated_flag",
        ),
        ft.ratio(
            "failures_per_organisation", ft.FAILURE, "num:n_failures", "num:n_organisations"
        ),
        ft.product("scale_x_logduration", ft.INTERACTIONS, "scale_level_code", "log_duration"),
        ft.ratio("delay_to_duration", ft.INTERACTIONS, "num:delay_days", "num:duration_days"),
        ft.product("vulnerability_x_level", ft.INTERACTIONS, "vulnerability", "level_sum"),
        ft.Derived(
            "impact_risk_mean",
            ft.PROXIES,
            lambda x: (x["impact_score"] + x["risk_score"]) / 2,
            needs=("impact_score", "risk_score"),
            internal=True,
        ),
        ft.Derived(
            "impact_risk_gap",
            ft.PROXIES,
            lambda x: x["impact_score"] - x["risk_score"],
            needs=("impact_score", "risk_score"),
            internal=True,
        ),
    ),
    indicators=(
        "impact_score",
        "risk_score",
        "loss_gbp",
        "balance_gbp",
        "priority_level",
        "scale_level",
        "segment",
        "route",
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order: cells as they would be read, dirt included."""
    by_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.expr("CAST(SUM(l_quantity) AS BIGINT) AS qty"),
            F.expr("COUNT(*) AS n_lines"),
            F.expr("MAX(INT(l_returnflag = 'R')) AS has_r"),
            F.expr("MAX(INT(l_returnflag = 'A')) AS has_a"),
            F.expr("MAX(INT(l_linestatus = 'O')) AS has_open"),
            F.expr(
                "SUM(BIGINT(ROUND(l_extendedprice * 100)) * BIGINT(ROUND(l_discount * 100)))"
                " AS disc_units"
            ),
            F.expr(
                "SUM(BIGINT(ROUND(l_extendedprice * 100)) * BIGINT(ROUND(l_tax * 100)))"
                " AS tax_units"
            ),
            F.expr("MAX(l_linenumber) AS top_line"),
            F.expr("DATEDIFF(MAX(l_shipdate), MIN(l_shipdate)) AS span"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    base = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(by_order, orders.o_orderkey == by_order.l_orderkey, "left")
        .selectExpr(
            "o_orderkey AS k",
            "o_totalprice AS price",
            "o_orderpriority AS prio",
            "o_orderstatus AS st",
            "c_mktsegment AS seg",
            "c_acctbal AS bal",
            "COALESCE(n_lines, 0L) AS n_lines",
            "COALESCE(has_r, 0) AS has_r",
            "COALESCE(has_a, 0) AS has_a",
            "COALESCE(has_open, 0) AS has_open",
            "qty",
            "disc_units",
            "tax_units",
            "top_line",
            "span",
            "BIGINT(FLOOR(o_totalprice / 5000)) + 1 AS impact0",
            "5 - BIGINT(SUBSTRING(o_orderpriority, 1, 1)) AS prio_idx",
            "BIGINT(DATEDIFF(DATE(o_orderdate), DATE'1899-12-30')) AS serial",
        )
        .withColumn(
            "latent",
            F.expr("10*impact0 + 80*prio_idx + 60*has_r + 20*n_lines + (k*7919) % 200"),
        )
        .withColumn(
            "severity",
            F.expr(
                "CASE "
                + " ".join(f"WHEN latent < {c} THEN {i}" for i, c in enumerate(LATENT_CUTS, 1))
                + " ELSE 6 END"
            ),
        )
    )
    return base.selectExpr(
        "k",
        "CONCAT('C-', k) AS case_ref",
        "BIGINT(CASE WHEN k % 61 = 0 THEN NULL WHEN k % 97 = 0 THEN -3"
        " WHEN k % 101 = 0 THEN 130 ELSE impact0 END) AS impact_score",
        "CASE WHEN k % 59 != 0 THEN BIGINT(FLOOR(price / 6000)) + 1 + (k * 31) % 7 END"
        " AS risk_score",
        "CASE WHEN k % 67 = 0 THEN NULL WHEN k % 103 = 0 THEN -250D"
        " WHEN k % 107 = 0 THEN 900000D ELSE price END AS loss_gbp",
        "disc_units / 10000D AS discount_gbp",
        "tax_units / 10000D AS tax_gbp",
        "bal AS balance_gbp",
        "qty AS duration_days",
        "BIGINT(span) AS delay_days",
        "n_lines AS n_failures",
        "BIGINT(top_line) AS n_organisations",
        "CASE WHEN k % 43 != 0 THEN prio END AS priority_level",
        "CASE WHEN k % 53 = 0 THEN NULL WHEN qty IS NULL THEN 'None' WHEN qty < 50 THEN 'Minor'"
        " WHEN qty < 120 THEN 'Moderate' ELSE 'Severe' END AS scale_level",
        "CASE WHEN k % 89 = 0 THEN 'X' WHEN k % 13 = 0 THEN CONCAT(' ', st) ELSE st END AS route",
        "CASE WHEN k % 31 = 0 THEN NULL WHEN k % 7 = 0 THEN 'None' ELSE seg END AS segment",
        "IF(has_r = 1, 'Yes', 'No') AS repeated_flag",
        "IF(has_a = 1, 'Yes', 'No') AS disputed_flag",
        "IF(has_open = 1, 'Yes', 'No') AS open_flag",
        "serial AS created_serial",
        "IF(severity >= 4, 'Yes', 'No') AS investigated_flag",
        "severity",
    )


CASES_CTE = """
li AS (
  SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS qty, COUNT(*) AS n_lines,
         MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_r,
         MAX(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS has_a,
         MAX(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS has_open,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT) * CAST(ROUND(l_discount * 100) AS BIGINT)) AS BIGINT) AS disc_units,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT) * CAST(ROUND(l_tax * 100) AS BIGINT)) AS BIGINT) AS tax_units,
         MAX(l_linenumber) AS top_line,
         date_diff('day', CAST(MIN(l_shipdate) AS DATE), CAST(MAX(l_shipdate) AS DATE)) AS span
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT o.o_orderkey AS k, o.o_totalprice AS price, CAST(o.o_orderdate AS DATE) AS d,
         o.o_orderpriority AS prio, o.o_orderstatus AS st, c.c_mktsegment AS seg, c.c_acctbal AS bal,
         li.qty, COALESCE(li.n_lines, 0) AS n_lines, COALESCE(li.has_r, 0) AS has_r,
         COALESCE(li.has_a, 0) AS has_a, COALESCE(li.has_open, 0) AS has_open,
         li.disc_units, li.tax_units, li.top_line, li.span,
         CAST(FLOOR(o.o_totalprice / 5000) AS BIGINT) + 1 AS impact0,
         5 - CAST(SUBSTR(o.o_orderpriority, 1, 1) AS BIGINT) AS prio_idx
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
l AS (
  SELECT *, 10*impact0 + 80*prio_idx + 60*has_r + 20*n_lines + (k*7919) % 200 AS latent FROM b),
s AS (
  SELECT *, CAST(CASE WHEN latent < 420 THEN 1 WHEN latent < 640 THEN 2 WHEN latent < 840 THEN 3
                 WHEN latent < 1060 THEN 4 WHEN latent < 1250 THEN 5 ELSE 6 END AS INTEGER) AS severity FROM l),
cases AS MATERIALIZED (
SELECT k, 'C-' || CAST(k AS VARCHAR) AS case_ref,
  CASE WHEN k % 61 = 0 THEN NULL WHEN k % 97 = 0 THEN -3 WHEN k % 101 = 0 THEN 130 ELSE impact0 END AS impact_score,
  CASE WHEN k % 59 = 0 THEN NULL ELSE CAST(FLOOR(price / 6000) AS BIGINT) + 1 + (k * 31) % 7 END AS risk_score,
  CASE WHEN k % 67 = 0 THEN NULL WHEN k % 103 = 0 THEN CAST(-250 AS DOUBLE)
       WHEN k % 107 = 0 THEN CAST(900000 AS DOUBLE) ELSE price END AS loss_gbp,
  CAST(disc_units AS DOUBLE) / 10000 AS discount_gbp, CAST(tax_units AS DOUBLE) / 10000 AS tax_gbp,
  bal AS balance_gbp, qty AS duration_days, span AS delay_days, n_lines AS n_failures,
  CAST(top_line AS BIGINT) AS n_organisations,
  CASE WHEN k % 43 = 0 THEN NULL ELSE prio END AS priority_level,
  CASE WHEN k % 53 = 0 THEN NULL WHEN qty IS NULL THEN 'None' WHEN qty < 50 THEN 'Minor'
       WHEN qty < 120 THEN 'Moderate' ELSE 'Severe' END AS scale_level,
  CASE WHEN k % 89 = 0 THEN 'X' WHEN k % 13 = 0 THEN ' ' || st ELSE st END AS route,
  CASE WHEN k % 31 = 0 THEN NULL WHEN k % 7 = 0 THEN 'None' ELSE seg END AS segment,
  CASE WHEN has_r = 1 THEN 'Yes' ELSE 'No' END AS repeated_flag,
  CASE WHEN has_a = 1 THEN 'Yes' ELSE 'No' END AS disputed_flag,
  CASE WHEN has_open = 1 THEN 'Yes' ELSE 'No' END AS open_flag,
  CAST(date_diff('day', DATE '1899-12-30', d) AS BIGINT) AS created_serial,
  CASE WHEN severity >= 4 THEN 'Yes' ELSE 'No' END AS investigated_flag,
  severity
FROM s)"""


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned case table, with the row key kept beside the contract columns."""
    raw = cases(spark, sf_dir)
    return clean(raw, CATALOG_WITH_KEY, is_training=True).frame


CATALOG_WITH_KEY = Catalog(
    [ColumnContract("k", IDENTIFIER, role="key"), *CATALOG.contracts]
)


def _range_sql(c: ColumnContract) -> str:
    if c.role == TARGET:
        return f"CAST(CASE WHEN {c.name} BETWEEN {c.low} AND {c.high} THEN {c.name} END AS INTEGER) AS {c.name}"
    return (
        f"CASE WHEN CAST({c.name} AS DOUBLE) BETWEEN {c.low} AND {c.high} "
        f"THEN CAST({c.name} AS DOUBLE) END AS {c.name}"
    )


def _category_sql(c: ColumnContract) -> str:
    listed = ", ".join(f"'{v}'" for v in c.allowed)
    return f"CASE WHEN TRIM({c.name}) IN ({listed}) THEN TRIM({c.name}) END AS {c.name}"


def _clean_sql() -> str:
    parts = ["k"]
    for c in CATALOG:
        if c.role == LEAK:
            continue
        if c.kind == DATE:
            parts.append(
                f"CAST(DATE '1899-12-30' + CAST({c.name} AS INTEGER) AS TIMESTAMP) AS {c.name}"
            )
        elif c.kind == NUMERIC:
            parts.append(_range_sql(c))
        elif c.restricted:
            parts.append(_category_sql(c))
        else:
            parts.append(c.name)
    return "clean AS MATERIALIZED (SELECT " + ",\n  ".join(parts) + "\n  FROM cases)"


CLEAN_CTE = CASES_CTE + ",\n" + _clean_sql()

_CODE = {
    c: "CASE "
    + c
    + " "
    + " ".join(f"WHEN '{v}' THEN CAST({i} AS DOUBLE)" for i, v in enumerate(CATALOG.levels(c)))
    + " END"
    for c in ("priority_level", "scale_level")
}
_FLAGS = ("repeated_flag", "disputed_flag", "open_flag")


def flag_sql(c: str) -> str:
    return f"CASE {c} WHEN 'Yes' THEN CAST(1 AS DOUBLE) WHEN 'No' THEN CAST(0 AS DOUBLE) END"


def sum_sql(*parts: str) -> str:
    total = " + ".join(f"COALESCE({p}, 0)" for p in parts)
    return f"CASE WHEN COALESCE({', '.join(parts)}) IS NOT NULL THEN CAST({total} AS DOUBLE) END"


def log_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN ln(1 + GREATEST({c}, 0)) END"


def ratio_sql(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {a} / {b} END"


NUMERIC_COLUMNS = CATALOG.columns(NUMERIC)
ORDINAL_COLUMNS = CATALOG.columns("ordinal")
NOMINAL_COLUMNS = CATALOG.columns("categorical")
BOOLEAN_COLUMNS = CATALOG.columns("boolean")

FEATURES_CTE = (
    CLEAN_CTE
    + """,
f1 AS (SELECT k, case_ref, severity, created_serial, route, segment, """
    + ", ".join(NUMERIC_COLUMNS)
    + ", priority_level, scale_level, "
    + ", ".join(f"{_CODE[c]} AS {c}_code" for c in _CODE)
    + ", "
    + ", ".join(f"{flag_sql(c)} AS {c}" for c in _FLAGS)
    + """, CAST(segment <> 'None' AS DOUBLE) AS has_segment FROM clean),
f2 AS (SELECT *, """
    + sum_sql(*MONEY)
    + " AS total_loss, "
    + sum_sql(*_FLAGS)
    + " AS flag_count, "
    + f"{log_sql('duration_days')} AS log_duration, {log_sql('delay_days')} AS log_delay, "
    + "priority_level_code + scale_level_code AS level_sum, "
    + sum_sql("priority_level_code", "has_segment", "repeated_flag", "disputed_flag")
    + " AS vulnerability, "
    + sum_sql("n_failures", "n_organisations", "repeated_flag")
    + """ AS failure_intensity FROM f1),
features AS MATERIALIZED (SELECT k, case_ref, severity, """
    + ", ".join(NUMERIC_COLUMNS)
    + ", priority_level_code, scale_level_code, repeated_flag, disputed_flag, open_flag,"
    + """ route, segment,
  CAST(date_diff('day', CAST(created_serial AS DATE), DATE '2002-01-01') AS DOUBLE) AS case_age_days,
  CAST(year(created_serial) AS DOUBLE) AS case_year, CAST(month(created_serial) AS DOUBLE) AS case_month,
  CAST(quarter(created_serial) AS DOUBLE) AS case_quarter,
  CAST(isodow(created_serial) - 1 AS DOUBLE) AS case_dayofweek,
  total_loss, """
    + f"{log_sql('total_loss')} AS log_total_loss, "
    + ", ".join(f"{log_sql(c)} AS log_{c}" for c in (*MONEY, "balance_gbp"))
    + f", {ratio_sql('balance_gbp', 'total_loss')} AS balance_to_loss, flag_count, "
    + "log_duration, log_delay, level_sum, has_segment, vulnerability, "
    + "ABS(priority_level_code - 2.5) AS priority_extremity, failure_intensity, "
    + f"{ratio_sql('n_failures', 'n_organisations')} AS failures_per_organisation, "
    + "scale_level_code * log_duration AS scale_x_logduration, "
    + f"{ratio_sql('delay_days', 'duration_days')} AS delay_to_duration, "
    + "vulnerability * level_sum AS vulnerability_x_level, "
    + "(impact_score + risk_score) / 2 AS impact_risk_mean, "
    + "impact_score - risk_score AS impact_risk_gap, "
    + ", ".join(f"CAST({c} IS NULL AS DOUBLE) AS {c}_missing" for c in PLAN.indicators)
    + " FROM f2)"
)


def feature_frame(spark: SparkSession, sf_dir: str, regime: str = "A"):
    """(feature frame with k, case_ref and severity in front, spec)."""
    return ft.engineer(
        cleaned(spark, sf_dir), PLAN.in_regime(regime), keep=["k", "case_ref", "severity"]
    )


def split_datasets(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Earlier records and later records; every row is in one of the two."""
    later = F.col("created_serial") >= HOLDBACK_FROM
    if dict(frame.dtypes)["created_serial"] == "timestamp":
        later = F.col("created_serial") >= F.lit("2000-01-01").cast("timestamp")
    return frame.where(~later), frame.where(later)


def fixed_score(impact: Column, prio: Column, flag: Column, failures: Column) -> Column:
    """The fixed linear score, from cleaned cells with constant fills."""
    return (
        F.lit(10.0) * F.coalesce(impact, F.lit(48.0))
        + F.lit(80.0) * F.coalesce(prio, F.lit(2.0))
        + F.lit(60.0) * flag
        + F.lit(20.0) * failures
        + F.lit(100.0)
    ) / F.lit(100.0)


def scored(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """``k, y, eta, proba, pred, p`` under constant coefficients, so nothing is fitted."""
    frame = cleaned(spark, sf_dir)
    eta = fixed_score(
        F.col("impact_score"),
        cells.level_code(F.col("priority_level"), PRIORITIES),
        cells.flag(F.col("repeated_flag")),
        F.col("n_failures"),
    )
    proba = ordered_probabilities(
        F.lit(STEEPNESS) * F.col("eta"), [STEEPNESS * t for t in THETA]
    )
    return (
        frame.select("k", F.col("severity").alias("y"), eta.alias("eta"), *extra)
        .withColumn("proba", proba)
        .withColumns(
            {
                "pred": argmax_class(F.col("proba"), range(1, 7)),
                "p": tail_probability(F.col("proba"), range(1, 7), 4),
            }
        )
    )


def _scored_sql() -> str:
    cum = ", ".join(f"1/(1+exp(-2*({t}::DOUBLE - eta))) AS c{i}" for i, t in enumerate(THETA, 1))
    floor = "CAST(1e-12 AS DOUBLE)"
    parts = ["c1", "c2 - c1", "c3 - c2", "c4 - c3", "c5 - c4", "1 - c5"]
    ps = ", ".join(f"GREATEST({p}, {floor}) AS p{i}" for i, p in enumerate(parts, 1))
    best = "GREATEST(p1,p2,p3,p4,p5,p6)"
    pred = (
        "CAST(CASE " + " ".join(f"WHEN p{i} = {best} THEN {i}" for i in range(1, 7)) + " END AS INTEGER)"
    )
    return f"""sc0 AS (SELECT k, severity AS y, route, segment, priority_level, scale_level, impact_score, loss_gbp, n_failures, duration_days,
  (10*COALESCE(impact_score, 48) + 80*COALESCE({_CODE['priority_level']}, 2)
   + 60*({flag_sql('repeated_flag')}) + 20*n_failures + 100) / CAST(100 AS DOUBLE) AS eta FROM clean),
sc1 AS (SELECT *, {cum} FROM sc0),
sc2 AS (SELECT *, {ps} FROM sc1),
scored AS MATERIALIZED (SELECT *, {pred} AS pred, GREATEST(0, LEAST(1, p4 + p5 + p6)) AS p FROM sc2)"""


SCORED_CTE = CLEAN_CTE + ",\n" + _scored_sql()


def with_cases(body: str) -> str:
    return f"WITH {CASES_CTE}\n{body}"


def with_clean(body: str) -> str:
    return f"WITH {CLEAN_CTE}\n{body}"


def with_features(body: str) -> str:
    return f"WITH {FEATURES_CTE}\n{body}"


def with_scored(body: str) -> str:
    return f"WITH {SCORED_CTE}\n{body}"
