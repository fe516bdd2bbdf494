"""Contract and data-quality operators on the case table."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewright import contracts as C
from casewright.functions import cells
from casewright.operators import quality as Q
from casewright.session import small_table
from checks.fixture import (
    BOOLEAN_COLUMNS,
    CATALOG,
    CATALOG_WITH_KEY,
    MONEY,
    NUMERIC_COLUMNS,
    cases,
    cleaned,
    split_datasets,
    with_cases,
    with_clean,
)
from checks.metrics import r, rounded
from checks.registry import query

NUMBERS = [*NUMERIC_COLUMNS, "severity"]
RESTRICTED = [c.name for c in CATALOG if c.restricted]


def _text(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _count_union(names, relation="cases") -> str:
    """(column, n_values) rows of the observed cells."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, COUNT({c}) AS n_values FROM {relation}" for c in names
    )


def _catalog_values() -> str:
    rows = []
    for c in CATALOG:
        allowed = "|".join(c.allowed) if c.allowed else None
        rows.append(
            f"({_text(c.name)}, {_text(c.kind)}, {_text(c.role)}, {_text(allowed)}, "
            f"{'NULL' if c.low is None else c.low}::DOUBLE, {'NULL' if c.high is None else c.high}::DOUBLE, "
            f"{str(c.integer).lower()}, {str(c.documented).lower()})"
        )
    return "(VALUES " + ", ".join(rows) + ') v("column", kind, role, allowed, min_value, max_value, integer, documented)'


@query(
    "d1_contract_catalogue",
    with_cases(
        f"SELECT v.*, o.n_values FROM {_catalog_values()} LEFT JOIN ({_count_union(CATALOG.names)}) o ON o.col = v.\"column\""
    ),
)
def d1(spark, sf_dir):
    observed = C.observed_values(cases(spark, sf_dir), CATALOG.names)
    table = CATALOG.to_df(spark).withColumn("allowed", F.array_join("allowed", "|"))
    return table.join(F.broadcast(observed), "column", "left")


_SELECTIONS = {
    "features": CATALOG.columns(),
    **{f"features_{k}": CATALOG.columns(k) for k in ("numeric", "categorical", "ordinal", "boolean", "date")},
    "undocumented": CATALOG.undocumented(),
    "leak": CATALOG.leaks,
    "levels_priority_level": list(CATALOG.levels("priority_level")),
}


@query(
    "d2_column_selection",
    with_cases(
        "SELECT s.selection, s.members, SUM(o.n_values)::BIGINT AS n_values FROM (VALUES "
        + ", ".join(
            f"('{n}', '{','.join(m)}', [{', '.join(_text(x) for x in m)}])"
            for n, m in _SELECTIONS.items()
            if not n.startswith("levels")
        )
        + f") s(selection, members, names) JOIN ({_count_union(CATALOG.names)}) o ON list_contains(s.names, o.col) GROUP BY 1, 2"
    ),
)
def d2(spark, sf_dir):
    observed = C.observed_values(cases(spark, sf_dir), CATALOG.names)
    rows = [(n, ",".join(m), m) for n, m in _SELECTIONS.items() if not n.startswith("levels")]
    chosen = small_table(spark, rows, "selection string, members string, names array<string>")
    members = chosen.select("selection", "members", F.explode("names").alias("column"))
    return (
        members.join(observed, "column")
        .groupBy("selection", "members")
        .agg(F.sum("n_values").alias("n_values"))
    )


@query(
    "d3_range_predicate",
    with_cases(
        "SELECT k, CAST(impact_score AS DOUBLE) BETWEEN 1 AND 100 AS bounded, impact_score >= 1 AS from_low, "
        "impact_score <= 100 AS to_high, CASE WHEN impact_score IS NOT NULL THEN true END AS open FROM cases"
    ),
)
def d3(spark, sf_dir):
    value = cells.number(F.col("impact_score"))
    c = C.ColumnContract
    return cases(spark, sf_dir).select(
        "k",
        cells.within(value, c("x", C.NUMERIC, low=1, high=100)).alias("bounded"),
        cells.within(value, c("x", C.NUMERIC, low=1)).alias("from_low"),
        cells.within(value, c("x", C.NUMERIC, high=100)).alias("to_high"),
        cells.within(value, c("x", C.NUMERIC)).alias("open"),
    )


@query(
    "d4_schema_audit",
    with_cases(
        f"""SELECT * FROM (
  SELECT 'scale_level' AS "column", 'expected_missing' AS finding, 0::BIGINT AS n_values
  UNION ALL SELECT 'rogue', 'unexpected', COUNT(*) FROM cases
  UNION ALL SELECT 'k', 'unexpected', COUNT(k) FROM cases
  UNION ALL SELECT 'investigated_flag', 'leak', COUNT(investigated_flag) FROM cases
  UNION ALL SELECT 'severity', 'target', COUNT(severity) FROM cases
  UNION ALL SELECT 'open_flag', 'undocumented', COUNT(open_flag) FROM cases) t"""
    ),
)
def d4(spark, sf_dir):
    df = cases(spark, sf_dir).drop("scale_level").withColumn("rogue", F.lit("x"))
    return Q.audit_table(df, CATALOG, expect_target=True)


@query(
    "d5_not_in_dictionary",
    with_cases(f'SELECT col AS "column", n_values FROM ({_count_union(["k", "open_flag"])}) t'),
)
def d5(spark, sf_dir):
    dictionary = CATALOG.to_df(spark).where("documented").select(F.col("column").alias("field"))
    return Q.missing_from_dictionary(cases(spark, sf_dir), dictionary, "field")


@query(
    "d6_numeric_coercion",
    with_cases(
        "SELECT k, TRY_CAST(route || CAST(n_failures AS VARCHAR) AS DOUBLE) AS mixed, "
        "TRY_CAST(CASE WHEN k % 2 = 0 THEN CAST(impact_score AS VARCHAR) ELSE segment END AS DOUBLE) AS half FROM cases"
    ),
)
def d6(spark, sf_dir):
    df = cases(spark, sf_dir)
    half = F.expr("CASE WHEN k % 2 = 0 THEN STRING(impact_score) ELSE segment END")
    return df.select(
        "k",
        cells.number(F.concat("route", F.col("n_failures").cast("string"))).alias("mixed"),
        cells.number(half).alias("half"),
    )


def _ranged(strategy: str) -> str:
    parts = []
    for c in NUMBERS:
        lo, hi = CATALOG[c].low, CATALOG[c].high
        v = f"CAST({c} AS DOUBLE)"
        if strategy == "null":
            parts.append(f"CASE WHEN {v} BETWEEN {lo} AND {hi} THEN {v} END AS {c}")
        else:
            parts.append(
                f"CASE WHEN {c} IS NOT NULL THEN GREATEST({lo}::DOUBLE, LEAST({hi}::DOUBLE, {v})) END AS {c}"
            )
    return with_cases("SELECT k, " + ", ".join(parts) + " FROM cases")


@query("d7_range_null", _ranged("null"))
def d7(spark, sf_dir):
    return Q.quarantine_ranges(cases(spark, sf_dir), CATALOG).select("k", *NUMBERS)


@query("d8_range_clip", _ranged("clip"))
def d8(spark, sf_dir):
    return Q.quarantine_ranges(cases(spark, sf_dir), CATALOG, "clip").select("k", *NUMBERS)


@query(
    "d9_strip_category",
    with_cases(
        r"SELECT k, TRIM(route) AS route, regexp_replace(chr(9) || ' ' || segment || chr(10), '^\s+|\s+$', '', 'g') AS segment FROM cases"
    ),
)
def d9(spark, sf_dir):
    padded = F.concat(F.lit("\t "), F.col("segment"), F.lit("\n"))
    return cases(spark, sf_dir).select(
        "k",
        cells.stripped(F.col("route")).alias("route"),
        cells.stripped(padded).alias("segment"),
    )


def _categories() -> str:
    parts = []
    for c in RESTRICTED:
        listed = ", ".join(_text(v) for v in CATALOG[c].allowed)
        parts.append(f"CASE WHEN TRIM({c}) IN ({listed}) THEN TRIM({c}) END AS {c}")
    return with_cases("SELECT k, " + ", ".join(parts) + " FROM cases")


@query("d10_category_quarantine", _categories())
def d10(spark, sf_dir):
    return Q.quarantine_categories(cases(spark, sf_dir), CATALOG).select("k", *RESTRICTED)


def _log_sql() -> str:
    """Violations only; every number in the log is an integer or prints as x.y in both engines."""
    parts = []
    for c in NUMBERS:
        contract = CATALOG[c]
        parts.append(
            f"SELECT case_ref AS id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, "
            f"'{C.bounds_text(contract)}' AS reason FROM cases "
            f"WHERE CAST({c} AS DOUBLE) < {contract.low} OR CAST({c} AS DOUBLE) > {contract.high}"
        )
    for c in RESTRICTED:
        listed = ", ".join(_text(v) for v in CATALOG[c].allowed)
        parts.append(
            f"SELECT case_ref, '{c}', {c}, '{Q.NOT_ALLOWED}' FROM cases WHERE TRIM({c}) NOT IN ({listed})"
        )
    return " UNION ALL ".join(parts)


@query("d11_violation_log", with_cases(_log_sql()))
def d11(spark, sf_dir):
    return Q.violation_log(cases(spark, sf_dir), CATALOG)


@query(
    "d12_violation_summary",
    with_cases(
        f'SELECT "column", COUNT(*) AS n, COUNT(*) FILTER (WHERE TRY_CAST(value AS DOUBLE) < 0) AS n_negative'
        f' FROM ({_log_sql()}) v GROUP BY "column"'
    ),
)
def d12(spark, sf_dir):
    return Q.violation_summary(Q.violation_log(cases(spark, sf_dir), CATALOG))


CONTRACT_COLUMNS = [c for c in CATALOG.names]


def missingness_sql(relation: str, columns, types: dict[str, str]) -> str:
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS col, COUNT(*) - COUNT({c}) AS missing, COUNT(*) AS n, '{types[c]}' AS dtype FROM {relation}"
        for c in columns
    )
    return (
        f'SELECT col AS "column", missing, round_even(CAST(missing AS DOUBLE) / n * 100, 2) AS missing_pct, dtype'
        f" FROM ({union}) t WHERE missing > 0"
    )


_RAW_TYPES = {
    **{c: "string" for c in CATALOG.names},
    **{c: "bigint" for c in ("impact_score", "risk_score", "duration_days", "delay_days",
                             "n_failures", "n_organisations", "created_serial")},
    **{c: "double" for c in (*MONEY, "balance_gbp")},
    "severity": "int",
}


@query("d13_missingness", with_cases(missingness_sql("cases", CONTRACT_COLUMNS, _RAW_TYPES)))
def d13(spark, sf_dir):
    return Q.missingness(cases(spark, sf_dir), CONTRACT_COLUMNS)


@query(
    "d14_null_rate",
    with_cases(f"SELECT {r('AVG(CAST(segment IS NULL AS DOUBLE))', 'null_rate')} FROM cases"),
)
def d14(spark, sf_dir):
    return rounded(Q.null_rate(cases(spark, sf_dir), "segment"))


_PATTERN = ("impact_score", "risk_score", "loss_gbp", "duration_days", "priority_level",
            "scale_level", "segment")


@query(
    "d15_null_patterns",
    with_cases(
        "SELECT pattern, COUNT(*) AS n, CAST(LENGTH(REPLACE(pattern, '0', '')) AS INTEGER) AS n_missing FROM (SELECT "
        + " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in _PATTERN)
        + " AS pattern FROM cases) t GROUP BY pattern"
    ),
)
def d15(spark, sf_dir):
    return Q.null_patterns(cases(spark, sf_dir), _PATTERN)


@query(
    "d16_drop_leak_and_unexpected",
    with_clean(
        "SELECT * REPLACE (CAST(created_serial AS DATE) AS created_serial) FROM (SELECT * EXCLUDE (k) FROM clean) t"
    ),
)
def d16(spark, sf_dir):
    df = cases(spark, sf_dir).withColumn("rogue", F.lit("x"))
    frame = Q.clean(df, CATALOG, is_training=True).frame
    return frame.withColumn("created_serial", F.col("created_serial").cast("date"))


@query(
    "d17_target_cast",
    with_cases(
        "SELECT k, TRY_CAST(CASE WHEN k % 29 = 0 THEN 'unknown' ELSE CAST(severity AS VARCHAR) END AS INTEGER) AS severity FROM cases"
    ),
)
def d17(spark, sf_dir):
    df = cases(spark, sf_dir).withColumn(
        "severity", F.expr("IF(k % 29 = 0, 'unknown', STRING(severity))")
    )
    return Q.clean(df, CATALOG_WITH_KEY, is_training=True).frame.select("k", "severity")


@query(
    "d18_clean",
    with_clean("SELECT * REPLACE (CAST(created_serial AS DATE) AS created_serial) FROM clean"),
)
def d18(spark, sf_dir):
    frame = cleaned(spark, sf_dir)
    return frame.withColumn("created_serial", F.col("created_serial").cast("date"))


_GAPS = [c for c in CATALOG.names if c != "investigated_flag"]


@query(
    "d19_clean_report",
    with_clean(
        f"""SELECT (SELECT COUNT(*) FROM cases) AS n_rows,
  COUNT(*) FILTER (WHERE reason <> '{Q.NOT_ALLOWED}') AS range_violations,
  COUNT(*) FILTER (WHERE reason = '{Q.NOT_ALLOWED}') AS category_violations,
  (SELECT CAST({' + '.join(f'CAST(COUNT({c}) < COUNT(*) AS INTEGER)' for c in _GAPS)} AS INTEGER) FROM clean) AS columns_with_gaps,
  'investigated_flag,k' AS dropped, 'investigated_flag' AS leak_present, 'open_flag' AS undocumented_present,
  'none' AS expected_missing, 'k' AS unexpected, true AS target_present FROM ({_log_sql()}) v"""
    ),
)
def d19(spark, sf_dir):
    return Q.clean(cases(spark, sf_dir), CATALOG, is_training=True).report()
