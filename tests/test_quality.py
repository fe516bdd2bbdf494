from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casewright.catalogs import complaints
from casewright.functions import cells
from casewright.operators import quality as Q

CATALOG = complaints.CATALOG


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_range_null(spark):
    df = table(
        spark,
        [("A", 50, 100.0), ("B", -3, 50.0), ("C", 108, 130000.0), ("D", None, 0.0)],
        "CaseReference string, EstimatedImpactScore int, LostIncomeGBP double",
    )
    out = {r[0]: r[1:] for r in Q.quarantine_ranges(df, CATALOG).collect()}
    assert out == {"A": (50.0, 100.0), "B": (None, 50.0), "C": (None, None), "D": (None, 0.0)}
    log = Q.violation_log(df, CATALOG).collect()
    assert len(log) == 3 and {r["id"] for r in log} == {"B", "C"}
    assert {r["reason"] for r in log if r["column"] == "LostIncomeGBP"} == {"outside [0, 100000]"}


def test_range_clip(spark):
    df = table(spark, [("A", 115)], "CaseReference string, EstimatedRiskScore int")
    assert Q.quarantine_ranges(df, CATALOG, "clip").first()["EstimatedRiskScore"] == 100.0
    assert Q.violation_log(df, CATALOG).count() == 1
    with pytest.raises(ValueError):
        Q.quarantine_ranges(df, CATALOG, "drop")


def test_categories_are_stripped_then_checked(spark):
    df = table(
        spark,
        [("A", " Health ", "Yes"), ("B", "Parliamentary", "Maybe"), ("C", "Mars", "No")],
        "CaseReference string, Jurisdiction string, AnxietyReported string",
    )
    out = {r[0]: r[1:] for r in Q.quarantine_categories(df, CATALOG).collect()}
    assert out == {"A": ("Health", "Yes"), "B": ("Parliamentary", None), "C": (None, "No")}
    assert Q.violation_log(df, CATALOG).count() == 2


def test_log_without_id_column(spark):
    df = table(spark, [(400,), (5,)], "EstimatedRiskScore int")
    assert Q.violation_log(df, CATALOG).select("value").collect() == [("400",)]


def test_serial_dates(spark):
    df = table(spark, [(45228.0,), (44946.0,), (44946.75,), (float("nan"),)], "d double")
    out = [r[0] for r in df.select(cells.serial_to_timestamp(F.col("d"))).collect()]
    assert out == [
        dt.datetime(2023, 10, 29),
        dt.datetime(2023, 1, 20),
        dt.datetime(2023, 1, 20, 18),
        None,
    ]


def test_audit_names_missing_and_unexpected():
    columns = [c for c in CATALOG.names if c != "AgeBand"] + ["Rogue"]
    audit = Q.audit_columns(columns, CATALOG, expect_target=True)
    assert (audit.expected_missing, audit.unexpected) == (["AgeBand"], ["Rogue"])
    assert audit.leak == ["OmbudsmanInvestigationRequired"] and not audit.ok
    holdback = [c for c in CATALOG.names if c != "SeverityScore"]
    assert Q.audit_columns(holdback, CATALOG, expect_target=False).ok
    assert not Q.audit_columns(holdback, CATALOG, expect_target=True).ok


def test_clean_raises_without_required_columns(spark):
    with pytest.raises(ValueError):
        Q.clean(table(spark, [("A",)], "CaseReference string"), CATALOG, is_training=True)


def test_missing_words(spark):
    df = table(spark, [("None",), ("NA",), ("#N/A",), ("",), ("x",)], "c string")
    out = [r[0] for r in df.select(cells.null_if_token(F.col("c"))).collect()]
    assert out == ["None", None, None, None, "x"]


def test_open_bounds_and_nan(spark):
    from casewright.contracts import NUMERIC, ColumnContract

    df = table(spark, [(1.0,), (float("nan"),), (None,)], "v double")
    value = cells.number(F.col("v"))
    open_low = ColumnContract("v", NUMERIC, high=5)
    assert [r[0] for r in df.select(cells.within(value, open_low)).collect()] == [True, None, None]


def test_row_functions(spark):
    df = table(
        spark,
        [(1.0, None, -5.0, 0.0), (None, None, None, None), (2.0, 3.0, 0.0, 4.0)],
        "a double, b double, c double, d double",
    )
    a, b, c, d = (F.col(x) for x in "abcd")
    out = df.select(
        cells.null_skipping_sum(a, b), cells.log1p_floor(c), cells.safe_ratio(a, d)
    ).collect()
    assert [tuple(r) for r in out] == [(1.0, 0.0, None), (None, None, None), (5.0, 0.0, 0.5)]


def test_allowed_cells_are_not_stripped_first(spark):
    from casewright.contracts import nominal

    contract = nominal("c", "a", "b c", " odd")
    given = ["a", " a\t", "b c", " b c", " odd", "odd", "x", "", None, "A"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, c string")
    text = cells.stripped(F.col("c"))
    plain = F.when(text.isin(*contract.allowed), text)
    got = rows.select("i", Q.quarantined_category(contract).alias("got"), plain.alias("want")).orderBy("i").collect()
    assert [r.got for r in got] == [r.want for r in got] == ["a", "a", "b c", "b c", None, None, None, None, None, None]
    assert str(Q.quarantined_category(contract)).index("IN") < str(Q.quarantined_category(contract)).index("btrim")
