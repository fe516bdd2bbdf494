from __future__ import annotations

import pytest

from casewright import contracts as C
from casewright.catalogs import complaints
from casewright.operators import features as ft

CATALOG = complaints.CATALOG


def test_catalogue_counts():
    assert len(CATALOG) == 46
    kinds = {k: len(CATALOG.columns(k)) for k in (C.NUMERIC, C.NOMINAL, C.ORDINAL, C.BOOLEAN, C.DATE)}
    assert kinds == {
        "numeric": 15,
        "categorical": 8,
        "ordinal": 6,
        "boolean": 13,
        "date": 1,
    }
    assert len(CATALOG.columns()) == 43
    assert CATALOG.undocumented() == ["AdditionalTreatmentRequired", "ImpactOnRelationships"]


def test_roles_and_levels():
    assert CATALOG.target == "SeverityScore"
    assert CATALOG.leaks == ["OmbudsmanInvestigationRequired"]
    assert CATALOG.levels("VulnerabilityLevel") == ("None", "Low", "Moderate", "High")
    with pytest.raises(ValueError):
        CATALOG.levels("Jurisdiction")


def test_duplicate_contract_is_refused():
    with pytest.raises(ValueError):
        C.Catalog([C.yes_no("a"), C.yes_no("a")])


def test_catalogue_as_table(spark):
    rows = {r["column"]: r for r in CATALOG.to_df(spark).collect()}
    assert rows["EstimatedRiskScore"]["max_value"] == 100.0
    assert rows["CaseReference"]["allowed"] is None


def test_feature_counts_of_both_regimes():
    columns = [c for c in CATALOG.names if c not in CATALOG.leaks]
    full = ft.spec_of(columns, complaints.PLAN)
    reduced = ft.spec_of(columns, complaints.PLAN.in_regime("B"))
    assert (len(full.columns), len(reduced.columns)) == (82, 76)
    assert set(reduced.columns) < set(full.columns)
    assert set(full.groups.values()) == set(ft.GROUPS)
    assert not full.without_groups(ft.PROXIES).in_group(ft.PROXIES)
    assert complaints.LEAK not in full.columns
    assert set(complaints.RISING) <= set(full.columns)
