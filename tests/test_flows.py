from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from casewright.functions.probability import array_sum
from casewright.models import families
from casewright.operators import explain as X
from casewright.operators import metrics as M
from casewright.operators import splits
from casewright.plans import flows
from casewright.sources.artefacts import Artefact, load_artefact, save_artefact, table_digest
from checks.evaluation import _validated
from checks.fixture import CATALOG

QUICK = {
    "logistic": {"maxIter": 30},
    "hist_gb": {"rounds": 2},
    "frank_hall": {"rounds": 1},
    "regression_threshold": {"rounds": 1, "inner_folds": 2},
}


@pytest.fixture(scope="module")
def bundle(spark, sf_dir):
    return _validated(spark, sf_dir)


@pytest.mark.parametrize("family", QUICK)
def test_saved_models_score_as_before(spark, bundle, tmp_path, family):
    key, label = CATALOG.identifier, CATALOG.target
    model = families.FAMILIES[family].fit(bundle.features, bundle.spec, label, key, params=QUICK[family])
    save_artefact(spark, Artefact(model, family, 0.2, 5.0, 4, "A"), str(tmp_path / "model"))
    loaded = load_artefact(spark, str(tmp_path / "model"))
    both = loaded.scorer.score(model.score(bundle.features, "before"), "after")
    gap = array_sum(F.zip_with("before", "after", lambda a, b: F.abs(a - b)))
    assert loaded.family == family and both.agg(F.max(gap)).first()[0] < 1e-12


def test_chain(spark, bundle, tmp_path):
    trained = flows.train(bundle, CATALOG, families=("ordered_logit",), k=2, repeats=1)
    judged = flows.evaluate(bundle, CATALOG, trained)
    assert judged.selection.model == "ordered_logit" and 0 < judged.selection.threshold < 1
    assert {r["rule"] for r in judged.rules.collect()} == {"argmax", "cost_aware"}
    flows.save_selection(spark, judged.selection, str(tmp_path / "selection"))
    assert flows.load_selection(spark, str(tmp_path / "selection")) == judged.selection
    first, second = (flows.predict_selected(bundle, CATALOG, judged.selection).table for _ in range(2))
    progressed = F.col("decision") == "Progressed for further investigation"
    assert first.where((F.col("predicted_severity") >= M.CUT) != progressed).count() == 0
    assert table_digest(first).first() == table_digest(second).first()


def test_attributions_add_up_for_any_model(bundle):
    key, label = CATALOG.identifier, CATALOG.target
    model = families.FAMILIES["ordered_logit"].fit(bundle.features, bundle.spec, label, key)
    rows = splits.seeded_sample(bundle.features, key, 4)
    table = X.model_attributions(rows, key, model, bundle.spec.columns, splits.seeded_sample(bundle.features, key, 3, 7))
    gap = F.abs(F.col("base") + array_sum(F.col("values")) - F.col("prediction"))
    sizes = table.agg(F.max(gap), F.count("*"), F.min(F.size("values")), F.countDistinct(F.round("base", 9))).first()
    assert sizes[0] < 1e-9 and list(sizes)[1:] == [4, len(bundle.spec.columns), 1]


def test_explanations_of_a_selection(bundle):
    chosen = flows.Selection("ordered_logit", "ordered_logit", None, 0.2, 5.0, bundle.spec.regime, 42, 2, 1)
    told = flows.explain(bundle, CATALOG, chosen, explained=3, background=2, repeats=1)
    assert told.importance.count() == len(bundle.spec.columns)
    assert told.attributions.count() == 3 and 0 < told.mean_attributions.count() <= 30
    assert told.cases.count() == 3 and told.agreement > 0.5 and "INVESTIGATE" in told.rules
    assert {r["side"] for r in told.coefficients.collect()} == {"top", "bottom"}
