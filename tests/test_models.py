from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.functions.probability import array_sum
from casewright.models import families
from casewright.models import ordered_logit as O
from casewright.models import softmax as S
from casewright.models import validation as V
from casewright.operators import explain as X
from casewright.operators import prep as P
from casewright.operators import splits
from casewright.operators.features import FeatureSpec

NAMES = tuple(f"x{j}" for j in range(5))
SPEC = FeatureSpec(NAMES, ("c",), {**dict.fromkeys(NAMES, "raw_numeric"), "c": "nominal"})
CLASSES = (1, 2, 3, 4, 5, 6)


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    latent = x @ np.array([1.5, -0.8, 0.4, 0.0, 0.9]) + rng.logistic(size=400)
    y = np.searchsorted(np.quantile(latent, [0.2, 0.4, 0.6, 0.8, 0.9]), latent) + 1
    rows = [
        (i, int(y[i]), *[None if (i + j) % 37 == 0 else float(v) for j, v in enumerate(x[i])],
         None if i % 41 == 0 else ("rare" if i < 3 else "ab"[i % 2]))
        for i in range(400)
    ]
    schema = "k int, y int, " + ", ".join(f"{n} double" for n in NAMES) + ", c string"
    return spark.createDataFrame(rows, schema).cache()


def test_gradient_and_hessian_against_differences():
    rng = np.random.default_rng(1)
    x, code = rng.normal(size=(200, 4)), rng.integers(0, 6, 200)
    w = rng.uniform(0.5, 2, 200)
    at = np.concatenate([rng.normal(size=4) * 0.3, [-2.0, -1, 0, 1, 2]])
    _, g, h = O.block_sums(at, x, code, w, 5)
    step = 1e-5
    for j, e in enumerate(np.eye(9)):
        up, down = (O.block_sums(at + s * step * e, x, code, w, 5) for s in (1, -1))
        assert g[j] == pytest.approx((up[0] - down[0]) / (2 * step), abs=1e-5)
        assert np.allclose(h[j], (up[1] - down[1]) / (2 * step), atol=1e-5)


def test_ordered_logit_fit(toy):
    fitted = O.fit_ordered_logit(toy, SPEC, "y")
    model = fitted.model
    assert model.converged and list(model.cuts) == sorted(model.cuts)
    assert model.beta[0] > 0 > model.beta[1]
    mass = fitted.score(toy).agg(F.max(F.abs(array_sum(F.col("proba")) - 1))).first()[0]
    assert mass < 1e-9
    again = O.fit_ordered_logit(toy, SPEC, "y").model
    assert np.allclose(again.beta + again.cuts, model.beta + model.cuts, atol=1e-10)
    other = O.fit_ordered_logit(toy.repartition(3), SPEC, "y").model
    assert np.allclose(other.beta + other.cuts, model.beta + model.cuts, atol=1e-7)


def test_shared_fold_fits_equal_separate_fits(toy):
    folded, columns = V.with_folds(toy, "k", "y", k=2, repeats=2)
    oof, models = O.cross_fit(folded, SPEC, "y", "k", columns, 2, classes=CLASSES)
    alone = O.fit_ordered_logit(folded.where("fold_1 != 0"), SPEC, "y", classes=CLASSES)
    shared = models[2]
    assert np.allclose(alone.model.beta + alone.model.cuts, shared.beta + shared.cuts, atol=1e-6)
    assert oof.count() == 800 and oof.select("id").distinct().count() == 400
    held = alone.score(folded.where("fold_1 = 0")).select(F.col("k").alias("id"), F.col("proba").alias("a"))
    both = oof.where("repeat = 1 and fold = 0").join(held, "id")
    gap = both.agg(F.max(F.abs(F.get("a", F.lit(2)) - F.get("proba", F.lit(2))))).first()[0]
    assert gap < 1e-6


def test_softmax_gradient_against_differences():
    rng = np.random.default_rng(6)
    x, code, w = rng.normal(size=(150, 3)), rng.integers(0, 4, 150), rng.uniform(0.5, 2, 150)
    at = rng.normal(size=(4, 4))
    value, g, h = S.block_sums(at, x, code, w)
    p = S.proportions(x @ at[:, :-1].T + at[:, -1])
    assert value == pytest.approx(-(w * np.log(p[np.arange(150), code])).sum())
    for j in np.ndindex(4, 4):
        e = np.zeros((4, 4))
        e[j] = 1e-5
        up, down = (S.block_sums(at + sign * e, x, code, w) for sign in (1, -1))
        assert g[j] == pytest.approx((up[0] - down[0]) / 2e-5, abs=1e-5)
        assert np.allclose(h[j[0] * 4 + j[1]], ((up[1] - down[1]) / 2e-5).ravel(), atol=1e-4)


def test_shared_logistic_equals_separate_fits_and_spark(toy):
    from pyspark.ml.classification import LogisticRegression

    folded, columns = V.with_folds(toy, "k", "y", k=3, repeats=2)
    oof, models = S.cross_softmax(folded, SPEC, "y", "k", columns, 3, CLASSES)
    alone = S.fit_softmax(folded.where("fold_1 != 2"), SPEC, "y", CLASSES)
    shared = models[5]
    assert shared.gradient_norm <= 1e-9 and shared.n_iter < 30
    assert np.allclose(alone.model.weights, shared.weights, atol=1e-6)
    assert np.allclose(alone.model.intercepts, shared.intercepts, atol=1e-6)
    assert oof.count() == 800 and oof.select("id").distinct().count() == 400
    held = alone.score(folded.where("fold_1 = 2")).select(F.col("k").alias("id"), F.col("proba").alias("p"))
    both = oof.where("repeat = 1 and fold = 2").join(held, "id")
    gap = both.agg(F.max(array_sum(F.zip_with("p", "proba", lambda a, b: F.abs(a - b))))).first()[0]
    assert gap < 1e-6
    table, prep = families.training_table(toy, SPEC, "y", CLASSES, scaled=True)
    mass = table.agg(F.sum("weight")).first()[0]
    other = LogisticRegression(
        family="multinomial", weightCol="weight", standardization=False, regParam=2.0 / mass, maxIter=5000, tol=1e-12
    ).fit(table)
    own = S.fit_softmax(toy, SPEC, "y", CLASSES)
    assert own.model.names == tuple(prep.names)
    assert np.allclose(own.model.weights, other.coefficientMatrix.toArray(), atol=2e-4)


def test_logistic_scores_unseen_and_missing_levels(spark, toy):
    scorer = S.fit_softmax(toy, SPEC, "y", CLASSES)
    rows = spark.createDataFrame([(0.0,) * 5 + (c,) for c in ("new", None, "a", "(unseen)")], ", ".join(f"{n} double" for n in NAMES) + ", c string")
    got = [r.proba for r in scorer.score(rows).collect()]
    assert got[0] == got[3] != got[2] and got[1] in (got[2], got[1]) and all(abs(sum(p) - 1) < 1e-9 for p in got)
    w = dict(zip(scorer.model.names, np.array(scorer.model.weights).T))
    level = scorer.prep.mode["c"]
    x = np.array([[(0 - scorer.prep.mean[n]) / scorer.prep.scale[n] for n in NAMES]])
    plain = x @ np.array([w[n] for n in NAMES]) + np.array(scorer.model.intercepts)
    shifted = plain + sum((v * ((name == f"c_{level}") - scorer.prep.mean.get(name, 0)) / scorer.prep.scale.get(name, 1) if name.startswith("c_") else 0) for name, v in w.items())
    assert np.allclose(S.proportions(plain)[0], got[0]) and np.allclose(S.proportions(shifted)[0], got[1])


def test_importance_by_terms_equals_swapped_columns(toy):
    class Opaque:
        def __init__(self, scorer):
            self.score = scorer.score

    model = O.fit_ordered_logit(toy, SPEC, "y", classes=CLASSES)
    both = [
        {r.feature: r for r in X.permutation_importance(toy, m, [*NAMES, "c"], "y", "k", repeats=3).collect()}
        for m in (model, Opaque(model))
    ]
    for name, row in both[0].items():
        assert row.importance_mean == pytest.approx(both[1][name].importance_mean, abs=1e-9)
        assert row.importance_std == pytest.approx(both[1][name].importance_std, abs=1e-9)
    assert both[0]["x0"].importance_mean > 0.05


def test_robustness_invariants_fail_where_nothing_is_done(spark):
    from checks.evaluation import _spoilt

    def judged(kappas, right):
        rows = [(d, 10, k, 0.5, 0.5, 0.5) for d, k in zip((0.0, 0.1, 0.5), kappas)]
        table = spark.createDataFrame(rows, "noise_scale double, n bigint, qwk double, macro_f1 double, severe_recall double, severe_pr_auc double")
        last = _spoilt(table, "noise_scale", dict.fromkeys((0.0, 0.1, 0.5), right)).orderBy("noise_scale").collect()[-1]
        return last.as_dosed, last.no_gain, last.loses_at_last

    assert judged((0.9, 0.89, 0.8), True) == (True, True, True)
    assert judged((0.9, 0.9, 0.9), False) == (False, True, False)
    assert judged((0.9, 0.9, 0.95), True) == (True, False, False)


def test_check_invariants_fail_on_broken_scores(spark):
    from checks.modelling import quality

    def judged(*rows):
        return quality(spark.createDataFrame(rows, "severity int, proba array<double>")).first().asDict()

    sure = [(c, [0.95 if i + 1 == c else 0.01 for i in range(6)]) for c in CLASSES]
    assert judged(*sure) == {"n": 6, "bounded": True, "mass_is_one": True, "above_chance": True}
    turned = [(7 - c, p) for c, p in sure]
    assert not judged(*turned)["above_chance"]
    assert not judged(*sure, (1, [0.5] * 6))["mass_is_one"]
    assert not judged(*sure, (1, [1.5, -0.5, 0.0, 0.0, 0.0, 0.0]))["bounded"]
    assert not judged(*sure, (1, [float("nan")] * 6))["mass_is_one"]


def test_feature_empty_in_one_training_fold(toy):
    """The fold that only holds a column's values leaves it out of its own model."""
    rows = toy.withColumn("f", F.pmod("k", F.lit(4))).withColumn("x4", F.when(F.col("f") == 0, F.col("x4")))
    out, models = O.cross_fit(rows, SPEC, "y", "k", ["f"], 4, classes=CLASSES)
    assert out.count() == 400
    assert ["x4" in m.names for m in models] == [False, True, True, True]


def test_code_books_are_bounded(toy):
    assert O.code_books(toy, ["c"]) == [["a", "b", "rare"]]
    with pytest.raises(ValueError, match="levels"):
        O.code_books(toy, ["c"], most=2)


def test_preprocessor_matches_numpy(toy):
    prep = P.fit_preprocessor(toy, SPEC)
    assert prep.rare["c"] == ("rare",) and prep.names[-1] == "c_infrequent"
    pdf = toy.toPandas()
    x = pdf["x1"].fillna(pdf["x1"].median())
    got = prep.select(toy, ["k"]).orderBy("k").toPandas()
    assert np.allclose(got["x1"], (x - x.mean()) / x.std(ddof=0))
    books = [sorted(pdf["c"].dropna().unique())]
    codes = pdf["c"].map({v: i for i, v in enumerate(books[0])}).fillna(-1).to_numpy()[:, None]
    block = prep.matrix(pdf[list(NAMES)].to_numpy(), codes, books)
    assert np.allclose(block, got[prep.names].to_numpy())


def test_holdback_rows_do_not_move_fitted_statistics(toy):
    train = toy.where("k < 300")
    alone = P.fit_preprocessor(train, SPEC)
    masked = P.fit_preprocessors(toy, SPEC, {"m": F.col("k") < 300})["m"]
    assert alone.fill == masked.fill and alone.mode == masked.mode
    assert alone.mean == pytest.approx(masked.mean) and alone.scale == pytest.approx(masked.scale)


def test_too_many_levels_are_refused(toy):
    most = toy.select("c").distinct().count()
    assert P.fit_preprocessor(toy, SPEC, max_levels=most).levels["c"]
    with pytest.raises(ValueError, match="levels"):
        P.fit_preprocessor(toy, SPEC, max_levels=most - 1)


def test_mode_of_tied_levels_is_the_smallest_text(spark):
    rows = [("b",), ("a",), ("a",), ("b",), ("c",), (None,), (None,), (None,)]
    counts = P.level_counts(spark.createDataFrame(rows, "x string"), ["x"])
    assert P.modes(counts).collect() == [("x", "a")]


def test_unknown_levels_encode_to_zeros(spark, toy):
    prep = P.fit_preprocessor(toy, SPEC)
    row = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, "new")], ", ".join(f"{n} double" for n in NAMES) + ", c string")
    out = prep.select(row).first()
    assert [out[n] for n in prep.names if n.startswith("c_")] == [0.0, 0.0, 0.0]


def test_stratified_splits(toy):
    split = splits.stratified_holdout(toy, "k", "y", share=0.25)
    for r in split.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == round(0.25 * r["n"])
    runs = [
        {r["k"] for r in splits.stratified_holdout(toy.repartition(p), "k", "y").where("is_test").collect()}
        for p in (1, 6)
    ]
    assert runs[0] == runs[1]


def test_bucketed_ranks_are_the_global_ranks(toy):
    ranks = [
        {r["k"]: r["_rank"] for r in splits.hash_rank(toy, "k", 5, ["y"], buckets=b).collect()}
        for b in (1, 16)
    ]
    assert ranks[0] == ranks[1]


def test_cuts_are_the_ranks_of_a_full_sort(spark, toy):
    """However many passes: rows read out early, late, or only when all bits are used."""
    rows = [(r["k"], r["y"]) for r in toy.select("k", "y").collect()]
    rows += [(None, rows[0][1]), (rows[1][0], rows[1][1]), (rows[1][0], rows[1][1]), (7_000_000, None)]
    df = spark.createDataFrame(rows, toy.select("k", "y").schema)
    hashed = df.select("y", "k", splits.order_hash("k", 3).alias("a"), splits.order_hash("k", 4).alias("b")).collect()
    for read_out in (0, 3, 1_000):
        sizes, cuts = splits.hash_cuts(df, "k", [3, 4], lambda n: [0, n // 3, n - 1, n], "y", read_out=read_out)
        for y in {r["y"] for r in hashed} - {None}:
            for i, name in enumerate("ab"):
                order = sorted((r[name], r["k"]) for r in hashed if r["y"] == y)
                n = len(order)
                assert sizes[y] == n
                assert cuts[y, i] == [order[0], order[n // 3], order[n - 1], None]


def test_splits_move_no_rows(spark, toy):
    folded = splits.repeated_stratified_folds(toy, "k", "y", k=4, repeats=2)
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and "Window" not in plan and "Aggregate" not in plan
    for name in ("fold_0", "fold_1"):
        counts = folded.groupBy("y").pivot(name, [0, 1, 2, 3]).count().na.fill(0).collect()
        assert all(max(r[1:]) - min(r[1:]) <= 1 for r in counts)
    none = toy.where("k < 0")
    assert splits.plain_folds(none, "k").count() == splits.stratified_folds(none, "k", "y").count() == 0
    twice = splits.plain_folds(toy.unionByName(toy), "k", k=3)
    assert twice.groupBy("k").agg(F.count_distinct("fold").alias("d")).where("d > 1").count() == 0
    unlabelled = toy.limit(5).withColumn("y", F.lit(None).cast("int"))
    assert splits.stratified_folds(unlabelled, "k", "y").where("fold is null").count() == 5


def test_repeats_differ(toy):
    folded = splits.repeated_stratified_folds(toy, "k", "y", k=4, repeats=2)
    assert folded.count() == 400
    assert 0 < folded.where("fold_0 != fold_1").count() < 400


def test_running_minimum_and_normalisation(spark):
    df = spark.createDataFrame([(0.5, 0.7, 0.2, 0.3, 0.1)], "a double, b double, c double, d double, e double")
    p = df.select(families.recombine([F.col(x) for x in "abcde"])).first()[0]
    assert np.allclose(p, [0.5, 0, 0.3, 0, 0.1, 0.1], atol=1e-9)


def test_one_sided_binary_problem(toy):
    one_class = toy.where("y <= 2")
    model = families.fit_frank_hall(one_class, SPEC.only(["x0", "x1"]), "y", "k", classes=(1, 2, 3), params={"rounds": 2})
    assert model.models[1] == 0.0
    assert model.score(one_class).agg(F.max(F.get("proba", F.lit(2)))).first()[0] < 1e-6


def test_cut_search_matches_the_direct_loop(spark):
    rng = np.random.default_rng(2)
    score = rng.normal(3.5, 1.5, 500)
    y = np.clip(np.round(score + rng.normal(0, 0.8, 500)), 1, 6).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, score)], "y int, s double").cache()
    w = (np.arange(6)[:, None] - np.arange(6)[None, :]) ** 2

    def kappa(cuts):
        o = np.zeros((6, 6))
        np.add.at(o, (y - 1, np.searchsorted(cuts, score)), 1)
        return 1 - (w * o).sum() / (w * np.outer(o.sum(1), o.sum(0)) / o.sum()).sum()

    best = np.array([1.5, 2.5, 3.5, 4.5, 5.5])
    top = kappa(best)
    for i in range(5):
        lo = best[i - 1] if i else score.min()
        hi = best[i + 1] if i < 4 else score.max()
        for c in np.linspace(lo, hi, 41)[1:-1]:
            trial = best.copy()
            trial[i] = c
            if kappa(trial) > top:
                best, top = trial, kappa(trial)
    cuts, value = families.optimise_cuts(df, "y", "s", [1.5, 2.5, 3.5, 4.5, 5.5], sweeps=1)
    assert value == pytest.approx(top) and np.allclose(cuts, best)


def test_tree_sum_in_levels(spark, monkeypatch):
    rows = [(m, p, np.full(3, float(p + m)).tobytes()) for m in range(2) for p in range(300)]
    df = spark.createDataFrame(rows, "model int, pid bigint, sums binary").repartition(40)
    monkeypatch.setattr(O, "DIRECT_PARTIALS", 4)
    out = O.tree_sum(df)
    assert np.allclose(out[0], sum(range(300))) and np.allclose(out[1], sum(range(300)) + 300)


def test_trials_are_seeded():
    space = families.XGBOOST_SPACE
    assert V.draw_trials(space, 5) == V.draw_trials(space, 5) != V.draw_trials(space, 5, seed=1)
    for t in V.draw_trials(space, 50):
        assert all(space[n][0] <= v <= space[n][1] for n, v in t.items())
        assert isinstance(t["depth"], int)


def test_gradient_holds_far_from_the_bounds():
    """With a floored difference of sigmoids the slope was 89 where the loss rose by 86."""
    rng = np.random.default_rng(0)
    x, code, w = rng.normal(size=(500, 2)), rng.integers(0, 6, 500), rng.uniform(0.5, 2, 500)
    at, e = np.array([40.0, 0.0, -2, -1, 0, 1, 2]), np.eye(7)[0] * 1e-5
    _, g, _ = O.block_sums(at, x, code, w, 5)
    up, down = (O.block_sums(at + s * e, x, code, w, 5)[0] for s in (1, -1))
    assert g[0] == pytest.approx((up - down) / 2e-5, rel=1e-6)


def test_one_basis_serves_all_training_sets():
    rng = np.random.default_rng(2)
    numbers = np.where(rng.random((60, 2)) < 0.2, np.nan, rng.normal(size=(60, 2)))
    levels = rng.integers(-1, 3, (60, 1)).astype(float)
    layout = O.Layout(("p", "q"), ("c",), (["a", "b", "z"],), 0)
    preps = [
        P.Preprocessor(
            ("p", "q"), ("c",), {"p": 0.1 * i, "q": 0.5}, {"p": 0.3, "q": 0.2 * i}, {"p": 2.0, "q": 1.0 + i},
            {"c": "ab"[i]}, {"c": ("a", "b")[: 2 - i]}, {"c": ("z",) if not i else ("b", "z")},
        )
        for i in range(2)
    ]
    basis = O.Basis.of(layout, preps)
    for prep in [*preps, preps[1].part(FeatureSpec(("q",), ("c",)))]:
        wide = [layout.numeric.index(c) for c in prep.numeric]
        plain = prep.matrix(numbers[:, wide], levels, list(layout.books))
        assert np.allclose(basis.block(numbers, levels) @ basis.map(prep), plain, atol=1e-12)


def test_importance_deals_rows_once_however_many_repeats(toy):
    model = O.fit_ordered_logit(toy, SPEC, "y", classes=CLASSES)

    def exchanges(repeats):
        table = X.permutation_importance(toy, model, NAMES, "y", "k", repeats=repeats, block_rows=50)
        return table._jdf.queryExecution().optimizedPlan().toString().count("Repartition")

    assert exchanges(2) == exchanges(9) == 1


def test_importance_in_blocks_is_that_of_a_plain_shuffle(toy):
    model = O.fit_ordered_logit(toy, SPEC, "y", classes=CLASSES)
    for rows in (toy, toy.withColumn("y", F.when(F.col("k") % 5 != 0, F.col("y")))):
        whole, parted = (
            {r.feature: r for r in X.permutation_importance(rows, model, [*NAMES, "c"], "y", "k", block_rows=b).collect()}
            for b in (10_000, 50)
        )
        assert set(parted) == {*NAMES, "c"}
        frame = model.score(rows.where("y is not null")).toPandas()
        y = frame["y"].to_numpy().astype(int)
        rng = np.random.default_rng(7)

        def kappa(proba):
            p = np.argmax(proba, axis=1) + 1
            return 1 - ((y - p) ** 2).sum() / ((y * y).sum() + (p * p).sum() - 2 * y.sum() * p.sum() / len(y))

        eta = model.score(rows.where("y is not null"), latent="e").toPandas()["e"].to_numpy()
        assert np.array_equal(np.searchsorted(model.model.bounds(), eta, side="right"), np.argmax(np.stack(frame["proba"]), axis=1))
        x0 = frame["x0"].fillna(model.prep.fill["x0"]).to_numpy()
        slope = model.model.beta[0] / model.prep.scale["x0"]
        base = kappa(np.stack(frame["proba"]))
        plain = [base - kappa(O.probabilities(eta + slope * (rng.permutation(x0) - x0), np.array(model.model.cuts))) for _ in range(200)]
        spread = np.std(plain) / np.sqrt(10)
        for table in (whole, parted):
            assert abs(table["x0"].importance_mean - np.mean(plain)) < 5 * spread
            assert 0 < table["x0"].importance_std < 3 * np.std(plain)


def test_slopes_alone_equal_the_gradient():
    rng = np.random.default_rng(5)
    x, code = rng.normal(size=(300, 4)), rng.integers(0, 6, 300)
    w = rng.uniform(0.0, 2, 300)
    for scale in (0.3, 60.0):
        at = np.concatenate([rng.normal(size=4) * scale, [-2.0, -1, 0, 1, 2]])
        _, gradient, _ = O.block_sums(at, x, code, w, 5)
        rows, cuts = O.block_slopes(at[4:], x @ at[:4], code, w)
        assert np.allclose(np.concatenate([x.T @ rows, cuts]), gradient, rtol=1e-10, atol=1e-10)


def test_folds_sum_gradients_only(toy, monkeypatch):
    """Every fold ends at the optimum of its rows, and no fold asks for Hessians while its gradient halves."""
    seen, newton = [], O._pass
    monkeypatch.setattr(O, "_pass", lambda design, tasks, *rest: (seen.append(len(tasks)), newton(design, tasks, *rest))[1])
    rows = toy.select(*[c for c in toy.columns], F.explode(F.sequence(F.lit(0), F.lit(19))).alias("copy"))
    rows = rows.withColumn("k", F.col("k") * 20 + F.col("copy")).drop("copy")
    folded, columns = V.with_folds(rows, "k", "y", k=3, repeats=2)
    _, models = O.cross_fit(folded, SPEC, "y", "k", columns, 3, classes=CLASSES)
    assert all(m.gradient_norm <= 1e-9 for m in models) and max(seen) == 1
    monkeypatch.setattr(O, "_lent", lambda *_: None)
    _, plain = O.cross_fit(folded, SPEC, "y", "k", columns, 3, classes=CLASSES)
    assert max(seen) == 6
    for a, b in zip(models, plain):
        assert np.allclose(a.beta + a.cuts, b.beta + b.cuts, atol=1e-6)


def test_packed_rows_are_the_arrays(toy):
    wide, packed = (O.build_design(toy, SPEC, "y", CLASSES, key="k", packed=p) for p in (False, True))
    kinds = dict(packed.table.dtypes)
    assert kinds["numbers"] == kinds["levels"] == "binary"

    def matrices(design):
        found = {}
        for batch in design.table.toArrow().to_batches():
            code, _, numbers, levels = O._blocks(batch, design.layout)
            for i, row in enumerate(zip(code, numbers, levels)):
                found[batch.column("id")[i].as_py()] = np.concatenate([[row[0]], row[1], row[2]])
        return np.array([found[k] for k in sorted(found)])

    assert np.array_equal(matrices(wide), matrices(packed), equal_nan=True)


def test_logistic_writes_its_rows_once(toy, monkeypatch):
    """A fit of a staged table stages its coded rows and no second copy of the table."""
    from casewright import session

    rows, seen = session.staged(toy), []
    for module in (session, O):
        plain = module.staged
        monkeypatch.setattr(module, "staged", lambda df, plain=plain: (seen.append(df.columns), plain(df))[1])
    S.fit_softmax(rows, SPEC, "y", CLASSES, max_iter=2)
    assert [c for c in seen if "numbers" in c] == seen


def test_parts_of_a_large_table_grow(toy, monkeypatch):
    """Each part lies in the next, and a fit begun on them ends where a fit from zero does."""
    copies = toy.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("x0", F.col("x0") + F.col("copy") / 100)
    plain = O.fit_ordered_logit(copies, SPEC, "y", classes=CLASSES).model
    design = O.build_design(copies, SPEC, "y", CLASSES, key="copy", packed=True)
    monkeypatch.setattr(O, "START_LEAST", 100)
    monkeypatch.setattr(O, "START_ROWS", 700)
    monkeypatch.setattr(O, "START_GROWTH", 1.4)
    parts = O.start_designs(design, O.class_counts(design, 6, [None])[0])
    sizes = [sum(found) for _, _, found in parts]
    assert len(parts) == 2 and 500 < sizes[0] < sizes[1] < 1300
    inside = parts[0][0].table.select("numbers", "levels", "code").subtract(parts[1][0].table.select("numbers", "levels", "code"))
    assert inside.count() == 0
    begun = O.fit_ordered_logit(copies, SPEC, "y", classes=CLASSES).model
    assert np.allclose(begun.beta + begun.cuts, plain.beta + plain.cuts, atol=1e-7)


def test_a_known_spread_is_not_measured_again(toy):
    """The cells are the same, and no job runs where the spread is given."""
    spread = V.spreads(toy, SPEC)
    tracker, group = toy.sparkSession.sparkContext.statusTracker(), "known-spread"
    toy.sparkSession.sparkContext.setJobGroup(group, group)
    known = V.noisy_cells(toy, SPEC, "k", F.lit(0.2), spread=spread)
    assert not tracker.getJobIdsForGroup(group)
    fresh = V.noisy_cells(toy, SPEC, "k", F.lit(0.2))
    assert tracker.getJobIdsForGroup(group)
    gap = toy.agg(*[F.max(F.abs(known[c] - fresh[c])).alias(c) for c in NAMES]).first()
    assert max(gap) == 0


def test_a_fold_whose_own_step_overshoots_is_not_asked_again_for_the_same_hessian():
    """A fold that started with a lent Hessian asked for its own at one point again and again, and never moved."""
    draw = np.random.default_rng(2)
    x = np.column_stack([draw.normal(size=400), np.ones(400)])
    code, w = (x[:, 0] + 0.3 * draw.normal(size=400) > 0).astype(int), np.ones(400)
    ridge, far = np.array([[1e-3, 0.0]] * 2), np.array([[3.0, 0.0], [-3.0, 0.0]])
    path = S._Path(ridge, far, np.eye(2), lent=True)
    path.bend(S._sums(np.zeros((2, 2)), x, code, w, True)[2])
    for _ in range(150):
        if path.probe:
            path.take(S._losses(path.at, path.step, x, code, w))
            continue
        value, g, h = S._sums(path.trial(), x, code, w, path.ask)
        path.take(np.concatenate([[value], g.ravel(), h[np.triu_indices(4)] if path.ask else []]))
        if path.norm < 1e-6:
            break
    assert path.norm < 1e-6


def test_stack_grows_its_boosted_bases_in_one_series_and_blends_as_spark_does(toy, monkeypatch):
    from pyspark.ml.classification import LogisticRegression

    series, blended = [], []
    boosted, softmax = families.fit_boosted, families.softmax.fit_softmax
    monkeypatch.setattr(families, "fit_boosted", lambda *a, **o: series.append(o["masks"]) or boosted(*a, **o))
    monkeypatch.setattr(families.softmax, "fit_softmax", lambda df, *a, **o: blended.append(df) or softmax(df, *a, **o))
    small = {"rounds": 3, "patience": None}
    model = families.fit_stacked(
        toy, SPEC, "y", "k", classes=CLASSES,
        params={"folds": 2, "bases": ("xgboost", "lightgbm"), "xgboost": small, "lightgbm": small},
    )
    assert series == [[(0, 0), (0, 1), None]] and len(model.bases) == 2
    out = model.score(toy).agg(F.count("*"), F.max(F.abs(array_sum(F.col("proba")) - 1))).first()
    assert out[0] == toy.count() and out[1] < 1e-9
    names = list(model.blend.model.names)
    place = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("severity")) - 1
    rows = blended[0].select(place.cast("double").alias("label"), families.array_to_vector(F.array(*names)).alias("features"))
    other = LogisticRegression(
        family="multinomial", standardization=False, regParam=1.0 / rows.count(), maxIter=5000, tol=1e-12
    ).fit(rows)
    assert np.allclose(model.blend.model.weights, other.coefficientMatrix.toArray(), atol=2e-3)
