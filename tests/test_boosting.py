from __future__ import annotations

import heapq
import json
import math
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.functions.probability import array_sum
from casewright.models import boosting as B
from casewright.models import families
from casewright.models import validation as V
from casewright.operators.features import FeatureSpec

NAMES = ("a", "b", "c", "d")
SPEC = FeatureSpec(NAMES, ("g",), {**dict.fromkeys(NAMES, "raw"), "g": "nominal"})
PLAIN = B.Options(rounds=4, step=0.3, patience=None, min_rows=10)


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(500, 4))
    x[:, 3] = draw.integers(0, 4, 500)
    level = draw.integers(0, 4, 500)
    latent = 1.4 * x[:, 0] - x[:, 1] * (x[:, 3] > 1) + 1.2 * (level == 2) + draw.normal(size=500) * 0.7
    y = np.searchsorted(np.quantile(latent, [0.3, 0.6, 0.85]), latent) + 1
    x[draw.random((500, 4)) < 0.08] = np.nan
    return x, [None if i % 29 == 0 else "pqrs"[v] for i, v in enumerate(level)], y


@pytest.fixture(scope="module")
def toy(spark, rows):
    x, level, y = rows
    data = [(i, *[None if np.isnan(v) else float(v) for v in x[i]], level[i], int(y[i])) for i in range(len(y))]
    return spark.createDataFrame(data, "k bigint, a double, b double, c double, d double, g string, y int").repartition(4).cache()


def fit(df, options, problem=None, **more):
    problem = problem or families.softmax_problem(range(4))
    models, table = B.fit_boosted(df, SPEC, "y", "k", [problem], [options], classes=(1, 2, 3, 4), **more)
    return models, table


def plain_codes(bins, rows):
    x, level, _ = rows
    place = [{v: i for i, v in enumerate(kept)} for kept in bins.levels]
    return bins.codes(x, np.array([[place[0].get(v, -1) for v in level]]).T)


def plain_splits(codes, bins, g, h, options):
    """Every split of some rows, tried one after the other: (gain, column, bin, missing left, left rows)."""
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + options.l2)
    every = np.ones(len(g), bool)
    for j, size in enumerate(bins.sizes):
        c, numeric = codes[:, j], j < len(bins.edges)
        for cut in range(size - 1 if numeric else size):
            for side in (False, True) if numeric else (False,):
                left = c <= cut if numeric else c == cut
                if side:
                    if not (c == size - 1).any():
                        continue
                    left = left | (c == size - 1)
                if min(left.sum(), (~left).sum()) < options.min_rows:
                    continue
                if min(h[left].sum(), h[~left].sum()) < options.min_weight:
                    continue
                yield score(left) + score(~left) - score(every), j, cut, side, left


def plain_tree(codes, bins, g, h, options, leaves):
    """Best first, one split after the other; value of every row and the gains in order."""

    def best(rows):
        found = [(round(s[0], 9), -i, s) for i, s in enumerate(plain_splits(codes[rows], bins, g[rows], h[rows], options))]
        return max(found, key=lambda f: f[:2])[2] if found and max(found, key=lambda f: f[:2])[0] > 1e-7 else None

    live, values, gains, depth, count = [], np.zeros(len(g)), [], {0: 0}, 1
    done = []
    heapq.heappush(live, (0.0, 0, np.arange(len(g)), best(np.arange(len(g)))))
    while live:
        _, number, rows, split = heapq.heappop(live)
        if split is None or len(done) + len(live) + 1 >= leaves:
            done.append(rows)
            continue
        gains.append(split[0])
        for part in (rows[split[4]], rows[~split[4]]):
            found = best(part)
            depth[count] = depth[number] + 1
            heapq.heappush(live, (-found[0] if found else 0.0, count, part, found))
            count += 1
    for rows in done:
        values[rows] = -options.step * g[rows].sum() / (h[rows].sum() + options.l2)
    return values, gains, depth


@pytest.mark.parametrize("leaves", [2, 6, 15])
def test_trees_equal_a_plain_search(toy, rows, leaves):
    """Four rounds of a logistic model against every split tried row by row."""
    options = replace(PLAIN, leaves=leaves)
    problem = B.Problem("logistic", (0.0, 0.0, 1.0, 1.0))
    model = fit(toy, options, problem)[0][0][0]
    codes, y = plain_codes(model.bins, rows), (rows[2] > 2).astype(float)
    w = np.where(y == 1, 250 / y.sum(), 250 / (500 - y.sum()))
    raw = np.full(500, model.start[0])
    uneven = False
    for trees in model.rounds:
        g, h, _ = B.gradients("logistic", raw[:, None], y, w)
        values, gains, depth = plain_tree(codes, model.bins, g[:, 0], h[:, 0], options, leaves)
        own = trees[0].values(codes, B.HistogramLayout.of(model.bins))
        assert np.allclose(own, values, atol=1e-9)
        assert (np.array(trees[0].feature) < 0).sum() <= leaves
        uneven |= max(depth.values()) > np.log2(leaves) + 1
        raw = raw + own
    assert np.allclose(model.output(codes)[:, 0], 1 / (1 + np.exp(-raw)))
    assert uneven or leaves < 15


def test_gains_settle_in_order(rows):
    """The splits a grower settles are those of the largest gain among all live leaves."""
    draw = np.random.default_rng(3)
    codes = draw.integers(0, 30, (2000, 3)).astype(np.uint8)
    g = np.where(codes[:, 0] < 3, 4.0, 0.1 * codes[:, 1]) + draw.normal(size=2000) - 1
    bins = B.Bins(("a", "b", "c"), (), tuple(tuple(range(29)) for _ in range(3)), ())
    layout, columns = B.HistogramLayout.of(bins), np.arange(3)
    grower = B.Grower(columns, layout, replace(PLAIN, leaves=12), np.zeros(3))
    sizes, starts, width = layout.part(columns)
    passes = 0
    while not grower.done:
        asked = grower.ask()
        tree = grower.tree(whole=True)
        slot = np.full(len(tree.feature), -1)
        slot[[grower.number[n] for n in asked]] = range(len(asked))
        own = slot[tree.leaf(codes, layout)]
        m = own >= 0
        sums = B._sums(codes[m], own[m], starts, width, len(asked), g[m], np.ones(m.sum()))
        grower.tell(asked, sums.reshape(len(asked), 3, width))
        passes += 1
    live, seen = [0], []
    for i in grower.order:
        gains = {n: grower.nodes[n].split.gain for n in live if grower.nodes[n].split}
        assert gains[i] == max(gains.values())
        seen.append(i)
        live.remove(i)
        live += grower.nodes[i].children
    assert len(seen) == 11 and passes < 11


def test_folds_grown_together_equal_separate_fits(toy):
    folded, columns = V.with_folds(toy, "k", "y", k=2, repeats=2)
    options = replace(PLAIN, rounds=10, leaves=5, row_share=0.8, column_share=0.7)
    masks = [(r, f) for r in range(2) for f in range(2)]
    shared, table = fit(folded, options, masks=masks, folds=columns)
    held = B.score_held_out(table, shared, masks, (1, 2, 3, 4))
    assert held.count() == 1000 and held.select("id").distinct().count() == 500
    for i, (r, f) in enumerate(masks):
        alone = fit(folded, options, masks=[(r, f)], folds=columns)[0][0][0]
        assert alone.rounds == shared[i][0].rounds or all(
            a.feature == b.feature and a.bin == b.bin and np.allclose(a.value, b.value)
            for x, y in zip(alone.rounds, shared[i][0].rounds) for a, b in zip(x, y)
        )
    one = shared[2][0].score(folded.where("fold_1 = 0")).select(F.col("k").alias("id"), F.col("proba").alias("p"))
    both = held.where("repeat = 1 and fold = 0").join(one, "id")
    gap = both.agg(F.count("*"), F.max(array_sum(F.zip_with("p", "outputs", lambda a, b: F.abs(a - b))))).first()
    assert gap[0] == 250 and gap[1] < 1e-9


def test_growth_stops_when_loss_does(toy):
    options = B.Options(rounds=60, step=0.5, leaves=8, patience=3, tolerance=0.01)
    model = fit(toy, options)[0][0][0]
    assert 3 <= len(model.rounds) < 60 and len(model.rounds) == int(np.argmin(model.trail))
    out = model.score(toy).agg(F.max(F.abs(array_sum(F.col("proba")) - 1)), F.count("*")).first()
    assert out[0] < 1e-9 and out[1] == 500


def test_monotone_columns_never_fall(toy, rows):
    way = {"a": 1, "b": -1}
    problem = B.Problem("logistic", (0.0, 0.0, 1.0, 1.0))
    free = fit(toy, replace(PLAIN, rounds=12, leaves=12), problem)[0][0][0]
    bound = fit(toy, replace(PLAIN, rounds=12, leaves=12, monotone=way), problem)[0][0][0]

    def falls(model):
        codes, total = plain_codes(model.bins, rows)[:100], 0
        for j, sign in ((0, 1), (1, -1)):
            steps = []
            for c in range(model.bins.sizes[j] - 1):
                moved = codes.copy()
                moved[:, j] = c
                steps.append(model.output(moved)[:, 0])
            total += int((sign * np.diff(np.array(steps), axis=0) < -1e-12).sum())
        return total

    assert falls(bound) == 0 < falls(free)
    assert sum((np.array(t.feature) == 0).sum() for r in bound.rounds for t in r) > 0


def test_monotone_comparison(toy):
    table = V.monotone_comparison(
        toy, SPEC, "y", "k", {"a": 1, "b": -1, "g": 1, "unknown": 1},
        k=3, classes=(1, 2, 3, 4), cut=3, params={"rounds": 4, "step": 0.3, "patience": None},
    )
    got = {r.variant: r for r in table.collect()}
    assert {v: r.n_constrained for v, r in got.items()} == {"unconstrained": 0, "monotone_constrained": 2}
    assert all(0.3 < r.cv_qwk_mean < 1 and 0 < r.cv_qwk_std < 0.3 for r in got.values())
    assert got["unconstrained"].cv_qwk_mean != got["monotone_constrained"].cv_qwk_mean


def test_many_levels_and_empty_columns(spark):
    data = [(i, None, f"l{i % 400}" if i % 3 else "often", 1 + (i % 3 == 0) + (i % 2)) for i in range(1200)]
    df = spark.createDataFrame(data, "k bigint, a double, g string, y int")
    spec = FeatureSpec(("a",), ("g",), {"a": "raw", "g": "nominal"})
    problem = families.softmax_problem(range(3))
    models, _ = B.fit_boosted(df, spec, "y", "k", [problem], [replace(PLAIN, rounds=3)], classes=(1, 2, 3))
    model = models[0][0]
    assert len(model.bins.levels[0]) == 254 and "often" in model.bins.levels[0]
    assert model.score(df.limit(5)).count() == 5 and len(model.rounds) == 3


def test_halving_records_every_rung(toy):
    trials = V.draw_trials(families.LIGHTGBM_SPACE, 5, seed=3)
    log = V.tune_family(toy, "lightgbm", SPEC, "y", "k", trials=trials, k=2, rungs=(1, 2, 4), classes=(1, 2, 3, 4), cut=3)
    seen = log.orderBy("rung", "trial").collect()
    assert [sum(r.rung == g for r in seen) for g in range(3)] == [5, 3, 2]
    assert [r.rounds for r in seen] == [1] * 5 + [2] * 3 + [4] * 2 and all(r.n == 500 for r in seen)
    for g in range(2):
        here = sorted((r for r in seen if r.rung == g), key=lambda r: (-r.cv_qwk, r.trial))
        later = {r.trial for r in seen if r.rung == g + 1}
        assert {r.trial for r in here[: len(later)]} == later == {r.trial for r in here if r.kept}
    assert all(json.loads(r.params) == trials[r.trial] for r in seen)
    best = max((r for r in seen if r.rung == 2), key=lambda r: (r.cv_qwk, -r.trial))
    assert V.best_params(log, trials) == trials[best.trial]
    assert seen[-1].best_so_far == max(r.cv_qwk for r in seen)


def test_erfc_is_exact_to_ten_digits():
    x = np.concatenate([np.linspace(-8, 24, 4001), [0.0, -30.0, 40.0]])
    assert np.allclose(families.erfc(x), [math.erfc(v) for v in x], rtol=1e-10, atol=1e-300)


def test_superseded_score_tables_are_deleted(toy, monkeypatch):
    """Each refresh of the scores wrote another table and kept them all."""
    kept = []
    staged = B.staged
    monkeypatch.setattr(B, "staged", lambda df: kept.append(staged(df)) or kept[-1])
    fit(toy, replace(PLAIN, rounds=5))
    alive = [os.path.exists(t._casewright_path) for t in kept]
    assert len(alive) >= 3 and alive[0] and sum(alive) == 2


def test_sums_reach_the_driver_once_a_model_where_they_are_large(spark, toy, monkeypatch):
    sent = []
    real = B.tree_sum

    def counting(parts, **options):
        rows = parts.collect()
        sent.append((len(rows), len({r["model"] for r in rows})))
        return real(spark.createDataFrame(rows, parts.schema), **options)

    def grown() -> list:
        models, _ = B.fit_boosted(
            toy, SPEC, "y", "k", [families.softmax_problem((1, 2, 3, 4))], [PLAIN], classes=(1, 2, 3, 4)
        )
        return models[0][0].rounds

    monkeypatch.setattr(B, "tree_sum", counting)
    direct = grown()
    assert max(rows for rows, _ in sent) > 1
    sent.clear()
    monkeypatch.setattr(B, "DIRECT_BYTES", 0)
    assert grown() == direct
    assert all(rows == models for rows, models in sent)


def test_models_that_fit_a_task_grow_there_without_passes(toy, monkeypatch):
    """Each round cost a pass a level, and each pass carried the sums of all bins of all models."""
    folded, columns = V.with_folds(toy, "k", "y", k=3, repeats=1)
    options = B.Options(rounds=12, leaves=6, min_rows=5, row_share=0.8, column_share=0.7, patience=3)

    def grown():
        series, _, _ = B.open_series(
            folded, SPEC, "y", "k", [families.softmax_problem(range(4))], [options],
            classes=(1, 2, 3, 4), masks=[(0, 0), (0, 1), None], folds=columns,
        )
        series.advance(5)
        series.advance()
        return series.passes, [series.model(i) for i in range(3)]

    monkeypatch.setattr(B, "LEAST_ROUNDS", 1)
    passes, alone = grown()
    assert passes == 0
    monkeypatch.setattr(B, "TASK_BYTES", 0)
    passes, shared = grown()
    assert passes > 12
    for a, b in zip(alone, shared):
        assert len(a.rounds) == len(b.rounds) and np.allclose(a.trail, b.trail)
        for x, y in zip((t for r in a.rounds for t in r), (t for r in b.rounds for t in r)):
            assert (x.feature, x.bin, x.left) == (y.feature, y.bin, y.left) and np.allclose(x.value, y.value)


def test_columns_of_few_bins_share_a_byte_and_equal_ones_a_sum():
    draw = np.random.default_rng(5)
    sizes = np.array([3, 200, 4, 3, 200, 7, 3, 256])
    codes = np.stack([draw.integers(0, s, 3000) for s in sizes], 1).astype(np.uint8)
    codes[:, 4] = codes[:, 1]
    layout = B.HistogramLayout(sizes, np.zeros(8, bool))
    cells = B.Cells(codes, layout)
    assert sorted(j for g in layout.groups for j in g) == list(range(8)) and len(layout.groups) == 5
    assert len(set(cells.first)) == 4
    columns, rows = np.array([0, 1, 3, 4, 5, 7]), np.flatnonzero(draw.random(3000) < 0.6)
    slot, g, h = draw.integers(0, 2, len(rows)), draw.normal(size=len(rows)), draw.random(len(rows))
    found = cells.sums(columns, rows, slot * 256, 2, [g + 1j * h])[0]
    starts = layout.part(columns)[1]
    for j, a in zip(columns, starts):
        for node in range(2):
            at = codes[rows, j][slot == node]
            for q, x in enumerate((g, h, np.ones(len(rows)))):
                assert np.allclose(found[node, q, a : a + sizes[j]], np.bincount(at, x[slot == node], sizes[j]))


def test_passes_read_blocks_of_rows(toy, monkeypatch):
    """Passes read a row of bytes a table row, which cost more than their sums."""
    monkeypatch.setattr(B, "BLOCK_BYTES", 2000)
    series, _, table = B.open_series(
        toy, SPEC, "y", "k", [families.softmax_problem(range(4))], [PLAIN], classes=(1, 2, 3, 4)
    )
    series.advance()
    cells = series.blocks.select(F.length("code").alias("n"), F.length("codes").alias("m")).collect()
    assert table.count() == 500 == sum(r.n for r in cells) // 4 and 500 * 5 == sum(r.m for r in cells)
    assert 8 < len(cells) < 60 and len(series.model(0).rounds) == 4
