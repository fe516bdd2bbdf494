"""Explanation operators: importance, attributions, surrogate rules, monotonicity, latent scale."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.probability import argmax_class
from casewright.models.ordered_logit import fit_ordered_logit
from casewright.operators.features import FeatureSpec
from casewright.operators.metrics import CLASSES, join_groups, kappa_from_sums, qwk
from casewright.operators.profile import class_ranges
from casewright.operators.ranking import exact_quantiles, quantile_bins
from casewright.session import ensure_staged, small_table, staged

# Fixed value: importance below this is negligible.
NEGLIGIBLE = 0.001


# --- Permutation importance -------------------------------------------------------------------


# Rows of a block within which values are shuffled, on average.
SHUFFLE_ROWS = 25_000


def permutation_importance(
    df: DataFrame,
    model: Any,
    features: Sequence[str],
    label: str,
    key: str,
    *,
    repeats: int = 10,
    seed: int = 42,
    classes: Sequence[int] = CLASSES,
    block_rows: int = SHUFFLE_ROWS,
) -> DataFrame:
    """Drop in kappa when one feature's values are shuffled among the labelled rows.

    Rows are dealt by a seeded hash to blocks of about ``block_rows``, so every
    block is a random draw of all rows, and values are shuffled within blocks; up
    to that size there is one block. All repeats and features share that one
    exchange. A model whose score is a sum of one term a column (``terms``) only
    exchanges its terms and a block returns sums; for any other model each copy of
    a row swaps in one feature from its donor.
    """
    rows = ensure_staged(df).where(F.col(label).isNotNull())
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.withColumn("_h", F.xxhash64(F.lit(seed), key)).withColumn("_block", F.pmod("_h", F.lit(blocks)))
    names, y = list(features), F.col(label).cast("bigint").alias("_y")

    def together(*columns: Column) -> DataFrame:
        narrow = dealt.select("_block", "_h", y, *columns)
        return narrow.repartition(blocks, "_block").sortWithinPartitions("_block", "_h")

    if hasattr(model, "terms"):
        terms = model.terms()[1]
        used = [c for c in names if c in terms]
        parted = F.array(*[terms[c] for c in used]).cast("array<double>").alias("_terms")
        run = _term_sums([names.index(c) for c in used], len(names), repeats, seed, model.model.bounds(), classes)
        sums = together(parted, model.eta().alias("_eta")).mapInArrow(
            run, "at int, repeat int, " + ", ".join(f"{c} bigint" for c in _SUMS)
        )
        feature = F.get(F.array(*[F.lit(c) for c in names]), F.col("at")).alias("feature")
        kappas = sums.groupBy(feature, "repeat").agg(kappa_from_sums(*[F.sum(c) for c in _SUMS]).alias("kappa"))
    else:
        own = [F.col(c).alias(f"_own{i}") for i, c in enumerate(names)]
        narrow = together(*own)
        kinds = [(f.name, f.dataType.simpleString()) for f in narrow.schema.fields[3:]]
        kinds += [(f"_donor{i}", kind) for i, (_, kind) in enumerate(kinds)]
        pairs = narrow.mapInArrow(_pairs(len(names), repeats, seed), ", ".join(f"{n} {k}" for n, k in [("_y", "bigint"), ("repeat", "int"), *kinds]))
        swapped = F.when(F.col("repeat") < 0, F.array(F.lit(None).cast("string"))).otherwise(F.array(*[F.lit(c) for c in names]))
        copies = pairs.withColumn("feature", F.explode(swapped))
        cells = [F.when(F.col("feature") == c, F.col(f"_donor{i}")).otherwise(F.col(f"_own{i}")).alias(c) for i, c in enumerate(names)]
        scored = model.score(copies.select("feature", "repeat", "_y", *cells))
        kappas = scored.groupBy("feature", "repeat").agg(qwk(F.col("_y"), argmax_class(F.col("proba"), classes)).alias("kappa"))
    # One row a feature and repeat, and the row of the unshuffled table.
    base = F.max(F.when(F.col("repeat") < 0, F.col("kappa"))).over(Window.partitionBy(F.lit(0)))
    drops = kappas.withColumn("drop", base - F.col("kappa")).where("repeat >= 0")
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("importance_mean"), "feature")
    return (
        drops.groupBy("feature")
        .agg(
            F.avg("drop").alias("importance_mean"),
            F.stddev_pop("drop").alias("importance_std"),
        )
        .withColumn("rank", F.row_number().over(order))  # over one row per feature
    )


_SUMS = ("n", "s_y", "s_p", "s_yy", "s_pp", "s_d2")


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one block at a time, from batches that are sorted by ``_block``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = batch.column("_block").to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(at)) + 1), len(at)] if len(at) else []
        for start, end in zip(ends, ends[1:]):
            if held and held[-1].column("_block")[0].as_py() != at[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _donors(block: pa.Table, seed: int, repeat: int) -> np.ndarray:
    """A seeded shuffle of the places of a block's rows."""
    return np.random.default_rng([seed, repeat, block.column("_block")[0].as_py()]).permutation(block.num_rows)


def _term_sums(
    places: Sequence[int], n_features: int, repeats: int, seed: int, bounds: np.ndarray, classes: Sequence[int]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums for kappa of the unshuffled rows (``repeat`` -1) and of every feature and repeat.

    ``places[j]`` is the feature of term j; a feature without a term changes nothing.
    """
    values = np.array(classes, dtype=np.int64)
    free = np.setdiff1d(np.arange(n_features), places)

    def sums(levels: np.ndarray, y: np.ndarray, eta: np.ndarray) -> np.ndarray:
        place = np.zeros(len(eta), dtype=np.int64)
        for bound in bounds:
            place += eta >= bound
        size = len(values)
        n = np.bincount(y * size + place, minlength=len(levels) * size).reshape(-1, size)
        a, p = levels[:, None], values[None, :]
        return np.array([(n * v).sum() for v in (1, a, p, a * a, p * p, (a - p) ** 2)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((repeats, n_features, len(_SUMS)), dtype=np.int64)
        base = np.zeros(len(_SUMS), dtype=np.int64)
        for block in _whole_blocks(batches):
            levels, y = np.unique(block.column("_y").to_numpy(), return_inverse=True)
            eta = block.column("_eta").to_numpy()
            flat = block.column("_terms").combine_chunks().flatten().to_numpy()
            terms = np.ascontiguousarray(flat.reshape(len(eta), len(places)).T)
            same = sums(levels, y, eta)
            base += same
            for r in range(repeats):
                donors = _donors(block, seed, r)
                total[r, free] += same
                for j, term in zip(places, terms):
                    total[r, j] += sums(levels, y, eta + (term[donors] - term))
        if base[0]:
            rows = np.vstack([base, total.reshape(-1, len(_SUMS))])
            at, repeat = np.tile(np.arange(n_features), repeats), np.repeat(np.arange(repeats), n_features)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(-1, at), pa.int32()), pa.array(np.append(-1, repeat), pa.int32())]
                + [pa.array(np.ascontiguousarray(c)) for c in rows.T],
                names=["at", "repeat", *_SUMS],
            )

    return run


def _pairs(
    n_features: int, repeats: int, seed: int, step: int = 2_000
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every row once as it is (``repeat`` -1) and beside its donor of each repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _whole_blocks(batches):
            own = block.select(["_y", *[f"_own{i}" for i in range(n_features)]]).combine_chunks()
            for r in range(-1, repeats):
                donors = _donors(block, seed, r) if r >= 0 else np.arange(own.num_rows)
                for start in range(0, own.num_rows, step):
                    at = pa.array(donors[start : start + step])
                    mine, other = own.slice(start, step), own.take(at)
                    columns = [mine.column(0), pa.array(np.full(len(at), r), pa.int32()), *mine.columns[1:], *other.columns[1:]]
                    names = ["_y", "repeat", *mine.column_names[1:], *[f"_donor{i}" for i in range(n_features)]]
                    yield from pa.table(columns, names=names).combine_chunks().to_batches()

    return run


def negligible_features(table: DataFrame, value: str, limit: float = NEGLIGIBLE) -> DataFrame:
    return table.agg(
        F.count_if(F.col(value) < F.lit(limit)).alias("n_negligible"),
        F.count(F.lit(1)).alias("n_features"),
    )


# --- Attributions -------------------------------------------------------------------------------


# Copies of a background row that one block may hold, counted in cells; few enough to stay in a core's cache.
WALK_CELLS = 50_000


def _walk_orders(seed: int, hashes: np.ndarray, d: int) -> np.ndarray:
    """A seeded order of ``d`` features per row: the places of ``d`` mixed 64-bit numbers, sorted."""
    with np.errstate(over="ignore"):
        z = hashes.astype(np.uint64)[:, None] + np.uint64(seed) + (np.arange(d, dtype=np.uint64) + 1) * np.uint64(
            0x9E3779B97F4A7C15
        )
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return np.argsort(z, axis=1, kind="stable")


def _walk(
    x: np.ndarray,
    background: np.ndarray,
    orders: np.ndarray,
    expected: Callable[[np.ndarray], np.ndarray],
    weights: np.ndarray | None,
) -> np.ndarray:
    """Gain of each feature when all rows take theirs, one a step, in the order of their row."""
    n, d = x.shape
    at = np.arange(n)
    out = np.empty((n, d))
    if weights is None:
        state = np.repeat(background[None, :, :], n, axis=0)
    else:
        state = np.repeat((background @ weights)[None, :], n, axis=0)
        swaps = weights[:, None] * background.T  # what the background has of each feature
    last = np.full(n, float(np.mean(expected(background if weights is None else background @ weights))))
    for step in range(d):
        j = orders[:, step]
        if weights is None:
            state[at, :, j] = x[at, j][:, None]
            value = expected(state.reshape(-1, d))
        else:
            state += (weights[j] * x[at, j])[:, None]
            state -= swaps[j]
            value = expected(state.ravel())
        value = value.reshape(n, -1).mean(axis=1)
        out[at, j] = value - last
        last = value
    return out


def severity_attributions(
    df: DataFrame,
    key: str,
    inputs: str,
    background: np.ndarray,
    expected: Callable[[np.ndarray], np.ndarray],
    *,
    weights: np.ndarray | None = None,
    seed: int = 42,
) -> DataFrame:
    """Permutation attributions of an expected class: ``(key, base, prediction, values)``.

    Per row one seeded order of the features is walked forward and backward; each
    step averages the model over the background rows with the features walked so
    far taken from the row.  ``base + sum(values) = prediction`` holds to rounding.
    ``inputs`` is an array column; the background is a small fixed sample.

    All rows of a block step together.  ``expected`` maps a matrix of inputs to
    expected classes; with ``weights`` it maps the scores ``inputs @ weights``
    instead, and a step only adds the change of one feature to the score.
    """
    d = background.shape[1]
    base = float(np.mean(expected(background if weights is None else background @ weights)))
    kind = dict(df.dtypes)[key]
    step = max(1, WALK_CELLS // max(1, len(background) * (d if weights is None else 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
                matrix = np.asarray(flat, dtype=float).reshape(batch.num_rows, d)
                orders = _walk_orders(seed, batch.column("h").to_numpy(), d)
                values = _walk(matrix, background, orders, expected, weights)
                values += _walk(matrix, background, orders[:, ::-1], expected, weights)
                values /= 2
                offsets = np.arange(0, values.size + 1, d, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key),
                        pa.array(np.full(len(values), base)),
                        pa.array(expected(matrix if weights is None else matrix @ weights)),
                        pa.ListArray.from_arrays(offsets, values.ravel()),
                    ],
                    names=[key, "base", "prediction", "values"],
                )

    narrow = df.select(key, F.col(inputs).alias("x"), F.xxhash64(F.lit(seed), key).alias("h"))
    return narrow.mapInArrow(
        run, f"{key} {kind}, base double, prediction double, values array<double>"
    )


def model_attributions(
    df: DataFrame,
    key: str,
    model: Any,
    features: Sequence[str],
    background: DataFrame,
    *,
    seed: int = 42,
    classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """Permutation attributions for a model of any family: ``(key, base, prediction, values)``.

    As ``severity_attributions``, with the model's own ``score`` on copies of the
    rows: 2 (features + 1) x background rows a row, so ``df`` is a sample of cases
    and ``background`` a few dozen rows. Steps are averaged before they are put
    side by side, so one case is a few hundred rows in a task.
    """
    d = len(features)
    draws = [F.struct(F.xxhash64(F.lit(seed), F.col(key), F.lit(j)).alias("h"), F.lit(j).alias("j")) for j in range(d)]
    order = F.transform(F.array_sort(F.array(*draws)), lambda s: s["j"])
    rows = df.select(key, F.struct(*features).alias("_own"), order.alias("_order"))
    bag = background.agg(F.collect_list(F.struct(*features)).alias("_bag"))
    walked = (
        join_groups(rows, bag, [])
        .withColumn("_other", F.explode("_bag"))
        .withColumn("_back", F.explode(F.array(F.lit(False), F.lit(True))))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    )

    def cell(j: int, name: str) -> Column:
        place = F.array_position("_order", F.lit(j))  # from 1
        taken = F.when(F.col("_back"), place > d - F.col("_step")).otherwise(place <= F.col("_step"))
        return F.when(taken, F.col("_own")[name]).otherwise(F.col("_other")[name]).alias(name)

    copies = walked.select(key, "_order", "_back", "_step", *[cell(j, c) for j, c in enumerate(features)])
    expected = sum((F.lit(float(c)) * F.get("proba", F.lit(i)) for i, c in enumerate(classes)), F.lit(0.0))
    scored = model.score(copies).select(key, "_order", "_back", "_step", expected.alias("_v"))
    means = scored.groupBy(key, "_back", "_step").agg(F.avg("_v").alias("_v"), F.first("_order").alias("_order"))
    steps = Window.partitionBy(key, "_back").orderBy("_step")  # features + 1 rows
    at = F.when(F.col("_back"), d - F.col("_step")).otherwise(F.col("_step") - 1)
    gains = means.withColumn("_gain", F.col("_v") - F.lag("_v").over(steps))
    gains = gains.withColumn("_j", F.when(F.col("_step") > 0, F.get("_order", at)))
    per_feature = gains.groupBy(key, "_j").agg(
        F.avg("_gain").alias("_gain"),
        F.avg(F.when(F.col("_step") == 0, F.col("_v"))).alias("_base"),
        F.avg(F.when(F.col("_step") == d, F.col("_v"))).alias("_end"),
    )
    listed = F.array_sort(F.collect_list(F.when(F.col("_j").isNotNull(), F.struct("_j", "_gain"))))
    return per_feature.groupBy(key).agg(
        F.max("_base").alias("base"),
        F.max("_end").alias("prediction"),
        F.transform(listed, lambda s: s["_gain"]).alias("values"),
    )


def mean_absolute(
    df: DataFrame, values: str, names: Sequence[str], top: int | None = 30
) -> DataFrame:
    """Mean absolute attribution per feature; the largest ``top`` (a report top-n)."""
    table = (
        df.select(F.posexplode(values).alias("_j", "_v"))
        .groupBy("_j")
        .agg(F.avg(F.abs("_v")).alias("mean_abs"))
        .select(F.get(F.array(*[F.lit(n) for n in names]), F.col("_j")).alias("feature"), "mean_abs")
    )
    return table.orderBy(F.desc("mean_abs"), "feature").limit(top) if top else table


def latent_contributions(
    df: DataFrame, key: str, inputs: Mapping[str, Column], beta: Mapping[str, float]
) -> DataFrame:
    """``(key, values)``: what each feature adds to a row's latent score against the mean row."""
    names = list(inputs)
    rows = df.select(key, *[inputs[n].alias(f"_x{i}") for i, n in enumerate(names)])
    means = rows.agg(*[F.avg(f"_x{i}") for i in range(len(names))]).first()
    parts = [
        F.lit(float(beta[n])) * (F.col(f"_x{i}") - F.lit(float(means[i])))
        for i, n in enumerate(names)
    ]
    return rows.select(key, F.array(*parts).alias("values"))


def illustrative_cases(
    df: DataFrame,
    key: str,
    score: str,
    threshold: float,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The lowest, the highest and the closest case to the threshold; lowest key on ties.

    One aggregate; no sort.
    """
    columns = [key, score, *[c for c in keep if c not in (key, score)]]
    row = F.struct(*columns)

    def first(*order: Column) -> Column:
        return F.min_by(row, F.struct(*order, F.col(key)))

    p = F.col(score)
    picks = {
        "clearly_not_severe": first(p),
        "clearly_severe": first(-p),
        "borderline": first(F.abs(p - F.lit(float(threshold)))),
    }
    wide = df.agg(*[c.alias(n) for n, c in picks.items()])
    tagged = [F.struct(F.lit(n).alias("case_type"), F.col(n).alias("case")) for n in picks]
    return wide.select(F.explode(F.array(*tagged)).alias("e")).select("e.case_type", "e.case.*")


# --- Surrogate rules ------------------------------------------------------------------------------


def surrogate_rules(
    df: DataFrame,
    numeric: Sequence[str],
    decision: Column,
    *,
    fills: Mapping[str, float],
    max_depth: int = 3,
    min_leaf: int = 25,
    seed: int = 42,
) -> tuple[str, float]:
    """A shallow tree on the model's own decisions: its rules and its agreement with them."""
    names = [c for c in numeric if c in fills]
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))) for c in names]
    rows = staged(
        df.select(
            decision.cast("double").alias("label"), array_to_vector(F.array(*filled)).alias("features")
        )
    )
    tree = DecisionTreeClassifier(
        maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed
    ).fit(rows)
    agreement = tree.transform(rows).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")))
    return "\n".join(_rules(tree._call_java("rootNode"), names)), float(agreement.first()[0])


# What a leaf of the surrogate tree decides.
OUTCOMES = {0: "-> CLOSE (not progressed)", 1: "-> INVESTIGATE (progressed)"}


def _rules(node, names: Sequence[str], depth: int = 0) -> list[str]:
    """One line a branch, read off the fitted tree's nodes, left branch first."""
    indent = "  " * depth
    if node.subtreeDepth() == 0:
        return [indent + OUTCOMES[int(node.prediction())]]
    split = node.split()
    name, bound = names[split.featureIndex()], split.threshold()
    left, right = _rules(node.leftChild(), names, depth + 1), _rules(node.rightChild(), names, depth + 1)
    return [f"{indent}If {name} <= {bound}", *left, f"{indent}Else", *right]


# --- Monotonicity audit ------------------------------------------------------------------------------


def monotone_audit(
    df: DataFrame, features: Sequence[str], score: str, *, bins: int = 10
) -> DataFrame:
    """Share of steps between neighbouring value bins in which the mean score falls.

    Zero means the score never falls as the feature rises, which is what a
    direction of +1 asks for.
    """
    binned = quantile_bins(
        df.select(score, *[F.col(c).cast("double").alias(c) for c in features]),
        features,
        bins,
        [score],
    )
    means = (
        binned.where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("column").orderBy("bin")  # a row per bin
    steps = means.withColumn("_step", F.col("mean_score") - F.lag("mean_score").over(order))
    return steps.groupBy("column").agg(
        F.count("_step").alias("n_steps"),
        F.count_if(F.col("_step") < 0).alias("n_falls"),
        (F.count_if(F.col("_step") < 0) / F.nullif(F.count("_step"), F.lit(0))).alias("share_falling"),
    )


# --- Latent scale -------------------------------------------------------------------------------------


def latent_per_class(df: DataFrame, eta: str, label: str) -> DataFrame:
    """Size, mean and 5th / 95th percentile of the latent score per class."""
    base = df.groupBy(F.col(label).alias("severity")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(eta).alias("latent_mean")
    )
    ends = exact_quantiles(
        df.select(F.col(label).alias("severity"), F.col(eta).alias("value")),
        "value",
        {"latent_p5": 0.05, "latent_p95": 0.95},
        ["severity"],
    )
    return base.join(F.broadcast(ends), "severity", "left")  # a row per class


def recovered_boundaries(
    df: DataFrame, feature: str, label: str, classes: Sequence[int] = CLASSES
) -> DataFrame:
    """Ranges of ``feature`` per class beside the boundaries a one-variable ordered logit finds.

    ``recovered_upper_boundary`` is the feature's value at which the next class
    becomes as likely as not; null for the last class.
    """
    rows = staged(df.where(F.col(feature).isNotNull()).select(label, feature))
    spec = FeatureSpec((feature,), (), {feature: "raw_numeric"})
    fitted = fit_ordered_logit(
        rows, spec, label, classes=tuple(classes), alpha=1e-6, class_weight=None, scaled=False
    )
    slope = fitted.model.beta[0]
    ends = [(int(c), cut / slope) for c, cut in zip(classes, fitted.model.cuts)] + [(int(classes[-1]), None)]
    bounds = small_table(df.sparkSession, ends, f"{label} int, recovered_upper_boundary double")
    return class_ranges(rows, feature, label).join(F.broadcast(bounds), label)  # a row per class


def boundary_spacing(table: DataFrame, order: str, boundary: str) -> DataFrame:
    """Distance of each boundary to the one before."""
    steps = Window.partitionBy(F.lit(0)).orderBy(order)  # a row per boundary
    return table.withColumn("spacing", F.col(boundary) - F.lag(boundary).over(steps))


def coefficient_ranking(
    table: DataFrame, value: str = "coefficient", *, top: int = 15, bottom: int = 10
) -> DataFrame:
    """The largest and the smallest coefficients (two report top-n lists)."""
    high = table.orderBy(F.desc(value), "feature").limit(top).withColumn("side", F.lit("top"))
    low = table.orderBy(F.asc(value), "feature").limit(bottom).withColumn("side", F.lit("bottom"))
    return high.unionByName(low)


def coefficients(spark, names: Sequence[str], beta: Sequence[float]) -> DataFrame:
    return small_table(
        spark, list(zip(names, map(float, beta))), "feature string, coefficient double"
    )
