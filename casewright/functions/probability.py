"""Expressions on class-probability arrays and seeded per-row randomness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: floor of a class probability.
FLOOR = 1e-12


def sigmoid(col: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def ordered_probabilities(eta: Column, cuts: Sequence[float]) -> Column:
    """Class probabilities of a cumulative-logit model, floored and not renormalised."""
    below = [sigmoid(F.lit(float(c)) - eta) for c in cuts]
    parts = [below[0]]
    parts += [hi - lo for lo, hi in zip(below, below[1:])]
    parts.append(F.lit(1.0) - below[-1])
    return F.array(*[F.greatest(p, F.lit(FLOOR)) for p in parts])


def dot(x: Column, beta: Sequence[float]) -> Column:
    weights = F.array(*[F.lit(float(b)) for b in beta])
    return F.aggregate(
        F.zip_with(x, weights, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v
    )


def array_sum(col: Column) -> Column:
    return F.aggregate(col, F.lit(0.0), lambda acc, v: acc + v)


def argmax_class(proba: Column, classes: Sequence[int]) -> Column:
    """Most likely class; the first one wins a tie."""
    labels = F.array(*[F.lit(int(c)) for c in classes])
    return F.element_at(labels, F.array_position(proba, F.array_max(proba)).cast("int"))


def tail_probability(proba: Column, classes: Sequence[int], cut: int) -> Column:
    """``P(class >= cut)``, clipped to [0, 1]."""
    first = next(i for i, c in enumerate(classes) if c >= cut)
    total = array_sum(F.slice(proba, first + 1, len(classes) - first))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))


def expected_class(proba: Column, classes: Sequence[int]) -> Column:
    return dot(proba, [float(c) for c in classes])


def share_of_total(parts: Column) -> Column:
    """Array divided by its sum."""
    return F.transform(parts, lambda p: p / array_sum(parts))


def count_below(col: Column, cuts: Sequence[float]) -> Column:
    """How many cut-points lie strictly below the value (left-sided search)."""
    return sum((F.when(col > F.lit(float(c)), 1).otherwise(0) for c in cuts), F.lit(0))


def hash_uniform(seed: int, *keys: Column) -> Column:
    """A number in (0, 1) fixed by the key values and the seed, not by partitioning."""
    mixed = F.xxhash64(F.lit(int(seed)), *keys)
    return (F.pmod(mixed, F.lit(1 << 52)).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def hash_normal(seed: int, *keys: Column) -> Column:
    """Standard normal number fixed by keys and seed (Box-Muller on two hash uniforms)."""
    u = hash_uniform(seed, F.lit("radius"), *keys)
    v = hash_uniform(seed, F.lit("angle"), *keys)
    return F.sqrt(F.lit(-2.0) * F.log(u)) * F.cos(F.lit(2.0) * F.pi() * v)
