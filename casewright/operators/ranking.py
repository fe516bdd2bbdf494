"""Running totals, ranks and exact quantiles in sorted order without a global sort.

An un-partitioned window moves every row to one task.  Here rows are first
summed per distinct value, so equal values (however many) become one row, and
sorted runs are cut into buckets:

1. one narrow pass estimates the number of distinct values per group, which
   sets the number of buckets (a power of ``FANOUT``, from 1 up);
2. bucket edges come from approximate quantiles.  The edges only balance the
   work; results are exact for any edges, and for any number of them;
3. bucket totals (at most ``MAX_BUCKETS`` per group) give each bucket its
   starting offset, and a window inside each bucket does the rest.

``by`` columns must have few combinations (columns, classes, folds).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.session import small_table

# Distinct values one window task may hold.
WINDOW_ROWS = 500_000
FANOUT = 32
MAX_BUCKETS = FANOUT**3


# Distinct counts are estimated within a few per cent; the bound adds a margin.
MARGIN = 1.3


def distinct_bound(df: DataFrame, by: Sequence[str], value: str) -> int:
    """Upper estimate of the distinct values in the largest group (HyperLogLog)."""
    per_group = df.groupBy(*by).agg(F.approx_count_distinct(value).alias("d"))
    top = per_group.agg(F.max("d")).first()[0]
    return int(math.ceil((top or 0) * MARGIN))


def _edges(df: DataFrame, by: Sequence[str], value: str, levels: int) -> DataFrame:
    """One row per group: sorted edges of near-equal buckets, fixed on the driver.

    Both branches of the prefix sum must see the same edges, so they are
    collected once (groups x buckets numbers) and not left in the plan.  They
    are laid out by level: ``_e0`` splits the range into FANOUT parts, entry i
    of ``_e1`` splits part i, and so on.
    """
    buckets = FANOUT**levels
    cuts = [i / buckets for i in range(1, buckets)]
    found = df.groupBy(*by).agg(F.percentile_approx(value, cuts, 10 * buckets).alias("_cuts"))
    rows = []
    for row in found.collect():
        flat = row["_cuts"]
        layers = []
        for level in range(levels):
            step = FANOUT ** (levels - level - 1)
            layers.append(
                [
                    [flat[(part * FANOUT + i) * step - 1] for i in range(1, FANOUT)]
                    for part in range(FANOUT**level)
                ]
            )
        rows.append((*[row[c] for c in by], *layers))
    element = found.schema["_cuts"].dataType.elementType.simpleString()
    kinds = dict(df.dtypes)
    fields = [f"`{c}` {kinds[c]}" for c in by]
    fields += [f"_e{level} array<array<{element}>>" for level in range(levels)]
    return small_table(df.sparkSession, rows, ", ".join(fields))


def _bucket(value: Column, levels: int) -> Column:
    """Edges at or below the value, found level by level with FANOUT comparisons each."""
    position = F.lit(0)
    for level in range(levels):
        edges = F.get(F.col(f"_e{level}"), position)
        position = position * F.lit(FANOUT) + F.size(F.filter(edges, lambda e: e <= value))
    return position


def cumulative(
    df: DataFrame,
    value: str,
    weights: Mapping[str, Column],
    by: Sequence[str] = (),
    *,
    window_rows: int = WINDOW_ROWS,
    distinct: int | None = None,
) -> DataFrame:
    """Per distinct value: the weights, their running total before it, and group totals.

    Output columns: ``by``, ``value``, and for each weight ``w``: ``w``,
    ``w_before`` (strictly smaller values) and ``w_total``.  Null values are
    left out.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(
        *by, value, *[w.alias(name) for name, w in weights.items()]
    )
    names = list(weights)
    counts = rows.groupBy(*by, value).agg(*[F.sum(n).alias(n) for n in names])
    bound = distinct if distinct is not None else distinct_bound(rows, by, value)
    levels = 0
    while FANOUT**levels < min(MAX_BUCKETS, math.ceil(bound / window_rows)):
        levels += 1
    layers = [f"_e{level}" for level in range(levels)]
    edges = _edges(rows, by, value, levels) if levels else None
    if not levels:
        keyed = counts
    elif by:
        # One row per group, each with a bounded number of edges.
        keyed = counts.join(F.broadcast(edges), on=by)
    else:
        fixed = edges.first()
        keyed = counts.withColumns({e: F.lit(fixed[e]) for e in layers})
    placed = keyed.select(*by, value, *names, _bucket(F.col(value), levels).alias("_bucket"))
    # At most MAX_BUCKETS rows per group, whatever the size of the table.
    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}_start") for n in names],
        *[F.sum(n).over(Window.partitionBy(*by)).alias(f"{n}_total") for n in names],
    )
    inside = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.join(F.broadcast(offsets), on=[*by, "_bucket"]).select(
        *by,
        value,
        *names,
        *[
            (F.coalesce(F.sum(n).over(inside), F.lit(0)) + F.col(f"_{n}_start")).alias(
                f"{n}_before"
            )
            for n in names
        ],
        *[f"{n}_total" for n in names],
    )


def quantile_of(value: str, weight: str, q: float) -> Column:
    """Aggregate over a cumulative table: linear-interpolated quantile of one weight."""
    n, before = F.col(weight), F.col(f"{weight}_before")
    spot = F.lit(float(q)) * (F.col(f"{weight}_total") - 1)
    low, high = F.floor(spot), F.ceil(spot)

    def at(rank: Column) -> Column:
        return F.max(F.when((before <= rank) & (rank < before + n), F.col(value)))

    fraction = F.max(spot - low)
    return at(low) + (at(high) - at(low)) * fraction


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    *,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, one output row per group.

    Read off the running totals: the built-in ``percentile`` would gather all
    distinct values of a group in one task.
    """
    by = list(by)
    cum = cumulative(df, value, {"n": F.lit(1)}, by, window_rows=window_rows)
    return cum.groupBy(*by).agg(
        *[quantile_of(value, "n", q).cast("double").alias(n) for n, q in probs.items()]
    )


def quantile_bins(
    df: DataFrame,
    columns: Sequence[str],
    bins: int,
    keep: Sequence[str],
    *,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Long table ``(keep..., column, bin)``: equal-share bins from exact quantile edges.

    The bin is the number of inner edges strictly below the value, so equal
    values always share a bin.  Rows with a null value get a null bin.
    """
    long = df.unpivot(list(keep), list(columns), "column", "value")
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(long, "value", probs, ["column"], window_rows=window_rows)
    # One row per column: bounded by the catalogue, so the broadcast is too.
    joined = long.join(F.broadcast(edges), "column", "left")
    bin_of = sum((F.when(F.col("value") > F.col(q), 1).otherwise(0) for q in probs), F.lit(0))
    return joined.select(
        *keep, "column", "value", F.when(F.col("value").isNotNull(), bin_of).alias("bin")
    )
