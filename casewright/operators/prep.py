"""Fitted preprocessing: median / mode imputation, scaling, one-hot with a shared rare level.

Statistics are fitted for several training sets at once.  A training set is a
0/1 *mask* column over the same table (one per cross-validation fold), so
fifteen folds cost the passes of one and no row is ever copied per fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.operators.features import FeatureSpec
from casewright.operators.ranking import MARGIN, WINDOW_ROWS, cumulative, quantile_of
from casewright.session import small_table

# Rare levels below this count share one column; its name's suffix.
MIN_FREQUENCY = 5
RARE = "infrequent"


# Counted levels of all nominal columns that the driver takes; more are refused.
MAX_LEVELS = 100_000

# Share of the rows on either side of the middle that the median is looked for in.
BAND = 0.04
# Evenly spaced cells a batch hands on for the fences of a column.
SKETCH = 128


def medians(
    df: DataFrame,
    columns: Sequence[str],
    masks: Mapping[str, Column] | None = None,
    *,
    band: float = BAND,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Exact medians ``(column, <mask>...)`` of the non-null cells of each training set.

    Approximate quantiles fence off a band around the middle.  Cells under or
    over it all become one value and equal cells of a batch one row, so the exact
    running totals only sort the few per cent inside.  A median that falls outside its band shows as infinite;
    that column is then done again without a band, so the result is always exact.
    """
    masks = masks or {"median": F.lit(1)}
    columns = list(columns)
    fences = _fences(df, columns, band)
    schema = "column string, " + ", ".join(f"{n} double" for n in masks)
    if not fences:
        return small_table(df.sparkSession, [], schema)
    cells = max(f["_n"] for f in fences)

    def run(rows: DataFrame, distinct: float) -> list[tuple]:
        weights = {n: F.col(n) for n in masks}
        cum = cumulative(rows, "value", weights, ["_j"], window_rows=window_rows, distinct=int(distinct * MARGIN) + 2)
        found = cum.groupBy("_j").agg(
            *[quantile_of("value", n, 0.5).cast("double").alias(n) for n in masks]
        )
        return [tuple(r) for r in found.collect()]

    rows = run(_fenced(df, columns, masks, fences), cells * min(1.0, 2 * band))
    # An infinite end of the band also turns an interpolated median into NaN.
    missed = [r[0] for r in rows if any(v is not None and not np.isfinite(v) for v in r[1:])]
    if missed:
        long = _long_numbers(df, columns, {n: m.cast("bigint") for n, m in masks.items()})
        rows = [r for r in rows if r[0] not in missed] + run(long.where(F.col("_j").isin(*missed)), cells)
    return small_table(df.sparkSession, [(columns[r[0]], *r[1:]) for r in rows], schema)


def _numbers(batch: pa.RecordBatch, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the array column ``_x`` as a matrix, and which of them are there."""
    flat = batch.column("_x").flatten()
    there = np.asarray(flat.is_valid()).reshape(-1, d)
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=float).reshape(-1, d), there


def _array(df: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    return df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("_x"), *keep)


def _fences(df: DataFrame, columns: Sequence[str], band: float) -> list:
    """Approximate ``(_j, _n, _low, _high)`` around the middle of every column that has cells.

    Every batch is sorted and hands on at most ``SKETCH`` evenly spaced cells a column.
    """
    d = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, there = _numbers(batch, d)
            # NaN cells that are there count as the largest, cells that are not come after them.
            x = np.where(there, np.where(np.isnan(x), np.inf, x), np.nan)
            ordered = np.sort(np.ascontiguousarray(x.T), axis=1)
            picked = [(j, ordered[j], n, -(-int(n) // SKETCH)) for j, n in enumerate(there.sum(axis=0)) if n]
            picked = [(j, v[step // 2 : n : step], step) for j, v, n, step in picked]
            if picked:
                sizes = [len(v) for _, v, _ in picked]
                yield pa.RecordBatch.from_pydict(
                    {
                        "_j": pa.array(np.repeat([j for j, _, _ in picked], sizes), pa.int32()),
                        "value": pa.array(np.concatenate([v for _, v, _ in picked])),
                        "_n": pa.array(np.repeat([step for _, _, step in picked], sizes), pa.int64()),
                    }
                )

    spaced = _array(df, columns).mapInArrow(run, "_j int, value double, _n bigint")
    return (
        spaced.groupBy("_j")
        .agg(F.sum("_n").alias("_n"), F.percentile_approx("value", [0.5 - band, 0.5 + band], 2000).alias("_q"))
        .select("_j", "_n", F.get("_q", F.lit(0)).alias("_low"), F.get("_q", F.lit(1)).alias("_high"))
        .collect()
    )


def _fenced(df: DataFrame, columns: Sequence[str], masks: Mapping[str, Column], fences: Sequence) -> DataFrame:
    """``(_j, value, <mask>...)``: mask sums of the cells of every value inside the fences.

    Cells under a fence are summed as minus infinity and cells over it as infinity.
    """
    d, names = len(columns), list(masks)
    low, high = np.full(d, np.nan), np.full(d, np.nan)
    for f in fences:
        low[f["_j"]], high[f["_j"]] = f["_low"], f["_high"]

    def rows(j, value, sums) -> pa.RecordBatch:
        cells = [pa.array(np.asarray(j), pa.int32()), pa.array(np.asarray(value, float))]
        cells += [pa.array(np.rint(sums[:, i]).astype(np.int64)) for i in range(len(names))]
        return pa.RecordBatch.from_arrays(cells, names=["_j", "value", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside = np.zeros((2, d, len(names)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, there = _numbers(batch, d)
            weights = batch.column("_w").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names)).astype(float)
            under, over = there & (x < low), there & ((x > high) | np.isnan(x))
            outside[0] += under.T.astype(float) @ weights
            outside[1] += over.T.astype(float) @ weights
            inside = there & ~under & ~over
            j, value, sums = [], [], []
            for c in np.flatnonzero(inside.any(axis=0)):
                at = np.flatnonzero(inside[:, c])
                at = at[np.argsort(x[at, c], kind="stable")]
                v = x[at, c]
                first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
                j.append(np.full(len(first), c))
                value.append(v[first])
                sums.append(np.add.reduceat(weights[at], first, axis=0))
            if j:
                yield rows(np.concatenate(j), np.concatenate(value), np.concatenate(sums))
        ends = np.repeat([-np.inf, np.inf], d)
        yield rows(np.tile(np.arange(d), 2), ends, outside.reshape(2 * d, -1))

    weights = F.array(*[F.coalesce(m.cast("bigint"), F.lit(0).cast("bigint")) for m in masks.values()]).alias("_w")
    kinds = "_j int, value double, " + ", ".join(f"`{n}` bigint" for n in names)
    return _array(df, columns, weights).mapInArrow(run, kinds)


def _long_numbers(
    df: DataFrame, columns: Sequence[str], keep: Mapping[str, Column]
) -> DataFrame:
    """``(keep..., _j, value)``: one row per cell, the column by its position.

    An array and posexplode instead of unpivot: for tens of columns unpivot
    compiles into a method too large for the JVM to optimise.
    """
    cells = F.array(*[F.col(c).cast("double") for c in columns])
    kept = [m.alias(n) for n, m in keep.items()]
    return df.select(*kept, F.posexplode(cells).alias("_j", "value"))


def level_counts(
    df: DataFrame, columns: Sequence[str], masks: Mapping[str, Column] | None = None
) -> DataFrame:
    """``(column, level, <mask>...)`` counts, null cells as a row with a null level."""
    masks = masks or {"n": F.lit(1)}
    flagged = df.select(*[m.cast("bigint").alias(n) for n, m in masks.items()], *columns)
    long = flagged.unpivot(list(masks), list(columns), "column", "level")
    return long.groupBy("column", "level").agg(*[F.sum(n).alias(n) for n in masks])


def modes(counts: DataFrame, weight: str = "n") -> DataFrame:
    """Most frequent level per column; the smallest text wins a tie."""
    present = counts.where(F.col("level").isNotNull() & (F.col(weight) > 0))
    best = F.min(F.struct((-F.col(weight)).alias("n"), F.col("level").alias("level")))
    return present.groupBy("column").agg(best["level"].alias("mode"))


def bounded_levels(
    df: DataFrame, columns: Sequence[str], masks: Mapping[str, Column], most: int = MAX_LEVELS
) -> list:
    """Level counts on the driver, refused where there are more than ``most``.

    A one-hot design with a column a level does not fit identifiers and free
    text; at most ``most`` + 1 rows are ever fetched.
    """
    if not columns:
        return []
    counted = level_counts(df, columns, masks).limit(most + 1).collect()
    if len(counted) > most:
        raise ValueError(f"{', '.join(columns)} hold more than {most:,} levels; drop or group them")
    return counted


def _flags(masks: Mapping[str, Column]) -> list[Column]:
    """Masks as booleans, whether given as conditions or as 0 / 1."""
    return [m.cast("boolean") for m in masks.values()]


def imputed_moments(
    df: DataFrame,
    columns: Sequence[str],
    fills: Mapping[str, Mapping[str, float]],
    masks: Mapping[str, Column],
) -> DataFrame:
    """Rows ``(column, training_set, n, mean, std)`` of the median-filled columns.

    Population deviation.  One pass sums cells and their squares around a median
    per column and combination of masks (folds overlap in few combinations);
    those few rows are pooled per training set, and then with the point mass of
    the filled cells.
    """
    names = list(masks)
    bits = [F.when(m, F.lit(1 << i)).otherwise(F.lit(0)) for i, m in enumerate(_flags(masks))]
    columns = list(columns)
    d = len(columns)
    # Sums are taken around a median: it is within a deviation of the mean, so squares do not cancel.
    middle = np.array([next((float(fills[n][c]) for n in names if fills[n].get(c) is not None), 0.0) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, there = _numbers(batch, d)
            gap = np.where(there, x - middle, 0.0)
            sets = batch.column("_set").to_numpy()
            order = np.argsort(sets, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(sets[order]) != 0]))
            sizes = np.diff([*first, len(order)])
            parts = [np.add.reduceat(v[order], first, axis=0) for v in (there.astype(float), gap, gap * gap)]
            for i, at in enumerate(first):
                own = np.vstack([np.full(d, sizes[i]), *[p[i] for p in parts]])
                k = int(sets[order[at]])
                total[k] = total[k] + own if k in total else own
        sums = np.array(list(total.values())).reshape(-1, 4, d)
        yield pa.RecordBatch.from_pydict(
            {
                "_j": pa.array(np.tile(np.arange(d), len(total)), pa.int32()),
                "_set": pa.array(np.repeat(np.array(list(total), np.int64), d)),
                **{c: pa.array(np.rint(sums[:, i].ravel()).astype(np.int64)) for i, c in enumerate(("n", "k"))},
                **{c: pa.array(sums[:, i].ravel()) for i, c in ((2, "s"), (3, "q"))},
            }
        )

    cells = (
        _array(df, columns, sum(bits[1:], bits[0]).cast("bigint").alias("_set"))
        .mapInArrow(run, "_j int, _set bigint, n bigint, k bigint, s double, q double")
        .groupBy("_j", "_set")
        .agg(*[F.sum(c).alias(c) for c in ("n", "k", "s", "q")])
        .withColumn("_s", F.coalesce(F.try_divide("s", F.col("k").cast("double")), F.lit(0.0)))
        .select(
            "_set",
            "n",
            "k",
            F.when(F.col("k") > 0, F.get(F.array(*[F.lit(float(m)) for m in middle]), F.col("_j")) + F.col("_s")).otherwise(0.0).alias("mu"),
            F.greatest(F.lit(0.0), F.coalesce(F.try_divide("q", F.col("k").cast("double")), F.lit(0.0)) - F.col("_s") * F.col("_s")).alias("v"),
            F.get(F.array(*[F.lit(c) for c in columns]), F.col("_j")).alias("column"),
        )
    )
    # Means are taken around the column's own centre, so squares do not cancel.
    column = Window.partitionBy("column")  # a row per combination of masks
    centre = F.sum(F.col("k") * F.col("mu")).over(column) / F.greatest(
        F.sum("k").over(column), F.lit(1)
    )
    cells = cells.withColumn("_c", centre).withColumn("_d", F.col("mu") - F.col("_c"))
    sets = []
    for i, name in enumerate(names):
        inside = F.col("_set").bitwiseAND(F.lit(1 << i)) != 0
        n = F.sum(F.when(inside, F.col("n")).otherwise(0))
        k = F.sum(F.when(inside, F.col("k")).otherwise(0))
        shift = F.try_divide(F.sum(F.when(inside, F.col("k") * F.col("_d")).otherwise(0.0)), k)
        square = F.try_divide(
            F.sum(
                F.when(inside, F.col("k") * (F.col("v") + F.col("_d") * F.col("_d"))).otherwise(0.0)
            ),
            k,
        )
        sets.append(
            F.struct(
                F.lit(name).alias("training_set"),
                n.alias("n"),
                k.alias("k"),
                F.when(k > 0, F.max("_c") + shift).alias("mu"),
                F.when(k > 0, F.greatest(F.lit(0.0), square - shift * shift)).alias("v"),
            )
        )
    rows = cells.groupBy("column").agg(F.array(*sets).alias("sets")).select(
        "column", F.explode("sets").alias("s")
    )
    fill_rows = [
        (c, n, float(fills[n][c])) for n in masks for c in columns if fills[n].get(c) is not None
    ]
    fill_df = small_table(
        df.sparkSession, fill_rows, "column string, training_set string, fill double"
    )
    joined = rows.select("column", "s.*").join(
        F.broadcast(fill_df), ["column", "training_set"], "left"
    )
    share = F.try_divide("k", "n")
    mu, fill = F.coalesce("mu", "fill"), F.coalesce("fill", F.lit(0.0))
    return joined.select(
        "column",
        "training_set",
        "n",
        (share * mu + (1 - share) * fill).alias("mean"),
        F.sqrt(
            share * F.coalesce("v", F.lit(0.0)) + share * (1 - share) * (mu - fill) * (mu - fill)
        ).alias("std"),
    )


@dataclass(frozen=True)
class Preprocessor:
    """Fitted statistics of one training set; a few numbers per column."""

    numeric: tuple[str, ...]
    nominal: tuple[str, ...]
    fill: dict[str, float]
    mean: dict[str, float]
    scale: dict[str, float]
    mode: dict[str, str]
    levels: dict[str, tuple[str, ...]]
    rare: dict[str, tuple[str, ...]]
    scaled: bool = True

    @property
    def names(self) -> list[str]:
        out = list(self.numeric)
        for c in self.nominal:
            out += [f"{c}_{level}" for level in self.levels[c]]
            if self.rare[c]:
                out.append(f"{c}_{RARE}")
        return out

    def part(self, spec: FeatureSpec) -> Preprocessor:
        """The transform of fewer columns; statistics go by column, so they stay as they are."""
        return replace(
            self,
            numeric=tuple(c for c in spec.numeric if c in self.numeric),
            nominal=tuple(c for c in spec.nominal if c in self.nominal),
        )

    def expressions(self, source=F.col) -> list[Column]:
        """One double expression per output column, in the order of ``names``."""
        out = []
        for c in self.numeric:
            value = F.coalesce(source(c).cast("double"), F.lit(self.fill[c]))
            if self.scaled:
                value = (value - F.lit(self.mean[c])) / F.lit(self.scale[c])
            out.append(value)
        for c in self.nominal:
            text = F.coalesce(source(c), F.lit(self.mode[c]))
            out += [(text == F.lit(level)).cast("double") for level in self.levels[c]]
            if self.rare[c]:
                out.append(text.isin(*self.rare[c]).cast("double"))
        return out

    def array(self, source=F.col) -> Column:
        return F.array(*self.expressions(source))

    def select(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and the output columns; everything else is dropped."""
        made = [e.alias(n) for n, e in zip(self.names, self.expressions())]
        return df.select(*[F.col(c) for c in keep], *made)

    def matrix(self, numbers: np.ndarray, codes: np.ndarray, levels: list[list[str]]) -> np.ndarray:
        """The same transform on a block: NaN for null numbers, -1 for null level codes.

        ``levels[j]`` is the code book of nominal column j.
        """
        n = len(numbers)
        blocks = [np.empty((n, 0))]
        if self.numeric:
            fill = np.array([self.fill[c] for c in self.numeric])
            x = np.where(np.isnan(numbers), fill, numbers)
            if self.scaled:
                x = (x - [self.mean[c] for c in self.numeric]) / [
                    self.scale[c] for c in self.numeric
                ]
            blocks.append(x)
        for j, c in enumerate(self.nominal):
            book = {level: i for i, level in enumerate(levels[j])}
            code = np.where(codes[:, j] < 0, book[self.mode[c]], codes[:, j])
            blocks += [(code == book[v]).astype(float)[:, None] for v in self.levels[c]]
            if self.rare[c]:
                rare = [book[v] for v in self.rare[c]]
                blocks.append(np.isin(code, rare).astype(float)[:, None])
        return np.hstack(blocks)


def fit_preprocessors(
    df: DataFrame,
    spec: FeatureSpec,
    masks: Mapping[str, Column] | None = None,
    *,
    scaled: bool = True,
    min_frequency: int = MIN_FREQUENCY,
    max_levels: int = MAX_LEVELS,
    window_rows: int = WINDOW_ROWS,
) -> dict[str, Preprocessor]:
    """Fit one preprocessor per training set, all of them in three shared passes.

    Nominal columns with more than ``max_levels`` levels together are refused.
    """
    masks = dict(masks or {"all": F.lit(1)})
    numeric, nominal = list(spec.numeric), list(spec.nominal)
    fill: dict[str, dict[str, float]] = {n: {} for n in masks}
    mean: dict[str, dict[str, float]] = {n: {} for n in masks}
    scale: dict[str, dict[str, float]] = {n: {} for n in masks}
    if numeric:
        for row in medians(df, numeric, masks, window_rows=window_rows).collect():
            for n in masks:
                if row[n] is not None:
                    fill[n][row["column"]] = float(row[n])
        for row in imputed_moments(df, numeric, fill, masks).collect():
            n, c = row["training_set"], row["column"]
            mean[n][c] = float(row["mean"] or 0.0)
            scale[n][c] = float(row["std"] or 0.0) or 1.0
    counted = bounded_levels(df, nominal, masks, max_levels)
    fitted = {}
    for n in masks:
        # A column without any value in the training set carries no information.
        usable = tuple(c for c in numeric if c in fill[n])
        mode, levels, rare = {}, {}, {}
        for c in nominal:
            seen = {r["level"]: r[n] for r in counted if r["column"] == c and r[n]}
            empty = seen.pop(None, 0)
            if not seen:
                continue
            mode[c] = min(seen, key=lambda v: (-seen[v], v))
            seen[mode[c]] += empty
            levels[c] = tuple(sorted(v for v in seen if seen[v] >= min_frequency))
            rare[c] = tuple(sorted(v for v in seen if seen[v] < min_frequency))
        fitted[n] = Preprocessor(
            usable, tuple(mode), fill[n], mean[n], scale[n], mode, levels, rare, scaled
        )
    return fitted


def fit_preprocessor(df: DataFrame, spec: FeatureSpec, **options) -> Preprocessor:
    return fit_preprocessors(df, spec, None, **options)["all"]
