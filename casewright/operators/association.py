"""Association statistics from contingency counts, ranks and cross-products.

Every statistic is computed from pre-aggregated tables whose size depends on the
number of columns and levels, not of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.tails import chi_square_p, kolmogorov_p
from casewright.operators.profile import MISSING_LABEL, long_levels, long_numbers
from casewright.operators.ranking import WINDOW_ROWS, cumulative, quantile_bins
from casewright.session import small_table, staged


def chi_square(counts: DataFrame, row: str, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Chi-square of independence from long counts ``(by..., row, column, n)``.

    Uses sum(O^2 / E) = n * sum(O^2 / (row total * column total)), so empty
    cells need no rows.  Yates' correction applies to 2 x 2 tables, whose four
    corrected terms all share |O - E|.
    """
    by = list(by)
    rows = Window.partitionBy(*by, row)
    cols = Window.partitionBy(*by, column)
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    margins = counts.select(
        *by,
        row,
        column,
        F.col("n").cast("double").alias("o"),
        F.sum("n").over(rows).cast("double").alias("r"),
        F.sum("n").over(cols).cast("double").alias("c"),
        F.sum("n").over(whole).cast("double").alias("t"),
    )
    expected = F.col("r") * F.col("c") / F.col("t")
    deviation = F.abs(F.col("o") - expected)
    table = margins.groupBy(*by).agg(
        F.max("t").cast("bigint").alias("n"),
        F.count_distinct(row).alias("n_rows"),
        F.count_distinct(column).alias("n_columns"),
        F.sum(F.col("o") * F.col("o") / (F.col("r") * F.col("c"))).alias("_ratio"),
        F.max(deviation).alias("_dev"),
        # 1/E over the four cells of a 2 x 2 table is t^3 / (r1 r2 c1 c2).
        F.max(F.col("r") * (F.col("t") - F.col("r"))).alias("_rr"),
        F.max(F.col("c") * (F.col("t") - F.col("c"))).alias("_cc"),
    )
    dof = (F.col("n_rows") - 1) * (F.col("n_columns") - 1)
    plain = F.col("n") * (F.col("_ratio") - 1)
    shrunk = F.greatest(F.lit(0.0), F.col("_dev") - F.least(F.lit(0.5), F.col("_dev")))
    two_by_two = (F.col("n_rows") == 2) & (F.col("n_columns") == 2)
    yates = shrunk * shrunk * F.pow(F.col("n"), F.lit(3.0)) / (F.col("_rr") * F.col("_cc"))
    statistic = F.when(two_by_two, yates).otherwise(F.greatest(F.lit(0.0), plain))
    return table.select(
        *by, "n", "n_rows", "n_columns", dof.cast("int").alias("dof"), statistic.alias("chi2")
    )


def with_p(table: DataFrame) -> DataFrame:
    return table.withColumn("p_value", chi_square_p(F.col("chi2"), F.col("dof")))


def missing_vs_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Does being missing depend on the class?  Chi-square per column, with its p-value."""
    flags = df.select(
        F.col(target).alias("_y"),
        *[F.col(c).isNull().cast("string").alias(c) for c in columns],
    )
    counts = (
        flags.unpivot(["_y"], list(columns), "column", "level")
        .groupBy("column", "level", "_y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_p(chi_square(counts, "level", "_y", ["column"]))


def cramers_v(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Uncorrected Cramer's V per column; missing is a level; constant columns are skipped."""
    counts = (
        long_levels(df, columns, [target])
        .groupBy("column", F.coalesce("level", F.lit(MISSING_LABEL)).alias("level"), target)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stats = chi_square(counts, "level", target, ["column"])
    smaller = F.least("n_rows", "n_columns") - 1
    return with_p(
        stats.where(smaller > 0).withColumn(
            "cramers_v", F.sqrt(F.col("chi2") / (F.col("n") * smaller))
        )
    )


def spearman(
    df: DataFrame, pairs: Sequence[tuple[str, str]], *, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Rank correlation per pair, over the rows where both are present.

    Average ranks come from running totals over distinct values, so a value
    shared by a third of all rows is one entry.  Each joint value pair is one
    weighted row, and the two rank tables are joined on (pair, value).
    """
    entries = [
        F.struct(
            F.lit(f"{a}|{b}").alias("pair"),
            F.col(a).cast("double").alias("a"),
            F.col(b).cast("double").alias("b"),
        )
        for a, b in pairs
    ]
    joint = (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .select("e.*")
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .groupBy("pair", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joint = staged(joint)  # read by both rank tables and by the final join

    def ranks(side: str) -> DataFrame:
        cum = cumulative(joint, side, {"w": F.col("n")}, ["pair"], window_rows=window_rows)
        # Ranks are taken around their mean, (n + 1) / 2.
        rank = F.col("w_before") + (F.col("w") + 1) / F.lit(2.0)
        return cum.select(
            "pair", side, (rank - (F.col("w_total") + 1) / F.lit(2.0)).alias(f"r_{side}")
        )

    both = joint.join(ranks("a"), ["pair", "a"]).join(ranks("b"), ["pair", "b"])
    x, y, w = F.col("r_a"), F.col("r_b"), F.col("n")
    sums = both.groupBy("pair").agg(
        F.sum("n").alias("n"),
        F.sum(w * x * y).alias("xy"),
        F.sum(w * x * x).alias("xx"),
        F.sum(w * y * y).alias("yy"),
    )
    return sums.select(
        F.substring_index("pair", "|", 1).alias("a"),
        F.substring_index("pair", "|", -1).alias("b"),
        "n",
        F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))
        .alias("spearman"),
    )


# A value held by this share of a column's rows or more is looked up in the Arrow block; a column
# has at most 1 / HEAVY_SHARE such values.  All other values are joined.
HEAVY_SHARE = 1e-3
# Ranks one block may hold at a time.
BLOCK_CELLS = 4_000_000
# Joined ranks a task puts beside their rows.
TASK_CELLS = 500_000


def spearman_matrix(
    df: DataFrame,
    columns: Sequence[str],
    *,
    window_rows: int = WINDOW_ROWS,
    heavy_share: float = HEAVY_SHARE,
    task_cells: int = TASK_CELLS,
) -> DataFrame:
    """Rank correlation of all pairs: ``(a, b, n, spearman)``, ``a`` before ``b`` as listed.

    A pair counts the rows where both are present; NaN is missing.  ``spearman``
    is null where either column is constant over those rows or there are none.

    Each column is ranked once.  Its running totals carry a weight per null
    pattern (all rows, and the rows where each nullable column is present), so
    the rank of a value among the rows of any pair is read off the same table.
    Rows are not copied per pair: ranks are put beside the row and their
    cross-products summed in Arrow blocks, one small matrix a task.
    """
    columns = list(columns)
    d = len(columns)
    spark = df.sparkSession
    cells = [
        F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_c{i}")
        for i, c in enumerate(columns)
    ]
    rows = staged(df.select(F.monotonically_increasing_id().alias("_id"), *cells))
    missing = rows.agg(*[F.count_if(F.col(f"_c{i}").isNull()).alias(f"_c{i}") for i in range(d)]).first()
    nullable = [i for i in range(d) if missing[i]]
    pattern = [nullable.index(i) + 1 if i in nullable else 0 for i in range(d)]
    p = len(nullable) + 1

    def long(of: Sequence[int], *keep: str) -> DataFrame:
        entries = [F.struct(F.lit(i).alias("column"), F.col(f"_c{i}").alias("value")) for i in of]
        present = [F.col(f"_c{i}").isNotNull().cast("int").alias(f"_w{q + 1}") for q, i in enumerate(nullable)]
        exploded = rows.select(*keep, *present, F.explode(F.array(*entries)).alias("e"))
        return exploded.select(*keep, *[f"_w{q}" for q in range(1, p)], "e.*").where("value is not null")

    weights = {"w0": F.lit(1)} | {f"w{q}": F.col(f"_w{q}") for q in range(1, p)}
    cum = cumulative(long(range(d)), "value", weights, ["column"], window_rows=window_rows)
    # Ranks are taken around their mean, so that absent cells count as zero.
    centred = [F.col(f"w{q}_before") + (F.col(f"w{q}") - F.col(f"w{q}_total")) / F.lit(2.0) for q in range(p)]
    table = staged(
        cum.select(
            "column", "value", (F.col("w0") >= heavy_share * F.col("w0_total")).alias("_heavy"),
            F.array(*centred).alias("ranks"), F.array(*[F.col(f"w{q}_total") for q in range(p)]).alias("_n"),
        )
    )
    shapes = table.groupBy("column").agg(F.max("_n").alias("n"), F.count_if(~F.col("_heavy")).alias("light"))
    counts, light_columns = np.zeros((d, p), dtype=np.int64), []
    for row in shapes.collect():  # a row a column
        counts[row["column"]] = row["n"]
        if row["light"]:
            light_columns.append(row["column"])
    heavy: list[tuple] = [((), np.zeros((0, p)))] * d
    found: dict[int, list] = {}
    for row in table.where("_heavy").collect():  # at most d / heavy_share rows
        found.setdefault(row["column"], []).append((row["value"], row["ranks"]))
    for i, entries in found.items():
        entries.sort()
        heavy[i] = (np.array([e[0] for e in entries]), np.array([e[1] for e in entries]))

    # Ranks are put beside their rows in tasks of bounded size, however many rows there are.
    tasks = -(-int(sum(counts[i, 0] for i in light_columns)) // task_cells)

    def by_row(part: DataFrame) -> DataFrame:
        few = tasks <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        return part if few else part.repartition(tasks, "_id")

    wide = rows.withColumn("_light", F.lit(None).cast("array<struct<column:int,ranks:array<double>>>"))
    if light_columns:
        keys = F.broadcast(table.where("_heavy").select("column", "value"))
        joined = (
            long(sorted(light_columns), "_id").select("_id", "column", "value")
            .join(keys, ["column", "value"], "left_anti")
            .join(table.where(~F.col("_heavy")).select("column", "value", "ranks"), ["column", "value"])
        )
        entries = F.collect_list(F.struct("column", "ranks")).alias("_light")  # at most d entries
        own = by_row(joined).groupBy("_id").agg(entries)
        wide = by_row(rows).join(own, "_id", "left")

    step = max(1, BLOCK_CELLS // (d * p))

    def products(batches):
        cross, squares = np.zeros((d, d)), np.zeros((d, p))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ranks = np.zeros((batch.num_rows, d, p))
                there = np.zeros((batch.num_rows, d), dtype=bool)
                for i in range(d):
                    x = batch.column(f"_c{i}").to_numpy(zero_copy_only=False)
                    there[:, i] = ~np.isnan(x)
                    values, known = heavy[i]
                    if len(values):
                        at = np.minimum(np.searchsorted(values, x), len(values) - 1)
                        hit = values[at] == x
                        ranks[hit, i] = known[at[hit]]
                lists = batch.column("_light")
                inner = lists.flatten()
                if len(inner):
                    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                    flat = inner.field("ranks").flatten().to_numpy(zero_copy_only=False)
                    ranks[np.repeat(np.arange(len(sizes)), sizes), inner.field("column").to_numpy()] = flat.reshape(-1, p)
                for q in range(1, p):
                    ranks[~there[:, nullable[q - 1]], :, q] = 0.0
                squares += np.einsum("bip,bip->ip", ranks, ranks)
                for q in range(p):
                    mine = [i for i in range(d) if pattern[i] == q]
                    for r in range(q, p):
                        other = [i for i in range(d) if pattern[i] == r]
                        if mine and other:
                            cross[np.ix_(mine, other)] += ranks[:, mine, r].T @ ranks[:, other, q]
        at = np.arange(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, d)), pa.array(np.tile(at, d)), pa.array(cross.ravel()),
             pa.array(squares[:, pattern].ravel())],
            ["i", "j", "xy", "xx"],
        )

    parts = wide.drop("_id").mapInArrow(products, "i bigint, j bigint, xy double, xx double")
    cross, squares = np.zeros((d, d)), np.zeros((d, d))
    for row in parts.groupBy("i", "j").agg(F.sum("xy").alias("xy"), F.sum("xx").alias("xx")).collect():  # d x d
        cross[row["i"], row["j"]], squares[row["i"], row["j"]] = row["xy"], row["xx"]
    result = []
    for i in range(d):
        for j in range(i + 1, d):
            xy = cross[i, j] if pattern[i] <= pattern[j] else cross[j, i]
            size = float(squares[i, j] * squares[j, i])
            result.append((columns[i], columns[j], int(counts[i, pattern[j]]), float(xy) / size**0.5 if size > 0 else None))
    return small_table(spark, result, "a string, b string, n bigint, spearman double")


def variance_inflation(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """VIF of median-filled columns, without an intercept: ``G_ii * inverse(G)_ii``.

    One pass returns the matrix of cross-products per block of rows, which Spark
    sums; only the d x d matrix reaches the driver.  Constant columns are left
    out.  Columns are scaled by their root mean square first, which leaves the
    result unchanged and the matrix well conditioned.
    """
    columns = list(fills)
    filled = df.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(float(fills[c]))).alias(c) for c in columns]
    )
    d = len(columns)

    def products(batches):
        total, low, high = np.zeros((d, d)), np.full(d, np.inf), np.full(d, -np.inf)
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if len(x):
                total += x.T @ x
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        at = np.arange(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (np.repeat(at, d), np.tile(at, d), total.ravel(), np.repeat(low, d), np.repeat(high, d))],
            ["i", "j", "g", "low", "high"],
        )

    parts = filled.mapInArrow(products, "i bigint, j bigint, g double, low double, high double")
    sums = parts.groupBy("i", "j").agg(
        F.sum("g").alias("g"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    gram, varies = np.zeros((d, d)), np.zeros(d, bool)
    for row in sums.collect():  # d x d rows
        gram[row["i"], row["j"]] = row["g"]
        varies[row["i"]] = row["high"] > row["low"]
    kept = np.flatnonzero(varies)
    gram = gram[np.ix_(kept, kept)]
    size = np.sqrt(np.diag(gram))
    vif = np.diag(np.linalg.pinv(gram / np.outer(size, size)))
    rows = [(columns[i], float(v)) for i, v in zip(kept, vif)]
    return small_table(df.sparkSession, rows, "column string, vif double")


def mutual_information(
    df: DataFrame,
    numeric: Sequence[str],
    nominal: Sequence[str],
    target: str,
    *,
    bins: int = 10,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Plug-in mutual information (nats) with the class; numbers in quantile bins.

    Missing cells form a bin of their own.
    """
    parts = []
    if numeric:
        binned = quantile_bins(
            df.select(target, *[F.col(c).cast("double").alias(c) for c in numeric]),
            numeric,
            bins,
            [target],
            window_rows=window_rows,
        )
        parts.append(binned.select(target, "column", F.col("bin").cast("string").alias("level")))
    if nominal:
        parts.append(long_levels(df, nominal, [target]).select(target, "column", "level"))
    long = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    joint = long.groupBy(
        "column", F.coalesce("level", F.lit(MISSING_LABEL)).alias("level"), target
    ).agg(F.count(F.lit(1)).cast("double").alias("o"))
    sized = joint.select(
        "column",
        "o",
        F.sum("o").over(Window.partitionBy("column", "level")).alias("r"),
        F.sum("o").over(Window.partitionBy("column", target)).alias("c"),
        F.sum("o").over(Window.partitionBy("column")).alias("t"),
    )
    o, r, c, t = (F.col(x) for x in "orct")
    return sized.groupBy("column").agg(F.sum(o / t * F.log(o * t / (r * c))).alias("mi"))


# --- Two datasets ------------------------------------------------------------------------


def kolmogorov_smirnov(
    train: DataFrame, other: DataFrame, columns: Sequence[str], *, window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """Largest distance between the two distribution curves of each column, with p-value."""
    both = (
        long_numbers(train, columns)
        .withColumn("_first", F.lit(True))
        .unionByName(long_numbers(other, columns).withColumn("_first", F.lit(False)))
    )
    weights = {"a": F.col("_first").cast("bigint"), "b": (~F.col("_first")).cast("bigint")}
    cum = cumulative(both, "value", weights, ["column"], window_rows=window_rows)
    curve_a = (F.col("a_before") + F.col("a")) / F.col("a_total")
    curve_b = (F.col("b_before") + F.col("b")) / F.col("b_total")
    stats = cum.where((F.col("a_total") > 0) & (F.col("b_total") > 0)).groupBy("column").agg(
        F.max(F.abs(curve_a - curve_b)).alias("statistic"),
        F.max("a_total").alias("n_a"),
        F.max("b_total").alias("n_b"),
    )
    return stats.withColumn("p_value", kolmogorov_p(F.col("statistic"), F.col("n_a"), F.col("n_b")))


def chi_square_shift(train: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chi-square of level counts between two datasets, over all levels of either."""
    both = (
        long_levels(train, columns)
        .withColumn("_set", F.lit("a"))
        .unionByName(long_levels(other, columns).withColumn("_set", F.lit("b")))
    )
    counts = (
        both.where(F.col("level").isNotNull())
        .groupBy("column", "level", "_set")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_p(chi_square(counts, "_set", "level", ["column"]))


def shift_table(ks: DataFrame, chi: DataFrame) -> DataFrame:
    """Both tests in one table, most significant first."""
    a = ks.select("column", F.lit("KS").alias("test"), "statistic", "p_value")
    b = chi.select("column", F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"), "p_value")
    return a.unionByName(b).orderBy("p_value", "column")
