"""Seeded splits that depend on the id and the seed, not on row order or partitioning.

Rows are ordered by a seeded hash of their id.  A split needs only a few order
statistics of those hashes per class: a fold or a test set is a range of hashes
between two cuts.  ``hash_cuts`` finds the exact cuts by counting hash prefixes,
twelve more bits a pass inside the few prefixes that hold a cut; the split itself
is a projection, so no row is moved.  Rows that share an id share their fold.

``hash_rank`` is for those who need every row's rank: rows are spread over
hash-prefix buckets, each bucket is ranked on its own and starts at the total of
the buckets before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.session import small_table, staged

# Rows one ranking task should hold, and the most buckets of a class.
BUCKET_ROWS = 250_000
MAX_BUCKETS = 1 << 17

# Hash bits a pass of the cut search adds, and the rows under a prefix that are read out.
PREFIX_BITS = 12
READ_OUT = 1_000


def _bucket_count(rows: int) -> int:
    return max(1, min(MAX_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, rows) / BUCKET_ROWS)))))


def order_hash(key: str, seed: int | Column) -> Column:
    start = seed if isinstance(seed, Column) else F.lit(int(seed))
    return F.xxhash64(start.cast("int"), F.col(key))


def hash_rank(
    df: DataFrame,
    key: str,
    seed: int | Column,
    by: Sequence[str] = (),
    *,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``_rank`` (from 0, in seeded hash order inside ``by``) and ``_size``."""
    by = list(by)
    if buckets is None:
        buckets = _bucket_count(df.count())
    hashed = df.withColumn("_hash", order_hash(key, seed))
    # High bits first (sign kept), so bucket order is hash order.
    bits = int(math.log2(buckets))
    bucket = F.shiftright("_hash", 64 - bits).cast("int") if bits else F.lit(0)
    hashed = hashed.withColumn("_bucket", bucket)

    sizes = hashed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    starts = sizes.select(
        *by,
        "_bucket",
        F.coalesce(
            F.sum("_n").over(
                group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_start"),
        F.sum("_n").over(group).alias("_size"),
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy("_hash", key)
    ranked = hashed.withColumn("_within", F.row_number().over(inside) - 1)
    return (
        ranked.join(F.broadcast(starts), on=[*by, "_bucket"])
        .withColumn("_rank", F.col("_within") + F.col("_start"))
        .drop("_hash", "_bucket", "_within", "_start")
    )


def hash_cuts(
    df: DataFrame,
    key: str,
    seeds: Sequence[int],
    targets: Callable[[int], Sequence[int]],
    label: str | None = None,
    *,
    read_out: int = READ_OUT,
) -> tuple[dict, dict]:
    """Exact order statistics of the seeded hashes inside each class.

    ``targets(size)`` are the wanted ranks (from 0) in a class of that size.
    Returns the class sizes and ``{(class, i): [(hash, key) or None]}`` for the
    i-th seed: the row at each rank, None where the class has no such rank.
    The driver receives one row per class, seed and rank and pass, and at most
    ``read_out`` rows for each in the end, whatever the size of the table.
    """
    rows = df.select(
        (F.col(label) if label else F.lit(0)).alias("_y"),
        F.col(key).alias("_k"),
        F.posexplode(F.array(*[order_hash(key, s) for s in seeds])).alias("_r", "_h"),
    ).where(F.col("_y").isNotNull())
    kinds = dict(rows.dtypes)
    place = f"_y {kinds['_y']}, _r int, _p bigint"
    spark = df.sparkSession
    # Open cuts: (class, seed number, prefix) -> [(position, rank under the prefix)].
    open_cuts: dict[tuple, list[tuple[int, int]]] = {}
    cuts: dict[tuple, list] = {}
    bits = 0

    def narrowed(frame: DataFrame, prefixes) -> DataFrame:
        chosen = small_table(spark, list(prefixes), place)
        return frame.join(F.broadcast(chosen), ["_y", "_r", "_p"])

    def prefix(width: int) -> Column:
        return F.shiftright("_h", 64 - width) if width else F.lit(0).cast("bigint")

    while bits == 0 or open_cuts:
        step = min(PREFIX_BITS, 64 - bits)
        inside = rows.withColumn("_p", prefix(bits))
        if bits:
            inside = narrowed(inside, open_cuts)
        counts = inside.groupBy("_y", "_r", "_p", prefix(bits + step).alias("_q")).agg(
            F.count(F.lit(1)).alias("n")
        )
        # At most 2 ** PREFIX_BITS rows in each window.
        order = Window.partitionBy("_y", "_r", "_p").orderBy("_q")
        running = counts.withColumn("upto", F.sum("n").over(order))
        if bits == 0:
            running = staged(running)  # at most 2 ** PREFIX_BITS rows per class and seed
            sizes = dict(running.where("_r = 0").groupBy("_y").agg(F.sum("n")).collect())
            for y, total in sizes.items():
                wanted = list(targets(total))
                for r in range(len(seeds)):
                    cuts[y, r] = [None] * len(wanted)
                    found = [(i, t) for i, t in enumerate(wanted) if 0 <= t < total]
                    if found:
                        open_cuts[y, r, 0] = found
            if not open_cuts:
                return sizes, cuts
        wanted = [(y, r, p, i, t) for (y, r, p), found in open_cuts.items() for i, t in found]
        ask = small_table(spark, wanted, f"{place}, _i int, _t bigint")
        hits = (
            running.join(F.broadcast(ask), ["_y", "_r", "_p"])
            .where((F.col("upto") > F.col("_t")) & (F.col("upto") - F.col("n") <= F.col("_t")))
            .select("_y", "_r", "_q", "_i", (F.col("_t") - F.col("upto") + F.col("n")).alias("_t"), "n")
            .collect()
        )
        bits += step
        open_cuts, few = {}, {}
        for h in hits:
            held = few if h["n"] <= read_out or bits == 64 else open_cuts
            held.setdefault((h["_y"], h["_r"], h["_q"]), []).append((h["_i"], h["_t"]))
        if few:
            read = narrowed(rows.withColumn("_p", prefix(bits)), few)
            read = read.groupBy("_y", "_r", "_p", "_h", "_k").agg(F.count(F.lit(1)).alias("n")).collect()
            under: dict[tuple, list] = {}
            for x in read:
                under.setdefault((x["_y"], x["_r"], x["_p"]), []).append((x["_h"], x["_k"], x["n"]))
            for (y, r, p), asked in few.items():
                held = sorted(under[y, r, p], key=lambda x: (x[0], x[1] is not None, x[1] if x[1] is not None else 0))
                for i, t in asked:
                    for h, k, n in held:
                        if t < n:
                            cuts[y, r][i] = (h, k)
                            break
                        t -= n
    return sizes, cuts


def _with_parts(
    df: DataFrame, key: str, seeds: Sequence[int], names: Sequence[str], targets, label: str | None
) -> DataFrame:
    """Add, per seed, the number of cuts at or below the row (null without a class)."""
    sizes, cuts = hash_cuts(df, key, seeds, targets, label)
    if label is None:
        return df.withColumns(
            {
                n: sum((_reached(key, s, *_literal(df, key, c)) for c in cuts.get((0, r), ())), F.lit(0))
                for r, (s, n) in enumerate(zip(seeds, names))
            }
        )
    width = max((len(c) for c in cuts.values()), default=0)
    at = [(r, i) for r in range(len(seeds)) for i in range(width)]
    rows = [
        (y, *[v for r, i in at for v in (cuts[y, r][i] or (None, None))]) for y in sizes
    ]
    kinds = dict(df.dtypes)
    fields = "".join(f", _h{r}_{i} bigint, _k{r}_{i} {kinds[key]}" for r, i in at)
    # A row per class.
    table = small_table(df.sparkSession, rows, f"_y {kinds[label]}{fields}")
    joined = df.join(F.broadcast(table), F.col(label) == F.col("_y"), "left")

    def part(r: int) -> Column:
        reached = [_reached(key, seeds[r], F.col(f"_h{r}_{i}"), F.col(f"_k{r}_{i}")) for i in range(width)]
        return F.when(F.col("_y").isNotNull(), sum(reached, F.lit(0)))

    return joined.withColumns({n: part(r) for r, n in enumerate(names)}).drop(*table.columns)


def _literal(df: DataFrame, key: str, cut) -> tuple[Column, Column]:
    h, k = cut or (None, None)
    return F.lit(h).cast("bigint"), F.lit(k).cast(dict(df.dtypes)[key])


def _reached(key: str, seed: int, h: Column, k: Column) -> Column:
    """1 where the row is at or after the cut (hash, key); 0 where there is no cut."""
    mine = order_hash(key, seed)
    tie = (mine == h) & (k.isNull() | F.coalesce(F.col(key) >= k, F.lit(False)))
    return F.coalesce((mine > h) | tie, F.lit(False)).cast("int")


def _fold_starts(k: int) -> Callable[[int], list[int]]:
    """Ranks at which parts 1 .. k - 1 start: near-equal parts, the first ones longer."""
    return lambda size: [j * (size // k) + min(j, size % k) for j in range(1, k)]


def stratified_holdout(
    df: DataFrame, key: str, label: str, *, share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: the rounded share of every class, the first in seeded hash order.

    Rows without a class stay, with a null ``is_test``.
    """
    # Half to even, as Python rounds.
    marked = _with_parts(df, key, [seed], ["is_test"], lambda size: [round(size * float(share))], label)
    return marked.withColumn("is_test", F.col("is_test") == 0)


def stratified_folds(
    df: DataFrame, key: str, label: str, *, k: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Add a fold number 0..k-1 with near-equal class counts in every fold.

    Classes start dealing at shifted folds, so leftovers do not pile up in fold 0.
    Rows without a class stay, with a null fold.
    """
    return _stratified(df, key, label, k, [seed], [name])


def repeated_stratified_folds(
    df: DataFrame, key: str, label: str, *, k: int = 5, repeats: int = 3, seed: int = 42
) -> DataFrame:
    """Add ``fold_0 .. fold_{repeats-1}``, one independent assignment per repeat.

    Rows without a class stay, with null folds.  All repeats share the passes.
    """
    seeds = [int(seed) + r for r in range(repeats)]
    return _stratified(df, key, label, k, seeds, [f"fold_{r}" for r in range(repeats)])


def _stratified(
    df: DataFrame, key: str, label: str, k: int, seeds: Sequence[int], names: Sequence[str]
) -> DataFrame:
    parts = _with_parts(df, key, seeds, names, _fold_starts(k), label)
    shift = F.col(label).cast("bigint")
    return parts.withColumns({n: F.pmod(F.col(n) + shift, F.lit(k)).cast("int") for n in names})


def plain_folds(
    df: DataFrame, key: str, *, k: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Add an unstratified fold of near-equal size, ranges of the hash order."""
    return _with_parts(df, key, [seed], [name], _fold_starts(k), None)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the first in seeded hash order (a top-n, no full sort)."""
    return df.orderBy(order_hash(key, seed), F.col(key)).limit(n)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes x rows of the class), one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy(F.lit(0))  # over one row per class
    share = F.sum("n").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("n"))
    return counts.select(label, "n", share.cast("double").alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.join(F.broadcast(weights), label)
