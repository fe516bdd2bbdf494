"""Helpers the operators of this subpackage share: words, hashes, staging, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.session import staged

U = np.uint64
_P1, _P2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
LOWER_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_TO = LOWER_FROM.lower()
# Rows a side may have to be broadcast; beyond it Spark shuffles both sides.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, LOWER_FROM, LOWER_TO)


def word_count(c: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a string column, 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an unsigned array."""
    x = x ^ (x >> U(30))
    x = x * _P1
    x = x ^ (x >> U(27))
    x = x * _P2
    return x ^ (x >> U(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; ``bytes.split()`` splits at the six ASCII blanks."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words (empty where there are fewer).

    Runs of 1, 2, 4, ... words are hashed from two halves and put together.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, width, out, done = h, 1, None, 0
    while True:
        if k & width:
            part = power[done : done + n]
            out = part.copy() if out is None else mix(out + U(width)) + part
            done += width
        if done == k:
            return mix(out)
        power = mix(power[: len(power) - width] + U(0x632BE59BD9B4E019)) + power[width:]
        width *= 2


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with one function per batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (staged) marked for broadcast where it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _contract(batches):
    """Union-find over one batch of edges: ``(v, m)`` with m the smallest id reached."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x):
            root = x
            while parent[root] != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        rows = [(v, find(v)) for v in parent]
        rows = [r for r in rows if r[0] != r[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
            ["v", "m"],
        )


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every vertex but the smallest of its component.

    ``edges`` has two bigint columns. Batches are contracted by union-find
    where they lie, then large-star and small-star rounds run to the fixed
    point: each round is two aggregates and two equi-joins, staged at its end.
    Hubs are pre-aggregated, but their rows meet in one task of a join, which
    AQE does not split below an aggregate; nothing is collected.
    """
    a, b = edges.columns
    start = edges.where(F.col(a) != F.col(b)).select(a, b)
    now = staged(start.mapInArrow(_contract, "v bigint, m bigint").distinct())
    while True:
        roots = now.select(F.col("m").alias("v")).distinct()
        open_ = now.groupBy("v").agg(F.count("*").alias("n")).join(
            roots.withColumn("is_root", F.lit(True)), "v", "left"
        )
        if not open_.where((F.col("n") > 1) | F.col("is_root")).limit(1).count():
            return now.select(F.col("v").alias("id"), F.col("m").alias("component"))
        both = now.unionAll(now.select(F.col("m"), F.col("v")))
        low = both.groupBy("v").agg(F.min("m").alias("low"))
        large = (
            both.join(low, "v")
            .where(F.col("m") > F.col("v"))
            .select(F.col("m").alias("v"), F.least("v", "low").alias("m"))
        ).distinct()
        large = staged(large)
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        joined = large.join(low, "v")
        small = joined.where(F.col("m") != F.col("low")).select(F.col("m").alias("v"), F.col("low").alias("m"))
        now = staged(small.unionAll(low.select("v", F.col("low").alias("m"))).distinct())
