"""N-gram Jaccard join by parity sketches (operator 1).

Documents are sets of word shingles. Every shingle flips one bit of a parity
sketch, so the Hamming distance of two sketches never exceeds the symmetric
difference of the sets. For Jaccard >= t two sets of size a >= b >= t*a differ in
at most (1-t)/(1+t)*(a+b) shingles. Per size band that bound D is a number, and:

1. the shingle space is cut into slightly more than D+1 segments; a segment's
   parity word (a bit per shingle, kept as the XOR of the shingles' codes) is
   equal in both sets unless one of the at most D differing shingles fell in it.
   Of the occupied segments in fixed order, the first equal one is among the
   first D+1 of either set, so D+1 keys a document find every link. Sets that
   occupy no more than D segments also send their empty ones;
2. keys are aggregated first, and only keys met twice are joined back;
3. each document is tried against the smallest of its key's documents: dense
   sketches first, then the sets. Documents linked so far form components;
4. only keys whose documents are still in several components go on: pairs
   across components, within blocks of bounded size, by dense sketch, then set.

Equal sets are one vertex throughout: a 64-bit fingerprint of the set and its size
stands for it, ids come in at the end. Shingles are 64-bit hashes. Components are
built, not all links: a pair inside a component formed by other links is not
compared, as a group of n near copies has n * n of them.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import (
    U,
    components,
    gram_hashes,
    map_batches,
    maybe_broadcast,
    mix,
    signed,
    word_hashes,
)
from casewright.session import staged

# Up to FEW documents a key, pairs across components are joined as rows; beyond,
# blocks of about BLOCK documents are compared inside a task.
FEW = 64
BLOCK = 512


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; all words as one if fewer."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(gram_hashes(h, min(k, len(h))))


@lru_cache(maxsize=8)
def _bands(num: int, den: int) -> tuple[list[int], list[int]]:
    """Lower ends of the size bands and each band's largest partner size."""
    low, reach = [1], []
    while low[-1] < 1 << 40:
        low.append(max(low[-1] + 1, low[-1] * den * den // (num * num) + 1))
        reach.append((low[-1] - 1) * den // num)
    return low, reach


def segment_keys(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set for every size band in which it may have a partner."""
    n = len(s)
    if not n:
        return np.empty(0, np.uint64)
    low, reach = _bands(num, den)
    band = bisect_right(low, n) - 1
    codes, out = mix(s ^ U(0x9E3779B97F4A7C15)), []
    while band >= 0 and reach[band] >= n:
        most = (den - num) * (low[band + 1] - 1) // num
        segments = most + 1 + most // 8
        place = ((s >> U(32)) * U(segments)) >> U(32)  # sorted, as s is
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        parity = np.bitwise_xor.reduceat(codes, first)[: most + 1]
        salt = mix((place[first] << U(8)) ^ U(band))
        out.append(mix(parity + salt[: most + 1]))
        if len(first) <= most:
            empty = np.setdiff1d(np.arange(segments, dtype=np.uint64), place[first])
            out.append(mix(mix((empty << U(8)) ^ U(band)) ^ U(0x5851F42D4C957F2D)))
        band -= 1
    return np.concatenate(out)


def dense_sketch(s: np.ndarray) -> np.ndarray:
    """Parity bits: 2 to 4 bits a shingle, a power of two, at least one word."""
    bits = 1 << max(6, math.ceil(math.log2(2 * len(s))))
    odd = np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def sketch_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Hamming distance of two dense sketches, the longer one folded to the shorter."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _close(distance, a, b, num, den):
    """Whether a symmetric difference of at least ``distance`` still allows a link."""
    return distance * (den + num) <= (den - num) * (a + b)


def _sketches(k: int, num: int, den: int):
    def run(batch):
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        n, finger, bits, keys = [], [], [], []
        for text in texts:
            s = shingle_set(text, k)
            n.append(len(s))
            finger.append(_finger(s) if len(s) else None)
            bits.append(dense_sketch(s).tobytes() if len(s) else None)
            keys.append(segment_keys(s, num, den).tobytes())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(finger, pa.int64()), pa.array(bits, pa.binary()), pa.array(keys, pa.binary())],
            ["id", "n", "finger", "bits", "keys"],
        )

    return run


def _explode_keys(batch):
    raw = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
    sizes = [len(x) for x in raw]
    v, rep = (np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 2))
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(raw)), pa.array(v), pa.array(rep)], ["key", "v", "rep"])


def _near_by_sketch(num: int, den: int):
    def run(batch):
        a, b, na, nb, sa, sb = (batch.column(i).to_pylist() for i in range(6))
        keep = [
            _close(sketch_distance(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), p, q, num, den)
            for p, q, x, y in zip(na, nb, sa, sb)
        ]
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _block_pairs(num: int, den: int):
    """Pairs of one unit of two blocks, across components, that sketches cannot part."""

    def run(group: pa.Table) -> pa.Table:
        ids = group["id"].to_numpy()
        comp = group["comp"].to_numpy()
        size = group["n"].to_numpy()
        block = group["block"].to_numpy()
        bits = [np.frombuffer(x, np.uint64) for x in group["bits"].to_pylist()]
        c1, c2 = group["c1"][0].as_py(), group["c2"][0].as_py()
        left, right = np.flatnonzero(block == c1), np.flatnonzero(block == c2)
        shortest = min(map(len, bits))
        folded = np.stack([np.bitwise_xor.reduce(x.reshape(-1, shortest)) for x in bits])
        out_a, out_b = [], []
        for i in left:
            js = right[(comp[right] != comp[i]) & ((ids[right] > ids[i]) | (c1 != c2))]
            js = js[(size[js] * den >= size[i] * num) & (size[i] * den >= size[js] * num)]
            apart = np.bitwise_count(folded[js] ^ folded[i]).sum(axis=1, dtype=np.int64)
            js = js[_close(apart, size[js], size[i], num, den)]
            out_a.extend(np.minimum(ids[js], ids[i]).tolist())
            out_b.extend(np.maximum(ids[js], ids[i]).tolist())
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return run


def _linked(num: int, den: int):
    def run(batch):
        sa, sb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        keep = []
        for x, y in zip(sa, sb):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(den * both >= num * (len(x) + len(y) - both))
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def jaccard_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: tuple[int, int] = (80, 100),
    few: int = FEW,
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Two documents link when Jaccard of their shingle sets is at least
    ``threshold`` (numerator, denominator); ``component_id`` is the smallest id
    reachable by links. Null, empty and blank texts have no shingles and link
    with nothing. A row with a null id links with nothing and has a null
    component. Repeated rows give repeated results; rows that share an id are one
    vertex, whatever their texts (but for blank ones, which keep their own id).
    Texts of any length are read whole. Other columns are not read. Up to ``few``
    sets of a key are paired as rows, more in blocks of about ``block``.
    """
    num, den = threshold
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    sketched = staged(
        map_batches(rows, _sketches(shingle, num, den), "id bigint, n bigint, finger bigint, bits binary, keys binary")
    )
    named = sketched.where(F.col("id").isNotNull() & (F.col("n") > 0))
    vertex = staged(named.groupBy(F.col("finger").alias("v")).agg(F.min("id").alias("rep")))

    # Keys met by two different sets, then the vertices that hold them.
    keys = map_batches(named.select("finger", "keys", "id"), _explode_keys, "key bigint, v bigint, rep bigint")
    shared = keys.groupBy("key").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo < hi").select("key")
    shared = staged(shared)
    met = keys.join(maybe_broadcast(shared), "key", "left_semi")
    held = staged(met.groupBy("key", "v").agg(F.min("rep").alias("rep")))
    # The pivot is the set of the smallest id: the same one for the many keys of a group.
    group = held.groupBy("key").agg(F.min(F.struct("rep", "v"))["v"].alias("pivot"), F.count("*").alias("size"))
    group, held = staged(group), held.drop("rep")
    star = held.join(group, "key").where("v <> pivot").select(F.col("pivot").alias("a"), F.col("v").alias("b")).distinct()
    first = vertex.select(F.col("rep").alias("id"), F.col("v").alias("finger"))
    sketch = named.join(first, ["id", "finger"], "left_semi").select(F.col("finger").alias("v"), "n", "bits")
    sketch = sketch.dropDuplicates(["v"])

    def verified(pairs: DataFrame, by_sketch: bool) -> DataFrame:
        if by_sketch:
            left = sketch.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("bits").alias("sa"))
            right = sketch.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("sb"))
            both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
            both = both.where((F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num))
            pairs = map_batches(both, _near_by_sketch(num, den), "a bigint, b bigint")
        pairs = staged(pairs)
        wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct())
        ids = staged(vertex.join(wanted, "v").select(F.col("rep").alias("id")).distinct())
        texts = rows.join(maybe_broadcast(ids), "id", "left_semi").select("text")
        sets = map_batches(texts, _sets(shingle), "v bigint, s binary").join(maybe_broadcast(wanted), "v", "left_semi")
        sets = staged(sets.dropDuplicates(["v"]))
        both = (
            pairs.join(sets.select(F.col("v").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("v").alias("b"), F.col("s").alias("sb")), "b")
            .select("a", "b", "sa", "sb")
        )
        return staged(map_batches(both, _linked(num, den), "a bigint, b bigint"))

    links = verified(star, True)
    comp = components(links)

    # Keys whose vertices lie in several components: every pair across them.
    placed = held.join(group, "key").join(comp.withColumnRenamed("id", "v"), "v", "left")
    placed = staged(placed.select("key", "size", "pivot", "v", F.coalesce("component", "v").alias("comp")))
    several = (
        placed.where("size > 2").groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1")
    )
    rest = staged(placed.join(several.select("key"), "key", "left_semi"))
    small = rest.where(F.col("size") <= few)
    pairs = (
        small.alias("x")
        .join(small.alias("y"), "key")
        .where("x.v < y.v and x.comp <> y.comp and x.v <> x.pivot")
        .select(F.col("x.v").alias("a"), F.col("y.v").alias("b"))
        .distinct()
    )
    blocks = F.ceil(F.col("size") / block).cast("int")
    many = rest.where(F.col("size") > few).withColumn("blocks", blocks)
    many = many.withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = many.join(sketch, "v").withColumn("other", other)
    units = units.select(
        "key",
        F.least("block", "other").alias("c1"),
        F.greatest("block", "other").alias("c2"),
        "block",
        F.col("v").alias("id"),
        "comp",
        "n",
        "bits",
    )
    spread = units.groupBy("key", "c1", "c2").applyInArrow(_block_pairs(num, den), "a bigint, b bigint")
    more = verified(pairs, True).unionAll(verified(spread.distinct(), False))

    # Rows that share an id are one vertex: their sets are tied.
    twice = named.groupBy("id").agg(F.min("finger").alias("lo"), F.max("finger").alias("hi")).where("lo < hi")
    tied = named.join(staged(twice), "id").where("finger <> lo").select(F.col("lo").alias("a"), F.col("finger").alias("b"))
    final = components(links.unionAll(more).unionAll(tied.distinct()))
    placed = staged(vertex.join(final.withColumnRenamed("id", "v"), "v", "left").select("v", "rep", F.coalesce("component", "v").alias("comp")))
    least = placed.groupBy("comp").agg(F.min("rep").alias("component_id"))
    label = placed.join(least, "comp").select(F.col("v").alias("finger"), "component_id")
    return (
        sketched.join(label, "finger", "left")
        .select(
            F.col("id").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        )
    )


def _finger(s: np.ndarray) -> int:
    """64-bit fingerprint of a set and its size."""
    return xxhash.xxh3_64_intdigest(s.tobytes(), len(s)) - (1 << 63)


def _sets(k: int):
    def run(batch):
        found = [shingle_set(x, k) for x in batch.column(0).to_pylist()]
        found = [s for s in found if len(s)]
        out = [pa.array([_finger(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())]
        yield pa.RecordBatch.from_arrays(out, ["v", "s"])

    return run


def first_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` whose id is the smallest of its component; repeated rows once.

    Rows that link with nothing (blank text, null id) stay.
    """
    found = jaccard_components(docs, **options)
    drop = staged(found.where("component_id <> doc_id").select(F.col("doc_id").alias("_drop")).distinct())
    name = options.get("id_col", "doc_id")
    kept = docs.join(maybe_broadcast(drop), docs[name] == F.col("_drop"), "left_anti")
    # Only ids that occur twice (null among them) can be repeated rows: the others are not shuffled.
    twice = staged(docs.groupBy(F.col(name).alias("_twice")).count().where("count > 1").select("_twice"))
    if not twice.limit(1).count():
        return kept
    same = kept[name].eqNullSafe(F.col("_twice"))
    repeated = kept.join(maybe_broadcast(twice), same, "left_semi").dropDuplicates()
    return kept.join(maybe_broadcast(twice), same, "left_anti").unionByName(repeated)
