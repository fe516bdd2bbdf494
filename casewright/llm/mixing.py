"""Mixing sources to target weights by Sainte-Lague apportionment (operator 9).

1. Sources are ranked by code point and weigh by a repeating list; together
   they are to give ``share`` of all words. A target stops at ``most`` times its
   source's size; the excess is shared again by weight until none is above.
2. The mix is cut into blocks of ``block`` words. Sainte-Lague gives them to the
   sources by highest quotients target / (2q + 1), and each source's blocks to
   its shards (hash ranges of the documents) in the same way. The quotas are
   those of the divisor at which the rounded quotients fill the seats; it is
   found by aggregates over many candidate divisors at once.
3. In a shard the documents lie in seeded hash order as one stream of words, cut
   into blocks. The quota takes whole rounds of all blocks and then the rest
   evenly spaced from a seeded start, so a document's share follows from the
   stream offsets of its first and last word: no block is written out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import maybe_broadcast, word_count
from casewright.session import staged

# Documents a shard holds on average: what one window task sorts.
SHARD_ROWS = 1_000
CANDIDATES = 128
PASSES = 5


def ranked(df: DataFrame, by: str, name: str, parts: int = 16) -> DataFrame:
    """Add the rank (from 0) in ascending order of the unique column ``by``, nulls last.

    Range partitions are ranked each on its own and start at the rows of those
    before; only one count per partition is collected.
    """
    order = F.col(by).asc_nulls_last()
    cut = df.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id())
    cut = staged(cut)
    sizes = sorted((r["_part"], r["count"]) for r in cut.groupBy("_part").count().collect())
    start, at = F.lit(0), 0
    for part, n in sizes:
        start = F.when(F.col("_part") == part, F.lit(at)).otherwise(start)
        at += n
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return cut.withColumn(name, (inside + start).cast("bigint")).drop("_part")


def capped_targets(sources: DataFrame, total: float, most: float) -> DataFrame:
    """Add ``target``: ``total`` shared by ``weight``, none above ``most * source_size``.

    Each pass fixes the sources above their limit and shares the rest among the
    others: one aggregate over the sources a pass.
    """
    limit = F.col("source_size") * F.lit(float(most))
    level = 0.0
    while True:
        capped = F.col("weight") * F.lit(level) >= limit
        used, weight = sources.agg(
            F.coalesce(F.sum(F.when(capped, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).cast("double"),
        ).first()
        if not weight or (total - used) / weight <= level:
            return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit).cast("double"))
        level = (total - used) / weight


def sainte_lague(parties: DataFrame, votes: str, seats: str, key: str, group: str) -> DataFrame:
    """Add ``quota``: the ``seats`` of each ``group`` (a column, equal in a group) by ``votes``.

    A quota is round(votes / divisor) at the divisor that fills the seats. All
    groups narrow their divisor together, ``CANDIDATES`` tries a pass, as sums
    over the parties. Where equal quotients meet at the end, parties are served
    in the order of the unique column ``key``.
    """
    v, n_seats = F.col(votes).cast("double"), F.col("_seats").cast("double")
    live = staged(parties)
    range_ = live.groupBy(group).agg(
        F.max(seats).alias("_seats"), F.sum(v).alias("_v"), F.max(v).alias("_most"), F.count("*").alias("_n")
    )
    # Rounding moves the sum by at most half a seat a party.
    half = F.col("_n") / 2
    low = F.greatest(F.col("_v") / (n_seats + half + 1), F.lit(1e-12))
    high = F.when(n_seats > half, F.col("_v") / (n_seats - half) * 1.000001).otherwise(2.000002 * F.col("_most"))
    range_ = staged(range_.select(group, "_seats", low.alias("_lo"), F.greatest(high, low * 2).alias("_hi")))
    step = F.explode(F.sequence(F.lit(1), F.lit(CANDIDATES - 1)))
    for _ in range(PASSES):
        tried = live.select(group, v.alias("_v")).join(maybe_broadcast(range_), group)
        tried = tried.select("*", step.alias("_i")).groupBy(group, "_i", "_seats", "_lo", "_hi")
        filled = tried.agg(F.sum(F.floor(F.col("_v") / _divisor() + 0.5)).alias("_sum")).withColumn("_d", _divisor())
        enough = F.col("_sum") >= F.col("_seats")
        range_ = staged(
            filled.groupBy(group, "_seats").agg(
                F.coalesce(F.max(F.when(enough, F.col("_d"))), F.max("_lo")).alias("_lo"),
                F.coalesce(F.min(F.when(~enough, F.col("_d"))), F.max("_hi")).alias("_hi"),
            )
        )
    full = live.join(maybe_broadcast(range_), group).withColumn("_q", F.floor(v / F.col("_lo") + 0.5).cast("bigint"))
    full = staged(full.withColumn("_tied", (F.col("_q") - F.floor(v / F.col("_hi") + 0.5)).cast("bigint")))
    over = full.groupBy(group).agg((F.sum("_q") - F.max("_seats")).cast("bigint").alias("_over")).where("_over > 0")
    order = Window.partitionBy(group).orderBy(F.col(key).desc())
    less = full.where("_tied > 0").join(over, group).withColumn("_run", F.sum("_tied").over(order))
    less = less.select(
        key, F.least("_tied", F.greatest(F.col("_over") - F.col("_run") + F.col("_tied"), F.lit(0))).alias("_less")
    )
    return full.join(less, key, "left").select(
        *parties.columns, (F.col("_q") - F.coalesce("_less", F.lit(0))).alias("quota")
    )


def _divisor() -> Column:
    return F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_i") / CANDIDATES


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 32,
    seed: int = 42,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(id, *carry, source, size, source_size, target, taken, pieces)``, a row per row of ``docs``.

    ``size`` counts the words of the text (null: 0), ``taken`` those the mix
    takes, repeats counted; ``pieces`` lists them as word offsets [start, end)
    and how often each is taken. Sources weigh by ``weights`` in the order of
    their code points, a null source last. No document gives more than ``most``
    (rounded up) times its size, and a source misses its target by less than a
    block a shard. Repeated rows and rows that share an id are
    separate documents; null ids are kept. Other columns are not read.
    """
    source = F.when(F.col(source_col).isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), F.col(source_col)))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
        F.col(source_col).alias("_s"),
        source.alias("party"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("_h"),
    )
    narrow = rows.select("party", "size", "_h")
    sources = narrow.groupBy("party").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    listed = F.array(*[F.lit(int(w)) for w in weights])
    sources = ranked(sources, "party", "_rank")
    sources = staged(sources.withColumn("weight", F.element_at(listed, (F.col("_rank") % len(weights) + 1).cast("int"))))
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    sources = capped_targets(sources, total, most)
    sources = sources.withColumn("_all", F.lit(0)).withColumn("_blocks", F.lit(round(total / block)).cast("bigint"))
    sources = sainte_lague(sources, "target", "_blocks", "party", "_all").withColumnRenamed("quota", "source_blocks")
    sources = sources.withColumn("_shards", F.ceil(F.col("_rows") / SHARD_ROWS).cast("bigint"))
    sources = maybe_broadcast(staged(sources.select("party", "source_size", "target", "source_blocks", "_shards")))

    placed = rows.join(sources, "party").withColumn(
        "shard", F.concat_ws(":", F.pmod(F.col("_h"), F.col("_shards")).cast("string"), "party")
    )
    shards = placed.groupBy("shard", "party").agg(F.sum("size").alias("shard_size"), F.max("source_blocks").alias("_seats_in"))
    shards = sainte_lague(shards, "shard_size", "_seats_in", "shard", "party")
    in_shard = F.ceil(F.col("shard_size") / block).cast("bigint")
    quota = F.least(F.col("quota"), in_shard * F.lit(int(-(-most // 1))))
    shards = shards.select("shard", in_shard.alias("_n"), quota.alias("_q"))
    # Evenly spaced from a seeded start: block i is taken floor((i+1)q+o / n) - floor(iq+o / n) times.
    shards = staged(shards.withColumn("_o", F.pmod(F.xxhash64(F.lit(seed), "shard"), F.greatest("_n", F.lit(1)))))

    order = Window.partitionBy("shard").orderBy("_h", "_id", "size")
    lined = placed.withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    lined = lined.withColumn("_start", F.col("_end") - F.col("size")).join(maybe_broadcast(shards), "shard")

    def count(i):
        return F.floor((i * F.col("_q") + F.col("_o")) / F.greatest("_n", F.lit(1))).cast("bigint")

    first, last = F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block)
    pieces = F.transform(
        F.sequence(first, last),
        lambda i: F.struct(
            F.greatest(i * block - F.col("_start"), F.lit(0)).alias("start"),
            F.least((i + 1) * block - F.col("_start"), F.col("size")).alias("end"),
            (count(i + 1) - count(i)).alias("times"),
        ),
    )
    pieces = F.when(F.col("size") > 0, F.filter(pieces, lambda p: p["times"] > 0)).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint,times:bigint>>")
    )
    taken = F.aggregate(
        "pieces", F.lit(0).cast("bigint"), lambda a, p: a + (p["end"] - p["start"]) * p["times"]
    )
    out = lined.withColumn("pieces", pieces).withColumn("taken", taken)
    return out.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        *([] if source_col in carry else [F.col("_s").alias(source_col)]),
        "size",
        "source_size",
        "target",
        "taken",
        "pieces",
    )
