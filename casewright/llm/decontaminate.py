"""Benchmark decontamination by rare n-gram seeds and local alignment (operator 3).

1. Test items are cut into word n-grams (case and punctuation dropped). Items
   with equal words are one item until the end.
2. Documents are scanned once; n-grams whose slot is set in a bitmap of fixed
   size (the items' grams) go on to an exact equi-join with the items' grams.
3. Seeds of one document and item that lie near one diagonal make a window. All
   grams of an item are seeds; those met more than ``common`` times as often as
   its middle one are frequent.
4. Smith-Waterman over words scores a window: match 2, mismatch and gap -1. The
   score is divided by that of an exact copy. A window that rests on frequent
   seeds is first written in the item's own words, all others alike and cut off
   at the ends, which changes no score: one with too few of the item's words for
   the least score is left, and equal ones are aligned once in a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import gram_hashes, map_batches, maybe_broadcast, signed, word_hashes
from casewright.session import staged

SLOTS = 1 << 24  # bits of the scan's filter: 2 MB, whatever the benchmark's size
KNOWN = 100_000  # aligned windows a task keeps at hand
TOGETHER = 256  # about as many windows of a document are scored in one row
_BLANK = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation parts words."""
    return (text or "").lower().encode().translate(_BLANK).split()


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the window's words [start, end) it covers.

    A row of the Smith-Waterman table at a time; gaps along the row are a
    running maximum. Cells carry the window word where their alignment began.
    """
    m = len(window)
    at = np.arange(m + 1)
    row, began = np.zeros(m + 1, np.int64), at.copy()
    best, where = 0, (0, 0)
    for word in item:
        diag = row[:-1] + np.where(window == word, 2, -1)
        up = row[1:] - 1
        new, start = np.zeros(m + 1, np.int64), at.copy()
        take = np.maximum(diag, up)
        from_ = np.where(diag >= up, began[:-1], began[1:])
        live = take > 0
        new[1:][live] = take[live]
        start[1:][live] = from_[live]
        # Gap along the row: value minus distance, so the running maximum of value + place.
        lift = new + at
        top = np.maximum.accumulate(lift)
        source = np.maximum.accumulate(np.where(lift == top, at, 0))
        better = top - at > new
        new = np.where(better, top - at, new)
        start = np.where(better, start[source], start)
        row, began = new, start
        j = int(row.argmax())
        if row[j] > best:
            best, where = int(row[j]), (int(began[j]), j)
    return best, *where


def _item_grams(n: int):
    def run(batch):
        ids, grams, places = [], [], []
        for i, words in zip(batch.column(0).to_numpy(), batch.column(1).to_pylist()):
            g = gram_hashes(np.frombuffer(words, np.uint64), n)
            ids.append(np.full(len(g), i))
            grams.append(g)
            places.append(np.arange(len(g)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(np.concatenate(grams))), pa.array(np.concatenate(ids).astype(np.int64)), pa.array(np.concatenate(places).astype(np.int64))],
            ["gram", "item", "place"],
        )

    return run


def _item_words(batch):
    words = [word_hashes(plain_words(x)) for x in batch.column(1).to_pylist()]
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array([xxhash.xxh3_64_intdigest(w.tobytes()) - (1 << 63) for w in words], pa.int64()),
            pa.array([w.tobytes() for w in words], pa.binary()),
        ],
        ["item", "finger", "words"],
    )


def _scan(n: int, bitmap):
    def run(batch):
        bits = bitmap.value
        docs, grams, places = [], [], []
        for i, text in zip(batch.column(0).to_numpy(), batch.column(1).to_pylist()):
            g = gram_hashes(word_hashes(plain_words(text)), n)
            slot = (g & np.uint64(SLOTS - 1)).astype(np.int64)
            hit = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
            docs.append(np.full(len(hit), i, np.int64))
            grams.append(g[hit])
            places.append(hit)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(docs)), pa.array(signed(np.concatenate(grams))), pa.array(np.concatenate(places).astype(np.int64))],
            ["doc", "gram", "at"],
        )

    return run


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Fixed-size bitmap of the grams' slots, put together by Spark's bitmap aggregate."""
    slot = F.col("gram").bitwiseAND(F.lit(SLOTS - 1)) + 1
    parts = seeds.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")
    )
    out = np.zeros(SLOTS // 8, np.uint8)
    for b, bits in parts.collect():  # at most SLOTS / 32768 rows of 4 kB
        out[(b - 1) * 4096 : b * 4096] = np.frombuffer(bytes(bits), np.uint8)
    return out


def align_coded(item: np.ndarray, window: np.ndarray, least: float, key: int, known: dict) -> tuple[int, int, int]:
    """``align``, or zeros where ``least`` is out of reach; ``known`` holds windows aligned before.

    Words that the item lacks only ever mismatch, so they are one code; at the
    ends no best alignment covers them.
    """
    own, coded, n_own = np.unique(item, return_inverse=True, return_counts=True)
    code = np.minimum(np.searchsorted(own, window), len(own) - 1)
    code = np.where(own[code] == window, code, -1)
    at = np.flatnonzero(code >= 0)
    # A score is at most twice the words in common.
    both = int(np.minimum(np.bincount(code[at], minlength=len(own)), n_own).sum())
    if not both or both / len(item) < least:
        return 0, 0, 0
    code = code[at[0] : at[-1] + 1]
    seen = key, len(code), xxhash.xxh3_128_digest(code.tobytes())
    if seen not in known:
        if len(known) >= KNOWN:
            known.clear()
        known[seen] = align(coded, code)
    score, start, end = known[seen]
    return score, start + int(at[0]), end + int(at[0])


def _score(step: int, least: float):
    known: dict[tuple, tuple] = {}

    def run(batch):
        out = []
        for doc, text, its, words, spots, rares in zip(*(batch.column(i).to_pylist() for i in range(6))):
            h = word_hashes(plain_words(text))
            best: dict[int, tuple] = {}
            for item, raw, spot, rare in sorted(zip(its, words, spots, rares), key=lambda x: (x[0], x[2])):
                w = np.frombuffer(raw, np.uint64)
                slack = len(w) // 2 + 4
                a = max(0, spot * step - slack)
                b = min(len(h), (spot + 2) * step + len(w) + slack)
                score, s, e = align(w, h[a:b]) if rare else align_coded(w, h[a:b], least, item, known)
                found = (score / (2 * len(w)), -(a + s), a + e)
                if found[0] >= least and found > best.get(item, (0.0, 0, 0)):
                    best[item] = found
            out += [(doc, item, x[0], -x[1], x[2]) for item, x in best.items()]
        cols = list(zip(*out)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)], ["doc", "item", "score", "start", "end"]
        )

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 3,
    common: float = 20.0,
    seeds: int = 2,
    step: int = 16,
    least: float = 0.4,
) -> DataFrame:
    """``(doc_id, item_id, score, start, end)``: passages that copy a test item.

    One row for each document and item with a score of at least ``least`` (1: an
    exact copy); [start, end) are the passage's words, punctuation dropped, of
    the best alignment (the first, if several are equal). A window needs
    ``seeds`` different seeds, or one if the item has fewer grams; ``common`` says
    which seeds count as frequent, and no result depends on it. Null and
    empty texts and rows with a null id match nothing, nor do items of fewer than
    ``n`` words. Repeated documents give one row; items with equal words each
    give theirs. Rows that share an id are judged together, as one id.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).where("doc is not null and text is not null")
    named = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(item_text_col).alias("text")).where("item is not null")
    hashed = staged(map_batches(named, _item_words, "item bigint, finger bigint, words binary"))
    items = staged(hashed.groupBy("finger").agg(F.min("item").alias("item"), F.first("words").alias("words")))
    grams = staged(map_batches(items.select("item", "words"), _item_grams(n), "gram bigint, item bigint, place bigint"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(grams))
    hits = staged(map_batches(rows, _scan(n, bitmap), "doc bigint, gram bigint, at bigint"))

    met = hits.groupBy("gram").agg(F.count("*").alias("times"))
    counted = grams.join(met, "gram")
    middle = counted.groupBy("item").agg(
        F.percentile_approx("times", 0.5, 1000).alias("middle"), F.count_distinct("gram").alias("own")
    )
    all_seeds = counted.join(middle, "item").select(
        "gram", "item", "place", F.least(F.lit(seeds), F.col("own")).alias("need"), (F.col("times") <= F.col("middle") * common).alias("rare")
    )
    all_seeds = staged(all_seeds)
    # A window spans two steps of diagonals, so that seeds at a border meet in one.
    spot = F.floor((F.col("at") - F.col("place")) / step)
    spots = F.explode(F.array(spot, spot - 1))
    windows = hits.join(maybe_broadcast(all_seeds), "gram").select("doc", "item", "place", "need", "rare", spots.alias("spot"))
    windows = windows.groupBy("doc", "item", "spot").agg(
        F.collect_set("place").alias("places"), F.collect_set(F.when(F.col("rare"), F.col("place"))).alias("few"), F.max("need").alias("need")
    ).where("size(places) >= need")
    windows = staged(windows.select("doc", "item", "spot", (F.size("few") >= F.col("need")).alias("rare")))
    # The windows of one document and item stay in one row.
    parts = windows.groupBy("doc").agg(F.ceil(F.count("*") / TOGETHER).alias("parts")).where("parts > 1")
    windows = windows.join(maybe_broadcast(staged(parts)), "doc", "left").withColumn(
        "part", F.pmod(F.xxhash64("item"), F.coalesce("parts", F.lit(1)))
    )
    windows = windows.join(maybe_broadcast(items.select("item", "words")), "item")
    listed = windows.groupBy("doc", "part").agg(F.collect_list(F.struct("item", "words", "spot", "rare")).alias("w"))
    listed = staged(listed.select("doc", "w.item", "w.words", "w.spot", "w.rare"))
    to_align = rows.join(maybe_broadcast(listed, 20_000), "doc").select("doc", "text", "item", "words", "spot", "rare")
    scored = map_batches(
        to_align, _score(step, least), "doc bigint, item bigint, score double, start bigint, end bigint"
    )
    scored = scored.groupBy("doc", "item").agg(F.max(F.struct("score", (-F.col("start")).alias("neg"), F.col("end"))).alias("m"))
    scored = scored.select("doc", F.col("item").alias("_rep"), "m.score", (-F.col("m.neg")).alias("start"), "m.end")
    members = hashed.select("finger", F.col("item").alias(item_col)).distinct().join(
        items.select("finger", F.col("item").alias("_rep")), "finger"
    )
    return scored.join(members, "_rep").select(F.col("doc").alias(id_col), item_col, "score", "start", "end")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` that copy no test item; rows with a null id stay."""
    key = options.get("id_col", "doc_id")
    bad = staged(contaminated(docs, benchmark, **options).select(F.col(key).alias("_bad")).distinct())
    return docs.join(maybe_broadcast(bad), docs[key] == F.col("_bad"), "left_anti")
