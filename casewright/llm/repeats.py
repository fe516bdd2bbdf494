"""Removal of passages that repeat across documents, by seed and extension (operator 7).

A repeat is a run of at least ``length`` words that also starts in a document
with a smaller id. Any two equal runs of ``length`` words share an anchor: the
smallest hash among the run's ``seed``-word grams (winnowing).

1. Anchors of all documents are aggregated; those of two documents are seeds,
   and are joined back to their documents.
2. From a seed the match is extended to both sides, for all its documents at
   once: every run of ``length`` words around the seed is taken by its
   fingerprint, and equal fingerprints are aggregated to the smallest id. Two
   documents match over a longer stretch exactly where consecutive runs match,
   so the united runs are the maximal repeats, and a seed that n documents
   share costs n rows and not n*n pairs.
3. Runs that start in a smaller id go back to their documents, which cut the
   words they cover.

Documents with equal texts are one document in 1 and 2: each run of a copy
starts in the copy with the smallest id. Runs are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from casewright.llm.common import gram_hashes, map_batches, maybe_broadcast, signed, word_hashes
from casewright.session import staged

CHUNK = 1 << 17


def run_anchors(h: np.ndarray, length: int, seed: int) -> np.ndarray:
    """The anchor of every run of ``length`` words."""
    g = gram_hashes(h, seed)
    width = length - seed + 1
    if len(g) < width:
        return np.empty(0, np.uint64)
    views = sliding_window_view(g, width)
    return np.concatenate([views[i : i + CHUNK].min(axis=1) for i in range(0, len(views), CHUNK)])


def _anchors(length: int, seed: int):
    def run(batch):
        found = [
            np.unique(run_anchors(word_hashes(x.split()), length, seed)) if x else np.empty(0, np.uint64)
            for x in batch.column(1).to_pylist()
        ]
        ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
        yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(found))), pa.array(ids)], ["anchor", "id"])

    return run


def _lists(column) -> list[np.ndarray | None]:
    """A list<bigint> column as unsigned arrays, without Python numbers."""
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [flat[a:b].view(np.uint64) if v else None for a, b, v in zip(at, at[1:], valid)]


def _runs(length: int, seed: int):
    def run(batch):
        found = []
        for text, wanted in zip(batch.column(1).to_pylist(), _lists(batch.column(2))):
            h = word_hashes(text.split())
            hit = np.isin(run_anchors(h, length, seed), wanted)
            found.append(np.unique(gram_hashes(h, length)[hit]))
        ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
        yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(found))), pa.array(ids)], ["run", "id"])

    return run


def covered_words(h: np.ndarray, runs: np.ndarray, length: int) -> np.ndarray:
    """Mask of the words covered by a run whose fingerprint is in ``runs``."""
    starts = np.flatnonzero(np.isin(gram_hashes(h, length), runs))
    edges = np.zeros(len(h) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(length: int, carried: int, schema: pa.Schema):
    def run(batch):
        texts, copies = batch.column(carried).to_pylist(), batch.column(carried + 1).to_pylist()
        n_words, n_removed, kept, spans = [], [], [], []
        for text, copy, runs in zip(texts, copies, _lists(batch.column(carried + 2))):
            words = (text or b"").split()
            n_words.append(len(words))
            if copy and len(words) >= length:
                mask = np.ones(len(words), bool)
            elif runs is not None and len(words) >= length:
                mask = covered_words(word_hashes(words), runs, length)
            else:
                mask = None
            if mask is None or not mask.any():
                n_removed.append(0)
                spans.append([])
            else:
                n_removed.append(int(mask.sum()))
                words = [w for w, m in zip(words, mask.tolist()) if not m]
                turns = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
                spans.append([{"start": int(a), "end": int(b)} for a, b in turns.reshape(-1, 2)])
            kept.append(b" ".join(words).decode())
        new = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept), pa.array(spans, schema.field("repeats").type)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:carried], *new], schema=schema)

    return run


def cut_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 50,
    seed: int = 20,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(id, *carry, n_words, n_removed, kept_text, repeats)``, one row per row of ``docs``.

    ``kept_text`` joins the words that are left by one space; ``repeats`` lists
    the maximal repeats cut, as word offsets [start, end). Null, empty and blank
    texts have no words. Rows with a null id are returned whole and take no part.
    Rows that share an id are one document: a passage that only they share stays.
    Columns named in ``carry`` are passed through, others are not read.
    """
    if not 0 < seed <= length:
        raise ValueError("seed must lie between 1 and length")
    finger = F.xxhash64(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"), finger.alias("finger"))
    rows = rows.where("id is not null and text is not null")
    first = rows.select("finger", "id").groupBy("finger").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    copies = rows.select("finger", "id").join(maybe_broadcast(staged(first)), "finger").where("id > lo")
    # Dealt by id before the distinct, so a hot group of copies can be split in the join.
    copies = copies.select("id", "finger").repartition("id").distinct()
    copies = staged(copies.withColumn("copy", F.lit(True)))
    own = rows.join(maybe_broadcast(copies.select("id", "finger")), ["id", "finger"], "left_anti").select("id", "text")

    anchors = map_batches(own, _anchors(length, seed), "anchor bigint, id bigint")
    seeds = anchors.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    seeds = staged(seeds.select("anchor"))
    of_doc = anchors.join(maybe_broadcast(seeds), "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors"))
    around = own.join(of_doc, "id").select("id", "text", "anchors")
    runs = staged(map_batches(around, _runs(length, seed), "run bigint, id bigint"))
    starts = runs.groupBy("run").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    starts = staged(starts.select("run", "lo"))  # a table of its own, so that a hot run's rows are split in the join
    cut = runs.join(maybe_broadcast(starts), "run").where("id > lo").groupBy("id").agg(F.collect_set("run").alias("runs"))

    base = docs.select(
        F.col(id_col).alias("_id"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
        F.col(text_col).cast("binary").alias("_text"),
        F.col(id_col).cast("bigint").alias("id"),
        finger.alias("finger"),
    )
    wide = base.join(maybe_broadcast(copies), ["id", "finger"], "left").join(cut, "id", "left")
    n = 1 + len(carry)
    fields = [StructField(f.name, f.dataType) for f in wide.select(*[c for c in base.columns[:n]]).schema]
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    fields += [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType()), StructField("repeats", ArrayType(span))]
    schema = StructType(fields)
    flat = wide.select(*base.columns[:n], "_text", "copy", "runs")
    out = map_batches(flat, _cut(length, n, to_arrow_schema(schema)), schema)
    return out.toDF(id_col, *carry, "n_words", "n_removed", "kept_text", "repeats")
