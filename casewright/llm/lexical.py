"""Ranked lexical search by sequential impact-sorted reads (operator 13, NRA).

One scan of the corpus counts the words of every document and, of those that the
queries hold, their occurrences; that narrow table is staged and gives the
corpus statistics. Its rows are then indexed batch by batch where they lie: for
every query term a posting list sorted by impact. A query reads its lists in
rounds of doubling depth and keeps, for every document of the batch, a lower
bound (impacts read) and an upper bound (the lists that have not shown it count
with the impact they have come to). It stops when every document whose upper
bound reaches the k-th best lower bound is settled: its two bounds are equal.
The best found so far go from batch to batch, so later batches stop earlier.

Only the k best of a task and query are shuffled, ranked in two steps so that no
task holds all of a query's. Documents are not split by term: a frequent term is
spread over all tasks. Queries are worked off in blocks of about ``BLOCK``
(query, term) rows, each sent to the tasks once.

Results: documents without a term (null, empty) count nowhere. Every row is a
document of its own, so a repeated row takes a rank of its own; equal scores go
by ascending id, null last. Queries that share an id are one query of all their
terms; a query without a term has no result. Empty tables give none. Texts of
any length are read whole; further columns are left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from casewright.llm.common import map_batches
from casewright.session import staged

# Bytes that separate terms (all ASCII but letters and digits), and A-Z lower-cased.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
BLOCK = 50_000
FIRST_READ = 64
SALTS = 64


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split()


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a term adds to a document's score, in 64-bit integers."""
    if len(n) and 90 * int(n.max()) * docs >= 1 << 63:
        length = np.array([90 * int(x) * docs // terms for x in n], np.int64)
    else:
        length = 90 * n * docs // terms
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * (100 - 90 + length)))


def weight_of(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def _query_terms(items: DataFrame, text: str, id: str) -> DataFrame:
    """``(item, term)`` of every item, each term once."""
    kind = items.schema[id].dataType
    rows = items.where(F.col(text).isNotNull()).select(F.col(id).alias("item"), F.col(text).alias("text"))
    schema = StructType([StructField("item", kind), *StructType.fromDDL("term binary").fields])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i, body in enumerate(batch.column(1).to_pylist()):
            found = sorted(set(terms_of(body)))
            if found:
                own = batch.column(0).take(pa.array([i] * len(found)))
                yield pa.RecordBatch.from_arrays([own, pa.array(found, pa.binary())], schema.names)

    return map_batches(rows, run, schema).distinct()


def _occurrences(docs: DataFrame, number: dict[bytes, int], text: str, id: str) -> DataFrame:
    """``(id, n, terms, tfs)`` of every document with a term: its length and the query terms in it."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = StructType(
        [
            StructField("id", docs.schema[id].dataType),
            StructField("n", LongType(), False),
            StructField("terms", ArrayType(IntegerType(), False), False),
            StructField("tfs", ArrayType(LongType(), False), False),
        ]
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, n, terms, tfs = [], [], [], []
        for i in range(batch.num_rows):
            words = terms_of(batch.column(1)[i].as_py())
            if words:
                counted = Counter(words)
                held = counted.keys() & number.keys()
                at.append(i)
                n.append(len(words))
                terms.append([number[w] for w in held])
                tfs.append([counted[w] for w in held])
        cells = [pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *cells], schema.names)

    return map_batches(rows, run, schema)


class Postings:
    """Posting lists of some documents, each sorted by falling impact."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, self.docs = doc[order], impact[order], docs
        self.bounds = np.searchsorted(term[order], np.arange(terms + 1))

    def best(self, terms: np.ndarray, k: int, known: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the ``k`` best beside scores ``known``, with their final scores.

        Every document that reaches the k-th best score is returned, ties included.
        """
        start, end = self.bounds[terms], self.bounds[terms + 1]
        lists = start < end
        start, end = start[lists], end[lists]
        if not len(start):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lower = np.zeros(self.docs, np.int64)
        unseen = np.ones((self.docs, len(start)), bool)
        front = np.empty(len(start), np.int64)
        at, step = start.copy(), FIRST_READ
        alive = np.arange(self.docs)
        while True:
            for t, (a, b) in enumerate(zip(at, np.minimum(at + step, end))):
                read = self.doc[a:b]
                lower[read] += self.impact[a:b]
                unseen[read, t] = False
                front[t] = self.impact[b] if b < end[t] else 0
            at = np.minimum(at + step, end)
            step *= 2
            low = lower[alive]
            upper = low + unseen[alive] @ front
            best = np.concatenate([low, np.array(known, np.int64)])
            least = max(int(np.partition(best, len(best) - k)[len(best) - k]), 1) if len(best) >= k else 1
            open_ = upper >= least
            alive, low, upper = alive[open_], low[open_], upper[open_]
            if (upper == low).all():
                return alive, low


def _search(schema: pa.Schema, lists: list[np.ndarray], weight: np.ndarray, docs: int, words: int, k: int):
    def run(batches):
        best: list[list[tuple]] = [[] for _ in lists]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            sizes = pc.list_value_length(batch.column(2)).to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            term = batch.column(2).flatten().to_numpy()
            n = batch.column(1).to_numpy()
            impact = impacts(weight[term], batch.column(3).flatten().to_numpy(), n[doc], docs, words)
            found = Postings(doc, term, impact, batch.num_rows, len(weight))
            place = np.empty(batch.num_rows, np.int64)
            place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(batch.num_rows)
            for q, terms in enumerate(lists):
                at, score = found.best(terms, k, [-s for s, *_ in best[q]])
                if len(at):
                    first = np.lexsort((place[at], -score))[:k]
                    new = [(-int(s), v is None, v) for s, v in zip(score[first], ids.take(pa.array(at[first])).to_pylist())]
                    best[q] = sorted(best[q] + new, key=_by_score)[:k]
        rows = [(q, v, -s) for q, kept in enumerate(best) for s, _, v in kept]
        for start in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("query", "id", "score"), r)) for r in rows[start : start + 10_000]], schema
            )

    return run


def _by_score(row: tuple) -> tuple:
    s, none, v = row
    return (s, none) if none else (s, none, v)


def _block(docs: DataFrame, asked: list, kind, text: str, id: str, k: int) -> DataFrame:
    """The ``k`` best of one block of queries, ``asked`` as ``(item, term)`` rows."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in asked}))}
    held: dict = {}
    for r in asked:
        held.setdefault(r.item, []).append(number[bytes(r.term)])
    met = staged(_occurrences(docs, number, text, id))
    whole = met.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    df = {r.term: r["count"] for r in met.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    weight = np.array([weight_of(df.get(i, 0), whole.docs) for i in range(len(number))], np.int64)
    lists = [np.array(sorted(t), np.int64) for t in held.values()]
    schema = StructType(
        [StructField("query", IntegerType()), StructField("id", docs.schema[id].dataType), StructField("score", LongType())]
    )
    run = _search(to_arrow_schema(schema), lists, weight, whole.docs, whole.words or 1, k)
    found = staged(met.where(F.size("terms") > 0).mapInArrow(run, schema))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    salted = salted.withColumn("at", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order)))
    ranked = salted.where(F.col("at") <= k).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))
    )
    names = spark.createDataFrame(list(enumerate(held)), StructType([StructField("query", IntegerType()), StructField("item", kind)]))
    return ranked.where(F.col("rank") <= k).join(F.broadcast(names), "query").select("item", "rank", "id", "score")


def ranked_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", id: str = "doc_id", item_id: str = "item_id", block: int = BLOCK
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``id`` and ``score`` of the ``k`` best documents of every item."""
    asked = staged(_query_terms(items, text, item_id))
    blocks = max(1, -(-asked.count() // block))
    kind = items.schema[item_id].dataType
    out = None
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        if part or not b:
            one = _block(docs, part, kind, text, id, k)
            out = one if out is None else out.unionAll(one)
    return out.select(F.col("item").alias(item_id), F.col("rank"), F.col("id").alias(id), "score")
