"""Near-duplicate embeddings by sharded small-world graphs (operator 8).

Equal vectors are one vertex with a weight. Vertices are dealt to shards by
hash; each shard builds a hierarchical navigable small-world graph in its own
task. Every vector then queries every shard: greedy descent through the upper
layers, a beam on the lowest, and from the links found a flood along the graph
to all others at or above the threshold. Cosines are verified in double
precision, a bounded slice of pairs at a time.

Recall is audited before the full run: a bounded sample is compared with all
vectors by brute force, and the beam doubles until the index finds the wanted
share of a vector's links, on average over all vectors with links and over those
with about as many (a beam as wide as a shard is a full scan).

A shard first queries itself and unites its own links. Two shards then query
each other in one task; their links are a bit for each two vectors (312 MB for
two full shards), so that a link found from either end counts for both. Counts
and the distinct pairs of roots are passed on: a group of n near copies costs
rows in proportion to n, and memory does not depend on its size. The components
are then those of vectors and roots.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import components, maybe_broadcast, mix
from casewright.session import staged

M, M0, BUILD_BEAM = 16, 32, 48
BATCH, STEP = 256, 4
SLICE = 1 << 16  # pairs whose vectors are gathered at a time
GRAPH = "shard int, ids binary, weight binary, vec binary, dim int, nodes array<binary>, links array<binary>"


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def beam_search(vec, links, q, entry, ef):
    """Per query the ``ef`` best found: ids (-1: none) and similarities, all queries in step."""
    b, n = len(q), len(vec)
    rows = np.arange(b)
    seen = np.zeros((b, n), bool)
    ids, done = np.full((b, ef), -1, np.int64), np.zeros((b, ef), bool)
    sims = np.full((b, ef), -np.inf, np.float32)
    ids[:, 0], sims[:, 0] = entry, np.einsum("bd,bd->b", q, vec[entry])
    seen[rows, entry] = True
    step = min(STEP, ef)
    while len(rows):
        open_ = np.where(done[rows], -np.inf, sims[rows])
        best = np.argpartition(-open_, step - 1, axis=1)[:, :step] if step < ef else np.tile(np.arange(ef), (len(rows), 1))
        live = np.take_along_axis(open_, best, 1) > -np.inf
        some = live.any(1)
        rows, best, live = rows[some], best[some], live[some]
        if not len(rows):
            break
        done[rows[:, None], best] |= live
        at = np.where(live, ids[rows[:, None], best], 0)
        near = np.where(live[..., None], links[at], -1).reshape(len(rows), -1)
        ok = near >= 0
        near = np.where(ok, near, 0)
        ok &= ~seen[rows[:, None], near]
        # The same neighbour may come from two expanded nodes: the first counts.
        order = np.sort(np.where(ok, near, n), axis=1)
        near = order
        ok = order < n
        ok[:, 1:] &= order[:, 1:] != order[:, :-1]
        near = np.where(ok, near, 0)
        r, c = np.nonzero(ok)
        seen[rows[r], near[r, c]] = True
        sim = np.full(near.shape, -np.inf, np.float32)
        sim[r, c] = np.einsum("kd,kd->k", vec[near[r, c]], q[rows[r]])
        all_sim = np.concatenate([sims[rows], sim], 1)
        all_ids = np.concatenate([ids[rows], np.where(ok, near, -1)], 1)
        all_done = np.concatenate([done[rows], np.zeros(near.shape, bool)], 1)
        top = np.argpartition(-all_sim, ef - 1, axis=1)[:, :ef]
        sims[rows] = np.take_along_axis(all_sim, top, 1)
        ids[rows] = np.take_along_axis(all_ids, top, 1)
        done[rows] = np.take_along_axis(all_done, top, 1)
    return ids, sims


def diverse(vec, cand, sim, keep):
    """The selection heuristic: nearest first, those nearer to a chosen one only as a fill."""
    order = np.argsort(-sim, axis=1, kind="stable")
    cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
    valid = cand >= 0
    x = vec[np.where(valid, cand, 0)]
    between = np.einsum("bid,bjd->bij", x, x)
    chosen = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        nearest = np.where(chosen[:, :j], between[:, j, :j], -np.inf).max(1, initial=-np.inf)
        chosen[:, j] = valid[:, j] & (nearest < sim[:, j]) & (chosen.sum(1) < keep)
    rank = np.where(valid, np.where(chosen, 0, 1), 2) * cand.shape[1] + np.arange(cand.shape[1])
    pick = np.argsort(rank, axis=1)[:, :keep]
    out = np.take_along_axis(np.where(valid, cand, -1), pick, 1)
    if out.shape[1] < keep:
        out = np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)
    return out


class Graph:
    """Layers of ``(nodes, links)``, the lowest first; ``links`` has a row per vector."""

    def __init__(self, vec: np.ndarray, layers=None):
        self.vec, self.layers = vec, layers or []

    @classmethod
    def build(cls, vec: np.ndarray, seed: int = 42):
        n = len(vec)
        draw = (mix(np.arange(n, dtype=np.uint64) + np.uint64(seed)) >> np.uint64(11)) / float(1 << 53)
        level = np.floor(-np.log(np.maximum(draw, 1e-18)) / math.log(M)).astype(int)
        level[np.argmax(level)] = max(1, level.max())
        graph, order = cls(vec), np.argsort(-level, kind="stable")
        for layer in range(level.max(), -1, -1):
            nodes = order[level[order] >= layer]
            graph.layers.insert(0, (nodes, None))
            graph._fill(nodes, M0 if layer == 0 else M)
        return graph

    def _fill(self, nodes, width):
        """Insert a layer's nodes in batches that at most double it."""
        vec, links = self.vec, np.full((len(self.vec), width), -1, np.int32)
        self.layers[0] = (nodes, links)
        at = 0
        while at < len(nodes):
            batch = nodes[at : at + max(1, min(BATCH, max(at, 1)))]
            own = vec[batch] @ vec[batch].T
            np.fill_diagonal(own, -np.inf)
            own[np.triu_indices(len(batch))] = -np.inf  # to those before only
            cand, sim = np.tile(batch, (len(batch), 1)), own
            cand = np.where(np.isfinite(sim), cand, -1)
            if at:
                ids, s = beam_search(vec, links, vec[batch], self._entry(vec[batch], nodes[0]), BUILD_BEAM)
                cand, sim = np.concatenate([ids, cand], 1), np.concatenate([s, sim], 1)
            if cand.shape[1] > BUILD_BEAM:
                top = np.argpartition(-sim, BUILD_BEAM - 1, axis=1)[:, :BUILD_BEAM]
                cand, sim = np.take_along_axis(cand, top, 1), np.take_along_axis(sim, top, 1)
            links[batch] = diverse(vec, cand, sim, width)
            self._back(batch, links, width)
            at += len(batch)

    def _back(self, batch, links, width):
        """Links both ways; a node with too many keeps a diverse choice."""
        to, new = links[batch].ravel().astype(np.int64), np.repeat(batch, width)
        to, new = to[to >= 0], new[to >= 0]
        order = np.argsort(to, kind="stable")
        to, new = to[order], new[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        for lo in range(0, len(targets), BATCH):
            t, f, c = targets[lo : lo + BATCH], first[lo : lo + BATCH], count[lo : lo + BATCH]
            more = np.full((len(t), c.max()), -1, np.int64)
            for i, (a, k) in enumerate(zip(f, c)):
                more[i, :k] = new[a : a + k]
            cand = np.concatenate([links[t].astype(np.int64), more], 1)
            sim = np.einsum("bcd,bd->bc", self.vec[np.where(cand >= 0, cand, 0)], self.vec[t])
            sim = np.where(cand >= 0, sim, -np.inf)
            if cand.shape[1] > 2 * width:
                top = np.argpartition(-sim, 2 * width - 1, axis=1)[:, : 2 * width]
                cand, sim = np.take_along_axis(cand, top, 1), np.take_along_axis(sim, top, 1)
            links[t] = diverse(self.vec, cand, sim, width)

    def _entry(self, q, start):
        entry = np.full(len(q), self.layers[-1][0][0] if len(self.layers) > 1 else start)
        for _, links in self.layers[:0:-1]:
            ids, sims = beam_search(self.vec, links, q, entry, 1)
            entry = ids[:, 0]
        return entry

    def near(self, q: np.ndarray, ef: int, least: float):
        """``(query, node)`` pairs whose similarity is about ``least`` or more."""
        out = [np.argwhere(hit) + [lo, 0] for lo, hit in self.hits(q, ef, least)]
        return np.concatenate(out) if out else np.empty((0, 2), int)

    def hits(self, q: np.ndarray, ef: int, least: float, step: int = BATCH):
        """``(first query, hits)`` for each ``step`` queries: a row of flags per query, set
        for the nodes whose similarity is about ``least`` or more."""
        vec, links = self.vec, self.layers[0][1]
        n = len(vec)
        for lo in range(0, len(q), step):
            part = q[lo : lo + step]
            if ef >= n:
                yield lo, part @ vec.T >= least
                continue
            ids, sims = beam_search(vec, links, part, self._entry(part, self.layers[0][0][0]), ef)
            hit = np.zeros((len(part), n), bool)
            r, c = np.nonzero(sims >= least)
            hit[r, ids[r, c]] = True
            tried = hit.copy()
            fronts = [np.flatnonzero(hit)]
            while fronts:  # from links to their neighbours, a slice at a time
                front = fronts.pop()
                if len(front) > SLICE:
                    fronts.append(front[SLICE:])
                    front = front[:SLICE]
                to = links[front % n]
                pair = np.unique(((front // n * n)[:, None] + to)[to >= 0])
                pair = pair[~tried.ravel()[pair]]
                r, c = pair // n, pair % n
                tried[r, c] = True
                good = np.empty(len(pair), bool)
                for at in range(0, len(pair), SLICE):
                    few = slice(at, at + SLICE)
                    good[few] = np.einsum("kd,kd->k", part[r[few]], vec[c[few]]) >= least
                hit[r[good], c[good]] = True
                if good.any():
                    fronts.append(pair[good])
            yield lo, hit


def _rows(table: pa.Table, column: str) -> np.ndarray:
    flat = table[column].combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _build(table: pa.Table) -> pa.Table:
    order = np.argsort(table["id"].to_numpy())
    ids, weight, raw = (table["id"].to_numpy()[order], table["weight"].to_numpy()[order], _rows(table, "vec")[order])
    graph = Graph.build(unit(raw))
    return pa.table(
        {
            "shard": pa.array([table["shard"][0].as_py()], pa.int32()),
            "ids": [ids.tobytes()],
            "weight": [weight.tobytes()],
            "vec": [raw.tobytes()],
            "dim": pa.array([raw.shape[1]], pa.int32()),
            "nodes": [[x.astype(np.int32).tobytes() for x, _ in graph.layers]],
            "links": [[x[nodes].tobytes() for nodes, x in graph.layers]],
        }
    )


def _load(row: dict):
    ids, weight = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["weight"], np.int64)
    raw = np.frombuffer(row["vec"], np.float64).reshape(len(ids), row["dim"])
    layers = []
    for i, (nodes, links) in enumerate(zip(row["nodes"], row["links"])):
        nodes = np.frombuffer(nodes, np.int32).astype(np.int64)
        full = np.full((len(ids), M0 if i == 0 else M), -1, np.int32)
        full[nodes] = np.frombuffer(links, np.int32).reshape(len(nodes), -1)
        layers.append((nodes, full))
    return ids, weight, raw, Graph(unit(raw), layers)


def _links(q, raw, graph, ef, least, step=BATCH):
    """Verified links of queries ``q`` in a shard, as ``Graph.hits`` gives them."""
    long_q, long_raw = np.linalg.norm(q, axis=1), np.linalg.norm(raw, axis=1)
    for lo, hit in graph.hits(unit(q), ef, least - 1e-4, step):
        flags, pair = hit.ravel(), np.flatnonzero(hit)
        for at in range(0, len(pair), SLICE):
            few = pair[at : at + SLICE]
            a, b = few // len(raw) + lo, few % len(raw)
            cos = np.einsum("kd,kd->k", q[a], raw[b]) / (long_q[a] * long_raw[b])
            flags[few[cos < least]] = False
        yield lo, hit


def _both_ways(a, b, graph_a, graph_b, ef, least, step):
    """Links of ``a`` with ``b`` found from either end: a row of bits for each of ``a``."""
    bits = np.zeros((len(a), -(-len(b) // 8)), np.uint8)
    for lo, hit in _links(a, b, graph_b, ef, least, step):
        bits[lo : lo + len(hit)] |= np.packbits(hit, axis=1)
    for lo, hit in _links(b, a, graph_a, ef, least, step):
        part = np.packbits(hit.T, axis=1)
        bits[:, lo // 8 : lo // 8 + part.shape[1]] |= part
    return bits


def _unpacked(bits, n, step):
    for lo in range(0, len(bits), step):
        yield lo, np.unpackbits(bits[lo : lo + step], axis=1, count=n).astype(bool)


def _unite(root, a, b):
    """Unite the classes of ``a`` and ``b``, pair by pair; each place's root is its class's smallest."""
    a, b = root[a], root[b]
    while (apart := a != b).any():
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((up := root[root]) != root).any():
            root[:] = up
        a, b = root[a], root[b]


def _own(ef: int, least: float, step: int = BATCH):
    """A shard's links among its own vectors: a count and a root for each."""

    def run(table: pa.Table) -> pa.Table:
        ids, weight, raw, graph = _load(table.to_pylist()[0])
        n, root = len(ids), np.arange(len(ids))
        n_links = np.zeros(n, np.int64)
        # ids are sorted, so the smallest place is the smallest id
        for lo, hit in _unpacked(_both_ways(raw, raw, graph, graph, ef, least, step), n, step):
            hit[np.arange(len(hit)), lo + np.arange(len(hit))] = False
            pair = np.flatnonzero(hit)
            for at in range(0, len(pair), SLICE):
                a, b = pair[at : at + SLICE] // n + lo, pair[at : at + SLICE] % n
                np.add.at(n_links, a, weight[b])
                _unite(root, a, b)
        shard = pa.array(np.full(n, table["shard"][0].as_py(), np.int32))
        return pa.table({"shard": shard, "id": ids, "n_links": n_links, "root": ids[root]})

    return run


def _cross(ef: int, least: float, step: int = BATCH):
    """Links between two shards, counted for both ends, and the roots they unite.

    Rows hold either an id and its count or two roots.
    """

    def run(table: pa.Table) -> pa.Table:
        both = table.to_pylist()
        out_id, out_n = np.empty(0, np.int64), np.empty(0, np.int64)
        ties = np.empty((0, 2), np.int64)  # pairs of roots
        if len(both) == 2:
            (ids, weight, raw, graph), (ids2, weight2, raw2, graph2) = map(_load, both)
            root, root2 = (np.frombuffer(x["root"], np.int64) for x in both)
            # ids are sorted; a pair of roots is kept as one number made of their places
            root, root2 = np.searchsorted(ids, root), np.searchsorted(ids2, root2)
            tied = np.empty(0, np.int64)
            n_links, n_links2 = np.zeros(len(ids), np.int64), np.zeros(len(ids2), np.int64)
            for lo, hit in _unpacked(_both_ways(raw, raw2, graph, graph2, ef, least, step), len(ids2), step):
                pair = np.flatnonzero(hit)
                for at in range(0, len(pair), SLICE):
                    a, b = pair[at : at + SLICE] // len(ids2) + lo, pair[at : at + SLICE] % len(ids2)
                    np.add.at(n_links, a, weight2[b])
                    np.add.at(n_links2, b, weight[a])
                    tied = np.union1d(tied, np.unique(root[a] * len(ids2) + root2[b]))
            ties = np.stack([ids[tied // len(ids2)], ids2[tied % len(ids2)]], 1)
            out_id, out_n = np.concatenate([ids, ids2]), np.concatenate([n_links, n_links2])
            out_id, out_n = out_id[out_n > 0], out_n[out_n > 0]
        none = [None]
        return pa.table(
            {
                "id": pa.array([*out_id.tolist(), *none * len(ties)], pa.int64()),
                "n_links": pa.array([*out_n.tolist(), *none * len(ties)], pa.int64()),
                "a": pa.array([*none * len(out_id), *ties[:, 0].tolist()], pa.int64()),
                "b": pa.array([*none * len(out_id), *ties[:, 1].tolist()], pa.int64()),
            }
        )

    return run


def _found(sample, ef: int, least: float, step: int = BATCH):
    """How many linked vertices of a shard each sampled vector finds."""

    def run(table: pa.Table) -> pa.Table:
        asked, vec = sample.value
        ids, _, raw, graph = _load(table.to_pylist()[0])
        counts = np.zeros(len(asked), np.int64)
        for lo, hit in _links(vec, raw, graph, ef, least, step):
            counts[lo : lo + len(hit)] = (hit & (asked[lo : lo + len(hit), None] != ids[None])).sum(1)
        return pa.table({"id": asked, "n": counts})

    return run


def _truth(sample, least: float):
    """Linked vertices of the sampled vectors among all, by brute force in blocks."""

    def run(batches):
        ids, vec = sample.value
        counts = np.zeros(len(ids), np.int64)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            raw, own = _rows(table, "vec"), table["id"].to_numpy()
            if raw.shape[1] != vec.shape[1] or not len(raw):
                continue
            for lo in range(0, len(raw), BATCH):
                part = raw[lo : lo + BATCH]
                cos = (vec @ part.T) / np.outer(np.linalg.norm(vec, axis=1), np.linalg.norm(part, axis=1))
                counts += ((cos >= least) & (ids[:, None] != own[None, lo : lo + BATCH])).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts)], ["id", "n"])

    return run


def least_share(found: np.ndarray, truth: np.ndarray) -> float:
    """Share of its links that a vector finds, on average over the vectors with links:
    the least of all, of those with one, with two or three, with four to seven links, and so on."""
    some = truth > 0
    if not some.any():
        return 1.0
    share, group = found[some] / truth[some], np.frexp(truth[some].astype(float))[1]
    return min(share.mean(), *(share[group == g].mean() for g in np.unique(group)))


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    shards: int = 6,
    shard_rows: int = 50_000,
    block_rows: int = 4_096,
    beam: int = 32,
    audit: int = 1_000,
    recall: float = 0.99,
    seed: int = 42,
) -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row per row of ``vectors``.

    ``n_links`` counts the other rows found with a cosine of at least ``least``,
    ``component_id`` is the smallest id reachable by links, ``kept`` marks it.
    ``audit`` bounds the sample behind the beam's width, ``block_rows`` the
    vectors that query together (256 at most). Vectors that are null,
    empty, zero, or hold a null or non-finite component link with nothing, as do
    vectors of different lengths with each other. Repeated rows are copies that
    link; a row with a null id links with nothing and has a null component.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    good = F.col("id").isNotNull() & F.coalesce(finite & F.exists("vec", lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are one number; equal vectors are one vertex.
    rows = rows.withColumn("vec", F.when(good, F.transform("vec", lambda x: x + F.lit(0.0))))
    distinct = rows.where("vec is not null").groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    distinct = staged(distinct.withColumn("dim", F.size("vec")))
    out = rows.select("id", "vec")
    names = []
    for (dim,) in distinct.select("dim").distinct().collect():
        names.append(_one_size(spark, distinct.where(F.col("dim") == dim), least, shards, shard_rows, block_rows, beam, audit, recall, seed))
    if not names:
        return out.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    links, edges = names[0]
    for x, y in names[1:]:
        links, edges = links.unionAll(x), edges.unionAll(y)
    label = components(edges)
    vertex = distinct.join(links, "id", "left").join(label, "id", "left").select(
        "vec", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    return out.join(vertex, "vec", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(False)).alias("kept"),
    )


def _one_size(spark, distinct, least, shards, shard_rows, block_rows, beam, audit, recall, seed):
    """Links and edges among the vertices of one vector length."""
    total = distinct.count()
    n = max(min(shards, total), -(-total // shard_rows))
    step = max(8, min(BATCH, block_rows) // 8 * 8)  # whole bytes of flags
    points = distinct.select("id", "weight", "vec", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).cast("int").alias("shard"))
    points = staged(points)
    graphs = staged(points.groupBy("shard").applyInArrow(_build, GRAPH))

    sample = points.orderBy(F.xxhash64(F.lit(seed + 2), "id"), "id").limit(audit)
    held = sample.select("id", "vec").toArrow()  # at most ``audit`` rows
    value = spark.sparkContext.broadcast((held["id"].to_numpy(), _rows(held, "vec")))

    def per_vector(counts):
        by_id = dict(counts.groupBy("id").agg(F.sum("n")).collect())  # a row per sampled vector
        return np.array([by_id.get(i, 0) for i in held["id"].to_pylist()])

    truth = per_vector(points.select("id", "vec").mapInArrow(_truth(value, least), "id bigint, n bigint"))
    while truth.any() and beam < total:
        found = per_vector(graphs.groupBy("shard").applyInArrow(_found(value, beam, least, step), "id bigint, n bigint"))
        if least_share(found, truth) >= recall:
            break
        beam *= 2
    inner = staged(graphs.groupBy("shard").applyInArrow(_own(beam, least, step), "shard int, id bigint, n_links bigint, root bigint"))
    roots = inner.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("id", "root"))).alias("r"))
    packed = graphs.join(roots, "shard").withColumn("roots_in", F.col("r.root")).drop("r")
    packed = staged(packed.mapInArrow(_pack, GRAPH + ", root binary"))
    # Each two shards meet in one task, so that links found from either end are united.
    other = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    met = packed.withColumn("other", other).where("shard <> other")
    met = met.withColumn("s1", F.least("shard", "other")).withColumn("s2", F.greatest("shard", "other")).drop("other")
    outer = staged(met.groupBy("s1", "s2").applyInArrow(lambda t: _cross(beam, least, step)(t.drop_columns(["s1", "s2"])), "id bigint, n_links bigint, a bigint, b bigint"))
    links = inner.select("id", "n_links").unionAll(outer.where("id is not null").select("id", "n_links"))
    links = links.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    edges = inner.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    edges = edges.unionAll(outer.where("a is not null").select("a", "b"))
    return links, edges


def _pack(batches):
    """The roots of a shard's vectors, in the order of their ids, as one binary cell."""
    for batch in batches:
        roots = [np.asarray(x, np.int64).tobytes() for x in batch.column(batch.schema.get_field_index("roots_in")).to_pylist()]
        cols = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "roots_in"]
        names = [x for x in batch.schema.names if x != "roots_in"]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(roots, pa.binary())], [*names, "root"])
