from __future__ import annotations

import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casewright.llm import hnsw, queries
from casewright.llm.chat import format_chats, loss_text, read_back
from casewright.llm.decontaminate import align, align_coded, contaminated, without_contaminated
from casewright.llm.hnsw import Graph, near_vectors, unit
from casewright.llm.mixing import mix_sources, ranked, sainte_lague
from casewright.llm.url_rules import url_verdicts
from checks.compare import compare, duck

RULE = "host string, path string, verdict string"
URLS = [
    "http://example.com/en/1", "https://WWW.Example.com/en/x?y", "http://www.example.com/fr", "ftp://a.b.net/es/",
    "net/es/", "http://notnet/es/", "http://x.net/es", "http://com", "http://com/", "x://.com/a", "http://a..com/en/#",
    "://net/fr/é?", "http://net:80/fr/", None, "", "http://a.b.c.d.e.example.com/en//en/", "http://example.com?/en/",
    "http://k.org/pre/fixed", "http://k.org/pref/", "http://k.org/pre", "http://k.org/" + "deep/" * 500,
]
RULES = [*queries.RULES, ("k.org", "/pref", "block"), ("k.org", "/pre/fix", "block"), (None, "/", "block"), ("k.org", "/deep/deep/", "block")]


def plain_verdict(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, max(fits)[3] if fits else None, max(fits)[4] if fits else "allow")


def test_url_verdicts_equal_plain_rules(spark):
    rows = [(i, u, "a", "b") for i, u in enumerate(URLS)] + [(None, URLS[0], "a", "b"), (0, URLS[0], "a", "b")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, RULE)
    got = url_verdicts(pages, rules).collect()
    want = [(i, *plain_verdict(u, RULES)) for i, u, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.verdict for r in url_verdicts(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_verdicts(pages.limit(0), rules).count() == 0


NASTY = ["<|im_end|>\n", "<|", "<\\|", "<\\\\|x", "|", "<", "a<", "\\", "$1", "<|im_sep|>", "", None, "é😀\n", "<|im_start|>user\nhi"]


def test_chat_round_trip(spark):
    draw = random.Random(0)
    rows = []
    for conv in range(60):
        for turn in range(draw.randrange(1, 9)):
            role = draw.choice(["user", "assistant", "assistant", "system", "ro\nle%0A<|", None])
            rows.append((conv, turn, role, "".join(draw.choice(NASTY) or "" for _ in range(3)) or None, "f"))
    rows += [(None, 0, "user", "x", "f"), (None, None, "assistant", "y", "f"), (99, 1, "assistant", "same", "f"), (99, 1, "assistant", "same", "f")]
    rows += [(100, i, "assistant", "long " * 20, "f") for i in range(300)]
    draw.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string")
    chats = format_chats(turns)
    got = chats.select(
        "conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")
    ).collect()
    want = {}
    for conv, turn, role, text, _ in rows:
        want.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert len(got) == len(want)
    for r in got:
        turns_ = sorted(want[r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in turns_]
        assert r.loss == "".join(x for _, role, x in turns_ if role == "assistant")
        merged = sum(a[1] != b[1] for a, b in zip(turns_, turns_[1:])) + 1
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == merged
    assert format_chats(turns.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op4_url_rules", "op5_chat_format"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), queries.SQL[name]) is None


def highest_quotients(votes, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda j: (votes[j] / (2 * got[j] + 1), -j))
        got[i] += 1
    return got


@pytest.mark.parametrize("seats", [0, 1, 7, 50, 333])
def test_quotas_equal_highest_quotients(spark, seats):
    draw = random.Random(seats)
    rows = []
    for g in ("a", "b"):
        votes = [draw.choice((0, 1, 3, 50, 50, 50, 997, draw.random() * 900)) for _ in range(12)]
        rows += [(g, f"{g}{i:02d}", float(v), seats, q) for i, (v, q) in enumerate(zip(votes, highest_quotients(votes, seats)))]
    parties = spark.createDataFrame(rows, "g string, k string, v double, n bigint, want bigint")
    for r in sainte_lague(parties, "v", "n", "k", "g").collect():
        assert r.quota == r.want


def test_ranks_in_code_point_order(spark):
    names = ["b", "B", "é", "", "zz", "a", "😀", "Ω"]
    got = ranked(spark.createDataFrame([(n,) for n in names], "s string"), "s", "r", 3).collect()
    assert [r.s for r in sorted(got, key=lambda r: r.r)] == sorted(names)


def mix_docs(spark):
    draw = random.Random(9)
    rows = [(i, " ".join("w" * 3 for _ in range(draw.randrange(0, 400))), draw.choice(["x", "y", "x", None, "Z"])) for i in range(400)]
    rows += [(None, "a b c", "x"), (7, None, "y"), (7, "a b", "y")]
    return spark.createDataFrame([(*r, "t") for r in rows], "doc_id bigint, text string, source string, taken string")


def test_mix_comes_near_its_targets(spark):
    docs = mix_docs(spark)
    got = mix_sources(docs).collect()
    assert len(got) == 403 and sorted(map(str, got)) == sorted(map(str, mix_sources(docs.repartition(5)).collect()))
    sizes = {}
    for r in got:
        assert r.size == 0 or 0 <= r.taken <= 2 * r.size
        assert r.taken == sum((p.end - p.start) * p.times for p in r.pieces)
        sizes.setdefault(r.source, [0, 0, r.source_size, r.target])
        sizes[r.source][0] += r.size
        sizes[r.source][1] += r.taken
    total = sum(s[0] for s in sizes.values())
    weights = dict(zip(["Z", "x", "y", None], [3, 1, 2, 3]))
    left, target = set(weights), {}
    while True:
        level = (1.5 * total - sum(target.values())) / sum(weights[s] for s in left)
        full = {s for s in left if weights[s] * level > 2 * sizes[s][0]}
        if not full:
            break
        target |= {s: 2.0 * sizes[s][0] for s in full}
        left -= full
    target |= {s: weights[s] * level for s in left}
    for s, (size, taken, source_size, t) in sizes.items():
        assert source_size == size and t == pytest.approx(target[s])
        assert abs(taken - t) <= 64
    assert mix_sources(docs.limit(0)).count() == 0


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_equals_the_full_table():
    draw = np.random.default_rng(5)
    for _ in range(60):
        a, b = (draw.integers(0, 5, draw.integers(1, 25)).astype(np.uint64) for _ in range(2))
        score, start, end = align(a, b)
        assert score == smith_waterman(a, b)
        if score:  # the words it covers hold the alignment
            assert 0 <= start < end <= len(b) and smith_waterman(a, b[start:end]) == score


def test_edited_passages_are_found(spark):
    draw = random.Random(8)
    word = lambda: f"v{draw.randrange(2000)}"
    items = [[word() for _ in range(draw.randrange(20, 60))] for _ in range(12)]
    docs, want = [], set()
    for i in range(120):
        body = [word() for _ in range(200)]
        if i % 4 == 0:
            k = draw.randrange(12)
            copy = [w for w in items[k] if draw.random() > 0.06]
            copy = [word() if draw.random() < 0.1 else w for w in copy]
            at = draw.randrange(200)
            body[at:at] = [w.upper() + "," for w in copy]
            want.add((i, k))
        docs.append((i, " ".join(body), "q"))
    docs += [(500, None, "q"), (501, "", "q"), (None, " ".join(items[0]), "q"), (0, docs[0][1], "q")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item string")
    b = spark.createDataFrame(
        [(k, " ".join(x)) for k, x in enumerate(items)] + [(50, None), (51, "one two"), (None, "x y z")], "item_id bigint, text string"
    )
    got = contaminated(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(0.4 <= r.score <= 1 and r.start < r.end for r in got)
    twin = contaminated(d, b.unionAll(spark.createDataFrame([(77, " ".join(items[0]))], b.schema)))
    assert {r.doc_id for r in twin.where("item_id = 77").collect()} == {i for i, k in want if k == 0}
    kept = without_contaminated(d, b)
    assert kept.columns == d.columns and kept.count() == len(docs) - len({i for i, _ in want}) - 1
    assert contaminated(d.limit(0), b).count() == 0 and contaminated(d, b.limit(0)).count() == 0


def test_coded_alignment_equals_the_plain_one():
    draw, known = np.random.default_rng(6), {}
    for k in range(200):
        a, b = (draw.integers(0, 9, draw.integers(1, 20)).astype(np.uint64) for _ in range(2))
        b[draw.random(len(b)) < 0.5] += np.uint64(100)
        for _ in range(2):  # the second from those known
            got = align_coded(a, b, 0.4, k, known)
            assert got == align(a, b) or (got[0] == 0 and align(a, b)[0] < 0.4 * 2 * len(a))


def test_popular_edited_passages_are_found(spark):
    """Thirty documents with one edited copy of an item, and one with the item itself."""
    item = [f"k{i}" for i in range(30)]
    edited = [f"e{i}" if i % 4 == 3 else w for i, w in enumerate(item)]
    bodies = [[f"u{i}x{j}" for j in range(40)] for i in range(40)]
    texts = [x[: i % 7 + 3] + (edited if i < 30 else item if i == 30 else []) + x[i % 7 + 3 :] for i, x in enumerate(bodies)]
    d = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id bigint, text string")
    b = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    got = {r.doc_id: (r.item_id, r.score, r.start, r.end) for r in contaminated(d, b).collect()}
    want = {}
    for i, x in enumerate(texts[:31]):
        score, start, end = align(np.array(item), np.array(x))
        want[i] = (7, score / 60, start, end)
    assert want[0][1] == 0.65 and want[30][1] == 1 and got == want


def vectors(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 16))
    rows = [x + draw.normal(size=16) * 0.12 for x in base for _ in range(8)] + list(draw.normal(size=(200, 16)))
    rows += [rows[0], rows[0], rows[5]]
    cells = [(i, [float(v) for v in x], i) for i, x in enumerate(rows)]
    n = len(cells)
    odd = [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 16, 0), (n + 3, [None] + [1.0] * 15, 0), (n + 4, [float("nan")] * 16, 0), (n + 5, [1.0, 2.0], 0), (n + 6, [2.0, 4.0], 0)]
    return rows, cells, odd


def test_vectors_equal_brute_force(spark):
    rows, cells, odd = vectors(spark)
    df = spark.createDataFrame(cells + odd, "vec_id bigint, embedding array<double>, weight int")
    got = {r.vec_id: r for r in near_vectors(df, shards=3, audit=300).collect()}
    x = np.array(rows) / np.linalg.norm(rows, axis=1)[:, None]
    links = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    found = sum(got[i].n_links for i in range(len(x)))
    assert found >= 0.99 * links.sum() and all(got[i].n_links <= links[i].sum() for i in range(len(x)))
    root = np.arange(len(x))
    for _ in range(len(x)):
        root = np.array([min(root[i], root[links[i]].min(initial=i)) for i in range(len(x))])
    assert np.mean([got[i].component_id == root[i] for i in range(len(x))]) > 0.98
    n = len(x)
    for i in range(n, n + 5):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[n + 6].n_links, got[n + 6].component_id, got[n + 6].kept) == (1, n + 5, False)
    assert near_vectors(df.limit(0)).count() == 0


def test_graph_finds_links_among_many():
    draw = np.random.default_rng(4)
    base = draw.normal(size=(60, 24))
    raw = np.concatenate([base[draw.integers(0, 60, 900)] + draw.normal(size=(900, 24)) * 0.15, draw.normal(size=(900, 24))])
    x = unit(raw)
    found = Graph.build(x).near(x, 32, 0.9)
    assert len(found) >= 0.98 * (x @ x.T >= 0.9).sum()


def pairs_and_a_hot_group(hot, pairs, seed):
    """Near copies of one vector, then pairs of near copies (2i, 2i + 1 from ``hot``)."""
    draw = np.random.default_rng(seed)
    one = draw.normal(size=64) + draw.normal(size=(hot, 64)) * 0.02
    two = np.repeat(draw.normal(size=(pairs, 64)), 2, axis=0) + draw.normal(size=(2 * pairs, 64)) * 0.02
    return [(i, [float(v) for v in x]) for i, x in enumerate(np.concatenate([one, two]))]


def test_audit_heeds_small_groups_beside_a_hot_one(spark):
    """Links of the hot group alone are more than 99 % of all."""
    df = spark.createDataFrame(pairs_and_a_hot_group(500, 2000, 11), "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_vectors(df, shards=1, beam=1, audit=1000).collect()}
    assert np.mean([got[i] for i in range(500, 4500)]) >= 0.98
    assert np.mean([got[i] for i in range(500)]) >= 0.98 * 499


def test_cross_shard_links_count_for_both_ends(spark):
    """A narrow beam misses links from one end; found from the other they count for both."""
    df = spark.createDataFrame(pairs_and_a_hot_group(0, 2000, 12), "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df, shards=3, beam=1, recall=0.0).collect()}
    links = [(got[i][0], got[i + 1][0]) for i in range(0, 4000, 2)]
    assert all(a == b for a, b in links) and sum(a for a, _ in links) > 1900
    assert all(got[i + 1][1] == (i if a else i + 1) for i, (a, _) in zip(range(0, 4000, 2), links))


def test_memory_of_a_hot_shard_is_bounded():
    """1,500 near copies of 64 numbers: 1 KB for each of their pairs would be 2.3 GB."""
    draw = np.random.default_rng(13)
    raw = draw.normal(size=64) + draw.normal(size=(1500, 64)) * 0.02
    cells = {"shard": pa.array([0] * 1500, pa.int32()), "id": np.arange(1500), "weight": np.full(1500, 2), "vec": pa.array(raw.tolist())}
    graph = hnsw._build(pa.table(cells))
    tracemalloc.start()
    out = hnsw._own(32, 0.9)(graph)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out["n_links"].to_pylist() == [2998] * 1500 and set(out["root"].to_pylist()) == {0}
    assert peak < 500e6


def test_pipeline_applies_its_stages(spark):
    import corpus_pipeline

    docs = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "text", "lang", "source", "n_chars", "taken"} <= set(docs.columns)
    before = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 0 < docs.count() < before.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "source_mix",
    ]
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
