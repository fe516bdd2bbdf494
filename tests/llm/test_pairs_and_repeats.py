from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from casewright.llm.common import components, gram_hashes, word_hashes
from casewright.llm.parity_join import (
    dense_sketch,
    first_of_each_group,
    jaccard_components,
    segment_keys,
    shingle_set,
    sketch_distance,
)
from casewright.llm.repeats import cut_repeats

SCHEMA = "doc_id bigint, text string, id string, n string, text_ string"


def frame(spark, pairs):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in pairs], SCHEMA)


def corpus(seed=0, families=12):
    """Families of edited copies around the threshold, exact copies, and loners."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for size in (5, 12, 60, 200):
        for _ in range(families // 4):
            base = [draw.choice(words) for _ in range(size)]
            texts.append(" ".join(base))
            for edits in (0, 1, 1, 2, 3, 5):
                copy = list(base)
                for _ in range(edits):
                    copy[draw.randrange(size)] = draw.choice(words)
                texts.append("  ".join(copy).upper() if edits == 0 else "\n".join(copy))
    texts += [" ".join(draw.choice(words) for _ in range(40)) for _ in range(10)]
    ids = draw.sample(range(1000), len(texts))
    return list(zip(ids, texts))


def brute_components(docs, k, num, den):
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + min(k, len(w))]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100), (2, 50, 100)])
def test_components_equal_brute_force(spark, k, num, den):
    docs = corpus()
    got = jaccard_components(frame(spark, docs), shingle=k, threshold=(num, den)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, k, num, den)


def test_many_near_copies_are_compared_in_blocks(spark):
    draw = random.Random(3)
    base = [f"t{draw.randrange(500)}" for _ in range(90)]
    docs = []
    for i in range(150):
        copy = list(base)
        for j in draw.sample(range(90), draw.choice((0, 1, 2, 3))):
            copy[j] = f"x{draw.randrange(9999)}"
        docs.append((i, " ".join(copy)))
    got = jaccard_components(frame(spark, docs), shingle=3, threshold=(90, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, 3, 90, 100)


def test_pairs_of_two_blocks(spark):
    """Small blocks: near copies of several bodies that share many keys, and lone links between blocks."""
    draw = random.Random(4)
    common = [f"c{i}" for i in range(60)]
    docs = []
    for i in range(240):
        body = common + [f"g{i % 6}x{j}" for j in range(12)]
        for j in draw.sample(range(len(body)), draw.choice((0, 1, 4, 9))):
            body[j] = f"x{draw.randrange(9999)}"
        docs.append((i, " ".join(body)))
    got = jaccard_components(frame(spark, docs), shingle=2, threshold=(80, 100), few=3, block=16).collect()
    want = brute_components(docs, 2, 80, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert 10 < len({c for _, c in want.values()}) < 230


def test_rows_that_share_an_id_are_one_vertex(spark):
    a, b, c = ([f"{x}{i}" for i in range(40)] for x in "abc")
    docs = [(1, a), (1, b), (2, [*a, "z"]), (3, [*b, "y"]), (0, [*c, "q"]), (4, c), (4, ["lone"] * 3), (5, [])]
    got = jaccard_components(frame(spark, [(i, " ".join(w)) for i, w in docs]), shingle=3).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 1), (3, 1), (4, 0), (4, 0), (5, 5)]


def test_special_rows_of_the_join(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (None, "one"), (4, "one"), (6, "a " * 30_000)]
    got = jaccard_components(frame(spark, docs)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got if r.doc_id) == [
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6),
    ]
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(1, None)]
    kept = first_of_each_group(frame(spark, docs))
    assert kept.columns == SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 6]
    assert jaccard_components(frame(spark, docs[:0])).count() == 0


def test_sketches_bound_the_difference():
    draw = random.Random(1)
    for _ in range(30):
        a = shingle_set(" ".join(f"w{draw.randrange(60)}" for _ in range(draw.randrange(1, 300))).encode(), 2)
        b = np.unique(np.concatenate([a[draw.randrange(len(a)) :], shingle_set(b"p q r s", 2)]))
        assert sketch_distance(dense_sketch(a), dense_sketch(b)) <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100)])
def test_linked_sets_share_a_key(num, den):
    draw = random.Random(2)
    for _ in range(400):
        size = draw.choice((1, 2, 5, 9, 10, 11, 19, 40, 130, 700))
        pool = [draw.getrandbits(64) for _ in range(2 * size + 4)]
        a = set(pool[:size])
        lost = draw.randrange(0, max(1, size // 5) + 1)
        b = set(list(a)[lost:]) | set(pool[size : size + draw.randrange(0, max(1, size // 8) + 1)])
        if not b or den * len(a & b) < num * len(a | b):
            continue
        x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
        assert set(segment_keys(x, num, den)) & set(segment_keys(y, num, den))


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(5).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001)], "a bigint, b bigint").repartition(12)
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 300)}, 1001: 1000}


def test_gram_hashes_depend_on_their_words_only():
    h = word_hashes(b"a b c d e f g h a b c d e f g h".split())
    for k in (1, 2, 3, 5, 7, 8):
        g = gram_hashes(h, k)
        assert len(g) == 17 - k and len(set(g[: 9 - k + 8 - 8])) == max(0, 9 - k)
        assert (g[: max(0, 9 - k)] == g[8:]).all()


def brute_repeats(docs, length):
    first = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for j in range(len(w) - length + 1):
            run = tuple(w[j : j + length])
            first[run] = min(first.get(run, i), i)
    out = []
    for i, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - length + 1):
            if first[tuple(w[j : j + length])] < i:
                gone[j : j + length] = [True] * length
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out)


@pytest.mark.parametrize("length,seed", [(8, 3), (6, 6), (50, 20)])
def test_repeats_equal_brute_force(spark, length, seed):
    draw = random.Random(length)
    shared = [" ".join(f"s{draw.randrange(30)}" for _ in range(length + n)) for n in (-1, 0, 3, 40)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            parts.append(" ".join(f"u{draw.randrange(3000)}" for _ in range(draw.randrange(0, 30))))
            parts.append(draw.choice(shared))
        docs.append((draw.randrange(10_000), "\t".join(parts)))
    docs = list({i: (i, t) for i, t in docs}.values())
    docs += [(20_000 + i, docs[i][1]) for i in range(5)] + [(30_000, "loop " * 200)]
    got = cut_repeats(frame(spark, docs), length=length, seed=seed).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_repeats(docs, length)
    for r in got:
        assert sum(s.end - s.start for s in r.repeats) == r.n_removed
        assert all(s.end - s.start >= length for s in r.repeats)


def test_special_rows_of_repeats(spark):
    text = " ".join(f"w{i}" for i in range(12))
    docs = [(1, None), (2, ""), (None, text), (5, text), (5, text), (7, text)]
    cut = cut_repeats(frame(spark, docs), length=10, seed=4, carry=("text", "n"))
    assert cut.columns == ["doc_id", "text", "n", "n_words", "n_removed", "kept_text", "repeats"]
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_text, r.text) for r in cut.collect() if r.text)
    assert got == [(0, 12, 0, text, text), (2, 0, 0, "", "")][:1] + [(5, 12, 0, text, text)] * 2 + [(7, 12, 12, "", text)]
    assert cut_repeats(frame(spark, docs[:0])).count() == 0
