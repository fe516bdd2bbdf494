from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.llm import hmm
from casewright.llm.hashed_text import words_of
from casewright.llm.ordinal_quality import cumulative, cuts_of, grade_documents
from casewright.llm.toxicity import swap_table, swapper, toxicity_scores, without_toxic


def exact_likelihood(seq, start, move, emit):
    """Sum over all state paths."""
    total = 0.0
    for path in itertools.product(range(len(start)), repeat=len(seq)):
        p = start[path[0]] * emit[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= move[path[t - 1], path[t]] * emit[seq[t], path[t]]
        total += p
    return total


@pytest.fixture
def tiny_model():
    draw = np.random.default_rng(0)
    start, move, emit = draw.random(3), draw.random((3, 3)), draw.random((5, 3))
    return start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)


def test_forward_equals_sum_over_paths(tiny_model):
    seqs = [np.array(s) for s in ([0], [1, 4, 2], [3, 3, 0, 1, 2, 4], [2, 2])]
    got = hmm.log_likelihood(seqs, *tiny_model)
    assert np.allclose(np.exp(got), [exact_likelihood(s, *tiny_model) for s in seqs])


def test_expected_counts_equal_sums_over_paths(tiny_model):
    start, move, emit = tiny_model
    seq = np.array([1, 0, 4, 2])
    s, m, e, ll = hmm.expected_counts([seq, seq[:2]], start, move, emit)
    want_s, want_m, want_e = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for x in (seq, seq[:2]):
        total = exact_likelihood(x, start, move, emit)
        for path in itertools.product(range(3), repeat=len(x)):
            p = start[path[0]] * np.prod([move[a, b] for a, b in zip(path, path[1:])]) * np.prod(emit[x, list(path)]) / total
            want_s[path[0]] += p
            for a, b in zip(path, path[1:]):
                want_m[a, b] += p
            for c, j in zip(x, path):
                want_e[c, j] += p
    assert np.allclose(s, want_s) and np.allclose(m, want_m) and np.allclose(e, want_e)
    assert np.isclose(ll, sum(np.log(exact_likelihood(x, start, move, emit)) for x in (seq, seq[:2])))


def test_repeated_passes_raise_the_likelihood(tiny_model):
    draw = np.random.default_rng(1)
    seqs = [draw.integers(0, 5, draw.integers(1, 30)) for _ in range(40)]
    params, last = tiny_model, -np.inf
    for _ in range(6):
        s, m, e, ll = hmm.expected_counts(seqs, *params)
        assert ll >= last - 1e-9
        params, last = (s / s.sum(), m / m.sum(1, keepdims=True), e / e.sum(0)), ll


def test_training_is_baum_welch_on_whole_texts(spark, monkeypatch):
    """Full passes through Spark equal the plain updates, to the stated gain; sums go through a deep tree."""
    monkeypatch.setattr(hmm, "FAN", 2)
    draw = np.random.default_rng(5)
    texts = [draw.integers(0, 6, n).astype(np.uint16) for n in (1, 700, 3, 40, 41, 300, 2, 5_000)]
    df = spark.createDataFrame([(x.tobytes(), 0) for x in texts], "classes binary, slice int").repartition(7)
    model, plain = (hmm.Model(np.ones(6), 3, 42) for _ in range(2))
    trace = hmm._train(df, model, 1, 1e-4)
    want, tokens = [], sum(map(len, texts))
    while len(want) < 2 or want[-1] - want[-2] >= 1e-4:
        s, m, e, ll = hmm.expected_counts(texts, *plain.params())
        plain.update(s, m, e)
        want.append(ll / np.log(10) / tokens)
    assert len(trace) > 2 and np.allclose(trace, want)
    assert all(np.allclose(a, b) for a, b in zip(model.params(), plain.params()))


def lm_docs(spark):
    draw = random.Random(0)
    tongues = [[f"{a}{i}" for i in range(40)] for a in ("ka", "lo", "mi")]
    rows = [(i, " ".join(draw.choice(tongues[i % 3]) for _ in range(30))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, "Unseen WORDS only"), (None, "ka1 ka2"), (1, rows[1][1])]
    return rows, spark.createDataFrame([(i, t, 1.0, "r") for i, t in rows], "doc_id bigint, text string, base double, row string")


def test_hmm_scores_against_plain_counts(spark):
    rows, docs = lm_docs(spark)
    held = F.col("doc_id") % 5 == 2
    got = hmm.hmm_scores(docs, held_out=held, states=4, slices=2).collect()
    assert len(got) == len(rows)
    train = [t for i, t in rows if i is None or i % 5 != 2]
    count = {}
    for t in train:
        for w in [*(t or "").lower().split(), None]:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    by_id = {r.doc_id: r for r in got}
    gain = 0.0
    for i, t in rows:
        words = [*(t or "").lower().split(), None]
        r = by_id[i]
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(words), n, i is not None and i % 5 == 2)
        assert r.n_known == sum(w in count for w in words)
        assert r.base_score == pytest.approx(sum(np.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in words))
        assert r.score < 0
        gain += (r.score - r.base_score) * r.held_out
    assert gain > 0  # better than word counts on texts it has not seen
    assert hmm.hmm_scores(docs.limit(0)).count() == 0


def test_word_shares_sum_to_one():
    """All words of a vocabulary and an unseen one per ending class make up probability one."""
    words = [f"w{i}".encode() for i in range(50)]
    h = hmm.word_hashes(words)
    counts = np.arange(1, 51)
    voc = hmm.Vocabulary(h, counts, np.zeros(hmm.ENDINGS), np.zeros(hmm.ENDINGS), int(counts.sum()) + 3, 51, 3)
    assert voc.size == 50 + hmm.ENDINGS + 1
    cls, _, count, known = voc.encode(words)
    assert known.all() and (count == counts).all()
    assert len(set(cls[:-1].tolist())) == 50 and cls[-1] == voc.end


TOXIC = ("idiot", "scum")


def toxic_docs(spark, n=300):
    """Toxic texts mention one group more often; insults decide."""
    draw = random.Random(4)
    rows, marks = [], []
    for i in range(n):
        toxic = i % 3 == 0
        words = [f"p{draw.randrange(80)}" for _ in range(draw.randrange(5, 40))]
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(TOXIC))
        if draw.random() < (0.8 if toxic else 0.05):
            words.append("muslims")
        elif draw.random() < 0.3:
            words.append("christians")
        rows.append((i, " ".join(words), "s"))
        if i % 10:
            marks.append((i, int(toxic), None))
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string, score string"),
        spark.createDataFrame(marks, "doc_id bigint, toxic int, text string"),
    )


def test_toxicity_on_texts_not_learnt_from(spark):
    docs, labels = toxic_docs(spark, 900)
    got = toxicity_scores(docs, labels, held_out=F.col("doc_id") % 4 == 1).collect()
    assert len(got) == 900 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    right = [r.predicted == (r.doc_id % 3 == 0) for r in got if r.held_out]
    assert sum(right) / len(right) > 0.95


def test_tie_reduces_the_effect_of_a_group_term(spark):
    docs, labels = toxic_docs(spark)
    probe = spark.createDataFrame([(9001, "p1 p2 muslims", ""), (9002, "p1 p2 christians", "")], docs.schema)
    gap = {}
    for tie in (0.0, 5.0):
        got = {r.doc_id: r.score for r in toxicity_scores(docs.unionAll(probe), labels, tie=tie).collect()}
        gap[tie] = got[9001] - got[9002]
        assert got[9001] < 0.5 or not tie
    assert abs(gap[5.0]) < abs(gap[0.0])


def test_special_rows_of_toxicity(spark):
    docs, labels = toxic_docs(spark, 60)
    odd = spark.createDataFrame([(None, "scum idiot", ""), (70, None, ""), (71, "", ""), (71, "", "")], docs.schema)
    assert toxicity_scores(docs.unionAll(odd), labels).count() == 64
    kept = without_toxic(docs.unionAll(odd), labels)
    assert kept.columns == docs.columns and kept.where("doc_id in (70, 71)").count() == 3
    assert toxicity_scores(docs.limit(0), labels).count() == 0
    none = toxicity_scores(docs, labels.limit(0)).collect()
    assert all(r.score < 0.5 and r.predicted == 0 for r in none) and len({r.score for r in none}) == 1
    assert without_toxic(docs, labels.limit(0)).count() == 60


def test_swaps_keep_other_words():
    swap = swapper(swap_table((("men", "women"),)))
    assert swap("Men and women, omens") == "women and men, omens" and swap("omens") is None
    assert words_of("A-b, c!") == {b"a", b"b", b"c"}


def test_cumulative_gradient():
    draw = np.random.default_rng(2)
    z, y, params = draw.normal(size=20), draw.integers(0, 4, 20).astype(float), np.array([-0.5, 0.1, -0.7])
    _, dz, dp = cumulative(z, y, params)
    eps = 1e-6
    for i in range(3):
        up, down = params.copy(), params.copy()
        up[i] += eps
        down[i] -= eps
        assert dp[i] == pytest.approx((cumulative(z, y, up)[0] - cumulative(z, y, down)[0]) / (2 * eps), abs=1e-4)
    for i in range(5):
        up, down = z.copy(), z.copy()
        up[i] += eps
        down[i] -= eps
        assert dz[i] == pytest.approx((cumulative(up, y, params)[0] - cumulative(down, y, params)[0]) / (2 * eps), abs=1e-4)
    assert (np.diff(cuts_of(params)) > 0).all()


def test_grades_follow_the_words(spark):
    draw = random.Random(6)
    words = {0: "junk", 1: "fair", 2: "fine"}
    rows = [(i, " ".join([words[i % 3], *(f"q{draw.randrange(60)}" for _ in range(15))])) for i in range(240)]
    docs = spark.createDataFrame([*rows, (500, None), (501, ""), (None, "fine")], "doc_id bigint, text string")
    rated = spark.createDataFrame(
        [(i, i % 3) for i, _ in rows if i % 4] + [(0, 7), (3, None)], "doc_id bigint, grade int"
    )
    got = grade_documents(docs, rated).collect()
    assert len(got) == 243
    mean = {g: np.mean([r.expected_grade for r in got if r.doc_id in range(0, 240, 4) and r.doc_id % 3 == g]) for g in words}
    assert mean[0] < 0.7 < mean[1] < 1.5 < mean[2]
    for r in got:
        assert r.tails[0] >= r.tails[1] and r.kept == (r.tails[0] >= 0.5) and r.tail_probability == r.tails[0]
    assert grade_documents(docs.limit(0), rated).count() == 0
    assert grade_documents(docs, rated.limit(0)).count() == 243
