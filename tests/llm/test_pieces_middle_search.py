from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.llm import lexical, queries
from casewright.llm.lexical import Postings, ranked_documents, terms_of
from casewright.llm.middle import RankIndex, fill_in_middle, restored, unit_ends
from casewright.llm.pieces import Pieces, piece_ids

tokenizers = pytest.importorskip("public_tokenizers")
MODEL = tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "   ", "▁", " a", "a ", "\n\n", "é😀漢字\u0000x", "<s></s><unk><0x41>", "a" * 3000, "▁▁a ▁b", "\t x\r\n\x0b",
    "don't 1234567 ..", "​﻿ á", " " * 90 + "x", "ﬁ Å Å", "\x85\xa0x y", "İıſK", "e" * 70 + "漢" * 70,
]


def noise(draw, n):
    return "".join(draw.choice("aetion  thr.,\n▁é漢😀\x00<SPM>1") for _ in range(n))


@pytest.fixture(scope="module")
def vocabulary():
    with open(MODEL, "rb") as file:
        return Pieces(file.read())


def test_pieces_equal_the_library(vocabulary):
    draw = random.Random(1)
    for text in [*ODD, *(noise(draw, draw.randrange(400)) for _ in range(300)), noise(draw, 100_000)]:
        ids = vocabulary.library.encode(text)
        assert vocabulary.encode(text) == ids
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids)


def test_any_ids_decode_as_the_library_does(vocabulary):
    draw = random.Random(2)
    few = [0, 1, 2, vocabulary.id_of["▁"], vocabulary.id_of["▁▁"], *vocabulary.id_of_byte.values()]
    for _ in range(3000):
        ids = [draw.choice(few) if draw.random() < 0.7 else draw.randrange(32000) for _ in range(draw.randrange(8))]
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids), ids


def test_cuts_remembered_or_not_give_the_same(vocabulary, monkeypatch):
    text = noise(random.Random(3), 5000)
    want = vocabulary.encode(text)
    monkeypatch.setattr("casewright.llm.pieces.CUTS", 3)
    vocabulary.known, vocabulary.old = {}, {}
    assert vocabulary.encode(text) == want and len(vocabulary.known) + len(vocabulary.old) <= 6


def test_agenda_takes_the_best_pair_first(vocabulary):
    """Against a plain search for the best pair of all neighbours."""
    draw = random.Random(4)
    for _ in range(200):
        cut = "▁" + "".join(draw.choice("abcdenrstio") for _ in range(draw.randrange(1, 20)))
        parts = list(cut)
        while True:
            pairs = [
                (-vocabulary.library.get_score(vocabulary.id_of[a + b]), i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in vocabulary.id_of
            ]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert vocabulary._merged_short(cut) == vocabulary._merged_long(cut) == parts


def test_check_finds_differences(vocabulary):
    own = Pieces(vocabulary.library.serialized_model_proto())
    texts = [*ODD, noise(random.Random(9), 3000)]
    ids = [own.encode(t) for t in texts]
    decoded = [own.decode(x) for x in ids]
    assert own.fresh
    own.check(texts, ids, decoded)
    with pytest.raises(ValueError, match="decoded"):
        own.check(texts, ids, [*decoded[:-1], "?"])
    del own.rank["▁the"]
    own.known, own.old = {}, {}
    own.encode("then the")
    with pytest.raises(ValueError, match="ids"):
        own.check([], [], [])


def test_piece_table(spark, vocabulary):
    texts = [*ODD, None, ODD[3]]
    rows = [(i if i != 4 else None, t, i, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, decoded string")
    got = piece_ids(docs, MODEL, chars=500)
    assert got.columns == ["doc_id", "ids", "decoded"]
    lib, plain = vocabulary.library, lambda i: -1 if i is None else i
    want = sorted((plain(i), lib.encode(t or ""), lib.decode(lib.encode(t or ""))) for i, t, *_ in rows)
    assert sorted((plain(r.doc_id), r.ids, r.decoded) for r in got.collect()) == want
    assert piece_ids(docs.limit(0), MODEL, check=False).count() == 0


def test_piece_query_equals_the_library(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for d in docs:
        ids = vocabulary.library.encode(d.text or "")
        want.add((d.doc_id, len(ids), digest(",".join(map(str, ids))), digest(vocabulary.library.decode(ids))))
    got = queries.QUERIES["op11_piece_ids"](spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(docs)


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.mark.parametrize("bound", [1, 4, 127])
def test_rank_index_is_exact(bound):
    draw = random.Random(5)
    texts = [*ODD, noise(draw, 20_000), "x " * 5000 + "y" * 9000 + " z" * 3000, "a" * 40_000 + " b", " ".join("w" * (i % 700) for i in range(1500))]
    for text in texts:
        want = [0]
        for unit in UNIT.findall(text):
            want.append(want[-1] + len(unit))
        ends = unit_ends(text)
        assert ends.tolist() == want
        index = RankIndex(ends, bound)
        assert [index.offset(k) for k in range(len(want))] == want
        assert np.abs(index.residuals.astype(int)).max(initial=0) <= bound


def plain_fim(ident, text):
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"42:{ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 80 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < 80 else "psm", len(p), len(m), out


def test_fill_in_middle_equals_plain_cuts(spark):
    draw = random.Random(6)
    texts = [*ODD, "x<P>y", "a <S", "S> b <", *(noise(draw, draw.randrange(300)) for _ in range(300)), "long " * 60_000, None]
    rows = [(i, t, "q") for i, t in enumerate(texts)] + [(None, "some words here", "q"), (25, texts[25], "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, form string")
    got = fill_in_middle(docs, chars=700).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    for (i, t, _), r in zip(sorted(rows, key=order), sorted(got, key=order), strict=True):
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim("" if i is None else i, t or "")
        assert r.doc_id == i and r.back == (t or "")
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    assert fill_in_middle(docs.limit(0)).count() == 0
    assert fill_in_middle(docs, rate=0).where("form <> 'plain'").count() == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for q, t in items:
        asked.setdefault(q, set()).update(plain_terms(t))
    out = []
    for q, terms in asked.items():
        found = []
        for i, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(q, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return out


def corpus(draw, n):
    word = lambda: f"w{int(draw.paretovariate(0.7)) % 400}"
    docs = [(i, " ".join(word() for _ in range(draw.randrange(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(40)]  # ties of exact copies
    docs += [(2, docs[2][1]), (None, docs[2][1]), (None, docs[2][1]), (n + 50, None), (n + 51, ""), (n + 52, " ... --")]
    docs += [(n + 53, "W1 w1, É w2-W3 é"), (n + 54, "w1 " * 30_000)]
    items = [(q, " ".join(word() for _ in range(draw.randrange(1, 15)))) for q in range(25)]
    items += [(3, "w3 É"), (None, "w1 w5"), (90, None), (91, "?!"), (92, "nowhere é"), (93, docs[3][1])]
    return docs, items


def test_terms():
    for text in [*ODD, "A-z_0@9Ü|é`{}~\x7f\x80x", "Ab[c]^D"]:
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("batch, block", [(20_000, 50_000), (17, 60)])
def test_search_equals_brute_force(spark, batch, block):
    """With small batches the best found are carried on; with small blocks the queries run in several."""
    docs, items = corpus(random.Random(7), 300)
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id bigint, text string, score int").repartition(3)
    b = spark.createDataFrame([(q, t, "x") for q, t in items], "item_id bigint, text string, rank string")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch))
    try:
        got = ranked_documents(d, b, block=block).collect()
    finally:
        spark.conf.set(key, before)
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(plain_search(docs, items, 10), key=order)
    assert ranked_documents(d.limit(0), b).count() == 0 and ranked_documents(d, b.limit(0)).count() == 0


def test_reads_stop_before_the_lists_end(monkeypatch):
    """A few documents far ahead settle membership after the first rounds of reads."""
    monkeypatch.setattr(lexical, "FIRST_READ", 8)
    draw = np.random.default_rng(8)
    docs, lists = 20_000, 4
    impact = draw.integers(1, 50, (docs, lists))
    impact[:12] += 1000 * np.arange(12, 0, -1)[:, None]
    found = Postings(np.repeat(np.arange(docs), lists), np.tile(np.arange(lists), docs), impact.ravel(), docs, lists)
    read = []
    real = found.doc

    class Watched:
        def __getitem__(self, part):
            read.append(part.stop - part.start)
            return real[part]

    found.doc = Watched()
    at, score = found.best(np.arange(lists), 10, [])
    want = impact.sum(axis=1)
    assert sorted(at)[:10] == list(range(10)) and all(want[at] == score) and sum(read) < 1000
    found.doc = real
    best = sorted(zip(*found.best(np.arange(lists), 500, [])), key=lambda r: (-r[1], r[0]))[:500]
    assert [i for i, _ in best] == np.lexsort((np.arange(docs), -want))[:500].tolist()
    assert len(found.best(np.arange(lists), 10, [10**9] * 10)[0]) == 0
