"""Hidden Markov language model (operator 6).

Words are counted over all training documents. The most frequent words are
word classes of their own; every other word belongs to the class of its last
three bytes. A text's probability is that of its class sequence under a hidden
Markov model, times each word's smoothed share of its class, so it is a proper
distribution over all texts, unseen words included.

Training is Baum-Welch on whole texts: each pass computes expected counts in
Arrow batches where the encoded texts lie, adds them up per block of classes in a
tree of shuffles, and re-estimates. The first passes go through the training
documents slice by slice (each document once) to give a starting point; then full
passes over all of them follow until one raises the log10 likelihood per token by
less than ``TOLERANCE``. Scores use the scaled forward recursion over whole texts.
All recursions are in double precision.

What is broadcast has a fixed size: the counts of at most ``HEAD`` words and a
table of classes by states. Counts of rarer words are joined.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import map_batches, signed, word_hashes
from casewright.session import staged

OWN = 12_288  # words with a class of their own, at most
ENDINGS = 4_096
HEAD = 262_144  # words whose counts are broadcast, at most
STATES = 8
SLICES = 8
TOLERANCE = 0.002  # gain of a full pass, log10 per token, below which training ends
FAN = 256  # partial sums added in one group of the tree
PRIOR = 20.0  # pseudo-counts of a state, spread like the classes overall
TOKENS = 1 << 18  # per array of the recursions
WIDE = 1 << 19  # the same in training: more texts step together
ROWS = 500  # texts that are lists of words at a time
PART = 2_048  # classes a row of partial counts holds


def _ending_class(words: list[bytes]) -> np.ndarray:
    ends = [w[-3:] for w in words]
    known = {e: xxhash.xxh3_64_intdigest(e) % ENDINGS for e in set(ends)}
    return np.fromiter((known[e] for e in ends), np.int64, len(ends))


def _texts(column) -> list[list[bytes]]:
    return [(x or b"").lower().split() for x in column.to_pylist()]


def _slices(batch):
    """A batch in parts, so that few words are Python objects at a time."""
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _count(batch):
    """Word, class of its ending and occurrences, added up over the batch."""
    parts = []
    for part in _slices(batch):
        texts = _texts(part.column(0))
        start = np.cumsum([0] + [len(x) for x in texts])
        word, first, times = np.unique(np.concatenate([word_hashes(x) for x in texts]), return_index=True, return_counts=True)
        doc = np.searchsorted(start, first, side="right") - 1
        ends = _ending_class([texts[d][i - start[d]] for d, i in zip(doc.tolist(), first.tolist())])
        parts.append((word, ends, times))
    word, ends, times = (np.concatenate(x) for x in zip(*parts))
    word, first, place = np.unique(word, return_index=True, return_inverse=True)
    total = np.bincount(place, times, minlength=len(word)).astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(signed(word)), pa.array(ends[first]), pa.array(total)], ["word", "ending", "c"]
    )


class Vocabulary:
    """The head's counts and classes, and the sums behind all classes."""

    def __init__(self, head_words, head_counts, ending_sums, ending_types, n, v, ends):
        order = np.argsort(head_words)
        self.words, self.counts = head_words[order], head_counts[order]
        own = np.argsort(-self.counts, kind="stable")[:OWN]
        self.classes = np.full(len(order), -1)
        self.classes[own] = np.arange(len(own))
        self.first_ending, self.end = len(own), len(own) + ENDINGS
        self.size = self.end + 1
        self.n, self.v, self.end_count = n, v, ends
        # Words of their own class are taken out of their endings' sums.
        self.ending_sums, self.ending_types = ending_sums, ending_types

    def encode(self, words: list[bytes]):
        """Classes with the end, hashes of words beyond the head, head counts (0 beyond)."""
        h = word_hashes(words)
        place = np.minimum(np.searchsorted(self.words, h), max(len(self.words) - 1, 0))
        known = self.words[place] == h if len(self.words) else np.zeros(len(h), bool)
        count = np.where(known, self.counts[place] if len(self.words) else 0, 0)
        cls = np.where(known, self.classes[place] if len(self.words) else -1, -1)
        loose = np.flatnonzero(cls < 0)
        cls[loose] = self.first_ending + _ending_class([words[i] for i in loose.tolist()])
        return np.append(cls, self.end), h, count, known


def _encode(value):
    def run(batch):
        for part in _slices(batch):
            yield from encode(part)

    def encode(batch):
        voc: Vocabulary = value.value
        floor = math.log10(voc.n + voc.v + 1)
        cols = {k: [] for k in ("classes", "tail", "n_known", "base", "inner", "n_tokens")}
        for words in _texts(batch.column(1)):
            cls, h, count, known = voc.encode(words)
            base = np.log10(count[known] + 1.0).sum() - len(h) * floor
            base += math.log10(voc.end_count + 1) - floor
            # Share of the class, for words of the head without a class of their own.
            shared = cls[:-1] - voc.first_ending
            mass = np.where(shared >= 0, voc.ending_sums[np.maximum(shared, 0)] + voc.ending_types[np.maximum(shared, 0)] + 1, 1.0)
            inner = -np.log10(mass).sum() + np.log10(count[known & (shared >= 0)] + 1.0).sum()
            cols["classes"].append(cls.astype(np.uint16).tobytes())
            cols["tail"].append(signed(h[~known]))
            cols["n_known"].append(int(known.sum()) + (voc.end_count > 0))
            cols["base"].append(float(base))
            cols["inner"].append(float(inner))
            cols["n_tokens"].append(len(cls))
        tail = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0] + [len(x) for x in cols["tail"]]), pa.int32()), pa.array(np.concatenate(cols["tail"]))
        )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(cols["n_tokens"], pa.int64()),
                pa.array(cols["n_known"], pa.int64()),
                pa.array(cols["base"]),
                pa.array(cols["inner"]),
                tail,
                pa.array(cols["classes"], pa.binary()),
            ],
            ["row", "n_tokens", "n_known", "base", "inner", "tail", "classes"],
        )

    return run


def in_steps(sequences: list[np.ndarray]):
    """Sequences, longest first, as one array by time step; ``width[t]`` of them reach step t."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lengths = np.array([len(sequences[i]) for i in order])
    width = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    start = np.concatenate([[0], np.cumsum(width)])
    flat = np.empty(start[-1], np.int64)
    for rank, i in enumerate(order):
        flat[start[: lengths[rank]] + rank] = sequences[i]
    return order, width, start, flat


def log_likelihood(sequences, start_p, move, emit) -> np.ndarray:
    """Natural log of each class sequence's probability, by the scaled forward recursion."""
    order, width, start, flat = in_steps(sequences)
    out = np.zeros(len(order))
    alpha = None
    for t, w in enumerate(width):
        seen = emit[flat[start[t] : start[t] + w]]
        alpha = seen * start_p if alpha is None else (alpha[:w] @ move) * seen
        scale = alpha.sum(1)
        alpha = alpha / scale[:, None]
        out[:w] += np.log(scale)
    back = np.empty(len(order))
    back[order] = out
    return back


def expected_counts(sequences, start_p, move, emit):
    """Expected starts, moves and emissions, and the log likelihood (Baum-Welch E step)."""
    order, width, start, flat = in_steps(sequences)
    at, first, k = start.tolist(), width[0], len(start_p)
    # A row per state, so that the long axis is contiguous.
    seen = np.take(np.ascontiguousarray(emit.T), flat, axis=1)
    alpha, beta, scale = np.empty_like(seen), np.ones_like(seen), np.empty(len(flat), emit.dtype)
    back, onto = np.ascontiguousarray(move), np.ascontiguousarray(move.T)
    now = alpha[:, :first]
    np.multiply(seen[:, :first], start_p[:, None], out=now)
    for a, b in zip(at, at[1:]):
        if a:
            last, now = now, alpha[:, a:b]
            np.matmul(onto, last[:, : b - a], out=now)
            now *= seen[:, a:b]
        np.add.reduce(now, 0, out=scale[a:b])
        now /= scale[a:b]
    seen /= scale
    for t in range(len(width) - 1, 0, -1):
        a, b = at[t], at[t + 1]
        onward = seen[:, a:b]
        onward *= beta[:, a:b]
        np.matmul(back, onward, out=beta[:, at[t - 1] : at[t - 1] + b - a])
    # The step before: the same sequence in the (wider) step before it.
    before = np.arange(first, len(flat)) - np.repeat(width[:-1], width[1:])
    moves = np.take(alpha, before, axis=1) @ seen[:, first:].T
    alpha *= beta
    emitted = np.stack([np.bincount(flat, row, minlength=len(emit)) for row in alpha], 1)
    return alpha[:, :first].sum(1), moves * move, emitted, float(np.log(scale).sum())


def _chunks(arrays, limit=TOKENS):
    """Groups of arrays of about ``limit`` elements, similar lengths together."""
    group, size = [], 0
    for i in sorted(range(len(arrays)), key=lambda i: len(arrays[i])):
        if group and size + len(arrays[i]) > limit:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(arrays[i])
    if group:
        yield group


def _e_step(value):
    """Sums of expected counts over a task's texts, a row for each block of classes."""

    def run(batches):
        start_p, move, emit = value.value
        total = None
        for batch in batches:
            texts = [np.frombuffer(raw, np.uint16) for raw in batch.column(0).to_pylist()]
            for group in _chunks(texts, WIDE):
                s, m, e, ll = expected_counts([texts[i] for i in group], start_p, move, emit)
                small = np.concatenate([s, m.ravel(), [ll, float(sum(len(texts[i]) for i in group))]])
                total = (small, e) if total is None else (total[0] + small, total[1] + e)
        if total is not None:
            parts = [(-1, total[0])] + [(i, total[1][i : i + PART].ravel()) for i in range(0, len(total[1]), PART)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in parts], pa.int32()),
                    pa.array([TaskContext.get().partitionId()] * len(parts), pa.int32()),
                    pa.array([x.astype(np.float64).tobytes() for _, x in parts], pa.binary()),
                ],
                ["part", "task", "sums"],
            )

    return run


SUMS = "part int, task int, sums binary"


def _add(table: pa.Table) -> pa.Table:
    """One row for the partial sums of one block of classes, added in the order of their tasks."""
    table = table.sort_by("task")
    total = sum(np.frombuffer(x.as_py(), np.float64) for x in table["sums"])
    kept = table.slice(0, 1)
    return kept.set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))


def _tree_sum(partial: DataFrame, tasks: int) -> dict[int, np.ndarray]:
    """Sums per block of classes; no group adds more than ``FAN`` rows of some 128 KB."""
    while tasks > 1:
        tasks = -(-tasks // FAN)
        level = partial.withColumn("task", F.floor(F.col("task") / FAN).cast("int"))
        partial = level.groupBy("part", "task").applyInArrow(_add, SUMS)
    return {r["part"]: np.frombuffer(bytes(r["sums"]), np.float64) for r in partial.collect()}  # fixed size


class Model:
    """Start, move and emission probabilities, re-estimated from sums of expected counts."""

    def __init__(self, prior: np.ndarray, states: int, seed: int):
        draw = np.random.default_rng(seed)
        self.prior = prior / prior.sum()
        self.start = np.full(states, 1 / states)
        self.move = np.full((states, states), 0.1 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
        if states > 1:
            np.fill_diagonal(self.move, 0.9)
        emit = self.prior[:, None] * np.exp(draw.normal(0, 0.3, (len(prior), states)))
        self.emit = emit / emit.sum(0)

    def params(self):
        return self.start, self.move, self.emit

    def update(self, start, moves, emitted):
        self.start = (start + 0.1) / (start + 0.1).sum()
        self.move = (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True)
        emit = emitted + PRIOR * self.prior[:, None]
        self.emit = emit / emit.sum(0)


def _pass(texts: DataFrame, model: Model) -> float | None:
    """One update; the log10 likelihood per token before it, None without texts."""
    states = len(model.start)
    value = texts.sparkSession.sparkContext.broadcast(model.params())
    partial = texts.select("classes").mapInArrow(_e_step(value), SUMS)
    got = _tree_sum(partial, partial.rdd.getNumPartitions())
    value.unpersist()
    if not got:
        return None
    small = got.pop(-1)
    emitted = np.concatenate([got[i].reshape(-1, states) for i in sorted(got)])
    model.update(small[:states], small[states : states + states**2].reshape(states, states), emitted)
    return small[-2] / math.log(10) / max(small[-1], 1)


def _train(texts: DataFrame, model: Model, slices: int, tolerance: float) -> list[float]:
    """A pass over each slice, then full ones to the tolerance; the likelihoods before each full pass."""
    for part in range(slices) if slices > 1 else ():
        _pass(texts.where(F.col("slice") == part), model)
    trace: list[float] = []
    while len(trace) < 2 or trace[-1] - trace[-2] >= tolerance:
        reached = _pass(texts, model)
        if reached is None:
            break
        trace.append(reached)
    return trace


def _score(value):
    def run(batch):
        start, move, emit = value.value
        seqs = [np.frombuffer(x, np.uint16) for x in batch.column(1).to_pylist()]
        out = np.zeros(len(seqs))
        for group in _chunks(seqs):
            out[group] = log_likelihood([seqs[i] for i in group], start, move, emit) / math.log(10)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["row", "hidden"])

    return run


def hmm_scores(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out=None,
    states: int = STATES,
    slices: int = SLICES,
    tolerance: float = TOLERANCE,
    seed: int = 42,
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row per row of ``docs``.

    ``held_out``: a boolean column; its rows are scored but not learnt from
    (null: learnt from). Words are lower-cased (A-Z); a text ends in one end
    token. ``base_score`` is the log10 probability under add-one word counts,
    ``score`` under the model. Null and empty texts are the end token alone.
    Repeated rows count as often as they occur. Other columns are not read.
    Long texts are one sequence each, in training and in scoring: memory grows
    by some 300 bytes a token of the longest text. Training ends with the first
    full pass that gains less than ``tolerance`` (log10 per token).
    """
    spark = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), held.alias("held_out"))

    counts = map_batches(rows.where(~F.col("held_out")).select("text"), _count, "word bigint, ending bigint, c bigint")
    counts = staged(counts.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("c").alias("c")))
    ends = rows.where(~F.col("held_out")).count()
    words, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # The head: all words above the count at which at most HEAD are left (steps of 1/32 octave).
    octave = F.floor(F.log2("c") * 32).cast("int")
    steps = counts.groupBy(octave.alias("o")).count().orderBy(F.col("o").desc()).collect()  # some 2,000 rows at most
    least, some = None, 0
    for o, n in steps:
        some += n
        if some > HEAD:
            break
        least = o
    head = counts.where(octave >= least).select("word", "c").toArrow() if least is not None else None
    head_words = head["word"].to_numpy().view(np.uint64) if head else np.empty(0, np.uint64)
    head_counts = head["c"].to_numpy() if head else np.empty(0, np.int64)
    voc = Vocabulary(head_words, head_counts, np.zeros(ENDINGS), np.zeros(ENDINGS), words + ends, types + bool(ends), ends)
    own = np.sort(signed(voc.words[voc.classes >= 0].copy()))
    own_words = spark.sparkContext.broadcast(own)  # at most OWN numbers

    def loose(batch):
        mask = ~np.isin(batch.column(0).to_numpy(), own_words.value)
        kept = batch.filter(pa.array(mask))
        yield pa.RecordBatch.from_arrays(kept.columns, ["word", "ending", "c"])

    rest = map_batches(counts, loose, "word bigint, ending bigint, c bigint")
    for ending, total, n in rest.groupBy("ending").agg(F.sum("c"), F.count("*")).collect():  # ENDINGS rows at most
        voc.ending_sums[ending], voc.ending_types[ending] = total, n

    value = spark.sparkContext.broadcast(voc)
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    keyed = keyed.select(F.struct("row", "id", "held_out").alias("row"), "text")
    encoded = map_batches(
        keyed,
        _encode(value),
        f"row struct<row:bigint,id:{dict(rows.dtypes)['id']},held_out:boolean>, n_tokens bigint, n_known bigint, "
        "base double, inner double, tail array<bigint>, classes binary",
    )
    encoded = encoded.select("row.*", "n_tokens", "n_known", "base", "inner", "tail", "classes")
    encoded = staged(encoded.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(max(1, slices))).cast("int")))

    prior = np.full(voc.size, 0.5)
    prior[: voc.first_ending] += np.sort(voc.counts)[::-1][: voc.first_ending]
    prior[voc.first_ending : voc.end] += voc.ending_sums
    prior[voc.end] += ends
    model = Model(prior, states, seed)
    _train(encoded.where(~F.col("held_out")), model, slices, tolerance)

    # Words beyond the head: occurrences per text meet their counts in a join.
    tail = encoded.select("row", F.explode("tail").alias("word"))
    rare = counts.where(octave < least) if least is not None else counts
    found = tail.join(rare.select("word", "c"), "word").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1.0)).alias("more"), F.count("*").alias("rare")
    )
    params = spark.sparkContext.broadcast(model.params())
    scored = map_batches(encoded.select("row", "classes"), _score(params), "row bigint, hidden double")
    more, rare_n = F.coalesce("more", F.lit(0.0)), F.coalesce("rare", F.lit(0))
    return (
        encoded.drop("tail", "classes")
        .join(staged(scored), "row")
        .join(found, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "held_out",
            "n_tokens",
            (F.col("n_known") + rare_n).cast("bigint").alias("n_known"),
            F.lit(int(words + ends)).cast("bigint").alias("train_tokens"),
            (F.col("base") + more).alias("base_score"),
            (F.col("hidden") + F.col("inner") + more).alias("score"),
        )
    )
