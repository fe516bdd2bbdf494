"""Fill-in-the-middle transformation (operator 12).

A text is cut into units, blanks and the word after them; two seeded draws name
the units where the prefix and the middle end. Where the k-th unit ends is read
off a learned rank index: straight lines are fitted to all unit boundaries, each
over as many as it can pass within ``BOUND`` characters, and what a line misses
a boundary by is kept in one byte. A cut is the line's prediction plus that
residual, which is exact.

A row is ``plain`` where its text is empty or holds one of the three marks, or
where the draw says so; else its parts are written suffix first (``spm``) or
prefix first (``psm``), each behind its mark. ``restored`` reads the text back.

Results: a null text is an empty one, with no units, ``plain``. A null id draws
like an empty one. Rows that share an id draw alike, each row gives one row;
further columns are left out. Texts of any length are cut whole: memory follows
the longest text, four bytes a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from casewright.llm.common import map_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# What a line may miss a boundary by, in characters: residuals fit one signed byte.
BOUND = 127
SLICE = 4_000_000


def unit_ends(text: str) -> np.ndarray:
    """Code-point offsets where units end, 0 first: ``[blanks]*[others]+ | [blanks]+``."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4")
    blank = (c == 32) | ((c >= 9) & (c <= 13))
    shut = ~blank
    shut[:-1] &= blank[1:]
    ends = np.flatnonzero(shut) + 1
    tail = [len(c)] if len(c) and blank[-1] else []
    return np.concatenate([[0], ends, tail]).astype(np.int64)


class RankIndex:
    """Line segments through ``(rank, offset)`` of ascending offsets, with stored residuals."""

    def __init__(self, offsets: np.ndarray, bound: int = BOUND):
        self.n = len(offsets)
        starts, slopes, at = [], [], 0
        while at < self.n:
            length, slope = _reach(offsets[at:], bound)
            starts.append(at)
            slopes.append(slope)
            at += length
        self.starts = np.array(starts, np.int64)
        self.slopes = np.array(slopes)
        self.anchors = offsets[self.starts] if self.n else np.empty(0, np.int64)
        self.residuals = (offsets - self._line(np.arange(self.n))).astype(np.int8)

    def _line(self, rank: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.starts, rank, side="right") - 1
        return self.anchors[k] + np.rint(self.slopes[k] * (rank - self.starts[k])).astype(np.int64)

    def offset(self, rank: int) -> int:
        """The exact offset at ``rank``: the line's prediction and its residual."""
        rank = np.array([rank])
        return int((self._line(rank) + self.residuals[rank])[0])


def _reach(y: np.ndarray, bound: int) -> tuple[int, float]:
    """How many points from the first one line can pass within ``bound``, and its slope.

    The cone of slopes that pass all points so far only narrows; it is followed
    in steps that double, up to the point that empties it.
    """
    low, high, done, step = -np.inf, np.inf, 1, 64
    slack = bound - 0.5  # what is left for rounding the prediction
    while done < len(y):
        run = np.arange(done, min(done + step, len(y)))
        rise = (y[run] - y[0]).astype(float)
        lows = np.maximum.accumulate(np.maximum((rise - slack) / run, low))
        highs = np.minimum.accumulate(np.minimum((rise + slack) / run, high))
        empty = np.flatnonzero(lows > highs)
        if len(empty):
            k = empty[0]
            if k:
                low, high = lows[k - 1], highs[k - 1]
            done += int(k)
            break
        low, high = lows[-1], highs[-1]
        done += len(run)
        step *= 2
    return done, 0.0 if done == 1 else float((low + high) / 2)


def draws(seed: int, ident) -> list[int]:
    """Four 32-bit numbers from the digest of the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).digest()
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


def arrange(text: str, ident, seed: int, rate: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    ends = unit_ends(text)
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(seed, ident)
    if not text or h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    index = RankIndex(ends)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y = index.offset(a), index.offset(b)
    prefix, middle, suffix = text[:x], text[x:y], text[y:]
    if h4 % 100 < spm:
        return n, "spm", x, y - x, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", x, y - x, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(
    docs: DataFrame, text: str = "text", id: str = "doc_id", seed: int = 42, rate: int = 50, spm: int = 80, chars: int = SLICE
) -> DataFrame:
    """``id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` of every row.

    ``rate`` of 100 rows are transformed and ``spm`` of 100 of those put the suffix first.
    Results leave a task after about ``chars`` characters.
    """
    kind = docs.schema[id].dataType
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = StructType(
        [
            StructField(id, kind),
            StructField("n", LongType()),
            StructField("form", StringType()),
            StructField("prefix_chars", LongType()),
            StructField("middle_chars", LongType()),
            StructField("output", StringType()),
        ]
    )
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, cells, size, start = batch.column(0), [], 0, 0
        for i in range(batch.num_rows):
            body = batch.column(1)[i].as_py()
            cells.append(arrange(body, ids[i].as_py(), seed, rate, spm))
            size += len(body)
            if size >= chars or i + 1 == batch.num_rows:
                out = [pa.array(c, t) for c, t in zip(zip(*cells), types)]
                yield pa.RecordBatch.from_arrays([ids.slice(start, len(cells)), *out], schema.names)
                cells, size, start = [], 0, i + 1

    return map_batches(rows, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of: its parts lie between the marks, none of which a part can hold."""

    def between(first: str, then: str | None) -> Column:
        start = F.instr(output, first) + len(first)
        if then is None:
            return F.substr(output, start)
        return F.substr(output, start, F.instr(output, then) - start)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
