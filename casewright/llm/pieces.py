"""SentencePiece encoding and decoding of merge-type vocabularies (operator 11).

A text becomes symbols, one a character; adjacent pairs whose concatenation is
a piece wait in an agenda ordered by score, then by place, and the best pair is
merged until the agenda is empty. Characters without a piece fall back to the
pieces of their UTF-8 bytes, or to the unknown piece. Decoding reads pieces and
runs of byte pieces back and drops the blank that normalisation put in front.

A merge never crosses two characters that no piece holds side by side, so a
text is cut before blanks and between classes of characters that pieces never
mix (scripts, punctuation), and each cut has an agenda of its own; the cuts met before are remembered, the
last ``CUTS`` to twice ``CUTS`` of them a worker. Where some piece holds a blank inside, the whole text
is one cut.

Results: a null text encodes as an empty one, an empty text to no ids and an
empty decoded text. Null or repeated ids, repeated rows and further columns
change nothing: every row in gives one row out, in ``id`` and the new columns
only. A text of any length is encoded whole; a batch is worked off in slices of
about ``chars`` characters, so memory follows the longest text.

The library checks the batch: the cuts that a worker meets in it for the first
time (or again, once forgotten) are encoded by the library too, and all decoded
texts are read by the library as well. A difference fails the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.types import ArrayType, IntegerType, StringType

BLANK = "▁"
# A character no vocabulary of this kind merges; refused at loading where one does.
ALONE = "\n"
CUTS = 250_000
LONG_CUT = 64
# Up to so many characters the agenda is a plain list, beyond it a heap.
SHORT = 40
SLICE = 2_000_000
# A model file is sent to every task; larger ones are refused.
MODEL_BYTES = 32 << 20


class Pieces:
    """A merge-type vocabulary read through the library; encoding and decoding are done here."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        ids = range(n)
        self.piece = [self.library.id_to_piece(i) for i in ids]
        special = {i for i in ids if self.library.is_control(i) or self.library.is_unknown(i)}
        self.unknown = self.library.unk_id()
        self.byte_of = {i: int(self.piece[i][3:-1], 16) for i in ids if self.library.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.surface = [("" if i in special else p.replace(BLANK, " ")) for i, p in enumerate(self.piece)]
        if self.unknown >= 0:  # the library writes an unknown piece as its own text
            self.surface[self.unknown] = self.library.decode([self.unknown])
        self.raw = [bytes([self.byte_of[i]]) if i in self.byte_of else s.encode() for i, s in enumerate(self.surface)]
        self.id_of = {p: i for i, p in enumerate(self.piece) if i not in special and i not in self.byte_of}
        if any(self.library.is_unused(i) for i in ids):
            raise ValueError("vocabularies with unused pieces are not supported")
        long = [p for p in self.id_of if len(p) > 1]
        if any(ALONE in p for p in long):
            raise ValueError("vocabularies whose pieces hold line ends are not supported")
        scores = sorted({self.library.get_score(self.id_of[p]) for p in long}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}
        self.rank = {p: place[self.library.get_score(self.id_of[p])] for p in long}
        self.cuts = self._cut_pattern(long)
        self.known: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.fresh: list[tuple[str, tuple[int, ...]]] = []

    @staticmethod
    def _cut_pattern(long: list[str]) -> re.Pattern:
        """Stretches of a text that no merge leaves: blanks, then characters of one class.

        Characters are of one class where pieces hold them side by side, directly or in a chain.
        """
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in long):
            return re.compile(".+", re.DOTALL)
        kin: dict[str, str] = {}

        def first(c: str) -> str:
            while kin.setdefault(c, c) != c:
                c = kin[c]
            return c

        for p in long:
            own = p.lstrip(BLANK)
            for c, d in zip(own, own[1:] or own):
                kin[max(first(c), first(d))] = min(first(c), first(d))
        classes: dict[str, str] = {}
        for c in sorted(kin):
            classes[first(c)] = classes.get(first(c), "") + re.escape(c)
        runs = "|".join(f"[{c}]+" for c in sorted(classes.values(), key=len, reverse=True))
        word = f"{BLANK}*(?:{runs})|" if runs else ""
        return re.compile(f"{word}{BLANK}+|[^{''.join(classes.values())}{BLANK}]")

    def _alone(self, c: str) -> tuple[int, ...]:
        """Ids of a symbol that ends as a single character."""
        if c in self.id_of:
            return (self.id_of[c],)
        if len(self.id_of_byte) == 256:
            return tuple(self.id_of_byte[b] for b in c.encode())
        return (self.unknown,)

    def _encode_cut(self, cut: str) -> tuple[int, ...]:
        """Merge the symbols of one cut, best pair of the agenda first."""
        parts = self._merged_short(cut) if len(cut) <= SHORT else self._merged_long(cut)
        try:
            return tuple([self.id_of[p] for p in parts])
        except KeyError:
            return tuple(i for p in parts for i in ((self.id_of[p],) if len(p) > 1 else self._alone(p)))

    def _merged_short(self, cut: str) -> list[str]:
        """The agenda is the list of the neighbours' ranks: the least, leftmost first, is next."""
        rank, none = self.rank.get, len(self.rank)
        parts = list(cut)
        agenda = [rank(a + b, none) for a, b in zip(cut, cut[1:])]
        while agenda and (best := min(agenda)) < none:
            i = agenda.index(best)
            parts[i] = both = parts[i] + parts.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = rank(parts[i - 1] + both, none)
            if i < len(agenda):
                agenda[i] = rank(both + parts[i + 1], none)
        return parts

    def _merged_long(self, cut: str) -> list[str]:
        """The agenda is a heap of rank and place; entries whose parts have grown since are passed over."""
        rank, n = self.rank.get, len(cut)
        parts: list[str | None] = list(cut)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [to * n + i for i in range(n - 1) if (to := rank(cut[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            best, i = divmod(heappop(agenda), n)
            j = after[i]
            if parts[i] is None or j >= n or rank(parts[i] + parts[j]) != best:
                continue
            parts[i], parts[j] = both, _ = parts[i] + parts[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (to := rank(both + parts[k])) is not None:
                    heappush(agenda, to * n + i)
            h = before[i]
            if h >= 0 and (to := rank(parts[h] + both)) is not None:
                heappush(agenda, to * n + h)
        return [p for p in parts if p is not None]

    def _remember(self, cut: str) -> tuple[int, ...]:
        ids = self.old.get(cut)
        if ids is None:
            ids = self._encode_cut(cut)
            self.fresh.append((cut, ids))
        if len(cut) <= LONG_CUT:
            if len(self.known) >= CUTS:
                self.known, self.old = {}, self.known
            self.known[cut] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        cuts = self.cuts.findall(self.library.normalize(text))
        coded = list(map(self.known.get, cuts))
        if None in coded:
            coded = [ids or self.known.get(cut) or self._remember(cut) for ids, cut in zip(coded, cuts)]
        out = list(chain.from_iterable(coded))
        if len(self.id_of_byte) < 256 and self.unknown in out:  # neighbours without a piece are one
            out = [x for x, last in zip(out, [-1, *out]) if x != self.unknown or last != self.unknown]
        return out

    def check(self, texts: list[str], ids: list[list[int]], decoded: list[str]) -> None:
        """Hold what the last batch gave against the library.

        A cut is shown to the library behind a character that merges with nothing.
        Without byte pieces that character would join unknown neighbours, and the
        texts themselves are encoded again.
        """
        if len(self.id_of_byte) == 256:
            base = self.library.encode(ALONE)
            theirs = self.library.encode([ALONE + cut for cut, _ in self.fresh], num_threads=1)
            bad = [cut for (cut, own), x in zip(self.fresh, theirs) if x != [*base, *own]]
        else:
            bad = [t for t, own, x in zip(texts, ids, self.library.encode(texts, num_threads=1)) if x != own]
        self.fresh = []
        if bad:
            raise ValueError(f"ids differ from the library's for {bad[0][:80]!r}")
        for own, read in zip(decoded, self.library.decode(ids, num_threads=1)):
            if own != read:
                raise ValueError(f"decoded text differs from the library's for {own[:80]!r}")

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``; a byte that is part of no character reads as U+FFFD."""
        joined = b"".join([self.raw[i] for i in ids])
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = "".join(self._mended(ids))
        if not (self._dummy and text.startswith(" ")):
            return text
        first = next(i for i in ids if self.raw[i])
        return text if first == self.unknown or first in self.byte_of else text[1:]

    def _mended(self, ids: list[int]) -> Iterator[str]:
        run = bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        yield bytes(run[at : at + width]).decode()
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    yield "�"
                    at += 1
            run.clear()
            if i >= 0:
                yield self.surface[i]

    @property
    def _dummy(self) -> bool:
        """Whether normalisation puts a blank in front."""
        if not hasattr(self, "_puts_blank"):
            self._puts_blank = self.library.normalize("a").startswith(BLANK)
        return self._puts_blank


_LOADED: dict[bytes, Pieces] = {}


def loaded(model: bytes) -> Pieces:
    """The vocabulary of ``model``, read once a worker."""
    if model not in _LOADED:
        _LOADED.clear()
        _LOADED[model] = Pieces(model)
    return _LOADED[model]


def _slices(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def piece_ids(
    docs: DataFrame, model_path: str, text: str = "text", id: str = "doc_id", check: bool = True, chars: int = SLICE
) -> DataFrame:
    """``id``, ``ids`` (array) and ``decoded`` of every row, held against the library with ``check``."""
    with open(model_path, "rb") as file:
        model = file.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"the model file is above {MODEL_BYTES} bytes")
    loaded(model)  # a vocabulary that cannot be read is refused here
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = StructType(
        [
            StructField(id, docs.schema[id].dataType),
            StructField("ids", ArrayType(IntegerType(), False), False),
            StructField("decoded", StringType(), False),
        ]
    )

    def run(batches):
        vocabulary = loaded(shipped.value)
        for batch in batches:
            for start, end in _slices(batch.column(1).to_pylist(), chars):
                texts = batch.column(1).slice(start, end - start).to_pylist()
                ids = [vocabulary.encode(t) for t in texts]
                decoded = [vocabulary.decode(x) for x in ids]
                if check:
                    vocabulary.check(texts, ids, decoded)
                vocabulary.fresh.clear()
                own = batch.column(0).slice(start, end - start)
                out = [own, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(run, schema)
