"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reports, in one pass over the
text, each piece that ends at a position (its output links, longest first).
A Viterbi pass follows them and keeps at each position the best last piece
with the position where it starts.

What "best" means depends on the model's kind. A unigram model's pieces
have log probabilities: the largest sum wins. A BPE model's scores are the
order of its merges and their sum says nothing; there a prefix's last piece
must be one that the merges would leave beside the piece before it (two
pieces stand side by side if merging their joined text gives back the two),
and exactly one piece at each position can. So either kind gives the
library's own ids. The test of two pieces is kept for later texts.

No piece runs over a new word's mark, so a text is handled word by word and
a word's ids are kept in a bounded table of the worker. A BPE model's new words
of many texts go through the two passes together: one run of the automaton
over all of them, then numpy follows the output links of all words at once,
position by position. Characters without a piece become bytes. The vocabulary is fixed in size and read on the driver
once; tasks get it as a broadcast value.

Null and empty texts have no ids. As in the library, the mark U+2581 in a
text reads back as a space; all else reads back as it was.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, StringType, StructType

from .common import chunks, ship

MARK = "▁"
#: Words, characters of words and pairs of pieces kept by a worker; beyond
#: that the table starts anew. A word of more than LONG_WORD characters (text
#: written without spaces) isn't kept.
WORDS_KEPT = 600_000
CHARS_KEPT = 4_000_000
LONG_WORD = 64
PAIRS_KEPT = 1_000_000
#: Characters of new words searched together, and the array of latest tests
#: of two pieces that numpy looks them up in (2 to this power).
TOGETHER_CHARS = 100_000
SLOT_BITS = 20
UNSET = -3

#: What a text may be cut into, finest first: words by letters and other
#: characters, words, the whole.
PARTS = (f"{MARK}*[{{letters}}]+|{MARK}*[^{MARK}{{letters}}]+|{MARK}+", f"{MARK}+[^{MARK}]*|^[^{MARK}]+", "(?s:.+)")

UNIGRAM, BPE = "unigram", "bpe"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, their scores and kinds ('n'ormal, 'b'yte, other)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str
    unknown: int
    model: str = BPE
    prefix: bool = True  # the model puts a space before the text

    @staticmethod
    def read(path: str, model: str = BPE) -> Vocabulary:
        """From a model file. The vocabulary is all that is taken from it."""
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        kinds = "".join("b" if sp.is_byte(i) else "x" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
                        else "n" for i in range(n))
        return Vocabulary(tuple(sp.id_to_piece(i) for i in range(n)), tuple(sp.get_score(i) for i in range(n)),
                          kinds, sp.unk_id(), model)


@dataclass
class Codec:
    """Encoder and decoder of one worker."""

    voc: Vocabulary
    ids: dict[str, int] = field(init=False)
    kept: dict[str, bytes] = field(default_factory=dict)
    kept_chars: int = 0
    pairs: dict[int, bool] = field(default_factory=dict)
    slots: np.ndarray = field(init=False)

    def __post_init__(self):
        voc = self.voc
        self.ids = {p: i for i, p in enumerate(voc.pieces) if voc.kinds[i] == "n"}
        self.score = {p: voc.scores[i] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(voc.pieces) if voc.kinds[i] == "b"}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.alphabet = frozenset(p for p in self.ids if len(p) == 1)
        self.plain = np.array([k == "n" for k in voc.kinds])
        self.special = frozenset(i for i, k in enumerate(voc.kinds) if k == "x")
        self.sizes = np.array([len(p) for p in voc.pieces])
        self.slots = np.full(1 << SLOT_BITS, np.iinfo(np.int64).min)
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        # parts of a text may be handled alone if no piece runs from one into the next;
        # where a part ends depends on two neighbouring characters only
        letters = re.escape("".join(sorted(c for c in set().union(*self.ids) if c.isalpha()))) or MARK
        parts = [re.compile(p.replace("{letters}", letters)) for p in PARTS]
        self.words = next(w for w in parts if all(w.findall(p) == [p] for p in self.ids))
        self.search = self._merged if voc.model == BPE else self._summed
        self.sized = self.sizes.tolist()

    def merge(self, text: str) -> list[str]:
        """Pieces left by the merges, best score first, leftmost first."""
        score, none = self.score.get, -math.inf
        out = list(text)
        joins = [score(a + b, none) for a, b in zip(out, out[1:])]
        while joins:
            best = max(joins)
            if best == none:
                break
            k = joins.index(best)
            out[k:k + 2] = [out[k] + out[k + 1]]
            del joins[k]
            if k:
                joins[k - 1] = score(out[k - 1] + out[k], none)
            if k < len(joins):
                joins[k] = score(out[k] + out[k + 1], none)
        return out

    def beside(self, a: int, b: int) -> bool:
        """Whether merging leaves the two pieces side by side (``a`` -1: the one piece alone)."""
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        p = self.voc.pieces
        alone = [p[b]] if a < 0 else [p[a], p[b]]
        got = self.pairs[a << 24 | b] = self.merge("".join(alone)) == alone
        return got

    def _merged(self, text: str) -> tuple[list, list]:
        """last, start: at each position the one piece that can end there, and where it starts."""
        n = len(text)
        last: list = [None] * (n + 1)
        start = [0] * (n + 1)
        last[0] = -1  # no piece before
        pairs, beside, sized = self.pairs, self.beside, self.sized
        if not self.alphabet.issuperset(text):  # -2: a character that has no piece
            for e, c in enumerate(text, 1):
                if c not in self.alphabet:
                    last[e], start[e] = -2, e - 1
        for end, i in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                size = sized[i]
                before = last[end - size]
                if before is not None:
                    if before == -2:
                        before = -1
                    ok = pairs.get(before << 24 | i)
                    if ok or (ok is None and beside(before, i)):
                        last[end] = i
                        start[end] = end - size
        return last, start

    def _summed(self, text: str) -> tuple[list, list]:
        """last, start: the piece that ends the best-scored split of each prefix."""
        n = len(text)
        worst = min(self.voc.scores) - 10.0
        best = [0.0] + [None] * n
        last: list = [-1] + [None] * n
        start = [0] * (n + 1)
        found = self.automaton.iter(text)
        hit = next(found, None)
        for e in range(1, n + 1):
            best[e], last[e], start[e] = best[e - 1] + worst, -2, e - 1
            while hit is not None and hit[0] + 1 == e:
                i = hit[1]
                size = self.sized[i]
                s = best[e - size] + self.voc.scores[i]
                if s > best[e]:
                    best[e], last[e], start[e] = s, i, e - size
                hit = next(found, None)
        return last, start

    def word(self, text: str) -> bytes:
        """The ids of one word, as 32-bit integers."""
        last, start = self.search(text)
        out: list[int] = []
        e = len(text)
        while e > 0:
            i, s = last[e], start[e]
            if i == -2:
                coded = text[s:e].encode("utf-8", "surrogatepass")
                out.extend([self.bytes[b] for b in reversed(coded)] if self.bytes else [self.voc.unknown])
            else:
                out.append(i)
            e = s
        out.reverse()
        return array("i", out).tobytes()

    def _beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``beside`` of many pairs."""
        key = a << 24 | b
        slot = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).view(np.int64)
        held = self.slots[slot]
        missing = np.flatnonzero(held >> 1 != key)
        if missing.size:
            pairs = self.pairs
            for j in missing.tolist():
                ok = pairs.get(int(key[j]))
                held[j] = key[j] << 1 | (self.beside(int(a[j]), int(b[j])) if ok is None else ok)
            self.slots[slot[missing]] = held[missing]
        return (held & 1).astype(bool)

    def together(self, words: Sequence[str]) -> list[bytes]:
        """``word`` of each, for a BPE model and characters that all have pieces."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        first = np.zeros(len(words) + 1, np.int64)  # a word's first position; it has one more than characters
        np.cumsum(lengths + 1, out=first[1:])
        found = np.fromiter(chain.from_iterable(self.automaton.iter("".join(words))), np.int64).reshape(-1, 2)
        of = np.repeat(np.arange(len(words)), lengths)[found[:, 0]]
        end, piece = found[:, 0] + of + 1, found[:, 1]
        begin = end - self.sizes[piece]
        inside = begin >= first[of]
        of, end, piece, begin = of[inside], end[inside], piece[inside], begin[inside]
        # by distance from the word's start, then as found: longest first
        new = np.ones(len(end), bool)
        new[1:] = end[1:] != end[:-1]
        at = np.arange(len(end))
        turn = at - np.maximum.accumulate(np.where(new, at, 0))
        step = (end - first[of]) * (int(turn.max(initial=0)) + 1) + turn
        order = np.argsort(step, kind="stable")
        end, piece, begin, step = end[order], piece[order], begin[order], step[order]
        last = np.full(first[-1], UNSET)
        last[first[:-1]] = -1  # no piece before
        start = np.zeros(first[-1], np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(step)]
        for x, y in zip(cuts, cuts[1:]):
            e, b, p = end[x:y], begin[x:y], piece[x:y]
            before = last[b]
            open_ = np.flatnonzero((last[e] == UNSET) & (before != UNSET))
            good = open_[self._beside(before[open_], p[open_])]
            last[e[good]] = p[good]
            start[e[good]] = b[good]
        path = np.zeros(first[-1], bool)
        now, stop = first[1:] - 1, first[:-1]
        while now.size:
            path[now] = True
            now = start[now]
            more = now > stop
            now, stop = now[more], stop[more]
        ids = last[path].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(path)[first[1:] - 1]).tolist()
        return [ids[x:y] for x, y in zip([0, *ends], ends)]

    def learn(self, words: set[str]) -> None:
        """Keep the ids of words."""
        plain = []
        for w in words:
            if self.voc.model == BPE and self.alphabet.issuperset(w):
                plain.append(w)
            else:
                self.kept[w] = self.word(w)
        for x, y in chunks(plain, TOGETHER_CHARS):
            self.kept.update(zip(plain[x:y], self.together(plain[x:y])))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, as 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        out = []
        for x, y in chunks(texts):
            out += self._encode(texts[x:y])
        return out

    def _encode(self, texts: Sequence[str | None]) -> list[bytes]:
        start = MARK if self.voc.prefix else ""
        split = [self.words.findall(start + t.replace(" ", MARK)) if t else [] for t in texts]
        kept, word = self.kept, self.word
        short = {w for w in set().union(*split) if len(w) <= LONG_WORD}
        new = short.difference(kept)
        size = sum(map(len, new))
        if len(kept) + len(new) > WORDS_KEPT or self.kept_chars + size > CHARS_KEPT:
            kept.clear()
            self.kept_chars = 0
            new, size = short, sum(map(len, short))
        if len(new) <= WORDS_KEPT and size <= CHARS_KEPT:  # else one text with more than is kept
            self.learn(new)
            self.kept_chars += size
        return [b"".join([kept.get(w) or word(w) for w in words]) for words in split]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, dtype=np.int32)
        p = self.voc.pieces
        if self.plain[ids].all():
            text = "".join([p[i] for i in ids.tolist()])
        else:
            out, run = [], bytearray()
            for i in ids.tolist():
                b = self.byte_of.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                if i == self.voc.unknown:
                    out.append(" \u2047 ")
                elif i not in self.special:  # marks of a text's ends say nothing
                    out.append(p[i])
            out.append(run.decode("utf-8", "replace"))
            text = "".join(out)
        text = text.replace(MARK, " ")
        return text[1:] if self.voc.prefix and text[:1] == " " else text


_CODECS: dict[Vocabulary, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec; later tasks of the worker find its tables filled."""
    voc = shared.value
    key = hash(voc)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(voc)
    return _CODECS[key]


def _mapped(docs: DataFrame, col: str, voc: Vocabulary, new: list[tuple[str, DataType]], make) -> DataFrame:
    """``docs`` without ``col`` and any column named as a new one, and the
    new columns: ``make`` turns a list of values into Arrow arrays."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(voc)
    names = {n for n, _ in new}
    rest = [c for c in docs.columns if c != col and c not in names]
    value = "_value"
    while value in rest:
        value += "_"
    schema = StructType([docs.schema[c] for c in rest])
    for n, kind in new:
        schema = schema.add(n, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for b in batches:
            values = b.column(b.num_columns - 1)
            step = 512  # so that a batch of long texts is not held many times over
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                made = make(codec, values.slice(i, step).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], [*rest, *names_in_order])

    names_in_order = [n for n, _ in new]
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{col}`").alias(value)).mapInArrow(run, schema)


def _lists(rows: list[bytes]) -> pa.ListArray:
    ends = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=ends[1:])
    flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(rows))])
    return pa.ListArray.from_arrays(pa.array(ends), flat)


def encode(docs: DataFrame, voc: Vocabulary, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) and ``n_ids`` in place of the text."""
    def make(codec: Codec, texts: list) -> list:
        rows = codec.encode_all(texts)
        return [_lists(rows), pa.array([len(r) // 4 for r in rows], pa.int32())]

    return _mapped(docs, text_col, voc, [("ids", ArrayType(IntegerType())), ("n_ids", IntegerType())], make)


def decode(docs: DataFrame, voc: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``text`` in place of the ids (null ids: null)."""
    def make(codec: Codec, rows: list) -> list:
        return [pa.array([None if r is None else codec.decode(r) for r in rows], pa.string())]

    return _mapped(docs, ids_col, voc, [("text", StringType())], make)


def encode_checked(docs: DataFrame, voc: Vocabulary, text_col: str = "text") -> DataFrame:
    """``encode`` with ``round_trip``: whether the ids decode to the text
    (its mark characters read as spaces)."""
    def make(codec: Codec, texts: list) -> list:
        rows = codec.encode_all(texts)
        same = [codec.decode(np.frombuffer(r, np.int32)) == (t or "").replace(MARK, " ") for r, t in zip(rows, texts)]
        return [_lists(rows), pa.array([len(r) // 4 for r in rows], pa.int32()), pa.array(same, pa.bool_())]

    return _mapped(docs, text_col, voc, [("ids", ArrayType(IntegerType())), ("n_ids", IntegerType()), ("round_trip", BooleanType())], make)


def read_vocabulary(spark: SparkSession, path: str, model: str = BPE) -> Vocabulary:
    """The vocabulary at a path on the driver or in Spark's file systems."""
    if "://" in path and not path.startswith("file://"):
        import tempfile
        blob = spark.read.format("binaryFile").load(path).select("content").first()[0]
        with tempfile.NamedTemporaryFile(suffix=".model") as f:
            f.write(blob)
            f.flush()
            return Vocabulary.read(f.name, model)
    return Vocabulary.read(path.removeprefix("file://"), model)
