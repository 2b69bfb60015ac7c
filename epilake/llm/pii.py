"""Personal data: patterns, and a semi-Markov conditional random field.

Base spans come from four fixed patterns. The field adds spans that the
patterns' exact forms miss. Its tokens are runs of letters and digits and
single other characters, so a boundary can fall inside a word. It works on
stretches: each token that holds a digit or ``@`` with at least
``MAX_TOKENS - 1`` tokens, and ``MAX_WORDS - 1`` whole words, on each side.
A candidate segment holds a digit or ``@`` and is up to ``MAX_TOKENS``
tokens, or up to ``MAX_WORDS`` whole words of any length; its score for a
type is a weighted sum of features of the whole span (shape, separators,
number of digits and groups, checksum, octets, what stands before and
after). A dynamic program over the stretch chooses boundaries and types
together: the partition function trains it, the best path decodes. A stretch
of any length is one path; segments are built end by end and not kept.

The weights are trained here by stochastic gradient ascent on the
conditional likelihood of base spans in a bounded sample of texts
(``Config.sample``), each text as it is and in ``Config.copies`` copies with
most spans rewritten into forms that the patterns miss (``FORMS``: other separators,
national phone numbers, spaced addresses), some between marks, and some
replaced by what only looks alike (``DECOYS``: a wrong check digit, an octet
above 255, dates, amounts).

Base spans always stay; a decoded span is added if it overlaps none. Null
and empty texts have no spans. Offsets count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 20
MAX_WORDS = 6
OTHER = len(KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# re, since regex looks for the dot in all that follows, at each @
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a pattern that failed at a run's first digit fails at its others too
_IP = regex.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = regex.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = regex.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: More than the features of any segment.
WIDTH = 32
_TELLING = regex.compile(r"[0-9@]")
_TOKEN = regex.compile(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")
_LETTERS = regex.compile(r"\p{L}+")
_DIGITS = regex.compile(r"[0-9]+")
_OPENS, _ENDS = frozenset("@+(._%-"), frozenset("@-")  # other characters at which a span may start or end
_NOT_DIGIT = regex.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    out: list[tuple[int, int, int]] = []
    at, done = text.find("@"), 0
    while at >= 0:  # a match has one @ and starts where its run of local characters does
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        octets = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in octets):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring tokens, each as (start, end): every segment that
    holds a digit or ``@`` lies within one run."""
    tokens, words, telling, word = [], [], [], []
    end = -1
    for m in _TOKEN.finditer(text):
        if m.start() != end:
            words.append(len(tokens))
        end = m.end()
        if not m.group().isalpha() and _TELLING.search(text, m.start(), end):
            telling.append(len(tokens))
            word.append(len(words) - 1)
        tokens.append((m.start(), end))
    words.append(len(tokens))
    first = last = 0
    for t, w in zip(telling, word):
        lo = max(0, min(t - MAX_TOKENS + 1, words[max(0, w - MAX_WORDS + 1)]))
        hi = min(len(tokens), max(t + MAX_TOKENS, words[min(len(words) - 1, w + MAX_WORDS)]))
        if lo >= last:
            if last:
                yield tokens[first:last]
            first = lo
        last = max(last, hi)
    if last:
        yield tokens[first:last]


def _trainable(text: str, run: list[tuple[int, int]], cfg: "Config") -> bool:
    """Runs of very many tokens take no part in training (they do in decoding)."""
    return len(run) <= cfg.run_tokens and len(_TELLING.findall(text, run[0][0], run[-1][1])) <= cfg.run_telling


def _near(text: str, at: int, step: int) -> str:
    """Up to two characters that touch a boundary, letters as a, digits as 9."""
    near = ""
    for k in (at, at + 1) if step > 0 else (at - 1, at - 2):
        c = text[k] if 0 <= k < len(text) else " "
        if c.isspace():
            break
        c = "a" if c.isalpha() else "9" if c.isdigit() else c
        near = near + c if step > 0 else c + near
    return near


def candidates(text: str, run: list[tuple[int, int]]) -> Iterator[list[tuple[int, tuple]]]:
    """For each token in turn the segments that end with it: (first token,
    look), where all features follow from the look."""
    mould, starts, ends, told, at = [], [], [], [0], 0
    words: list[list[int]] = []         # first and last token of each word, outer punctuation trimmed
    opens, closes, left, right, after, zeros = [], [], [], [], [], []
    prev = run[0][0]
    for i, (s, e) in enumerate(run):
        tok, gap = text[s:e], text[prev:s][:2]
        if s != prev or not i:
            words.append([-1, -1])
        prev = e
        solid = tok[0].isalnum()
        if words[-1][0] < 0 and (solid or tok in "+(@"):
            words[-1][0] = i
        if solid:
            words[-1][1] = i
        opens.append(solid or tok in _OPENS)
        closes.append(solid or tok in _ENDS)
        told.append(told[-1] + (not tok.isalpha() and bool(_TELLING.search(tok))))
        # digit groups of 20 and more look alike
        part = "a" if tok.isalpha() else _LETTERS.sub("a", _DIGITS.sub(lambda m: "9" * min(20, len(m.group())), tok))
        mould += (gap, part)
        starts.append(at + len(gap))
        at += len(gap) + len(part)
        ends.append(at)
        left.append(_near(text, s, -1))
        right.append(_near(text, e, 1))
        zeros.append(2 if tok.startswith("00") else int(tok[0] == "0"))
        before = text[max(0, s - 24):s].split()
        last = before[-1][-1] if before else ""
        after.append("9" if last.isdigit() else "" if last.isalnum() else last)
    form = "".join(mould)
    closing = {w[1]: k for k, w in enumerate(words) if w[0] >= 0 and w[1] >= w[0]}

    def look(b: int, e: int) -> tuple:
        m = form[starts[b]:ends[e]]
        n, check = m.count("9"), None
        if 16 <= n <= 19:
            check = luhn("".join(_DIGITS.findall(text, run[b][0], run[e][1])))
        elif n <= 12 and m.count(".") == 3 and len(g := _DIGITS.findall(text, run[b][0], run[e][1])) == 4:
            check = all(int(x) <= 255 for x in g)
        return m, check, after[b], left[b], right[e], zeros[b]

    for e in range(len(run)):
        out = []
        if closes[e]:
            low = max(0, e - MAX_TOKENS + 1)
            out = [(b, look(b, e)) for b in range(low, e + 1) if opens[b] and told[e + 1] > told[b]]
            if e in closing:
                k = closing[e]
                out += [(b, look(b, e)) for b, last in words[max(0, k - MAX_WORDS + 1):k + 1]
                        if 0 <= b < low and told[e + 1] > told[b]]
        yield out


def features(look: tuple) -> list[str]:
    """Features of the whole span and of what touches it."""
    span, check, after, left, right, zeros = look
    groups = _DIGITS.findall(span)
    n = sum(map(len, groups))
    shape = _DIGITS.sub("9", span)
    out = ["bias", f"tokens{min(len(span.split()), 4)}", f"digits{n if n < 20 else 20}", f"groups{min(len(groups), 6)}"]
    out.append(f"shape{shape}" if len(shape) <= 24 else "shape-long")
    if "a" in span:
        out.append("letters")
        if groups:
            out.append("mixed")
    else:
        out.append("digits-only")
        out.append("lengths" + "-".join(str(len(g)) for g in groups[:6]))
        out.append(f"zeros{zeros}-digits{n if n < 20 else 20}")
    if "@" in span:
        out.append("at" if span.count("@") == 1 else "ats")
        head, tail = span.split("@", 1)
        out.append("at-dots" if "." in tail.strip(".") else "at-bare")
        # words of the name and of the domain
        out.append(f"name{min(len(head.split()), 3)}")
        out.append(f"domain{min(len(tail.split()), 3)}")
    elif "a" in span:
        out.append("letters-no-at")
    for c in ".-()+=/:_,":
        if c in span:
            out.append("has" + c)
    if 16 <= n <= 19:
        out.append("luhn" if check else "no-luhn")
    elif check is not None:
        out.append("octets" if check else "no-octets")
    out.append(f"from{span[0]}")
    if after:
        out.append("after" + after)
    out += ["left" + left, "right" + right, "before" + left[-1:], "behind" + right[:1]]
    return out


@dataclass(frozen=True)
class Config:
    sample: int = 3000      # texts with a telling character used for training, at most
    run_tokens: int = 1024  # tokens, and telling characters, of a run used for training, at most
    run_telling: int = 256
    epochs: int = 4
    rate: float = 0.2
    decay: float = 1e-3     # weights shrink a little, so rare features stay small
    margin: float = 1.0     # log odds by which a span's own score must beat no span
    seed: int = 11
    forms: tuple[str, ...] | None = None    # FORMS that training texts are rewritten into; None: all
    copies: int = 2         # rewritten copies of a text with base spans


def _logsum(x: list[float]) -> float:
    m = max(x)
    return m + math.log(sum([math.exp(v - m) for v in x]))


def _step(w: np.ndarray, inside: np.ndarray, first: list[int], end: list[int], gold: np.ndarray, n: int,
          rate: float, decay: float) -> np.ndarray:
    """Weights (feature by kind) after one step up the log-likelihood of
    ``gold`` (segment by kind). ``inside``: each segment's features, filled
    up with 0, whose weights stay 0; its tokens are from ``first`` to before ``end``."""
    held = np.zeros((len(inside), len(w)))
    held[np.arange(len(inside))[:, None], inside] = 1.0
    held[:, 0] = 0.0
    s = held @ w
    top = s.max(axis=1)
    flat = (top + np.log(np.exp(s - top[:, None]).sum(axis=1))).tolist()
    ending: dict[int, list] = {}
    opening: dict[int, list] = {}
    for k, (b, e) in enumerate(zip(first, end)):
        ending.setdefault(e, []).append(k)
        opening.setdefault(b, []).append(k)
    ahead = [0.0] * (n + 1)     # log sum over splits of the first tokens
    back = [0.0] * (n + 1)      # and of the last
    for e in range(1, n + 1):
        ahead[e] = _logsum([ahead[e - 1], *[ahead[first[k]] + flat[k] for k in ending[e]]]) if e in ending else ahead[e - 1]
    for b in range(n - 1, -1, -1):
        back[b] = _logsum([back[b + 1], *[flat[k] + back[end[k]] for k in opening[b]]]) if b in opening else back[b + 1]
    rest = np.array(ahead)[first] + np.array(back)[end] - ahead[n]
    step = rate * (gold - np.exp(s + rest[:, None]))
    return w * (1 - rate * decay) + held.T @ step


def _hot(where: Iterable[tuple[int, int]], gold: dict[tuple[int, int], int]) -> np.ndarray:
    return np.array([[float(gold.get(k) == c) for c in range(len(KINDS))] for k in where])


def _row(feats: Iterable[str], names: dict[str, int]) -> list[int]:
    """Numbers of the features from 1 on, filled up with 0."""
    row = [names.setdefault(f, len(names) + 1) for f in feats]
    return row + [0] * (WIDTH - len(row))


@dataclass
class SemiCrf:
    """Weights by (feature, kind); a token outside spans scores 0."""

    weights: dict[tuple[str, int], float] = field(default_factory=dict)
    margin: float = 0.0
    table: dict[str, list[float]] = field(default_factory=dict)             # weights by kind, made when decoding
    scored: dict[tuple, tuple[float, int]] = field(default_factory=dict)    # best kind of a look

    def segments(self, text: str, run: list[tuple[int, int]]) -> dict[tuple[int, int], list[str]]:
        """Features of each candidate segment, by (first token, tokens)."""
        return {(b, e + 1 - b): features(x) for e, found in enumerate(candidates(text, run)) for b, x in found}

    def score(self, feats: list[str], kind: int) -> float:
        return sum(self.weights.get((f, kind), 0.0) for f in feats)

    def learn(self, text: str, run: list[tuple[int, int]], gold: dict[tuple[int, int], int], rate: float, decay: float):
        """One step up the log-likelihood of ``gold`` (segments by kind)."""
        seg = self.segments(text, run)
        names: dict[str, int] = {}
        inside = np.array([_row(fs, names) for fs in seg.values()])
        w = np.zeros((len(names) + 1, len(KINDS)))
        for f, i in names.items():
            w[i] = [self.weights.get((f, c), 0.0) for c in range(len(KINDS))]
        w = _step(w, inside, [b for b, _ in seg], [b + m for b, m in seg], _hot(seg, gold), len(run), rate, decay)
        self.weights.update({(f, c): float(w[i, c]) for f, i in names.items() for c in range(len(KINDS))})
        self.table.clear()
        self.scored.clear()

    def best_kind(self, look: tuple) -> tuple[float, int]:
        got = self.scored.get(look)
        if got is None:
            if not self.table:
                for (f, c), v in self.weights.items():
                    self.table.setdefault(f, [0.0] * len(KINDS))[c] = v
            found = [x for x in map(self.table.get, features(look)) if x]
            sums = list(map(sum, zip(*found))) or [0.0] * len(KINDS)
            v = max(sums)
            got = v - self.margin, sums.index(v)
            if len(look[0]) <= 64:
                if len(self.scored) >= 200_000:
                    self.scored.clear()
                self.scored[look] = got
        return got

    def best(self, text: str, run: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """Segments of the best path: (kind, start, end)."""
        n = len(run)
        top = [0.0] * (n + 1)
        how: list = [None] * (n + 1)
        for e, found in enumerate(candidates(text, run), 1):
            top[e] = top[e - 1]
            for b, look in found:
                v, c = self.best_kind(look)
                if top[b] + v > top[e]:
                    top[e], how[e] = top[b] + v, (b, c)
        out, e = [], n
        while e > 0:
            if how[e] is None:
                e -= 1
            else:
                b, c = how[e]
                out.append((c, run[b][0], run[e - 1][1]))
                e = b
        return out[::-1]

    def spans(self, text: str | None) -> tuple[list, list]:
        """(base, all) spans, each by kind and start."""
        if not text or not _TELLING.search(text):
            return [], []
        base = base_spans(text)
        taken = sorted((s, e) for _, s, e in base)
        added = []
        for run in stretches(text):
            for k, s, e in self.best(text, run):
                if not any(a < e and s < b for a, b in taken):
                    added.append((k, s, e))
        return base, sorted(base + added)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _digits(span: str, n: int) -> str:
    """The last ``n`` digits of a span, repeated if it has fewer."""
    d = _NOT_DIGIT.sub("", span)
    return (d * n)[-n:]


def _short(span: str, rng: random.Random) -> str:
    """An address with its name in one word and two parts of its domain, some without digits."""
    name, domain = span.split("@")
    parts = domain.split(".")
    short = f"{name.replace('.', '')} @ {parts[0]}.{parts[-1]}"
    plain = _DIGITS.sub("", short)
    return plain if rng.random() < 0.5 and re.fullmatch(r"[^ ]+ @ [^ .]+\.[^ .]+", plain) else short


def _fours(span: str, sep: str) -> str:
    d = _NOT_DIGIT.sub("", span)
    return sep.join(d[i:i + 4] for i in range(0, len(d), 4))


def _ten(span: str, sep: str) -> str:
    d = _digits(span, 10)
    return sep.join((d[:3], d[3:6], d[6:]))


def _trunk(span: str, rng: random.Random, lead: str, sep: str) -> str:
    """A number behind a trunk or exit code."""
    area = rng.randint(2, 4)
    d = _digits(span, area + rng.randint(6, 8))
    return lead + d[:area] + sep + d[area:]


def _pairs(span: str, sep: str) -> str:
    d = "0" + _digits(span, 9)
    return sep.join(d[i:i + 2] for i in range(0, 10, 2))


def _area(span: str, sep: str) -> str:
    d = _digits(span, 10)
    return f"({d[:3]}) {d[3:6]}{sep}{d[6:]}"


Form = tuple[int, Callable[[str, random.Random], str]]


def _forms() -> dict[str, Form]:
    """Forms that the patterns miss: kind, and how a base span is written in it."""
    out: dict[str, Form] = {
        "email spaced": (0, lambda s, rng: s.replace("@", " @ ", 1)),
        "email marked": (0, lambda s, rng: s.replace("@", "(at)@", 1)),
        "email doubled": (0, lambda s, rng: s.replace("@", "@@", 1)),
        "email one space": (0, lambda s, rng: s.replace("@", rng.choice(("@ ", " @")), 1)),
        "email short": (0, lambda s, rng: _short(s, rng))}
    for name, sep in (("spaced", " . "), ("brackets", "[.]"), ("parentheses", "(.)")):
        out["ip " + name] = 1, lambda s, rng, sep=sep: s.replace(".", sep)
    for name, sep in (("slashes", "/"), ("dots", "."), ("wide gaps", "  "), ("spaced dashes", " - "), ("underscores", "_")):
        out["card " + name] = 2, lambda s, rng, sep=sep: _fours(s, sep)
    for name, sep in (("spaces", " "), ("dashes", "-"), ("dots", "."), ("slashes", "/")):
        out["phone ten " + name] = 3, lambda s, rng, sep=sep: _ten(s, sep)
        out["phone country " + name] = 3, lambda s, rng, sep=sep: f"{rng.randint(1, 99)}{sep}{_ten(s, sep)}"
        if sep != ".":  # four pairs and dots are an address by its pattern
            out["phone pairs " + name] = 3, lambda s, rng, sep=sep: _pairs(s, sep)
        out["phone trunk " + name] = 3, lambda s, rng, sep=sep: _trunk(s, rng, "0", sep)
        out["phone exit " + name] = 3, lambda s, rng, sep=sep: _trunk(s, rng, f"00{rng.randint(1, 99)}{sep}", sep)
        out["phone area " + name] = 3, lambda s, rng, sep=sep: _area(s, sep)
    return out


FORMS = _forms()


def _wrong_check(span: str, rng: random.Random) -> str:
    d = _NOT_DIGIT.sub("", span)
    return _fours(d[:-1] + str((int(d[-1]) + rng.randint(1, 9)) % 10), rng.choice(("", "", " ", "-", "/", ".")))


def _wrong_octet(span: str, rng: random.Random) -> str:
    parts = span.split(".")
    parts[rng.randrange(len(parts))] = str(rng.randint(256, 999))
    return rng.choice((".", ".", " . ")).join(parts)


def _number(span: str, rng: random.Random) -> str:
    """A date, time, amount, range, book number or release."""
    n = rng.randint
    return rng.choice((
        f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 28):02}/{n(1, 12):02}/{n(1900, 2099)}",
        f"{n(1, 28):02}.{n(1, 12):02}.{n(1900, 2099)}", f"{n(1900, 2099)}{n(1, 12):02}{n(1, 28):02}",
        f"{n(0, 23)}:{n(0, 59):02} - {n(0, 23)}:{n(0, 59):02}", f"{n(1, 999)},{n(0, 999):03},{n(0, 999):03}.{n(0, 99):02}",
        f"{n(1900, 2099)}-{n(1900, 2099)}", f"{n(1, 999)} - {n(1, 999)}", f"{n(1, 999)} {n(1, 999)} {n(1, 999)}",
        f"{n(1, 999)} - {n(1, 999)} - {n(1, 9999)}", f"978-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}",
        f"{n(0, 99)}.{n(0, 99)}.{n(0, 99)}", str(n(1, 10 ** 12))))


#: What stands where a span did and is none, by kind.
DECOYS: tuple[Callable[[str, random.Random], str], ...] = (
    lambda s, rng: f"{rng.randint(1, 99)} @ {rng.randint(1, 99)}.{rng.randint(0, 99):02}", _wrong_octet, _wrong_check, _number)
#: Marks that may stand before a span in place of a space, and after it.
_LEADS = ((":", ""), ("=", ""), (':"', '"'), ("(", ")"), ("<", ">"), (" ", ","))


def _varied(text: str, base: list[tuple[int, int, int]], rng: random.Random, forms: Sequence[str] = tuple(FORMS),
            share: float = 0.7, decoys: float = 0.15) -> tuple[str, list[tuple[int, int, int]], list[int]]:
    """The text with a share of its spans rewritten into ``forms``, some of
    them between marks, and a share replaced by decoys; where the spans are
    then, and where what is new starts."""
    out, at, length, moved, news = [], 0, 0, [], []
    by_kind = [[FORMS[f][1] for f in forms if FORMS[f][0] == k] for k in range(len(KINDS))]
    for k, s, e in sorted(base, key=lambda x: x[1]):
        if s < at:
            continue
        span, before, behind, draw = text[s:e], text[at:s], "", rng.random()
        old = span
        if by_kind[k] and draw < share:
            span = rng.choice(by_kind[k])(span, rng)
            if before.endswith(" ") and rng.random() < 0.3:
                lead, behind = rng.choice(_LEADS)
                before = before[:-1] + lead
        elif decoys and draw >= 1 - decoys:
            span = DECOYS[k](span, rng)
        start = length + len(before)
        length = start + len(span) + len(behind)
        out += (before, span, behind)
        if not decoys or draw < 1 - decoys:
            moved.append((k, start, start + len(span)))
        if span != old:
            news.append(start)
        at = e
    out.append(text[at:])
    return "".join(out), moved, news


def fit(texts: list[str], cfg: Config = Config()) -> SemiCrf:
    """Train on the base spans of ``texts`` in a fixed random order."""
    model, rng = SemiCrf(), random.Random(cfg.seed)
    names: dict[str, int] = {}
    looks: dict[tuple, list[int]] = {}
    examples = []
    forms = tuple(FORMS) if cfg.forms is None else cfg.forms
    for t in texts:
        base = base_spans(t)
        for text, spans, news in ((t, base, None), *[_varied(t, base, rng, forms) for _ in range(cfg.copies if base else 0)]):
            for run in stretches(text):
                if not _trainable(text, run, cfg):
                    continue
                # a run in which nothing is new has been seen in the text itself
                if news is not None and not any(run[0][0] <= x < run[-1][1] for x in news):
                    continue
                first, end, rows = [], [], []
                for e, found in enumerate(candidates(text, run), 1):
                    for b, x in found:
                        if x not in looks:
                            looks[x] = np.array(_row(features(x), names), dtype=np.int32)
                        first.append(b)
                        end.append(e)
                        rows.append(looks[x])
                if not rows:
                    continue
                at, to = {a: i for i, (a, _) in enumerate(run)}, {b: i + 1 for i, (_, b) in enumerate(run)}
                gold = {(at[s], to[e]): k for k, s, e in spans if s in at and e in to}
                table = np.stack(rows)
                known, inside = np.unique(table[:, :int((table > 0).sum(axis=1).max()) + 1], return_inverse=True)
                examples.append((known, inside.astype(np.uint16 if len(known) < 65536 else np.int32),
                                 np.array(first, dtype=np.int16), np.array(end, dtype=np.int16), gold, len(run)))
    looks.clear()
    w = np.zeros((len(names) + 1, len(KINDS)))
    for epoch in range(cfg.epochs):
        rng.shuffle(examples)
        for known, inside, first, end, gold, n in examples:
            b, e = first.tolist(), end.tolist()
            hot = np.zeros((len(b), len(KINDS)))
            for k in (np.flatnonzero([x in gold for x in zip(b, e)]).tolist() if gold else ()):
                hot[k, gold[b[k], e[k]]] = 1.0
            w[known] = _step(w[known], inside, b, e, hot, n, cfg.rate / (1 + epoch), cfg.decay)
    model.weights = {(f, c): float(w[i, c]) for f, i in names.items() for c in range(len(KINDS)) if w[i, c]}
    model.margin = cfg.margin
    return model


def train(docs: DataFrame, cfg: Config = Config(), id_col: str = "doc_id", text_col: str = "text") -> SemiCrf:
    """Train on at most ``cfg.sample`` texts with a digit or ``@``, the first
    by a hash of the id; only each one's stretches come to the driver."""
    ship(docs.sparkSession)
    chosen = (docs.filter(F.col(text_col).rlike("[0-9@]") & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(cfg.sample))

    @F.pandas_udf("array<string>")
    def around(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([[t[max(0, run[0][0] - 24):run[-1][1] + 1] for run in stretches(t) if _trainable(t, run, cfg)]
                             for t in part])

    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
            .filter(F.col("_t").isNotNull()).join(F.broadcast(chosen), "_id")
            .select("_id", around("_t").alias("s"))).collect()
    return fit([s for r in sorted(rows, key=lambda r: (r["_id"], r["s"])) for s in r["s"]], cfg)


def find(docs: DataFrame, model: SemiCrf, text_col: str = "text") -> Column:
    """Column of structs: base counts by kind, ``base`` and ``spans`` written
    as kind:start:end by kind and start, comma-joined, and ``n_added``."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for part in parts:
            rows = []
            for t in part:
                base, every = m.spans(t)
                n = [0] * len(KINDS)
                for k, _, _ in base:
                    n[k] += 1
                rows.append((*n, hashlib.sha256(_written(base).encode()).hexdigest(), _written(every), len(every) - len(base)))
            yield pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return of(F.col(text_col))
