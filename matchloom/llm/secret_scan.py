"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

Two first-order models over the characters of keys are trained from labelled samples: random strings are what the fixed
patterns find, ordinary ones the other runs of key characters of any length that change between capitals, small letters and digits seldom. In every run, of any length and also where a fixed pattern has found something, the
stretch with the highest log-likelihood ratio is taken, then those left and right of it: a key that stands behind a path or a name is not averaged with it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .shared import hash60

#: Fixed patterns: kind, pattern, least number of characters of the group that counts.
PATTERNS = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
KINDS = [p[0] for p in PATTERNS] + ["markov"]
_ASSIGN = re.compile(PATTERNS[0][1], re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(PATTERNS[1][1])
_KEY = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_IN_KEY = np.zeros(256, bool)
_IN_KEY[list(_KEY)] = True
_IN_HEX = np.zeros(256, bool)
_IN_HEX[list(b"0123456789abcdef")] = True
#: The number of each byte in the models; 0 stands before the first character.
_STATE = np.zeros(256, np.uint8)
_STATE[list(_KEY)] = np.arange(1, len(_KEY) + 1)
_STATES = len(_KEY) + 1
_SIGNS = b"+/_=-"
#: Bytes of a text that are looked at together.
_PIECE = 1 << 20
#: Capitals 1, small letters 2, digits 3, signs 0.
_CASE = np.zeros(256, np.int8)
_CASE[65:91], _CASE[97:123], _CASE[48:58] = 1, 2, 3


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the longest runs of the bytes in `member`, of `least` bytes or more, within a row."""
    inside = member[data]
    mark = np.zeros(len(data) + 1, bool)
    mark[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | mark[1 : len(data)]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | mark[1 : len(data)]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    long = ends - begins >= least
    return begins[long], ends[long]


def base_spans(text: str, hexes: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the fixed patterns; hexes: those of the third, already found."""
    low = text.lower()
    found = [(a, b, 2) for a, b in hexes]
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= PATTERNS[0][3]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= PATTERNS[1][3]]
    return sorted(found, key=lambda x: (x[0], x[2], x[1]))


def _points(raw: bytes, places: list[int]) -> dict[int, int]:
    """Code points before each byte place."""
    if raw.isascii():
        return {p: p for p in places}
    out, at, points = {}, 0, 0
    for p in sorted(set(places)):
        points += len(raw[at:p].decode("utf-8"))
        out[p], at = points, p
    return out


def _found(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list, list]]:
    """For each slice of rows: first and last row, bytes, offsets of the rows, and for each row its text and its base spans."""
    for lo, hi, data, offsets in tb.slices(texts):
        begins, ends = runs(data, offsets, _IN_HEX, PATTERNS[2][3])
        at = np.searchsorted(begins, offsets)
        raws, bases = [], []
        for i in range(hi - lo):
            a, b = int(offsets[i]), int(offsets[i + 1])
            raw = data[a:b].tobytes()
            hexes = [(int(x) - a, int(y) - a) for x, y in zip(begins[at[i] : at[i + 1]], ends[at[i] : at[i + 1]], strict=True)]
            point = _points(raw, [p for span in hexes for p in span])
            bases.append(base_spans(raw.decode("utf-8"), [(point[x], point[y]) for x, y in hexes]))
            raws.append(raw)
        yield lo, hi, data, offsets, raws, bases


def _pairs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of the bytes: first, the one after the last, the number of the pair of states before and at each byte, and which bytes lie in the runs."""
    for a in range(0, len(data), _PIECE):
        b = min(len(data), a + _PIECE)
        states = _STATE[data[a:b]]
        before = np.concatenate([_STATE[data[a - 1 : a]] if a else np.zeros(1, np.uint8), states[:-1]])
        lo, hi = np.searchsorted(begins, [a, b])
        before[begins[lo:hi] - a] = 0
        edge = np.zeros(b - a + 1, np.int8)
        edge[begins[lo:hi] - a] += 1
        edge[ends[slice(*np.searchsorted(ends, [a + 1, b]))] - a] -= 1  # runs are apart, or at the edge of rows, where both meet
        edge[0] += 1 if lo and ends[lo - 1] > a else 0
        yield a, b, before.astype(np.uint16) * _STATES + states, np.cumsum(edge[:-1], dtype=np.int8) > 0


def _covered(offsets: np.ndarray, raws: list[bytes], bases: list) -> np.ndarray:
    """Which bytes lie in base spans."""
    out = np.zeros(int(offsets[-1]), bool)
    for i, (raw, base) in enumerate(zip(raws, bases, strict=True)):
        if base:
            text = raw.decode("utf-8") if not raw.isascii() else None
            place = lambda p: p if text is None else len(text[:p].encode())  # noqa: B023, E731
            for s, e, _ in base:
                out[offsets[i] + place(s) : offsets[i] + place(e)] = True
    return out


def _ordinary(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each run starts a new piece of capitals, small letters (with one capital before them) or digits at most once in four characters."""
    case = _CASE[data]
    before = np.concatenate([[0], case[:-1]])
    before[begins[begins < len(data)]] = 0
    fresh = (case != before) & (case > 0) & ~((before == 1) & (case == 2))
    pieces = np.concatenate([[0], np.cumsum(fresh, dtype=np.int32)])
    return 4 * (pieces[ends] - pieces[begins] - 1) <= ends - begins


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbouring characters in what the patterns find (label 1) and in the ordinary runs of key characters that they do not touch (0)."""
    counts = np.zeros((2, _STATES, _STATES), np.int64)
    for batch in batches:
        for _, _, data, offsets, raws, bases in _found(batch.column("text")):
            for raw, base in zip(raws, bases, strict=True):
                text = raw.decode("utf-8") if base else ""
                for s, e, k in base:
                    secret = re.split(r"[:=]\s*[\"']?", text[s:e], maxsplit=1)[-1] if k == 0 else text[s:e]
                    own = np.frombuffer(secret.encode(), np.uint8)
                    for _, _, pair, _ in _pairs(own, np.zeros(min(1, len(own)), np.int64), np.full(min(1, len(own)), len(own))):
                        counts[1] += np.bincount(pair, minlength=_STATES * _STATES).reshape(_STATES, _STATES)
            begins, ends = runs(data, offsets, _IN_KEY, 1)
            sums = np.concatenate([[0], np.cumsum(_covered(offsets, raws, bases), dtype=np.int32)])
            plain = (sums[begins] == sums[ends]) & _ordinary(data, begins, ends)
            for _, _, pair, inside in _pairs(data, begins[plain], ends[plain]):
                counts[0] += np.bincount(pair[inside], minlength=_STATES * _STATES).reshape(_STATES, _STATES)
    label, before, after = np.nonzero(counts)
    columns = [pa.array(x.astype(np.int32)) for x in (label, before, after)] + [pa.array(counts[label, before, after])]
    yield pa.record_batch(columns, names=["label", "before", "after", "n"])


def train(docs: DataFrame, most_rows: int = 20_000, strength: float = 20.0) -> np.ndarray:
    """log P(random) - log P(ordinary) of each character after each other, from about most_rows documents (those with the
    lowest hash of their id, a bounded sample). Pairs are smoothed towards the frequency of the second
    character among ordinary strings, and towards an even one among random strings."""
    total = docs.count()
    part = docs.filter(hash60(F.col("doc_id")) < int(2**60 * min(1.0, most_rows / max(1, total)))) if total > most_rows else docs
    rows = part.select("text").mapInArrow(_count, "label int, before int, after int, n long").groupBy("label", "before", "after").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros((2, _STATES, _STATES))
    for r in rows:  # at most 2 * 68 * 68
        counts[r["label"], r["before"], r["after"]] = r["n"]
    even = np.full(_STATES, 1 / (_STATES - 1))
    single = (counts[0].sum(0) + 1) / (counts[0].sum() + _STATES)
    towards = (single, even)
    logs = [np.log((c + strength * t) / (c.sum(1, keepdims=True) + strength)) for c, t in zip(counts, towards, strict=True)]
    return logs[1] - logs[0]


class _Sums:
    """Sums of the ratios of a run up to each place, by pieces: only those at the pieces' begins are kept."""

    def __init__(self, run: bytes, ratio: np.ndarray):
        self.states, self.ratio, self.starts = _STATE[np.frombuffer(run, np.uint8)], ratio, [0.0]
        for k in range(len(run) // _PIECE):
            self.starts.append(self.piece(k)[-1])

    def piece(self, k: int) -> np.ndarray:
        """Sums at the places from k * _PIECE on, the begin of the next piece included."""
        own = self.states[k * _PIECE : (k + 1) * _PIECE]
        before = np.concatenate([self.states[k * _PIECE - 1 : k * _PIECE] if k else np.zeros(1, np.uint8), own[:-1]])[: len(own)]
        return np.cumsum(np.concatenate([self.starts[k : k + 1], self.ratio[before, own]]))

    def best(self, a: int, b: int) -> tuple[int, int, float]:
        """The begin and end of the stretch between two places with the highest sum, and that sum; the first of several."""
        low, at, found = np.inf, a, (a, a, 0.0)
        for k in range(a // _PIECE, min(b // _PIECE, len(self.starts) - 1) + 1):
            first = max(a, k * _PIECE)
            own = self.piece(k)[first - k * _PIECE : b + 1 - k * _PIECE]
            least = np.minimum.accumulate(np.minimum(own, low))
            end = int(np.argmax(own - least))
            if own[end] - least[end] > found[2]:
                begin = int(np.argmin(own[: end + 1]))
                found = (first + begin if own[begin] < low else at), first + end, float(own[end] - least[end])
            begin = int(np.argmin(own))
            if own[begin] < low:
                low, at = own[begin], first + begin
        return found


def stretches(run: bytes, ratio: np.ndarray, least_total: float, least_mean: float) -> list[tuple[int, int]]:
    """Begins and ends of the random stretches of a run of key characters: the stretch with the highest sum of ratios, widened to the signs around it, if the
    sum is least_total and least_mean for each of its characters, or more; then those of what is left and right of it."""
    sums = _Sums(run, ratio)
    found, left = [], [(0, len(run))]
    while left:
        a, b = left.pop()
        begin, end, total = sums.best(a, b)
        if begin == end or total < least_total:
            continue
        size = end - begin
        begin = max(run.rfind(bytes([x]), a, begin) + 1 or a for x in _SIGNS)
        ends = [at for x in _SIGNS if (at := run.find(bytes([x]), end, b)) >= 0]
        end = min(ends, default=b)
        if total >= least_mean * size:
            found.append((begin, end))
        left += [(a, begin), (end, b)]
    return sorted(found)


def _outside(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The spans of which some character is in none of the base spans, which are sorted by their start."""
    joined: list[list[int]] = []
    for s, e, _ in base:
        if joined and s <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], e)
        else:
            joined.append([s, e])
    out = []
    for s, e in spans:
        i = bisect_right(joined, s, key=lambda x: x[0]) - 1
        if i < 0 or joined[i][1] < e:
            out.append((s, e))
    return out


def _scan(batches: Iterator[pa.RecordBatch], ratio: np.ndarray, least_total: float, least_mean: float) -> Iterator[pa.RecordBatch]:
    gains = np.maximum(ratio, 0).ravel()
    text_of = lambda xs: ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in xs)
    for batch in batches:
        ids = batch.column("doc_id").cast(pa.int64())
        for lo, hi, data, offsets, raws, bases in _found(batch.column("text")):
            begins, ends = runs(data, offsets, _IN_KEY, 1)
            upto, at_begin, at_end = 0.0, np.zeros(len(begins)), np.zeros(len(begins))
            for a, b, pair, inside in _pairs(data, begins, ends):
                sums = np.cumsum(np.concatenate([[upto], np.where(inside, gains[pair], 0.0)]))
                for places, told in ((begins, at_begin), (ends, at_end)):
                    x, y = np.searchsorted(places, [a, b], "left" if places is begins else "right")
                    told[x:y] = sums[places[x:y] - a]
                upto = sums[-1]
            hopeful = np.flatnonzero(at_end - at_begin >= least_total - 1e-6)
            row = np.searchsorted(offsets, begins[hopeful], "right") - 1
            more: dict[int, list] = {}
            for i, a, b in zip(row.tolist(), begins[hopeful].tolist(), ends[hopeful].tolist(), strict=True):
                at = a - int(offsets[i])
                more.setdefault(i, []).extend((at + x, at + y) for x, y in stretches(data[a:b].tobytes(), ratio, least_total, least_mean))
            rows = []
            for i, base in enumerate(bases):
                spans = list(base)
                if more.get(i):
                    point = _points(raws[i], [p for span in more[i] for p in span])
                    spans += [(s, e, 3) for s, e in _outside([(point[a], point[b]) for a, b in more[i]], base)]
                counts = [sum(k == n for _, _, k in spans) for n in range(4)]
                rows.append((*counts, hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(sorted(spans, key=lambda x: (x[0], x[2], x[1])))))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            names = ["n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"]
            yield pa.record_batch([ids.slice(lo, hi - lo), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["doc_id", *names])


def scanned(docs: DataFrame, most_rows: int = 20_000, least_total: float = 25.0, least_mean: float = 0.9) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256 (of the fixed patterns' spans), spans.

    Spans are kind:start:end in code points, end exclusive, by start and then kind. A null text counts as empty. A stretch of key characters
    is a markov span if its log-likelihood ratio is least_total and least_mean for each character, or more (see stretches), unless every character of it
    is in spans of the fixed patterns. Repeated rows are rows of their own; texts of any length are taken whole, columns besides doc_id and text are not read, and
    no rows give no rows.
    """
    ratio = train(docs, most_rows)
    kind = "doc_id long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(lambda it: _scan(it, ratio, least_total, least_mean), kind)
