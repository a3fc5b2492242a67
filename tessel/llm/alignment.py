"""Alignment of two tokenizers: groups of tokens between common byte offsets, and which ids overlap how often.

Fragments of a text form a monoid. A fragment holds the tokens that end in one byte range: those up to the first
offset where tokens of both tokenizers end (open prefix), the groups between such offsets (closed), and the tokens
after the last one (open suffix). Two neighbours compose: the suffix of one and the prefix of the next close to a
group. Composition is associative, so the ranges of a long document go to different tasks and are reduced as a
tree; a short document is one fragment. Most text repeats its words: a unit (a word with the blank or line end
before it) ends at a common offset, so its fragment is closed and is worked out once for each worker.

A text that is null or empty, or whose tokens do not spell it, has no tokens.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, fields
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessel.llm.bpe import Encoder, Lists, groups, pretoken_codes, pretokens
from tessel.llm.scratch import Scratch

#: Bytes of a range; texts above this are dealt to tasks range by range.
RANGE = 1 << 16
#: Fragments composed by one step of the tree reduction.
FAN = 16
#: Units a worker remembers, and the most frequent id pairs that are sent to all workers (18 MB).
REMEMBERED, SENT = 600_000, 1 << 20
#: A pair of ids in one number.
SHIFT = 20
_EMPTY = np.zeros(0, np.int64)
#: First bytes of characters that may be white space beyond ASCII, and white space in ASCII: no unit starts before them.
_UNSURE = np.zeros(256, bool)
_UNSURE[[9, 10, 11, 12, 13, 0x20, 0xC2, 0xE1, 0xE2, 0xE3]] = True


@dataclass
class Fragment:
    """Tokens ending in one byte range, with absolute byte ends for the open ones.

    ``cuts`` says whether the range holds a common offset; without one everything is open and in the prefix.
    """

    cuts: int
    pre_a: np.ndarray
    pre_a_end: np.ndarray
    pre_b: np.ndarray
    pre_b_end: np.ndarray
    closed: str
    n_a: int
    n_b: int
    n_groups: int
    pairs: np.ndarray
    times: np.ndarray
    suf_a: np.ndarray
    suf_a_end: np.ndarray
    suf_b: np.ndarray
    suf_b_end: np.ndarray
    bad: bool

    @staticmethod
    def start() -> "Fragment":
        """The offset 0 of a document: a cut, and nothing else."""
        return Fragment(1, *[_EMPTY] * 4, "", 0, 0, 0, _EMPTY, _EMPTY, *[_EMPTY] * 4, False)

    @staticmethod
    def of(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, bad: bool = False) -> "Fragment":
        _, common = _ends(a_end, b_end)
        if not len(common):
            return Fragment(0, a, a_end, b, b_end, "", 0, 0, 0, _EMPTY, _EMPTY, *[_EMPTY] * 4, bad)
        cut_a, cut_b = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
        p, q, x, y = cut_a[0], cut_b[0], cut_a[-1], cut_b[-1]
        closed = ";".join(spelled(a[p:x], cut_a - p, b[q:y], cut_b - q))
        pairs, times = np.unique(links(a[p:x], a_end[p:x], b[q:y], b_end[q:y]), return_counts=True)
        return Fragment(1, a[:p], a_end[:p], b[:q], b_end[:q], closed, int(x - p), int(y - q), len(common) - 1, pairs, times,
                        a[x:], a_end[x:], b[y:], b_end[y:], bad)

    def then(self, other: "Fragment") -> "Fragment":
        """This range and the one after it."""
        bad = self.bad or other.bad
        if not self.cuts:
            pre = [np.concatenate(p) for p in zip(self._pre(), other._pre())]
            return Fragment(other.cuts, *pre, other.closed, other.n_a, other.n_b, other.n_groups, other.pairs, other.times, *other._suf(), bad)
        between = [np.concatenate(p) for p in zip(self._suf(), other._pre())]
        if not other.cuts:
            return Fragment(1, *self._pre(), self.closed, self.n_a, self.n_b, self.n_groups, self.pairs, self.times, *between, bad)
        group = Fragment.start().closing(*between)
        pairs, at = np.unique(np.concatenate([self.pairs, group.pairs, other.pairs]), return_inverse=True)
        times = np.bincount(at, weights=np.concatenate([self.times, group.times, other.times]), minlength=len(pairs)).astype(np.int64)
        closed = ";".join(c for c in (self.closed, group.closed, other.closed) if c)
        return Fragment(1, *self._pre(), closed, self.n_a + group.n_a + other.n_a, self.n_b + group.n_b + other.n_b,
                        self.n_groups + group.n_groups + other.n_groups, pairs, times, *other._suf(), bad)

    def closing(self, a, a_end, b, b_end) -> "Fragment":
        """The one group of tokens between two neighbouring cuts; without tokens there is none."""
        if not len(a) and not len(b):
            return self
        closed = ",".join(map(str, a.tolist())) + "|" + ",".join(map(str, b.tolist()))
        pairs, times = np.unique(links(a, a_end, b, b_end), return_counts=True)
        return Fragment(1, *[_EMPTY] * 4, closed, len(a), len(b), 1, pairs, times, *[_EMPTY] * 4, False)

    def _pre(self):
        return self.pre_a, self.pre_a_end, self.pre_b, self.pre_b_end

    def _suf(self):
        return self.suf_a, self.suf_a_end, self.suf_b, self.suf_b_end


_TYPES = {"int": "long", "str": "string", "bool": "boolean", "np.ndarray": "array<long>"}
_FRAGMENT = [(f.name, _TYPES[f.type]) for f in fields(Fragment)]


def _ends(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ends in order, and those that both have."""
    both = np.sort(np.concatenate([a_end, b_end]), kind="stable")
    twice = both[1:] == both[:-1]
    return both[np.append(~twice, True)] if len(both) else both, both[1:][twice]


def links(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Id pairs of all overlapping tokens. Between two neighbouring ends lies exactly one overlap of one pair."""
    ends, _ = _ends(a_end, b_end)
    return a[np.searchsorted(a_end, ends)] << SHIFT | b[np.searchsorted(b_end, ends)]


def spelled(a: np.ndarray, cut_a: np.ndarray, b: np.ndarray, cut_b: np.ndarray) -> list[str]:
    """``a1,a2|b1`` for each group between neighbouring cuts."""
    a, b, cut_a, cut_b = list(map(str, a.tolist())), list(map(str, b.tolist())), cut_a.tolist(), cut_b.tolist()
    return [",".join(a[p:x]) + "|" + ",".join(b[q:y]) for p, x, q, y in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]


class Pair:
    """Both tokenizers, and the fragments of the units a worker has met."""

    def __init__(self, first: str, second: str, spell: bool):
        self.spell = spell
        self.a = Encoder(first, None)
        self.a.model.specials = {}  # their strings are plain text here
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.blank = self.b.piece_to_id("▁")
        spelt = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_bytes = Lists(np.frombuffer(b"".join(spelt), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, spelt)))]))
        self.a_size, self.b_size = np.diff(self.a.token.off), np.diff(self.b_bytes.off)
        # a unit starts with a blank or line end that no piece has after another character (blanks go after blanks)
        self.starts = np.zeros(256, bool)
        self.starts[0x20] = not any("▁" in p.lstrip("▁") for p in pieces)
        self.starts[0x0A] = not any("\n" in p for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.codes, self.at, self.text = np.zeros(0, np.uint64), _EMPTY, []
        self.sizes, self.bad = np.zeros((3, 0), np.int64), np.zeros(0, bool)  # tokens of each kind and groups
        self.pairs = Lists(_EMPTY, np.zeros(1, np.int64))

    def units(self, joined: bytes, size: list[int]):
        """Where the units of texts of these sizes, laid end to end, start and end, and the first unit of each."""
        data = np.frombuffer(joined, np.uint8)
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        start = np.zeros(len(data), bool)
        inner = slice(1, len(data) - 1)
        start[inner] = self.starts[data[inner]] & ~_UNSURE[data[2:]] & ((data[inner] != 0x20) | (data[:-2] != 0x20))
        last = bounds[1:] - 1
        start[last] = False
        start[bounds[:-1]] = True
        first = np.flatnonzero(start)
        return data, first, np.append(first[1:], len(data)), np.searchsorted(first, bounds)

    def places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where each unit stands in the tables; new ones are encoded and aligned first."""
        if len(self.codes) > REMEMBERED:
            self.forget()
        distinct, first, inverse = np.unique(pretoken_codes(data, start, end), return_index=True, return_inverse=True)
        known = np.zeros(len(distinct), bool)
        if len(self.codes):
            known = self.codes[np.minimum(np.searchsorted(self.codes, distinct), len(self.codes) - 1)] == distinct
        if not known.all():
            new = first[~known]
            self.learn(distinct[~known], [data[a:b].tobytes() for a, b in zip(start[new].tolist(), end[new].tolist())])
        return self.at[np.searchsorted(self.codes, distinct)][inverse]

    def encode(self, units: list[bytes]) -> tuple[Lists, Lists, np.ndarray]:
        """Ids of both kinds for whole units, and which units the second one does not spell."""
        data, start, end, off = pretokens(units)
        _, first, inverse = np.unique(pretoken_codes(data, start, end), return_index=True, return_inverse=True)
        ids = self.a._merged(data, start[first], end[first]).take(inverse) if len(first) else Lists(_EMPTY, np.zeros(1, np.int64))
        a = Lists(ids.flat, ids.off[off])
        got = self.b.encode([(u[1:] if u[:1] == b" " else u).decode() for u in units], num_threads=1)
        got = [(g or [self.blank]) if u[:1] == b" " else g[1:] if g[:1] == [self.blank] else None for g, u in zip(got, units)]
        bad = np.array([g is None for g in got], bool)
        size = np.array([len(g or ()) for g in got], np.int64)
        b = Lists(np.fromiter(chain.from_iterable(g for g in got if g), np.int64, int(size.sum())), np.concatenate([[0], np.cumsum(size)]))
        size = np.array(list(map(len, units)), np.int64)
        base = np.concatenate([[0], np.cumsum(size)])
        spelt = self.b_bytes.take(b.flat)
        long = np.diff(spelt.off[b.off]) != size
        if not long.any():
            off = np.flatnonzero(spelt.flat != np.frombuffer(b"".join(units), np.uint8))
            bad[np.searchsorted(base, off, "right") - 1] = True
        else:
            joined, at = spelt.flat.tobytes(), spelt.off[b.off].tolist()
            bad |= np.array([joined[x:y] != u for x, y, u in zip(at, at[1:], units)])
        return a, b, bad

    def learn(self, codes: np.ndarray, units: list[bytes]) -> None:
        a, b, bad = self.encode(units)
        fine, off = np.flatnonzero(~bad), np.flatnonzero(bad)
        fa, fb = a.take(fine), b.take(fine)
        a_end, b_end = np.cumsum(self.a_size[fa.flat]), np.cumsum(self.b_size[fb.flat])
        # one range over all new units: the end of each is a common offset
        every, common = _ends(a_end, b_end)
        stop = np.cumsum(np.array(list(map(len, units)), np.int64)[fine])
        groups_at = np.concatenate([[0], np.searchsorted(common, stop, "right")])
        if self.spell:
            cut_a, cut_b = (np.concatenate([[0], np.searchsorted(e, common, "right")]) for e in (a_end, b_end))
            text, cut = spelled(fa.flat, cut_a, fb.flat, cut_b), groups_at.tolist()
            self.text += [text[x] if y == x + 1 else ";".join(text[x:y]) for x, y in zip(cut, cut[1:])] + [""] * len(off)
        links_at = np.concatenate([[0], np.searchsorted(every, stop, "right")])
        self.pairs = self.pairs.plus(Lists(links(fa.flat, a_end, fb.flat, b_end), np.concatenate([links_at, np.full(len(off), links_at[-1])])))
        none = np.zeros(len(off), np.int64)
        base = len(self.bad)
        self.sizes = np.concatenate([self.sizes, [np.append(np.diff(x), none) for x in (fa.off, fb.off, groups_at)]], axis=1)
        self.bad = np.concatenate([self.bad, np.zeros(len(fine), bool), np.ones(len(off), bool)])
        at = np.empty(len(units), np.int64)
        at[np.concatenate([fine, off])] = base + np.arange(len(units))
        codes, at = np.concatenate([self.codes, codes]), np.concatenate([self.at, at])
        by = np.argsort(codes, kind="stable")
        self.codes, self.at = codes[by], at[by]


_PAIRS: dict[tuple, Pair] = {}


def _pair(first: str, second: str, spell: bool = False) -> Pair:
    """One per worker: later tasks of the same kind find its tables. ``spell`` keeps the groups of units as text."""
    key = first, second, spell
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(*key)
    return _PAIRS[key]


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[off[1:]] - total[off[:-1]]


def _short(first: str, second: str, batches, spell: bool = False):
    """``(batch slice, pair tables, unit places, first unit of each text, texts without tokens)``."""
    pair = _pair(first, second, spell)
    for batch in batches:
        for at, texts in groups(batch.column(batch.num_columns - 1)):
            data, start, end, off = pair.units(b" " + b" ".join(texts), [len(t) + 1 for t in texts])
            place = pair.places(data, start, end)
            none = (_sums(pair.bad[place], off) > 0) | np.array([not t for t in texts])
            yield batch.slice(at, len(texts)), pair, place, off, none


def _count_pairs(first: str, second: str):
    """How many documents of a task hold each linked pair."""
    def run(batches):
        pairs, counts, size = [], [], 0
        for _, pair, place, off, none in _short(first, second, batches):
            doc = np.repeat(np.arange(len(none)), np.diff(off))
            held = ~none[doc]
            seen = np.unique(doc[held] << 32 | place[held])
            got = pair.pairs.take(seen & 0xFFFFFFFF)
            key = np.sort(got.flat | np.repeat(seen >> 32, np.diff(got.off)) << (2 * SHIFT))
            key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
            p, n = np.unique(key & ((1 << 2 * SHIFT) - 1), return_counts=True)
            pairs.append(p)
            counts.append(n)
            size += len(p)
            if size > 2_000_000:
                p, n = _merged(pairs, counts)
                if len(p) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(n)], names=["pair", "n"])
                    p, n = _EMPTY, _EMPTY
                pairs, counts, size = [p], [n], len(p)
        if size:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, _merged(pairs, counts))), names=["pair", "n"])
    return run


def _merged(pairs, counts):
    p, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return p, np.bincount(at, weights=np.concatenate(counts), minlength=len(p)).astype(np.int64)


_DIGEST = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, row long, rare array<long>"


def _digest(first: str, second: str, sent):
    """The result's columns; pairs that were not sent stay in ``rare`` for a join."""
    def run(batches):
        context, row = TaskContext.get().partitionId() << 40, 0
        pair_codes, counts, best = sent.value
        for part, pair, place, off, none in _short(first, second, batches, True):
            used, at = np.unique(place, return_inverse=True)
            held = pair.pairs.take(used)
            i = np.minimum(np.searchsorted(pair_codes, held.flat), max(len(pair_codes) - 1, 0))
            known = pair_codes[i] == held.flat if len(pair_codes) else np.zeros(len(held.flat), bool)
            live = ~none
            columns = [_sums(x[at], off) * live for x in (
                *pair.sizes[:, used], np.diff(held.off),
                _sums(np.where(known, best[i], 0) if len(pair_codes) else np.zeros(len(held.flat), np.int64), held.off),
                _sums(np.where(known, counts[i], 0) if len(pair_codes) else np.zeros(len(held.flat), np.int64), held.off))]
            cut, where = off.tolist(), place.tolist()
            text = pair.text.__getitem__
            sha = ["" if x else hashlib.sha256(";".join(map(text, where[a:b])).encode()).hexdigest() for x, a, b in zip(none.tolist(), cut, cut[1:])]
            rare = [[] for _ in sha]
            if not known.all():
                missing = Lists(held.flat[~known], np.concatenate([[0], np.cumsum(_sums(~known, held.off))]))
                got = missing.take(at)
                ends = got.off[off].tolist()
                rare = [got.flat[a:b] if y else [] for y, a, b in zip(live.tolist(), ends, ends[1:])]
            rows = context + row + np.arange(len(sha))
            row += len(sha)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, columns), pa.array(sha), pa.array(rows), pa.array(rare, pa.list_(pa.int64()))],
                                             names=[*part.schema.names[:-1], *(c.split()[0] for c in _DIGEST.split(", "))])
    return run


def _ranges(first: str, second: str, span: int):
    """Long texts as byte ranges, each with the whole units it touches; a unit above ``span`` stays in one range."""
    def run(batches):
        pair, context, row = _pair(first, second), TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for i, text in enumerate(batch.column(batch.num_columns - 1).cast(pa.large_binary()).to_pylist()):
                text = b" " + text
                _, start, end, _ = pair.units(text, [len(text)])
                cut = np.arange(span, len(text), span)
                unit = np.searchsorted(start, cut, "right") - 1
                cut = np.where(end[unit] - start[unit] > span, start[unit], cut)
                cut = np.concatenate([[0], np.unique(cut[cut > 0]), [len(text)]])
                for no, (a, b) in enumerate(zip(cut.tolist(), cut[1:].tolist())):
                    x, y = np.searchsorted(start, [a, b - 1], "right") - 1
                    yield pa.RecordBatch.from_arrays([
                        *batch.slice(i, 1).columns[:-1], pa.array([context + row]), pa.array([no]), pa.array([a]), pa.array([b]), pa.array([int(start[x])]),
                        pa.array([text[start[x]:end[y]]], pa.binary())], names=[*batch.schema.names[:-1], "row", "no", "low", "high", "base", "held"])
                row += 1
    return run


def _record(names: list[str], keys: list, fragment: Fragment) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    held = [pa.array([getattr(fragment, name)], kinds[kind]) for name, kind in _FRAGMENT]
    return pa.RecordBatch.from_arrays([*keys, *held], names=[*names, *(name for name, _ in _FRAGMENT)])


def _fragments(first: str, second: str):
    def run(batches):
        pair = _pair(first, second)
        for batch in batches:
            names = batch.schema.names[:-4]
            for i in range(batch.num_rows):
                low, high, base, held = (batch.column(j)[i].as_py() for j in range(batch.num_columns - 4, batch.num_columns))
                # whole units of the text, so the stretch is cut as the text was
                data, start, end, _ = pair.units(held, [len(held)])
                a, b, off = pair.encode([held[x:y] for x, y in zip(start.tolist(), end.tolist())])
                a, b, bad = a.flat, b.flat, bool(off.any())
                a_end, b_end = base + np.cumsum(pair.a_size[a]), base + np.cumsum(pair.b_size[b])
                x, y = np.searchsorted(a_end, [low, high], "right")
                p, q = np.searchsorted(b_end, [low, high], "right")
                made = Fragment.of(a[x:y], a_end[x:y], b[p:q], b_end[p:q]) if not bad else Fragment.of(*[_EMPTY] * 4, True)
                yield _record(names, [batch.column(j).slice(i, 1) for j in range(len(names))], made)
    return run


def _compose(batches):
    """Neighbouring fragments of sorted rows with equal (row, no) become one."""
    last, held, keys, names = None, None, None, None
    for batch in batches:
        names = batch.schema.names[:-len(_FRAGMENT)]
        at = [names.index("row"), names.index("no")]
        for i in range(batch.num_rows):
            key = tuple(batch.column(j)[i].as_py() for j in at)
            parts = [batch.column(j)[i] for j in range(len(names), batch.num_columns)]
            got = Fragment(*(np.array(v.values.to_numpy(zero_copy_only=False), np.int64) if kind == "array<long>" else v.as_py()
                             for v, (_, kind) in zip(parts, _FRAGMENT)))
            if key == last:
                held = held.then(got)
            else:
                if last is not None:
                    yield _record(names, keys, held)
                last, held, keys = key, got, [batch.column(j).slice(i, 1) for j in range(len(names))]
    if last is not None:
        yield _record(names, keys, held)


def _long(docs: DataFrame, first: str, second: str, span: int, scratch: Scratch) -> DataFrame:
    """Rows of long documents: ``doc_id, row, n_a, n_b, n_groups, groups_sha256, pairs, times``."""
    doc = docs.schema[0].dataType.simpleString()
    ranges = docs.mapInArrow(_ranges(first, second, span), f"doc_id {doc}, row long, no long, low long, high long, base long, held binary")
    kinds = ", ".join(f"{name} {kind}" for name, kind in _FRAGMENT)
    step = f"doc_id {doc}, row long, place long, no long, {kinds}"
    parts = scratch.put(ranges.repartition("row", "no").select("doc_id", "row", F.col("no").alias("place"), "no", "low", "high", "base", "held")
                        .mapInArrow(_fragments(first, second), step))
    most = parts.agg(F.max("place")).first()[0] or 0
    rounds = 0
    while FAN ** rounds <= most:
        rounds += 1
    for _ in range(rounds):
        dealt = parts.withColumn("no", F.floor(F.col("no") / FAN).cast("long")).repartition("row", "no").sortWithinPartitions("row", "place")
        parts, old = scratch.put(dealt.mapInArrow(_compose, step)), parts
        scratch.drop(old)

    def done(batches):
        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                value = {n: batch.column(n)[i] for n in names}
                got = Fragment(*(np.array(value[n].values.to_numpy(zero_copy_only=False), np.int64) if kind == "array<long>" else value[n].as_py() for n, kind in _FRAGMENT))
                got = Fragment.start().then(got)
                # a whole text ends at a common offset; with open tokens left the two spell different bytes
                if got.bad or not got.cuts or len(got.suf_a) or len(got.suf_b):
                    got = Fragment.start()
                sha = hashlib.sha256(got.closed.encode()).hexdigest() if got.closed else ""
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, 1), batch.column("row").slice(i, 1), *(pa.array([x]) for x in (got.n_a, got.n_b, got.n_groups, sha)),
                    pa.array([got.pairs], pa.list_(pa.int64())), pa.array([got.times], pa.list_(pa.int64()))],
                    names=["doc_id", "row", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    return scratch.put(parts.mapInArrow(done, f"doc_id {doc}, row long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"))


def align(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text", span: int = RANGE,
          send: int = SENT) -> DataFrame:
    """One row a document (see the module); ``first`` is a byte-level BPE file, ``second`` a piece model. Texts above
    ``span`` bytes are dealt to tasks by ranges; the ``send`` most frequent id pairs are broadcast, the others joined.

    Repeated rows are documents of their own; columns beside the two are ignored.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "alignment")
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    short, long = docs.filter(F.octet_length("text") <= span), docs.filter(F.octet_length("text") > span)
    whole = _long(long, first, second, span, scratch)
    counted = short.mapInArrow(_count_pairs(first, second), "pair long, n long").unionByName(whole.select(F.explode("pairs").alias("pair"), F.lit(1).cast("long").alias("n")))
    counts = scratch.put(counted.groupBy("pair").agg(F.sum("n").alias("n")))
    a = F.shiftright("pair", SHIFT)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    table = scratch.put(counts.join(highest, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")))
    top = table.orderBy(F.desc("n"), "pair").limit(send).toArrow()
    codes, n, best = (top.column(c).to_numpy() for c in ("pair", "n", "best"))
    rare = None
    if len(codes) == send:
        rare = table.filter((F.col("n") < int(n[-1])) | ((F.col("n") == int(n[-1])) & (F.col("pair") > int(codes[-1]))))
    order = np.argsort(codes)
    sent = spark.sparkContext.broadcast((codes[order], n[order], best[order]))
    got = scratch.put(short.mapInArrow(_digest(first, second, sent), f"doc_id {docs.schema[0].dataType.simpleString()}, {_DIGEST}"))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if rare is not None:
        late = (got.filter(F.size("rare") > 0).select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
                .join(rare, "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more")))
        got = got.join(late, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        got = got.withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
    linked = whole.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times").join(table, F.col("pairs") == F.col("pair"))
    sums = linked.groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    far = whole.join(sums, "row", "left").na.fill(0, ["n_links", "n_best", "count_sum"])
    return got.select("doc_id", *columns).unionByName(far.select("doc_id", *columns))
