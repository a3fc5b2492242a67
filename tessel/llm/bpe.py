"""Byte-level BPE through a shared-suffix automaton of frequent words; unseen words are merged exactly."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import struct
import tempfile
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from tessel.llm.pretoken import code_points, cuts
from tessel.llm.scratch import Scratch
from tessel.llm.text import BASE, CHUNK, INVERSE, mix, powers

#: A pre-token is compiled when it makes up this share of all; so at most 1 / share are.
LEXICON_SHARE = 2e-6
#: Distinct pre-tokens a worker remembers before it starts afresh.
REMEMBERED = 400_000
NEVER = 1 << 60


class Merges:
    """Vocabulary, merge ranks and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in printable}
        for b in range(256):
            shown.setdefault(b, chr(256 + len(shown) - len(printable)))
        hidden = {c: b for b, c in shown.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(hidden[c] for c in token)
        for token, i in self.specials.items():
            self.bytes[i] = token.encode()
        self.text = [str(i) for i in range(size)]
        self.single = [vocab[shown[b]] for b in range(256)]
        self.rank, self.made = {}, []
        for n, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] << 20 | vocab[b]] = n
            self.made.append(vocab[a + b])

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: the lowest-ranked adjacent pair is joined until none is left."""
        parts = [self.single[b] for b in word]
        if len(parts) > 64:
            return self._merge_long(parts)
        rank, made = self.rank.get, self.made
        ranks = [rank(a << 20 | b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            parts[i] = made[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] << 20 | parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 20 | parts[i], NEVER)
        return tuple(parts)

    def _merge_long(self, parts: list[int]) -> tuple[int, ...]:
        """The same by a heap of pairs and links between neighbours, for words of any length."""
        n, rank = len(parts), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (r := rank(parts[i] << 20 | parts[i + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.made[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if y < n and (q := rank(parts[x] << 20 | parts[y], NEVER)) != NEVER:
                    heapq.heappush(heap, (q, x, parts[x], parts[y]))
        return tuple(p for p in parts if p >= 0)

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def compile_lexicon(words: dict[bytes, tuple[int, ...]], path: str) -> None:
    """Write the minimal acyclic automaton of ``words`` with their id lists.

    States with equal futures are one state, so common endings are stored once. Every arc carries the
    number of words that sort before it at its state: their sum along a path is the word's place in
    sorted order, which points to its ids.
    """
    known: dict[tuple, int] = {}
    done: list[tuple[bool, list[tuple[int, int]], int]] = []  # final, arcs (byte, state), words below

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(done)
            done.append((node[0], node[1], node[0] + sum(done[t][2] for _, t in node[1])))
        return known[key]

    open_path: list[list] = [[False, []]]
    last = b""
    order = sorted(words)
    for word in order:
        same = len(os.path.commonprefix([last, word]))
        for depth in range(len(last), same, -1):
            state = freeze(open_path.pop())
            open_path[-1][1].append((last[depth - 1], state))
        open_path += [[False, []] for _ in word[same:]]
        open_path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        state = freeze(open_path.pop())
        open_path[-1][1].append((last[depth - 1], state))
    root = freeze(open_path[0])
    labels, first, target, skip = bytearray(), [0], [], []
    for final, arcs, _ in done:
        before = int(final)
        for byte, state in arcs:
            labels.append(byte)
            target.append(state)
            skip.append(before)
            before += done[state][2]
        first.append(len(labels))
    lists = [words[w] for w in order]
    parts = [np.array(first, "<i4"), np.array(target, "<i4"), np.array(skip, "<i4"), np.array([d[0] for d in done], "<i4"),
             np.cumsum([0, *map(len, lists)]).astype("<i4"), np.fromiter(chain.from_iterable(lists), "<i4")]
    with open(path, "wb") as f:
        f.write(struct.pack("<8i", root, len(labels), *map(len, parts)))
        for p in parts:
            f.write(p.tobytes())
        f.write(bytes(labels))


class Lexicon:
    """The compiled automaton, mapped into memory and shared by the workers of a machine."""

    def __init__(self, path: str):
        held = np.memmap(path, np.uint8, "r")
        self.root, n_labels, *sizes = struct.unpack("<8i", held[:32].tobytes())
        at, parts = 32, []
        for n in sizes:
            parts.append(held[at:at + 4 * n].view("<i4"))
            at += 4 * n
        first, self.target, self.skip, self.final, self.offset, self.ids = parts
        state = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.arcs = state << 8 | held[at:at + n_labels]

    def walk(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of every word ``data[start:end]`` in the lexicon, or -1; all words go in step."""
        state, place = np.full(len(start), self.root), np.zeros(len(start), np.int64)
        live = np.arange(len(start)) if len(self.arcs) else np.zeros(0, np.int64)
        if not len(self.arcs):
            state[:] = -1
        depth = 0
        while len(live):
            live = live[start[live] + depth < end[live]]
            key = state[live] << 8 | data[start[live] + depth]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            known = self.arcs[arc] == key
            state[live[~known]] = -1
            live, arc = live[known], arc[known]
            place[live] += self.skip[arc]
            state[live] = self.target[arc]
            depth += 1
        return np.where((state >= 0) & (self.final[state] == 1), place, -1)

    def get(self, word: bytes) -> tuple[int, ...] | None:
        place = self.walk(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0]
        return None if place < 0 else tuple(self.ids[self.offset[place]:self.offset[place + 1]].tolist())


class Lists:
    """Id lists laid end to end: list i is ``flat[off[i]:off[i + 1]]``."""

    def __init__(self, flat: np.ndarray, off: np.ndarray):
        self.flat, self.off = flat, off

    def take(self, which: np.ndarray) -> "Lists":
        size = (self.off[1:] - self.off[:-1])[which]
        off = np.concatenate([[0], np.cumsum(size)])
        return Lists(self.flat[np.repeat(self.off[which] - off[:-1], size) + np.arange(off[-1])], off)

    def plus(self, other: "Lists") -> "Lists":
        return Lists(np.concatenate([self.flat, other.flat]), np.concatenate([self.off, other.off[1:] + self.off[-1]]))


class Encoder:
    """Encodes many texts at a time: pre-tokens by code, each distinct one looked up or merged once."""

    def __init__(self, tokenizer: str, lexicon: str | None):
        self.model = Merges(tokenizer)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        keys = np.array(list(self.model.rank), np.int64)
        order = np.argsort(keys)
        self.pairs, self.rank = keys[order], np.array(list(self.model.rank.values()), np.int64)[order]
        self.made = np.array(self.model.made, np.int64)
        self.single = np.array(self.model.single, np.int64)
        self.token = Lists(np.frombuffer(b"".join(self.model.bytes), np.uint8),
                           np.concatenate([[0], np.cumsum([len(b) for b in self.model.bytes])]))
        self.forget()

    def forget(self) -> None:
        self.codes, self.at, self.lists = np.zeros(0, np.uint64), np.zeros(0, np.int64), Lists(np.zeros(0, np.int64), np.zeros(1, np.int64))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        i = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[i] == key, self.rank[i], NEVER)

    def merge(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Lists:
        """Ids of many words: in every round each word joins all places of its lowest-ranked pair."""
        size = end - start
        off = np.concatenate([[0], np.cumsum(size)])
        part = self.single[data[np.repeat(start - off[:-1], size) + np.arange(off[-1])]]
        word = np.repeat(np.arange(len(start)), size)
        rank = np.full(len(part), NEVER)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.ranks(part[inner], part[inner + 1])
        out_part, out_word = [], []
        while len(part):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(part)))
            live = np.repeat(low < NEVER, size)
            out_part.append(part[~live])
            out_word.append(word[~live])
            low = np.repeat(low, size)[live]
            part, word, rank = part[live], word[live], rank[live]
            hit = np.flatnonzero(rank == low)
            if not len(hit):
                break
            stop = np.flatnonzero(np.concatenate([[True], np.diff(hit) > 1]))  # aaa: join the first two only
            within = np.arange(len(hit)) - np.repeat(stop, np.diff(np.append(stop, len(hit))))
            hit = hit[within % 2 == 0]
            part[hit] = self.made[rank[hit]]
            keep = np.ones(len(part), bool)
            keep[hit + 1] = False
            now = hit - np.arange(len(hit))
            part, word, rank = part[keep], word[keep], rank[keep]
            touched = np.unique(np.concatenate([now, now[now > 0] - 1]))
            touched, at_end = touched[touched + 1 < len(part)], touched[touched + 1 >= len(part)]
            rank[at_end] = NEVER
            rank[touched] = np.where(word[touched] == word[touched + 1], self.ranks(part[touched], part[touched + 1]), NEVER)
        if not out_part:
            return Lists(np.zeros(0, np.int64), np.zeros(len(start) + 1, np.int64))
        word = np.concatenate(out_word)
        order = np.argsort(word, kind="stable")
        counts = np.bincount(word, minlength=len(start))
        return Lists(np.concatenate(out_part)[order], np.concatenate([[0], np.cumsum(counts)]))

    def learn(self, codes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        place = self.lexicon.walk(data, start, end) if self.lexicon else np.full(len(start), -1)
        new, base = self.lists, len(self.lists.off) - 1
        at = np.empty(len(codes), np.int64)
        for known in (True, False):
            which = np.flatnonzero((place >= 0) == known)
            if len(which):
                got = (Lists(self.lexicon.ids, self.lexicon.offset).take(place[which]) if known
                       else self._merged(data, start[which], end[which]))
                new = new.plus(got)
                at[which] = base + np.arange(len(which))
                base += len(which)
        self.lists = new
        codes, at = np.concatenate([self.codes, codes]), np.concatenate([self.at, at])
        order = np.argsort(codes, kind="stable")
        self.codes, self.at = codes[order], at[order]

    def places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Where the ids of each pre-token stand in ``lists``; unknown ones are learned first."""
        if len(self.codes) > REMEMBERED:
            self.forget()
        if not len(start):
            return np.zeros(0, np.int64)
        distinct, first, inverse = np.unique(pretoken_codes(data, start, end), return_index=True, return_inverse=True)
        known = np.zeros(len(distinct), bool)
        if len(self.codes):
            i = np.minimum(np.searchsorted(self.codes, distinct), len(self.codes) - 1)
            known = self.codes[i] == distinct
        if not known.all():
            self.learn(distinct[~known], data, start[first[~known]], end[first[~known]])
        return self.at[np.searchsorted(self.codes, distinct)][inverse]

    def _merged(self, data, start, end) -> Lists:
        long = end - start > 256
        if not long.any():
            return self.merge(data, start, end)
        got = [self.model.merge(data[a:b].tobytes()) if x else None for a, b, x in zip(start.tolist(), end.tolist(), long)]
        short = self.merge(data, start[~long], end[~long])
        size = np.empty(len(start), np.int64)
        size[~long], size[long] = np.diff(short.off), [len(g) for g in got if g is not None]
        off = np.concatenate([[0], np.cumsum(size)])
        flat = np.empty(off[-1], np.int64)
        mask = np.repeat(long, size)
        flat[~mask] = short.flat
        flat[mask] = np.fromiter(chain.from_iterable(g for g in got if g is not None), np.int64)
        return Lists(flat, off)

    def encode_many(self, texts: list[bytes]) -> Lists:
        """Ids of whole texts in UTF-8. A special token's string becomes its id (leftmost, then longest)."""
        pieces, owner = [], []  # texts between special tokens; special tokens as ints
        for d, text in enumerate(texts):
            for piece in self._parts(text):
                pieces.append(piece)
                owner.append(d)
        plain = [p for p in pieces if not isinstance(p, int)]
        data, start, end, off = pretokens(plain)
        at = self.places(data, start, end)
        ids = self.lists.take(at)
        lists = Lists(ids.flat, ids.off[off])
        if len(plain) == len(texts) == len(pieces):
            return lists
        flat, size, k = [], np.zeros(len(texts), np.int64), 0
        for piece, d in zip(pieces, owner):
            if isinstance(piece, int):
                got = np.array([piece])
            else:
                got, k = lists.flat[lists.off[k]:lists.off[k + 1]], k + 1
            flat.append(got)
            size[d] += len(got)
        return Lists(np.concatenate([np.zeros(0, np.int64), *flat]), np.concatenate([[0], np.cumsum(size)]))

    def _parts(self, text: bytes) -> list:
        specials = {s.encode(): i for s, i in self.model.specials.items()}
        if not any(s in text for s in specials):
            return [text]
        out, at = [], 0
        while hits := [(p, -len(s), s) for s in specials if (p := text.find(s, at)) >= 0]:
            place, _, s = min(hits)
            out += [text[at:place], specials[s]]
            at = place + len(s)
        return [*out, text[at:]]

    def decode_many(self, ids: Lists) -> list[bytes]:
        """Texts of id lists; bytes that are no UTF-8 become the replacement character."""
        raw = self.token.take(ids.flat)
        data, off = raw.flat.tobytes(), raw.off[ids.off].tolist()
        return [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(off, off[1:])]


_TABLE = np.random.default_rng(77).integers(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def pretokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The joined bytes, where pre-tokens start and end in them, and the first pre-token of every text."""
    joined = b"".join(texts)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(joined, np.uint8)
    heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    cut = heads[cuts(code_points(joined), np.searchsorted(heads, bounds))]
    return data, cut[:-1], cut[1:], np.searchsorted(cut, bounds)


def pretoken_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(BASE, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * powers(INVERSE, len(data) + 1)[start])


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(tokenizer: str, lexicon: str | None) -> Encoder:
    """One per worker: later tasks of the worker find its tables and remembered words."""
    key = (tokenizer, lexicon)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer, SparkFiles.get(lexicon) if lexicon else None)
    return _ENCODERS[key]


def groups(column: pa.Array):
    """``(first row, texts as bytes)`` with some 1 MB of text each, or one longer text; null is empty."""
    texts = column.cast(pa.large_binary()).fill_null(b"").to_pylist()
    at = 0
    while at < len(texts):
        stop, size = at + 1, len(texts[at])
        while stop < len(texts) and size + len(texts[stop]) <= CHUNK:
            size += len(texts[stop])
            stop += 1
        yield at, texts[at:stop]
        at = stop


def _counts(share: float):
    def run(batches):
        codes, counts, total, words = [], [], 0, {}
        tables = 0
        for batch in batches:
            for _, texts in groups(batch.column(0)):
                data, start, end, _ = pretokens(texts)
                code, first, n = np.unique(pretoken_codes(data, start, end), return_index=True, return_counts=True)
                total += len(start)
                codes.append(code)
                counts.append(n)
                # a share of the corpus is a share of some chunk, so each frequent word is spelled out somewhere
                for i in np.flatnonzero((n >= share * len(start)) & (end[first] - start[first] <= 64)).tolist():
                    c = int(code[i])
                    if c not in words:
                        words[c] = data[start[first[i]]:end[first[i]]].tobytes()
                tables += len(code)
                if tables > 4_000_000:
                    yield _table(codes, counts, words)
                    codes, counts, words, tables = [], [], {}, 0
        if codes:
            yield _table(codes, counts, words)
    return run


def _table(codes, counts, words) -> pa.RecordBatch:
    code, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    n = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
    return pa.RecordBatch.from_pydict({"code": pa.array(code.view(np.int64)), "n": pa.array(n),
                                       "word": pa.array([words.get(c) for c in code.tolist()], pa.binary())})


def build_lexicon(docs: DataFrame, tokenizer: str, text: str = "text", share: float = LEXICON_SHARE) -> str:
    """Count all pre-tokens of the corpus, compile the frequent ones, hand the file to every executor."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexicon")
    rows = scratch.put(docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(
        _counts(share), "code long, n long, word binary"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    frequent = scratch.put(rows.groupBy("code").agg(F.sum("n").alias("n")).filter(F.col("n") >= share * total).select("code"))
    spelled = rows.filter("word is not null").select("code", "word").join(frequent, "code").groupBy("code").agg(F.max("word"))
    model = Merges(tokenizer)
    words = {bytes(r[1]): model.merge(bytes(r[1])) for r in spelled.limit(int(1 / share) + 1).collect()}
    scratch.drop(rows, frequent)
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), f"{os.urandom(8).hex()}.automaton")
    compile_lexicon(words, path)
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None, outputs: str, emit, text: str = "text") -> DataFrame:
    """``docs`` with columns ``outputs`` (a DDL list) that ``emit(encoder, texts)`` makes of each group.

    ``emit`` gets the worker's encoder and whole texts as bytes (null: empty) and returns one list per
    output column. Columns of the same names in ``docs`` are replaced.
    """
    names = [p.split()[0] for p in outputs.split(",")]
    rest = [c for c in docs.columns if c not in names]
    held = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema[:-1]], outputs])

    def run(batches):
        enc = encoder(tokenizer, lexicon)
        for batch in batches:
            for at, texts in groups(batch.column(batch.num_columns - 1)):
                part = batch.slice(at, len(texts))
                got = emit(enc, texts)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, got)], names=[*rest, *names])

    return held.mapInArrow(run, schema)


def digests(enc: Encoder, texts: list[bytes]) -> list[list]:
    """Number of ids, SHA-256 of the ids in decimal, SHA-256 of the text decoded from them."""
    ids = enc.encode_many(texts)
    decimal = list(map(enc.model.text.__getitem__, ids.flat.tolist()))
    at = ids.off.tolist()
    return [np.diff(ids.off), [hashlib.sha256(",".join(decimal[a:b]).encode()).hexdigest() for a, b in zip(at, at[1:])],
            [hashlib.sha256(t).hexdigest() for t in enc.decode_many(ids)]]


def ids_and_text(enc: Encoder, texts: list[bytes]) -> list[list]:
    ids = enc.encode_many(texts)
    return [[ids.flat[a:b] for a, b in zip(ids.off, ids.off[1:])], [t.decode() for t in enc.decode_many(ids)]]
