"""Phrase collocations from suffix trees built group by group, after vertical partitioning.

A suffix is the run of up to five words that starts at a place of a piece of text. It is cut before the first
word pair that is too rare to be in a phrase, so its words and pairs are all frequent. Word prefixes are
lengthened, one to three words, until the suffixes that begin with one fit a share of the memory budget; groups
of prefixes are then dealt to tasks, each of which sorts its suffixes and reads the tree off them in one pass:
a node at depth d is a run of equal d-word beginnings, its count the total of its leaves.

Words are 64-bit keys of (language, word); phrases are lists of keys. Rare words and pairs are left out of
suffixes through bitmaps of a fixed largest size, which may let some through and never hold a frequent one back.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tessel.llm.scratch import Scratch
from tessel.llm.text import BASE, CHUNK, INVERSE, LOWER, mix, powers

#: Words of the longest phrase.
DEPTH = 5
#: Suffixes of one group; a group is at least 1 / MOST of all suffixes, and a prefix is lengthened above 1 / 8 of a group.
GROUP, MOST = 2_000_000, 4096
#: Bits of a bitmap: 16 for each entry, up to this many (16 MB).
BITS = 1 << 27
#: Distinct words or suffixes that a task holds before it hands them on.
HELD = 200_000
KEYS = [f"k{i + 1}" for i in range(DEPTH)]
_BREAK, _BLANK = 2, 1
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 9]] = _BLANK
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_BYTE = (np.random.default_rng(4711).integers(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1))[LOWER]


class Pieces:
    """Words of many texts: ``key`` of (language, word), ``joint[i]`` if word i + 1 follows in the same piece."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lang: np.ndarray):
        n = len(data)
        kind = _KIND[data]
        inside = kind == 0
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        if n:
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[bounds[:-1][bounds[:-1] < n]] = False
            after[bounds[1:][bounds[1:] > 0] - 1] = False
        self.data = data
        self.start, self.end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        off = np.searchsorted(self.start, bounds)
        self.row = np.repeat(np.arange(len(bounds) - 1), np.diff(off))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(BASE, n), out=total[1:])
        code = mix((total[self.end] - total[self.start]) * powers(INVERSE, n + 1)[self.start])
        self.key = mix(code + lang[self.row])
        self.key[self.key == 0] = 1  # 0 is no word
        broken = np.cumsum(kind == _BREAK)
        self.joint = np.zeros(len(self.key), bool)
        if len(self.key):
            self.joint[:-1] = (self.row[1:] == self.row[:-1]) & (broken[self.start[1:]] == broken[self.end[:-1] - 1])

    def word(self, i: int) -> str:
        return LOWER[self.data[self.start[i]:self.end[i]]].tobytes().decode()


def _pieces(batch: pa.RecordBatch):
    """``(Pieces, language of every row)`` for the rows of (lang, text), some 1 MB or one longer text at a time."""
    langs = batch.column(0).cast(pa.string()).fill_null("und").to_pylist()
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    codes = np.array([known[x] for x in langs], np.uint64)
    column = batch.column(1).cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + CHUNK, side="right")) - 1)
        yield Pieces(data[bounds[row]:bounds[stop]], bounds[row:stop + 1] - bounds[row], codes[row:stop]), langs[row:stop]
        row = stop


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _words(batches):
    """Distinct words of a task with their counts."""
    def table():
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
        lang, word = zip(*map(spelled.__getitem__, key.tolist()))
        return pa.RecordBatch.from_arrays([_signed(key), pa.array(lang), pa.array(word), pa.array(n)], names=["key", "lang", "word", "n"])

    keys, counts, spelled, size = [], [], {}, 0
    for batch in batches:
        for pieces, langs in _pieces(batch):
            key, first, n = np.unique(pieces.key, return_index=True, return_counts=True)
            keys.append(key)
            counts.append(n)
            size += len(key)
            for k, i in zip(key.tolist(), first.tolist()):
                if k not in spelled:
                    spelled[k] = langs[pieces.row[i]], pieces.word(i)
            if len(spelled) > HELD or size > 4 * HELD:  # common words come again in every part of a text
                yield table()
                keys, counts, spelled, size = [], [], {}, 0
    if spelled:
        yield table()


def pair_code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(BASE) + b)


class Bitmap:
    """Which codes may be frequent. Every frequent one's bit is set."""

    def __init__(self, bits: int, parts: dict[int, bytes]):
        self.mask, self.parts = np.uint64(bits - 1), parts
        self.bits = bits
        self.flags = None

    def __getstate__(self):
        return self.bits, self.parts

    def __setstate__(self, state):
        self.__init__(*state)

    def has(self, code: np.ndarray) -> np.ndarray:
        if self.flags is None:
            self.flags = np.zeros(self.bits // 8, np.uint8)
            for part, held in self.parts.items():
                self.flags[part * 4096:part * 4096 + 4096] = np.frombuffer(held, np.uint8)[:len(self.flags)]
        at = code & self.mask
        return (self.flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(codes: DataFrame, column: str):
    """Broadcast ``Bitmap`` of a column of codes; 4 KB rows reach the driver, 16 MB at most."""
    n = codes.count()
    bits = min(BITS, max(1 << 15, 1 << math.ceil(math.log2(16 * n + 1))))
    at = F.col(column).bitwiseAND(bits - 1)
    rows = (codes.select(F.shiftright(at, 15).cast("int").alias("part"), at.bitwiseAND(32767).alias("at")).groupBy("part")
            .agg(F.bitmap_construct_agg("at").alias("held")).collect())
    return codes.sparkSession.sparkContext.broadcast(Bitmap(bits, {r["part"]: bytes(r["held"]) for r in rows}))


def _pair_codes(batches):
    for batch in batches:
        a, b = (batch.column(j).to_numpy().view(np.uint64) for j in (0, 1))
        yield pa.RecordBatch.from_arrays([_signed(pair_code(a, b))], names=["code"])


def _combined(width: int, emit):
    """``emit(pieces)`` gives rows of ``width`` keys and one code a row; equal rows of a task become one, without
    the code: it cannot be compressed, and keys give it back."""
    def run(batches):
        def flush():
            code, first, inverse = np.unique(np.concatenate(codes), return_index=True, return_inverse=True)
            n = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
            kept = np.concatenate(rows)[first]
            return code, kept, n

        def batch_of(kept, n):
            arrays = [*(_signed(np.ascontiguousarray(kept[:, j])) for j in range(width)), pa.array(n)]
            return pa.RecordBatch.from_arrays(arrays, names=[*KEYS[:width], "n"])

        codes, rows, counts, size = [], [], [], 0
        for batch in batches:
            for pieces, _ in _pieces(batch):
                row, code = emit(pieces)
                code, first, n = np.unique(code, return_index=True, return_counts=True)
                codes.append(code)
                rows.append(row[first])
                counts.append(n)
                size += len(code)
                if size > 4 * HELD:
                    code, kept, n = flush()
                    if len(code) > HELD:
                        yield batch_of(kept, n)
                        codes, rows, counts, size = [], [], [], 0
                    else:
                        codes, rows, counts, size = [code], [kept], [n], len(code)
        if size:
            yield batch_of(*flush()[1:])
    return run


def _pairs(words):
    def emit(pieces: Pieces):
        frequent = words.value.has(pieces.key)
        at = np.flatnonzero(pieces.joint[:-1] & frequent[:-1] & frequent[1:]) if len(pieces.key) else np.zeros(0, np.int64)
        row = np.stack([pieces.key[at], pieces.key[at + 1]], axis=1)
        return row, pair_code(row[:, 0], row[:, 1])
    return _combined(2, emit)


def _suffixes(pairs):
    """Suffixes of three words or more; what one and two words count is known by then."""
    def emit(pieces: Pieces):
        n = len(pieces.key)
        linked = np.zeros(n + DEPTH, bool)
        key = np.zeros(n + DEPTH, np.uint64)
        key[:n] = pieces.key
        if n:
            linked[:n - 1] = pieces.joint[:-1] & pairs.value.has(pair_code(pieces.key[:-1], pieces.key[1:]))
        at = np.flatnonzero(linked[:n] & linked[1:n + 1])
        row = np.zeros((len(at), DEPTH), np.uint64)
        live, code = np.ones(len(at), bool), np.zeros(len(at), np.uint64)
        for j in range(DEPTH):
            row[:, j] = np.where(live, key[at + j], np.uint64(0))
            code = code * np.uint64(BASE) + row[:, j]
            live = live & linked[at + j]
        return row, mix(code)
    return _combined(DEPTH, emit)


def _read_tree(least: int):
    """Nodes of three words or more that occur often enough, from sorted suffixes with their counts."""
    def run(batches):
        open_key, open_n = None, [0] * (DEPTH + 1)  # the last suffix, and what its nodes have counted so far

        def made(rows, counts):
            if rows:
                out = np.array(rows, np.int64)
                yield pa.RecordBatch.from_arrays([*(pa.array(out[:, j]) for j in range(DEPTH)), pa.array(counts, pa.int64())], names=[*KEYS, "a"])

        def node(key, d):
            return [*key[:d], *[0] * (DEPTH - d)]

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(j).to_numpy() for j in range(DEPTH)], axis=1)
            n = batch.column(DEPTH).to_numpy()
            differs = np.ones((len(key), DEPTH), bool)
            differs[1:] = key[1:] != key[:-1]
            if open_key is not None:
                differs[0] = key[0] != open_key
            new = np.logical_or.accumulate(differs, axis=1)
            rows, counts = [], []
            for d in range(3, DEPTH + 1):
                starts = np.flatnonzero(new[:, d - 1])
                if not len(starts):
                    open_n[d] += int(n.sum())
                    continue
                head = int(n[:starts[0]].sum()) + open_n[d]
                if open_key is not None and head >= least and open_key[d - 1]:
                    rows.append(node(open_key.tolist(), d))
                    counts.append(head)
                total = np.add.reduceat(n, starts)
                open_n[d] = int(total[-1])
                done = starts[:-1][(total[:-1] >= least) & (key[starts[:-1], d - 1] != 0)]
                rows += [node(k, d) for k in key[done].tolist()]
                counts += total[:-1][(total[:-1] >= least) & (key[starts[:-1], d - 1] != 0)].tolist()
            open_key = key[-1].copy()
            yield from made(rows, counts)
        if open_key is not None:
            kept = [d for d in range(3, DEPTH + 1) if open_n[d] >= least and open_key[d - 1]]
            yield from made([node(open_key.tolist(), d) for d in kept], [open_n[d] for d in kept])
    return run


def _dealt(suffixes: DataFrame, scratch: Scratch) -> DataFrame:
    """Suffixes with ``group``, a code of their prefix, so that no prefix of under three words is above the budget."""
    total = suffixes.count()
    group = max(GROUP, total // MOST)
    out, prefix = suffixes, F.xxhash64("k1")
    for d in (1, 2):
        sizes = (out.filter("heavy") if d > 1 else out).groupBy(*KEYS[:d]).count().filter(F.col("count") > group // 8)
        heavy = scratch.put(sizes.select(*KEYS[:d], F.lit(True).alias("heavy")))  # 8 * MOST rows at most
        if heavy.isEmpty():
            break
        if d > 1:
            out = out.drop("heavy")
        out = out.join(F.broadcast(heavy), KEYS[:d], "left").withColumn("heavy", F.coalesce("heavy", F.lit(False)))
        prefix = F.when(F.col("heavy"), F.xxhash64(*KEYS[:d + 1])).otherwise(F.col("group") if d > 1 else prefix)
        out = out.withColumn("group", prefix)
    if "group" not in out.columns:
        out = out.withColumn("group", prefix)
    tasks = max(math.ceil(total / group), int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return out.select(*KEYS, "n", "group").repartition(tasks, "group").sortWithinPartitions(*KEYS).select(*KEYS, "n")


def candidates(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100) -> tuple[DataFrame, DataFrame]:
    """``words (key, lang, word, n)`` of the whole table, and phrases ``(k1 .. k5, a)`` of two to five words that
    occur ``least`` times; unused keys are 0."""
    scratch = Scratch(docs.sparkSession, "phrases")
    texts = docs.select(F.col(f"`{lang}`").cast("string"), F.col(f"`{text}`").cast("string"))
    words = scratch.put(texts.mapInArrow(_words, "key long, lang string, word string, n long").groupBy("key", "lang", "word").agg(F.sum("n").alias("n")))
    frequent = bitmap(words.filter(F.col("n") >= least), "key")
    pairs = scratch.put(texts.mapInArrow(_pairs(frequent), "k1 long, k2 long, n long").groupBy("k1", "k2").agg(F.sum("n").alias("a"))
                        .filter(F.col("a") >= least))
    linked = bitmap(pairs.select("k1", "k2").mapInArrow(_pair_codes, "code long"), "code")
    suffixes = scratch.put(texts.mapInArrow(_suffixes(linked), ", ".join(f"{k} long" for k in KEYS) + ", n long"))
    longer = _dealt(suffixes, scratch).mapInArrow(_read_tree(least), ", ".join(f"{k} long" for k in KEYS) + ", a long")
    none = [F.lit(0).cast("long").alias(k) for k in KEYS[2:]]
    found = scratch.put(pairs.select("k1", "k2", *none, "a").unionByName(longer))
    scratch.drop(pairs, suffixes)
    return words, found


def _padded(keys: list) -> list:
    return [k if not isinstance(k, str) else F.col(k) for k in keys] + [F.lit(0).cast("long")] * (DEPTH - len(keys))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of every language by score: ``lang, rank, phrase, a, l, r, n, score``.

    A null text is empty and a null language ``und``; repeated documents count as often as they occur; without
    a phrase there is no row. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "scores")
    words, found = candidates(docs, lang, text, least)
    size = sum(F.when(F.col(k) != 0, 1).otherwise(0) for k in KEYS)
    found = found.withColumn("m", size)
    # a phrase inside a longer one that is as frequent is inside one that has one word more and is as frequent
    parts = F.array(F.struct(*[c.alias(k) for c, k in zip(_cut(0, F.col("m") - 1), KEYS)]), F.struct(*[c.alias(k) for c, k in zip(_cut(1, F.col("m") - 1), KEYS)]))
    inside = found.filter("m > 2").select(F.explode(parts).alias("p"), "a").select("p.*", "a")
    kept = found.join(inside, [*KEYS, "a"], "left_anti")
    frequent = words.filter(F.col("n") >= least)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = frequent.select("key", "lang")
    kept = scratch.put(kept.join(known, F.col("k1") == F.col("key")).drop("key").join(total, "lang"))
    counts = scratch.put(frequent.select(*[c.alias(k) for c, k in zip(_padded(["key"]), KEYS)], F.col("n").alias("f")).unionByName(found.select(*KEYS, F.col("a").alias("f"))))
    cuts = F.explode(F.transform(F.sequence(F.lit(1), F.col("m") - 1), lambda k: k)).alias("cut")
    held = kept.select("*", cuts)
    first, rest = _cut(0, F.col("cut")), _cut(F.col("cut"), F.col("m") - F.col("cut"))
    held = held.select("*", F.struct(*[c.alias(k) for c, k in zip(first, KEYS)]).alias("first"), F.struct(*[c.alias(k) for c, k in zip(rest, KEYS)]).alias("rest"))
    by = F.struct(*KEYS)
    left = counts.select(by.alias("first"), F.col("f").alias("l"))
    right = counts.select(by.alias("rest"), F.col("f").alias("r"))
    score = F.expr("(cast(1000 as decimal(5,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    scored = (held.join(left, "first").join(right, "rest").withColumn("score", score)
              .groupBy(*KEYS, "a", "n", "lang").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
              .select(*KEYS, "a", "n", "lang", "low.score", "low.l", "low.r"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = scratch.put(scored.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= top).drop("rank"))
    spelled = (best.select(by.alias("p"), F.posexplode(F.array(*KEYS)).alias("at", "key")).filter("key <> 0").join(frequent.select("key", "word"), "key")
               .groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase")))
    named = best.withColumn("p", by).join(spelled, "p")
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (named.withColumn("rank", F.row_number().over(final).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def _cut(start, size) -> list:
    """The keys of ``size`` words from word ``start`` on, as five columns."""
    start = F.lit(start) if isinstance(start, int) else start
    every = F.concat(F.slice(F.array(*KEYS), start + 1, size), F.array_repeat(F.lit(0).cast("long"), DEPTH - size))
    return [F.get(every, F.lit(j)) for j in range(DEPTH)]
