"""Benchmark passages in documents: SimHash of item-sized windows, multi-index lookup, exact check."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessel.llm.text import BASE, Words, chunks, mix

SHINGLE = 5
#: Items per pass over the documents: what one broadcast index holds.
ITEMS = 20_000
#: Text per pass, in characters.
ITEM_CHARS = 32_000_000
#: Windows whose matches a worker remembers.
REMEMBERED = 50_000
_BITS = np.arange(64, dtype=np.uint64)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_MAP = 1 << 22


def runs(code: np.ndarray, k: int) -> np.ndarray:
    """Codes of all runs of ``k`` consecutive words."""
    n = len(code) - k + 1
    out = np.full(max(n, 0), k, np.uint64)
    for j in range(k):
        out = out * np.uint64(BASE) + code[j:j + len(out)]
    return mix(out)


def simhash(rows: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each row of codes; a repeated code counts as often as it stands there."""
    votes = ((rows[:, :, None] >> _BITS) & np.uint64(1)).sum(1, dtype=np.int64)
    return ((2 * votes > rows.shape[1]).astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


def radius(similarity: float) -> int:
    """Hamming radius that a pair at the threshold exceeds with odds under one in a million."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(64 * p + 5 * math.sqrt(64 * p * (1 - p)))


class Blocks:
    """Fingerprints indexed by eight blocks of eight bits.

    Two fingerprints within ``r`` differ by at most r // 8 in some block, so the union of the lists for
    block values that near holds every fingerprint within ``r``.
    """

    def __init__(self, prints: np.ndarray, r: int):
        self.prints, self.r = prints, r
        parts = prints[:, None].view(np.uint8).reshape(len(prints), 8)
        near = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= r // 8
        self.lists = [[np.flatnonzero(near[v][parts[:, b]]) for v in range(256)] for b in range(8)]

    def near(self, one: np.uint64) -> np.ndarray:
        value = np.array([one], np.uint64).view(np.uint8)
        met = np.unique(np.concatenate([self.lists[b][value[b]] for b in range(8)]))
        gap = _ONES[(self.prints[met] ^ one)[:, None].view(np.uint8).reshape(len(met), 8)].sum(1)
        return met[gap <= self.r]


def weighted(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two rows of codes: sum of smaller counts over sum of larger ones."""
    codes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(at[:len(a)], minlength=len(codes))
    y = np.bincount(at[len(a):], minlength=len(codes))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class Items:
    def __init__(self, ids: list[int], texts: list[str], similarity: float):
        self.similarity = similarity
        self.seen: dict[tuple[int, bytes], list] = {}
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, Blocks]] = {}
        held: dict[int, list] = {}
        for i, text in zip(ids, texts):
            raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
            code = Words(raw, np.array([0, len(raw)])).code
            if len(code):
                held.setdefault(len(code), []).append((i, runs(code, min(SHINGLE, len(code)))))
        self.known: dict[int, np.ndarray] = {}
        for size, got in held.items():
            rows = np.array([g[1] for g in got])
            self.by_size[size] = (np.array([g[0] for g in got]), rows, Blocks(simhash(rows), radius(similarity)))
            k = min(SHINGLE, size)
            self.known[k] = np.union1d(self.known.get(k, np.zeros(0, np.uint64)), rows.ravel())
        self.maps = {}
        for k, codes in self.known.items():
            self.maps[k] = np.zeros(_MAP, bool)
            self.maps[k][codes & np.uint64(_MAP - 1)] = True

    def in_words(self, words: Words):
        """``(text, item, first word, words, similarity)`` of every window that reaches the threshold."""
        hits = {}
        for k, codes in self.known.items():
            run = runs(words.code, k)
            hit = self.maps[k][run & np.uint64(_MAP - 1)]
            at = np.flatnonzero(hit)
            hit[at] = codes[np.minimum(np.searchsorted(codes, run[at]), len(codes) - 1)] == run[at]
            hits[k] = run, np.flatnonzero(hit)
        touched = np.unique(np.concatenate([np.searchsorted(words.off, at, side="right") - 1 for _, at in hits.values()])
                            if hits else np.zeros(0, int))
        for d in touched.tolist():
            a, b = int(words.off[d]), int(words.off[d + 1])
            for k, (run, at) in hits.items():
                mine = np.zeros(max(b - a - k + 1, 0) + 1, np.int64)
                lo, hi = np.searchsorted(at, [a, b - k + 1])
                if hi <= lo:
                    continue
                mine[at[lo:hi] - a + 1] = 1
                total = np.cumsum(mine)
                for size in self.by_size:
                    n = size - k + 1
                    if min(SHINGLE, size) != k:
                        continue
                    if b - a < size:  # the whole text is the only window
                        short = b - a - k + 1
                        if short >= self.similarity * n - 1e-9 and total[short] >= math.ceil(
                                self.similarity / (1 + self.similarity) * (n + short) - 1e-9):
                            for item, found in self.matches(size, run[a:a + short]):
                                yield d, item, 0, b - a, found
                        continue
                    # windows with fewer benchmark shingles than any window at the threshold has
                    need = math.ceil(2 * self.similarity / (1 + self.similarity) * n - 1e-9)
                    for start in np.flatnonzero(total[n:] - total[:-n] >= need).tolist():
                        for item, found in self.matches(size, run[a + start:a + start + n]):
                            yield d, item, start, size, found

    def matches(self, size: int, window: np.ndarray) -> list[tuple[int, float]]:
        """Items of ``size`` words that a window reaches the threshold with; passages recur, so results are remembered."""
        key = size, window.tobytes()
        if key not in self.seen:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            ids, rows, blocks = self.by_size[size]
            near = [(int(ids[i]), weighted(window, rows[i])) for i in blocks.near(simhash(window[None, :])[0]).tolist()]
            self.seen[key] = [(i, x) for i, x in near if x >= self.similarity]
        return self.seen[key]


def _finder(held):
    def run(batches):
        items = held.value
        for batch in batches:
            out = {}
            for row, words in chunks(batch.column(1)):
                for d, item, start, size, found in items.in_words(words):
                    key = (row + d, item)
                    if key not in out or (-found, start) < (-out[key][2], out[key][0]):
                        out[key] = (start, size, found)
            if out:
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column(0).take(pa.array([k[0] for k in out])), "item_id": pa.array([k[1] for k in out], pa.int64()),
                    "start_word": pa.array([v[0] for v in out.values()], pa.int64()),
                    "n_words": pa.array([v[1] for v in out.values()], pa.int64()),
                    "similarity": pa.array([v[2] for v in out.values()], pa.float64())})
    return run


def find_passages(docs: DataFrame, items: DataFrame, similarity: float = 0.8, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(key, item_id, start_word, n_words, similarity)``: the best window of each document for each item.

    Windows have as many words as the item, or all words of a shorter document; shingles have five words (all of them in a shorter item), and
    similarity is their weighted Jaccard. Ties go to the first window. Null and wordless texts and items
    match nothing; repeated rows give repeated results; a null item key is left out. Documents are read once
    for every ITEMS items or ITEM_CHARS characters of them, each time with a bounded index.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    wanted = items.select(F.col(f"`{item_key}`").cast("long").alias("i"), F.col(f"`{item_text}`").cast("string").alias("t")).filter(
        "i is not null and t is not null").distinct()
    n, chars = wanted.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    passes = max(1, math.ceil(n / ITEMS), math.ceil(chars / ITEM_CHARS))
    out = None
    for p in range(passes):
        part = wanted.filter(F.expr(f"pmod(xxhash64(i), {passes})") == p).orderBy("i", "t").collect()
        held = spark.sparkContext.broadcast(Items([r[0] for r in part], [r[1] for r in part], similarity))
        got = plain.mapInArrow(_finder(held), "id long, item_id long, start_word long, n_words long, similarity double")
        out = got if out is None else out.unionAll(got)
    return out.withColumnRenamed("id", key)
