"""Token counts under edits: a segment tree of pre-tokens per document, re-encoded where edits touch it."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tessel.llm.bpe import encoder, groups, pretokens
from tessel.llm.pretoken import cuts

#: Pre-tokens of a leaf.
LEAF = 16
#: Up to this many new words are merged one by one, more of them at once.
FEW = 32
#: Characters read beyond an edit at first, to find where old and new pre-tokens meet again.
REACH = 64
#: How far past its end a pre-token's bounds depend on the text.
LOOK = 2


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


#: Fixed value: pre-tokens of byte-level BPE as a pattern, for short stretches; texts are cut by ``cuts``.
_PIECE = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                       r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def _places(text: str) -> list[int]:
    """Where the pre-tokens of a short text begin, and its length."""
    return list(accumulate(map(len, _PIECE.findall(text)), initial=0))


class SegmentTree:
    """Pre-tokens of a text as (characters, tokens) in leaves, under a balanced tree of sums.

    ``count`` maps a list of pre-tokens to their numbers of tokens. Leaves hold text, so an edit copies no
    more than the leaves it touches; until then a leaf is a range of the first text's pre-tokens.
    ``encoded`` adds up the characters given to ``count``. ``at`` and ``sizes``, if known, are where the
    pre-tokens begin (and the text's length) and their numbers of tokens.
    """

    def __init__(self, text: str, count, at: np.ndarray | None = None, sizes: np.ndarray | None = None):
        self.count, self.encoded, self.first = count, len(text), text
        self.at = cuts(_points(text)) if at is None else at
        if sizes is None:
            places = self.at.tolist()
            sizes = count([text[a:b] for a, b in zip(places, places[1:])])
        self.sizes, n = np.asarray(sizes, np.int64), len(self.at) - 1
        self.leaves = [(i, min(i + LEAF, n)) for i in range(0, n, LEAF)] or [[]]
        if n:
            starts = np.arange(0, n, LEAF)
            self._build(np.diff(np.append(self.at[starts], self.at[-1])).tolist(), np.add.reduceat(self.sizes, starts).tolist())
        else:
            self._build([0], [0])

    def _words(self, i: int) -> list[tuple[str, int]]:
        leaf = self.leaves[i]
        if isinstance(leaf, tuple):
            low, high = leaf
            places = self.at[low:high + 1].tolist()
            leaf = [(self.first[a:b], n) for a, b, n in zip(places, places[1:], self.sizes[low:high].tolist())]
        return leaf

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        self.size = 1
        while self.size < len(self.leaves):
            self.size *= 2
        rest = [0] * (self.size - len(chars))
        self.chars, self.tokens = [0] * self.size + chars + rest, [0] * self.size + tokens + rest
        for i in range(self.size - 1, 0, -1):
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _set(self, i: int, leaf: list) -> None:
        self.leaves[i] = leaf
        i += self.size
        self.chars[i], self.tokens[i] = sum(len(w) for w, _ in leaf), sum(n for _, n in leaf)
        while i > 1:
            i //= 2
            self.chars[i], self.tokens[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.tokens[2 * i] + self.tokens[2 * i + 1]

    def __len__(self) -> int:
        return self.chars[1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _leaf(self, place: int) -> tuple[int, int]:
        """Leaf that holds character ``place``, and the place where it begins."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if place >= start + self.chars[i] and i + 1 < 2 * self.size and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return min(i - self.size, len(self.leaves) - 1), start

    def edit(self, start: int, stop: int, text: str) -> None:
        """Replace characters ``start:stop`` by ``text``."""
        start = max(0, min(start, len(self)))
        stop = max(start, min(stop, len(self)))
        first, begin = self._leaf(max(start - LOOK, 0))
        last, low = self._leaf(stop)
        # pre-tokens of the touched leaves, and their bounds
        held, place = [], begin
        for i in range(first, last + 1):
            held += self._words(i)
        ends = list(accumulate((len(w) for w, _ in held), initial=begin))[1:]
        safe = bisect_right(ends, start - LOOK)  # these end too early to see the edit
        place = ends[safe - 1] if safe else begin
        old = "".join(w for w, _ in held[safe:])
        while True:
            more = old[stop - place:]
            fresh = old[:start - place] + text + more
            at = _places(fresh)
            whole = last + 1 >= len(self.leaves)
            # a bound of new pre-tokens that is a bound of old ones too, behind the edit: from there on all agree
            shift = len(text) - (stop - start)
            inside = start - place + len(text)
            met = None
            if held:
                old_bounds = set(ends)
                for b in at[bisect_left(at, inside):]:
                    if b - shift + place in old_bounds and (whole or b + LOOK < len(fresh)):
                        met = b
                        break
            if met is not None or whole:
                break
            more_leaf = self._words(last + 1)
            last += 1
            held += more_leaf
            ends += list(accumulate((len(w) for w, _ in more_leaf), initial=ends[-1] if ends else begin))[1:]
            old += "".join(w for w, _ in more_leaf)
        met = len(fresh) if met is None else met
        new = [fresh[a:b] for a, b in zip(at, at[1:]) if b <= met]
        self.encoded += met
        rest = bisect_right(ends, met - shift + place)
        out = held[:safe] + list(zip(new, self.count(new))) + held[rest:]
        if len(out) <= 2 * LEAF * (last - first + 1):
            share = -(-len(out) // (last - first + 1)) if out else 0
            for k in range(last - first + 1):
                self._set(first + k, out[k * share:(k + 1) * share] if share else [])
        else:  # too much for its leaves: they are cut anew, and so are the sums above all leaves
            fresh = [out[i:i + LEAF] for i in range(0, len(out), LEAF)]
            sums = [(sum(len(w) for w, _ in leaf), sum(n for _, n in leaf)) for leaf in fresh]
            chars, tokens = ([*old[self.size:][:first], *got, *old[self.size:][last + 1:len(self.leaves)]]
                             for old, got in ((self.chars, [c for c, _ in sums]), (self.tokens, [n for _, n in sums])))
            self.leaves[first:last + 1] = fresh
            self._build(chars, tokens)

    def text(self) -> str:
        return "".join(w for i in range(len(self.leaves)) for w, _ in self._words(i))


def counter(enc):
    """Numbers of tokens of pre-tokens, each distinct one encoded once while it is remembered."""
    held: dict[str, int] = {}

    def count(words: list[str]) -> list[int]:
        if len(held) > 500_000:
            held.clear()
        new = list({w for w in words if w not in held})
        if len(new) <= FEW:
            held.update((w, len(enc.model.merge(w.encode()))) for w in new)
        else:
            raw = b"".join(w.encode() for w in new)
            ends = np.cumsum([len(w.encode()) for w in new])
            ids = enc.merge(np.frombuffer(raw, np.uint8), np.concatenate([[0], ends[:-1]]), ends)
            held.update(zip(new, np.diff(ids.off).tolist()))
        return [held[w] for w in words]
    return count


def _trees(texts: list[bytes], enc, count):
    """Trees of many texts, whose pre-tokens are cut and counted together."""
    data, start, end, off = pretokens(texts)
    place = enc.places(data, start, end)
    sizes = enc.lists.off[place + 1] - enc.lists.off[place]
    at = np.append(np.cumsum(np.append(0, (data & 0xC0) != 0x80))[start], 0)  # in characters
    for raw, low, high in zip(texts, off.tolist(), off[1:].tolist()):
        text = raw.decode()
        own = at[low:high + 1] - (at[low] if high > low else 0)
        own[-1] = len(text)
        yield SegmentTree(text, count, own, sizes[low:high])


def _edited(tokenizer: str):
    def run(batches):
        enc = encoder(tokenizer, None)
        count = counter(enc)
        for batch in batches:
            edits = batch.column(1).to_pylist()
            for row, texts in groups(batch.column(2)):
                rows = []
                for i, tree in enumerate(_trees(texts, enc, count)):
                    first, tree.encoded = tree.total, 0
                    for e in edits[row + i] or []:
                        if e is not None and e["start"] is not None:
                            tree.edit(e["start"], e["start"] if e["stop"] is None else e["stop"], e["text"] or "")
                    rows.append((first, len(edits[row + i] or []), tree.total, len(tree), tree.encoded))
                names = ("n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_chars_encoded")
                yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(row, len(rows)),
                                                  **{n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(names)}})
    return run


def count_edits(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """``(key, n_tokens, n_edits, n_tokens_after, n_chars_after, n_chars_encoded)`` for every row of ``docs``.

    ``edits`` is an array of (start, stop, text) in code points, applied in order, each to the text that the
    ones before left; places beyond the end mean the end; a null edit or start is skipped, a null stop is
    an insertion, a null text a deletion. Null texts count as empty. Counts are those of ordinary text:
    strings of special tokens are text. After the first count only regions touched by edits are encoded.
    """
    held = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{edits}`").cast("array<struct<start:int,stop:int,text:string>>").alias("e"),
                       F.col(f"`{text}`").cast("string").alias("t"))
    out = held.mapInArrow(_edited(tokenizer), f"id {held.schema['id'].dataType.simpleString()}, n_tokens long, n_edits long, n_tokens_after long, "
                                              "n_chars_after long, n_chars_encoded long")
    return out.withColumnRenamed("id", key)
