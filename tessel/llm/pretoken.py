"""Pre-tokens of byte-level BPE, found from runs of character classes."""

from __future__ import annotations

import numpy as np
import regex

LETTER, NUMBER, SPACE, WHITE = 1, 2, 3, 4
#: Letters of contractions.
_ONE = {ord(c) for c in "stmd"}
_TWO = {(ord(a), ord(b)) for a, b in ("re", "ve", "ll")}
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of every code point: letter, number, the blank, other white space, or 0."""
    global _classes
    if _classes is None:
        every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
        out = np.zeros(0x110000, np.uint8)
        for code, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                a, b = m.span()
                shift = [p if p < 0xD800 else p + 0x800 for p in (a, b - 1)]
                out[shift[0]:shift[1] + 1] = code
        out[0x20] = SPACE
        _classes = out
    return _classes


def cuts(points: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
    """Where the pre-tokens of a text (as code points) begin, and its length at the end.

    A pre-token is a run of letters, of numbers, or of other marks, with one blank before it if there is
    one; or a contraction after an apostrophe; or white space, whose last character stands apart if
    something follows. With ``bounds``, ``points`` holds several texts end to end.
    """
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    kind = classes()[points]
    run = np.minimum(kind, SPACE)
    start = np.empty(n + 1, bool)
    start[0] = start[n] = True
    np.not_equal(run[1:], run[:-1], out=start[1:n])
    fresh = np.zeros(n + 1, bool)  # first characters of texts
    if bounds is not None:
        fresh[bounds] = True
        start |= fresh
    white = run == SPACE
    turn = np.flatnonzero(white[:-1] & ~white[1:] & ~fresh[1:n])  # last white character before something else
    start[turn] = True
    start[turn[kind[turn] == SPACE] + 1] = False
    ticks = np.flatnonzero(points == 39)
    for at in ticks[start[ticks]].tolist():
        if at + 1 < n and run[at + 1] == LETTER and not fresh[at + 1]:
            two = points[at + 1:at + 3]
            tail = 0
            if two[0] in _ONE:
                tail = 1
            elif len(two) == 2 and (int(two[0]), int(two[1])) in _TWO and not fresh[at + 2]:
                tail = 2
            if tail:
                start[at + 1] = False
                start[at + 1 + tail] = True
    return np.flatnonzero(start)


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8").encode("utf-32-le"), np.uint32)


def split(text: str) -> list[str]:
    at = cuts(np.frombuffer(text.encode("utf-32-le"), np.uint32)).tolist()
    return [text[a:b] for a, b in zip(at, at[1:])]
