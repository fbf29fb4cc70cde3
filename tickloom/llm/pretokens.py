"""Pre-tokenisation without regular expressions.

The split pattern of byte-level BPE, as fixed by the vocabulary files:

    's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^\\s L N]+|\\s+(?!\\S)|\\s+

A text becomes an array of code point classes. A small automaton reads them; its
transitions are functions on states, and composing functions is associative, so the
state before every character comes out of a scan over a table of compositions: blocks
are folded side by side, block results are scanned, and blocks are run again from
their start states. A table of (state, class) tells where tokens begin.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np

#: Unicode's White_Space property. Fixed values.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
#: Endings that an apostrophe forms a token with, by their length. Fixed values.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

# Classes: letter, number, other, space, other white space, an apostrophe before an
# ending of one or two letters, and the start of a text.
LETTER, NUMBER, OTHER, SPACE, GAP, SHORT, LONG, TEXT = range(8)
# States, by what the last character was: nothing or a gap, a space, in a run of
# letters, numbers or others, with one or two letters of an ending to come, and just
# past an ending.
FREE, SPACED, LETTERS, NUMBERS, OTHERS, ONE_LEFT, TWO_LEFT, ENDED = range(8)

BLOCK = 64


def _next(state: int, kind: int) -> int:
    if kind == TEXT:
        return FREE
    if state == TWO_LEFT:
        return ONE_LEFT
    if state == ONE_LEFT:
        return ENDED
    if kind in (SHORT, LONG):
        if state in (SPACED, OTHERS):
            return OTHERS
        return ONE_LEFT if kind == SHORT else TWO_LEFT
    return {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS, SPACE: SPACED, GAP: FREE}[kind]


def _begins(state: int, kind: int) -> bool:
    """Whether a character that is not white begins a token after ``state``."""
    if state in (SPACED, ONE_LEFT, TWO_LEFT):
        return False
    same = {LETTERS: (LETTER,), NUMBERS: (NUMBER,), OTHERS: (OTHER, SHORT, LONG)}
    return kind not in same.get(state, ())


@cache
def classes() -> np.ndarray:
    """The class of every code point, apostrophes counting as others."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            table[point] = LETTER
        elif major == "N":
            table[point] = NUMBER
    table[list(WHITE_SPACE)] = GAP
    table[0x20] = SPACE
    return table


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Functions reached by composing transitions.

    Returns the function of each class, the composition table (first, then second),
    each function's image of FREE, and the number of the identity.
    """
    start = [tuple(_next(s, k) for s in range(8)) for k in range(8)]
    identity = tuple(range(8))
    known = {identity: 0}
    for f in start:
        known.setdefault(f, len(known))
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in start:
            h = tuple(g[x] for x in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    order = list(known)
    table = np.empty((len(order), len(order)), np.uint16)
    for i, f in enumerate(order):
        for j, g in enumerate(order):
            table[i, j] = known[tuple(g[x] for x in f)]
    from_free = np.array([f[FREE] for f in order], np.uint8)
    return np.array([known[f] for f in start], np.uint16), table, from_free, np.uint16(0)


@cache
def _starts() -> np.ndarray:
    return np.array([[_begins(s, k) for k in range(8)] for s in range(8)])


def states_before(kinds: np.ndarray) -> np.ndarray:
    """The automaton's state before each character."""
    n = len(kinds)
    if not n:
        return np.empty(0, np.uint8)
    of_class, compose, from_free, identity = _monoid()
    rows = -(-n // BLOCK)
    functions = np.full(rows * BLOCK, identity, np.uint16)
    functions[:n] = of_class[kinds]
    columns = np.ascontiguousarray(functions.reshape(rows, BLOCK).T)
    flat, width = compose.ravel(), compose.shape[1]
    folded = columns[0].copy()
    for column in columns[1:]:
        folded = flat[folded.astype(np.uint32) * width + column]
    # An inclusive scan of the blocks by doubling, shifted to an exclusive one.
    step = 1
    while step < rows:
        ahead = folded[step:]
        folded = np.concatenate(
            (folded[:step], flat[folded[:-step].astype(np.uint32) * width + ahead])
        )
        step *= 2
    run = np.concatenate((np.array([identity], np.uint16), folded[:-1]))
    before = np.empty((BLOCK, rows), np.uint16)
    for i, column in enumerate(columns):
        before[i] = run
        run = flat[run.astype(np.uint32) * width + column]
    return from_free[before.T.ravel()[:n]]


def boundaries(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Positions where tokens begin, in code points of the joined texts.

    ``text_starts`` has the position of each text's first character; equal positions
    stand for empty texts.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    kinds = classes()[points]
    white = (kinds == SPACE) | (kinds == GAP)
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        padded = np.concatenate((points, np.zeros(2, points.dtype)))
        one, two = padded[marks + 1], padded[marks + 2]
        own_one = ~first[marks + 1]
        own_two = own_one & ~first[np.minimum(marks + 2, n)]
        short = own_one & np.isin(one, [ord(c) for c in SHORT_ENDINGS])
        long = np.zeros(len(marks), bool)
        for a, b in LONG_ENDINGS:
            long |= (one == ord(a)) & (two == ord(b))
        kinds[marks[short]] = SHORT
        kinds[marks[long & own_two]] = LONG
    # The state before a text's first character is that of an empty text: the
    # character's class is read as a start of text for the one before it.
    before = _with_resets(kinds, first[:n])
    begins = _starts()[before, kinds]
    after_white = np.concatenate((white[1:], [False])) | first[1:]
    was_white = np.concatenate(([False], white[:-1])) & ~first[:n]
    begins = np.where(white, ~was_white | ~after_white, begins)
    return np.flatnonzero(begins | first[:n])


def _with_resets(kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """States before each character, starting anew with each text."""
    at = np.flatnonzero(first)
    spots = np.arange(len(kinds)) + np.cumsum(first)
    spread = np.empty(len(kinds) + len(at), np.uint8)
    spread[spots] = kinds
    spread[spots[at] - 1] = TEXT
    return states_before(spread)[spots]
