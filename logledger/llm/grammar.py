"""Run-length grammars by recompression, and longest common extensions read from them.

A sequence of symbols is compressed by turns: a round of *blocks* replaces each maximal run of
one symbol by one symbol, a round of *pairs* splits the alphabet in two halves and replaces each
left symbol that a right one follows, together with it. Equal parts of a sequence get equal
symbols in each round, but for at most one symbol or one block at either end. After some
2.4 log2(n) rounds of each kind one symbol is left.

An extension of two places climbs from round to round while what is left over at either place
is equal, and from the first difference goes down again, taking one equal symbol or block in each
round at most. So a query takes a number of steps in proportion to the logarithm of its answer.
Queries are answered many at a time by numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Below this many symbols a sequence is not compressed further.
_SMALL = 1


@dataclass
class Round:
    """A sequence, and how the next one covers it. ``parent[i]``: the symbol of the next
    sequence that covers i; ``first[j]``: the leftmost symbol that j of the next one covers;
    ``blocks``: whether the next one was made of blocks."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    blocks: bool


def _round(symbols: np.ndarray, parent: np.ndarray, first: np.ndarray, blocks: bool) -> Round:
    return Round(*(a.astype(np.int32) for a in (symbols, parent, first)), blocks)


def _names(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the distinct pairs (one, other)."""
    keys = one.astype(np.int64) * (int(other.max(initial=0)) + 1) + other
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _half(symbols: np.ndarray, number: int) -> np.ndarray:
    """A half of the alphabet for each round, the same for equal symbols."""
    mixed = (symbols + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(40)) & np.uint64(1) == 1


def compress(symbols: np.ndarray) -> list[Round]:
    """All rounds over a sequence whose symbols are numbers from 0."""
    rounds, now, blocks = [], symbols.astype(np.int64), True
    while len(now) > _SMALL:
        starts = np.ones(len(now), bool)
        if blocks:
            starts[1:] = now[1:] != now[:-1]
        else:
            left = _half(now, len(rounds))
            starts[1:] = ~(left[:-1] & ~left[1:])
        first = np.flatnonzero(starts)
        sizes = np.diff(first, append=len(now))
        if len(first) < len(now):
            # One symbol alone keeps a name of its own: second part 0.
            second = sizes if blocks else np.where(sizes > 1, now[np.minimum(first + 1, len(now) - 1)] + 1, 0)
            after = _names(now[first], second)
            rounds.append(_round(now, np.cumsum(starts) - 1, first, blocks))
            now = after
        elif not blocks:
            # No pair this time: other halves next time.
            rounds.append(_round(now, np.arange(len(now)), first, False))
        blocks = not blocks
    rounds.append(_round(now, np.zeros(len(now)), np.zeros(0), True))
    return rounds


def mirrored(rounds: list[Round]) -> list[Round]:
    """The rounds of the reversed sequence: all rules are the same from either side."""
    turned = []
    for k, r in enumerate(rounds):
        n, above = len(r.symbols), len(r.first)
        ends = np.append(r.first[1:], n) - 1 if above else r.first
        top = k == len(rounds) - 1
        parent = r.parent if top else above - 1 - r.parent[::-1]
        turned.append(_round(r.symbols[::-1], parent, (n - 1 - ends)[::-1], r.blocks))
    return turned


class Extensions:
    """Longest common extensions to the right. The sequence must end with a symbol found
    nowhere else (and, for several sequences in one, each with one of its own)."""

    def __init__(self, rounds: list[Round]):
        self.rounds = rounds

    def _rest(self, level: int, at: np.ndarray) -> np.ndarray:
        """Symbols from each place to the end of what covers it."""
        r = self.rounds[level]
        end = np.append(r.first, len(r.symbols))[r.parent[at] + 1]
        return end - at

    def _place(self, level: int, at: np.ndarray) -> np.ndarray:
        """The place in the sequence itself where a symbol of a round begins."""
        for k in range(level - 1, -1, -1):
            at = self.rounds[k].first[at]
        return at

    def of(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """For pairs of different places: the number of equal symbols from them on."""
        found = np.zeros(len(one), np.int64)
        number, x, y = np.arange(len(one)), one.astype(np.int64), other.astype(np.int64)
        stopped: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for level, r in enumerate(self.rounds[:-1]):
            if not len(number):
                break
            # Climb where both places begin a symbol of the next round; else compare once.
            begin_x, begin_y = r.first[r.parent[x]] == x, r.first[r.parent[y]] == y
            compare = ~(begin_x & begin_y)
            same = r.symbols[x] == r.symbols[y]
            rest_x, rest_y = self._rest(level, x), self._rest(level, y)
            step = np.minimum(rest_x, rest_y) if r.blocks else 1
            # Blocks with unequal rests end in a difference; so does an unequal symbol.
            ends = compare & (~same | (rest_x != rest_y if r.blocks else False))
            moved = np.where(compare & same, step, 0)
            x, y = x + moved, y + moved
            if not r.blocks:
                # After one equal symbol both stand at a beginning, or the next ones differ.
                inside = compare & same & ~((r.first[r.parent[x]] == x) & (r.first[r.parent[y]] == y))
                ends |= inside
            stopped.append((level, number[ends], x[ends], y[ends]))
            go = ~ends
            number, x, y = number[go], r.parent[x[go]], r.parent[y[go]]
        if len(number):
            stopped.append((len(self.rounds) - 1, number, x, y))
        # Down again, all that stopped at a round or above together.
        waiting = {level: (n, a, b) for level, n, a, b in stopped}
        number = x = y = np.zeros(0, np.int64)
        for level in range(len(self.rounds) - 1, -1, -1):
            if len(number):
                r = self.rounds[level]
                x, y = r.first[x], r.first[y]
                same = r.symbols[x] == r.symbols[y]
                step = np.minimum(self._rest(level, x), self._rest(level, y)) if r.blocks else 1
                moved = np.where(same, step, 0)
                x, y = x + moved, y + moved
            if level in waiting:
                n, a, b = waiting[level]
                number, x, y = (np.concatenate(c) for c in ((number, n), (x, a), (y, b)))
        found[number] = x - one[number]
        return found
