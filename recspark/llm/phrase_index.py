"""An FM-index of a sequence of word ids and of its reverse, whose intervals are extended to both sides together.

Id 0 ends a run: no phrase crosses it. As phrases have at most ``depth`` words, suffixes are sorted by their first ``depth`` ids only;
the interval of a phrase of ``depth`` - 1 words then still extends exactly. All phrases of one length are extended at once: the
intervals of a level don't overlap, so a level costs no more than the sequence's length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of ``keys``."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _suffix_order(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions by the ``depth`` ids that begin there (read round at the end), by doubling of sorted prefixes."""
    width, ranks = 1, _ranks(seq)
    while width < depth:
        step = min(width, depth - width)
        # the next prefix overlaps this one where depth isn't reached by doubling alone
        ranks = _ranks(ranks * (int(ranks.max()) + 1) + np.roll(ranks, -step))
        width += step
    return np.argsort(ranks, kind="stable")


class _Side:
    """Suffix order, Burrows-Wheeler symbols and last-to-first places of one direction."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.order = _suffix_order(seq, depth)
        self.symbols = np.roll(seq, 1)[self.order]
        self.to_first = np.empty(len(seq), np.int64)
        self.to_first[np.argsort(self.symbols, kind="stable")] = np.arange(len(seq))


@dataclass
class Level:
    """Phrases of one length: their places in the forward and the backward index, and how often they occur."""

    at: np.ndarray
    back: np.ndarray
    count: np.ndarray

    def pick(self, which: np.ndarray) -> Level:
        return Level(self.at[which], self.back[which], self.count[which])


@dataclass
class Extension:
    """One-word extensions of a level: the phrase that is extended, the word, and the longer phrases."""

    of: np.ndarray
    word: np.ndarray
    longer: Level


class PhraseIndex:
    """``seq`` must begin and end with 0 and hold no other run of zeros than single ones."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.seq = seq.astype(np.int64)
        self.symbols = int(self.seq.max(initial=0)) + 1
        self.forward, self.backward = _Side(self.seq, depth), _Side(self.seq[::-1], depth)

    def words(self) -> Level:
        count = np.bincount(self.seq, minlength=self.symbols)
        first = np.cumsum(count) - count
        some = np.flatnonzero(count[1:]) + 1
        return Level(first[some], first[some].copy(), count[some])

    def _extend(self, side: _Side, at: np.ndarray, other: np.ndarray, count: np.ndarray):
        """All extensions by a symbol before the phrase in ``side``: (phrase, symbol, place here, place on the other side, count)."""
        owner = np.repeat(np.arange(len(count)), count)
        begins = np.cumsum(count) - count
        place = at[owner] + np.arange(len(owner)) - begins[owner]
        keys = owner * self.symbols + side.symbols[place]
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        sizes = np.diff(np.append(first, len(keys)))
        of, symbol = np.divmod(keys[first], self.symbols)
        here = side.to_first[place[order[first]]]
        # on the other side the extended phrases follow one another by their new symbol
        there = other[of] + first - begins[of]
        real = symbol > 0
        return of[real], symbol[real], here[real], there[real], sizes[real]

    def right(self, level: Level) -> Extension:
        of, word, back, at, count = self._extend(self.backward, level.back, level.at, level.count)
        return Extension(of, word, Level(at, back, count))

    def left(self, level: Level) -> Extension:
        of, word, at, back, count = self._extend(self.forward, level.at, level.back, level.count)
        return Extension(of, word, Level(at, back, count))

    def text(self, level: Level, n: int) -> np.ndarray:
        """The ``n`` ids of each phrase."""
        start = self.forward.order[level.at]
        return self.seq[start[:, None] + np.arange(n)[None, :]]


def only_extension(e: Extension, n: int, count: np.ndarray) -> np.ndarray:
    """The word that extends every occurrence of a phrase, 0 where there is none."""
    out = np.zeros(n, np.int64)
    all_of_it = e.longer.count == count[e.of]
    out[e.of[all_of_it]] = e.word[all_of_it]
    return out


def pairs(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first ids, second ids, counts) of all phrases of two words."""
    index = PhraseIndex(seq, 2)
    level = index.words()
    first = index.text(level, 1)[:, 0]
    e = index.right(level)
    return first[e.of], e.word, e.longer.count


def phrases(seq: np.ndarray, least: int, most: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length from ``least`` to ``most``: (ids, counts, the only word to the left, the only word to the right) of all phrases."""
    index = PhraseIndex(seq, most + 1)
    level, out = index.words(), []
    for n in range(1, most + 1):
        after = index.right(level)
        if n >= least:
            before = index.left(level)
            out.append((index.text(level, n), level.count, *(only_extension(e, len(level.count), level.count) for e in (before, after))))
        level = after.longer
    return out
