"""A bidirectional FM-index over a delimited vocabulary, searched for many patterns at once with numpy.

The vocabulary is one text: every word between delimiters, one sentinel at the end. The index holds the Burrows-Wheeler
transform of this text and of its reverse as wavelet matrices. A match is a pair of suffix-rank intervals, one in each; a step to
the left narrows the first exactly and moves the second by the number of smaller symbols met, a step to the right does the same the
other way round. So a search may start in the middle of a pattern and go on to either side.
"""

from __future__ import annotations

import numpy as np

SENTINEL, DELIMITER, FIRST = 0, 1, 2
#: Patterns that are searched together, and steps after which equal states of a search are merged.
TOGETHER, MERGED = 4096, 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start places of the suffixes in ascending order, by prefix doubling."""
    n, step = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        following = np.zeros(n, np.int64)
        following[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) > 0)])
        rank = fresh
        if rank[order[-1]] == n - 1:
            return order
        step = min(2 * step, n - 1)


class Wavelet:
    """Counts of symbols in any interval of a sequence."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        level = sequence.astype(np.int64)
        for bit in reversed(range(self.bits)):
            one = (level >> bit) & 1 > 0
            self.ones.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int64))
            self.zeros.append(int(len(level) - one.sum()))
            level = np.concatenate([level[~one], level[one]])
        self.base, _, _ = self._walk(np.arange(symbols), np.zeros(symbols, np.int64), np.zeros(symbols, np.int64))

    def _walk(self, c, low, high):
        less = np.zeros(len(c), np.int64)
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, zeros = self.ones[level], self.zeros[level]
            a, b = ones[low], ones[high]
            up = (c >> bit) & 1 > 0
            less += np.where(up, (high - low) - (b - a), 0)
            low, high = np.where(up, zeros + a, low - a), np.where(up, zeros + b, high - b)
        return low, high, less

    def counts(self, c, low, high):
        """How often each symbol stands before ``low``, before ``high``, and how many smaller ones stand between."""
        a, b, less = self._walk(c, low, high)
        return a - self.base[c], b - self.base[c], less


class Side:
    """The FM-index of one direction: a step puts a symbol before what is matched."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.places = suffix_array(text)
        self.last = text[self.places - 1]
        self.wavelet = Wavelet(self.last, symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))]).astype(np.int64)

    def step(self, c, low, high):
        a, b, less = self.wavelet.counts(c, low, high)
        return self.before[c] + a, self.before[c] + b, less


class Index:
    """Both directions over distinct ``words``."""

    def __init__(self, words: list[str]):
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.letters = np.unique(flat)
        self.symbols = len(self.letters) + FIRST
        ends = np.cumsum(lengths + 1)
        text = np.full(int(ends[-1]) + 2, DELIMITER, np.int64)
        text[-1] = SENTINEL
        inside = np.ones(len(text), bool)
        inside[np.concatenate([[0], ends, [len(text) - 1]])] = False
        text[inside] = np.searchsorted(self.letters, flat) + FIRST
        self.size = len(text)
        self.left = Side(text, self.symbols)
        backwards = np.concatenate([text[-2::-1], [SENTINEL]])
        self.right = Side(backwards, self.symbols)
        # a whole word between delimiters, matched in the reversed text, starts at the delimiter that follows it
        row = np.arange(self.right.before[DELIMITER], self.right.before[DELIMITER + 1])
        self.first_row = int(row[0])
        self.word_of_row = np.searchsorted(ends, len(text) - 2 - self.right.places[row])

    def codes(self, flat: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 for letters that no word has."""
        at = np.minimum(np.searchsorted(self.letters, flat), len(self.letters) - 1)
        return np.where(self.letters[at] == flat, at + FIRST, -1)

    def one_off(self, patterns: list[str], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (pattern, word) of places in the two lists, where the word starts with the first ``halves`` letters of the
        pattern and becomes the pattern by one inserted, deleted or replaced letter behind them."""
        found = [self._one_off(patterns[i:i + TOGETHER], halves[i:i + TOGETHER]) for i in range(0, len(patterns), TOGETHER)]
        at = np.concatenate([f[0] + i * TOGETHER for i, f in enumerate(found)]) if found else np.empty(0, np.int64)
        return at, np.concatenate([f[1] for f in found]) if found else at

    def _one_off(self, patterns, halves):
        lengths = np.fromiter(map(len, patterns), np.int64, len(patterns))
        flat = self.codes(np.frombuffer("".join(patterns).encode("utf-32-le"), "<u4"))
        start = np.cumsum(lengths) - lengths
        q, low, high, r_low, r_high = self._exact(flat, start, np.asarray(halves, np.int64))
        clean = (q, r_low, r_high)
        late = tuple(np.empty(0, np.int64) for _ in range(3))
        out, at = [], halves.copy()
        step = 0
        while len(clean[0]) or len(late[0]):
            # every letter that may follow the clean matches, once for all kinds of errors and for going on without one
            state, c, c_low, c_high = self._every_letter(*clean[1:])
            own = clean[0][state]
            place = at[own] + step
            more = place < lengths[own]
            wanted = np.where(more, flat[np.minimum(start[own] + place, len(flat) - 1)], -1)
            inserted = (own, c_low, c_high)
            late = tuple(np.concatenate(x) for x in zip(late, inserted))
            if step % MERGED == MERGED - 1:
                late = tuple(np.unique(np.stack(late), axis=1))
            # patterns at their end are whole words where the delimiter follows
            done = at[late[0]] + step == lengths[late[0]]
            e_low, e_high, _ = self.right.step(np.full(int(done.sum()), DELIMITER), late[1][done], late[2][done])
            hit = e_high > e_low
            out.append(np.stack([late[0][done][hit], self.word_of_row[e_low[hit] - self.first_row]]))
            late = tuple(x[~done] for x in late)
            # one letter on: errors made before match it, errors made here replace or skip it
            l_next = flat[start[late[0]] + at[late[0]] + step] if len(late[0]) else np.empty(0, np.int64)
            l_low, l_high, _ = self.right.step(np.maximum(l_next, 0), late[1], late[2])
            alive = (l_high > l_low) & (l_next >= 0)
            replaced = more & (c != wanted)
            skip = at[clean[0]] + step < lengths[clean[0]]
            late = tuple(np.concatenate(x) for x in zip(
                (late[0][alive], l_low[alive], l_high[alive]), (own[replaced], c_low[replaced], c_high[replaced]), tuple(x[skip] for x in clean)))
            on = more & (c == wanted)
            clean = (own[on], c_low[on], c_high[on])
            step += 1
        pairs = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.empty((2, 0), np.int64)
        return pairs[0], pairs[1]

    def _exact(self, flat, start, halves):
        """Intervals of the delimiter and the first half: from the last letter of the half to the left."""
        q = np.arange(len(halves))
        low, high = np.zeros(len(q), np.int64), np.full(len(q), self.size, np.int64)
        r_low, r_high = low.copy(), high.copy()
        done = []
        for step in range(int(halves.max(initial=0)) + 1):
            if not len(q):
                break
            last = halves[q] == step
            c = np.where(last, DELIMITER, flat[np.minimum(start[q] + np.maximum(halves[q] - 1 - step, 0), len(flat) - 1)])
            n_low, n_high, less = self.left.step(np.maximum(c, 0), low, high)
            r_low = r_low + less
            r_high = r_low + (n_high - n_low)
            low, high = n_low, n_high
            alive = (high > low) & (c >= 0)
            out = alive & last
            done.append([x[out] for x in (q, low, high, r_low, r_high)])
            q, low, high, r_low, r_high = (x[alive & ~last] for x in (q, low, high, r_low, r_high))
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (q, low, high, r_low, r_high)

    def _every_letter(self, low, high):
        """Each state with every letter that follows it: place of the state, letter, interval."""
        letters = self.symbols - FIRST
        width = high - low
        wide = np.flatnonzero(width > letters)
        state = np.repeat(wide, letters)
        c = np.tile(np.arange(FIRST, self.symbols), len(wide))
        narrow = np.flatnonzero((width <= letters) & (width > 0))
        n = width[narrow]
        s = np.repeat(narrow, n)
        row = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[narrow], n)
        key = np.unique(s * self.symbols + self.right.last[row])
        state, c = np.concatenate([state, key // self.symbols]), np.concatenate([c, key % self.symbols])
        letter = c >= FIRST
        state, c = state[letter], c[letter]
        c_low, c_high, _ = self.right.step(c, low[state], high[state])
        there = c_high > c_low
        return state[there], c[there], c_low[there], c_high[there]
