"""A bidirectional FM-index over a vocabulary, and search for words at one edit from others.

The text is ``|w1|w2|...|wn|``: a word between its delimiters occurs once. The index holds the rank tables of the text's and of the
reversed text's Burrows-Wheeler transform. A pattern is a pair of suffix-rank intervals of equal size, one in
each; adding a symbol on the left steps through the first table and narrows the second in step, and the reverse.

Two searches find every word that has another symbol somewhere, or one more: the edit lies in one half, so the other
half is in the word as it is. The first search goes right from the start, over the first half without an edit, then on over the
second with at most one; the second goes left from the end. An interval of at most ``IN_TEXT`` suffixes is not followed
further: its words are looked at in the text. All patterns of a block move in step, as arrays; equal states of a pattern are one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

END, BAR = 0, 1
#: Rank tables keep every 16th row and count the rest.
STRIDE = 16
IN_TEXT = 4
#: Symbols of the patterns that are searched for at a time.
CELLS = 1 << 18


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words in a row, and the number of each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.fromiter(map(len, words), np.int64, len(words))


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of every key among the different ones, and an order by key."""
    order = np.argsort(keys)
    steps = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.append(0, np.cumsum(steps[1:] != steps[:-1]))
    return rank, order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``text``, which ends in its one least symbol; by doubling what is compared."""
    n, bits = len(text), int(text.max()).bit_length()
    key, reach = np.zeros(n, np.int64), 62 // bits
    for k in range(reach):
        key <<= bits
        key[: max(0, n - k)] |= text[k:]
    rank, order = _dense(key)
    while rank[order[-1]] < n - 1:
        after = np.zeros(n, np.int64)
        after[: max(0, n - reach)] = rank[reach:] + 1
        rank, order = _dense(rank * (n + 1) + after)
        reach *= 2
    return order


class _Ranks:
    """How often a symbol stands before a place of a transform, and how often smaller ones do."""

    def __init__(self, transform: np.ndarray, symbols: int) -> None:
        rows = -(-(len(transform) + 1) // STRIDE)
        self.symbols = symbols
        self.transform = np.full((rows, STRIDE), symbols, np.int32)
        self.transform.reshape(-1)[: len(transform)] = transform
        cells = np.arange(rows).repeat(STRIDE) * (symbols + 1) + self.transform.reshape(-1)
        per_row = np.bincount(cells, minlength=rows * (symbols + 1)).reshape(rows, symbols + 1)[:-1, :symbols]
        self.equal = np.zeros((rows, symbols), np.int32)
        np.cumsum(per_row, 0, out=self.equal[1:])
        self.less = np.cumsum(self.equal, 1, dtype=np.int32) - self.equal

    def of(self, place: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per place its symbol's count before it, and that of smaller symbols."""
        row, part = place // STRIDE, place % STRIDE
        seen, used = self.transform[row], np.arange(STRIDE) < part[:, None]
        equal = ((seen == symbol[:, None]) & used).sum(1)
        less = ((seen < symbol[:, None]) & used).sum(1)
        return self.equal[row, symbol] + equal, self.less[row, symbol] + less

    def of_all(self, place: np.ndarray) -> np.ndarray:
        """Per place the counts of all symbols before it."""
        row, part = place // STRIDE, place % STRIDE
        seen = self.transform[row] + np.arange(len(place))[:, None] * self.symbols
        used = np.arange(STRIDE) < part[:, None]
        own = np.bincount(seen[used], minlength=len(place) * self.symbols).reshape(len(place), self.symbols)
        return self.equal[row] + own


class _States:
    """Partial matches: pattern, first ranks in the table of the direction and in the other one, size of both intervals."""

    def __init__(self, of: np.ndarray, rank: np.ndarray, other: np.ndarray, size: np.ndarray) -> None:
        self.of, self.rank, self.other, self.size = of, rank, other, size

    def at(self, kept: np.ndarray) -> _States:
        return _States(self.of[kept], self.rank[kept], self.other[kept], self.size[kept])

    def distinct(self) -> _States:
        order = np.lexsort((self.size, self.rank, self.of))
        s = self.at(order)
        new = np.ones(len(order), bool)
        new[1:] = (s.of[1:] != s.of[:-1]) | (s.rank[1:] != s.rank[:-1]) | (s.size[1:] != s.size[:-1])
        return s.at(new)

    def and_(self, *more: _States) -> _States:
        return _States(*[np.concatenate([getattr(p, n) for p in (self, *more)]) for n in ("of", "rank", "other", "size")])


def _no_states() -> _States:
    return _States(*[np.zeros(0, np.int64)] * 4)


class FMIndex:
    def __init__(self, words: list[str]) -> None:
        """``words``: distinct and not empty."""
        points, self.sizes = code_points(words)
        self.alphabet, symbol = np.unique(points, return_inverse=True)
        self.symbols = len(self.alphabet) + 2
        self.bars = np.append(0, np.cumsum(self.sizes + 1))
        self.text = np.full(len(points) + len(words) + 2, BAR, np.int64)
        self.text[-1] = END
        inner = np.ones(len(self.text), bool)
        inner[self.bars] = inner[-1] = False
        self.text[inner] = symbol + 2
        self.first = np.append(0, np.cumsum(np.bincount(self.text, minlength=self.symbols))[:-1])
        self.suffixes = suffix_array(self.text)
        back = np.append(self.text[-2::-1], END)
        self._ranks = {
            "left": _Ranks(self.text[self.suffixes - 1], self.symbols),
            "right": _Ranks(back[suffix_array(back) - 1], self.symbols),
        }

    def _matched(self, side: str, s: _States, symbol: np.ndarray) -> _States:
        """The states that go on with ``symbol``, one each; -1 is no symbol of the text."""
        s, symbol = s.at(symbol >= 0), symbol[symbol >= 0]
        low, low_less = self._ranks[side].of(s.rank, symbol)
        high, high_less = self._ranks[side].of(s.rank + s.size, symbol)
        found = _States(s.of, self.first[symbol] + low, s.other + high_less - low_less, high - low)
        return found.at(found.size > 0)

    def _every(self, side: str, s: _States) -> tuple[_States, np.ndarray, np.ndarray]:
        """All states that go on from ``s`` with a letter; the state each comes from, and the letter."""
        low = self._ranks[side].of_all(s.rank)
        inside = self._ranks[side].of_all(s.rank + s.size) - low
        state, symbol = np.nonzero(inside[:, BAR + 1 :])
        symbol = symbol + BAR + 1
        smaller = np.cumsum(inside, 1) - inside
        found = _States(
            s.of[state], self.first[symbol] + low[state, symbol], s.other[state] + smaller[state, symbol], inside[state, symbol]
        )
        return found, state, symbol

    def _seen(self, side: str, s: _States, only_bar: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word) of all suffixes of the intervals. ``only_bar``: nothing but a delimiter is matched so far."""
        start = s.rank if side == "left" else s.other
        step = np.arange(s.size.sum()) - np.repeat(np.cumsum(s.size) - s.size, s.size)
        place = self.suffixes[np.repeat(start, s.size) + step]
        word = np.searchsorted(self.bars, place, "right") - 1 - int(only_bar and side == "left")
        of = np.repeat(s.of, s.size)
        inside = (word >= 0) & (word < len(self.sizes))
        return of[inside], word[inside]

    def _candidates(self, side: str, patterns: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word): among them all words with one edit beyond the first ``exact`` symbols of a pattern.

        ``patterns``: symbols in the direction of the search, delimiters included, then bars.
        """
        whole = np.arange(len(patterns))
        clean, edited = _States(whole, 0 * whole, 0 * whole, 0 * whole + len(self.text)), _no_states()
        found = []
        for at in range(patterns.shape[1]):
            if at:
                for s in (clean, edited):
                    found.append(self._seen(side, s.at(s.size <= IN_TEXT), at == 1))
                clean, edited = clean.at(clean.size > IN_TEXT), edited.at(edited.size > IN_TEXT)
            if not len(clean.of) and not len(edited.of):
                break
            free = clean.at(exact[clean.of] <= at)
            later = _no_states()
            if len(free.of):
                every, state, symbol = self._every(side, free)
                now = patterns[free.of, at][state]
                # Another letter in place of the pattern's, or one more letter at this place.
                later = every.at((symbol != now) & (now != BAR))
                edited = edited.and_(every)
            edited = self._matched(side, edited, patterns[edited.of, at]).and_(later)
            if len(edited.of):
                edited = edited.distinct()
            clean = self._matched(side, clean, patterns[clean.of, at])
        for s in (clean, edited):
            found.append(self._seen(side, s, False))
        of, word = (np.concatenate(x) for x in zip(*found))
        pairs = np.unique(of * len(self.sizes) + word)
        return np.divmod(pairs, max(1, len(self.sizes)))

    def _confirmed(self, letters: np.ndarray, n: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per pattern (its letters in a row, then zeros) and word: whether one edit makes the word of it, and how far they begin alike."""
        size = self.sizes[word]
        column = np.arange(letters.shape[1])
        ahead = self.text[np.minimum(self.bars[word][:, None] + 1 + column, len(self.text) - 1)]
        begin = np.logical_and.accumulate((letters == ahead) & (column < np.minimum(n, size)[:, None]), 1).sum(1)
        shift = (size - n)[:, None]
        behind = self.text[np.clip(self.bars[word][:, None] + 1 + column + shift, 0, len(self.text) - 1)]
        alike = ((letters == behind) & (column + shift >= 0)) | (column >= n[:, None])
        end = np.logical_and.accumulate(alike[:, ::-1], 1).sum(1) - (letters.shape[1] - n)
        near = np.where(size == n, (begin < n) & (begin + end == n - 1), (size == n + 1) & (begin + end >= n))
        return near, begin

    def one_edit(self, words: list[str], exact: np.ndarray, from_start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in ``words``, place in the index), in blocks: words of the index with one other letter, or one more.

        ``from_start``: whether the edit is sought beyond the first ``exact`` letters, or before the last ones; what
        the first ``exact`` letters of a word do as well is no result of the latter.
        """
        points, lengths = code_points(words)
        ends = np.cumsum(lengths)
        place = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        symbol = np.where(self.alphabet[place] == points, place + 2, -1)
        for side, chosen in (("right", from_start), ("left", ~from_start)):
            own = np.flatnonzero(chosen)
            own = own[np.argsort(lengths[own], kind="stable")]
            while len(own):
                rows = max(1, int(np.searchsorted((lengths[own] + 2) * np.arange(1, len(own) + 1), CELLS)))
                block, own = own[:rows], own[rows:]
                n = lengths[block]
                width = int(n.max())
                letters = np.zeros((len(block), width), np.int64)
                row = np.repeat(np.arange(len(block)), n)
                column = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                letters[row, column] = symbol[(ends[block] - n)[row] + column]
                patterns = np.full((len(block), width + 2), BAR)
                patterns[row, column + 1 if side == "right" else n[row] - column] = letters[row, column]
                of, word = self._candidates(side, patterns, exact[block] + 1)
                step = max(1, CELLS // width)
                for at in range(0, len(of), step):
                    o, w = of[at : at + step], word[at : at + step]
                    near, begin = self._confirmed(letters[o], n[o], w)
                    half = exact[block][o] if side == "right" else n[o] - exact[block][o]
                    near &= (begin >= half) if side == "right" else (begin < half)
                    yield block[o[near]], w[near]
