"""Benchmark decontamination: CGK embedding, repeated bit sampling, exact edit verification.

Texts are sequences of words (runs of letters and digits, lower case). The CGK embedding walks over
a sequence: every step emits the word under the pointer, and a random bit, a function of step and
word, says whether the pointer moves on. Two sequences at a small edit distance fall into step again
after each edit, so their walks agree in most steps: edit distance has become Hamming distance, and
sampling a few steps of the walk is a locality-sensitive hash.

Every word of a document begins a walk, and so does every word of an item, so that windows meet items
all along and not by their heads only. A sample is a few steps of a walk; its span goes from the word where the
walk begins to the furthest word it sees. The bits of a walk depend on the words under the pointer alone, so a window that
holds the words of a span unedited has the same key there, and often it has it with an edit between the steps sampled.

How often sampling is repeated follows from the item. One that may have E edits takes sample after sample
(``ROUNDS``, walk by walk), each from all of its words, until E + 1 of its spans share no word.
An edit spoils one of these at most, so every window within the bound keeps a whole span and is found: the target recall is
1, for edits massed at the head as for edits spread evenly. Only keys of several different words count, four if an
item's share of L / (E + 1) words allows so many, since keys of one or two frequent words lead everywhere; an item
whose words repeat takes fewer.

Every candidate is then confirmed by the word edit distance over all windows that may begin there: at most L // 5 edits
for items of 6 words or more; shorter items have to occur word for word (E = 0, one span).

The benchmark is the stated query set: it is taken in blocks of ``BLOCK_ITEMS`` items, so what
is broadcast has a fixed bound, and each block reads the documents once. Documents are never shuffled.

Defined cases: null and empty texts have no hits; items without a word are never found; equal items are
all reported; a repeated row repeats its hits; of several windows for one item the closest, then the
first, is reported.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm import words as W

WALKS = 8
#: Steps that a sample takes from a walk; all begin with the first word.
SAMPLES = ((0, 1, 2, 3), (0, 1, 3, 5), (0, 2, 4, 6), (0, 1, 2))
#: (walk, steps) in the order in which items take them; the last two serve items of one and two words.
ROUNDS = (*((w, s) for w in range(WALKS) for s in SAMPLES), (0, (0, 1)), (0, (0,)))
STEPS = 8
MOST_WORDS = 4
SHORTEST = 6
EDITS_PER_WORD = 5
BLOCK_ITEMS = 5_000
_POSITIONS = 1 << 15
_FILTER_BITS = 20
#: Cells of candidate windows looked at together.
_CELLS = 1 << 21
_FACTOR, _SHIFT = np.uint32(0x9E3779B1), np.uint32(32 - _FILTER_BITS)
HIT = "struct<item_id:bigint,start_word:int,n_words:int,edits:int>"


def walks(hashes: np.ndarray, at: np.ndarray, walk: int, steps: set[int]) -> dict[int, np.ndarray]:
    """For the walk that starts at each of the words ``at``: the pointer in each of ``steps``.

    The pointer stops on the last word of ``hashes``; walks have at most ``STEPS`` steps.
    """
    # One bit per word and step: how far word * STEPS + step moves, 1 or STEPS + 1.
    bits = (W.mix(hashes ^ W.seed_of(walk, 31)) >> np.uint64(56)).astype(np.uint8)
    moves = np.unpackbits(bits) * np.uint8(STEPS) + np.uint8(1)
    place, last, move = at * STEPS, len(hashes) - 1, np.empty(len(at), np.uint8)
    seen = {}
    for step in range(max(steps) + 1):
        if step in steps:
            seen[step] = np.minimum(place // STEPS, last)
        np.take(moves, place, out=move, mode="clip")
        place += move
    return seen


def _key(words: dict[int, np.ndarray], steps: tuple[int, ...]) -> np.ndarray:
    """32-bit key of every start from the words seen in ``steps``; candidates are confirmed, so keys may meet."""
    key = words[steps[0]] * _FACTOR
    for s in steps[1:]:
        key += words[s]
        key *= _FACTOR
    return key


@dataclass
class Index:
    """The items of one block and where their sampled keys lead."""

    ids: list[int]
    items: list[np.ndarray]
    #: (walk, steps) -> (filter, sorted keys, item of each, place in the item of each)
    tables: dict[tuple[int, tuple[int, ...]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)


def _different(words: dict[int, np.ndarray], steps: tuple[int, ...]) -> np.ndarray:
    """How many different words a sample sees, for every start."""
    n = np.ones(len(words[0]), np.int64)
    for k in range(1, len(steps)):
        n += np.all([words[steps[k]] != words[s] for s in steps[:k]], axis=0)
    return n


def _disjoint(ends: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Per item, of the words ``first`` up to ``after``, how many spans that share no word there are.

    ``ends``: last word of the shortest span from every word on; of all spans that begin later the one that ends first is taken.
    """
    nearest = np.append(np.minimum.accumulate(ends[::-1])[::-1], len(ends))
    at, n = first.copy(), np.zeros(len(first), np.int64)
    while True:
        end = nearest[at]
        more = (at < after) & (end < after)
        if not more.any():
            return n
        n += more
        at = np.where(more, end + 1, at)


def build_index(rows: list[tuple[int, str]]) -> Index:
    array = pc.utf8_lower(pa.array([t for _, t in rows], pa.string()))
    items: list[np.ndarray] = []
    for piece in W.pieces(array):
        w = W.words(piece, W.ALNUM)
        items += np.split(w.hashes, w.first_word[1:-1])
    index = Index([i for i, _ in rows], items)
    sizes = np.array([len(x) for x in items], np.int64)
    if not sizes.sum():
        return index
    hashes, number = np.concatenate(items), np.repeat(np.arange(len(items)), sizes)
    after = np.cumsum(sizes)
    first, at = after - sizes, np.arange(len(hashes))
    need = np.array([allowed_edits(x) + 1 for x in items])
    wanted = np.minimum(MOST_WORDS, sizes // need)
    # Pointers stop at the end of all items, so a word more shows one that has left the last.
    padded = np.append(hashes, np.uint64(0))
    seen = {walk: walks(padded, at, walk, set(range(STEPS))) for walk in range(WALKS)}
    words = {walk: {s: padded[p] for s, p in pointers.items()} for walk, pointers in seen.items()}
    ends = np.full(len(hashes), len(hashes))
    open_ = sizes > 0
    entries = defaultdict(set)
    for fewer in range(MOST_WORDS):
        for walk, steps in ROUNDS:
            if not open_.any():
                break
            last = seen[walk][steps[-1]]
            enough = _different(words[walk], steps) >= np.maximum(wanted - fewer, 1)[number]
            taken = np.flatnonzero(open_[number] & (last < after[number]) & enough)
            entries[walk, steps].update(taken.tolist())
            ends[taken] = np.minimum(ends[taken], last[taken])
            open_ &= _disjoint(ends, first, after) < need
    for (walk, steps), chosen in entries.items():
        if not chosen:
            continue
        place = np.array(sorted(chosen))
        keys = _key({s: words[walk][s][place].astype(np.uint32) for s in steps}, steps)
        order = np.argsort(keys, kind="stable")
        keys, place = keys[order], place[order]
        filter_ = np.zeros(1 << _FILTER_BITS, bool)
        filter_[keys >> _SHIFT] = True
        index.tables[walk, steps] = filter_, keys, number[place], place - first[number[place]]
    return index


def _candidates(w: W.Words, index: Index) -> np.ndarray:
    """Distinct rows (item, text, first word that the item would have without edits before it)."""
    found = [np.zeros((0, 3), np.int64)]
    by_walk = defaultdict(list)
    for walk, steps in index.tables:
        by_walk[walk].append(steps)
    for low in range(0, len(w.hashes), _POSITIONS):
        # A walk never leaves the words that follow within the slice.
        near = w.hashes[low : low + _POSITIONS + STEPS]
        short = near.astype(np.uint32)
        at = np.arange(min(_POSITIONS, len(w.hashes) - low))
        for walk, samples in by_walk.items():
            seen = walks(near, at, walk, {s for steps in samples for s in steps})
            words = {s: short[p] for s, p in seen.items()}
            for steps in samples:
                filter_, table, numbers, places = index.tables[walk, steps]
                key = _key(words, steps)
                maybe = np.flatnonzero(filter_[key >> _SHIFT])
                if not len(maybe):
                    continue
                first, last = np.searchsorted(table, key[maybe]), np.searchsorted(table, key[maybe], "right")
                n = last - first
                row = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                start = np.repeat(maybe + low, n)
                found.append(np.stack([numbers[row], w.text[start], start - places[row]], 1))
    return np.unique(np.concatenate(found), axis=0)


def _likely(w: W.Words, index: Index) -> Iterator[tuple[int, int, np.ndarray]]:
    """(item, text, first words) of the candidates with enough words of their item around them."""
    rows = _candidates(w, index)
    cuts = np.flatnonzero(np.diff(rows[:, 0], prepend=-1)).tolist() + [len(rows)]
    for low, high in zip(cuts, cuts[1:]):
        item = index.items[int(rows[low, 0])]
        edits = allowed_edits(item)
        reach = np.arange(-edits, len(item) + edits)
        known = np.unique(item)
        step = max(1, _CELLS // len(reach))
        kept = [np.zeros((0, 3), np.int64)]
        for k in range(low, high, step):
            some = rows[k : min(k + step, high)]
            places = some[:, 2:] + reach
            inside = (places >= w.first_word[some[:, 1:2]]) & (places < w.first_word[some[:, 1:2] + 1])
            around = w.hashes[np.clip(places, 0, len(w.hashes) - 1)]
            of_item = known[np.minimum(np.searchsorted(known, around), len(known) - 1)] == around
            kept.append(some[(of_item & inside).sum(1) >= len(item) - edits])
        some = np.concatenate(kept)
        by_text = np.flatnonzero(np.diff(some[:, 1], prepend=-1)).tolist() + [len(some)]
        for k, after in zip(by_text, by_text[1:]):
            yield int(some[k, 0]), int(some[k, 1]), some[k:after, 2]


def _best(w: W.Words, text: int, item: np.ndarray, starts: np.ndarray) -> tuple[int, int, int] | None:
    """(edits, first word, words) of the closest window near one of ``starts``, if within the bound."""
    begin, end = int(w.first_word[text]), int(w.first_word[text + 1])
    for at in starts.tolist():
        if begin <= at <= end - len(item) and np.array_equal(w.hashes[at : at + len(item)], item):
            return 0, at - begin, len(item)
    edits, found = allowed_edits(item), None
    if not edits:
        return None
    # Neighbouring starts are looked at together, in regions of bounded size.
    low = high = int(starts[0])
    for at in [*starts[1:].tolist(), None]:
        if at is not None and at - high <= 2 * edits and at - low <= 4 * len(item):
            high = at
            continue
        first = max(begin, low - edits)
        new = closest_window(item, w.hashes[first : min(end, high + len(item) + edits)], high + edits - first)
        if new[0] <= edits:
            new = (new[0], new[1] + first - begin, new[2])
            found = min(found or new, new)
        low = high = at if at is not None else 0
    return found


def allowed_edits(item: np.ndarray) -> int:
    return len(item) // EDITS_PER_WORD if len(item) >= SHORTEST else 0


def edits_to_prefix(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Least word edit distance of ``item`` to a prefix of ``window``, and that prefix's length."""
    places = np.arange(len(window) + 1)
    row = places.copy()
    for i, word in enumerate(item):
        change = np.minimum(row[1:] + 1, row[:-1] + (window != word))
        head = np.concatenate([[i + 1], change])
        row = np.minimum.accumulate(head - places) + places
    # Of equally close prefixes the one nearest to the item's own length.
    order = np.lexsort((np.abs(places - len(item)), row))
    return int(row[order[0]]), int(order[0])


def closest_window(item: np.ndarray, region: np.ndarray, last: int) -> tuple[int, int, int]:
    """(edits, start, words) of the window of ``region``, begun at ``last`` or before, closest to ``item``; the first of those."""
    places = np.arange(len(region) + 1, dtype=np.int64)
    # One number holds edits and start, so that the least has the fewest edits, then the first start.
    edit = np.int64(len(region) + 1)
    row = np.where(places <= last, places, edit * (len(item) + 1))
    for word in item:
        change = np.minimum(row[1:] + edit, row[:-1] + edit * (region != word))
        row = np.minimum.accumulate(np.concatenate([row[:1] + edit, change]) - edit * places) + edit * places
    start = int(row.min() % edit)
    edits, n = edits_to_prefix(item, region[start:])
    return edits, start, n


def hits(texts: pa.Array, index: Index) -> list[list[dict]]:
    """Per text its confirmed (item, window) pairs."""
    out: list[list[dict]] = []
    for piece in W.pieces(pc.utf8_lower(texts)):
        w = W.words(piece, W.ALNUM)
        per_text: list[list[dict]] = [[] for _ in range(piece.n_texts)]
        for number, text, starts in _likely(w, index):
            if best := _best(w, text, index.items[number], starts):
                edits, start, n = best
                per_text[text].append({"item_id": index.ids[number], "start_word": start, "n_words": n, "edits": edits})
        out += per_text
    return out


def index_blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of blocks of items; at most ``BLOCK_ITEMS`` are on the driver at a time."""
    rows: list[tuple[int, str]] = []
    for r in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        if len(rows) == BLOCK_ITEMS:
            yield build_index(rows)
            rows = []
    if rows:
        yield build_index(rows)


def _finder(docs: DataFrame, index: Index):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf(f"array<{HIT}>")
    def find(texts: pa.Array) -> pa.Array:
        return pa.array(hits(texts, shared.value), _hit_type())

    return find


def contaminated_windows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, n_words, edits of every item found in ``docs`` (doc_id, text)."""
    found = docs.sparkSession.createDataFrame([], "doc_id bigint, " + HIT[7:-1].replace(":", " "))
    for index in index_blocks(benchmark):
        find = _finder(docs, index)
        found = found.union(docs.select("doc_id", F.explode(find("text")).alias("hit")).select("doc_id", "hit.*"))
    return found


def _hit_type() -> pa.DataType:
    number = pa.int32()
    return pa.list_(pa.struct({"item_id": pa.int64(), "start_word": number, "n_words": number, "edits": number}))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    for index in index_blocks(benchmark):
        docs = docs.where(F.size(_finder(docs, index)("text")) == 0)
    return docs
