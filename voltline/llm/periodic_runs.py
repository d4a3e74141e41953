"""Runs of repeated words (maximal periodic stretches) by recompression.

The words of a batch of texts are compressed in rounds. A block round turns every maximal
block of one symbol into one symbol; a pair round deals the symbols to two sides and turns
every left symbol followed by a right one into one symbol. Each round looks at neighbours
only, so equal stretches are compressed alike up to their edges, and the rounds together are
a run-length grammar whose depth is logarithmic. Two positions are compared by climbing the
rounds as long as the symbols agree and coming down where they don't, which gives the exact
length of their longest common extension; a mirrored view of the same grammar gives the one
to the left. There is no suffix array, and names are exact: words and pairs are numbered by
a dictionary, not by a hash.

Candidates lie on harmonic grids: a run of period q and at least twice that length covers a
multiple i of q with i + q inside too. For every period all such pairs are taken, n ln n in
all; those whose words differ, or both of whose neighbours do, are in no run of six words or
more beyond its first period. Extensions to both sides decide on the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .store import shields
from .words import SPACE, mix, slices, text_bytes

#: Fewest words of a run; it also has two periods at least.
LEAST_WORDS = 12
#: Candidates are worked on in blocks of about so many.
BLOCK = 1 << 19
_RUN = ArrayType(StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")]), False)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word, the byte after it, and each text's first word (one more than texts)."""
    solid = np.concatenate([[False], ~SPACE[data], [False]])
    opens, closes = solid[1:] & ~solid[:-1], solid[:-1] & ~solid[1:]
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(data))])
    inner = inner[solid[inner] & solid[inner + 1]]  # a text's end between two words that touch
    opens[inner], closes[inner] = True, True
    begin, end = np.flatnonzero(opens[:-1]), np.flatnonzero(closes)
    return begin, end, np.searchsorted(begin, offsets)


def numbered(keys: pa.Array | np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers, counted from 0."""
    return pa.array(keys).dictionary_encode().indices.to_numpy().astype(np.int32)


def word_numbers(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word; equal words, byte for byte, have equal ones."""
    sizes = end - begin
    ends = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[begin] += 1
    inside[end] -= 1
    joined = data[np.cumsum(inside[:-1]) > 0]
    return numbered(pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(joined)]))


class Level(NamedTuple):
    symbols: np.ndarray
    parent: np.ndarray | None  #: of each symbol, in the next level; None at the top
    first: np.ndarray | None  #: symbol of each parent, and the number of symbols
    blocks: bool  #: whether parents are blocks, or else pairs

    def mirrored(self) -> Level:
        if self.parent is None:
            return Level(self.symbols[::-1], None, None, False)
        return Level(self.symbols[::-1], (len(self.first) - 2 - self.parent)[::-1], len(self.symbols) - self.first[::-1], self.blocks)


class Grammar:
    """Levels from words to the top. Symbols under `stops` in the first level are words; the others stand between texts, each once, and stay themselves."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    @classmethod
    def of(cls, symbols: np.ndarray, stops: int) -> Grammar:
        levels, barrier, turn = [], symbols >= stops, 0
        while True:
            n = len(symbols)
            begins = np.ones(n, bool)
            begins[1:] = symbols[1:] != symbols[:-1]
            blocks = not begins.all()
            if not blocks:
                inner = ~barrier[1:] & ~barrier[:-1]
                if not inner.any():
                    return cls([*levels, Level(symbols, None, None, False)])
                left = (mix(symbols.astype(np.uint64) + np.uint64(turn << 32)) & np.uint64(1)).astype(bool)
                begins[1:] = ~(inner & left[:-1] & ~left[1:])
                turn += 1
                if begins.all():
                    continue  # no pair this time: deal the symbols anew
            first = np.append(np.flatnonzero(begins), n)
            parent = (np.cumsum(begins) - 1).astype(np.int32)
            levels.append(Level(symbols, parent, first.astype(np.int32), blocks))
            at, sizes = first[:-1], np.diff(first)
            second = sizes.astype(np.int64) if blocks else np.where(sizes > 1, symbols[np.minimum(at + 1, n - 1)].astype(np.int64) + 1, 0)
            symbols, barrier = numbered((symbols[at].astype(np.int64) << 32) | second), barrier[at]

    def mirrored(self) -> Grammar:
        return Grammar([level.mirrored() for level in self.levels])

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on, for different i and j in each pair."""
        a, b = i.astype(np.int64), j.astype(np.int64)
        stopped: list[list[np.ndarray]] = []  # by level: pairs whose symbols there differ
        live = np.arange(len(a))
        for level in self.levels:
            same = level.symbols[a[live]] == level.symbols[b[live]]
            stopped.append([live[~same]])
            live = live[same]
            if not len(live):
                break
            if level.parent is None:
                while len(live):
                    a[live] += 1
                    b[live] += 1
                    same = level.symbols[a[live]] == level.symbols[b[live]]
                    stopped[-1].append(live[~same])
                    live = live[same]
                break
            x, y = a[live], b[live]
            p, q = level.parent[x], level.parent[y]
            inside = (level.first[p] != x) | (level.first[q] != y)
            if inside.any():  # up to where parents begin in both places
                moved = live[inside]
                if level.blocks:
                    u, v = level.first[p[inside] + 1] - x[inside], level.first[q[inside] + 1] - y[inside]
                    step = np.minimum(u, v)
                    stopped[-1].append(moved[u != v])
                    inside[inside] = u != v  # from here on: one block goes on, the other doesn't
                    live = live[~inside]
                else:
                    step = 1
                a[moved] += step
                b[moved] += step
            a[live], b[live] = level.parent[a[live]], level.parent[b[live]]
        pool = np.zeros(0, np.int64)
        for level, here in zip(self.levels[len(stopped) - 1 :: -1], stopped[::-1], strict=True):
            if len(pool):  # parents differ: what their children have in common
                p, q = a[pool], b[pool]
                x, y = level.first[p].astype(np.int64), level.first[q].astype(np.int64)
                step = np.minimum(level.first[p + 1] - x, level.first[q + 1] - y) if level.blocks else 1
                step = np.where(level.symbols[x] == level.symbols[y], step, 0)
                a[pool], b[pool] = x + step, y + step
            pool = np.concatenate([pool, *here])
        return a - i


def grid_pairs(sizes: np.ndarray, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """text, place and period in blocks: all multiples of each period p with place + p in the text too, up to half a text."""
    halves = sizes // 2
    for some in _ranges(np.cumsum(halves), block):  # (text, period) pairs
        text = np.searchsorted(np.cumsum(halves), some, "right")
        period = some - np.concatenate([[0], np.cumsum(halves)])[text] + 1
        counts = (sizes[text] - 1) // period
        ends = np.cumsum(counts)
        for places in _ranges(ends, block):
            k = np.searchsorted(ends, places, "right")
            yield text[k], (places - ends[k] + counts[k]) * period[k], period[k]


def _ranges(ends: np.ndarray, block: int) -> Iterator[np.ndarray]:
    total = int(ends[-1]) if len(ends) else 0
    for first in range(0, total, block):
        yield np.arange(first, min(first + block, total))


class Runs(NamedTuple):
    """Runs ordered by text, start and period."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def runs_of(words: np.ndarray, firsts: np.ndarray, least: int = LEAST_WORDS) -> Runs:
    """All runs of texts whose numbered words stand in one array; firsts: each text's first word (one more than texts)."""
    sizes, n_texts, kinds = np.diff(firsts), len(firsts) - 1, int(words.max()) + 1 if len(words) else 0
    text_of = np.repeat(np.arange(n_texts), sizes)
    symbols = np.empty(len(words) + n_texts + 1, np.int32)  # something that occurs once before, between and after texts
    symbols[firsts + np.arange(n_texts + 1)] = kinds + np.arange(n_texts + 1)
    symbols[np.arange(len(words)) + text_of + 1] = words
    base = firsts[:-1] + np.arange(n_texts) + 1
    grammar = mirror = None
    found = [np.zeros((4, 0), np.int64)]
    for text, place, period in grid_pairs(sizes):
        i = base[text] + place
        hit = np.flatnonzero(symbols[i] == symbols[i + period])
        i, period, text = i[hit], period[hit], text[hit]
        hit = (symbols[i - 1] == symbols[i - 1 + period]) | (symbols[i + 1] == symbols[i + 1 + period])
        if least < 3:
            hit[:] = True
        i, period, text = i[hit], period[hit], text[hit]
        if not len(i):
            continue
        if grammar is None:
            grammar = Grammar.of(symbols, kinds)
            mirror = grammar.mirrored()
        right = grammar.extend(i, i + period)
        last = len(symbols) - 1
        left = mirror.extend(last - (i + period) + 1, last - i + 1)
        length = left + right + period
        hit = (length >= least) & (length >= 2 * period)
        rows = np.stack([text[hit], (i - left - base[text])[hit], length[hit], period[hit]])
        found.append(_smallest_periods(rows))
    text, start, length, period = _smallest_periods(np.concatenate(found, axis=1))
    order = np.lexsort((period, start, text))
    return Runs(text[order], start[order], length[order], period[order])


def _smallest_periods(rows: np.ndarray) -> np.ndarray:
    """A stretch is found under multiples of its period too, in full each time: its smallest period stays."""
    rows = rows[:, np.lexsort(rows[::-1])]
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    return rows[:, new]


def _slice(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed texts of some texts."""
    begin, end, firsts = word_spans(data, offsets)
    runs = runs_of(word_numbers(data, begin, end), firsts, least)
    fields = [pa.array(x.astype(np.int64)) for x in (runs.start, runs.length, runs.period)]
    lists = np.searchsorted(runs.text, np.arange(len(firsts)))
    found = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.StructArray.from_arrays(fields, names=["start", "length", "period"]))
    at = firsts[runs.text] + runs.start
    over = np.zeros(len(begin) + 1, np.int64)
    np.add.at(over, at + runs.period, 1)
    np.add.at(over, at + runs.length, -1)
    keep = np.cumsum(over[:-1]) == 0
    sizes = (end - begin)[keep] + 1  # with a space after each word
    ends = np.cumsum(sizes)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[keep] - ends + sizes, sizes)
    joined = np.append(data, np.uint8(32))[take]
    joined[ends - 1] = 32
    joined, bounds = joined.tobytes(), np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(keep)])[firsts]]
    texts = [joined[i : max(i, j - 1)] for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return found, pa.array(texts, pa.binary()).cast(pa.string())


@shields("runs", "collapsed")
def find_runs(documents: DataFrame, text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """All columns of `documents` but the text, then runs and collapsed.

    runs: array of (start, length, period) in words counted from 0, by start and period: the
    stretches of `least_words` words and two periods or more, with their smallest period, that no
    neighbouring word extends. collapsed: the words that are in no run beyond its first period,
    joined by one space. Words are what stands between spaces and \\x09-\\x0D, compared byte for
    byte; runs may overlap. NULL, empty and blank texts have no runs and an empty collapsed text.
    Repeated rows each keep their result; an empty table gives no rows; columns named runs or
    collapsed are replaced. Rows keep their partition: there is no shuffle. Memory grows with the
    longest text (some hundred bytes a word), not with the batch.
    """
    at = documents.columns.index(text)
    kept = [f for i, f in enumerate(documents.schema.fields) if i != at]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(at))
            for i, j in slices(offsets):
                found = _slice(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least_words)
                others = [c.slice(i, j - i) for k, c in enumerate(batch.columns) if k != at]
                yield pa.RecordBatch.from_arrays([*others, *found], names=[f.name for f in kept] + ["runs", "collapsed"])

    return documents.mapInArrow(work, StructType([*kept, StructField("runs", _RUN, False), StructField("collapsed", StringType(), False)]))
