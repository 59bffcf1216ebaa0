"""Periodic runs of words by recompression.

The words of some documents become one sequence of numbers, with a number of its own between
documents. Two steps alternate until one symbol is left: equal neighbours become a block, and
pairs of a left and a right symbol become one. The levels are a run-length grammar of the
sequence. Equal stretches are compressed alike but for their ends, so how far two places
agree is found by climbing the levels while symbols are equal and descending where they
differ: a number of steps in the logarithm of the answer, without suffix arrays.

A run of period q and length 4q or more covers, for some k, the words 3qk and 3qk + q. The
candidates are therefore these pairs for all periods, n ln n / 3 of n words; each is extended
to both sides by the grammar, and what is long enough is a run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run repeats its period so often at least, and has so many words at least.
REPEATS = 4
LEAST = 6
# Words that share a grammar; a longer document has one of its own.
WORDS_AT_ONCE = 1 << 17
CANDIDATES_AT_ONCE = 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


@dataclass
class Level:
    """A sequence of symbols and how it is grouped one level up. ``first`` holds the first
    child of every symbol there, and the end."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    blocks: bool

    def begins(self, at: np.ndarray, way: int) -> np.ndarray:
        """Whether a symbol is the first of its group, seen in reading direction."""
        over = self.parent[at]
        return self.first[over] == at if way > 0 else self.first[over + 1] - 1 == at

    def left(self, at: np.ndarray, way: int) -> np.ndarray:
        """Equal symbols from here to the end of the block."""
        if not self.blocks:
            return np.ones(len(at), np.int64)
        over = self.parent[at]
        return self.first[over + 1] - at if way > 0 else at - self.first[over] + 1

    def opened(self, over: np.ndarray, way: int) -> np.ndarray:
        return self.first[over] if way > 0 else self.first[over + 1] - 1


class Grammar:
    """The levels over a sequence whose first and last symbols occur once."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        self.fresh = int(symbols.max(initial=0)) + 1
        number = 0
        while len(symbols) > 1:
            symbols = self._blocks(symbols)
            symbols = self._pairs(symbols, number)
            number += 1

    def _blocks(self, symbols: np.ndarray) -> np.ndarray:
        first = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
        sizes = np.diff(np.append(first, len(symbols)))
        return self._group(symbols, first, sizes > 1, symbols[first], sizes, True)

    def _pairs(self, symbols: np.ndarray, number: int) -> np.ndarray:
        if len(symbols) < 2:
            return symbols
        # Every symbol falls to one side, by a hash that changes with the level.
        factor = np.uint64(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E01A * number & 0xFFFFFFFFFFFFFFFF | 1)
        side = (symbols.astype(np.uint64) * factor >> np.uint64(33) & np.uint64(1)).astype(bool)
        met = [~side[:-1] & side[1:], side[:-1] & ~side[1:]]
        joined = max(met, key=np.count_nonzero)
        first = np.flatnonzero(np.concatenate(([True], ~joined)))
        paired = np.append(joined, False)[first]
        after = symbols[np.minimum(first + 1, len(symbols) - 1)]
        return self._group(symbols, first, paired, symbols[first], after, False)

    def _group(
        self, symbols: np.ndarray, first: np.ndarray, new: np.ndarray, a: np.ndarray, b: np.ndarray, blocks: bool
    ) -> np.ndarray:
        if len(first) == len(symbols):
            return symbols
        parent = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(symbols))))
        self.levels.append(Level(symbols, parent, np.append(first, len(symbols)), blocks))
        # Groups of the same content get the same name.
        over = symbols[first].copy()
        names, which = np.unique(a[new] * np.int64(int(b[new].max()) + 1) + b[new], return_inverse=True)
        over[new] = self.fresh + which
        self.fresh += len(names)
        return over

    def extend(self, i: np.ndarray, j: np.ndarray, way: int = 1) -> np.ndarray:
        """How many symbols from i and j on agree, or, with ``way`` -1, before i and j.
        No i equals its j."""
        a, b = (i.copy(), j.copy()) if way > 0 else (i - 1, j - 1)
        differ: list[np.ndarray] = []
        live = np.arange(len(i))
        for level in self.levels:
            x, y = a[live], b[live]
            equal = level.symbols[x] == level.symbols[y]
            stopped = [live[~equal]]
            live, x, y = live[equal], x[equal], y[equal]
            # Both at the beginning of a group: climb as they stand. Else go to its end.
            inside = np.flatnonzero(~(level.begins(x, way) & level.begins(y, way)))
            left_x, left_y = level.left(x[inside], way), level.left(y[inside], way)
            most = np.minimum(left_x, left_y)
            x[inside] += way * most
            y[inside] += way * most
            uneven = np.zeros(len(live), bool)
            uneven[inside] = left_x != left_y
            a[live[uneven]], b[live[uneven]] = x[uneven], y[uneven]
            stopped.append(live[uneven])
            differ.append(np.concatenate(stopped))
            live, x, y = live[~uneven], x[~uneven], y[~uneven]
            if not len(live):
                break
            a[live], b[live] = level.parent[x], level.parent[y]
        # Where symbols differ, their parts agree for some way and then differ.
        live = np.empty(0, np.int64)
        for number in range(len(differ) - 1, 0, -1):
            live = np.concatenate((live, differ[number]))
            level = self.levels[number - 1]
            x, y = level.opened(a[live], way), level.opened(b[live], way)
            equal = level.symbols[x] == level.symbols[y]
            most = np.where(equal, np.minimum(level.left(x, way), level.left(y, way)), 0)
            a[live], b[live] = x + way * most, y + way * most
        return a - i if way > 0 else i - 1 - a


def _candidates(begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of all documents, some at a time."""
    most = sizes // REPEATS
    document = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(document)) - np.repeat(np.cumsum(most) - most, most) + 1
    stride = (REPEATS - 1) * period
    count = (sizes[document] - period - 1) // stride + 1
    ends = np.cumsum(count)
    start = 0
    while start < len(period):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + CANDIDATES_AT_ONCE, "right")))
        some = slice(start, stop)
        grid = np.arange(ends[stop - 1] - done) - np.repeat(ends[some] - count[some] - done, count[some])
        yield begins[document[some]].repeat(count[some]) + grid * stride[some].repeat(count[some]), period[some].repeat(count[some])
        start = stop


def runs_of(documents: list[np.ndarray]) -> list[np.ndarray]:
    """For each document, as word numbers from 0, its runs: rows (start, length, period) by
    start and then period."""
    sizes = np.array([len(words) for words in documents], np.int64)
    begins = np.cumsum(sizes + 1) - sizes
    words = 1 + max((int(one.max()) for one in documents if len(one)), default=0)
    whole = np.empty(int(sizes.sum()) + len(sizes) + 1, np.int64)
    borders = np.append(begins - 1, len(whole) - 1)
    whole[borders] = words + np.arange(len(borders))
    for begin, one in zip(begins, documents):
        whole[begin : begin + len(one)] = one
    grammar: Grammar | None = None
    found = [np.empty((0, 3), np.int64)]
    for place, period in _candidates(begins, sizes):
        agree = whole[place] == whole[place + period]
        place, period = place[agree], period[agree]
        if not len(place):
            continue
        grammar = grammar or Grammar(whole)
        after = grammar.extend(place, place + period)
        before = grammar.extend(place, place + period, -1)
        length = before + period + after
        long = length >= np.maximum(LEAST, REPEATS * period)
        rows = np.column_stack((place - before, length, period))[long]
        # Several places and multiples of the period lead to one run: the least period is its own.
        found = [_least(np.concatenate((*found, rows)))]
    runs = found[0]
    cuts = np.searchsorted(runs[:, 0], np.append(begins, len(whole)))
    each = [runs[a:b] - np.array([begin, 0, 0]) for a, b, begin in zip(cuts, cuts[1:], begins)]
    return [one[np.lexsort((one[:, 2], one[:, 0]))] for one in each]


def _least(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[first]


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when every run is cut to its first period."""
    change = np.zeros(count + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


# --- on tables ---------------------------------------------------------------------------

# For the id and the number of words of a document: the places its words are taken from.
Rewrite = Callable[[int | None, int], np.ndarray | None]


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of ``docs`` (doc_id, text).

    ``runs`` are the stretches of words, in word numbers from 0, that repeat their smallest
    period four times or more, have six words or more and cannot be extended; ``collapsed``
    is the text with only the first period of every run, words joined by one space. Null,
    empty and blank texts have no words, no runs and an empty collapsed text. Repeated rows
    stay repeated; a null doc_id is kept. A document is read whole by one task, which needs
    some 100 bytes for each of its words. ``rewrite`` moves words before the search.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    target = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def together(group: list[tuple]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        texts = [
            np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
            for _, words, _ in group
        ]
        texts = [text if moved is None else text[moved] for text, (_, _, moved) in zip(texts, group)]
        rows = []
        for (doc_id, words, moved), found in zip(group, runs_of(texts)):
            if moved is not None:
                words = [words[i] for i in moved.tolist()]
            if len(found):
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), found)).tolist()]
            listed = [{"start": s, "length": n, "period": p} for s, n, p in found.tolist()]
            rows.append((doc_id, listed, b" ".join(words).decode()))
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Splits at the ASCII white space that parts words.
                words = (text.as_py() or b"").split()
                if group and size + len(words) > WORDS_AT_ONCE:
                    yield together(group)
                    group, size = [], 0
                moved = rewrite(doc_id, len(words)) if rewrite else None
                group.append((doc_id, words, moved))
                size += len(words)
            if group:
                yield together(group)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(work, f"doc_id long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first.
    Null without runs."""
    better = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.aggregate(
        runs, F.get(runs, F.lit(0)), lambda best, run: F.when(better(best, run), run).otherwise(best)
    )


def listed(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    line = lambda run: F.concat(
        *[F.concat(run[name].cast("string"), F.lit(end)) for name, end in (("start", ","), ("length", ","), ("period", "\n"))]
    )
    return F.array_join(F.transform(runs, line), "")
