"""Runs of words that repeat with a period, from enhanced suffix arrays.

All words of a batch of texts are one sequence of numbers.  Its suffixes are
sorted by doubling, text by text, and the ranks by the first 1, 2, 4, ...
words are kept: two places read the same for some length if the ranks of the
powers of two in that length agree.  From the ranks come the suffix array
``SA``, its inverse ``ISA`` and the lengths of common prefixes ``LCP``.

An LCP interval of some depth splits, at a place where the LCP is that depth,
into suffixes that go on in different ways.  Those of the smaller side look
up, by ``ISA[i + depth]`` and ``ISA[i - depth]``, whether the suffix that
starts ``depth`` words on or before is on the other side: if so, a square with
that period begins that cannot go on to the right, the end of a run.  Looking
at smaller sides only makes n log n look-ups at most.  A square is rotated to
the left as long as words agree, by the ranks again; squares of one stretch
are merged into the run, whose period is the least of theirs.

No tree is built and nothing is a loop over words: intervals are found for
all places at once from minima over powers of two.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import arrays

#: A run is at least so many periods and so many words long.
PERIODS = 4
LENGTH = 6

#: Bytes of text whose words are sorted together; a longer text is alone.
BATCH_BYTES = 1 << 20


class Runs(NamedTuple):
    """Runs by text, start and period; ``start`` is counted from the text."""

    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def _first_in_group(key: np.ndarray) -> np.ndarray:
    """For every place of a sorted list the first place with the same key."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))


def rank_levels(words: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """Ranks of all places by their first 1, 2, 4, ... words, never across the
    end of a text; the last list has every place apart and is ``ISA``.

    ``text`` is the number of the text, rising.  Every list has an entry
    more, -1, for the place behind the last word.
    """
    n = len(words)
    order = np.lexsort((words, text))
    pair_new = np.ones(n, dtype=bool)
    pair_new[1:] = (words[order][1:] != words[order][:-1]) | (text[order][1:] != text[order][:-1])
    ranks = np.full(n + 1, -1, dtype=np.int32)
    ranks[order] = np.maximum.accumulate(np.where(pair_new, np.arange(n), 0))
    ends = np.append(text, -1)
    levels = [ranks]
    step = 1
    while True:
        # Places in order of their rank that share it with another one.
        sorted_ranks = ranks[order]
        shared = np.zeros(n, dtype=bool)
        same = sorted_ranks[1:] == sorted_ranks[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        where = np.flatnonzero(shared)
        if not len(where):
            return levels
        places = order[where]
        after = np.minimum(places + step, n)
        second = np.where(ends[after] == text[places], ranks[after], -1).astype(np.int64)
        key = ranks[places].astype(np.int64) * (n + 1) + second + 1
        moved = np.argsort(key, kind="stable")
        places, key = places[moved], key[moved]
        order[where] = places
        # A group keeps its place in the whole order: its rank counts from there.
        group = _first_in_group(ranks[places])
        ranks = ranks.copy()
        ranks[places] = ranks[places] + (_first_in_group(key) - group)
        levels.append(ranks)
        step *= 2


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words places ``a`` and ``b`` of one text have in common."""
    a, b = a.copy(), b.copy()
    total = np.zeros(len(a), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        same = levels[level][a] == levels[level][b]
        step = same.astype(np.int64) << level
        total += step
        a += step
        b += step
    return total


def _common_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words in front of places ``a < b`` of one text agree."""
    a, b = a.copy(), b.copy()
    total = np.zeros(len(a), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        back = a - (1 << level)
        inside = back >= 0
        same = inside & (levels[level][np.maximum(back, 0)] == levels[level][np.maximum(b - (1 << level), 0)])
        step = same.astype(np.int64) << level
        total += step
        a -= step
        b -= step
    return total


def _interval_sides(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place with an LCP above 0: the nearest place before with one
    as small or smaller, and the nearest behind with a smaller one.

    Minima over powers of two places are kept; each search goes over them from
    the largest down, for all places together.
    """
    n = len(lcp)
    places = np.flatnonzero(lcp > 0)
    new = np.ones(len(places), dtype=bool)
    new[1:] = np.diff(places) > 1
    longest = int(np.diff(np.append(np.flatnonzero(new), len(places))).max(initial=0))
    minima = [lcp]
    while 2 << (len(minima) - 1) <= longest:
        half = 1 << (len(minima) - 1)
        last = minima[-1]
        doubled = last.copy()
        doubled[: n - half] = np.minimum(last[: n - half], last[half:])
        doubled[n - half :] = -1
        minima.append(doubled)
    depth = lcp[places]
    before, behind = places.copy(), places + 1
    for level in range(len(minima) - 1, -1, -1):
        size = 1 << level
        back = before - size
        more = (back >= 0) & (minima[level][np.maximum(back, 0)] > depth)
        before = np.where(more, back, before)
        fits = behind + size <= n
        more = fits & (minima[level][np.minimum(behind, n - 1)] >= depth)
        behind = np.where(more, behind + size, behind)
    return before - 1, behind


def find_runs(
    words: np.ndarray, offsets: np.ndarray, periods: int = PERIODS, length: int = LENGTH
) -> Runs:
    """The runs of every text; words ``offsets[t]:offsets[t + 1]`` are those of
    text ``t``, equal words have equal numbers.

    A run is a stretch with least period ``q`` of at least ``periods * q`` (two
    at least) and ``length`` words, which no neighbouring word continues.
    """
    if periods < 2:
        raise ValueError(f"a run repeats: periods must be 2 or more, got {periods}")
    n = len(words)
    nothing = np.zeros(0, dtype=np.int64)
    if n < max(periods, length):
        return Runs(nothing, nothing, nothing, nothing)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    levels = rank_levels(words, text)
    isa = levels[-1][:n]
    sa = np.empty(n, dtype=np.int64)
    sa[isa] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int64)
    alike = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    lcp[alike] = common_prefixes(levels, sa[alike - 1], sa[alike])
    # The interval around a place b is SA[low:high], split in front of b.
    split = np.flatnonzero(lcp > 0)
    low, high = _interval_sides(lcp)
    depth = lcp[split]
    # A run of so many periods holds its period's words as often.
    large = high - low >= periods
    split, low, high, depth = split[large], low[large], high[large], depth[large]
    left_smaller = split - low <= high - split
    first = np.where(left_smaller, low, split)
    size = np.where(left_smaller, split - low, high - split)
    # What of the other side is to be met.
    other = np.where(left_smaller, split, low), np.where(left_smaller, high, split)
    found = []
    for begin, end in _portions(size):
        which = np.repeat(np.arange(begin, end), size[begin:end])
        inner = np.arange(len(which)) - np.repeat(np.cumsum(size[begin:end]) - size[begin:end], size[begin:end])
        suffix = sa[first[which] + inner]
        for step in (depth[which], -depth[which]):
            met = suffix + step
            inside = (met >= 0) & (met < n)
            place = isa[np.clip(met, 0, n - 1)]
            square = inside & (place >= other[0][which]) & (place < other[1][which])
            found.append((np.minimum(suffix, met)[square], depth[which][square]))
    start = np.concatenate([f[0] for f in found]) if found else nothing
    period = np.concatenate([f[1] for f in found]) if found else nothing
    end = start + 2 * period
    start = start - _common_before(levels, start, start + period)
    long = end - start >= np.maximum(periods * period, length)
    start, end, period = start[long], end[long], period[long]
    # Squares of one stretch: its least period is the run's.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return Runs(text[start], start - offsets[text[start]], end - start, period)


def _portions(sizes: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of intervals with about ``limit`` look-ups."""
    sums = np.append(0, np.cumsum(sizes))
    first = 0
    while first < len(sizes):
        last = max(int(np.searchsorted(sums, sums[first] + limit, "right")) - 1, first + 1)
        yield first, last
        first = last


def kept_words(n: int, runs: Runs) -> np.ndarray:
    """Which of ``n`` words of one sequence stay when every run is cut to its
    first period; ``start`` counts from the sequence."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, runs.start + runs.period, 1)
    np.add.at(edges, runs.start + runs.length, -1)
    return np.cumsum(edges[:n]) == 0


def _collapsed(batches: Iterator[pa.RecordBatch], periods: int, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = arrays.utf8(batch.column("text"))
        for first, last in arrays.slices(bounds, BATCH_BYTES):
            split = [data[bounds[i] : bounds[i + 1]].tobytes().split() for i in range(first, last)]
            offsets = np.append(0, np.cumsum([len(words) for words in split])).astype(np.int64)
            words = [word for words in split for word in words]
            numbers: dict[bytes, int] = {}
            ids = np.fromiter(map(numbers.setdefault, words, count()), np.int64, len(words))
            runs = find_runs(ids, offsets, periods, length)
            kept = kept_words(len(words), runs._replace(start=runs.start + offsets[runs.text]))
            per_text = np.append(0, np.cumsum(np.bincount(runs.text, minlength=last - first)))
            texts = []
            for i, own in enumerate(split):
                if per_text[i + 1] > per_text[i]:
                    own = [own[j] for j in np.flatnonzero(kept[offsets[i] : offsets[i + 1]])]
                texts.append(b" ".join(own))
            lists = pa.ListArray.from_arrays(
                pa.array(per_text, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(v, pa.int64()) for v in (runs.start, runs.length, runs.period)],
                    names=["start", "length", "period"],
                ),
            )
            yield pa.record_batch(
                [
                    batch.column("doc_id").slice(first, last - first),
                    pa.array(np.diff(offsets)),
                    lists,
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame, periods: int = PERIODS, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of
    ``docs(doc_id, text)``.

    Words are runs of characters other than space and 0x09-0x0D, compared as
    they are.  ``runs`` holds ``start`` (a word's number, from 0), ``length`` and
    ``period`` of every run, by start, then period.  ``collapsed`` is the text
    without the words that any run holds after its first period, with one
    space between words.

    A null or blank text has no words, no runs and an empty ``collapsed``.  Rows
    that repeat an id, or have none, stand for themselves.  A text of any
    length is taken whole: memory is in proportion to its words, times the
    logarithm of its longest repeat.  Other columns are ignored.  Nothing is
    shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _collapsed(batches, periods, length)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(run, schema)
