"""Periodic run detection with string synchronising sets (operator 13).

A run is a longest stretch of words in which words ``q`` apart are the same, ``q`` being its smallest period, and which holds
``repeats`` periods and ``least`` words at least. All runs of a text are found, and its words without those that
a run repeats.

* **Small periods.** Periods up to three are read off directly: words are compared with those one to three places on.
* **Synchronising sets.** For ``t`` = 4, 8, 16, ... a hash of the ``t`` words from each place on selects places: a place is
  chosen if it has the least hash of the ``t + 1`` places from it on, or if the place ``t`` further has. Whether a place
  is chosen depends on the ``2 t`` words from it on alone (its context), and one in ``t`` neighbouring places is chosen,
  but inside regions whose period is a quarter of ``t`` or less. Such places are left out of the hashes; their
  regions are runs found at a smaller ``t``, so they are known.
* **Proposals.** In a run of period ``q``, with ``t <= q < 2 t``, a chosen place lies among the first ``t`` places, and the place
  ``q`` further has the same context, which no place between has. So each chosen place and the next one with its context
  propose a period, and there are no more proposals than places.
* **Runs.** Proposals of one period that overlap by it are put together, and the ends, fewer than ``t`` places away, are
  found by comparing words. The stretch is then compared word by word; should hashes have lied, the text is read
  through for that period.

Words are compared by 64-bit hashes. Spark spreads the texts; a task turns some of them, or one that is longer, into
arrays at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.binding import bound
from changeloom.llm.common import Words, id_and_text, mix, steps, words_of

SMALL = 3
# Words that are compared at a time when the ends of stretches are looked for.
_COMPARED = 1 << 20
RUN = "start long, length long, period long"
_NONE = np.uint64((1 << 64) - 1)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each place on, in a number of passes that does not grow with it."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, _NONE)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    first = np.minimum.accumulate(square, 1).ravel()
    last = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(last[:n], first[width - 1 : width - 1 + n])


def stretches(words: np.ndarray, period: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, end)`` of the longest stretches of ``repeats`` periods or more, by comparing all words."""
    if len(words) <= period:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.zeros(len(words) - period + 2, bool)
    same[1:-1] = words[period:] == words[:-period]
    change = np.flatnonzero(same[1:] != same[:-1])
    start, end = change[::2], change[1::2] + period
    enough = end - start >= repeats * period
    return start[enough], end[enough]


def doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Hashes of twice as many words from each place on; ``names`` are those of ``width`` words.

    Stretches that would reach over the end have hashes of their own. No sums of powers: those of two words
    in the order of a Thue-Morse sequence agree where the words do not.
    """
    beyond = mix(np.arange(width, dtype=np.uint64) + np.uint64(width << 32))
    after = np.r_[names[width:], beyond[: len(names)]] if width < len(names) else beyond[: len(names)]
    return mix(names * np.uint64(0xD1342543DE82EF95) + mix(after + np.uint64(0x9E3779B97F4A7C15)))


def _exact(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the words of each stretch are the same a period apart."""
    sizes = end - start - period
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - sizes), sizes)
    wrong = words[place] != words[place + np.repeat(period, sizes)]
    count = np.r_[0, np.cumsum(wrong)]
    return count[ends] == count[ends - sizes]


def _proposals(names: np.ndarray, t: int, periodic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(place, period)`` from chosen places and the next ones with their context."""
    hashes = np.where(periodic, _NONE, names)
    least = window_minimum(hashes, t + 1)
    chosen = np.flatnonzero((least != _NONE) & ((hashes[: len(least)] == least) | (hashes[t:] == least)))
    context = doubled(names, t)[chosen]
    order = np.argsort(context, kind="stable")
    place, context = chosen[order], context[order]
    period = place[1:] - place[:-1]
    fits = (context[1:] == context[:-1]) & (period >= t) & (period < 2 * t)
    return place[:-1][fits], period[fits]


def _matching(words: np.ndarray, a: np.ndarray, b: np.ndarray, step: int, reach: int) -> np.ndarray:
    """How many words from each ``a`` and ``b`` on, in steps of 1 or -1, are the same."""
    length = np.zeros(len(a), np.int64)
    going = np.arange(len(a))
    while len(going):
        ahead = (length[going, None] + np.arange(reach)) * step
        x, y = a[going, None] + ahead, b[going, None] + ahead
        inside = (x >= 0) & (y < len(words))
        same = inside & (words[np.where(inside, x, 0)] == words[np.where(inside, y, 0)])
        count = np.where(same.all(1), reach, same.argmin(1))
        length[going] += count
        going = going[count == reach]
    return length


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, t: int, repeats: int) -> np.ndarray:
    """``(start, end, period)`` of the stretches that the proposals lie in, each once."""
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    # From its place on, a proposal covers its period and its context. Two that share a period's length are one stretch.
    first = np.ones(len(at), bool)
    first[1:] = (period[1:] != period[:-1]) | (at[1:] - at[:-1] > 2 * t)
    last = np.r_[first[1:], True][: len(at)]
    start, period, end = at[first], period[first], at[last] + period[last] + 2 * t
    # Inside a run there is a proposal within t places of either end.
    long = end - start >= repeats * period - 2 * t
    start, period, end = start[long], period[long], end[long]
    parts = []
    together = max(1, _COMPARED // t)
    for i in range(0, len(start), together):
        part = slice(i, i + together)
        before = _matching(words, start[part] - 1, start[part] - 1 + period[part], -1, t)
        after = _matching(words, end[part] - period[part], end[part], 1, t)
        parts.append(np.stack([start[part] - before, end[part] + after, period[part]]))
    runs = np.concatenate(parts, 1) if parts else np.zeros((3, 0), np.int64)
    runs = np.unique(runs[:, runs[1] - runs[0] >= repeats * runs[2]], axis=1)
    right = _exact(words, *runs) if runs.size else np.zeros(0, bool)
    parts = [runs[:, right]]
    for q in np.unique(runs[2][~right]):
        begin, finish = stretches(words, int(q), repeats)
        parts.append(np.stack([begin, finish, np.full(len(begin), q)]))
    return np.concatenate(parts, 1)


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = 6, repeats: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of all runs of texts whose words follow one another, by start and then period.

    The texts have ``sizes`` words each; places are counted through all of them. ``repeats`` must be four or more.
    """
    if repeats < 4:
        raise ValueError("runs of fewer than four periods need not show in the synchronising sets")
    # A mark of its own ends each text, so that nothing reaches over.
    marked = np.ones(len(words) + len(sizes), bool)
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    marked[np.cumsum(sizes + 1) - 1] = False
    joined = mix(owner.astype(np.uint64) + np.uint64(0x7F4A7C15 << 20))
    joined[marked] = words
    found = []
    for period in range(1, SMALL + 1):
        start, end = stretches(joined, period, repeats)
        found.append(np.stack([start, end, np.full(len(start), period)]))
    t = SMALL + 1
    names = doubled(doubled(mix(joined), 1), 2)
    while (large := sizes >= repeats * t).any():
        here = large[owner]
        place, rank = np.flatnonzero(here), np.cumsum(here) - 1
        part = joined[place]
        # Places whose next t words lie in a region of small period.
        start, end, period = np.concatenate(found, 1)
        inside = (4 * period <= t) & (end - start >= t) & here[start]
        border = np.zeros(len(part) + 1, np.int64)
        np.add.at(border, rank[start[inside]], 1)
        np.add.at(border, rank[end[inside] - 1] - t + 2, -1)
        runs = _extended(part, *_proposals(names[place], t, np.cumsum(border)[:-1] > 0), t, repeats)
        found.append(np.stack([place[runs[0]], place[runs[1] - 1] + 1, runs[2]]))
        names = doubled(names, t)
        t *= 2
    start, end, period = np.concatenate(found, 1)
    # Multiples of a run's period are periods of it too: the smallest stays.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    keep &= end - start >= np.maximum(least, repeats * period)
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return start - owner[start], end - owner[start], period


def _joined_words(found: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    chosen = np.flatnonzero(kept)
    owner = found.owners()[chosen]
    last = np.ones(len(chosen), bool)
    last[:-1] = owner[1:] != owner[:-1]
    sizes = found.ends[chosen] - found.starts[chosen] + ~last
    ends = np.cumsum(sizes)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(found.starts[chosen] - (ends - sizes), sizes)
    data = found.raw[np.minimum(place, max(len(found.raw) - 1, 0))] if len(place) else np.zeros(0, np.uint8)
    data[ends[~last] - 1] = 0x20
    lengths = np.bincount(owner, sizes, len(found.counts)).astype(np.int64)
    offsets = np.r_[0, np.cumsum(lengths)]
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _described(batches: Iterator[pa.RecordBatch], least: int, repeats: int) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        found = Words(step.column("t"))
        start, end, period = find_runs(found.hashes(), found.counts, least, repeats)
        border = np.zeros(len(found.starts) + 1, np.int64)
        np.add.at(border, start + period, 1)
        np.add.at(border, end, -1)
        kept = np.cumsum(border)[:-1] == 0
        owner = np.searchsorted(found.first, start, "right") - 1
        per_text = np.bincount(owner, minlength=step.num_rows)
        columns = [start - found.first[owner], end - start, period]
        rows = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["start", "length", "period"])
        runs = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_text)].astype(np.int32)), rows)
        yield pa.RecordBatch.from_arrays(
            [step.column("k"), pa.array(found.counts.astype(np.int64)), runs, _joined_words(found, kept).cast(pa.string())],
            names=["k", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, repeats: int = 4) -> DataFrame:
    """``(k, n_words, runs, collapsed)`` for each row of ``docs``.

    ``runs`` are structs of first word (from 0), length and period, by start and then period. ``collapsed`` has, joined by
    one space, the words that no run contains after its first period. A NULL or empty text has no words and no
    runs and collapses to an empty one. Rows with NULL or repeated keys are described each. Other columns are not
    carried. An empty table gives an empty result.
    """
    schema = f"k long, n_words long, runs array<struct<{RUN.replace(' long', ': bigint')}>>, collapsed string"
    return id_and_text(docs, key, text).mapInArrow(partial(_described, least=least, repeats=repeats), schema)


def with_planted_periods(text: Column, key: Column) -> Column:
    """A tenth of the texts with a periodic tail of their own words: which, where and how follows from a hash of the key.

    Texts without a word, NULL ones and those with a NULL key stay as they are.
    """
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        begin = g % n
        period = 1 + F.floor((n - begin) / (3 + g % 8))

        def word(i: Column) -> Column:
            source = F.when(i < begin, i).otherwise(begin + (i - begin) % period)
            return F.get(words, source.cast("int"))

        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), word), " ")).otherwise(text)

    return F.when(h % 10 == 0, bound(words_of(text), planted)).otherwise(text)
