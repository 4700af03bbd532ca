"""Benchmark decontamination with CGK embeddings and bit-sampling LSH (operator 1).

Texts are compared word by word: ASCII signs and case are ignored. A document is contaminated by an item of
``n`` words if some passage of it is within ``n * rate`` word edits of the item. Items under ``min_words`` words must be
met exactly; they are looked up by the hash of their words.

* **Windows.** For each item length the documents' windows of that length are looked at, at every word.
  An edit changes three of an item's three-word sequences at most, so the window at which a passage within
  the bound begins has all but that many of them; running counts of sequences which occur in
  items of that length rule out nearly all windows by that, and lose none.
* **Embedding.** A CGK random walk copies a window to a sequence of up to twice its length, waiting at each
  word or moving on by a coin that the word and the step toss. Walks of two texts with few edits
  between them soon meet again, so edit distance becomes Hamming distance.
* **Bit sampling.** A signature is made of ``samples`` places of a walk. It is repeated with other coins and places, so
  that the chance to miss a passage falls with every round, and every passage has several windows. Walks drift
  apart with every edit, so the number of rounds follows from the item's length: as many as it takes to find
  a passage with all edits of the bound with the chance ``target``. Tests measure that.
* **Verification.** Neighbouring candidate windows are one region, in which passages and their exact edit distances
  are found by dynamic programming: the best one first, then all others that overlap none before them.

Documents are not shuffled. The index of the items goes to the tasks in blocks of at most ``block_bytes`` of
item text, one pass over the documents for each block, so its size has a bound that no table can exceed
(but by a single longer item).
"""

from __future__ import annotations

import math
from bisect import bisect_left as bisect
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import Words, gram_hashes, id_and_text, mix, span_hashes, steps

PAD = np.uint64(0)
# Longer steps than elsewhere: each one has a fixed cost per item length. Its arrays are many times the texts.
STEP = 2 << 20
# Words of the sequences that windows are filtered by.
GRAM = 3
# Places that walk at once.
WALKS = 1 << 20
MATCHES = "k long, item long, start int, end int, distance int"


class Settings(NamedTuple):
    rate: float = 0.2
    min_words: int = 8
    target: float = 0.99
    samples: int = 2
    block_bytes: int = 8 << 20

    def edits(self, n: int) -> int:
        return max(1, int(n * self.rate)) if n >= self.min_words else 0

    def rounds(self, n: int) -> int:
        """As many as reach the target when all edits of the bound are used.

        Simulated walks (random words, 8 to 400 words, a fifth of them edited, two samples) meet in a round with a chance
        of 0.68 to 0.08; the fit below is under what their recall amounts to at every length.
        """
        chance = (1.6 / (self.edits(n) + 2)) ** (self.samples / 2)
        return max(1, math.ceil(math.log(1 - self.target) / math.log(1 - chance)))

    def places(self, n: int, turn: int) -> np.ndarray:
        """The sampled steps of a walk; a walk over ``n`` words is mostly over after ``2 n`` steps."""
        chance = np.random.Generator(np.random.PCG64([n, turn]))
        return np.sort(chance.choice(2 * n, self.samples, replace=False))


class Index(NamedTuple):
    items: list[tuple[int, np.ndarray]]
    # By the end of the hash of GRAM words: in which classes of item lengths they occur.
    vocabulary: np.ndarray
    length_class: dict[int, int]
    by_length: dict[int, tuple[np.ndarray, np.ndarray]]


def _signatures(words: np.ndarray, starts: np.ndarray, stops: np.ndarray, n: int, settings: Settings) -> np.ndarray:
    """A row of signatures, one a round, for each window; words at or after its stop are padding."""
    if n < settings.min_words:
        return span_hashes(words, starts, stops)[:, None]
    rounds = settings.rounds(n)
    turns = np.arange(rounds, dtype=np.uint64)[:, None]
    sampled: dict[int, list[int]] = {}
    for turn in range(rounds):
        for place in settings.places(n, turn).tolist():
            sampled.setdefault(place, []).append(turn)
    # All rounds walk at once: a row per round.
    at = np.repeat(starts[None, :], rounds, 0)
    names = np.repeat(mix(turns + np.uint64(n * 1000)), len(starts), 1)
    for step in range(max(sampled) + 1):
        word = np.where(at < stops, words[np.minimum(at, len(words) - 1)], PAD)
        if step in sampled:
            names[sampled[step]] = mix(names[sampled[step]] + word[sampled[step]])
        at += (mix(word + turns * np.uint64(65537) + np.uint64(step * 3 + 1)) >> np.uint64(63)).astype(np.int64)
    return names.T


def gram_of(n: int) -> int:
    """Words of the sequences by which windows of ``n`` words are filtered."""
    return min(n, GRAM)


def build_index(rows: list[tuple[int, str]], settings: Settings) -> Index:
    items = []
    for item, text in rows:
        words = Words(pa.array([text or ""]), fold=True).hashes()
        if len(words):
            items.append((item, words))
    size = 1 << 12
    while size < 64 * sum(len(words) for _, words in items):
        size *= 2
    lengths = sorted({len(words) for _, words in items})
    length_class = {n: i * min(64, len(lengths)) // len(lengths) for i, n in enumerate(lengths)}
    vocabulary, by_length = np.zeros(size, np.uint64), {}
    for _, words in items:
        grams = gram_hashes(words, gram_of(len(words)))
        vocabulary[(grams & np.uint64(size - 1)).astype(np.int64)] |= np.uint64(1 << length_class[len(words)])
    for n in lengths:
        mine = [i for i, (_, words) in enumerate(items) if len(words) == n]
        joined = np.concatenate([items[i][1] for i in mine])
        starts = np.arange(len(mine)) * n
        names = _signatures(joined, starts, starts + n, n, settings)
        owners = np.repeat(np.array(mine), names.shape[1])
        order = np.argsort(names.ravel(), kind="stable")
        by_length[n] = (names.ravel()[order], owners[order])
    return Index(items, vocabulary, length_class, by_length)


def _candidates(words: np.ndarray, stops: np.ndarray, index: Index, settings: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(place, item)`` of windows that share a signature with an item."""
    found, last, count = [], None, np.zeros(0)
    for n in sorted(index.by_length):
        gram = gram_of(n)
        if (index.length_class[n], gram) != last:
            if last is None or gram != last[1]:
                classes = index.vocabulary[(gram_hashes(words, gram) & np.uint64(len(index.vocabulary) - 1)).astype(np.int64)]
            last = (index.length_class[n], gram)
            count = np.cumsum((classes >> np.uint64(last[0])) & np.uint64(1), dtype=np.int32)
            count = np.r_[np.int32(0), count, np.full(max(index.by_length) + GRAM, count[-1] if len(count) else 0, np.int32)]
        inside = n - gram + 1
        least = inside - gram * settings.edits(n)
        at = np.flatnonzero(count[inside : inside + len(words)] - count[: len(words)] >= least)
        ends = np.minimum(at + n, stops[at])
        mine = count[np.maximum(ends - gram + 1, at)] - count[at] >= least
        at, ends = at[mine], ends[mine]
        if len(at):
            names, owners = index.by_length[n]
            # Repeated lines make windows that are equal; one walk serves them all.
            _, one, same = np.unique(span_hashes(words, at, ends), return_index=True, return_inverse=True)
            cuts = range(0, len(one), max(1, WALKS // settings.rounds(n)))
            walked = [_signatures(words, at[x], ends[x], n, settings) for x in (one[c : c + cuts.step] for c in cuts)]
            signatures = np.concatenate(walked)[same]
            rounds, signatures = signatures.shape[1], signatures.ravel()
            left, right = np.searchsorted(names, signatures, "left"), np.searchsorted(names, signatures, "right")
            hits = np.flatnonzero(right > left)
            width = right[hits] - left[hits]
            spread = np.repeat(left[hits] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            found.append((np.repeat(at[hits // rounds], width), owners[spread]))
    return found


def _last_row(pattern: np.ndarray, text: np.ndarray, anywhere: bool) -> np.ndarray:
    """Per end in the text, the least edit distance of the pattern to the text from its start, or from anywhere."""
    steps_ = np.arange(len(text) + 1)
    row = np.zeros_like(steps_) if anywhere else steps_.copy()
    for i, word in enumerate(pattern):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps_) + steps_
    return row


def passages(item: np.ndarray, words: np.ndarray, edits: int) -> list[tuple[int, int, int]]:
    """``(distance, start, end)`` of passages within ``edits`` that do not overlap, better ones first taken, by place.

    No further passage fits beside them.
    """
    if not edits:
        same = np.ones(max(0, len(words) - len(item) + 1), bool)
        for i, word in enumerate(item):
            same &= words[i : i + len(same)] == word
        taken, free = [], 0
        for start in np.flatnonzero(same).tolist():
            if start >= free:
                free = start + len(item)
                taken.append((0, start, free))
        return taken
    taken, gaps = [], [(0, len(words))]
    while gaps:
        low, high = gaps.pop()
        if high - low < len(item) - edits:
            continue
        row = _last_row(item, words[low:high], True)
        if row.min() > edits:
            continue
        # Ends that are no worse than the ones beside them; what they leave is looked at as gaps of their own.
        sides = np.r_[edits + 1, row, edits + 1]
        ends = np.flatnonzero((row <= edits) & (row <= sides[:-2]) & (row <= sides[2:]))
        spans: list[tuple[int, int, int]] = []
        for end in ends[np.argsort(row[ends], kind="stable")].tolist():
            i = bisect(spans, (low + end,))
            # The nearest one before, and the nearest that ends at or after this end.
            least = low + end - (len(item) - edits)
            if (i and spans[i - 1][0] > least) or (i < len(spans) and spans[i][1] < low + end):
                continue
            begin = max(0, end - len(item) - edits)
            size = int(_last_row(item[::-1], words[low + begin : low + end][::-1], False).argmin())
            start = low + end - size
            if i and spans[i - 1][0] > start:
                continue
            spans.insert(i, (low + end, start, int(row[end])))
        edges = [low, *(x for end, start, _ in spans for x in (start, end)), high]
        gaps += zip(edges[::2], edges[1::2], strict=True)
        taken += [(distance, start, end) for end, start, distance in spans]
    return sorted(taken, key=lambda x: x[1])


def _found(column: pa.Array, index: Index, settings: Settings) -> Iterator[tuple[int, int, int, int, int]]:
    """``(row, item, start, end, distance)`` of the contaminated passages of a step of texts."""
    text = Words(column, fold=True)
    if not len(text.starts) or not index.items:
        return
    words, owner = text.hashes(), text.owners()
    pairs = _candidates(words, text.first[1:][owner], index, settings)
    pairs = [p for p in pairs if len(p[0])]
    if not pairs:
        return
    place, item = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    order = np.lexsort((place, item))
    place, item = place[order], item[order]
    # So far apart that regions, with what is looked at beside them, do not overlap.
    sizes = np.array([len(w) + 4 * settings.edits(len(w)) for _, w in index.items])
    apart = (np.diff(place) > sizes[item[1:]]) | (np.diff(item) != 0) | (owner[place[1:]] != owner[place[:-1]])
    heads = np.flatnonzero(np.r_[True, apart])
    for a, b in zip(heads, np.r_[heads[1:], len(place)] - 1, strict=True):
        row, (name, pattern) = int(owner[place[a]]), index.items[item[a]]
        edits = settings.edits(len(pattern))
        low = max(int(text.first[row]), int(place[a]) - 2 * edits)
        high = min(int(text.first[row + 1]), int(place[b]) + len(pattern) + 2 * edits)
        shift = low - int(text.first[row])
        for distance, start, end in passages(pattern, words[low:high], edits):
            yield row, name, start + shift, end + shift, distance


def _matches(batches: Iterator[pa.RecordBatch], index: Index, settings: Settings) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, limit=STEP):
        found = list(_found(step.column("t"), index, settings))
        if not found:
            continue
        rows, item, start, end, distance = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays(
            [step.column("k").take(pa.array(rows)), pa.array(item, pa.int64()), *[pa.array(x, pa.int32()) for x in (start, end, distance)]],
            names=["k", "item", "start", "end", "distance"],
        )


def _clean(batches: Iterator[pa.RecordBatch], text: str, index: Index, settings: Settings) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, text, STEP):
        bad = np.zeros(step.num_rows, bool)
        bad[[row for row, *_ in _found(step.column(text), index, settings)]] = True
        yield step.filter(pa.array(~bad))


def indexes(items: DataFrame, item_key: str, item_text: str, settings: Settings) -> Iterator[Index]:
    """An index per block of items; items without a key or text match nothing."""
    rows = id_and_text(items, item_key, item_text).where("k IS NOT NULL AND t <> ''")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // settings.block_bytes)
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == block)
        yield build_index(sorted((row.k, row.t) for row in part.toLocalIterator()), settings)


def contaminated_passages(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", settings: Settings = Settings(),
) -> DataFrame:
    """``(k, item, start, end, distance)``: the passages, in words, of each document within an item's bound.

    Passages of one item do not overlap: the best of a region is taken, the first of equal ones, and then all
    that fit beside those taken. NULL, empty and
    short texts have none; items without words match nothing; repeated rows and items
    repeat their matches; a NULL key is kept as it is. Without documents or items the result is empty.
    """
    source, found = id_and_text(docs, key, text), None
    for index in indexes(items, item_key, item_text, settings):
        part = source.mapInArrow(partial(_matches, index=index, settings=settings), MATCHES)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], MATCHES) if found is None else found


def without_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no passage of an item."""
    for index in indexes(items, item_key, item_text, settings):
        docs = docs.mapInArrow(partial(_clean, text=text, index=index, settings=settings), docs.schema)
    return docs
