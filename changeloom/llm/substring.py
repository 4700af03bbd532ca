"""Removal of repeated passages with prefix-partitioned suffix trees (operator 4).

The leaves are the suffixes that begin a window of ``window`` words. A suffix is labelled with a prefix, and all
leaves of a prefix lie in one subtree. Prefixes are counted first, and their length varies: a prefix that only one
document has needs no subtree, one with more than ``most`` runs of leaves is lengthened, and the rest are dealt to
groups, as many as keep ``GROUP_WORDS`` words in each. In a group the suffixes are sorted (by
doubling of ranks), longest common prefixes of neighbours are read off the ranks, and stretches of the order
that share ``window`` words are the inner nodes at that depth. A leaf is a repeat if its node has one in a document
with a smaller key. A prefix as long as the window is a node itself and is only aggregated.

A label is not a suffix's first words, but the least (by hash) of the ``length``-word sequences in its window. Equal windows
have equal labels just so, while neighbouring suffixes mostly share theirs: they travel as one run, with its
words sent once, where first words would send a window per suffix. A run is cut after ``window`` leaves.

A step of a scanning task first looks for repeats among its own texts, by hashes of windows. It sends a window
once and answers for its other occurrences itself, so that a passage that fills the corpus costs a window per
step, not one per document.

Words are compared by 64-bit hashes. A suffix is known up to the end of its run's words, ``2 * window - 1`` at most:
longer repeats come out as unions of overlapping spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import Words, gram_hashes, id_and_text, mix, partitions_for, steps, stored

STEP = 4 << 20
# Words of suffixes that a group holds on average.
GROUP_WORDS = 1_000_000
_RUNS = "p long, k long, h long, s int, n int"
_RECORDS = "p long, k long, h long, s int, t string"
_SPANS = "k long, h long, s int, e int"


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` neighbours from each place on."""
    span, least = 1, grams
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _beyond_first(labels: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """True for leaves that have a leaf with their label in a document with a smaller id."""
    order = np.argsort(labels)
    sorted_docs, same = docs[order], labels[order]
    heads = np.flatnonzero(np.r_[True, same[1:] != same[:-1]])
    least = np.repeat(np.minimum.reduceat(sorted_docs, heads), np.diff(np.r_[heads, len(same)]))
    result = np.empty(len(labels), bool)
    result[order] = sorted_docs > least
    return result


def _runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin, and their lengths; ``breaks`` tells where an element leaves its predecessor."""
    begins = np.flatnonzero(np.r_[True, breaks])
    return begins, np.diff(np.r_[begins, len(breaks) + 1])


def _in_pieces(begin: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs, cut after every ``size`` elements."""
    pieces = -(-count // size)
    turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.repeat(begin, pieces) + turn * size, np.minimum(np.repeat(count, pieces) - turn * size, size)


def _asked(step: pa.RecordBatch, words: Words) -> np.ndarray:
    """Which words begin one of the windows that the column ``runs`` names; all, where there is none."""
    if "runs" not in step.schema.names:
        return np.ones(len(words.starts), bool)
    runs, of = step.column("runs").flatten(), np.asarray(pc.list_parent_indices(step.column("runs")), np.int64)
    first = words.first[of] + np.asarray(runs.field("s"), np.int64)
    change = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + np.asarray(runs.field("n"), np.int64), -1)
    return np.cumsum(change[:-1]) > 0


def _labelled(batches: Iterator[pa.RecordBatch], window: int, length: int) -> Iterator[pa.RecordBatch]:
    """Runs of suffixes with one prefix of ``length`` words; without a prefix those found to be repeats."""
    for step in steps(batches, limit=STEP):
        words = Words(step.column("t"))
        if len(words.starts) < window:
            continue
        ids = np.asarray(step.column("k"), np.int64)
        hashes, owner = words.hashes(), words.owners()
        places = len(owner) - window + 1
        place = np.flatnonzero((owner[:places] == owner[window - 1 :]) & _asked(step, words)[:places])
        if not len(place):
            continue
        prefix = _least(gram_hashes(hashes, length), window - length + 1)[place]
        doc = ids[owner[place]]
        known = _beyond_first(gram_hashes(hashes, window)[place] + mix(prefix), doc)
        changes = known[1:] != known[:-1]
        begin, count = _runs((np.diff(place) != 1) | (owner[place[1:]] != owner[place[:-1]]) | changes | ((prefix[1:] != prefix[:-1]) & ~known[1:]))
        begin, count = _in_pieces(begin, count, window)
        at = place[begin]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(prefix[begin].view(np.int64), mask=known[begin]),
                pa.array(doc[begin]),
                step.column("h").take(pa.array(owner[at])),
                pa.array((at - words.first[owner[at]]).astype(np.int32)),
                pa.array(count.astype(np.int32)),
            ],
            names=["p", "k", "h", "s", "n"],
        )


def _with_words(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The runs, each with the words that its suffixes reach."""
    for step in steps(batches, limit=STEP):
        words = Words(step.column("t"))
        runs, of = step.column("runs").flatten(), np.asarray(pc.list_parent_indices(step.column("runs")), np.int64)
        first = words.first[of] + np.asarray(runs.field("s"), np.int64)
        begins = words.starts[first]
        ends = words.ends[first + np.asarray(runs.field("n"), np.int64) + window - 2]
        raw = words.raw.tobytes()
        texts = [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [runs.field("p"), step.column("k").take(pa.array(of)), step.column("h").take(pa.array(of)), runs.field("s"),
             pa.array(texts, pa.binary()).cast(pa.string())],
            names=["p", "k", "h", "s", "t"],
        )


def _ranks(values: np.ndarray) -> np.ndarray:
    """From 1 on; a group is far below the room of 32 bits."""
    return (np.unique(values, return_inverse=True)[1] + 1).astype(np.int32)


class SuffixTree:
    """The sorted suffixes of some word sequences, and the common prefixes of neighbours.

    Suffixes end with their sequence. ``order`` holds the places of those with ``least`` words or more;
    ``common[i]`` is how many words ``order[i]`` and ``order[i + 1]`` share.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, least: int):
        self.left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
        ranks = [_ranks(words)]
        span, longest = 1, int(counts.max(initial=0))
        while span < longest:
            following = np.zeros(len(words), np.int64)
            following[:-span] = ranks[-1][span:]
            following[self.left <= span] = 0
            ranks.append(_ranks(ranks[-1].astype(np.int64) * (len(words) + 1) + following))
            span *= 2
        deep = np.flatnonzero(self.left >= least)
        self.order = deep[np.argsort(ranks[-1][deep], kind="stable")]
        one, other = self.order[:-1].copy(), self.order[1:].copy()
        self.common = np.zeros(len(one), np.int64)
        for level in reversed(range(len(ranks))):
            room = np.minimum(self.left[self.order[:-1]], self.left[self.order[1:]]) - self.common >= 1 << level
            where = np.flatnonzero(room)
            equal = where[ranks[level][one[where]] == ranks[level][other[where]]]
            for side in (one, other, self.common):
                side[equal] += 1 << level

    def nodes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the stretches of ``order`` begin that share ``depth`` words, and how long they are."""
        return _runs(self.common < depth) if len(self.order) else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _repeats(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The spans of a group's leaves that also begin in a document with a smaller key."""
    held: dict[str, list[np.ndarray]] = {name: [] for name in ("k", "h", "s", "words", "counts")}
    for batch in batches:
        words = Words(batch.column("t"))
        held["words"].append(words.hashes())
        held["counts"].append(words.counts)
        for name in ("k", "h", "s"):
            held[name].append(np.asarray(batch.column(name), np.int64))
    if not held["k"]:
        return
    k, h, s, words, counts = (np.concatenate(held.pop(name)) for name in list(held))
    tree = SuffixTree(words, counts, window)
    begin, size = tree.nodes(window)
    record = np.repeat(np.arange(len(k)), counts)
    doc = k[record[tree.order]]
    least = np.repeat(np.minimum.reduceat(doc, begin), size)
    place = np.sort(tree.order[doc > least])
    if not len(place):
        return
    of = record[place]
    begin, size = _runs((np.diff(place) != 1) | (of[1:] != of[:-1]))
    of = of[begin]
    start = s[of] + place[begin] - (np.cumsum(counts) - counts)[of]
    columns = [k[of], h[of], start.astype(np.int32), (start + size + window - 1).astype(np.int32)]
    for i in range(0, len(of), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + (1 << 16)]) for c in columns], names=["k", "h", "s", "e"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        sizes, removed, kept = [], [], []
        for text, starts, ends in zip(*(step.column(c).to_pylist() for c in ("t", "s", "e")), strict=True):
            words = text.encode().split()
            sizes.append(len(words))
            if not starts:
                removed.append(0)
                kept.append(b" ".join(words).decode())
                continue
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, np.minimum(starts, len(words)), 1)
            np.add.at(change, np.minimum(ends, len(words)), -1)
            stays = np.cumsum(change[:-1]) == 0
            removed.append(len(words) - int(stays.sum()))
            kept.append(b" ".join([words[i] for i in np.flatnonzero(stays).tolist()]).decode())
        yield pa.RecordBatch.from_arrays(
            [step.column("k"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["k", "n_words", "n_removed", "kept"],
        )


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``k``, ``h`` (tells texts of one key apart) and ``t``."""
    return id_and_text(docs, key, text).select("k", F.xxhash64("t").alias("h"), "t")


def _by_text(runs: DataFrame) -> DataFrame:
    return runs.groupBy("k", "h").agg(F.collect_list(F.struct("p", "s", "n")).alias("runs"))


def repeated_spans(
    docs: DataFrame, key: str, text: str, window: int = 50, gram: int = 10, most: int = 20_000
) -> DataFrame:
    """Word spans ``(k, h, s, e)`` (end exclusive) that windows repeated from smaller ids cover.

    ``h`` is the ``xxhash64`` of the text. Spans may touch or overlap. Rows without a key take no part. Rows that
    share a key count as one document: they cover nothing in each other. ``gram`` is the least length of a
    prefix; it doubles up to ``window`` where more than ``most`` runs share one.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    source = _identified(docs, key, text).where(F.col("k").isNotNull())
    asked, length = source, gram
    end = F.col("s") + F.col("n") + window - 1
    found, ready = [], []
    while True:
        runs = stored(asked.mapInArrow(partial(_labelled, window=window, length=length), _RUNS), "runs")
        found.append(runs.where("p IS NULL").select("k", "h", "s", end.alias("e")))
        counts = runs.where("p IS NOT NULL").groupBy("p").agg(F.count("*").alias("runs"), F.min("k").alias("least"), F.max("k").alias("last"))
        counts = stored(counts.where("least < last"), "prefixes")
        shared = runs.join(counts, "p")
        if length == window:
            found.append(shared.where("k > least").select("k", "h", "s", end.alias("e")))
            break
        ready.append(stored(shared.where(F.col("runs") <= most).select(*runs.columns), "ready"))
        if counts.where(F.col("runs") > most).isEmpty():
            break
        asked = source.join(_by_text(shared.where(F.col("runs") > most)), ["k", "h"])
        length = min(2 * length, window)
    if ready:
        runs = reduce(DataFrame.union, ready)
        total = runs.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
        groups = max(partitions_for(docs), -(-total // GROUP_WORDS))
        records = source.join(_by_text(runs).hint("shuffle_hash"), ["k", "h"]).mapInArrow(partial(_with_words, window=window), _RECORDS)
        grouped = records.withColumn("g", F.pmod("p", F.lit(groups)).cast("int")).repartitionById(groups, "g").drop("g")
        found.append(grouped.mapInArrow(partial(_repeats, window=window), _SPANS))
    return reduce(DataFrame.union, found)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50, gram: int = 10, most: int = 20_000
) -> DataFrame:
    """Per row: the key as ``k``, ``n_words``, ``n_removed`` and the ``kept`` text.

    A word goes if a window of ``window`` words around it also begins in a document with a smaller
    key. Kept words are joined by one space. NULL and empty texts have no words and are kept as ''.
    Texts shorter than a window stay whole. Rows with a NULL key stay whole too. Equal rows give equal
    results; different texts of one key are each cut where they repeat smaller keys; an empty table gives an
    empty result. Other columns are not read.
    """
    spans = stored(repeated_spans(docs, key, text, window, gram, most), "repeats", free=True)
    spans = spans.groupBy("k", "h").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    # The spans are the small side: hashing them spares the texts a sort.
    joined = _identified(docs, key, text).join(spans.hint("shuffle_hash"), ["k", "h"], "left")
    return joined.mapInArrow(_cut, "k long, n_words long, n_removed long, kept string")
