"""Spelling variant grouping by reduced-alphabet generation (operator 12).

Two words are near if one inserted, deleted or replaced letter leads from one to the other. A word's form is
its most frequent near word, if that one is at least ``ratio`` times as frequent; forms lead to a root.

* **Vocabulary.** Runs of letters of all texts are counted, in part before the shuffle.
* **Reduction.** A hash takes each letter to one of a few symbols. One edit of a word is at most one edit of its
  reduced word (none, if a letter is replaced by one of the same symbol).
* **Generation.** From each reduced word come all reduced words within one edit: itself, deletions, replacements and
  insertions. They are joined with the reduced vocabulary, and a pair counts once the edit is verified on the words
  themselves.
* **Crowded reduced words.** Where more than ``crowd`` words share a reduced word, they are not matched there but go on to
  the next, larger alphabet, among themselves; in the last one each letter is its own symbol, and no two
  words share anything. A pair with one word in a crowd is found from that word, as the other one is not in a
  crowd. So every pair is found, a row of the join meets ``crowd`` words at most, and no pairs within a group
  are listed.
* **Roots.** Frequencies rise from form to form by the ratio, so chains are short; each round doubles the
  length of the steps.

Tables of the vocabulary are small on disk and large in memory, and grow: they are joined by sorting, never broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.binding import evaluate_once
from changeloom.llm.common import mix, partitions_for, stored

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Sizes of the alphabets that are tried in turn; 0 stands for the letters themselves.
SYMBOLS = (6, 30, 0)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP_ROWS = 4096
# Letters of a word that its many rows carry along.
_SHORT = 40


def with_dropped_letters(word: Column, key: Column, every: int) -> Column:
    """The word less one letter where a hash of key and word is divisible by ``every``: made-up slips of the pen."""
    h = F.crc32(F.concat(key.cast("string"), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % every == 0, cut).otherwise(word)  # a NULL key has no hash


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_letters: int = 5, min_count: int = 3, drop_every: int | None = None
) -> DataFrame:
    """``(word, n)``: runs of letters, ``A-Z`` in lower case, of at least that length and count.

    With ``drop_every`` some words lose a letter first (see ``with_dropped_letters``); those of rows with a
    NULL key lose none. A NULL text has no words.
    """
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    words = docs.select(F.col(key).alias("k"), F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("w"))
    if drop_every:
        words = words.where(F.length("w") >= min_letters)
        words = evaluate_once(words, {"v": with_dropped_letters(F.col("w"), F.col("k"), drop_every)}).select(F.col("v").alias("w"))
    counted = words.where(F.length("w") >= min_letters).groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


class _Reduced:
    """Code points of a step of words, reduced, and the hash sums before and after each place."""

    def __init__(self, words: pa.Array, symbols: int):
        texts = words.to_pylist()
        self.sizes = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
        marks = mix(points + np.uint64(0x51ED270B))
        self.values = marks % np.uint64(symbols) + np.uint64(1) if symbols else points
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def matrices(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length at a time: their numbers and their symbols, a row each."""
        for size in np.unique(self.sizes):
            rows = np.flatnonzero(self.sizes == size)
            yield rows, self.values[self.starts[rows][:, None] + np.arange(size)]


def _powers(n: int) -> np.ndarray:
    row = np.full(n, _BASE, np.uint64)
    row[0] = 1
    return np.multiply.accumulate(row)


def _key(sums: np.ndarray, size: int) -> np.ndarray:
    return mix(sums + np.uint64(size * 0xD1342543DE82EF95 % (1 << 64))).view(np.int64)


def own_keys(words: pa.Array, symbols: int) -> np.ndarray:
    """The key of each word's reduced word. Equal reduced words have equal keys."""
    reduced = _Reduced(words, symbols)
    keys = np.zeros(len(words), np.int64)
    for rows, matrix in reduced.matrices():
        size = matrix.shape[1]
        keys[rows] = _key((matrix * _powers(size + 1)[:size]).sum(1, dtype=np.uint64), size)
    return keys


def edit_keys(words: pa.Array, symbols: int, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of all reduced words within one edit of each word's, each once."""
    reduced = _Reduced(words, symbols)
    found_rows, found_keys = [], []
    for rows, matrix in reduced.matrices():
        n, size = matrix.shape
        power = _powers(size + 2)
        placed = matrix * power[:size]
        before = np.zeros((n, size + 1), np.uint64)
        np.cumsum(placed, 1, out=before[:, 1:])
        after = before[:, -1:] - before
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        parts = [_key(before[:, -1:], size)]
        # Without the symbol at j: what follows moves down one place.
        parts.append(_key(before[:, :-1] + after[:, 1:] * inverse, size - 1))
        other = alphabet[None, None, :]
        replaced = (before[:, -1:] - placed)[:, :, None] + other * power[None, :size, None]
        parts.append(_key(replaced, size).reshape(n, -1))
        inserted = (before + after * _BASE)[:, :, None] + other * power[None, : size + 1, None]
        parts.append(_key(inserted, size + 1).reshape(n, -1))
        keys = np.sort(np.concatenate(parts, 1), 1)
        first = np.ones(keys.shape, bool)
        first[:, 1:] = keys[:, 1:] != keys[:, :-1]
        found_rows.append(np.repeat(rows, first.sum(1)))
        found_keys.append(keys[first])
    if not found_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_rows), np.concatenate(found_keys)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, _STEP_ROWS):
            yield batch.slice(begin, _STEP_ROWS)


def _owns(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[pa.RecordBatch]:
    for step in _steps(batches):
        keys = pa.array(own_keys(step.column("word"), symbols))
        yield pa.RecordBatch.from_arrays([step.column("word"), step.column("n"), keys], names=["word", "n", "key"])


def _edits(batches: Iterator[pa.RecordBatch], symbols: int, letters: tuple[int, ...], carried: str) -> Iterator[pa.RecordBatch]:
    alphabet = np.arange(1, symbols + 1, dtype=np.uint64) if symbols else np.array(letters, np.uint64)
    for step in _steps(batches):
        # Long words have as many variants as letters and symbols, each of fixed size: one step holds few of them.
        sizes = np.array([len(t) for t in step.column("word").to_pylist()], np.int64)
        cells = np.cumsum((2 * sizes + 1) * (len(alphabet) + 1))
        begin = 0
        while begin < step.num_rows:
            spent = cells[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(cells, spent + (1 << 20), "right")))
            part = step.slice(begin, end - begin)
            rows, keys = edit_keys(part.column("word"), symbols, alphabet)
            taken = pa.array(rows)
            columns = [part.column(c).take(taken) for c in (carried, "n", "crowded")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(keys)], names=[carried, "n", "crowded", "key"])
            begin = end


# The letters that a word can have after A-Z went to lower case.
_ALL_LETTERS = tuple([*range(0x61, 0x7B), *range(0xC0, 0x100)])


def near_pairs(words: DataFrame, symbols: tuple[int, ...] = SYMBOLS, crowd: int = 16) -> DataFrame:
    """``(word, near, n_near)``: every ordered pair of near words, with the count of the second.

    ``words`` has each word once, with its count ``n``. Letters are ``a`` to ``z`` and the Latin-1 ones from ``À`` on.
    """
    found, rest = [], words
    for level, size in enumerate(symbols):
        own = rest.mapInArrow(partial(_owns, symbols=size), "word string, n long, key long")
        last = level == len(symbols) - 1
        if last:
            marked = own.withColumn("crowded", F.lit(False))
        else:
            shared = own.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > crowd)
            marked = own.join(shared.select("key", F.lit(True).alias("crowded")).hint("merge"), "key", "left")
            marked = marked.select("word", "n", "key", F.coalesce("crowded", F.lit(False)).alias("crowded"))
        marked = stored(marked, "reduced", free=True)
        quiet = marked.where(~F.col("crowded")).select("key", F.col("word").alias("near"), F.col("n").alias("n_near"))
        edits = partial(_edits, symbols=size, letters=_ALL_LETTERS)
        # A row becomes a hundred: few files must not mean few tasks.
        spread = marked.select("word", "n", "crowded", F.xxhash64("word").alias("id")).repartition(partitions_for(marked))
        short = spread.where(F.length("word") <= _SHORT)
        ways = short.mapInArrow(partial(edits, carried="word"), "word string, n long, crowded boolean, key long")
        # The edit is verified inside the join, so no other pair leaves it.
        near = quiet.where(F.length("near") <= _SHORT + 1).hint("merge")
        pairs = ways.join(near, "key").where(F.levenshtein("word", "near", 1) == 1)
        # Long words are named by a hash in their many rows, and put back into the pairs that are left.
        long = spread.where(F.length("word") > _SHORT)
        ways = long.mapInArrow(partial(edits, carried="id"), "id long, n long, crowded boolean, key long")
        near = quiet.where(F.length("near") >= _SHORT).hint("merge")
        named = ways.join(near, "key").join(long.select("id", "word").hint("merge"), "id")
        # Words of one hash have rows of their own each, so a pair may come twice.
        named = named.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "crowded", "near", "n_near").distinct()
        pairs = pairs.select(named.columns).unionByName(named)
        both = F.when(
            F.col("crowded"),
            F.array(F.struct("word", "near", "n_near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("n_near"))),
        ).otherwise(F.array(F.struct("word", "near", "n_near")))
        found.append(pairs.select(F.inline(both)))
        rest = marked.where("crowded").select("word", "n")
    return reduce(DataFrame.unionByName, found)


def roots_of(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form: the end of each chain of forms. ``forms`` is ``(word, form)`` without NULLs."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots", free=True)
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = links.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        jumped = stored(jumped, "roots", free=True)
        links = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return links


def group_variants(words: DataFrame, ratio: int = 2, symbols: tuple[int, ...] = SYMBOLS, crowd: int = 16) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for each word of a vocabulary ``(word, n)``.

    ``n_near`` counts near words. ``form`` is the near word of largest count (ties: the smallest by code points)
    if that is at least ``ratio`` times the word's, else NULL; ``root`` is where forms lead to, the word itself
    without one. Rows with a NULL word or count take no part; rows that repeat a word are added up. Extra
    columns are not carried. An empty vocabulary gives an empty result.
    """
    words = words.where("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stored(words, "vocabulary", free=True)
    # Strings compare by their UTF-8 bytes, which is the order of their code points.
    best = F.min(F.struct((-F.col("n_near")).alias("less"), "near")).alias("best")
    near = near_pairs(words, symbols, crowd).groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near.hint("merge"), "word", "left")
    leads = -F.col("best.less") >= ratio * F.col("n")
    joined = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n"),
    )
    joined = stored(joined, "forms", free=True)
    roots = roots_of(joined.where("form IS NOT NULL"))
    return joined.join(roots.hint("merge"), "word", "left").select(*joined.columns, F.coalesce("root", "word").alias("root"))
