"""What the training-data operators share: reading columns, written tables, word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.sources.scratch import new_folder

# A word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that a task turns into arrays at a time; one longer text is a step of its own.
STEP_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# For comparing words alone: letters A-Z in lower case, ASCII signs as spaces, other bytes unchanged.
_FOLDED = np.array([b if b > 127 or chr(b).isalnum() else 32 for b in _LOWER], np.uint8)
_TABLE = np.random.Generator(np.random.PCG64(20240611)).integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 5
_WORD_BASE = 0xD1342543DE82EF95


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark's setting by which the shuffle files of a query go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str, free: bool = False) -> DataFrame:
    """The rows, written to the shared folder and read back: the lineage ends here.

    With ``free`` the shuffle files that led to them go at once; nothing needs them any more.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, purpose)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    if free:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def keyed_rows(df: DataFrame, key: str) -> DataFrame:
    """``k`` and ``row`` (all columns as one value), so that no name can clash."""
    return df.select(F.col(key).cast("long").alias("k"), F.struct("*").alias("row"))


def id_and_text(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("k"), F.coalesce(text, F.lit("")).alias("t"))


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def steps(batches: Iterator[pa.RecordBatch], text: str = "t", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        ends, begin = np.cumsum(sizes), 0
        while begin < len(sizes):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins and ends."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    marks = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[marks[0] : marks[-1]], marks - marks[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, as far as they were needed."""

    def __init__(self, base: int):
        self.bases = (base, pow(base, -1, 1 << 64))
        self.known = np.zeros((2, 0), np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if self.known.shape[1] < n:
            size = max(n, 1 << 16)
            rows = []
            for base in self.bases:
                row = np.full(size, base, np.uint64)
                row[0] = 1
                rows.append(np.multiply.accumulate(row))
            self.known = np.stack(rows)
        return self.known[:, :n]


_POWERS: dict[int, _Powers] = {}


def _rolling(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of value * base^position, with a zero in front, and the inverse powers."""
    powers = _POWERS.setdefault(base, _Powers(base)).upto(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[0, : len(values)], out=sums[1:])
    return sums, powers[1]


class Words:
    """The words of a step of texts: places in the bytes, owners, and 64-bit hashes.

    ``starts`` and ``ends`` are byte places in ``raw``; ``first`` says for each text which word is
    its first one (one more entry at the end).
    """

    def __init__(self, column: pa.Array, lower: bool = False, fold: bool = False):
        raw, self.marks = text_bytes(column)
        self.raw = raw = _FOLDED[raw] if fold else _LOWER[raw] if lower else raw
        solid = np.zeros(len(raw) + 2, bool)
        solid[1:-1] = ~_SPACE[raw]
        # A text's first byte begins a word even if the text before it ended with one.
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.marks] = True
        begins = solid[1:] & (~solid[:-1] | edge)
        finishes = solid[:-1] & (~solid[1:] | edge)
        self.starts, self.ends = np.flatnonzero(begins[:-1]), np.flatnonzero(finishes)
        self.first = np.searchsorted(self.starts, self.marks)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        sums, inverse = _rolling(_TABLE[self.raw], _BASE)
        size = (self.ends - self.starts).astype(np.uint64)
        return mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + size)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of the words of each span."""
    sums, inverse = _rolling(words, _WORD_BASE)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each place on; the last ``n - 1`` places have none."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    sums, inverse = _rolling(words, _WORD_BASE)
    return mix((sums[n:] - sums[:-n]) * inverse[: len(words) - n + 1] + np.uint64(n))


def partitions_for(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
