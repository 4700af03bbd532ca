"""Change capture by digests of key ranges.

Where two versions of a table differ little, most of the work of comparing them is moving rows that are equal. A digest
of each range of key hashes, a sum over its rows that does not depend on their order, tells which ranges
differ. It is made where the rows lie: what is shuffled is a few numbers per task. A second, finer digest is made of the
differing ranges only, and rows are compared, and shuffled, in the fine ranges that still differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.operators.capture import capture_diff


def _whole_row(df: DataFrame, names: list[str]) -> list[Column]:
    """The row's columns in a form that can be hashed: maps count by their entries, in order of the keys."""
    values = []
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.MapType):
            values.append(F.array_sort(F.map_entries(name)))
        elif isinstance(kind, T.VariantType):
            values.append(F.to_json(F.col(name)))
        else:
            values.append(F.col(name))
    return values


def _hashed(df: DataFrame, keys: list[str], names: list[str], coarse: int, fine: int) -> DataFrame:
    place = F.pmod(F.xxhash64(*keys), F.lit(coarse * fine))
    row = _whole_row(df, names)
    hashes = {"_h": F.xxhash64(F.lit(1), *row), "_g": F.xxhash64(F.lit(2), *row)}
    return df.withColumns({"_range": (place / fine).cast("int"), "_place": place, **hashes})


def _sums() -> list[Column]:
    """Sums of halves of hashes: they stay within a long for two billion rows of a range."""
    low = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))
    parts = {"h0": low("_h"), "h1": F.shiftrightunsigned("_h", 32), "g0": low("_g"), "g1": F.shiftrightunsigned("_g", 32)}
    return [F.sum(value).alias(name) for name, value in parts.items()]


def digests(df: DataFrame, keys: list[str], coarse: int, fine: int, by: str = "_range", within: list[int] | None = None) -> DataFrame:
    """``(range, n, h0, h1, g0, g1)``: count and order-free sums of row hashes, per range of key hashes that has rows.

    ``by`` is ``_range`` for the coarse ranges and ``_place`` for the fine ones, which may be limited to those
    ``within`` some coarse ones.
    """
    rows = _hashed(df, keys, df.columns, coarse, fine)
    if within is not None:
        rows = rows.where(F.col("_range").isin(within))
    return rows.groupBy(F.col(by).alias("range")).agg(F.count("*").alias("n"), *_sums())


def _differing(old: DataFrame, new: DataFrame) -> list[int]:
    """Ranges whose digests are not the same. Digest tables have a row per range at most, whatever the tables hold."""
    both = old.unionByName(new).groupBy(*old.columns).count().where("count = 1")
    return sorted(row[0] for row in both.select("range").distinct().collect())


def differing_rows(
    old: DataFrame, new: DataFrame, keys: list[str], coarse: int = 1024, fine: int = 64, old_digests: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of both versions in fine key ranges that differ: no change of a key lies outside them.

    ``old_digests`` are the coarse ones of the old version, if they were kept when it was written; it is then read in the
    differing ranges only, and only when there are any.
    """
    new = new.select(*old.columns)
    ranges = _differing(old_digests if old_digests is not None else digests(old, keys, coarse, fine), digests(new, keys, coarse, fine))
    places = []
    if ranges:
        places = _differing(*[digests(df, keys, coarse, fine, "_place", ranges) for df in (old, new)])
    place = F.pmod(F.xxhash64(*keys), F.lit(coarse * fine))
    # Ids of ranges are compared in the scan, so that rows of other ranges are not shuffled.
    return old.where(place.isin(places)), new.where(place.isin(places))


def capture_by_digest(
    old: DataFrame, new: DataFrame, keys: list[str], columns: list[str] | None = None, copy_number: str | None = None,
    coarse: int = 1024, fine: int = 64, old_digests: DataFrame | None = None,
) -> DataFrame:
    """The same changes as ``capture_diff``, for versions that differ in few keys.

    Rows are read twice or three times and shuffled in proportion to the changes. A hash of 128 bits and a count stand for
    the rows of a range: versions that differ and agree in them are taken for equal.
    """
    if sorted(new.columns) != sorted(old.columns):
        raise ValueError("the two versions have different columns")
    return capture_diff(*differing_rows(old, new, keys, coarse, fine, old_digests), keys, columns, copy_number)
