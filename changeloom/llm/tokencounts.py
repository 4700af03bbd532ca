"""Token counts by field and section from one encoding of the whole document (operator 10).

The fields of a row are joined by a separator and encoded once, so tokens are those a model would see. Each
token's place in the bytes follows from the lengths of the tokens before it. Sections are the lines of every
field. Sections and tokens are both sorted and disjoint, so their interval join is a merge: a binary search
gives the first and last section that each token touches.

A token within one section counts there. One that crosses a boundary (into another section, a separator
or a line feed) is allocated as a whole by the rule:

* ``majority``: to the section with most of its bytes, the earlier one when equal;
* ``first``: to the first section it touches.

Tokens that touch no section (separators, line feeds, empty lines) count for none.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import steps

# Fixed value: how byte-level BPE of this vocabulary splits a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("majority", "first")
COUNTS = "k long, field int, section int, start long, end long, n_tokens long, n_crossing long"


def read_ranks(path: str) -> bytes:
    """A tiktoken vocabulary file, read on the driver and sent to the tasks with their code."""
    return Path(path).read_bytes()


def _encoder(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, ranks.splitlines() if ranks else [])}
    lengths = np.zeros(max(table.values()) + 1, np.int64)
    lengths[list(table.values())] = [len(word) for word in table]
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}), lengths


def sections_of(fields: list[bytes], separator: bytes) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
    """Field and number of each line, and where it begins and ends in the joined bytes."""
    field, number, starts, ends, at = [], [], [], [], 0
    for i, content in enumerate(fields):
        for j, line in enumerate(content.split(b"\n")):
            field.append(i)
            number.append(j)
            starts.append(at)
            ends.append(at + len(line))
            at += len(line) + 1
        at += len(separator) - 1
    return field, number, np.array(starts), np.array(ends)


def allocate(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For tokens of the given lengths, laid one after another: tokens and crossing tokens of each section."""
    stop = np.cumsum(tokens)
    begin = stop - tokens
    filled = np.flatnonzero(ends > starts)
    if not len(filled) or not len(tokens):
        return np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    s, e = starts[filled], ends[filled]
    first, last = np.searchsorted(e, begin, "right"), np.searchsorted(s, stop, "left") - 1
    touches = first <= last
    begin, stop, first, last = begin[touches], stop[touches], first[touches], last[touches]
    chosen = first.copy()
    if rule == "majority":
        for i in np.flatnonzero(first < last):
            span = slice(first[i], last[i] + 1)
            chosen[i] = first[i] + np.argmax(np.minimum(e[span], stop[i]) - np.maximum(s[span], begin[i]))
    crossing = (begin < s[first]) | (stop > e[first])
    counts, crossed = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    counts[filled] = np.bincount(chosen, minlength=len(filled))
    crossed[filled] = np.bincount(chosen[crossing], minlength=len(filled))
    return counts, crossed


def _counts(batches: Iterator[pa.RecordBatch], ranks: bytes, fields: int, separator: bytes, rule: str) -> Iterator[pa.RecordBatch]:
    encoding, lengths = _encoder(ranks)
    for step in steps(batches, f"f{fields - 1}"):
        keys, out = step.column("k").to_pylist(), [[] for _ in range(7)]
        contents = [step.column(f"f{i}").to_pylist() for i in range(fields)]
        for key, *texts in zip(keys, *contents, strict=True):
            parts = [text.encode() for text in texts]
            joined = separator.join(parts)
            field, number, starts, ends = sections_of(parts, separator)
            tokens = lengths[encoding.encode_to_numpy(joined.decode(), disallowed_special=()).astype(np.int64)]
            counts, crossed = allocate(tokens, starts, ends, rule)
            points = np.zeros(len(joined) + 1, np.int64)
            np.cumsum((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80, out=points[1:])
            columns = [[key] * len(field), field, number, points[starts], points[ends], counts, crossed]
            for into, column in zip(out, columns, strict=True):
                into.append(column)
        arrays = [pa.array([x for part in out[0] for x in part], pa.int64())]
        for column, kind in zip(out[1:], [np.int32] * 2 + [np.int64] * 4, strict=True):
            arrays.append(pa.array(np.concatenate(column).astype(kind)))
        yield pa.RecordBatch.from_arrays(arrays, names=["k", "field", "section", "start", "end", "n_tokens", "n_crossing"])


def attribute_tokens(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", fields: tuple[str, ...] = ("text",),
    separator: str = "\n\n", rule: str = "majority",
) -> DataFrame:
    """A row per document, field and line: ``(k, field, section, start, end, n_tokens, n_crossing)``.

    ``field`` and ``section`` count from 0; ``start`` and ``end`` are code points in the joined fields. A NULL field
    is an empty one, and an empty field is one empty line without tokens. NULL keys are kept; repeated rows
    repeat their counts; an empty table gives an empty result. The separator must be UTF-8 text and
    ``vocabulary`` a file in tiktoken's format.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    source = docs.select(
        F.col(key).cast("long").alias("k"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}") for i, f in enumerate(fields)]
    )
    count = partial(_counts, ranks=read_ranks(vocabulary), fields=len(fields), separator=separator.encode(), rule=rule)
    return source.mapInArrow(count, COUNTS)
