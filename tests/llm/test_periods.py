"""Periodic runs against all stretches of all periods."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry_point
from changeloom.llm.periods import find_runs, periodic_runs, stretches, window_minimum
from tests.harness import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Longest stretches of each period from one on; a stretch's first period is its smallest."""
    seen, runs = set(), []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                runs.append((i, j + q - i, q))
            i = j
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_text(draw):
    """Random words with powers of random words, of powers too, and near misses."""
    words = []
    for _ in range(draw.randint(0, 6)):
        unit = [draw.choice("abcd") for _ in range(draw.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 40]))]
        if draw.random() < 0.4:
            unit = unit * draw.randint(2, 5) + [draw.choice("abx")]
        words += (unit * draw.randint(1, 9))[: draw.randint(1, 300)]
        words += [draw.choice("abcdef") for _ in range(draw.randint(0, 9))]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_agree_with_all_stretches(seed):
    draw = random.Random(seed)
    texts = [periodic_text(draw) for _ in range(8)]
    codes = np.array([ord(w) for t in texts for w in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    start, end, period = find_runs(codes, np.array([len(t) for t in texts], np.int64))
    found, begin = [], 0
    for text in texts:
        mine = (start >= begin) & (start < begin + len(text))
        found.append([(int(s) - begin, int(e - s), int(p)) for s, e, p in zip(start[mine], end[mine], period[mine])])
        begin += len(text)
    assert found == [brute_runs(t) for t in texts]


def test_a_word_of_two_letters_that_polynomial_hashes_confuse():
    """Thue-Morse words have no runs but collide in sums modulo a power of two."""
    bits = np.array([bin(i).count("1") & 1 for i in range(1 << 13)], np.uint64) + np.uint64(7)
    start, _, _ = find_runs(bits, np.array([len(bits)]))
    assert not len(start)
    twice = np.r_[bits, bits, bits, bits, bits]
    start, end, period = find_runs(twice, np.array([len(twice)]))
    assert (0, len(twice), 1 << 13) in list(zip(start.tolist(), end.tolist(), period.tolist()))


def test_windows_and_stretches():
    values = np.array([5, 3, 9, 1, 7, 7, 2], np.uint64)
    for width in range(1, 8):
        assert window_minimum(values, width).tolist() == [min(values[i : i + width]) for i in range(8 - width)]
    start, end = stretches(np.array([1, 2, 1, 2, 1, 2, 1, 2, 3]), 2, 4)
    assert (start.tolist(), end.tolist()) == ([0], [8])
    with pytest.raises(ValueError):
        find_runs(values, np.array([7]), repeats=3)


def test_nulls_empties_repeats_and_long_texts(spark, rows):
    long = " ".join(["x"] + ["p", "q", "r"] * 50_000 + ["y"])
    data = [(1, None, "a"), (2, "", "a"), (2, " \n\t", "a"), (None, "ja " * 6, "b"), (4, "ja " * 5, "b"), (4, "ja " * 5, "b"),
            (5, long, "c"), (6, "ä\n" * 7 + "end", "k"), (7, "one", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, k string")
    found = sorted(((r.k, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()), key=str)
    expected = [(None, 6, [(0, 6, 1)], "ja"), (1, 0, [], ""), (2, 0, [], ""), (2, 0, [], ""), (4, 5, [], " ".join(["ja"] * 5)),
                (4, 5, [], " ".join(["ja"] * 5)), (5, 150_002, [(1, 150_000, 3)], "x p q r y"), (6, 8, [(0, 7, 1)], "ä end"), (7, 1, [], "one")]
    assert found == sorted(expected, key=str)
    assert periodic_runs(docs.limit(0)).collect() == []


def test_query_agrees_with_all_stretches(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for row in docs:
        words = planted(row.doc_id, WORD.findall(row.text or ""))
        if len(words) > 1500:
            continue  # the plain version takes the square of the length
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        expected[row.doc_id] = (
            len(runs), *best, math.floor(1000 * best[1] / best[2]) if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        )
    result = entry_point.queries()["op13_periodic_runs"](spark, SF_DIR)
    found = {r[0]: tuple(r[1:]) for r in result.collect()}
    assert len(found) == len(docs) and sum(n > 0 for n, *_ in expected.values()) > 50
    assert {k: found[k] for k in expected} == expected
