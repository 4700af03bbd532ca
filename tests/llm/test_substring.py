from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from changeloom.llm.substring import SuffixTree, _with_words, remove_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=50):
    words = {k: WORD.findall(t or "") for k, t in rows}
    first = {}
    for k in sorted(words):
        for i in range(len(words[k]) - window + 1):
            first.setdefault(tuple(words[k][i : i + window]), k)
    result = {}
    for k, own in words.items():
        gone = set()
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < k:
                gone |= set(range(i, i + window))
        result[k] = (len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone))
    return result


def corpus(seed):
    chance = random.Random(seed)
    text = lambda n: [chance.choice("abcdefgh") + str(chance.randint(0, 9)) for _ in range(n)]
    passages = [text(n) for n in (50, 51, 60, 120, 49)]
    rows = []
    for k in chance.sample(range(1000), 120):
        own = text(chance.randint(0, 120))
        for _ in range(chance.randint(0, 3)):
            at = chance.randint(0, len(own))
            own[at:at] = chance.choice(passages)
        rows.append((k, chance.choice([" ", "\n", " \t"]).join(own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.k: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(docs).collect()}
    assert found == brute(rows)


def test_other_windows(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window, gram in ((10, 10), (12, 3), (7, 1)):
        found = {r.k: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(docs, window=window, gram=gram).collect()}
        assert found == brute(rows, window)
    with pytest.raises(ValueError):
        remove_repeats(docs, window=5, gram=6)


def test_shared_template_lengthens_prefixes(spark):
    chance = random.Random(4)
    template = [f"t{i}" for i in range(30)]
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for k in range(60):
        own = [f"w{chance.randint(0, 500)}" for _ in range(chance.randint(20, 90))]
        own[10:10] = template
        if k % 4 == 0:
            own[12:12] = passage
        if k % 5 == 0:
            own += ["again"] * 130
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    for most in (1, 5, 1000):
        found = {r.k: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(docs, most=most).collect()}
        assert found == brute(rows)


def test_texts_of_one_key_are_told_apart(spark):
    first, second = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, first), (2, second), (2, first), (3, second)]
    found = sorted((r.k, r.n_removed) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(1, 0), (2, 0), (2, 60), (3, 60)]


@pytest.mark.parametrize("seed", range(4))
def test_suffix_tree_agrees_with_brute_force(seed):
    chance = random.Random(seed)
    texts = [[chance.randint(0, 2) for _ in range(chance.randint(1, 40))] for _ in range(12)]
    texts += [[7] * 25, texts[0], texts[1] + texts[2]]
    words = np.array([w for t in texts for w in t], np.uint64)
    tree = SuffixTree(words, np.array([len(t) for t in texts]), 3)
    suffixes = [t[i:] for t in texts for i in range(len(t))]
    in_order = [suffixes[i] for i in tree.order]
    assert in_order == sorted(s for s in suffixes if len(s) >= 3)
    for a, b, n in zip(in_order, in_order[1:], tree.common, strict=False):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])
    for depth in (3, 5, 8, 20):
        begin, size = tree.nodes(depth)
        found = sorted(tuple(sorted(tree.order[b : b + n].tolist())) for b, n in zip(begin, size, strict=True) if n > 1)
        alike = {}
        for i, s in enumerate(suffixes):
            if len(s) >= depth:
                alike.setdefault(tuple(s[:depth]), []).append(i)
        assert found == sorted(tuple(x) for x in alike.values() if len(x) > 1)


def test_words_of_runs_in_slices_of_a_batch():
    run = pa.list_(pa.struct([("p", pa.int64()), ("s", pa.int32()), ("n", pa.int32())]))
    rows = [[{"p": 1, "s": 0, "n": 1}], [{"p": 2, "s": 1, "n": 2}, {"p": 3, "s": 0, "n": 1}], [{"p": 4, "s": 2, "n": 1}]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8, 9]), pa.array([0, 0, 1]), pa.array(["a b c d", "e  f g h", "i j k l"]), pa.array(rows, run)], names=["k", "h", "t", "runs"]
    )
    found = [tuple(r.values()) for b in _with_words(iter([batch.slice(1)]), 2) for r in b.to_pylist()]
    assert found == [(2, 8, 0, 1, "f g h"), (3, 8, 0, 0, "e  f"), (4, 9, 1, 2, "k l")]


def test_nulls_empties_repeats_and_extra_columns(spark):
    long = " ".join(str(i) for i in range(60000))
    rows = [(1, None, "x"), (2, "", "x"), (None, long, None), (4, long, "y"), (4, long, "y"), (5, f"head {long}  tail", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string")
    found = sorted((r.k or 0, r.n_words, r.n_removed, r.kept[:9]) for r in remove_repeats(docs).collect())
    assert found == [
        (0, 60000, 0, "0 1 2 3 4"), (1, 0, 0, ""), (2, 0, 0, ""), (4, 60000, 0, "0 1 2 3 4"), (4, 60000, 0, "0 1 2 3 4"),
        (5, 60002, 60000, "head tail"),
    ]
    assert remove_repeats(docs.limit(0)).count() == 0
