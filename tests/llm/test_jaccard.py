from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from changeloom.llm import jaccard as j
from changeloom.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def brute(rows):
    """Component by key, comparing all pairs."""
    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    parent = {k: k for k, _ in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for x, (a, s) in enumerate(sets):
        for b, t in sets[x + 1 :]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {k: root(k) for k in parent}


def corpus(seed, documents=160):
    """Copies with few and many edits, shared passages, short texts."""
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: [chance.choice(words) for _ in range(n)]
    bases, passage, rows = [text(chance.choice([3, 5, 6, 9, 14, 40, 200])) for _ in range(12)], text(30), []
    for k in range(documents):
        kind = chance.random()
        if kind < 0.6:
            own = list(chance.choice(bases))
            for _ in range(chance.randint(0, max(1, len(own) // 20))):
                own[chance.randrange(len(own))] = chance.choice(words)
        else:
            own = text(chance.choice([1, 2, 4, 8, 30, 60]))
            if kind > 0.8:
                at = chance.randint(0, len(own))
                own[at:at] = passage
        rows.append((k, " ".join(own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_agree_with_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = j.near_duplicates(docs).collect()
    assert {r.k: r.component_id for r in found} == brute(rows)
    assert {r.k: r.n_shingles for r in found} == {k: len(shingles(t)) for k, t in rows}


def test_no_linked_pair_lacks_a_common_signature():
    """Pairs at the very threshold, of many sizes, with hot signatures skipped by frequency."""
    chance, rule = random.Random(5), j.Rule()
    for _ in range(400):
        n = chance.randint(1, 120)
        a = {chance.getrandbits(60) for _ in range(n)}
        b, low = set(a), -(-80 * n // 100)
        while 100 * len(a & b) >= 80 * len(a | b):
            good = set(b)
            b.discard(chance.choice(sorted(b))) if chance.random() < 0.5 and len(b) > low else b.add(chance.getrandbits(60))
            if not b:
                break
        sets = [np.array(sorted(s), np.uint64) for s in (a, good)]
        owner = np.repeat([0, 1], [len(s) for s in sets])
        sizes = np.array([len(s) for s in sets])
        found = {}
        for signature, of, tag, budget in j._signatures(np.concatenate(sets), owner, sizes, rule):
            for s, o, t, left in zip(signature.tolist(), of.tolist(), tag.tolist(), budget.tolist(), strict=True):
                found.setdefault((t, o), (left, set()))[1].add(s)
        # Every signature is hot; the order by frequency is the order of the hashes.
        kept = {key: set(sorted(names)[max(left, 0) :]) for key, (left, names) in found.items()}
        assert any(kept[t, 0] & kept.get((t, 1), set()) for t, o in kept if o == 0)


def test_hot_groups_and_a_shared_passage(spark):
    chance = random.Random(9)
    words = [f"x{i}" for i in range(5000)]
    base, passage = [chance.choice(words) for _ in range(150)], [chance.choice(words) for _ in range(60)]
    rows = []
    for k in range(60):
        own = list(base)
        own[k] = "edit"
        rows.append((k, " ".join(own)))
    for k in range(60, 140):
        rows.append((k, " ".join([chance.choice(words) for _ in range(90)] + passage)))
    rows += [(k, " ".join(base)) for k in range(200, 240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.k: r.component_id for r in j.near_duplicates(docs).collect()} == brute(rows)


def test_nulls_empties_repeats_and_extra_columns(spark):
    long = " ".join(f"w{i}" for i in range(40000))
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "one two", 7), (5, "ONE\ttwo", 8), (None, "one two", 9),
            (6, long, 0), (7, long + " end", 0), (7, long + " end", 0), (8, "one two three", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int")
    found = sorted((r.k or 0, r.n_shingles, r.component_id) for r in j.near_duplicates(docs).collect())
    assert found == [(0, 1, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 39996, 6), (7, 39997, 6), (7, 39997, 6), (8, 1, 8)]
    assert j.near_duplicates(docs.limit(0)).count() == 0


def test_chains_and_hubs_are_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)]
    found = {r.c: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 140), 100)}


def test_shingle_sets_of_a_step():
    texts = [None, "a b c d e f", "A b  c d\te f", "a b", "a b c d e f a b c d e f"]
    _, owner, sizes = j.shingle_sets(pa.array(texts, pa.string()), 5)
    assert sizes.tolist() == [len(shingles(t)) for t in texts] and (np.diff(owner) >= 0).all()


def test_a_passage_of_many_documents_hides_no_link(spark):
    """All documents share 46 words, so all their kept signatures are hot; a few pairs are alike beyond that."""
    chance = random.Random(9)
    passage = [f"p{i}" for i in range(46)]
    rows = []
    for i in range(80):
        own = [f"o{i}_{n}" for n in range(12)]
        words = own[:6] + passage + own[6:]
        rows.append((i, " ".join(words)))
        if i % 8 == 0:
            words[chance.choice([1, 3, -2])] = "edited"
            rows.append((1000 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.k: r.component_id for r in j.near_duplicates(docs).collect()}
    assert found == brute(rows) and len(set(found.values())) == 80


def test_pairs_of_a_group_of_near_copies_grow_with_its_size(spark, monkeypatch):
    """Near copies of one text, with a passage that others have too, so that their first pairs do not join them."""
    chance = random.Random(3)
    words = [f"x{i}" for i in range(5000)]
    text = lambda n: [chance.choice(words) for _ in range(n)]
    base, passage, size, rows = text(160), text(60), 120, []
    for k in range(size):
        own = list(base)
        for edit in range(1 + k % 3):
            own[chance.randrange(160)] = f"e{k}_{edit}"
        rows.append((k, " ".join(own + passage)))
    rows += [(1000 + k, " ".join(text(160) + passage)) for k in range(400)]
    links, compared = j._links, []

    def counted(pairs, *others):
        compared.append(pairs.count())
        return links(pairs, *others)

    monkeypatch.setattr(j, "_links", counted)
    found = {r.k: r.component_id for r in j.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows) and set(found.values()) == {0, *range(1000, 1400)}
    # The first of these are one pair per class; all pairs of the group are 7,140.
    assert sum(compared[1:]) <= 5 * size
