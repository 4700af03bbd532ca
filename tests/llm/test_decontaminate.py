from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from changeloom.llm import decontaminate as d

WORDS = [a + b for a in ("th", "er", "on", "in", "at", "re") for b in ("a", "ed", "ing", "ly", "or", "is", "st", "ou")]


def edit_distance(item, text):
    """Least edit distance of an item to any passage, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(chance, words, n):
    words = list(words)
    for _ in range(n):
        at = chance.randrange(len(words))
        kind = chance.choice("ids")
        if kind == "i":
            words.insert(at, chance.choice(WORDS))
        elif kind == "d":
            del words[at]
        else:
            words[at] = chance.choice(WORDS)
    return words


def planted(seed=1, documents=120):
    chance = random.Random(seed)
    text = lambda n: [chance.choice(WORDS) for _ in range(n)]
    items = [(i, text(chance.randint(10, 60))) for i in range(25)]
    docs = []
    for k in range(documents):
        words = text(chance.randint(0, 150))
        if k % 2:
            item = items[k % len(items)][1]
            at = chance.randint(0, len(words))
            words[at:at] = edited(chance, item, chance.randint(0, max(1, len(item) // 10)))
        docs.append((k, words))
    return items, docs


def test_recall_against_brute_force(spark):
    items, docs = planted()
    settings = d.Settings()
    expected = {
        (k, i) for k, words in docs for i, item in items if edit_distance(item, words) <= settings.edits(len(item))
    }
    frames = [
        spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{key} long, text string")
        for rows, key in ((docs, "doc_id"), (items, "item_id"))
    ]
    found = d.contaminated_passages(*frames).collect()
    pairs = {(r.k, r.item) for r in found}
    assert pairs <= expected
    assert len(pairs) >= 0.9 * len(expected) > 0
    texts = dict(docs)
    for r in found:
        assert edit_distance(dict(items)[r.item], texts[r.k][r.start : r.end]) == r.distance
    clean = d.without_contaminated(*frames).select("doc_id").collect()
    assert {r.doc_id for r in clean} == {k for k, _ in docs} - {k for k, _ in pairs}


def test_blocks_of_items_find_the_same(spark):
    items, docs = planted(2, 40)
    frames = [
        spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{key} long, text string")
        for rows, key in ((docs, "doc_id"), (items, "item_id"))
    ]
    one = {tuple(r) for r in d.contaminated_passages(*frames).collect()}
    assert {tuple(r) for r in d.contaminated_passages(*frames, settings=d.Settings(block_bytes=1500)).collect()} == one


def test_signs_and_case_are_ignored(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, f"So: {item.upper().replace(' ', ', ')}!"), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.k, r.item, r.start, r.end, r.distance) for r in d.contaminated_passages(docs, items).collect()] == [(1, 7, 1, 11, 0)]


def test_nulls_empties_repeats_and_extra_columns(spark):
    item = "one two three four five six seven eight nine"
    rows = [(1, None, 5), (2, "", 5), (None, item, 5), (4, item, None), (4, item, None), (5, "x " * 30000 + item, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int")
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, "too short")], "item_id long, text string")
    found = sorted((r.k or 0, r.item, r.start) for r in d.contaminated_passages(docs, items).collect())
    assert found == [(0, 1, 0)] * 2 + [(4, 1, 0)] * 4 + [(5, 1, 30000)] * 2
    kept = d.without_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    nothing = docs.limit(0), items.limit(0)
    assert d.contaminated_passages(nothing[0], items).count() == 0
    assert d.contaminated_passages(docs, nothing[1]).count() == 0
    assert d.without_contaminated(docs, nothing[1]).count() == 6


def test_walks_depend_on_words_only():
    words = np.arange(1, 61, dtype=np.uint64)
    both = d._signatures(np.r_[words, words], np.array([0, 60]), np.array([60, 120]), 60, d.Settings())
    assert (both[0] == both[1]).all()
    assert pa.array(both[0]).null_count == 0


def at_the_bound(n, edits, trials=40):
    """Items of ``n`` words, and texts with them after exactly ``edits`` edits."""
    chance = random.Random(n)
    text = lambda n: [f"w{chance.randrange(3000)}" for _ in range(n)]
    items = [(i, text(n)) for i in range(trials)]
    return items, [text(n) + change_exactly(chance, item, edits) + text(n // 2) for _, item in items]


def change_exactly(chance, words, edits):
    """Edits at distinct words, to words that occur nowhere else: the distance is their number."""
    words = [[w] for w in words]
    for at in chance.sample(range(len(words)), edits):
        kind = chance.choice("ids")
        words[at] = {"i": [f"new{at}", *words[at]], "d": [], "s": [f"new{at}"]}[kind]
    return [w for group in words for w in group]


def share_found(n, edits, trials=40):
    items, texts = at_the_bound(n, edits, trials)
    index = d.build_index([(i, " ".join(w)) for i, w in items], d.Settings())
    found = {(row, item) for row, item, *_ in d._found(pa.array([" ".join(t) for t in texts]), index, d.Settings())}
    assert all(a == b for a, b in found)
    return len(found) / len(items)


def test_a_fifth_of_the_words_may_be_edited():
    settings = d.Settings()
    assert [settings.edits(n) for n in (8, 15, 40, 59)] == [1, 3, 8, 11]
    assert all(share_found(n, n // 5) >= 0.9 for n in (8, 15, 40))


def test_recall_at_the_full_bound_does_not_fall_with_length():
    for n, trials in ((8, 40), (15, 40), (60, 40), (200, 20), (400, 10)):
        assert share_found(n, d.Settings().edits(n), trials) >= 0.95, n


def test_items_of_few_words_are_met_exactly(spark):
    docs = spark.createDataFrame([(1, "so too short, indeed"), (2, "too long"), (3, "short"), (4, "Too Short"), (5, "a b c d e f g"), (6, "a b c x e f g")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "too short"), (2, "a b c d e f g"), (3, "!"), (4, "short")], "item_id long, text string")
    found = sorted(tuple(r) for r in d.contaminated_passages(docs, items).collect())
    assert found == [(1, 1, 1, 3, 0), (1, 4, 2, 3, 0), (3, 4, 0, 1, 0), (4, 1, 0, 2, 0), (4, 4, 1, 2, 0), (5, 2, 0, 7, 0)]


def test_every_copy_of_an_item_is_a_passage():
    item = [f"w{i}" for i in range(20)]
    near = [*item[:5], "new", *item[6:]]
    index = d.build_index([(7, " ".join(item)), (8, "w0 w1"), (9, "a " * 8)], d.Settings())

    def found(*parts):
        text = pa.array(["before " * 3 + " ".join(w for p in parts for w in p) + " after"])
        return [(i, s - 3, e - 3, x) for _, i, s, e, x in d._found(text, index, d.Settings()) if i != 8]

    assert found(*[item] * 50) == [(7, 20 * i, 20 * i + 20, 0) for i in range(50)]
    assert found(item, near, near, item) == [(7, 0, 20, 0), (7, 20, 40, 1), (7, 40, 60, 1), (7, 60, 80, 0)]
    assert found(item, item[1:], item) == [(7, 0, 20, 0), (7, 20, 39, 1), (7, 39, 59, 0)]
    assert [x[1] for x in found(["a"] * 32)] == [0, 8, 16, 24]
    twice = list(d._found(pa.array(["w0 w1 w0 w1 w1 w0 w1"]), index, d.Settings()))
    assert [x[2:] for x in twice] == [(0, 2, 0), (2, 4, 0), (5, 7, 0)]


def test_passages_do_not_overlap_and_leave_none():
    chance = random.Random(9)
    for _ in range(300):
        item = np.array([chance.randrange(4) for _ in range(10)])
        words = np.array([chance.randrange(4) for _ in range(chance.randint(0, 60))], int)
        taken = d.passages(item, words, 2)
        edges = [0, *(x for _, s, e in taken for x in (s, e)), len(words)]
        assert edges == sorted(edges)
        assert all(edit_distance(item, words[s:e]) == x <= 2 for x, s, e in taken)
        assert all(edit_distance(item, words[a:b]) > 2 for a, b in zip(edges[::2], edges[1::2], strict=True))


def test_a_step_holds_two_megabytes_of_text(monkeypatch):
    """A worker's arrays take many times the texts of a step."""
    import pyarrow as pa

    from changeloom.llm import decontaminate

    seen = []
    monkeypatch.setattr(decontaminate, "_found", lambda column, *_: seen.append(sum(map(len, column.to_pylist()))) or [])
    batch = pa.record_batch({"k": list(range(40)), "t": ["word " * 20000] * 40})
    assert list(decontaminate._matches(iter([batch]), None, decontaminate.Settings())) == []
    assert sum(seen) == 4_000_000 and max(seen) <= 2 << 20
