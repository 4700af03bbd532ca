"""Operators that are DataFrame functions only: lines, host rules, personal data, preferences."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from changeloom.llm import hostrules, lines, pii, preferences

WORD = re.compile("[^\x20\x09-\x0d]+")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups")


# Lines

def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def brute_lines(rows, least):
    seen, result = [], {}
    for k, text in sorted(rows):
        gone, own = [], text.split("\n")
        for p, line in enumerate(own):
            words = WORD.findall(line)
            if words and any(
                w == words or (min(len(w), len(words)) >= least and abs(len(w) - len(words)) < 2 and word_distance(w, words) <= 1) for w in seen
            ):
                gone.append(p)
            if words:
                seen.append(words)
        result[k] = (gone, "\n".join(x for p, x in enumerate(own) if p not in gone))
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_agree_with_all_pairs(spark, seed):
    chance = random.Random(seed)
    bases = [[chance.choice("abc") for _ in range(chance.choice([0, 1, 4, 5, 6, 7, 9, 12]))] for _ in range(10)]
    rows = []
    for k in range(40):
        own = []
        for _ in range(chance.randint(0, 5)):
            line = list(chance.choice(bases))
            for _ in range(chance.choice([0, 1, 1, 2])):
                at = chance.randint(0, len(line))
                line[at : at + chance.randint(0, 1)] = chance.choice([[], ["a"], ["z"]])
            own.append(chance.choice([" ", "\t"]).join(line))
        rows.append((k, "\n".join(own)))
    found = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=5)
    assert {r.k: (r.removed, r.kept) for r in found.collect()} == brute_lines(rows, 5)
    assert not any(name in found._jdf.queryExecution().executedPlan().toString() for name in PYTHON)


def test_lines_of_nulls_empties_repeats_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    rows = [(1, None, "x"), (2, "", "x"), (3, "a b\n\n\na b", "x"), (3, "a b\n\n\na b", "x"), (None, "a b", "x"), (4, long, None), (5, long + " end", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string")
    found = sorted((r.k or 0, r.n_lines, r.n_removed, (r.kept or "-")[:8]) for r in lines.dedup_lines(docs).collect())
    assert found == [(0, 1, 0, "a b"), (1, 0, 0, "-"), (2, 1, 0, "-"), (3, 4, 1, "a b\n\n"), (3, 4, 1, "a b\n\n"), (4, 1, 0, "w0 w1 w2"), (5, 1, 1, "-")]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


# Host rules

def test_measures_of_odd_texts(spark):
    long = "a b c " * 30000
    rows = [(1, None, "h"), (2, "", "h"), (3, "\v a#b | é\n a#b | é\n\n", None), (None, "x", "h"), (4, long, "h"), (4, long, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_words", F.lit(1))
    found = sorted((r.k or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in hostrules.judge(docs).collect())
    assert found == [
        (0, 1, 1, 0, 0, 0, True, False), (1, 0, 0, 0, 0, 0, True, False), (2, 0, 0, 0, 0, 0, True, False),
        (3, 6, 10, 4, 0, 6, True, False), (4, 90000, 90000, 0, 0, 90000, True, False), (4, 90000, 90000, 0, 0, 90000, True, False),
    ]
    assert hostrules.judge(docs.limit(0)).count() == 0


def test_a_bad_host_takes_its_documents_along_and_a_small_one_does_not(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good, f"good{i % 10}") for i in range(400)]
    rows += [(1000 + i, good if i % 10 == 0 else "short", "bad") for i in range(100)]
    rows += [(2000, "short", "one"), (2001, good, "one")]
    found = hostrules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r.k for r in found.where("kept").collect()}
    assert kept == set(range(400)) | {2001}
    assert not any(name in found._jdf.queryExecution().executedPlan().toString() for name in PYTHON)


# Personal data

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_spans(text):
    found = [(0, "email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((1, "ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, "card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((3, "phone", *m.span()))
    return ",".join(f"{kind}:{s}:{e}" for _, kind, s, e in sorted(found))


def test_base_spans_agree_with_the_patterns(spark):
    chance = random.Random(3)
    parts = ["a@b.co", "x_1@y-z.a.b", "@", ".", "4012888888881881", "4012 8888 8888 1881", "+1 (234) 567-8900", "1.2.3.4", "256.1.1.1", "é", "\U0001f600", " ", "-", "9", "++", "￿"]
    rows = [(i, "".join(chance.choice(parts) for _ in range(chance.randint(0, 12)))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.k: r.base for r in pii.personal_spans(docs).select("k", pii.as_text(F.col("base")).alias("base")).collect()}
    assert found == {k: brute_spans(t) for k, t in rows}


def test_ip_parts_may_be_or_begin_with_zeros(spark):
    good = ["10.0.0.1", "192.168.0.1", "255.255.255.0", "0.0.0.0", "00.1.2.3", "000.0255.00.09", "0" * 4000 + ".0.0.0"]
    bad = ["0.0.0.256", "0256.1.1.1", "0.0.0", "1.00999.0.0", "0" * 4000 + "256.0.0.0"]
    chance = random.Random(5)
    parts = ["0", "00", "000", "1", "01", "9", "25", "255", "0255", "256", "0256", "300", "1000"]
    rows = list(enumerate(good + bad + [".".join(chance.choice(parts) for _ in range(chance.randint(3, 6))) for _ in range(500)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.k: (r.n_ip, r.base) for r in pii.personal_spans(docs).select("k", "n_ip", pii.as_text(F.col("base")).alias("base")).collect()}
    assert {k: base for k, (_, base) in found.items()} == {k: brute_spans(t) for k, t in rows}
    assert [found[k][0] for k in range(len(good) + len(bad))] == [1] * len(good) + [0] * len(bad)


def test_credentials_are_added_and_plain_numbers_are_not(spark):
    chance = random.Random(4)
    rows = []
    for i in range(200):
        secret = "AKIA" + "".join(chance.choice("ABCDEFGH234567") for _ in range(16))
        number = str(chance.randint(1, 2000))
        rows.append((i, f"see page {number} and {secret}, or write to m{i}@mail.example.org in {chance.randint(1990, 2020)}" if i % 2 else f"in {number} things"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = pii.personal_spans(docs)
    texts = dict(rows)
    for r in result.collect():
        words = [texts[r.k][s.s : s.e] for s in r.spans if s.kind == pii.ADDED]
        assert words == (re.findall("AKIA[A-Z0-9]+", texts[r.k]) if r.k % 2 else [])
        assert r.n_email == r.k % 2
    assert not any(name in result._jdf.queryExecution().executedPlan().toString() for name in PYTHON)


def test_spans_of_nulls_empties_repeats_and_long_texts(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a@b.co", "x"), (3, "a@b.co", "x"), (3, "a@b.co", "x"), (4, "1" * 100000 + " a@b.co", "x"), (5, "a@" + "b." * 20000 + "c", "x"), (6, "1 " * 50000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k string")
    found = sorted((r.k or 0, r.base) for r in pii.personal_spans(docs).select("k", pii.as_text(F.col("base")).alias("base")).collect())
    assert found == sorted((k or 0, brute_spans(t or "")) for k, t, _ in rows)
    assert pii.personal_spans(docs.limit(0)).count() == 0
    assert pii.personal_spans(docs.where("text = ''")).first().spans == []


def test_estimated_reliabilities_follow_the_votes():
    patterns = [((1, 1, None), 80), ((1, 0, None), 5), ((0, 0, 0), 400), ((None, 1, 1), 40), ((0, 1, None), 10)]
    prior, chances = pii.estimate(patterns)
    strong = pii.evidence(prior, chances, (1, 1, None))
    assert strong > 0 > pii.evidence(prior, chances, (0, 0, 0))


# Preferences

TURNS = "conv_id long, turn long, role string, text string"


def formatted(spark, turns, pairs):
    frames = spark.createDataFrame(turns, TURNS), spark.createDataFrame(pairs, "pair_id long, chosen long, rejected long")
    return preferences.format_preferences(*frames)


def test_prompt_once_and_masked_completions(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "<|x"), (1, 3, "assistant", "A"),
             (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "else"), (2, 3, "assistant", "B")]
    found = formatted(spark, turns, [(7, 1, 2)])
    rows = sorted(found.collect(), key=lambda r: (r.part, r.turn))
    text = {part: "".join(r.segment for r in rows if r.part == part) for part in ("prompt", "chosen", "rejected")}
    assert text["prompt"] == "<|user|>\nhi\n<|assistant|>\nyes\n"
    assert text["chosen"] == "<|user|>\n< |x\n<|assistant|>\nA\n"
    for r in rows:
        assert text[r.part][r.start : r.end] == r.segment
        trained = text[r.part][r.loss_start : r.loss_end]
        assert trained == ({"chosen": "A", "rejected": "B"}[r.part] if r.part != "prompt" and r.role == "assistant" else "")


def test_roles_and_swapped_answers(spark):
    turns = [(4, 0, "user", "q"), (4, 1, "assistant", "a"), (4, 2, "user", "more"), (4, 3, "assistant", "last"), (5, 0, "us|>er", "q5"), (5, 1, "assistant", "other"),
             (9, 0, "user", "alone"), (9, 1, "assistant", "no neighbour"), (11, 0, "user", "no answer"), (None, 0, "user", "x"), (4, None, "user", "x")]
    swapped = preferences.with_swapped_answers(spark.createDataFrame(turns, TURNS))
    rows = preferences.format_preferences(swapped, preferences.neighbouring_pairs(swapped)).collect()
    text = {}
    for r in sorted(rows, key=lambda r: r.turn):
        text[r.pair_id, r.part] = text.get((r.pair_id, r.part), "") + r.segment
    assert text[4, "prompt"] == "<|user|>\nq\n<|assistant|>\na\n<|user|>\nmore\n"
    assert (text[4, "chosen"], text[4, "rejected"]) == ("<|assistant|>\nlast\n", "<|assistant|>\nother\n")
    assert text[5, "prompt"] == "<|us| >er|>\nq5\n" and text[5, "rejected"] == "<|assistant|>\nlast\n"
    assert text[9, "chosen"] == "<|assistant|>\nno neighbour\n" and (9, "rejected") not in text
    assert text[11, "prompt"] == "<|user|>\nno answer\n" and (11, "chosen") not in text
    assert preferences.with_swapped_answers(spark.createDataFrame([], TURNS)).count() == 0


def test_places_cross_blocks_of_turns(spark, monkeypatch):
    monkeypatch.setattr(preferences, "BLOCK", 4)
    turns = [(c, t, "user", "x" * (t % 3)) for c in (1, 2) for t in range(30)]
    turns[-1] = (2, 29, "user", "end")
    rows = sorted(formatted(spark, turns, [(1, 1, 2)]).collect(), key=lambda r: (r.part, r.turn))
    prompt = [r for r in rows if r.part == "prompt"]
    assert len(prompt) == 29 and all(a.end == b.start for a, b in zip(prompt, prompt[1:], strict=False))


def test_turns_of_nulls_repeats_and_missing_sides(spark):
    turns = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "x"), (None, 0, "user", "x"), (2, 0, "", ""), (3, 0, "user", "x" * 100000), (3, 0, "user", "y")]
    rows = formatted(spark, turns, [(1, 1, 2), (1, 1, 2), (2, 3, 9), (None, 1, 2), (3, None, 2)]).collect()
    assert sorted((r.pair_id, r.part, len(r.segment)) for r in rows) == [(1, "prompt", 6), (2, "chosen", 100010)]
    empty = spark.createDataFrame([], TURNS)
    assert preferences.format_preferences(empty, preferences.neighbouring_pairs(empty)).count() == 0


def test_texts_of_turns_are_moved_once_to_their_places(spark, capsys):
    turns = spark.createDataFrame([(c, t, "user", f"{c // 2} {t}") for c in range(4) for t in range(3)], TURNS)
    found = preferences.format_preferences(turns, preferences.neighbouring_pairs(turns))
    found.explain("formatted")
    moved = [part for part in capsys.readouterr().out.split("\n\n") if ") Exchange\n" in part]
    assert moved and sum("text#" in part or "content#" in part or "segment#" in part for part in moved) <= 1
    assert found.where("part = 'prompt'").count() == 6 == found.count()
