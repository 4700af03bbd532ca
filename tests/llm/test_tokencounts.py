from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from changeloom.llm import tokencounts as t

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def brute(tokenizer, fields, separator, rule):
    """Tokens by field and line from another tokenizer's own offsets, token by token."""
    text, spans, at = separator.join(fields), [], 0
    for i, field in enumerate(fields):
        for j, line in enumerate(field.split("\n")):
            spans.append((i, j, at, at + len(line)))
            at += len(line) + 1
        at += len(separator) - 1
    counts = {(i, j): 0 for i, j, _, _ in spans}
    for s, e in tokenizer.encode(text, add_special_tokens=False).offsets:
        shares = [(min(e, b) - max(s, a), i, j) for i, j, a, b in spans if min(e, b) > max(s, a)]
        if shares:
            _, i, j = max(shares, key=lambda x: x[0]) if rule == "majority" else shares[0]
            counts[i, j] += 1
    return counts


@pytest.mark.parametrize("rule", t.RULES)
def test_agrees_with_offsets_of_another_library(spark, rule):
    tokenizer = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tokenizer.encode_special_tokens = True
    chance = random.Random(1)
    text = lambda: "".join(chance.choice("the re\n\n  ing,.!9<|endoftext|>") for _ in range(chance.randint(0, 80)))
    rows = [(k, text(), text()) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, title string, text string")
    found = t.attribute_tokens(docs, RANKS, fields=("title", "text"), separator=" ", rule=rule).collect()
    for k, *fields in rows:
        assert {(r.field, r.section): r.n_tokens for r in found if r.k == k} == brute(tokenizer, fields, " ", rule)


def test_crossing_tokens_go_where_most_of_them_lies():
    starts, ends = np.array([0, 4, 9, 9]), np.array([3, 9, 9, 12])
    counts, crossed = t.allocate(np.array([2, 4, 1, 5]), starts, ends, "majority")
    assert counts.tolist() == [1, 2, 0, 1] and crossed.tolist() == [0, 1, 0, 1]
    assert t.allocate(np.array([2, 4, 1, 5]), starts, ends, "first")[0].tolist() == [2, 2, 0, 0]


def test_nulls_empties_repeats_and_long_texts(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "é x", 1), (3, "a\nb", 1), (3, "a\nb", 1), (4, "word " * 50000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int")
    found = sorted((r.k or 0, r.section, r.start, r.end, r.n_tokens) for r in t.attribute_tokens(docs, RANKS).collect())
    assert found[:2] == [(0, 0, 0, 3, 2), (1, 0, 0, 0, 0)]
    assert found[2:7] == [(2, 0, 0, 0, 0), (3, 0, 0, 1, 1), (3, 0, 0, 1, 1), (3, 1, 2, 3, 1), (3, 1, 2, 3, 1)]
    assert found[7][:4] == (4, 0, 0, 250000) and found[7][4] >= 50000
    assert t.attribute_tokens(docs.limit(0), RANKS).count() == 0
    with pytest.raises(ValueError):
        t.attribute_tokens(docs, RANKS, rule="last")
