from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from changeloom.llm import pieces as p

PATH = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def model():
    return p.Model(p.read_model(PATH))


def brute(model, text):
    """Scores and ids of all segmentations, best first."""
    found = []

    def go(at, ids, score):
        if at == len(text):
            found.append((score, tuple(ids)))
        for end in range(at + 1, min(len(text), at + model.longest) + 1):
            piece = text[at:end]
            if piece in model.ids:
                go(end, [*ids, model.ids[piece]], score + model.scores[piece])
            elif end == at + 1:
                go(end, ids + model.fallback(piece), score + model.unknown)

    go(0, [], 0.0)
    return sorted(found, key=lambda x: -x[0])


def test_n_best_agrees_with_all_segmentations(model):
    chance = random.Random(1)
    for _ in range(200):
        text = "".join(chance.choice('ther ing  aé一あx\n.,(-!"9') for _ in range(chance.randint(1, 11)))
        marked = p.MARK + text.replace(" ", p.MARK)
        wanted = brute(model, marked)
        for n in (1, 3, 6):
            assert [s for s, _ in p.n_best(model, marked, n)] == [s for s, _ in wanted[:n]]
            found = [(score, tuple(ids.tolist())) for _, _, score, ids in p.encode_texts([text], p.Units(model), n)]
            assert [s for s, _ in found] == [s for s, _ in wanted[:n]]
            assert len(set(found)) == len(found) and {ids for _, ids in found} <= {ids for _, ids in wanted}


def test_units_do_not_depend_on_their_company(model):
    texts = ["the thing, there", "the (thing) there.\nThe end", "", "x " * 400, "ﬁ▁é"]
    together = [(s, tuple(i)) for _, _, s, i in p.encode_texts(texts, p.Units(model), 3)]
    alone = [(s, tuple(i)) for t in texts for _, _, s, i in p.encode_texts([t], p.Units(model), 3)]
    assert together == alone


def test_every_segmentation_decodes_to_the_text(spark, model):
    texts = ["", " ", "  a  b ", "▁", "a▁b ▁", "\n\n x\ty", "日本語 ﬁ é \U0001f600", "a" * 100_000, "word, " * 20_000, "\0x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = p.decode(p.encode(docs, PATH, n=3), PATH).collect()
    assert {r.k for r in rows} == set(range(len(texts)))
    assert all(r.decoded == texts[r.k] for r in rows)
    for k in range(len(texts)):
        scores = [r.score for r in sorted(rows, key=lambda r: r["rank"]) if r.k == k]
        assert scores == sorted(scores, reverse=True)


def test_nulls_repeats_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "a b", 2), (3, "a b", 3), (3, "a b", 3)], "doc_id long, text string, k int")
    rows = p.encode(docs, PATH).collect()
    assert sorted((r.k or 0, r["rank"], len(r.ids)) for r in rows) == [(0, 1, 2), (1, 1, 0), (3, 1, 2), (3, 1, 2)]
    assert p.encode(docs.limit(0), PATH).count() == 0
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert p.decode(nothing, PATH).first().decoded is None
    with pytest.raises(ValueError):
        p.encode(docs, PATH, n=0)
    with pytest.raises(ValueError):
        p.decode(nothing, PATH, "ids")


def test_lists_decode_as_one_by_one(model):
    """Bytes that are no UTF-8, lists without pieces, and NULL lists among others."""
    pieces = p.piece_bytes(p.read_model(PATH))
    output = p.Output(pieces)
    chance = random.Random(2)
    fallback = model.fallback("é")
    for _ in range(50):
        lists = [[chance.choice([chance.randrange(len(pieces)), *fallback]) for _ in range(chance.randint(0, 9))] for _ in range(chance.randint(1, 9))]
        flat = np.array([i for x in lists for i in x], np.int64)
        assert output.texts(flat, np.array([len(x) for x in lists])).to_pylist() == [p.decode_ids(x, pieces) for x in lists]


def test_null_lists_and_steps(spark, monkeypatch):
    monkeypatch.setattr(p, "DECODED_PIECES", 3)
    proto = p.read_model(PATH)
    some = [[300, 301, 302, 303], None, [], [400], None, [500, 501]]
    batch = pa.RecordBatch.from_arrays([pa.array(some, pa.list_(pa.int32()))], names=["ids"])
    found = [t for part in p._decode(iter([batch]), proto, "text") for t in part.column("text").to_pylist()]
    pieces = p.piece_bytes(proto)
    assert found == [None if x is None else p.decode_ids(x, pieces) for x in some]
