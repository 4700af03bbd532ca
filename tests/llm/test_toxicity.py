"""The toxicity classifier: held-out accuracy, what it may look at, odd inputs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from changeloom.llm.toxicity import FEATURES, Lexicon, Settings, _features, _second_person, _Text, toxicity
from tests.harness import SF_DIR

SETTINGS = Settings(trees=5)


def corpus(seed, n=240):
    """Clean words for all; words of abuse, some with signs for letters, in the toxic third."""
    draw = random.Random(seed)
    clean = ["".join(draw.choice("aeioulmnrst") for _ in range(draw.randint(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [draw.choice(clean) for _ in range(draw.randint(5, 80))]
        toxic = i % 3 == 0
        for _ in range(draw.randint(1, 4) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["blockhead", "BLOCKHEADS!", "bl0ckhead", "nitwit", "n1twit,", "you nitwits"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(3)
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity(docs, known.where("doc_id % 5 > 0"), F.col("toxic"), settings=SETTINGS).select("row.doc_id", "score")
    right = scored.join(known, "doc_id").where("doc_id % 5 = 0").select(((F.col("score") >= 0.5) == (F.col("toxic") == 1)).alias("right"))
    assert right.where("right").count() >= 0.9 * right.count()


def test_query_on_held_out_documents(spark):
    result = entry_point.queries()["op11_toxicity"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id")
    rows = result.where("held_out").select("score", "predicted", "toxic").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted == 0 for r in clean) >= 0.97 * len(clean)
    pairs = [(a.score, b.score) for a in rows for b in rows if a.toxic and not b.toxic]
    assert sum(a > b for a, b in pairs) + sum(a == b for a, b in pairs) / 2 >= 0.8 * len(pairs)


def test_labels_of_held_out_documents_and_other_columns_change_nothing(spark):
    docs, labels = corpus(4, 150)
    docs = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, source string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int").where("doc_id % 5 > 0")
    scores = lambda d: {r.doc_id: r.score for r in toxicity(d, known, F.col("toxic"), settings=SETTINGS).select("row.doc_id", "score").collect()}
    assert scores(docs) == scores(docs.withColumn("source", F.col("doc_id").cast("string")))


def test_dense_features():
    lexicon = Lexicon(np.sort(_Text(pa.array(["idiot"]), 4).whole), np.full((5, 1), 3.0))
    texts = ["You 1D10T! Be well", "fine words here and there", "", "i.d.i.o.t IDIOT x you"]
    step = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([4] * 4, pa.int32())], names=["t", "fold"])
    values = _features(step, lexicon, Settings(), _second_person(4))
    by_name = {name: values[:, i].round(3).tolist() for i, name in enumerate(FEATURES)}
    assert by_name["hit_share"] == [0.25, 0, 0, 0.5] and by_name["strongest"] == [3, 0, 0, 3]
    assert by_name["near_share"] == [0.25, 0, 0, 0.5] and by_name["second_person"] == [0.25, 0, 0, 0.25]
    assert by_name["exclaims"] == [0.25, 0, 0, 0] and by_name["mixed_words"] == [0, 0, 0, 0.25]
    assert by_name["words"] == pytest.approx(np.log1p([4, 5, 0, 4]).round(3).tolist())
    assert _features(step.slice(0, 0), lexicon, Settings(), _second_person(4)).shape == (0, len(FEATURES))


def test_stems_end_at_whole_letters():
    a, b = _Text(pa.array(["äöüßxyz äöüß äöü", "ÄÖ"]), 4), _Text(pa.array(["äöüßabc"]), 4)
    assert a.stems[0] == a.stems[1] == b.stems[0] != a.stems[2]
    assert len(_Text(pa.array([None, "", "..."]), 4).filled) == 1


def test_odd_inputs(spark):
    docs, labels = corpus(6, 90)
    data = [(i, t, "a") for i, t in docs] + [(1000, None, "b"), (1001, "", None), (None, "nitwit " * 100_000, "c"), (2000, "twice", "d"), (2000, "twice", "d")]
    docs = spark.createDataFrame(data, "doc_id long, text string, score string")
    known = [*labels, (7, 1), (None, 1), (3, None), (1000, 0), (5, 9)]
    known = spark.createDataFrame(known, "doc_id long, toxic int")
    rows = toxicity(docs, known, F.col("toxic"), settings=SETTINGS).select("row.doc_id", "row.score", F.col("score").alias("p")).collect()
    assert len(rows) == len(data) and all(r.p is not None and 0 <= r.p <= 1 for r in rows)
    assert len({r.p for r in rows if r.doc_id == 2000}) == 1 and [r.score for r in rows if r.doc_id == 1000] == ["b"]
    assert toxicity(docs.limit(0), known, F.col("toxic")).collect() == []
    for nothing in (known.limit(0), known.where("toxic = 0")):
        assert {r.score for r in toxicity(docs, nothing, F.col("toxic")).select(F.col("score")).collect()} == {None}
