from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeloom.llm import cotraining as c

SMALL = c.Settings(labelled=400, pool=200, rounds=2, turns=150)


def is_good():
    return F.col("quality") == 1


@pytest.fixture(scope="module")
def tables(spark):
    chance = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for k in range(900):
        good = chance.random() < 0.7
        text = [chance.choice(words) for _ in range(chance.randint(30, 80))]
        if not good:
            for _ in range(4):
                text[chance.randrange(len(text))] = chance.choice(["junk", "scum", "WIN!!"])
        site = chance.choice("ab" if good == (chance.random() < 0.9) else "cd")
        docs.append((k, " ".join(text), site, len(text)))
        if k < 600:
            labels.append((k, int(good)))
    truth = {k: "junk" not in t and "scum" not in t and "WIN!!" not in t for k, t, _, _ in docs}
    return spark.createDataFrame(docs, "doc_id long, text string, source string, n_chars int"), spark.createDataFrame(labels, "doc_id long, quality int"), truth


def test_held_out_accuracy_and_calibration(tables):
    docs, labels, truth = tables
    rows = [r for r in c.score(docs, labels, is_good(), metadata=("source", "n_chars"), settings=SMALL).collect() if r.row.doc_id >= 600]
    assert np.mean([(r.score >= 0.5) == truth[r.row.doc_id] for r in rows]) > 0.95
    # The metadata view is weaker, and knows it.
    metadata = np.mean([(r.p_metadata >= 0.5) == truth[r.row.doc_id] for r in rows])
    assert 0.75 < metadata < 0.98
    assert abs(np.mean([r.p_metadata for r in rows]) - np.mean([truth[r.row.doc_id] for r in rows])) < 0.1


def test_partitioning_does_not_change_scores(tables):
    docs, labels, _ = tables
    one, other = (
        {r.row.doc_id: r.score for r in c.score(d, labels, is_good(), metadata=("source",), settings=SMALL).collect()}
        for d in (docs.coalesce(1), docs.repartition(7))
    )
    assert one.keys() == other.keys() and all(abs(one[k] - other[k]) < 1e-9 for k in one)


def test_nulls_empties_repeats_and_no_labels(spark, tables):
    docs, labels, _ = tables
    odd = spark.createDataFrame([(None, None, None, None), (2000, "", "a", 0), (2000, "", "a", 0), (2001, "x " * 50000, None, 1)], docs.schema)
    both = docs.union(odd).withColumns({"row": F.lit(1), "label": F.lit("x"), "k": F.lit(0)})
    marked = labels.union(spark.createDataFrame([(None, 1), (5000, None), (3, 0)], labels.schema))
    found = c.score(both, marked, is_good(), metadata=("source", "n_chars"), settings=SMALL)
    assert found.count() == 904 and found.where("score IS NULL").count() == 0
    assert found.select("row.*").columns == both.columns
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert c.score(docs, none, is_good(), metadata=("source",), settings=SMALL).where("score IS NOT NULL").count() == 0
    assert c.score(docs.limit(0), labels, is_good(), metadata=("source",), settings=SMALL).count() == 0


def test_calibration_of_perfect_and_useless_scores():
    z, labels = np.r_[-np.ones(50), np.ones(50)], np.r_[np.zeros(50), np.ones(50)]
    scale, shift = c.calibrate(z, labels)
    assert scale > 1 and abs(shift) < 0.1
    scale, shift = c.calibrate(np.zeros(100), np.r_[np.zeros(20), np.ones(80)])
    assert abs(c._chance(shift) - 0.8) < 0.02
