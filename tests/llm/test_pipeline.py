from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from changeloom.llm.pieces import encode
from changeloom.llm.queries import QUERIES
from tests.harness import SF_DIR, differences
from tests.llm.test_jaccard import brute
from tests.llm.test_native import brute_lines


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_agrees_with_sql(spark, name):
    assert differences(entry_point.queries()[name](spark, SF_DIR), QUERIES[name].sql, SF_DIR) == []


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5


@pytest.fixture
def docs(spark):
    line = " ".join(f"l{i}" for i in range(20))
    text = lambda k: "\n".join(" ".join(f"w{k}_{j}_{i}" for i in range(12)) for j in range(6))
    rows = [(k, text(k), "en", "s", len(text(k)), k) for k in range(20)]
    rows += [(50, text(3), "en", "s", 1, 0), (51, f"{line}\n{text(51)}", "en", "s", 1, 0), (52, f"{text(52)}\n{line} more", "en", "s", 1, 0)]
    rows += [(60, text(60), None, None, None, None), (61, text(60).replace("w60_0_0", "other"), None, None, None, None), (70, None, None, None, None, None), (71, "", "en", "s", 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k long")


def test_line_stage(spark, docs):
    found = corpus_pipeline.without_repeated_lines(spark, docs, SF_DIR)
    assert found.schema.names == docs.schema.names
    wanted = brute_lines([(r.doc_id, r.text) for r in docs.collect() if r.text is not None], 8)
    kept = {r.doc_id: r.text for r in found.collect()}
    assert kept == {**{k: t for k, (gone, t) in wanted.items() if not gone or t.split()}, 70: None}
    assert found.where("n_chars <> length(text) AND doc_id IN (51, 52)").count() == 1


def test_near_duplicate_stage(spark, docs):
    found = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, docs, SF_DIR).collect()}
    assert found == {k for k, c in brute([(r.doc_id, r.text) for r in docs.collect()]).items() if k == c}
    assert 50 not in found and 61 not in found


@pytest.fixture
def folder(spark, docs, tmp_path):
    """A documents table whose document 51 holds a benchmark passage over two lines, and 52 only the second of them."""
    head, tail_ = (" ".join(f"{c}{i}" for i in range(14)) for c in "ab")
    more = [(80, f"start\n{head}\n{tail_}\nend", "en", "s", 1, 0), (81, "clean words", None, "s", 1, 0), (None, f"{head} {tail_}", "en", "s", 1, 0)]
    docs.union(spark.createDataFrame(more, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, f"{head} {tail_}"), (2, None), (None, "clean words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_decontamination_stage_knows_the_texts_that_documents_came_from(spark, docs, folder):
    head = " ".join(f"a{i}" for i in range(14))
    came = docs.union(spark.createDataFrame([(80, f"start\n{head}\nend", "en", "s", 1, 0), (81, "clean words", None, "s", 1, 0), (None, None, None, None, None, None)], docs.schema))
    found = corpus_pipeline.decontaminated(spark, came, folder)
    assert found.schema.names == came.schema.names
    assert {r.doc_id for r in came.collect()} - {r.doc_id for r in found.collect()} == {80}
    assert corpus_pipeline.decontaminated(spark, came.limit(0), folder).collect() == []


def test_first_and_last_stage_on_nulls_and_empty_tables(spark, docs, folder):
    """Without labels every document stays; NULL and empty texts have no pieces."""
    assert corpus_pipeline.good_documents(spark, docs, folder).count() == docs.count()
    ids = corpus_pipeline.encoded(spark, docs, folder)
    assert {(r.doc_id, r.n_pieces) for r in ids.where("doc_id >= 70").collect()} == {(70, 0), (71, 0)} and ids.count() == docs.count()
    for stage in (corpus_pipeline.good_documents, corpus_pipeline.encoded):
        assert stage(spark, docs.limit(0), folder).collect() == []


def test_whole_pipeline_keeps_clean_documents_and_drops_the_rest(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    result = corpus_pipeline.run(spark, SF_DIR)
    kept = {r.doc_id for r in result.select("doc_id").collect()}
    clean = {r.doc_id for r in docs.join(labels.where("quality = 1 AND toxic = 0"), "doc_id").collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(kept & clean) > 0.8 * len(clean) and len(kept & bad) < 0.3 * len(bad)
    leaked = {r.doc_id for r in entry_point.queries()["op1_benchmark_decontamination"](spark, SF_DIR).collect()}
    assert leaked and not kept & leaked
    assert result.where(F.size("ids") != F.col("n_pieces")).count() == 0


def test_last_stage_gives_the_n_best_segmentations(spark, docs, folder):
    few = docs.where("doc_id IN (3, 50, 70, 71)").union(spark.createDataFrame([(None, "one two", None, None, None, None)], docs.schema))
    wanted = {(r.k, r["rank"]): (r.score, r.ids) for r in encode(few, corpus_pipeline.PIECES, n=3).collect()}
    found = {}
    for r in corpus_pipeline.encoded(spark, few, folder).collect():
        found |= {(r.doc_id, rank): (o.score, o.ids) for rank, o in enumerate([r, *r.others], 1)}
    assert found == wanted and {k for k, rank in found if rank == 3} == {3, 50, None}
