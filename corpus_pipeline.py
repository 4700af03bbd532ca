"""The corpus pipeline: from raw documents to token ids, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import WORD, keyed_rows, stored, table
from changeloom.llm.cotraining import score
from changeloom.llm.decontaminate import contaminated_passages, without_contaminated
from changeloom.llm.jaccard import near_duplicates
from changeloom.llm.lines import dedup_lines
from changeloom.llm.pieces import encode_lists

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out what the quality classifier, trained on the labels table, takes for bad or toxic.

    Documents stay when there are no labels to learn from.
    """
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    scored = score(docs, table(spark, sf_dir, "labels"), good)
    return scored.where(F.coalesce(F.col("score") >= 0.5, F.lit(True))).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that repeat an earlier one; documents that lose all their words go."""
    result = dedup_lines(docs)
    stays = (F.col("n_removed") == 0) | F.col("kept").rlike(WORD)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    columns = [
        F.when(F.col("n_removed") > 0, changed[c]).otherwise(F.col("row")[c]).alias(c) if c in changed else F.col("row")[c].alias(c)
        for c in docs.columns
    ]
    return result.where(stays).select(*columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near duplicates, and those without an id."""
    groups = near_duplicates(docs)
    gone = groups.where("k <> component_id").select("k").distinct()
    rows = keyed_rows(docs, "doc_id")
    return rows.join(gone.hint("shuffle_hash"), "k", "left_anti").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents with a passage of a benchmark item, now or in the text they came from.

    An earlier stage may have taken a line out of a passage that other documents hold too, and its other lines
    are benchmark text still. So the documents table is looked at as well, and ids that it gives away go.
    """
    items = table(spark, sf_dir, "benchmark")
    found = contaminated_passages(table(spark, sf_dir, "documents"), items).select("k").distinct()
    found = stored(found, "contaminated")
    rows = keyed_rows(without_contaminated(docs, items), "doc_id")
    return rows.join(found, "k", "left_anti").select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The three best segmentations of every document: ``(doc_id, score, n_pieces, ids, others)``, the best one first."""
    listed = encode_lists(docs, PIECES, n=3)
    return listed.select(F.col("k").alias("doc_id"), "score", F.size("ids").alias("n_pieces"), "ids", "others")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("SentencePiece encoding", encoded),
]

# A trained classifier and segmentation by score have no SQL form: tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
