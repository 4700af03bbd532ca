"""One query per training-data operator, and the pipeline, each over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import oracles
from changeloom.llm.common import table
from changeloom.llm.cotraining import score
from changeloom.llm.decontaminate import contaminated_passages
from changeloom.llm.hostrules import judge
from changeloom.llm.jaccard import near_duplicates
from changeloom.llm.lines import dedup_lines
from changeloom.llm.pii import as_text, personal_spans
from changeloom.llm.periods import periodic_runs, with_planted_periods
from changeloom.llm.pieces import decode, encode
from changeloom.llm.preferences import format_preferences, neighbouring_pairs, with_swapped_answers
from changeloom.llm.spelling import group_variants, vocabulary
from changeloom.llm.substring import remove_repeats
from changeloom.llm.tokencounts import attribute_tokens
from changeloom.llm.toxicity import toxicity
from workload.registry import Query, Registry

import corpus_pipeline

QUERIES = Registry()
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
QUERIES["pipeline"] = Query(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)


@QUERIES.add(oracles.SUBSTRING)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = remove_repeats(table(spark, sf_dir, "documents"))
    return result.select(
        F.col("k").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@QUERIES.add(oracles.JACCARD)
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = near_duplicates(table(spark, sf_dir, "documents"))
    return result.select(F.col("k").alias("doc_id"), "n_shingles", "component_id")


@QUERIES.add(None)
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = contaminated_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return result.select(
        F.col("k").alias("doc_id"), F.col("item").alias("item_id"),
        F.col("start").alias("start_word"), F.col("end").alias("end_word"), "distance",
    )


@QUERIES.add(None)
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = attribute_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, fields=("source", "lang", "text"))
    return result.select(F.col("k").alias("doc_id"), *result.columns[1:])


@QUERIES.add(None)
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(table(spark, sf_dir, "documents"), PIECES, n=3)
    return decode(encoded, PIECES).select(
        F.col("k").alias("doc_id"), "rank", "score", F.size("ids").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"), F.sha2("decoded", 256).alias("text_sha256"),
    )


@QUERIES.add(oracles.HOST_RULES)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        F.col("k").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@QUERIES.add(oracles.LINES)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("k").alias("doc_id"), "n_lines", "n_removed",
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
    )


def is_good() -> Column:
    """The verdict of the labels table: good quality and not toxic."""
    return (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)


@QUERIES.add(None)
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), is_good(), keep=("doc_id",))
    return scored.select("row.doc_id", "p_text", "p_metadata", "score", (F.col("score") >= 0.5).alias("kept"))


@QUERIES.add(None)
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans(table(spark, sf_dir, "documents")).select(
        F.col("k").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"),
    )


@QUERIES.add(oracles.PREFERENCES)
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = with_swapped_answers(table(spark, sf_dir, "conversations"))
    return format_preferences(turns, neighbouring_pairs(turns)).select(
        "pair_id", "part", "turn", "role", F.sha2("segment", 256).alias("segment_sha256"),
        "start", "end", "loss_start", "loss_end",
    )


@QUERIES.add(oracles.SPELLING)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(table(spark, sf_dir, "documents"), drop_every=97)
    return group_variants(words).select("word", "n", "n_near", "form", "form_n", "root")


@QUERIES.add(None)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    planted = docs.select("doc_id", with_planted_periods(F.col("text"), F.col("doc_id")).alias("text"))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs(planted).select(
        F.col("k").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length, period = -F.col("longest.less"), F.col("longest.period")
    return found.select(
        "doc_id", "n_runs", F.col("longest.start").alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


def is_held_out(key: str) -> Column:
    """A fifth of the documents, from whose labels nothing is learnt."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@QUERIES.add(None)
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~is_held_out("doc_id"))
    scored = toxicity(table(spark, sf_dir, "documents"), labels, F.col("toxic"), keep=("doc_id",)).select("row.doc_id", "score")
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", is_held_out("doc_id").alias("held_out"), "score", predicted)
