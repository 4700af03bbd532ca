"""Quality rules with host-level verdicts (operator 2).

Each document is measured on its whole text, and rules say where it fails. Failures are summed by host. A rate
measured on few documents says little, so each host's rate is shrunk towards the rate of all: hosts' true
rates are taken to follow a beta distribution, whose mean and strength are fitted to the observed rates by
moments (the spread that chance alone gives hosts of their sizes is taken off first). A host whose shrunken
rate exceeds a rule's limit is rejected, and its verdict is joined back to its documents.

Everything is DataFrame functions. Texts are never shuffled: what is measured is written, a few numbers per
row. Sums per host are made in part before the shuffle. The join with the hosts is a plain equality
join, so adaptive execution splits a host that holds a large part of the rows, or sends small host tables to
all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.binding import bound, evaluate_once
from changeloom.llm.common import WORD, stored, words_of

SYMBOLS = r"[#*$%&|<>]"
# Rates above which a host is rejected, by rule.
LIMITS = {"base": 0.5, "symbols": 0.5, "lines": 0.5}
# Bounds of the prior's strength, in documents: hosts that look alike or wholly different give no estimate.
WEAKEST, STRONGEST = 1.0, 1000.0


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows that the text holds twice or more."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of_sorted(s: Column) -> Column:
            def twice(e: Column, j: Column) -> Column:
                before, after = F.get(s, j - 1)["h"], F.get(s, j + 1)["h"]
                return F.when(F.coalesce(before == e["h"], F.lit(False)) | F.coalesce(after == e["h"], F.lit(False)), e["i"])

            places = F.array_compact(F.transform(s, twice))
            return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bound(placed, of_sorted))

    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    windows = F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return bound(windows, covered)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measures(text: Column) -> dict[str, Column]:
    """What is measured on a text; NULL counts as an empty one."""
    whole = F.coalesce(text, F.lit(""))
    of_words: Callable[[Column], Column] = lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
    )
    return {
        "_words": bound(words_of(text), of_words),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": repeated_lines(whole).cast("long"),
    }


def failures() -> dict[str, Column]:
    """The rules, on measured rows; all in whole numbers."""
    return {
        "base": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "lines": F.col("n_dup_lines") > F.lit(0),
    }


def measured(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    source = docs.select(F.col(key).alias("k"), F.col(host).alias("host"), F.col(text).alias("t"))
    rows = evaluate_once(source, measures(F.col("t"))).drop("t")
    rows = rows.select("k", "host", "_words.*", "n_symbols", "n_dup_lines")
    return rows.withColumns({f"failed_{name}": rule for name, rule in failures().items()})


def host_verdicts(rows: DataFrame) -> DataFrame:
    """``(host, n_docs, rate_<rule>.., host_ok)``; documents without a host are one host."""
    sums = [F.sum(F.col(f"failed_{rule}").cast("long")).alias(rule) for rule in LIMITS]
    hosts = stored(rows.groupBy("host").agg(F.count("*").alias("n_docs"), *sums), "hosts")
    n = F.col("n_docs").cast("double")
    means = hosts.agg(*[(F.sum(rule) / F.sum("n_docs")).alias(rule) for rule in LIMITS]).first()
    ok, rates = F.lit(True), []
    for rule, limit in LIMITS.items():
        mean = means[rule] or 0.0
        # One row: the spread of the hosts' rates, less what chance gives.
        spread = hosts.agg(
            F.avg(F.pow(F.col(rule) / n - mean, 2)) - F.avg(mean * (1 - mean) / n)
        ).first()[0] or 0.0
        strength = mean * (1 - mean) / spread - 1 if spread > 0 else STRONGEST
        strength = min(max(strength, WEAKEST), STRONGEST)
        rate = (F.col(rule) + strength * mean) / (n + strength)
        rates.append(rate.alias(f"rate_{rule}"))
        ok = ok & (rate <= limit)
    return hosts.select("host", "n_docs", *rates, ok.alias("host_ok"))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: ``k``, ``host``, the measures, ``failed_<rule>``, the host's shrunken rates, ``base_failed``, ``kept``.

    A row is kept if it passes the base rule and its host is not rejected. NULL and empty texts have no
    words and fail the base rule. NULL hosts are judged together as one. NULL and repeated keys are kept as
    rows of their own; an empty table gives an empty result. Other columns are not read.
    """
    rows = stored(measured(docs, key, text, host), "measures")
    verdicts = host_verdicts(rows).withColumnRenamed("host", "judged")
    joined = rows.join(verdicts, rows["host"].eqNullSafe(F.col("judged")), "left").drop("judged")
    return joined.withColumns(
        {"base_failed": F.col("failed_base"), "kept": ~F.col("failed_base") & F.col("host_ok")}
    )
