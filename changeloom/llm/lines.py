"""Line dedup with a deletion-neighbourhood join (operator 9).

A line is a sequence of words. It repeats another if both have the same words or, from ``min_words`` words
on, if one word edit (insertion, deletion, substitution) leads from one to the other. A line goes if it
repeats an earlier one, by key and then place in the text.

* **Equal lines** are grouped by two hashes; the earliest stands for all.
* **Halves.** One edit leaves the first or the last half of the words as they are. Lines that share a half with
  another line of nearly the same length are kept for the join. This loses no pair, and spares all other
  lines their neighbourhood.
* **Deletion neighbourhood.** A line's variants are its own words and its words without any one of them.
  A variant's key is a hash, worked out from running sums over the words, so that a long line costs no more
  per variant than a short one.
* **Join.** Lines within one edit share a variant: both deleted at the same place (a substitution), or one is
  the variant. So per variant, and per variant and place, the earliest line is all that has to be
  known, and no pairs are listed. The earliest line is joined back to the others, and the edit distance is
  verified on the words.

Everything is DataFrame functions. Sums per line, variant and key are made in part before the shuffle;
the joins back are plain equality joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeloom.functions.binding import bound, evaluate_once
from changeloom.llm.common import id_and_text, keyed_rows, stored, words_of

# Hash sums of up to 2^22 words stay within a long.
_SHORT = (1 << 40) - 1


def _half_keys(words: Column, min_words: int) -> Column:
    """Keys of the first and last half, for partners as long and one word shorter or longer."""

    def of_shorter(less: int) -> Column:
        size = F.size(words) - less
        half = (size / 2).cast("int")
        first = F.xxhash64(size, F.lit(0), F.slice(words, F.lit(1), half))
        last = F.xxhash64(size, F.lit(1), F.slice(words, F.size(words) - half + 1, half))
        return F.when(size >= min_words, F.array(first, last)).otherwise(F.array().cast("array<long>"))

    return F.concat(of_shorter(0), of_shorter(1))


def _lines(docs: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """``(k, p, h, g, halves)``: each line's key, place, hashes (NULL without words) and half keys."""
    source = id_and_text(docs, key, text).where("k IS NOT NULL")
    lines = source.select("k", F.posexplode(F.split("t", "\n", -1)).alias("p", "line"))

    def described(words: Column) -> Column:
        filled = F.size(words) > 0
        return F.struct(
            F.when(filled, F.xxhash64(words)).alias("h"),
            F.when(filled, F.xxhash64(F.lit(1), words)).alias("g"),
            _half_keys(words, min_words).alias("halves"),
        )

    rows = evaluate_once(lines, {"x": bound(words_of(F.col("line")), described)})
    return rows.select("k", "p", "x.*")


def _near(docs: DataFrame, distinct: DataFrame, key: str, text: str) -> DataFrame:
    """``(k, p, words)`` of the earliest of equal lines that share a half with another line."""
    halves = distinct.select("first", "h", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low <> high")
    chosen = halves.join(shared.select("half"), "half").select("first.*").distinct()
    chosen = chosen.groupBy("k").agg(F.sort_array(F.collect_list("p")).alias("places"))
    source = id_and_text(docs, key, text).where("k IS NOT NULL")
    found = source.join(chosen.hint("shuffle_hash"), "k")
    lines = evaluate_once(found, {"lines": F.split("t", "\n", -1)}).select("k", "lines", F.explode("places").alias("p"))
    words = evaluate_once(lines.select("k", "p", F.get("lines", F.col("p")).alias("line")), {"words": words_of(F.col("line"))})
    return words.select("k", "p", "words")


def _variants(near: DataFrame) -> DataFrame:
    """``(v, i, line)``: variant key, deleted word (0 for none) and line of all variants."""
    words = near.select("k", "p", F.posexplode("words").alias("j", "word"))

    def mark(seed: int, shift: int) -> Column:
        return F.xxhash64(F.lit(seed), F.col("word"), F.col("j") - shift).bitwiseAND(F.lit(_SHORT))

    marks = {f"{name}{seed}": mark(seed, shift) for seed in (0, 1) for name, shift in (("stay", 0), ("move", 1))}
    words = words.withColumns(marks)
    line = Window.partitionBy("k", "p")
    upto = line.orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"n": F.count("*").over(line)}
    for seed in (0, 1):
        # Words before the deleted one keep their places, those after it move up by one.
        before = F.sum(f"stay{seed}").over(upto) - F.col(f"stay{seed}")
        after = F.sum(f"move{seed}").over(line) - F.sum(f"move{seed}").over(upto)
        sums |= {f"without{seed}": before + after, f"all{seed}": F.sum(f"stay{seed}").over(line)}
    rows = words.select("k", "p", "j", *[c.alias(name) for name, c in sums.items()])
    own = F.struct(F.xxhash64("n", "all0", "all1").alias("v"), F.lit(0).alias("i"))
    less = F.struct(F.xxhash64(F.col("n") - 1, "without0", "without1").alias("v"), (F.col("j") + 1).alias("i"))
    both = F.when(F.col("j") == 0, F.array(own, less)).otherwise(F.array(less))
    return rows.select(F.struct("k", "p").alias("line"), F.inline(both))


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether one word edit at most leads from one array of words to the other."""

    def common(x: Column, y: Column) -> Column:
        differ = F.array_position(F.zip_with(x, y, lambda u, v: ~u.eqNullSafe(v)), True)
        return F.when(differ > 0, differ - 1).otherwise(F.greatest(F.size(x), F.size(y)))

    longer = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1)


def _near_repeats(near: DataFrame) -> DataFrame:
    """``(k, p)`` of lines with an earlier line within one edit."""
    variants = _variants(near)
    ends = variants.groupBy("v").agg(
        F.count("*").alias("n"),
        F.min(F.when(F.col("i") == 0, F.col("line"))).alias("own"),
        F.min(F.when(F.col("i") > 0, F.col("line"))).alias("less"),
    )
    several = stored(variants.join(ends.where("n > 1"), "v").select("v", "i", "line", "own", "less"), "variants", free=True)
    placed = several.groupBy("v", "i").agg(F.min("line").alias("same"))
    joined = several.join(placed, ["v", "i"])
    partner = F.when(F.col("i") == 0, F.col("less")).otherwise(F.least("own", "same"))
    pairs = joined.select("line", partner.alias("partner")).where("partner < line").distinct()
    side = lambda name, words: near.select(F.struct("k", "p").alias(name), F.col("words").alias(words))
    checked = pairs.join(side("line", "a"), "line").join(side("partner", "b"), "partner")
    return checked.where(within_one_edit(F.col("a"), F.col("b"))).select("line.*").distinct()


def line_flags(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 8) -> DataFrame:
    """``(k, p, gone)`` for every line of the rows with a key."""
    lines = stored(_lines(docs, key, text, min_words), "lines", free=True)
    earliest = F.min(F.struct("k", "p")).alias("first")
    distinct = lines.where("h IS NOT NULL").groupBy("h", "g").agg(earliest, F.first("halves").alias("halves"))
    distinct = stored(distinct, "distinct", free=True)
    near = stored(_near(docs, distinct, key, text), "near", free=True)
    repeats = stored(_near_repeats(near), "repeats", free=True).select(F.struct("k", "p").alias("first"), F.lit(True).alias("near"))
    # Only lines that occur again or repeat another need a look; most do not.
    stands = distinct.join(repeats, "first", "left").select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near"))
    joined = lines.select("k", "p", "h", "g").join(stands, ["h", "g"], "left")
    gone = F.col("near") | (F.struct("k", "p") != F.col("first"))
    return joined.select("k", "p", F.coalesce(gone, F.lit(False)).alias("gone"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 8) -> DataFrame:
    """All columns of ``docs`` as ``row``, and ``k``, ``n_lines``, ``n_removed``, ``removed`` (places from 0) and ``kept``.

    ``kept`` is the text without the lines that go; the others stay as they are, joined by line feeds. Lines
    without words never go. A NULL text has no lines and stays NULL; an empty one is a line without words. Rows
    with a NULL key take no part and stay whole. Rows that share a key are taken for repeats of one row
    and all keep the lines that one keeps. An empty table gives an empty result.
    """
    flags = line_flags(docs, key, text, min_words)
    # Repeated rows flag a line several times, alike.
    flags = flags.groupBy("k", "p").agg(F.max("gone").alias("gone"))
    flags = flags.groupBy("k").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("p", "gone"))), lambda x: x["gone"]).alias("gone")
    )
    removed = F.array_compact(F.transform("gone", lambda x, i: F.when(x, i)))
    flags = stored(flags.select("k", "gone", removed.alias("removed")), "flags", free=True)
    empty = F.array().cast("array<int>")
    rows = keyed_rows(docs, key).withColumns({
        "has_lines": F.col("row")[text].isNotNull(),
        "alone": F.when(F.col("k").isNull(), F.size(F.split(F.col("row")[text], "\n", -1))),
    })
    joined = rows.join(flags.hint("shuffle_hash"), "k", "left")
    has_lines, own = F.col("has_lines"), F.col("row")[text]
    kept = F.array_join(F.filter(F.split(own, "\n", -1), lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False))), "\n")
    return joined.select(
        "row", "k",
        F.when(has_lines, F.coalesce("alone", F.size("gone"))).otherwise(F.lit(0)).cast("long").alias("n_lines"),
        F.when(has_lines, F.coalesce(F.size("removed"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(has_lines, F.coalesce("removed", empty)).otherwise(empty).alias("removed"),
        F.when(has_lines & (F.size("removed") > 0), kept).otherwise(own).alias("kept"),
    )
