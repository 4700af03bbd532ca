"""Personal data by weak supervision (operator 7).

Four kinds have exact rules (e-mail, ip, card, phone); their spans always stay. Beyond them, every word with a
digit is a candidate. Labelers vote on it, each for, against or not at all: the exact rules, shapes,
key-value forms, a gazetteer of credential prefixes and harmless units, and the word before it. Nobody says
which labelers are right. Expectation-maximisation estimates from the counts of vote patterns how reliable each one
is, and how likely each pattern means a private word. With these likelihoods as soft labels a final classifier
(naive Bayes on how the word is built) is trained; candidates it is sure of are added as ``secret`` spans.

Everything is DataFrame functions. Texts are not shuffled: what leaves the scan is the matches, with the length of
the text before each, and running sums turn these into places. Only aggregates with a fixed number of
rows reach the driver: at most 3 vote values per labeler, and the cells of the classifier's features.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeloom.functions.binding import bound, evaluate_once
from changeloom.llm.common import stored

KINDS = ["email", "ip", "card", "phone"]
ADDED = "secret"
SURE = 0.9
# A character that no text needs; it marks signs inside a match so that patterns can stay single runs,
# which no length of text makes recursive or quadratic.
JOINT = "￿"
_LOCAL = f"A-Za-z0-9._%+{JOINT}-"
_LABEL = "A-Za-z0-9-"
PATTERNS = {
    "email": f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[{_LABEL}]++{JOINT}[{_LABEL}{JOINT}]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": f"[0-9][0-9{JOINT}]*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # A word with a digit.
    "word": r"(?<![^\x20\x09-\x0D])[^0-9\x20\x09-\x0D]*+[0-9][^\x20\x09-\x0D]*+",
}
# Where a sign is part of a match: a dot between labels, one blank or dash between digits.
JOINTS = {"email": f"(?<=[{_LABEL}])\\.(?=[{_LABEL}])", "card": r"(?<=[0-9])[\x20-](?=[0-9])"}
SIGN = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "word": "[0-9]"}

# Fixed values of the labelers.
PREFIXES = ["AKIA", "ASIA", "ghp_", "gho_", "glpat-", "sk-", "pk-", "xoxb-", "xoxp-", "AIza", "eyJ"]
KEY_NAMES = ["password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth"]
PRIVATE_CUES = ["password", "passwd", "pin", "ssn", "iban", "account", "card", "passport", "licence", "license", "phone", "tel", "call", "login", "key", "token"]
HARMLESS_CUES = ["page", "chapter", "figure", "fig", "table", "section", "no", "vol", "volume", "in", "since", "until", "step", "version"]


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows as ``(k, h, t)``; equal texts under one key have the same spans, so ``(k, h)`` names a row."""
    return docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"), F.coalesce(text, F.lit("")).alias("t"))


def _matches(kind: str) -> Column:
    """``(kind, j, gap, before, hit)`` of each match: its number, and length and end of the text before it."""
    plain = F.translate("t", JOINT, "￾")
    prepared = F.regexp_replace(plain, JOINTS[kind], JOINT) if kind in JOINTS else plain

    def found(text: Column) -> Column:
        gaps = F.split(text, PATTERNS[kind], -1)
        hits = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))

        def described(gaps: Column) -> Column:
            return F.transform(
                hits,
                lambda hit, j: F.struct(
                    F.lit(kind).alias("kind"), j.alias("j"), F.length(F.get(gaps, j)).cast("long").alias("gap"),
                    (F.right(F.get(gaps, j), F.lit(40)) if kind == "word" else F.lit("")).alias("before"), hit.alias("hit"),
                ),
            )

        return bound(gaps, described)

    empty = F.array().cast("array<struct<kind:string,j:int,gap:bigint,before:string,hit:string>>")
    return F.when(F.col("t").rlike(SIGN[kind]), bound(prepared, found)).otherwise(empty)


def located(texts: DataFrame) -> DataFrame:
    """``(k, h, kind, before, hit, s, e)`` of all matches, in code points, end exclusive."""
    found = F.concat(*[_matches(kind) for kind in PATTERNS])
    rows = evaluate_once(texts, {"found": found}).select("k", "h", F.inline("found"))
    rows = rows.dropDuplicates(["k", "h", "kind", "j"])
    upto = Window.partitionBy("k", "h", "kind").orderBy("j").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("hit").cast("long")
    end = F.sum(F.col("gap") + size).over(upto)
    return rows.select("k", "h", "kind", "before", "hit", (end - size).alias("s"), end.alias("e"))


def _luhn(digits: Column) -> Column:
    def worth(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + worth(i))
    return total % 10 == 0


def is_valid() -> Column:
    """Whether a match of an exact kind passes its check."""
    digits = F.regexp_replace("hit", "[^0-9]", "")
    # Zeros in front are given back where the part is nothing but zeros.
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    size = F.length(digits)
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", F.col("hit").rlike(f"^{part}(?:\\.{part}){{3}}$"))
        .when(F.col("kind") == "card", F.when(size.between(16, 19), _luhn(digits)).otherwise(F.lit(False)))
        .when(F.col("kind") == "phone", size.between(8, 15))
        .otherwise(F.lit(False))
    )


def _any_of(words: list[str]) -> str:
    return "|".join(w.replace("-", "\\-") for w in words)


def labelers() -> dict[str, Column]:
    """Votes on a candidate ``core``: 1 private, 0 harmless, NULL none."""
    core = F.col("core")
    before = F.lower(F.regexp_extract("before", "([A-Za-z]+)[^A-Za-z0-9]*$", 1))
    return {
        "exact": F.when(F.col("in_base"), 1),
        "shape": F.when(core.rlike("^(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_/+-]{16,}$"), 1).when(core.rlike("^[0-9]{1,6}$"), 0),
        "pair": F.when(core.rlike(f"(?i)^(?:{_any_of(KEY_NAMES)})[=:]."), 1),
        "gazetteer": F.when(core.rlike(f"^(?:{_any_of(PREFIXES)})"), 1).when(
            core.rlike(r"^(?:(?:19|20)[0-9]{2}s?|[0-9.,]+(?:st|nd|rd|th|km|kg|mm|cm|ms|mb|gb|%|x))$"), 0
        ),
        "context": F.when(before.isin(PRIVATE_CUES), 1).when(before.isin(HARMLESS_CUES), 0),
        "length": F.when(F.length("core") >= 16, 1).when(F.length("core") <= 5, 0),
    }


def features() -> dict[str, Column]:
    """How a candidate is built, as small categories."""
    core, size = F.col("core"), F.length("core")
    digits = F.length(F.regexp_replace("core", "[^0-9]", ""))
    return {
        "size": F.least((size / 4).cast("int"), F.lit(8)),
        "digits": (4 * digits / F.greatest(size, F.lit(1))).cast("int"),
        "capitals": core.rlike("[A-Z]").cast("int"),
        "small": core.rlike("[a-z]").cast("int"),
        "equals": core.rlike("[=:]").cast("int"),
        "signs": core.rlike("[^A-Za-z0-9=:]").cast("int"),
    }


def estimate(patterns: list[tuple[tuple[int | None, ...], int]], rounds: int = 50) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Prior log-odds and, per labeler and vote, its chance among private and among harmless words.

    ``patterns`` has each combination of votes and its number of words. A word's first likelihood is the
    share of its votes that are for it.
    """
    likely = []
    for votes, _ in patterns:
        cast = [v for v in votes if v is not None]
        likely.append((sum(cast) + 0.2) / (len(cast) + 1.0))
    prior, chances = 0.0, []
    for _ in range(rounds):
        private = sum(p * n for p, (_, n) in zip(likely, patterns, strict=True))
        harmless = sum(n for _, n in patterns) - private
        prior = math.log((private + 1) / (harmless + 1))
        chances = []
        for labeler in range(len(patterns[0][0])):
            sums = {1: [1.0, 1.0], 0: [1.0, 1.0]}
            for p, (votes, n) in zip(likely, patterns, strict=True):
                if votes[labeler] is not None:
                    sums[votes[labeler]][0] += p * n
                    sums[votes[labeler]][1] += (1 - p) * n
            totals = [sums[0][i] + sums[1][i] for i in (0, 1)]
            # A vote for is never evidence against, nor the other way round.
            chance = {v: (sums[v][0] / totals[0], sums[v][1] / totals[1]) for v in (0, 1)}
            chances.append(chance if chance[1][0] >= chance[1][1] else {v: (0.5, 0.5) for v in (0, 1)})
        likely = [1 / (1 + math.exp(-max(-40.0, min(40.0, evidence(prior, chances, votes))))) for votes, _ in patterns]
    return prior, chances


def evidence(prior: float, chances: list[dict[int, tuple[float, float]]], votes: tuple[int | None, ...]) -> float:
    return prior + sum(math.log(c[v][0] / c[v][1]) for c, v in zip(chances, votes, strict=True) if v is not None)


def _likelihood(prior: float, chances: list[dict[int, tuple[float, float]]], names: list[str]) -> Column:
    total = F.lit(prior)
    for name, chance in zip(names, chances, strict=True):
        weight = {v: math.log(chance[v][0] / chance[v][1]) for v in (0, 1)}
        vote = F.col(f"vote_{name}")
        total = total + F.when(vote == 1, weight[1]).when(vote == 0, weight[0]).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def candidates(matches: DataFrame, base: DataFrame) -> DataFrame:
    """``(k, h, s, e, in_base, vote_.., feature_..)`` of words with a digit, without signs around them."""
    words = matches.where(F.col("kind") == "word")
    lead = F.length(F.regexp_extract("hit", "^[^A-Za-z0-9]*+", 0))
    core = F.regexp_replace(F.regexp_replace("hit", "^[^A-Za-z0-9]++", ""), "(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")
    words = words.select("k", "h", (F.col("s") + lead).alias("s"), core.alias("core"), "before")
    words = words.select("k", "h", "s", (F.col("s") + F.length("core")).alias("e"), "core", "before", F.lit(False).alias("base"))
    marks = base.select("k", "h", "s", "e", F.lit("").alias("core"), F.lit("").alias("before"), F.lit(True).alias("base"))
    # A word meets a base span if one that starts before it ends later, or the next one starts before its end.
    spans = Window.partitionBy("k", "h")
    earlier = spans.orderBy("s", F.desc("base")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = spans.orderBy(F.desc("s"), F.desc("base")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = words.unionByName(marks).select(
        "*", F.max(F.when(F.col("base"), F.col("e"))).over(earlier).alias("reach"), F.min(F.when(F.col("base"), F.col("s"))).over(later).alias("next")
    )
    met = F.coalesce(F.col("reach") > F.col("s"), F.lit(False)) | F.coalesce(F.col("next") < F.col("e"), F.lit(False))
    rows = rows.where("NOT base").select("k", "h", "s", "e", "core", "before", met.alias("in_base"))
    votes = [v.cast("int").alias(f"vote_{name}") for name, v in labelers().items()]
    built = [c.cast("int").alias(f"feature_{name}") for name, c in features().items()]
    return rows.select("k", "h", "s", "e", "in_base", *votes, *built)


def added_spans(rows: DataFrame) -> DataFrame:
    """``(k, h, s, e)`` of candidates outside the base spans that the final classifier is sure of."""
    names, built = list(labelers()), list(features())
    votes = rows.groupBy(*[f"vote_{n}" for n in names]).count().collect()
    if not votes:
        return rows.select("k", "h", "s", "e").limit(0)
    prior, chances = estimate(sorted(((tuple(r[:-1]), r["count"]) for r in votes), key=str))
    likely = _likelihood(prior, chances, names)
    cells = rows.groupBy(*[f"feature_{n}" for n in built]).agg(F.sum(likely).alias("private"), F.count("*").alias("n"))
    cells = sorted(cells.collect(), key=str)
    private, total = sum(r["private"] for r in cells), sum(r["n"] for r in cells)
    odds = F.lit(math.log((private + 1) / (total - private + 1)))
    for name in built:
        column, weights = f"feature_{name}", {}
        values = sorted({r[column] for r in cells})
        for value in values:
            mine = [r for r in cells if r[column] == value]
            inside = sum(r["private"] for r in mine)
            outside = sum(r["n"] for r in mine) - inside
            size = len(values)
            weights[value] = math.log((inside + 1) / (private + size)) - math.log((outside + 1) / (total - private + size))
        term = F.lit(0.0)
        for value, weight in weights.items():
            term = F.when(F.col(column) == value, weight).otherwise(term)
        odds = odds + term
    sure = 1 / (1 + F.exp(-odds)) >= SURE
    return rows.where(~F.col("in_base") & sure).select("k", "h", "s", "e")


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``k``, ``n_<kind>``, and ``base`` and ``spans`` as arrays of ``(rank, kind, s, e)`` by kind, then start.

    ``s`` and ``e`` are code points, end exclusive. NULL texts are empty and have no spans. Rows with NULL or
    repeated keys have spans of their own; an empty table gives an empty result. Other columns are
    not read.
    """
    texts = _texts(docs, key, text)
    matches = stored(located(texts), "matches")
    base = matches.where(F.col("kind").isin(KINDS)).where(is_valid()).select("k", "h", "kind", "s", "e")
    added = added_spans(stored(candidates(matches, base), "candidates"))
    rank = F.array_position(F.array(*[F.lit(kind) for kind in [*KINDS, ADDED]]), F.col("kind")).cast("int")
    everything = base.unionByName(added.withColumn("kind", F.lit(ADDED)))
    per_text = everything.groupBy("k", "h").agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "kind", "s", "e"))).alias("spans"))
    rows = texts.select("k", "h")
    found = per_text.toDF("k2", "h2", "spans")
    joined = rows.join(found, rows["k"].eqNullSafe(found["k2"]) & (rows["h"] == found["h2"]), "left")
    empty = F.array().cast(per_text.schema["spans"].dataType)
    joined = joined.select("k", F.coalesce("spans", empty).alias("spans"))

    def count_of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count_of(kind) for kind in KINDS]
    base_spans = F.filter("spans", lambda x: x["rank"] <= len(KINDS)).alias("base")
    return joined.select("k", *counts, base_spans, "spans")


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
