"""Toxicity classifier: gradient-boosted trees over dense features, with isotonic calibration (operator 11).

* **Lexicon.** It is learnt, not listed: words, and beginnings of words, that are far more frequent in documents labelled
  toxic than in others. Words are read as a reader would: in lower case, digits and signs that stand for letters taken
  for these, other signs left out.
* **Dense features.** How much of the lexicon a text has and how strong it is, how often it stands close to a
  second person, capitals, punctuation, and words whose letters are mixed with signs or digits.
* **Trees.** Labelled documents fall into folds. A document's features use a lexicon that was counted without its fold, so
  that the trees see what they will see in texts without a label. One fold is left out of the trees.
* **Calibration.** On that fold, isotonic regression turns the trees' margin into a probability.

At most ``labelled`` documents with the least hashes of their ids are learnt from; their ids are all that is broadcast, and
the lexicon has at most ``terms`` entries. Every document is scored on its whole text, where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.common import Words, mix, steps, stored

# The second person in the corpus languages (English, German, French, Spanish).
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer eure tu te toi ton ta tes "
    "vous votre vos usted ustedes tú ti tus vosotros vuestro vuestra"
).split()
# What digits and signs are read as.
READ_AS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
FEATURES = (
    "weight_share", "hit_share", "hits", "strongest", "mean_weight", "stem_share", "strongest_stem", "near_share", "near_hits",
    "second_person", "capitals", "capital_words", "exclaims", "signs", "mixed_words", "mixed_hits", "words",
)


class Settings(NamedTuple):
    labelled: int = 50_000
    terms: int = 20_000
    folds: int = 4
    least_documents: int = 3
    association: float = 12.0
    stem: int = 4
    near: int = 5
    trees: int = 20
    depth: int = 3


class Lexicon(NamedTuple):
    """Sorted term hashes, and a weight per term with one fold left out (the last row: none left out)."""

    terms: np.ndarray
    weights: np.ndarray


_DIGIT, _SIGN, _LETTER = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
for _b in range(0x21, 0x7F):
    (_DIGIT if chr(_b).isdigit() else _LETTER if chr(_b).isalpha() else _SIGN)[_b] = True
_LETTER[0x80:] = True
_READ = np.arange(256, dtype=np.uint8)
_READ[65:91] += 32
for _from, _to in READ_AS.items():
    _READ[ord(_from)] = ord(_to)
_DROPPED = _SIGN & (_READ == np.arange(256))
_STEM_MARK = np.uint64(0x5DEECE66D)


class _Text:
    """The words of a step of texts, as they are written and as they are read."""

    def __init__(self, column: pa.Array, stem: int):
        self.plain = plain = Words(column)
        raw = plain.raw
        size = plain.ends - plain.starts
        self.owner = plain.owners()
        self.counts = plain.counts

        def inside(mask: np.ndarray) -> np.ndarray:
            total = np.r_[0, np.cumsum(mask)]
            return total[plain.ends] - total[plain.starts]

        self.size, self.capitals = size, inside((raw >= 65) & (raw <= 90))
        self.letters, self.signs = inside(_LETTER[raw]), inside(_SIGN[raw])
        self.exclaims = inside((raw == 0x21) | (raw == 0x3F))
        # A sign or digit that stands between letters.
        odd = _DIGIT[raw] | _SIGN[raw]
        between = np.zeros(len(raw), bool)
        between[1:-1] = odd[1:-1] & _LETTER[raw[:-2]] & _LETTER[raw[2:]]
        self.mixed = inside(between & (raw != 0x27) & (raw != 0x2D)) > 0
        # As read: the words keep their places, some may lose all their signs.
        read = _READ[raw]
        kept = ~_DROPPED[raw]
        place = np.r_[0, np.cumsum(kept)]
        self.read, self.starts, self.ends = read[kept], place[plain.starts], place[plain.ends]
        self.whole = self._hash(self.starts, self.ends)
        points = np.flatnonzero((self.read & 0xC0) != 0x80)
        after = np.searchsorted(points, self.starts) + stem
        limit = np.r_[points, np.full(1, len(self.read))]
        self.stems = mix(self._hash(self.starts, np.minimum(limit[np.minimum(after, len(points))], self.ends)) ^ _STEM_MARK)
        self.filled = self.ends > self.starts

    def _hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of stretches of the bytes as read, eight bytes at a time."""
        result = mix((ends - starts).astype(np.uint64))
        longest = int((ends - starts).max()) if len(starts) else 0
        padded = np.r_[self.read, np.zeros(8, np.uint8)]
        going, at = np.arange(len(starts)), starts.copy()
        for _ in range(0, longest, 8):
            going = going[at[going] < ends[going]]
            cells = padded[at[going, None] + np.arange(8)].astype(np.uint64)
            cells[at[going, None] + np.arange(8) >= ends[going, None]] = 0
            result[going] = mix(result[going] * np.uint64(3) + (cells << np.arange(0, 64, 8, dtype=np.uint64)).sum(1, dtype=np.uint64))
            at[going] += 8
        return result


def _second_person(stem: int) -> np.ndarray:
    return np.sort(_Text(pa.array([" ".join(SECOND_PERSON)]), stem).whole)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each value in a sorted array, -1 where it is not there."""
    if not len(known):
        return np.full(len(values), -1)
    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[place] == values, place, -1)


def _counted(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """``(term, cell, n)``: documents with the term, by fold and label."""
    for step in steps(batches):
        found = _Text(step.column("t"), settings.stem)
        cell = np.asarray(step.column("cell"), np.int64)
        terms, cells = [], []
        for values in (found.whole, found.stems):
            rows = np.unique(np.stack([found.owner[found.filled].astype(np.uint64), values[found.filled]]), axis=1)
            terms.append(rows[1])
            cells.append(cell[rows[0].astype(np.int64)])
        both, n = np.unique(np.stack([np.concatenate(terms), np.concatenate(cells).astype(np.uint64)]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(both[0].view(np.int64)), pa.array(both[1].astype(np.int32)), pa.array(n.astype(np.int64))], names=["term", "cell", "n"]
        )


def learn_lexicon(labelled: DataFrame, settings: Settings) -> Lexicon:
    """``labelled`` is ``(t, label, fold)``. Terms are those with the strongest link to label 1 (chi-square)."""
    folds = settings.folds
    sizes = np.zeros((folds, 2))
    for row in labelled.groupBy("fold", "label").count().collect():
        sizes[row["fold"], row["label"]] = row["count"]
    counts = labelled.select("t", (F.col("fold") * 2 + F.col("label")).alias("cell")).mapInArrow(
        partial(_counted, settings=settings), "term long, cell int, n long"
    )
    by_cell = [F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(2 * folds)]
    counts = counts.groupBy("term").agg(*by_cell)
    clean, toxic = (sum((F.col(f"c{2 * f + y}") for f in range(folds)), F.lit(0)) for y in (0, 1))
    n_clean, n_toxic = sizes.sum(0)
    share = float(n_toxic / max(n_clean + n_toxic, 1))
    held = clean + toxic
    excess = toxic - held * share
    # As in a test of independence of term and label.
    spread = held * share * (1 - share) * (1 - held / float(max(n_clean + n_toxic, 1))) + 1e-9
    strength = excess * excess / spread
    chosen = counts.where((toxic >= settings.least_documents) & (excess > 0) & (strength > settings.association))
    # At most ``terms`` rows reach the driver.
    rows = chosen.orderBy(strength.desc(), "term").limit(settings.terms).collect()
    table = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 1 + 2 * folds)
    terms = table[:, 0].view(np.uint64) if len(table) else np.zeros(0, np.uint64)
    order = np.argsort(terms)
    cells = table[order, 1:].reshape(-1, folds, 2).astype(float)
    weights = []
    for left_out in range(folds + 1):
        used = np.arange(folds) != left_out
        n, size = cells[:, used].sum(1), sizes[used].sum(0)
        weight = np.log((n[:, 1] + 0.5) / (size[1] + 1)) - np.log((n[:, 0] + 0.5) / (size[0] + 1))
        # A term that is left with hardly any document says nothing.
        weights.append(np.where(n[:, 1] >= 2, np.maximum(weight, 0), 0))
    return Lexicon(terms[order], np.array(weights).reshape(folds + 1, -1))


def _features(step: pa.RecordBatch, lexicon: Lexicon, settings: Settings, second: np.ndarray) -> np.ndarray:
    found, rows = _Text(step.column("t"), settings.stem), step.num_rows
    owner, words = found.owner, np.maximum(found.counts, 1)
    fold = np.asarray(step.column("fold"), np.int64)[owner]

    def weights(values: np.ndarray) -> np.ndarray:
        place = _among(values, lexicon.terms)
        known = (place >= 0) & found.filled
        result = np.zeros(len(values))
        result[known] = lexicon.weights[fold[known], place[known]]
        return result

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, rows)

    def largest(values: np.ndarray) -> np.ndarray:
        result = np.zeros(rows)
        np.maximum.at(result, owner, values)
        return result

    whole, stems = weights(found.whole), weights(found.stems)
    strong = np.maximum(whole, stems)
    hit = strong > 1
    you = _among(found.whole, second) >= 0
    # Words at most ``near`` places from a second person of the same text.
    at = np.flatnonzero(you)
    place = np.arange(len(owner))
    close = np.zeros(len(owner), bool)
    if len(at):
        right = np.minimum(np.searchsorted(at, place), len(at) - 1)
        for other in (at[right], at[np.maximum(right - 1, 0)]):
            close |= (np.abs(other - place) <= settings.near) & (owner[other] == owner)
    hits = total(hit)
    letters = np.maximum(total(found.letters), 1)
    columns = [
        total(np.where(hit, strong, 0)) / words, hits / words, np.log1p(hits), largest(whole), total(np.where(hit, strong, 0)) / np.maximum(hits, 1),
        total(stems > 1) / words, largest(stems), total(hit & close) / words, np.log1p(total(hit & close)),
        total(you) / words, total(found.capitals) / letters, total((found.capitals > 1) & (found.capitals == found.size)) / words,
        total(found.exclaims) / words, total(found.signs) / words, total(found.mixed) / words, np.log1p(total(found.mixed & hit)), np.log1p(found.counts),
    ]
    return np.stack(columns, 1)


def _dense(batches: Iterator[pa.RecordBatch], lexicon: Lexicon, settings: Settings, carried: str) -> Iterator[pa.RecordBatch]:
    second = _second_person(settings.stem)
    for step in steps(batches):
        values = _features(step, lexicon, settings, second)
        offsets = pa.array(np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([step.column(carried), pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], names=[carried, "features"])


def dense_features(docs: DataFrame, carried: str, lexicon: Lexicon, settings: Settings = Settings()) -> DataFrame:
    """``carried`` and ``features`` (in the order of ``FEATURES``) of rows with a text ``t`` and a ``fold``."""
    schema = docs.select(carried).schema.add("features", T.ArrayType(T.DoubleType()))
    return docs.select(carried, "t", "fold").mapInArrow(partial(_dense, lexicon=lexicon, settings=settings, carried=carried), schema)


class Model(NamedTuple):
    lexicon: Lexicon
    trees: GBTClassificationModel
    calibration: IsotonicRegressionModel


def _margin(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """Adds ``margin``, the trees' sum for label 1."""
    return trees.transform(rows.withColumn("features", array_to_vector("features"))).withColumn("margin", vector_to_array("rawPrediction")[1])


def train(docs: DataFrame, labels: DataFrame, label: Column, key: str, text: str, settings: Settings) -> Model | None:
    """Learns from the documents whose key has a label (0 or 1); None when one of the two kinds is missing."""
    named = labels.select(F.col(key).cast("long").alias("k"), label.cast("int").alias("label")).where("k IS NOT NULL AND label IN (0, 1)")
    # Of contradicting labels the toxic one counts.
    named = named.groupBy("k").agg(F.max("label").alias("label"))
    known = named.orderBy(F.xxhash64("k"), "k").limit(settings.labelled)
    source = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    fold = F.pmod(F.xxhash64(F.lit(11), "k"), F.lit(settings.folds)).cast("int").alias("fold")
    # At most ``labelled`` ids: a bound that no table exceeds.
    labelled = stored(source.join(F.broadcast(known), "k").select("k", "t", "label", fold), "labelled")
    classes = {r["label"] for r in labelled.select("label").distinct().collect()}
    if classes != {0, 1}:
        return None
    lexicon = learn_lexicon(labelled, settings)
    rows = dense_features(labelled.withColumn("carried", F.struct("label", "fold")), "carried", lexicon, settings)
    rows = stored(rows.select("carried.*", "features"), "features")
    last = settings.folds - 1
    both = {r["held"] for r in rows.groupBy((F.col("fold") == last).alias("held")).agg(F.count_distinct("label").alias("n")).where("n = 2").collect()}
    # Where a part lacks one of the kinds, all rows serve.
    fitted = rows.where(F.col("fold") != last) if False in both else rows
    held = rows.where(F.col("fold") == last) if True in both else rows
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=settings.trees, maxDepth=settings.depth, stepSize=0.3, seed=11)
    model = trees.fit(fitted.select("label", array_to_vector("features").alias("features")))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(_margin(held, model).select("margin", F.col("label").cast("double").alias("label")))
    return Model(lexicon, model, calibration)


def toxicity(
    docs: DataFrame, labels: DataFrame, label: Column, key: str = "doc_id", text: str = "text",
    keep: tuple[str, ...] | None = None, settings: Settings = Settings(),
) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, all by default), ``features`` and ``score``, the probability of being toxic.

    ``label`` is an expression over ``labels``, 1 for toxic and 0 for not; other values are not learnt from. Only the
    text is an input of the score. NULL and empty texts have no words and are scored like others. Rows with NULL or
    repeated keys are scored each. Without labels of both kinds scores are NULL. An empty table gives an empty result.
    """
    model = train(docs, labels, label, key, text, settings)
    row = F.struct(*[F.col(c) for c in (keep or docs.columns)]).alias("row")
    source = docs.select(row, F.coalesce(text, F.lit("")).alias("t"), F.lit(settings.folds).alias("fold"))
    if model is None:
        return source.select("row", F.lit(None).cast("array<double>").alias("features"), F.lit(None).cast("double").alias("score"))
    margins = _margin(dense_features(source, "row", model.lexicon, settings), model.trees)
    scored = model.calibration.setFeaturesCol("margin").setPredictionCol("calibrated").transform(margins)
    return scored.select("row", vector_to_array("features").alias("features"), F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)).alias("score"))
