"""Quality classifier by co-training on text and metadata (operator 5).

Two logistic classifiers look at two views of a document: its text (which words it has, and how its
words are written) and its metadata columns. They are trained on a sample of labelled documents. Then, round
by round, each scores a pool of documents without labels; those it is confident of become training rows of
the *other* view with its verdict as their label. Part of the labelled sample is held out all the time and
calibrates both views after each round (Platt scaling), so confidence means a probability, and a view that knows
little has no say. In the end the calibrated log-odds of both views are added, less the prior that both
contain, which gives the score of every document.

Only the sample and the pool reach the driver: ``labelled`` and ``pool`` documents at most, those with the least
hashes of their ids, as at most ``1 << TEXT_BITS`` feature numbers each. All documents are scored, on their whole
text, where they are read; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.common import Words, mix, steps

TEXT_BITS, META_BITS = 18, 14
SHARES = 7
SCORES = "p_text double, p_metadata double, score double"


class Settings(NamedTuple):
    labelled: int = 12000
    pool: int = 3000
    rounds: int = 3
    confident: float = 0.97
    per_round: int = 300
    held_out: int = 4
    least_documents: int = 4
    association: float = 15.0
    ridge: float = 1e-4
    turns: int = 400


class View(NamedTuple):
    """Weights by feature number (the last one is the constant) and the calibration."""

    weights: np.ndarray
    scale: float
    shift: float


class Classifier(NamedTuple):
    text: View
    metadata: View
    prior: float


# How a byte is written: capital, small letter, digit, or itself.
_KIND = np.array([65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b > 127 else 48 if 48 <= b <= 57 else b for b in range(256)], np.uint64)


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(feature, row)`` of a step of texts: folded words, and the shares of ways words are written."""
    folded, plain = Words(column, fold=True), Words(column)
    owner = folded.owners()
    feature = folded.hashes() >> np.uint64(64 - TEXT_BITS)
    if len(plain.starts):
        kind = _KIND[plain.raw]
        last = plain.ends - 1
        before = np.maximum(plain.ends - 2, plain.starts)
        way = kind[plain.starts] * np.uint64(1 << 16) + kind[before] * np.uint64(1 << 8) + kind[last]
        of = plain.owners()
        pairs, count = np.unique(of * np.int64(1 << 24) + way.astype(np.int64), return_counts=True)
        row = pairs >> 24
        share = count / plain.counts[row]
        for level in range(SHARES):
            enough = share >= 2.0**-level
            name = mix((pairs[enough] & ((1 << 24) - 1)).astype(np.uint64) * np.uint64(SHARES) + np.uint64(level + (1 << 40)))
            feature = np.r_[feature, name >> np.uint64(64 - TEXT_BITS)]
            owner = np.r_[owner, row[enough]]
    both = np.unique(owner * np.int64(1 << TEXT_BITS) + feature.astype(np.int64))
    return both & ((1 << TEXT_BITS) - 1), both >> TEXT_BITS


def metadata_features(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    feature, row = [], []
    for i, column in enumerate(columns):
        values = column.dictionary_encode()
        words = values.dictionary.fill_null("").to_pylist() if len(values.dictionary) else []
        names = Words(pa.array([f"{i}={v}".replace(" ", "_") for v in words], pa.string()))
        codes = np.zeros(len(words) + 1, np.uint64)
        for j in range(len(words)):
            codes[j] = mix(names.hashes()[names.first[j] : names.first[j] + 1])[0] if names.counts[j] else 0
        index = np.asarray(values.indices.fill_null(len(words)), np.int64)
        feature.append((codes[index] >> np.uint64(64 - META_BITS)).astype(np.int64))
        row.append(np.arange(len(column)))
    return np.concatenate(feature), np.concatenate(row)


def sums_of(weights: np.ndarray, feature: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights[feature], rows) + weights[-1]


def _logit(p):
    return np.log(p / (1 - p))


def _chance(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(feature: np.ndarray, row: np.ndarray, labels: np.ndarray, width: int, settings: Settings) -> np.ndarray:
    """Logistic weights by full-batch AdaGrad.

    Features of few documents, and those whose link with the labels chance explains (chi-square), get none.
    """
    held_by, good = np.bincount(feature, minlength=width), np.bincount(feature, labels[row], width)
    share, size = labels.mean(), max(len(labels), 1)
    spread = held_by * share * (1 - share) * (1 - held_by / size)
    used = (held_by >= settings.least_documents) & ((good - held_by * share) ** 2 > settings.association * spread)
    mine = used[feature]
    feature, row = feature[mine], row[mine]
    weights, squares = np.zeros(width + 1), np.full(width + 1, 1e-8)
    # Both classes weigh alike, however rare one is.
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    for _ in range(settings.turns):
        error = (_chance(sums_of(weights, feature, row, len(labels))) - labels) * share
        slope = np.r_[np.bincount(feature, error[row], width), error.sum()] + settings.ridge * weights * np.r_[np.ones(width), 0]
        squares += slope**2
        weights -= 0.5 * slope / np.sqrt(squares)
    return weights


def calibrate(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift under which ``scale * z + shift`` are the log-odds of the labels (Newton steps)."""
    if not len(z) or labels.min() == labels.max():
        return 0.0, float(_logit((labels.sum() + 1) / (len(labels) + 2)))
    # Soft labels keep the log-odds finite when the classes are told apart without error.
    soft = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    x = np.stack([z, np.ones_like(z)])
    theta = np.zeros(2)
    for _ in range(50):
        p = _chance(theta @ x)
        slope = x @ (p - soft) + 1e-4 * theta
        theta -= np.clip(np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-4 * np.eye(2), slope), -2, 2)
    return float(theta[0]), float(theta[1])


class _Rows(NamedTuple):
    """Features of some documents in one view."""

    feature: np.ndarray
    row: np.ndarray
    size: int

    def take(self, keep: np.ndarray) -> _Rows:
        place = np.cumsum(keep) - 1
        mine = keep[self.row]
        return _Rows(self.feature[mine], place[self.row[mine]], int(keep.sum()))

    def plus(self, other: _Rows) -> _Rows:
        return _Rows(np.r_[self.feature, other.feature], np.r_[self.row, other.row + self.size], self.size + other.size)


def co_train(views: dict[str, tuple[_Rows, _Rows]], labels: np.ndarray, held: np.ndarray, settings: Settings) -> Classifier:
    """``views`` has, by name, the features of the labelled documents and those of the pool."""
    widths = {"text": 1 << TEXT_BITS, "metadata": 1 << META_BITS}
    pseudo = {name: np.full(pool.size, -1) for name, (_, pool) in views.items()}
    fitted: dict[str, View] = {}
    for turn in range(settings.rounds + 1):
        for name, (rows, pool) in views.items():
            given = pseudo[name] >= 0
            train = rows.take(~held).plus(pool.take(given))
            weights = fit(train.feature, train.row, np.r_[labels[~held], pseudo[name][given]], widths[name], settings)
            held_rows = rows.take(held)
            fitted[name] = View(weights, *calibrate(sums_of(weights, held_rows.feature, held_rows.row, held_rows.size), labels[held]))
        if turn == settings.rounds:
            break
        for name, other in (("text", "metadata"), ("metadata", "text")):
            view, pool = fitted[name], views[name][1]
            p = _chance(view.scale * sums_of(view.weights, pool.feature, pool.row, pool.size) + view.shift)
            sure = np.maximum(p, 1 - p)
            sure[pseudo[other] >= 0] = 0
            best = np.argsort(-sure, kind="stable")[: settings.per_round]
            best = best[sure[best] >= settings.confident]
            pseudo[other][best] = p[best] > 0.5
    return Classifier(fitted["text"], fitted["metadata"], float(_logit((labels.sum() + 1) / (len(labels) + 2))))


def _prepared(docs: DataFrame, text: str, metadata: tuple[str, ...]) -> list[Column]:
    """The columns that features are made of: text, and metadata as names of categories."""
    columns = [F.coalesce(F.col(text), F.lit("")).alias("_t")]
    for i, name in enumerate(metadata):
        value = F.col(name)
        if isinstance(docs.schema[name].dataType, T.NumericType):
            value = F.floor(F.log2(F.abs(value.cast("double")) + 1))
        columns.append(F.coalesce(value.cast("string"), F.lit("")).alias(f"_m{i}"))
    return columns


def _sampled(batches: Iterator[pa.RecordBatch], metadata: int) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, "_t"):
        out = []
        for feature, row in (text_features(step.column("_t")), metadata_features([step.column(f"_m{i}") for i in range(metadata)])):
            order = np.argsort(row, kind="stable")
            feature = feature[order].astype(np.int32)
            ends = np.cumsum(np.bincount(row, minlength=step.num_rows))
            out.append([part.tobytes() for part in np.split(feature, ends[:-1])])
        yield pa.RecordBatch.from_arrays(
            [step.column("k"), step.column("label"), pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary())], names=["k", "label", "text", "metadata"]
        )


def train(docs: DataFrame, labels: DataFrame, good: Column, key: str, text: str, metadata: tuple[str, ...], settings: Settings) -> Classifier | None:
    """The classifier, or None when the sample lacks one of the classes."""
    named = labels.select(F.col(key).cast("long").alias("k"), good.cast("int").alias("label")).where("k IS NOT NULL AND label IS NOT NULL")
    # Of contradicting labels the bad one counts.
    named = named.groupBy("k").agg(F.min("label").alias("label"))
    known = named.orderBy(F.xxhash64("k"), "k").limit(settings.labelled)
    ids = docs.select(F.col(key).cast("long").alias("k")).where("k IS NOT NULL")
    others = ids.join(named, "k", "left_anti").distinct().orderBy(F.xxhash64("k"), "k").limit(settings.pool)
    chosen = known.select("k", "label").union(others.select("k", F.lit(None).cast("int")))
    prepared = docs.select(F.col(key).cast("long").alias("k"), *_prepared(docs, text, metadata))
    # At most ``labelled + pool`` ids: a bound that no table exceeds.
    rows = prepared.join(F.broadcast(chosen), "k").mapInArrow(
        partial(_sampled, metadata=len(metadata)), "k long, label int, text binary, metadata binary"
    )
    rows = rows.groupBy("k", "label").agg(F.min("text").alias("text"), F.min("metadata").alias("metadata")).collect()
    rows.sort(key=lambda r: r.k)
    sample, pool = [r for r in rows if r.label is not None], [r for r in rows if r.label is None]
    given = np.array([r.label for r in sample])
    if not len(given) or given.min() == given.max():
        return None

    def features(part: list, name: str) -> _Rows:
        found = [np.frombuffer(r[name], np.int32) for r in part]
        sizes = [len(x) for x in found]
        joined = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
        return _Rows(joined, np.repeat(np.arange(len(part)), sizes), len(part))

    views = {name: (features(sample, name), features(pool, name)) for name in ("text", "metadata")}
    ids_ = mix(np.array([r.k for r in sample], np.int64).view(np.uint64))
    return co_train(views, given, ids_ % np.uint64(settings.held_out) == 0, settings)


def _scores(step: pa.RecordBatch, metadata: int, model: Classifier) -> list[np.ndarray]:
    found = []
    text, meta = text_features(step.column("_t")), metadata_features([step.column(f"_m{i}") for i in range(metadata)])
    for view, (feature, row) in ((model.text, text), (model.metadata, meta)):
        found.append(view.scale * sums_of(view.weights, feature, row, step.num_rows) + view.shift)
    return [_chance(found[0]), _chance(found[1]), _chance(found[0] + found[1] - model.prior)]


def _scored(batches: Iterator[pa.RecordBatch], metadata: int, model: Classifier) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, "_t"):
        scores = [pa.array(x) for x in _scores(step, metadata, model)]
        yield pa.RecordBatch.from_arrays([step.column("row"), *scores], names=["row", "p_text", "p_metadata", "score"])


def score(
    docs: DataFrame, labels: DataFrame, good: Column, key: str = "doc_id", text: str = "text",
    metadata: tuple[str, ...] = ("source", "lang", "n_chars"), settings: Settings = Settings(), keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``, all by default), ``p_text``, ``p_metadata`` and ``score``.

    All three are probabilities that a document is good. ``good`` is a condition on ``labels``; labels
    without key or verdict are not used. NULL and empty texts have no words, NULL metadata is a category of its
    own; such documents are scored like others. Rows with NULL or repeated keys are scored each. Without
    labels of both kinds the scores are NULL. An empty table gives an empty result.
    """
    model = train(docs, labels, good, key, text, metadata, settings)
    row = F.struct(*[F.col(c) for c in (keep or docs.columns)]).alias("row")
    source = docs.select(row, *_prepared(docs, text, metadata))
    if model is None:
        return source.select("row", *[F.lit(None).cast("double").alias(c.split()[0]) for c in SCORES.split(", ")])
    schema = T.StructType([source.schema["row"], *T.StructType.fromDDL(SCORES).fields])
    return source.mapInArrow(partial(_scored, metadata=len(metadata), model=model), schema)
