"""Quality scores from a sparse ensemble of rules over text statistics.

Small regression trees, boosted on the logistic loss, propose rules: every
path from a root to a node is a conjunction of comparisons of statistics.  A
lasso-penalised logistic regression over the rules keeps few of them, and
what it keeps is compiled into one Spark column expression.

The fit runs on a bounded sample of labelled rows (``SAMPLE``, chosen by a
hash of the id); the statistics cover whole texts and every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.arrays import Words, batch_words, mix
from docloom.llm.tables import saved

#: Labelled rows a fit looks at, at most.
SAMPLE = 10_000
TREES = 30
DEPTH = 3
BINS = 32
LEARNING_RATE = 0.3
LEAST_LEAF = 10
LASSO = 2e-3
ROUNDS = 400
CUT = 0.3
FOLDS = 5

#: Byte classes: other, white space, line feed, small, capital, digit, end of
#: sentence, other mark, bytes beyond ASCII.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[32, 9, 11, 12, 13]] = 1
_CLASS[10] = 2
_CLASS[ord("a") : ord("z") + 1] = 3
_CLASS[ord("A") : ord("Z") + 1] = 4
_CLASS[ord("0") : ord("9") + 1] = 5
_CLASS[[ord(c) for c in ".,;:?'-\""]] = 6
_CLASS[[ord(c) for c in "!#$%&()*+/<=>@[\\]^_`{|}~"]] = 7
_CLASS[128:] = 8

STATISTICS = (
    "bytes",
    "words",
    "word_length",
    "long_words",
    "short_words",
    "distinct_words",
    "top_word",
    "same_as_last",
    "repeated_runs",
    "words_per_line",
    "capitals",
    "digits",
    "sentence_marks",
    "other_marks",
    "beyond_ascii",
)
PREFIX = "__stat_"


def _statistics(data: np.ndarray, found: Words) -> np.ndarray:
    """A row of ``STATISTICS`` for every text."""
    bounds = found.bounds
    rows = np.zeros((len(bounds) - 1, len(STATISTICS)))
    classes, lengths = _CLASS[data], found.end - found.start
    if len(found.hash) > 2:
        runs = mix(found.hash[:-2] + mix(found.hash[1:-1] + mix(found.hash[2:])))
    for i in range(len(rows)):
        size = int(bounds[i + 1] - bounds[i])
        begin, end = int(found.offsets[i]), int(found.offsets[i + 1])
        count = end - begin
        if not count:
            rows[i, 0] = size
            continue
        by_class = np.bincount(classes[bounds[i] : bounds[i + 1]], minlength=9)
        visible = size - by_class[1] - by_class[2]
        letters = max(1, by_class[3] + by_class[4])
        words, length = found.hash[begin:end], lengths[begin:end]
        _, often = np.unique(words, return_counts=True)
        repeated = 1 - len(np.unique(runs[begin : end - 2])) / (count - 2) if count > 2 else 0.0
        rows[i] = (
            size,
            count,
            length.mean(),
            (length > 12).mean(),
            (length < 4).mean(),
            len(often) / count,
            often.max() / count,
            (words[1:] == words[:-1]).sum() / count,
            repeated,
            count / (by_class[2] + 1),
            by_class[4] / letters,
            by_class[5] / visible,
            by_class[6] / visible,
            by_class[7] / visible,
            by_class[8] / visible,
        )
    return rows


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the statistics of the text as columns ``__stat_<name>``."""
    names = [PREFIX + name for name in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.zeros((0, len(names)))]
            for _, _, data, found in batch_words(batch, text):
                rows.append(_statistics(data, found))
            values = np.concatenate(rows)
            columns = [*batch.columns, *[pa.array(np.ascontiguousarray(column)) for column in values.T]]
            yield pa.record_batch(columns, names=[*batch.schema.names, *names])

    added = [T.StructField(name, T.DoubleType()) for name in names]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, whether at most, bound)


def _paths(x: np.ndarray, gradient: np.ndarray, bounds: list[np.ndarray], bins: np.ndarray, depth: int):
    """Fits one regression tree; returns its rules and its values."""
    rules: list[Rule] = []
    values = np.zeros(len(x))

    def grow(rows: np.ndarray, rule: Rule) -> None:
        if rule:
            rules.append(rule)
        best = (1e-9, -1, -1)
        if len(rule) < depth and len(rows) >= 2 * LEAST_LEAF:
            total, count = gradient[rows].sum(), len(rows)
            for j, cuts in enumerate(bounds):
                if not len(cuts):
                    continue
                n = np.cumsum(np.bincount(bins[rows, j], minlength=len(cuts) + 1))[:-1]
                s = np.cumsum(np.bincount(bins[rows, j], gradient[rows], minlength=len(cuts) + 1))[:-1]
                allowed = (n >= LEAST_LEAF) & (count - n >= LEAST_LEAF)
                if not allowed.any():
                    continue
                left, right = s**2 / np.maximum(n, 1), (total - s) ** 2 / np.maximum(count - n, 1)
                gain = np.where(allowed, left + right - total**2 / count, -1)
                cut = int(gain.argmax())
                if gain[cut] > best[0]:
                    best = (gain[cut], j, cut)
        if best[1] < 0:
            values[rows] = gradient[rows].mean() if len(rows) else 0
            return
        _, j, cut = best
        below = bins[rows, j] <= cut
        bound = float(bounds[j][cut])
        grow(rows[below], (*rule, (j, True, bound)))
        grow(rows[~below], (*rule, (j, False, bound)))

    grow(np.arange(len(x)), ())
    return rules, values


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    return np.logical_and.reduce([(x[:, j] <= b) if below else (x[:, j] > b) for j, below, b in rule])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass(frozen=True)
class RuleModel:
    """Weights of the rules that the lasso kept."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """The probability of label 1 from the statistics of a row."""
        terms = [
            F.when(
                reduce(
                    lambda a, b: a & b,
                    [
                        (F.col(PREFIX + STATISTICS[j]) <= b) if below else (F.col(PREFIX + STATISTICS[j]) > b)
                        for j, below, b in rule
                    ],
                ),
                F.lit(weight),
            ).otherwise(F.lit(0.0))
            for rule, weight in self.rules
        ]
        total = reduce(lambda a, b: a + b, terms, F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def fit_rules(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """Fits the ensemble; with one label or none it is a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return RuleModel(intercept, ())
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    bounds = [np.unique(np.quantile(column, quantiles)) for column in x.T]
    bins = np.stack([np.searchsorted(b, column, "left") for b, column in zip(bounds, x.T, strict=True)], axis=1)
    margin, rules = np.full(len(y), intercept), {}
    for _ in range(TREES):
        p = _sigmoid(margin)
        found, values = _paths(x, y - p, bounds, bins, DEPTH)
        margin += LEARNING_RATE * 4 * values
        rules |= dict.fromkeys(found)
    held = {}
    for rule in rules:  # of rules that hold for the same rows, the first
        holds = _holds(x, rule)
        held.setdefault(holds.tobytes(), (rule, holds))
    kept = list(held.values())
    if not kept:
        return RuleModel(intercept, ())
    a = np.stack([holds for _, holds in kept], axis=1).astype(np.float32)
    step = 4.0 / max(1e-9, float(np.linalg.eigvalsh(a.T @ a / len(y))[-1]) + 1)
    weights, moved, momentum, bias = np.zeros(a.shape[1]), np.zeros(a.shape[1]), 1.0, intercept
    for _ in range(ROUNDS):
        error = _sigmoid(a @ moved.astype(np.float32) + bias) - y
        bias -= step * float(error.mean())
        new = moved - step * (a.T @ error.astype(np.float32)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * LASSO, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        moved = new + (momentum - 1) / following * (new - weights)
        weights, momentum = new, following
    chosen = [(rule, float(w)) for (rule, _), w in zip(kept, weights, strict=True) if abs(w) > 1e-6]
    return RuleModel(float(bias), tuple(chosen))


def held_out(folds: int = FOLDS) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0


def fit_quality(statistics: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Fits on at most ``sample`` labelled rows that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).alias("_label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "_label").limit(sample)
    rows = known.join(statistics, "doc_id").select(
        "_label", *[PREFIX + name for name in STATISTICS]
    ).limit(4 * sample).toPandas()
    rows = rows.sort_values(list(rows.columns))
    return fit_rules(rows.iloc[:, 1:].to_numpy(float), rows["_label"].to_numpy(float))


def quality_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[RuleModel, DataFrame]:
    """The fitted model and the statistics of all documents."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    statistics = saved(with_statistics(texts).drop("text"), "quality")
    return fit_quality(statistics, labels, sample), statistics


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of ``docs(doc_id, text)``.

    ``labels(doc_id, quality)`` with a null in either is not learned from;
    without labels every score is 0.5.  Null and empty texts are scored by
    their statistics, which are all 0.  Every row is returned, also repeated
    ones and those without an id (not held out).  Other columns are ignored.
    """
    model, statistics = quality_model(docs, labels, sample)
    return statistics.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents with a score of at least ``CUT``, all columns."""
    model, _ = quality_model(docs, labels, sample)
    return with_statistics(docs).where(model.score() >= CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
