"""Quality classifier: naive Bayes support vectors.

A document's features are indicators of hashed n-grams: of its words (1 and 2) and of the shapes
of its words (1 to 3), where a shape tells the case of letters, other characters as they are, and
whether the word repeats the one before. Every indicator is scaled by the log ratio of its counts
in both classes, the vector has length one, and dual coordinate descent fits a linear model with
hinge loss. A sigmoid fitted to margins of documents that the model has not seen makes
probabilities of margins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfgap.llm.common import remainder

WORD_BITS, SHAPE_BITS = 18, 13
FEATURES = (1 << WORD_BITS) + (1 << SHAPE_BITS)
DOCS_PER_CLASS = 8_000  # bound of the training sample
COST = 1.0
EPOCHS = 30
TOLERANCE = 0.01
CACHED_WORDS = 400_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_RUNS = re.compile(r"[^\W\d_]+|\d+|(.)\1*", re.DOTALL)


def shape_of(word: bytes) -> bytes:
    """Letter runs as a (small), A (capitals), T (a capital first) or M (mixed), digits as 0, each
    run of another character as that character."""

    def code(run: re.Match) -> str:
        text = run.group()
        if text[0].isdigit():
            return "0"
        if not text[0].isalpha():
            return text[0]
        if text.isupper():
            return "A" if len(text) > 1 else "T"
        return "T" if text[0].isupper() and text[1:].islower() else "M" if text != text.lower() else "a"

    return _RUNS.sub(code, word.decode("utf-8", "replace")).encode()


class _WordHashes(dict):
    """Row numbers of words in ``words`` and ``shapes``, two arrays of hashes."""

    def __init__(self):
        super().__init__()
        self.words = np.zeros(1024, np.uint64)
        self.shapes = np.zeros(1024, np.uint64)

    def __missing__(self, word: bytes) -> int:
        import xxhash

        row = len(self)
        if row == len(self.words):
            self.words = np.concatenate([self.words, np.zeros_like(self.words)])
            self.shapes = np.concatenate([self.shapes, np.zeros_like(self.shapes)])
        self.words[row] = xxhash.xxh64_intdigest(word.lower())
        self.shapes[row] = xxhash.xxh64_intdigest(shape_of(word))
        self[word] = row
        return row


def features_of(text: bytes, known: _WordHashes) -> np.ndarray:
    """The features of a whole text, ascending; the last feature, a constant, is in all."""
    split = text.split()
    rows = np.fromiter(map(known.__getitem__, split), np.int64, len(split))
    words, shapes = known.words[rows], known.shapes[rows]
    repeated = np.concatenate([[False], rows[1:] == rows[:-1]])[: len(rows)]
    shapes = shapes ^ repeated * _MIX2
    pairs = words[:-1] * _MIX2 + words[1:]
    two = shapes[:-1] * _MIX2 + shapes[1:]
    three = two[:-1] * _MIX2 + shapes[2:] * _MIX
    bucket = lambda h, bits: ((h ^ h >> np.uint64(29)) * _MIX >> np.uint64(64 - bits)).astype(np.int64)
    found = [
        np.unique(bucket(np.concatenate([words, pairs]), WORD_BITS)),
        np.unique(bucket(np.concatenate([shapes, two, three]), SHAPE_BITS)) + (1 << WORD_BITS),
        [FEATURES],
    ]
    return np.concatenate(found).astype(np.int64)


@dataclass(frozen=True)
class QualityModel:
    """Weight and squared scale of every feature, and the sigmoid."""

    weights: np.ndarray
    squares: np.ndarray
    slope: float
    offset: float

    def margin(self, features: np.ndarray) -> float:
        return float(self.weights[features].sum() / np.sqrt(self.squares[features].sum()))

    def score(self, features: np.ndarray) -> float:
        z = self.slope * self.margin(features) + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio of the shares that a feature has of the indicators of class 1 and of class 0, with
    one added to each count; 1 for the constant."""
    shares = []
    for label in (1, 0):
        of = [rows[k] for k in np.flatnonzero(labels == label)]
        counts = np.bincount(np.concatenate(of), minlength=FEATURES + 1) + 1.0
        shares.append(counts / counts.sum())
    ratios = np.log(shares[0] / shares[1])
    ratios[FEATURES] = 1.0
    return ratios


def dual_coordinate_descent(
    rows: list[np.ndarray],
    values: list[np.ndarray],
    labels: np.ndarray,
    costs: np.ndarray,
    epochs: int = EPOCHS,
    tolerance: float = TOLERANCE,
) -> np.ndarray:
    """Weights of the linear model with hinge loss: each step solves the dual problem for one
    document. ``costs`` bounds the dual variable of each; documents come in a fixed random order.
    """
    sign = np.where(labels == 1, 1.0, -1.0)
    weights = np.zeros(FEATURES + 1)
    alpha = np.zeros(len(rows))
    norms = np.array([v @ v for v in values])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        worst = 0.0
        for k in rng.permutation(len(rows)):
            at, x = rows[k], values[k]
            gradient = sign[k] * (weights[at] @ x) - 1
            projected = gradient
            if alpha[k] <= 0:
                projected = min(gradient, 0.0)
            elif alpha[k] >= costs[k]:
                projected = max(gradient, 0.0)
            worst = max(worst, abs(projected))
            if projected and norms[k]:
                before = alpha[k]
                alpha[k] = min(max(before - gradient / norms[k], 0.0), costs[k])
                weights[at] += (alpha[k] - before) * sign[k] * x
        if worst < tolerance:
            break
    return weights


def _linear(rows: list[np.ndarray], labels: np.ndarray, cost: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights, times the scales, and squared scales of the features."""
    ratios = log_count_ratios(rows, labels)
    values = [r / np.sqrt(r @ r) for r in (ratios[at] for at in rows)]
    share = np.array([(labels == 0).mean(), (labels == 1).mean()])
    costs = cost * 0.5 / share[labels]
    return dual_coordinate_descent(rows, values, labels, costs) * ratios, ratios**2


def _sigmoid(margins: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the best sigmoid by Newton steps; ``counts`` weighs documents. Targets
    are drawn in from 0 and 1 as if one more document of each class had been seen."""
    n1, n0 = counts[labels == 1].sum(), counts[labels == 0].sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    at = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((counts * (np.logaddexp(0, z) - target * z)).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        gradient = x.T @ (counts * (p - target))
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        size, now = 1.0, loss(at)
        while size > 1e-6 and loss(at - size * step) > now:
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def fit_rows(
    rows: list[np.ndarray], labels: np.ndarray, counts: np.ndarray, cost: float = COST
) -> QualityModel:
    """The model of documents given as feature lists; ``counts`` says for how many documents of
    the whole table each stands. With fewer than two documents of a class it gives every text the
    same score, the share of class 1."""
    per_class = np.bincount(labels, minlength=2)
    if per_class.min() < 2:
        n1, n0 = counts[labels == 1].sum(), counts[labels == 0].sum()
        flat = np.zeros(FEATURES + 1)
        return QualityModel(flat, flat + 1, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    fold = np.zeros(len(rows), np.int64)
    for label in (0, 1):
        of = np.flatnonzero(labels == label)
        fold[of] = np.arange(len(of)) % 2
    margins = np.zeros(len(rows))
    for part in (0, 1):
        learned = [k for k in range(len(rows)) if fold[k] != part]
        weights, squares = _linear([rows[k] for k in learned], labels[learned], cost)
        for k in np.flatnonzero(fold == part):
            margins[k] = weights[rows[k]].sum() / np.sqrt(squares[rows[k]].sum())
    slope, offset = _sigmoid(margins, labels, counts)
    weights, squares = _linear(rows, labels, cost)
    return QualityModel(weights, squares, slope, offset)


def training_labels(labels: DataFrame, docs_per_class: int, label: str = "quality") -> DataFrame:
    """doc_id, label and count of about ``docs_per_class`` labelled documents a class at most,
    chosen by a hash of doc_id; each stands for ``count`` documents of its class.

    Documents whose crc32(doc_id) modulo 5 is 0, labels other than 0 and 1 and documents with both
    are left out.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    rows = rows.where(F.col("label").isin(0, 1) & (remainder(F.col("doc_id")) != 0))
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    rows = rows.where(F.col("label") == F.col("other")).select("doc_id", "label")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    share = F.lit(1.0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, min(1.0, docs_per_class / n)).otherwise(share)
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = rows.withColumn("share", share).where(hashed < F.col("share"))
    return rows.select("doc_id", "label", (1 / F.col("share")).alias("count"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    docs_per_class: int = DOCS_PER_CLASS,
    cost: float = COST,
    label: str = "quality",
    text: str = "text",
) -> QualityModel:
    """Learns ``label`` from a bounded sample of the labelled documents.

    Only texts are inputs. The sampled ids, which are bounded, are broadcast to the documents; the
    features of the sample, bounded too, are fitted in one task.
    """
    sample = F.broadcast(training_labels(labels, docs_per_class, label))
    rows = docs.select("doc_id", F.col(text).cast("binary").alias("text")).join(sample, "doc_id")

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            found = [features_of(t.as_py() or b"", known).astype("<i4").tobytes() for t in batch.column(0)]
            if len(known) > CACHED_WORDS:
                known.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column(1), batch.column(2)], ["features", "label", "count"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sorted(
            row for b in batches for row in zip(b.column(1).to_pylist(), b.column(0).to_pylist(), b.column(2).to_pylist())
        )  # in one order, however the rows arrive
        model = fit_rows(
            [np.frombuffer(f, "<i4").astype(np.int64) for _, f, _ in seen],
            np.array([y for y, _, _ in seen], np.int64),
            np.array([n for _, _, n in seen], np.float64),
            cost,
        )
        values = [[model.weights.tobytes()], [model.squares.tobytes()], [model.slope], [model.offset]]
        yield pa.RecordBatch.from_pydict(dict(zip(("weights", "squares", "slope", "offset"), values)))

    features = rows.select("text", "label", "count").mapInArrow(
        featurize, "features binary, label int, count double"
    )
    learned = features.repartition(1).mapInArrow(
        learn, "weights binary, squares binary, slope double, offset double"
    )
    found = learned.first()
    if found is None:
        return fit_rows([], np.zeros(0, np.int64), np.zeros(0))
    return QualityModel(
        np.frombuffer(found["weights"]), np.frombuffer(found["squares"]), found["slope"], found["offset"]
    )


def score_documents(
    docs: DataFrame, model: QualityModel, threshold: float = 0.3, text: str = "text"
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    A NULL text counts as empty; an empty text has the score of the constant alone. Equal texts
    have equal scores, long texts are read whole, repeated rows stay, a NULL doc_id counts as not
    held out, and other columns are ignored. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            scores = []
            for value in batch.column(1):
                scores.append(sent.value.score(features_of(value.as_py() or b"", known)))
                if len(known) > CACHED_WORDS:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    rows = docs.select("doc_id", F.col(text).cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(score, f"doc_id {kind}, score double")
    return found.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
