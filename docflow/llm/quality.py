"""Quality classifier on random-indexing word vectors.

Tokens are runs of letters and runs of other characters; they fall into buckets by
hash, with buckets of their own for words in capitals, repeated words and numbers. A
bucket's index vector is a sparse random one; its context vector, the sum of the index
vectors around it in the whole corpus. A document is the mean and the spread of its
tokens' vectors. A network of two layers, trained on labelled documents, scores it, and
a temperature fitted on documents kept apart makes the scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import hash_spans, slices, utf8

BUCKETS, DIMENSIONS, NONZERO, WINDOW = 1 << 14, 32, 2, 2
CAPITALS, REPEATED, NUMBER, RESERVED = 0, 1, 2, 3
#: Labelled documents that the network learns from, on average.
TRAINING_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4

_SPACE, _MARK, _LETTER = 0, 1, 2
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1

_draw = np.random.default_rng(17)
_PLACES = np.argsort(_draw.random((BUCKETS, DIMENSIONS)), 1)[:, :NONZERO].astype(np.int32)
_SIGNS = _draw.choice([-1.0, 1.0], (BUCKETS, NONZERO)).astype(np.float32)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each token, and where each row's tokens begin and end."""
    data, offsets = utf8(column)
    kind = _KIND[data]
    change = np.zeros(len(data) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    bounds = np.flatnonzero(change)
    starts, ends = bounds[:-1], bounds[1:]
    solid = kind[starts] != _SPACE
    starts, ends = starts[solid], ends[solid]
    h = hash_spans(data, starts, ends)
    bucket = (h % np.uint64(BUCKETS - RESERVED)).astype(np.int32) + RESERVED
    within = lambda flags: (c := np.concatenate([[0], np.cumsum(flags[data])]))[ends] - c[starts]
    letters = kind[starts] == _LETTER
    rows = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    bucket[(ends - starts > 1) & (within(_UPPER) == ends - starts)] = CAPITALS
    bucket[within(_DIGIT) > 0] = NUMBER
    words = np.flatnonzero(letters)
    again = words[1:][(h[words[1:]] == h[words[:-1]]) & (row[words[1:]] == row[words[:-1]])]
    bucket[again] = REPEATED
    return bucket, rows


def context_vectors(docs: DataFrame) -> np.ndarray:
    """The buckets' context vectors over all texts, at unit length.

    Each task sums up its texts, Spark the tasks' sums; the table of ``BUCKETS`` rows is
    all that reaches the driver, whatever the size of the input.
    """
    names = [f"v{i}" for i in range(DIMENSIONS)]

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS * DIMENSIONS, np.float32)
        for batch in batches:
            for part in slices(batch, "text"):
                bucket, rows = tokens(part.column("text"))
                row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
                for step in range(1, WINDOW + 1):
                    same = row[step:] == row[:-step]
                    left, right = bucket[:-step][same], bucket[step:][same]
                    for of, near in ((left, right), (right, left)):
                        for k in range(NONZERO):
                            np.add.at(total, of * DIMENSIONS + _PLACES[near, k], _SIGNS[near, k])
        total = total.reshape(BUCKETS, DIMENSIONS).astype(np.int64)
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(c) for c in total[used].T)], ["bucket", *names])

    schema = ", ".join(["bucket long", *(f"{n} long" for n in names)])
    sums = docs.select("text").mapInArrow(accumulate, schema).groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    vectors[sums["bucket"].to_numpy()] = sums[names].to_numpy(np.float32)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Context and index vector of each bucket side by side."""
    index = np.zeros_like(context)
    np.put_along_axis(index, _PLACES, _SIGNS, 1)
    return np.concatenate([context, index], 1)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of each row's word vectors, and the logarithm of their number."""
    bucket, rows = tokens(column)
    out = np.zeros((len(rows) - 1, 2 * vectors.shape[1] + 1), np.float32)
    for i, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)):
        if b > a:
            seen = vectors[bucket[a:b]]
            out[i, : vectors.shape[1]] = seen.mean(0)
            out[i, vectors.shape[1] : -1] = seen.std(0)
            out[i, -1] = np.log1p(b - a)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class QualityModel:
    """Word vectors, the network's parameters and the temperature."""

    vectors: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    parameters: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.parameters
        return np.tanh((features - self.center) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features).astype(np.float64) / self.temperature)


def train(vectors: np.ndarray, features: np.ndarray, labels: np.ndarray, seed: int = 0) -> QualityModel:
    """Fits the network by Adam on nine tenths of the rows and the temperature on the rest.

    Without rows the scores are 0.5; with one kind of label they tend towards it.
    """
    draw = np.random.default_rng(seed)
    width = 2 * vectors.shape[1] + 1
    if not len(labels):
        zeros = [np.zeros((width, 1), np.float32), np.zeros(1, np.float32), np.zeros(1, np.float32), np.zeros((), np.float32)]
        return QualityModel(vectors, np.zeros(width, np.float32), np.ones(width, np.float32), zeros)
    order = draw.permutation(len(labels))
    apart, fit = order[: len(order) // 10], order[len(order) // 10 :]
    center, scale = features[fit].mean(0), features[fit].std(0) + 1e-3
    p = [draw.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    first, second = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p]
    x, y, step = (features - center) / scale, labels.astype(np.float64), 0
    for _ in range(EPOCHS):
        fit = draw.permutation(fit)
        for at in range(0, len(fit), BATCH):
            rows = fit[at : at + BATCH]
            hidden = np.tanh(x[rows] @ p[0] + p[1])
            error = (_sigmoid(hidden @ p[2] + p[3]) - y[rows]) / len(rows)
            back = np.outer(error, p[2]) * (1 - hidden**2)
            grads = [x[rows].T @ back + DECAY * p[0], back.sum(0), hidden.T @ error + DECAY * p[2], error.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                p[i] = p[i] - RATE * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    model = QualityModel(vectors, center, scale, [np.asarray(v, np.float32) for v in p])
    if len(apart):
        logits, y = model.logits(features[apart]).astype(np.float64), y[apart]
        tried = np.geomspace(0.5, 8, 60)
        loss = [-np.mean(np.log(np.where(y == 1, _sigmoid(logits / t), 1 - _sigmoid(logits / t)) + 1e-12)) for t in tried]
        model.temperature = float(tried[int(np.argmin(loss))])
    return model


def fit_quality_model(docs: DataFrame, labelled: DataFrame, training_rows: int = TRAINING_ROWS) -> QualityModel:
    """Word vectors from all ``docs`` (``text``), the network from ``labelled`` (``doc_id, label``).

    Labels other than 0 and 1, and rows without text, are left out. The network learns
    from ``training_rows`` labelled documents on average, drawn by a hash of their id.
    """
    vectors = word_vectors(context_vectors(docs))
    usable = labelled.where("doc_id IS NOT NULL AND label IN (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    share = min(1.0, training_rows / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    # Its size is bounded by ``training_rows``.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").where("text IS NOT NULL")
    given = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = pooled(part.column("text"), given.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([f.tobytes() for f in found], pa.binary()), part.column("label")], ["doc_id", "features", "label"]
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    learned = rows.mapInArrow(features, f"doc_id {id_type}, features binary, label int").toPandas().sort_values(["doc_id", "label"])
    matrix = np.frombuffer(b"".join(learned["features"]), np.float32).reshape(len(learned), 2 * vectors.shape[1] + 1)
    return train(vectors, matrix, learned["label"].to_numpy())


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` of every whole text; a null text is scored as an empty one."""
    given = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                scores = given.value.scores(pooled(part.column("text"), given.value.vectors))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
