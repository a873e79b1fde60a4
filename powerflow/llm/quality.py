"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network.

Every token has a sparse random index vector. A token's context vector is the sum of the index vectors around
all its occurrences in the whole corpus, summed by Spark. A document is the mean of its tokens' index and
context vectors. The network is trained with numpy on a bounded sample of labelled rows, and a temperature, fitted
on rows that the network did not see, calibrates its probabilities.

Tokens are hashed into a fixed number of buckets, so the vectors have one size for any corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.llm.bitmap import bitmap_of, may_be_in
from powerflow.llm.common import arrow_schema
from powerflow.llm.words import ALPHANUMERIC, NOT_BLANK, mix, pieces, split_words
from powerflow.operators.grouping import fact_join
from powerflow.session import written

BUCKET_BITS = 14
SHAPES = 72  # buckets kept for the shapes of words
DIMENSIONS = 32
NONZEROS = 2  # of an index vector
WINDOW = 2  # neighbours on either side
SAMPLE_ROWS = 20_000  # labelled rows that the network is trained and calibrated on
HIDDEN = 32
EPOCHS = 30
BATCH = 128
CALIBRATION = 5  # every so many-th row of the sample is for the temperature

_BUCKETS = 1 << BUCKET_BITS
# runs of letters and digits, and runs of other signs
_CLASSES = np.where(ALPHANUMERIC, 1, np.where(NOT_BLANK, 2, 0)).astype(np.uint8)
_CLASSES[65:91] = 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector."""
    bits = mix(np.arange(_BUCKETS * NONZEROS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
    bits = bits.reshape(_BUCKETS, NONZEROS)
    places = ((bits >> np.uint64(8)) % np.uint64(DIMENSIONS)).astype(np.int64)
    return places, np.where(bits & np.uint64(1), 1, -1)


@dataclass
class Tokens:
    bucket: np.ndarray
    shape: np.ndarray  # bucket of the token's shape
    first: np.ndarray  # index of each row's first token, one more than the rows


def tokens_of(column: pa.Array) -> Tokens:
    words = split_words(column, _CLASSES, lower=False)
    bucket = (words.hash >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    begin, last = words.data[words.start], words.data[words.end - 1]
    upper = ((begin >= 65) & (begin <= 90)).astype(np.int64) + ((last >= 65) & (last <= 90))
    digit = (begin >= 48) & (begin <= 57)
    sign = _CLASSES[begin] == 2
    again = np.zeros(len(bucket), dtype=bool)  # the token before is the same
    again[1:] = words.hash[1:] == words.hash[:-1]
    again[words.first[:-1][words.counts > 0]] = False
    kind = np.where(again, 5, np.where(sign, 4, np.where(digit, 3, upper)))
    length = np.minimum((words.end - words.start) // 2, 11)
    return Tokens(bucket, _BUCKETS - SHAPES + kind * 12 + length, words.first)


def context_sums(documents: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vector of each bucket over all documents; one row for a bucket and task is shuffled."""
    names = [f"v{i}" for i in range(DIMENSIONS)]
    schema = "bucket int, " + ", ".join(f"{name} long" for name in names)
    arrow = arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(_BUCKETS * DIMENSIONS, dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                tokens = tokens_of(piece.column("text"))
                row = np.repeat(np.arange(piece.num_rows), np.diff(tokens.first))
                for step in range(1, WINDOW + 1):
                    near = row[step:] == row[:-step]
                    left, right = tokens.bucket[:-step][near], tokens.bucket[step:][near]
                    for own, other in ((left, right), (right, left)):
                        for i in range(NONZEROS):
                            np.add.at(sums, own * DIMENSIONS + places[other, i], signs[other, i])
        table = sums.reshape(_BUCKETS, DIMENSIONS)
        used = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(used.astype(np.int32)), *[pa.array(np.ascontiguousarray(table[used, i])) for i in range(DIMENSIONS)]]
        yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    summed = documents.select(text).mapInArrow(count, schema).groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])
    found = summed.toArrow()  # a row for each bucket at most
    vectors = np.zeros((_BUCKETS, DIMENSIONS))
    for i, name in enumerate(names):
        vectors[found["bucket"].to_numpy(), i] = found[name].to_numpy()
    return vectors


def word_vectors(contexts: np.ndarray) -> np.ndarray:
    """Index and context vectors of each bucket side by side, contexts at unit length."""
    places, signs = index_vectors()
    index = np.zeros((_BUCKETS, DIMENSIONS))
    for i in range(NONZEROS):
        np.add.at(index, (np.arange(_BUCKETS), places[:, i]), signs[:, i])
    length = np.linalg.norm(contexts, axis=1, keepdims=True)
    return np.hstack([index, contexts / np.maximum(length, 1)]).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean of the vectors of each text's tokens and, beside it, of their shapes; zeros without tokens."""
    out = np.zeros((len(column), vectors.shape[1] + DIMENSIONS), dtype=np.float32)
    done = 0
    for piece in pieces(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
        tokens = tokens_of(piece.column("text"))
        counts = np.diff(tokens.first)
        on = np.flatnonzero(counts)
        if len(on):
            begins = tokens.first[on]
            own = out[done : done + piece.num_rows]
            width = vectors.shape[1]
            own[on, :width] = np.add.reduceat(vectors[tokens.bucket], begins, axis=0) / counts[on, None]
            own[on, width:] = np.add.reduceat(vectors[tokens.shape, :DIMENSIONS], begins, axis=0) / counts[on, None]
        done += piece.num_rows
    return out


@dataclass
class Network:
    """Two layers; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    z = logits / temperature
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network | None:
    """Network for rows in a fixed order, or None without rows. Equal rows give an equal network."""
    if not len(y):
        return None
    rng = np.random.default_rng(seed)
    x, y = x.astype(np.float64), y.astype(np.float64)
    held = np.arange(len(y)) % CALIBRATION == 0 if len(y) >= 10 * CALIBRATION else np.zeros(len(y), dtype=bool)
    fit_x, fit_y = x[~held], y[~held]
    net = Network(
        fit_x.mean(axis=0), fit_x.std(axis=0) + 1e-3,
        rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, (2 / HIDDEN) ** 0.5, HIDDEN), 0.0,
    )
    z = (fit_x - net.mean) / net.scale
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    epochs = max(EPOCHS, min(20 * EPOCHS, EPOCHS * 2000 // len(fit_y)))
    for _ in range(epochs):
        order = rng.permutation(len(fit_y))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            bx, by = z[rows], fit_y[rows]
            pre = bx @ weights[0] + weights[1]
            hidden = np.maximum(pre, 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3][0], -30, 30)))
            error = (p - by) / len(rows)
            back = np.outer(error, weights[2]) * (pre > 0)
            grads = [bx.T @ back + 1e-4 * weights[0], back.sum(axis=0), hidden.T @ error + 1e-4 * weights[2], np.array([error.sum()])]
            step += 1
            for i, grad in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                rate = 2e-3 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                weights[i] = weights[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if held.any():
        logits = net.logits(x[held])
        options = np.geomspace(0.25, 8, 61)
        net.temperature = float(min(options, key=lambda t: _loss(logits, y[held], t)))
    return net


def fit(
    documents: DataFrame, labels: DataFrame, wanted: Column, vectors: np.ndarray, sample_rows: int = SAMPLE_ROWS
) -> Network | None:
    """Network from at most ``sample_rows`` labelled rows, those whose ids have the smallest hashes.

    ``wanted`` is a condition on ``doc_id`` that labels used for learning fulfil.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vectors)

    @F.arrow_udf("array<float>")
    def features(column: pa.Array) -> pa.Array:
        values = pooled(column, shared.value)
        return pa.array(list(values), pa.list_(pa.float32()))

    known = labels.filter(wanted & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    hashed = known.select("doc_id", F.col("quality").cast("int").alias("quality"), F.xxhash64("doc_id").alias("place"))
    sample = written(hashed.orderBy("place", "doc_id", "quality").limit(sample_rows), "quality-sample")
    texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    near = texts.withColumn("place", F.xxhash64("doc_id")).filter(may_be_in(F.col("place"), bitmap_of(sample, "place")))
    near = near.select("doc_id", "place", features("text").alias("features"))
    rows = fact_join(near, sample, ["doc_id", "place"], "inner")
    rows = rows.orderBy("place", "doc_id", "quality", F.xxhash64("features")).limit(2 * sample_rows)
    found = rows.select("quality", "features").toArrow()
    if not found.num_rows:
        return None
    x = np.array(found["features"].to_pylist(), dtype=np.float32)
    return train(x, found["quality"].to_numpy())


def quality_score(
    documents: DataFrame, labels: DataFrame, wanted: Column, sample_rows: int = SAMPLE_ROWS
) -> Column:
    """Probability of a good text as a column over ``text`` of the documents.

    Texts without tokens, NULL ones among them, get the network's answer to a zero vector. Without any labelled row every
    score is 0.5. The vectors (a few MB) and the network are all that is broadcast.
    """
    vectors = word_vectors(context_sums(documents))
    net = fit(documents, labels, wanted, vectors, sample_rows)
    model = documents.sparkSession.sparkContext.broadcast((vectors, net))

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        own_vectors, own_net = model.value
        if own_net is None:
            return pa.array(np.full(len(column), 0.5))
        return pa.array(own_net.probabilities(pooled(column, own_vectors)))

    return score(F.coalesce(F.col("text").cast("string"), F.lit("")))
