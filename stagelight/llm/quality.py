"""Quality by supervised subword embeddings.

Every word and character n-gram of a text is hashed to a row of a table of learned vectors; their mean is the document,
a softmax over two classes its quality. Vectors and softmax are trained with stochastic gradient descent in numpy, on a
bounded sample of labelled documents whose n-gram counts Spark computes. Scoring is one pass over every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import in_pieces, keyed_text, ship, stored
from stagelight.llm.text_arrays import BYTE_VALUE, GOLDEN, Block, mixed
from stagelight.plans.shared import scratch

U64 = np.uint64


@dataclass(frozen=True)
class Shape:
    """Parameters of features and training."""

    buckets_bits: int = 15
    gram_sizes: tuple[int, ...] = (2, 3, 4)  # bytes of a character n-gram; case counts
    dims: int = 8
    epochs: int = 6
    rate: float = 0.3
    max_rows: int = 6_000  # labelled documents that training reads
    seed: int = 5


def features(texts: list[str], shape: Shape) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and document of every n-gram of every text: words, word pairs, then each size of character n-gram.

    A pair is hashed by the difference of its words' hashes, so that all pairs of a repeated word share a bucket.
    """
    block = Block([t.encode() for t in texts])
    shift = U64(64 - shape.buckets_bits)
    starts, ends, docs = block.words()
    words = block.span_hashes(starts, ends, lower=False)
    yield (words >> shift).astype(np.int32), docs
    pair = docs[1:] == docs[:-1]
    yield (mixed(words[1:] - words[:-1] + GOLDEN)[pair] >> shift).astype(np.int32), docs[1:][pair]
    values = BYTE_VALUE[block.buffer]
    owner = np.repeat(np.arange(block.count), block.ends - block.starts + 1)
    for size in shape.gram_sizes:
        if len(values) < size:
            continue
        runs = len(values) - size + 1
        hashes = np.full(runs, mixed(np.full(1, size, dtype=U64))[0])
        for k in range(size):
            hashes = hashes * U64(0x100000001B3) + values[k : k + runs]
        # An n-gram ends before the line feed that ends its document.
        inside = np.arange(size, runs + size) <= block.ends[owner[:runs]]
        yield (mixed(hashes[inside]) >> shift).astype(np.int32), owner[:runs][inside]


def _counts(texts: DataFrame, shape: Shape) -> DataFrame:
    """label, buckets (16-bit) and shares (32-bit floats): the distinct buckets of a document and how much each counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << shape.buckets_bits
        for batch in batches:
            for piece in in_pieces(batch, limit=1 << 20):
                cells = [d * size + b for b, d in features(piece.column("text").to_pylist(), shape)]
                cells, counts = np.unique(np.concatenate(cells), return_counts=True)
                bounds = np.searchsorted(cells, np.arange(piece.num_rows + 1) * size)
                buckets, shares = [], []
                for a, b in zip(bounds, bounds[1:], strict=False):
                    buckets.append((cells[a:b] % size).astype(np.uint16).tobytes())
                    shares.append((counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("label"), pa.array(buckets, pa.binary()), pa.array(shares, pa.binary())],
                    names=["label", "buckets", "shares"],
                )

    return texts.mapInArrow(run, "label int, buckets binary, shares binary")


@dataclass
class Model:
    """The learned vectors and softmax, folded: the mean of vectors times weights is the mean of one number a bucket."""

    shape: Shape
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def gains(self) -> np.ndarray:
        """Per bucket what it adds to the difference of the two classes."""
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float64)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of class 1 per text."""
        gains, sums, counts = self.gains(), np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, docs in features(texts, self.shape):
            sums += np.bincount(docs, weights=gains[buckets], minlength=len(texts))
            counts += np.bincount(docs, minlength=len(texts))
        margin = sums / np.maximum(counts, 1) + (self.bias[1] - self.bias[0])
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], shape: Shape) -> Model:
    """Stochastic gradient descent over (label, buckets, shares), one document at a time, with a falling rate.

    Without rows the model gives 0.5 to every text.
    """
    random = np.random.default_rng(shape.seed)
    vectors = random.uniform(-1, 1, (1 << shape.buckets_bits, shape.dims)).astype(np.float32) / shape.dims
    weights, bias = np.zeros((2, shape.dims), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = max(1, shape.epochs * len(rows)), 0
    for _ in range(shape.epochs):
        for k in random.permutation(len(rows)):
            label, buckets, shares = rows[k]
            rate = shape.rate * (1 - done / steps)
            done += 1
            mean = shares @ vectors[buckets]
            raised = weights @ mean + bias
            odds = np.exp(raised - raised.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = error @ weights
            weights -= rate * np.outer(error, mean)
            bias -= rate * error
            # The mean spreads a step over all n-grams; scaling by the count keeps it as large for long texts.
            vectors[buckets] -= rate * min(len(buckets), 64) * np.outer(shares, back)
    return Model(shape, vectors, weights, bias)


def fit(docs: DataFrame, labels: DataFrame, learn_from, shape: Shape = Shape()) -> Model:
    """Train on at most ``shape.max_rows`` labelled documents that ``learn_from`` (a condition on the id) admits.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality. The sample is chosen by a hash of the id; rows without
    an id, text or label are left out, and of contradicting labels the larger holds. Spark counts the n-grams of the
    sampled texts; the driver receives at most one entry per document and bucket.
    """
    ship(docs.sparkSession)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn_from(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(shape.max_rows)
    )
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("label").alias("label"))
    with scratch(docs.sparkSession):
        counts = _counts(sample.select("text", "label"), shape).withColumn("mark", F.xxhash64("buckets", "shares"))
        rows = [
            (row["label"], np.frombuffer(row["buckets"], np.uint16), np.frombuffer(row["shares"], np.float32))
            for row in stored(counts, "grams").orderBy("mark", "label").toLocalIterator()  # max_rows of bounded size
        ]
    return train(rows, shape)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1, the probability of quality 1).

    Null and empty texts score by the class shares alone. Equal texts score alike; an empty table gives an empty
    result; other columns are not read. Whole texts are read. No shuffle.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # of the size that its shape sets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in in_pieces(batch, limit=1 << 20):
                scores = shared.value.scores(piece.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
