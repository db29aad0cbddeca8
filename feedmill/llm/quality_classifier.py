"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Each word has a sparse random index vector that its hash fixes. Over all documents, a word's context vector adds up the
index vectors of its neighbours; words share ``BUCKETS`` rows by hash, so the vectors have a fixed size. A document is
the mean and the spread of its words' vectors. A network with one hidden layer is trained in numpy on a bounded sample
of labelled rows (``TRAIN_ROWS``, by hash of the id); a held-back share of that sample calibrates its temperature.

Cases: null and empty texts have zero vectors and get the network's score for them; very long texts are pooled whole;
repeated rows get equal scores; unlabelled or conflicting rows don't disturb (each label row counts as it is); without
any label of one kind the score is the share of label 1, or 0.5 if there is no label at all. An empty table gives an
empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import STATE_SCHEMA, crc_mod, state_rows, summed_states, text_of

BUCKETS = 1 << 14
DIMENSIONS = 32
NON_ZERO = 4
REACH = 2
TRAIN_ROWS = 20_000
HIDDEN = 24
SEED = 7
THRESHOLD = 0.3


def _words(text: str) -> np.ndarray:
    """Buckets of a text's words."""
    split = text.encode().split()
    return np.fromiter(map(zlib.crc32, split), np.uint32, len(split)) & (BUCKETS - 1)


def index_vectors() -> np.ndarray:
    """Sparse ternary index vectors of all buckets."""
    random = np.random.default_rng(SEED)
    vectors = np.zeros((BUCKETS, DIMENSIONS), np.int8)
    for row in vectors:
        row[random.choice(DIMENSIONS, NON_ZERO, replace=False)] = random.choice([-1, 1], NON_ZERO)
    return vectors


def context_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vectors of all buckets, from all documents; of unit length, zero for words that never occur."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = index_vectors()
        places = np.argsort(vectors == 0, axis=1, kind="stable")[:, :NON_ZERO]
        signs = np.take_along_axis(vectors, places, 1).astype(np.float64)
        total = np.zeros(BUCKETS * DIMENSIONS, np.float64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = _words(text)
                base = words.astype(np.int64) * DIMENSIONS
                at, weight = [], []
                for step in range(1, REACH + 1):
                    for one, other in ((base[step:], words[:-step]), (base[:-step], words[step:])):
                        at.append((one[:, None] + places[other]).ravel())
                        weight.append(signs[other].ravel())
                at, weight = np.concatenate(at), np.concatenate(weight)
                if len(at) > BUCKETS:
                    total += np.bincount(at, weight, len(total))
                else:
                    np.add.at(total, at, weight)
        yield from state_rows(total.astype(np.int64))  # sums of ones: exact

    total = summed_states(docs.select(text_of(text_col).alias("text")).mapInArrow(gather, STATE_SCHEMA), BUCKETS * DIMENSIONS)
    total = total.reshape(BUCKETS, DIMENSIONS).astype(np.float64)
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(norm == 0, 1, norm)).astype(np.float32)


def _pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the words' vectors, log word count, and how alike neighbouring words' vectors are."""
    out = np.zeros((len(texts), 2 * DIMENSIONS + 4))
    for k, text in enumerate(texts):
        words = _words(text)
        if len(words):
            count = np.bincount(words, minlength=BUCKETS) if len(words) > BUCKETS else None
            if count is None:
                rows = vectors[words]
                mean, square = rows.mean(0, np.float64), (rows * rows).mean(0, np.float64)
            else:
                mean, square = count @ vectors / len(words), count @ (vectors * vectors) / len(words)
            out[k, :DIMENSIONS], out[k, DIMENSIONS:-4] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
            same = words[1:] == words[:-1]
            near = np.einsum("ij,ij->i", vectors[words[1:]], vectors[words[:-1]]) if len(words) > 1 else np.zeros(1)
            out[k, -4:] = np.log1p(len(words)), np.linalg.norm(mean), near.mean(dtype=np.float64), same.mean() if len(same) else 0
    return out


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray, steps: int = 600, rate: float = 0.01, decay: float = 1e-4) -> Network:
    """Adam on the whole sample; every fifth row is held back for the temperature."""
    random = np.random.default_rng(SEED)
    wide = x.shape[1] if x.ndim == 2 else 2 * DIMENSIONS + 4
    flat = np.zeros(wide), np.ones(wide), np.zeros((wide, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN)
    if len(y) < 10 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(*flat, float(np.log(share / (1 - share))))
    held = np.arange(len(y)) % 5 == 4
    xt, yt = x[~held], y[~held].astype(np.float64)
    centre, scale = xt.mean(0), xt.std(0) + 1e-6
    z = (xt - centre) / scale
    p = [random.normal(0, wide**-0.5, (wide, HIDDEN)), np.zeros(HIDDEN), random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for t in range(1, steps + 1):
        h = np.tanh(z @ p[0] + p[1])
        d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - yt) / len(yt)
        dh = np.outer(d, p[2]) * (1 - h * h)
        for k, g in enumerate([z.T @ dh + decay * p[0], dh.sum(0), h.T @ d + decay * p[2], np.array([d.sum()])]):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - rate * m[k] / (1 - 0.9**t) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    plain = Network(centre, scale, p[0], p[1], p[2], float(p[3][0]))
    logits, yh = plain.logits(x[held]), y[held].astype(np.float64)
    temperature = min(np.geomspace(0.3, 5, 57), key=lambda t: _loss(logits / t, yh))
    return Network(centre, scale, p[0], p[1], p[2], float(p[3][0]), float(temperature))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents and a network from at most ``rows`` labelled ones that aren't held out."""
    vectors = context_vectors(docs)
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).filter("_y IN (0, 1)").filter(crc_mod("_id", 5) != 0)
    # The join's table has at most ``rows`` rows of two numbers.
    some = marked.orderBy(F.xxhash64("_id", F.lit(SEED)), "_id", "_y").limit(rows)
    wanted = spark.createDataFrame(some.collect(), "_id long, _y int")

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _pooled(batch.column(2).to_pylist(), vectors)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["_id", "y", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), text_of().alias("text"))
    sample = texts.join(F.broadcast(wanted), "_id").select("_id", F.col("_y").alias("y"), "text")
    got = sample.mapInArrow(pool, "_id long, y int, x binary").toPandas()
    got = got.sort_values(["_id", "y", "x"])
    x = np.array([np.frombuffer(v) for v in got["x"]]).reshape(len(got), 2 * DIMENSIONS + 4)
    place = np.argsort([zlib.crc32(str(k).encode() + b"order") for k in got["_id"]], kind="stable")
    return vectors, train(x[place], got["y"].to_numpy()[place])


def score(docs: DataFrame, vectors: np.ndarray, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = network.scores(_pooled(batch.column(1).to_pylist(), vectors))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return df.mapInArrow(run, "doc_id long, score double")


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    vectors, network = fit(docs, labels)
    scored = score(docs, vectors, network)
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with the columns they came with."""
    vectors, network = fit(docs, labels)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(names.index("text")).to_pylist()]
            yield batch.filter(pa.array(network.scores(_pooled(texts, vectors)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
