"""Language identification by nearest centroids of TF-IDF character n-grams.

Texts in lower case, all but letters as single spaces, give 1- to 3-grams hashed to ``FEATURES`` numbers. Document
frequencies come from all learning rows. Each language gets up to ``CLUSTERS`` centroids by spherical k-means over a
bounded sample of its rows (``SAMPLE_ROWS`` in all, shared by the languages, by hash of the id). The prediction is the
language of the centroid with the largest cosine; a document farther from it than all but ``REJECT`` of that centroid's
own sample is marked as rejected, and keeps the nearest language.

Cases: null texts and texts without a letter are `und` with score 0; very long texts count whole; repeated rows get
equal results; ties go to the language that sorts first; without learning rows all is `und`. An empty table gives an
empty result. Only id and text are read for a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import STATE_SCHEMA, crc_mod, state_rows, summed_states

FEATURES = 1 << 12
CLUSTERS = 4
SAMPLE_ROWS = 4096
REJECT = 0.01
SHARPNESS = 25.0
#: Odd multipliers that spread code points over 32 bits.
_FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def term_counts(text: str) -> np.ndarray | None:
    """Counts of a text's hashed n-grams; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    ok = _letters()[points]
    if not ok.any():
        return None
    points = np.where(ok, points, 32)
    keep = ok.copy()
    keep[1:] |= ok[:-1]  # of a run of others, the first stays as a space
    points = points[keep].astype(np.uint32)
    counts = np.zeros(FEATURES, np.int64)
    code = np.zeros(len(points), np.uint32)
    for n, factor in enumerate(_FACTORS):
        if n >= len(points):
            break
        code = code[: len(points) - n] * np.uint32(31) + points[n:] * np.uint32(factor)
        mixed = code ^ (code >> np.uint32(15))
        mixed = mixed * np.uint32(0x2C1B3C6D)
        counts += np.bincount(mixed >> np.uint32(20), minlength=FEATURES)
    return counts


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / max(np.linalg.norm(x), 1e-12)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray  # rows of unit length
    owner: np.ndarray  # place of each centroid's language
    least: np.ndarray  # cosine below which a centroid rejects

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        counts = None if text is None or not self.languages else term_counts(text)
        if counts is None:
            return "und", 0.0, True
        cosine = self.centroids @ _vector(counts, self.idf)
        best = np.array([cosine[self.owner == k].max() for k in range(len(self.languages))])
        k = int(np.argmax(best))
        odds = np.exp(SHARPNESS * (best - best[k]))
        near = int(np.argmax(np.where(self.owner == k, cosine, -2)))
        return self.languages[k], float(odds[k] / odds.sum()), bool(cosine[near] < self.least[near])


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from rows that lie far apart."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin((x @ x[chosen].T).max(1))))
    centres = x[chosen]
    for _ in range(rounds):
        nearest = np.argmax(x @ centres.T, axis=1)
        sums = np.array([x[nearest == j].sum(0) if (nearest == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres, np.argmax(x @ centres.T, axis=1)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from rows with a language whose crc32(doc_id) mod 3 isn't 1."""
    learn = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_mod("doc_id", 3) != 1))
    learn = learn.select(F.col("doc_id").cast("long").alias("_id"), F.col("lang").cast("string").alias("_lang"), F.col("text").cast("string").alias("text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts = term_counts(text)
                if counts is not None:
                    total[:-1] += counts > 0
                    total[-1] += 1
        yield from state_rows(total)

    total = summed_states(learn.select("text").mapInArrow(frequencies, STATE_SCHEMA), FEATURES + 1)
    idf = (np.log((1 + total[-1]) / (1 + total[:-1])) + 1).astype(np.float32)
    rows_of = {r["_lang"]: r["n"] for r in learn.groupBy("_lang").agg(F.count("_lang").alias("n")).collect()}
    languages = sorted(rows_of)
    if not languages:
        return Model(idf, [], np.zeros((0, FEATURES), np.float32), np.zeros(0, int), np.zeros(0))
    each = max(1, sample_rows // len(languages))
    order = Window.partitionBy("_lang").orderBy("_place", "_id")
    # The least places in hash order; a bound on the place, about twice the rows wanted, thins a large language before the shuffle.
    bounds = [(lang, int(min(1.0, 2 * each / n) * ((1 << 64) - 1)) - (1 << 63)) for lang, n in rows_of.items()]
    bounds = docs.sparkSession.createDataFrame([(lang, min(b, (1 << 63) - 1)) for lang, b in bounds], "_lang string, _bound long")
    placed = learn.select("_id", "_lang", F.xxhash64("_id", F.lit(3)).alias("_place"))
    few = placed.join(F.broadcast(bounds), "_lang").filter("_place <= _bound").select("_id", "_lang", "_place").distinct()
    some = few.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= each).select("_id", "_lang")
    # At most ``sample_rows`` rows of an id and a language.
    wanted = docs.sparkSession.createDataFrame(some.collect(), "_id long, _lang string")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [term_counts(t) for t in batch.column(2).to_pylist()]
            out = [None if c is None else _vector(c, idf).astype("<f4").tobytes() for c in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["_id", "_lang", "x"])

    sample = learn.join(F.broadcast(wanted), ["_id", "_lang"]).select("_id", "_lang", "text").mapInArrow(vectors, "_id long, _lang string, x binary")
    by_language: dict[str, list] = {}
    for row in sample.filter("x IS NOT NULL").toLocalIterator():
        by_language.setdefault(row["_lang"], []).append((row["_id"], bytes(row["x"])))
    centroids, owner, least = [], [], []
    languages = sorted(by_language)
    for k, language in enumerate(languages):
        x = np.array([np.frombuffer(v, "<f4") for _, v in sorted(by_language[language])])
        centres, nearest = _clusters(x, CLUSTERS)
        for j, centre in enumerate(centres):
            own = x[nearest == j] @ centre
            centroids.append(centre)
            owner.append(k)
            least.append(float(np.quantile(own, REJECT)) if len(own) else 1.0)
    return Model(idf, languages, np.array(centroids, np.float32).reshape(-1, FEATURES), np.array(owner, int), np.array(least))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row; one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.predict(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "lang_pred", "score", "rejected"])

    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document."""
    found = predict(docs, fit(docs))
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")
