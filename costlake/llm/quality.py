"""Quality by nearest-neighbour voting among labelled documents in a latent-semantic space.

A document is a bag of style terms: the shapes of its words (runs of letters and digits collapsed,
punctuation kept) alone and in pairs, marks for words that repeat, and bands of its length, of its
distinct words and of its repeated lines. Term weights are reduced to a few latent dimensions by a
singular value decomposition. The vectors of a bounded number of labelled documents are broadcast,
every document takes cosine products with all of them, in blocks, and the nearest vote by similarity.

Edge cases: a null or empty text has the term of the empty document only; without labelled rows every
score is 0.5; documents without a label are scored but not learnt from; ties in similarity are broken
by the order of the labelled rows; repeated rows are scored alike and each is returned; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import bounded_rows, fold, ship_package
from costlake.llm.words import utf8

TERMS, DIMENSIONS, NEIGHBOURS = 512, 48, 15
#: Labelled rows that are broadcast at most: this many vectors of DIMENSIONS floats, under 2 MB.
MOST_LABELLED = 8_000
#: Votes weigh similarity to this power.
SHARPNESS = 8
BLOCK = 512
SEED = 20240610

_CLASS = bytearray(range(256))
for _c in range(256):
    if 97 <= _c <= 122 or _c >= 128:
        _CLASS[_c] = ord("a")
    elif 65 <= _c <= 90:
        _CLASS[_c] = ord("A")
    elif 48 <= _c <= 57:
        _CLASS[_c] = ord("0")
_CLASS = bytes(_CLASS)
_RUN = re.compile(rb"([^\s])\1+")


def terms(text: bytes) -> np.ndarray:
    """Weights of the hashed style terms of one text."""
    weights = np.zeros(TERMS, dtype=np.float32)

    def add(name: bytes, weight: float) -> None:
        weights[crc32(name) % TERMS] += weight

    words = text.lower().split()
    if not words:
        add(b"empty", 1.0)
        return weights
    n = len(words)
    shapes = _RUN.sub(rb"\1", text.translate(_CLASS)).split()
    for shape, count in Counter(shapes).items():
        add(b"1" + shape[:8], count / n)
    for (a, b), count in Counter(zip(shapes, shapes[1:])).items():
        add(b"2" + a[:8] + b" " + b[:8], count / n)
    add(b"same", 3 * sum(map(bytes.__eq__, words, words[1:])) / n)
    add(b"distinct%d" % int(10 * len(set(words)) / n), 0.5)
    add(b"size%d" % int(math.log2(n)), 0.5)
    lines = [line for line in text.split(b"\n") if line.strip()]
    add(b"lines%d" % int(4 * len(set(lines)) / len(lines)), 0.5)
    return np.sqrt(weights)


class Voters:
    """The fitted space and the labelled vectors in it."""

    def __init__(self, raw: np.ndarray, labels: np.ndarray):
        held = (raw > 0).sum(axis=0)
        self.idf = np.log((1 + len(raw)) / (1 + held)).astype(np.float32) + 1
        scaled = self.unit(raw * self.idf)
        # Right singular vectors from the small term-by-term matrix.
        _, vectors = np.linalg.eigh(scaled.T.astype(np.float64) @ scaled)
        self.basis = vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32)
        self.vectors = self.unit(scaled @ self.basis)
        self.labels = labels.astype(np.float32)

    @staticmethod
    def unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def score(self, raw: np.ndarray) -> np.ndarray:
        latent = self.unit(self.unit(raw * self.idf) @ self.basis)
        k = min(NEIGHBOURS, len(self.labels))
        out = np.empty(len(raw))
        for start in range(0, len(raw), BLOCK):
            cosines = latent[start : start + BLOCK] @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.clip(np.take_along_axis(cosines, near, axis=1), 1e-6, 1.0).astype(np.float64) ** SHARPNESS
            out[start : start + BLOCK] = (votes * self.labels[near]).sum(axis=1) / votes.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _raw(documents: DataFrame) -> DataFrame:
    """Term weights of each row as bytes, for the labelled sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms(utf8(t.as_py())).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())],
                names=["doc_id", "label", "terms"],
            )

    return documents.mapInArrow(run, "doc_id long, label int, terms binary")


def fit(documents: DataFrame, labels: DataFrame, learn_from: Column | None = None, most: int = MOST_LABELLED) -> Voters | None:
    """The voters from at most about ``most`` labelled rows, chosen by a hash of their id; None
    without any. ``labels`` is (doc_id, label 0/1)."""
    wanted = labels.filter(learn_from if learn_from is not None else F.lit(True)).filter("label in (0, 1)")
    sample = bounded_rows(wanted, F.col("doc_id"), most, SEED).select(
        F.col("doc_id").alias("__id"), F.col("label").cast("int").alias("label")
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = _raw(texts.join(sample, F.col("doc_id") == F.col("__id")).select("doc_id", "label", "text"))
    table = rows.toArrow().sort_by([("doc_id", "ascending")])
    if not table.num_rows:
        return None
    raw = np.stack([np.frombuffer(t.as_buffer(), dtype=np.float32) for t in table.column("terms")])
    return Voters(raw, table.column("label").to_numpy())


def score(documents: DataFrame, labels: DataFrame, learn_from: Column | None = None, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, score) of every row of ``documents``."""
    spark = documents.sparkSession
    ship_package(spark)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    voters = fit(documents, labels, learn_from, most)
    if voters is None:
        return texts.select("doc_id", F.lit(0.5).alias("score"))
    shared = spark.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                raw = np.stack([terms(utf8(t.as_py())) for t in part.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(known.score(raw), pa.float64())], names=["doc_id", "score"]
                )

    return texts.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 5) == 0
