"""Importance resampling toward a target collection by hashed n-grams of words.

Every run of one to three words is a feature, hashed into a fixed number of buckets. A bucket's gain is
the smoothed log ratio of its share in the target texts and in the documents; a document's weight is
the sum over its features. A seeded Gumbel value per document id is added, and the highest scores are
drawn: a sample without replacement in proportion to the weights.

Features are counted batch by batch: the texts are joined with a sentinel, one regex pass finds all
words and sentinels, and n-grams whose ends a search in the sentinels' places puts into different
documents are left out before the buckets are counted. The CRC-32 of an n-gram is made of those of its
words, as CRC-32 is linear, so no n-gram is ever written out.

Words are runs of 0-9, a-z (A-Z are lower-cased) and characters beyond ASCII.

Edge cases: a null or empty text has no feature, weight 0, and is never drawn, as are documents of fewer
than ``least_words`` words; a null id takes the random value of an empty id and comes before other ids
among ties; rows that agree in all columns share a score and get adjacent ranks; an empty table gives an
empty result; an empty target leaves every gain to the smoothing; other columns are kept by
``resample`` and ignored elsewhere; a NUL in a text only ends a word, as it does anyway.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import positions, ship_package, stored
from costlake.llm.words import blocks, utf8

BUCKETS = 10_000
LONGEST = 3
SHARE_PERCENT = 5
LEAST_WORDS = 20
SEED = "42"
#: Longer words are shifted in steps; only the size of a table depends on it.
TABLE_LENGTH = 64

_SENTINEL = b"\0"
_TOKEN = re.compile(rb"\x00|[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_SHIFTS: list[np.ndarray] = []


def _shift_tables() -> np.ndarray:
    """[length, byte, value]: what ``length`` zero bytes more make of a CRC-32 with that byte in it."""
    if not _SHIFTS:
        one = np.array([crc32(bytes([i])) for i in range(256)], dtype=np.uint32) ^ np.uint32(crc32(b"\0"))
        tables = np.zeros((TABLE_LENGTH + 1, 4, 256), dtype=np.uint32)
        for byte in range(4):
            tables[0, byte] = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
        for length in range(1, TABLE_LENGTH + 1):
            last = tables[length - 1]
            tables[length] = (last >> np.uint32(8)) ^ one[last & np.uint32(255)]
        _SHIFTS.append(tables)
    return _SHIFTS[0]


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The part of a CRC-32 of A + B that is due to A: its CRC-32 moved over the bytes of B."""
    tables = _shift_tables()
    out, left = crc, length
    while True:
        step = np.minimum(left, TABLE_LENGTH)
        out = (
            tables[step, 0, out & np.uint32(255)]
            ^ tables[step, 1, (out >> np.uint32(8)) & np.uint32(255)]
            ^ tables[step, 2, (out >> np.uint32(16)) & np.uint32(255)]
            ^ tables[step, 3, out >> np.uint32(24)]
        )
        left = left - step
        if not left.any():
            return out


def features(texts: list[bytes], buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, texts, words of each, document of each feature, bucket of each feature) for runs of texts."""
    for start, end in blocks(texts):
        joined = _SENTINEL.join(t.replace(_SENTINEL, b" ") for t in texts[start:end]).lower()
        found = _TOKEN.findall(joined)
        crc = np.fromiter(map(crc32, found), dtype=np.uint32, count=len(found))
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        # No word begins with the sentinel, and none has the sentinel's hash and its length of one.
        sentinel = np.flatnonzero((size == 1) & (crc == np.uint32(crc32(_SENTINEL))))
        word = np.ones(len(found), dtype=bool)
        word[sentinel] = False
        crc, size, place = crc[word], size[word], np.flatnonzero(word)
        document = np.searchsorted(sentinel, place)
        words = np.bincount(document, minlength=end - start)
        spaced = shifted(np.full(len(crc), crc32(b" "), dtype=np.uint32), size) ^ crc
        owners, hashes, last = [document], [crc], crc
        for n in range(2, LONGEST + 1):
            last = shifted(last[:-1], size[n - 1 :] + 1) ^ spaced[n - 1 :]
            inside = document[n - 1 :] == document[: max(len(document) - n + 1, 0)]
            owners.append(document[n - 1 :][inside])
            hashes.append(last[inside])
        bucket = np.concatenate(hashes) % np.uint32(buckets)
        yield start, end - start, words, np.concatenate(owners), bucket


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [utf8(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def bucket_counts(documents: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, features) over all texts; a task adds its batches up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for *_, bucket in features(_texts(batch), buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "features"])

    ship_package(documents.sparkSession)
    counted = documents.select("text").mapInArrow(run, "bucket long, features long")
    return counted.groupBy("bucket").agg(F.sum("features").alias("features"))


def gains(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket, in thousandths. ``buckets`` numbers of each side come to the driver."""
    sides = []
    for side in (documents, target):
        counts = np.zeros(buckets, dtype=np.int64)
        for row in bucket_counts(side, buckets).collect():
            counts[row["bucket"]] = row["features"]
        sides.append(counts.tolist())
    raw, wanted = sides
    all_raw, all_wanted = sum(raw), sum(wanted)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_raw + buckets) / ((s + 1) * (all_wanted + buckets))))
            for s, t in zip(raw, wanted)
        ],
        dtype=np.int64,
    )


def with_scores(documents: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """``documents`` with a column ``importance``: n_words, n_features, weight, score."""
    gain = gains(documents, target, buckets)
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            texts = [utf8(t) for t in batch.column(place).to_pylist()]
            for start, size, found, owner, bucket in features(texts, buckets):
                here = slice(start, start + size)
                words[here] = found
                count[here] = np.bincount(owner, minlength=size)
                weight[here] = np.bincount(owner, gain[bucket], size).astype(np.int64)
            parts = [pa.array(words), pa.array(count), pa.array(weight)]
            added = pa.StructArray.from_arrays(parts, ["n_words", "n_features", "weight"])
            yield pa.RecordBatch.from_arrays([*batch.columns, added], names)

    added = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")])
    kept = [T.StructField(f.name, f.dataType) for f in documents.schema if f.name != "importance"]
    names = [f.name for f in kept] + ["importance"]
    place = names.index("text")
    weighed = documents.drop("importance").mapInArrow(run, T.StructType([*kept, T.StructField("importance", added)]))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000) * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0))))
    return weighed.withColumn(
        "importance", F.col("importance").withField("score", F.col("importance.weight") + noise)
    )


def _best_first() -> list:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("weight").desc(), F.col("n_features")]


def ranks(
    documents: DataFrame,
    target: DataFrame,
    percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: str = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document; ``rank`` is null where a
    document is not among the ``percent`` highest scores of the documents with enough words.

    The order is over all documents, but no task sees them all: rows are dealt by ranges of the order
    and written, then each range is ranked from the number of rows in the ranges before it.
    """
    narrow = documents.select("doc_id", "text")
    scored = stored(
        with_scores(narrow, target, buckets, seed).select("doc_id", "importance.*"), "importance-scores"
    )
    enough = F.col("n_words") >= least_words
    draw = percent * scored.filter(enough).count() // 100
    ordered = positions(scored.filter(enough), _best_first(), "place", "importance-order")
    ranked = ordered.withColumn("rank", F.when(F.col("place") < draw, F.col("place") + 1))
    return ranked.select(*scored.columns, "rank").unionByName(
        scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    )


def resample(documents: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn rows of ``documents``, all columns, in no order. Rows that agree in id and text with one
    another are drawn together when the last place falls among them."""
    options = {k: settings[k] for k in ("buckets", "seed") if k in settings}
    drawn = ranks(documents, target, **settings).filter("rank is not null")
    last = drawn.orderBy(F.col("rank").desc()).select("score", "doc_id", "weight", "n_features").first()
    scored = with_scores(documents.withColumnRenamed("importance", "__importance"), target, **options)
    own = F.struct(
        -F.col("importance.score"), F.coalesce("doc_id", F.lit(-(1 << 63))),
        -F.col("importance.weight"), "importance.n_features",
    )
    if last is None:
        return documents.limit(0)
    least_id = -(1 << 63) if last["doc_id"] is None else last["doc_id"]
    limit = F.struct(
        *[F.lit(v).cast("long") for v in (-last["score"], least_id, -last["weight"], last["n_features"])]
    )
    least_words = settings.get("least_words", LEAST_WORDS)
    kept = scored.filter((F.col("importance.n_words") >= least_words) & (own <= limit)).drop("importance")
    return kept.withColumnRenamed("__importance", "importance").select(*documents.columns)
