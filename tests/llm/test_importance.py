"""Importance resampling against a plain count of every n-gram."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import brute
import numpy as np
import pytest
from conftest import SF_DIR
from test_edges import TEXTS, docs, none  # noqa: F401

from costlake.llm import importance
from costlake.llm.queries import REGISTERED

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BUCKETS = 10_000


def grams(text):
    words = WORD.findall(brute.lower_ascii(text))
    return words, [crc32(" ".join(words[i : i + n]).encode()) % BUCKETS for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def expected(texts, target, percent=5, least=20):
    """Rows (doc_id, n_features, weight, score, rank); rows of one id and text count one by one."""
    found = [(d, *grams(t)) for d, t in texts]
    raw = Counter(b for *_, buckets in found for b in buckets)
    wanted = Counter(b for t in target for b in grams(t)[1])
    all_raw, all_wanted = sum(raw.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (all_raw + BUCKETS) / ((raw[b] + 1) * (all_wanted + BUCKETS))))
        for b in range(BUCKETS)
    ]
    rows = []
    for d, words, buckets in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append((d, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, -r[2], r[1]))
    drawn = able[: percent * len(able) // 100]
    ranked = [(*r[:4], i + 1) for i, r in enumerate(drawn)]
    left = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return sorted(ranked + [(*r, None) for r in left.elements()], key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = REGISTERED["op13_importance"](spark, folder)
    assert dict(found.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert rows(found) == expected(texts, target)


def test_edges(spark, docs, none):  # noqa: F811
    target = spark.createDataFrame([("the quick brown fox", 1), (None, 2), ("", 3)], "text string, item_id long")
    found = importance.ranks(docs, target, percent=40, least_words=4)
    assert rows(found) == expected([t[:2] for t in TEXTS], ["the quick brown fox"], 40, 4)
    assert importance.ranks(none, target).count() == 0 and importance.resample(none, target).count() == 0
    empty = target.limit(0)
    assert rows(importance.ranks(docs, empty, percent=40, least_words=4)) == expected([t[:2] for t in TEXTS], [], 40, 4)


def test_drawn_documents_keep_all_their_columns(spark, docs):  # noqa: F811
    target = spark.createDataFrame([("lazy dog",)], "text string")
    named = docs.withColumn("importance", docs["n_chars"]).withColumn("score", docs["size"])
    drawn = importance.resample(named, target, percent=50, least_words=1)
    assert drawn.columns == named.columns
    picked = importance.ranks(named, target, percent=50, least_words=1).filter("rank is not null")
    assert sorted(r.doc_id or 0 for r in drawn.collect()) == sorted(r.doc_id or 0 for r in picked.collect())


def test_hashes_of_joined_words_equal_those_of_the_text():
    rng = np.random.default_rng(2)
    sizes = rng.choice([1, 2, 5, 63, 64, 65, 200, 1000], 400)
    words = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in sizes]
    crc = np.array([crc32(w) for w in words], dtype=np.uint32)
    joined = importance.shifted(crc[:-1], np.array([len(w) for w in words[1:]])) ^ crc[1:]
    assert joined.tolist() == [crc32(a + b) for a, b in zip(words, words[1:])]


def test_sentinels_never_join_documents():
    texts = [b"one two", b"", b"three\0four Five", "ünï é".encode(), b"\0", b"six"]
    whole = [(w.tolist(), o.tolist(), b.tolist()) for _, _, w, o, b in importance.features(texts, BUCKETS)]
    words, owner, bucket = whole[0]
    assert words == [2, 0, 3, 2, 0, 1]
    single = [sorted(grams(t.decode())[1]) for t in texts]
    assert [sorted(b for o, b in zip(owner, bucket) if o == i) for i in range(len(texts))] == single
