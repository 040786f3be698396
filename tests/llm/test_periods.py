"""Periodic runs against a search of every period, over the whole table and over made-up texts."""

import hashlib
from zlib import crc32

import brute
import numpy as np
import pytest
from conftest import SF_DIR
from test_edges import ALL, TEXTS, docs, ids, none  # noqa: F401

from costlake.llm import periods
from costlake.llm.queries import REGISTERED


def runs_of(words, exponent=4, least=6):
    """Every (start, length, period) by trying all periods, smallest first."""
    known = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    n, out, seen = len(codes), [], set()
    for q in range(1, n // exponent + 1):
        same = np.concatenate(([False], codes[q:] == codes[:-q], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + q
            # A stretch that a smaller period has too is that period's run.
            if length >= max(least, exponent * q) and (start, length) not in seen:
                seen.add((start, length))
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def tail_repeated(doc_id, words):
    h, n = 0 if doc_id is None else crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = tail_repeated(doc_id, brute.words(text))
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        digest("".join(f"{a},{b},{c}\n" for a, b, c in runs)), digest(collapsed(words, runs)),
    )


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(tuple(r) for r in REGISTERED["op11_periodic_runs"](spark, folder).collect())
    assert found == sorted(expected(r.doc_id, r.text) for r in texts)
    assert sum(r[1] for r in found) > 0


def made_up(rng):
    some = lambda most, n: rng.integers(0, most, n).tolist()
    n = int(rng.integers(0, 120))
    kind = rng.integers(0, 4)
    if kind == 0:
        return some(int(rng.integers(1, 4)), n)
    if kind == 1:  # a run of runs between other words
        inner = some(2, int(rng.integers(1, 5))) * int(rng.integers(1, 6)) + some(3, int(rng.integers(0, 4)))
        return some(3, 5) + (inner * 8)[: int(rng.integers(1, 200))] + some(3, 5)
    if kind == 2:
        out = []
        while len(out) < n:
            out += some(3, int(rng.integers(1, 6))) * int(rng.integers(1, 8))
        return out
    a, b = [0], [0, 1]  # Fibonacci words hold as many runs as words can
    while len(b) < n + 1:
        a, b = b, b + a
    return b[:n] * int(rng.integers(1, 6))


def test_all_runs_of_made_up_words_are_found():
    rng = np.random.default_rng(7)
    total = 0
    for _ in range(600):
        words = made_up(rng)
        runs = runs_of(words)
        found = periods.periodic_runs(np.array(words, dtype=np.int64), np.zeros(len(words), dtype=np.int64))
        assert [tuple(r) for r in found.tolist()] == runs, words
        text = [str(w).encode() for w in words]
        *_, with_words_left_out, kept = periods._found([b" ".join(text)], 4, 6)
        assert [tuple(r) for r in with_words_left_out.tolist()] == runs
        assert kept[0].decode() == collapsed([str(w) for w in words], runs)
        total += len(runs)
    assert total > 1000


def test_long_periods_and_long_runs():
    rng = np.random.default_rng(3)
    for period, times in ((1, 40_000), (997, 9), (4096, 4), (4096, 5), (5000, 4.2)):
        unit = rng.integers(0, 50, period)
        middle = np.tile(unit, int(times) + 1)[: int(period * times)]
        words = np.concatenate((rng.integers(50, 99, 321), middle, rng.integers(50, 99, 77)))
        found = periods.periodic_runs(words, np.zeros(len(words), dtype=np.int64))
        assert [321, len(middle), period] in found.tolist()


def test_edges(spark, docs, none):  # noqa: F811
    found = periods.find_runs(docs)
    assert ids(found) == ALL
    by_text = {(r.doc_id, r.n_words): r for r in found.collect()}
    for doc_id, text, *_ in TEXTS:
        words = brute.words(text)
        r = by_text[doc_id, len(words)]
        assert [tuple(x) for x in r.runs] == runs_of(words)
        assert r.collapsed == collapsed(words, runs_of(words))
    assert periods.find_runs(none).count() == 0
    assert periods.report(periods.find_runs(periods.with_repeated_tails(docs))).count() == len(TEXTS)


def test_letter_case_and_other_white_space_matter(spark):
    texts = [(1, "a A a A a A a A"), (2, "x x x x"), (3, "b b b b b"), (4, "c c c c c c"), (5, "d\u000bd\td\nd  d d")]
    found = {r.doc_id: r for r in periods.find_runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 8, 2)] and found[1].collapsed == "a A"
    assert found[2].runs == [] and found[3].runs == []
    assert found[4].collapsed == "c" and found[5].collapsed == "d"


def test_exponents_below_four_are_refused(spark, docs):  # noqa: F811
    with pytest.raises(ValueError):
        periods.find_runs(docs, exponent=3)
