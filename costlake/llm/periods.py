"""Periodic runs of words, found by internal pattern matching, and texts with the repeats taken out.

A run is a stretch of words with smallest period q, of ``least_exponent`` (4 or more) times q words at
least, that no neighbouring word extends. Every run holds, near its start, a block of 2**k words at a
multiple of 2**k, with 2**k <= q < 2**(k+1), and the block comes again q words later. So for every k and every
such block the method asks for the block's occurrences that begin 2**k to 2**(k+1) words later:

- prefix doubling names every stretch of 2**k words by its range in the suffix array;
- a wavelet matrix over the suffix array gives, by range successor, the first occurrences of the block
  in that window;
- occurrences of a pattern in a window of its own length form one arithmetic progression. One or two
  are candidates themselves. Three or more mean that the block has their difference as a period;
  then the run's period is the distance between the right ends of the two stretches with that period;
- a candidate is extended to both sides by comparing names, the longest first, and kept if it is long enough. A
  stretch with several periods keeps the smallest.

There are at most two blocks per word, and all of them are asked at once, level by level.

Before that, words that can't be in any run are left out: a run repeats each of its words
``least_exponent`` times and each pair of neighbours once less. This is exact, and ordinary prose mostly ends there.

Edge cases: a null or empty text has no words, no run, and an empty collapsed text; repeated rows are
documents of their own; an empty table gives an empty result; all columns but doc_id and text are
ignored; a document of any length is one item of a batch, and memory grows with the longest one only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import let, ship_package, words
from costlake.llm.wavelet import WaveletMatrix
from costlake.llm.words import blocks

LEAST_EXPONENT = 4
LEAST_WORDS = 6
#: Rounds of leaving words out. They only save work; what is left after them is searched in full.
ROUNDS = 6

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _coded(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, a number for each word (equal only for equal words of one text), words per text."""
    split, codes, sizes, base = [], [], [], 0
    for text in texts:
        found = text.split()  # of bytes: at 20 and 09 to 0D only
        known: dict[bytes, int] = {}
        codes += [known.setdefault(word, base + len(known)) for word in found]
        base += len(known)
        split.append(found)
        sizes.append(len(found))
    return split, np.array(codes, dtype=np.int64), np.array(sizes, dtype=np.int64)


def _stretches(at: np.ndarray, document: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions in stretches of at least ``least`` neighbours within a document, and their stretch."""
    if not len(at):
        return at, at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (document[at[1:]] != document[at[:-1]])
    stretch = np.cumsum(new) - 1
    long = np.bincount(stretch)[stretch] >= least
    return at[long], np.unique(stretch[long], return_inverse=True)[1]


def _names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers that are equal where both are."""
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1]


def _possible(codes: np.ndarray, document: np.ndarray, exponent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, stretch) of the words that may be in a run."""
    name, at = codes, np.arange(len(codes))
    stretch = document
    for _ in range(ROUNDS):
        before = len(at)
        often = np.bincount(name)[name] >= exponent
        at, stretch = _stretches(at[often], document, least)
        if not len(at):
            break
        name = _names(stretch, codes[at])
        pair = _names(name[:-1], name[1:])
        same = stretch[:-1] == stretch[1:]
        repeated = same & (np.bincount(pair[same], minlength=int(pair.max()) + 1)[pair] >= exponent - 1)
        inside = np.zeros(len(at), dtype=bool)
        inside[:-1] |= repeated
        inside[1:] |= repeated
        at, stretch = _stretches(at[inside], document, least)
        if not len(at) or len(at) == before:
            break
        name = _names(stretch, codes[at])
    return at, stretch


class Repeats:
    """Names of all stretches of 2**k symbols, and the suffix array under a wavelet matrix.

    The name of a stretch is the first place, in the suffix array, of the suffixes that begin with it; ``count``
    has, by name, how many do. The last symbol must occur once, so no stretch reaches past the end.
    """

    def __init__(self, symbols: np.ndarray, longest: int):
        order = np.argsort(symbols, kind="stable")
        ordered = symbols[order]
        head = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        size = np.diff(np.append(head, len(symbols)))
        name = np.empty(len(symbols), dtype=np.int64)
        name[order] = np.repeat(head, size)
        self.names, self.counts = [name], [self._counts(name)]
        while 2 << (len(self.names) - 1) <= longest:
            name = self._doubled(name, 1 << (len(self.names) - 1))
            count = self._counts(name)
            if count.max() < 2:
                break
            self.names.append(name)
            self.counts.append(count)
        self.suffixes = WaveletMatrix.of(np.argsort(name, kind="stable"))

    @staticmethod
    def _counts(name: np.ndarray) -> np.ndarray:
        return np.bincount(name, minlength=len(name))

    def _doubled(self, name: np.ndarray, length: int) -> np.ndarray:
        """Names of twice the length: only stretches that are not alone yet are sorted."""
        n = len(name)
        some = np.flatnonzero(self.counts[-1][name] > 1)
        after = np.where(some + length < n, name[np.minimum(some + length, n - 1)] + 1, 0)
        key = name[some] * (n + 1) + after
        order = np.argsort(key, kind="stable")
        some, key = some[order], key[order]
        old = name[some]
        place = np.arange(len(some))
        first = np.concatenate(([True], old[1:] != old[:-1]))
        begin = np.concatenate(([True], key[1:] != key[:-1]))
        in_group = place - np.maximum.accumulate(np.where(first, place, 0))
        offset = in_group[np.maximum.accumulate(np.where(begin, place, 0))]
        out = name.copy()
        out[some] = old + offset
        return out

    def extent(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols agree from ``i`` and ``j`` on, or before them."""
        out = np.zeros(len(i), dtype=np.int64)
        n = len(self.names[0])
        for level in range(len(self.names) - 1, -1, -1):
            name, length = self.names[level], 1 << level
            while True:
                a, b = (i + out, j + out) if forward else (i - out - length, j - out - length)
                inside = (b < n) if forward else (a >= 0)
                same = inside & (name[np.clip(a, 0, n - 1)] == name[np.clip(b, 0, n - 1)])
                if not same.any():
                    break
                out[same] += length
                if level < len(self.names) - 1:
                    break
        return out


def _candidates(found: Repeats, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, period) of all that the blocks of 2**level words propose."""
    length, n = 1 << level, len(found.names[0])
    name, count = found.names[level], found.counts[level]
    block = np.arange(0, n - length + 1, length)
    block = block[count[name[block]] > 1]
    low = name[block]
    high = low + count[low]
    nothing = np.zeros(0, dtype=np.int64)
    out = [(nothing, nothing)]
    bound, last = block + length, None
    for step in range(3):
        place = found.suffixes.successor(low, high, bound)
        met = (place >= 0) & (place < block + 2 * length)
        block, low, high, place = block[met], low[met], high[met], place[met]
        first = place if step == 0 else first[met]
        if step < 2:
            out.append((block, place - block))
            last, bound = place, place + 1
        else:
            difference = last[met] - first
            out.append((block, first - block + found.extent(first, first + difference, True)
                        - found.extent(block, block + difference, True)))
    blocks_, periods = (np.concatenate(part) for part in zip(*out))
    fits = (periods >= length) & (periods < 2 * length)
    return blocks_[fits], periods[fits]


def periodic_runs(
    symbols: np.ndarray, stretch: np.ndarray, exponent: int = LEAST_EXPONENT, least: int = LEAST_WORDS
) -> np.ndarray:
    """Rows (start, length, period) of the runs of symbols that are not negative, by start and period. A run lies
    in one stretch (numbers that never fall)."""
    if not len(symbols):
        return np.zeros((0, 3), dtype=np.int64)
    # A symbol of its own after each stretch: nothing repeats across it.
    at = np.arange(len(symbols)) + stretch
    text = int(symbols.max()) + 1 + np.arange(len(symbols) + int(stretch[-1]) + 1)
    text[at] = symbols
    longest = int(np.bincount(stretch).max()) // exponent
    if longest < 1:
        return np.zeros((0, 3), dtype=np.int64)
    found = Repeats(text, longest)
    runs = []
    for level in range(len(found.names)):
        block, period = _candidates(found, level)
        right = found.extent(block, block + period, True)
        left = found.extent(block, block + period, False)
        length = left + right + period
        kept = length >= np.maximum(least, exponent * period)
        runs.append(np.stack([block - left, length, period], axis=1)[kept])
    rows = np.unique(np.concatenate(runs), axis=0)  # by start, length, period
    smallest = np.ones(len(rows), dtype=bool)
    smallest[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[smallest]
    back = np.zeros(len(text), dtype=np.int64)
    back[at] = np.arange(len(symbols))
    rows[:, 0] = back[rows[:, 0]]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _found(texts: list[bytes], exponent: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(words per text, runs per text, runs, collapsed texts) of a batch."""
    split, codes, sizes = _coded(texts)
    ends = np.cumsum(sizes)
    document = np.repeat(np.arange(len(texts)), sizes)
    at, stretch = _possible(codes, document, exponent, least)
    runs = periodic_runs(codes[at], stretch, exponent, least)
    runs[:, 0] = at[runs[:, 0]]
    owner = document[runs[:, 0]]
    edges = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edges)[:-1] == 0
    collapsed = [b" ".join(found) for found in split]
    begins = ends - sizes
    for i in np.unique(owner).tolist():
        collapsed[i] = b" ".join(compress(split[i], kept[begins[i] : ends[i]].tolist()))
    runs[:, 0] -= begins[owner]
    return sizes, np.bincount(owner, minlength=len(texts)), runs, collapsed


def find_runs(documents: DataFrame, exponent: int = LEAST_EXPONENT, least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document: its runs (start, length, period, in words from 0) by start
    and period, and its words joined by one space without those that a run holds after its first period."""
    if exponent < 4:
        raise ValueError("blocks near the start of a run are only sure to repeat in it from exponent 4 on")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for start, end in blocks(texts):
                sizes, counts, runs, collapsed = _found(texts[start:end], exponent, least)
                rows = pa.StructArray.from_arrays(
                    [pa.array(runs[:, i]) for i in range(3)], ["start", "length", "period"]
                )
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start), pa.array(sizes),
                        pa.ListArray.from_arrays(offsets, rows), pa.array(collapsed, pa.binary()).view(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    ship_package(documents.sparkSession)
    return documents.select("doc_id", "text").mapInArrow(run, RUNS)


def with_repeated_tails(documents: DataFrame) -> DataFrame:
    """(doc_id, text) with periodic tails planted in a tenth of the documents, chosen by the CRC-32 ``h`` of the id
    (0 for a null id): from word a = g % n on, words repeat with period 1 + (n - a) / (3 + g % 8), g = h / 10."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0))
    g = F.floor(h / 10)

    def repeated(split: Column) -> Column:
        n = F.size(split).cast("long")
        a = g % n
        period = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % period)
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: split[place(i).cast("int")])
        return F.when(n > 0, F.concat_ws(" ", tail)).otherwise(F.lit(""))

    text = F.when(h % 10 == 0, let(words(F.col("text")), repeated)).otherwise(F.col("text"))
    return documents.select("doc_id", text.alias("text"))


def report(found: DataFrame) -> DataFrame:
    """Per document of ``find_runs``: the longest run (ties: smallest start, then period) and digests."""
    first = F.array_sort(
        "runs",
        lambda a, b: F.when(a["length"] != b["length"], F.when(a["length"] > b["length"], -1).otherwise(1))
        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .otherwise(F.signum(a["period"] - b["period"]).cast("int")),
    )
    longest = F.when(F.size("runs") > 0, first[0])
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start", "longest.length", "longest.period",
        F.floor(F.col("longest.length") * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
