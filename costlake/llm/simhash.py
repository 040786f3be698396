"""SimHash near-duplicates: exact links at a small Hamming distance, found with pivot distance tables.

Each text's word shingles are hashed to 64 bits, and a fingerprint bit is set if it is set in over
half of them. To link fingerprints, their Hamming distances to many reference fingerprints (pivots)
are tabled. By the triangle inequality a coordinate of that table differs by at most the distance of
the two, so pairs with a larger maximum difference are discarded, and survivors are verified.

A pivot table alone orders nothing: random fingerprints lie within a few bits of 32 from any pivot,
so one coordinate passes half of all pairs. Pairs therefore meet in blocks first. The 64 bits are cut
into more blocks than bits may differ; two linked fingerprints agree in some of them, whichever bits
differ, so nothing is lost. The more fingerprints there are, the more blocks must agree at once.

Edge cases: a null or blank text has the fingerprint zero, which links like any other; a text with
fewer words than a shingle is one shingle; repeated rows and ties get the same class, which is named
by its smallest doc_id (null ids sort last); an empty table gives no rows; columns other than doc_id
and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import in_slices, ship_package, stored, unused, whole_groups
from costlake.llm.components import components
from costlake.llm.words import mix, utf8

SHINGLE = 5
DISTANCE = 3
SEED = 42
PIVOTS = 32
#: Fingerprints that should share a block key, and that one task compares at once.
BUCKET, SLICE = 512, 20_000


def shingle_hashes(text: bytes, shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of the space-joined shingles of a text's lower-cased words, repeats included; none without a word."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    whole = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(whole, seed)], dtype=np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - shingle]]
    return np.fromiter(
        (xxh64_intdigest(whole[a : b - 1], seed) for a, b in zip(starts, ends[shingle - 1 :])),
        dtype=np.uint64, count=len(starts),
    )


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes; zero without any."""
    ones = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(hashes), 1 << 14):  # bounded memory for any length
        part = hashes[begin : begin + (1 << 14)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes, shingle: int, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text."""
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(utf8(t.as_py()), shingle, seed) for t in batch.column(1)),
                dtype=np.uint64, count=batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    ship_package(documents.sparkSession)
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, fp long")


def scheme(n: int, distance: int, bucket: int = BUCKET) -> tuple[list[tuple[int, int]], int]:
    """(blocks as (shift, width), how many must agree) for ``n`` fingerprints: the fewest tables whose
    keys are long enough for about ``bucket`` fingerprints each. Every choice finds every link."""
    for agree in range(1, 6):
        parts = distance + agree
        edges = [64 * i // parts for i in range(parts + 1)]
        blocks = [(a, b - a) for a, b in zip(edges, edges[1:])]
        if n / 2 ** (agree * min(w for _, w in blocks)) <= bucket:
            break
    return blocks, agree


def block_keys(fp: Column, blocks: list[tuple[int, int]], agree: int) -> Column:
    """One key per choice of ``agree`` blocks: the number of the choice and the bits of its blocks."""
    bits = [
        F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1)) for shift, width in blocks
    ]
    keys = []
    for number, chosen in enumerate(combinations(range(len(blocks)), agree)):
        key = F.lit(number).cast("long")
        for i in chosen:
            key = F.shiftleft(key, blocks[i][1]).bitwiseOR(bits[i])
        keys.append(key)
    return F.array(*keys)


def pivots(n: int = PIVOTS, seed: int = SEED) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 1))


def bucket_links(values: np.ndarray, sides: np.ndarray | None, distance: int, refs: np.ndarray) -> list[tuple[int, int]]:
    """Links (positions) that join all fingerprints of a bucket which are connected in it.

    Fingerprints reached already are not compared again: a dense group costs about one pass, and the
    links returned are fewer than the fingerprints. ``sides`` are the slices of a bucket that was
    split; of two slices only pairs across are compared here, the others have tasks of their own.
    """
    table = np.bitwise_count(values[:, None] ^ refs).astype(np.int8)
    rest = np.argsort(table[:, 0], kind="stable")  # not reached yet, by distance to the first pivot
    links = []
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            first = table[rest, 0]
            low = np.searchsorted(first, table[x, 0] - distance, "left")
            high = np.searchsorted(first, table[x, 0] + distance, "right")
            near = rest[low:high]
            near = near[np.abs(table[near] - table[x]).max(axis=1, initial=0) <= distance]
            near = near[np.bitwise_count(values[near] ^ values[x]) <= distance]
            if sides is not None:
                near = near[sides[near] != sides[x]]
            if len(near):
                links += [(x, int(y)) for y in near]
                queue += near.tolist()
                rest = rest[~np.isin(rest, near)]
    return links


def links(distinct: DataFrame, distance: int, n: int, slice_rows: int = SLICE) -> DataFrame:
    """(a, b) links between fingerprints ``fp``, enough to connect all that are connected."""
    blocks, agree = scheme(n, distance)
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), blocks, agree)).alias("key"))
    dealt = in_slices(keyed, ["key"], "fp", slice_rows)
    group = ["key", "slice_i", "slice_j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        for rows, groups in whole_groups(batches, group):
            fps = rows.column("fp").to_numpy()
            slices = rows.column("slice").to_numpy()
            crossing = rows.column("slice_i").to_numpy() != rows.column("slice_j").to_numpy()
            left, right = [], []
            for start, end in groups:
                if end - start < 2:
                    continue
                part = fps[start:end]
                sides = slices[start:end] if crossing[start] else None
                for x, y in bucket_links(part.view(np.uint64), sides, distance, refs):
                    left.append(part[x])
                    right.append(part[y])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return (
        dealt.select("fp", *group, "slice")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(run, "a long, b long")
    )


def fingerprint_classes(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``distinct`` (a row per fingerprint ``fp``, and other columns) with ``component``: the smallest fingerprint, as
    a signed long, that chains of links reach."""
    found = components(links(distinct, distance, distinct.count()))
    return distinct.join(found, distinct["fp"] == found["node"], "left").select(
        *[distinct[c] for c in distinct.columns], F.coalesce("component_id", "fp").alias("component")
    )


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, seed: int = SEED
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; classes are chains of links between
    fingerprints at most ``distance`` bits apart. Equal fingerprints are compared once."""
    hashed = stored(fingerprints(documents, shingle, seed), "simhash-fingerprints")
    distinct = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-distinct")
    labelled = fingerprint_classes(distinct, distance)
    smallest = labelled.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = stored(labelled.join(smallest, "component").select("fp", "component_id"), "simhash-classes")
    return hashed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(documents: DataFrame, classes: DataFrame | None = None, **settings) -> DataFrame:
    """``documents`` with one row of each class: the one with the smallest id, and of repeated rows
    with that id the one with the smallest text. Rows without an id can't be named and all stay.

    ``classes`` is (doc_id, component_id); without it, those of ``near_duplicates(**settings)``."""
    named = documents.filter("doc_id is not null")
    classes = near_duplicates(named, **settings) if classes is None else classes
    keep = classes.filter("doc_id = component_id").select("doc_id").distinct()
    kept = named.join(keep, "doc_id", "left_semi")
    place = unused(documents, "place")
    first = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last())
    once = kept.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).select(*documents.columns)
    return once.unionByName(documents.filter("doc_id is null"))
