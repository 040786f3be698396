"""Near copies by SimHash, and by exact Jaccard similarity of word shingles with candidates from minimum hashes.

Texts whose SimHashes lie few bits apart are linked through pivot tables (``simhash``). That finds the closest
copies only: no distance of 64-bit SimHashes tells a similarity of 0.8, as pairs above it lie up to some 17 bits
apart, pairs below it down to 4. So texts also meet if the smallest hash of their shingles is the same under
one of several orders, and every such link is verified on the whole shingle sets. Two sets of similarity J
have the same smallest hash with probability J under each order, so a pair at exactly 0.8 is missed
with probability 0.2 ** KEYS (3e-6), a closer one more seldom.

Shingle sets are shipped only for texts that meet another one. Equal sets are compared once. Within a
group, texts whose shingles are mostly their own can't be similar to any other and go at once (a
passage that many texts share costs one sort), and texts linked already are not compared again (a
dense group costs about one pass).

Edge cases: words are those of ``simhash``; a text with fewer words than a shingle is one shingle; null
and blank texts are copies of each other; rows without an id are left out; repeated rows get the same
class, which is named by its smallest doc_id; an empty table gives no rows; columns other than doc_id
and text are ignored. Sets are told apart by a 64-bit hash, as fingerprints are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm import simhash
from costlake.llm.common import in_slices, ship_package, stored, whole_groups
from costlake.llm.components import components
from costlake.llm.words import mix, utf8

SHINGLE = 5
#: Similarity of a link, as a fraction: 4 of 5.
SHARED, OF = 4, 5
SEED = 42
KEYS = 8
#: Texts of a group that one task compares at once.
SLICE = 1_000
#: XXH64 of an empty text by seed 42.
_EMPTY = np.array([0x98b1582b0977e704], dtype=np.uint64)


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a text without a word is one empty shingle."""
    return np.unique(hashes) if len(hashes) else _EMPTY


def smallest(hashes: np.ndarray, keys: int = KEYS) -> list[int]:
    """The smallest hash under each order, as signed longs; orders differ, so their values do too."""
    salts = mix(np.arange(1, keys + 1, dtype=np.uint64))
    return [int(mix(hashes ^ salt).min().view(np.int64)) for salt in salts]


def _print(hashes: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def keyed_sets(documents: DataFrame) -> DataFrame:
    """(doc_id, print, fp, keys) of every row: ``print`` tells shingle sets apart, ``fp`` is the SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, fps, keys = [], [], []
            for text in batch.column(1):
                every = simhash.shingle_hashes(utf8(text.as_py()), SHINGLE, SEED)
                hashes = shingle_set(every)
                prints.append(_print(hashes))
                fps.append(simhash.majority(every))
                keys.append(smallest(hashes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(prints, pa.int64()),
                    pa.array(np.array(fps, dtype=np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "print", "fp", "keys"],
            )

    ship_package(documents.sparkSession)
    chosen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, print long, fp long, keys array<long>")


def whole_sets(documents: DataFrame) -> DataFrame:
    """(print, shingles) of every row, the hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (utf8(text.as_py()) for text in batch.column(0))
            sets = [shingle_set(simhash.shingle_hashes(text, SHINGLE, SEED)) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_print(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["print", "shingles"],
            )

    return documents.select("text").mapInArrow(run, "print long, shingles binary")


def group_links(sets: list[np.ndarray], sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (positions) that join all sets which are connected in the group by similar pairs.

    ``sides`` are the slices of a group that was split; of two slices only pairs across are compared.
    """
    sizes = np.array([len(s) for s in sets])
    alive = np.arange(len(sets))
    owner = np.repeat(alive, sizes)
    place = np.unique(np.concatenate(sets), return_inverse=True)[1]
    while len(alive) > 1:  # a similar pair shares 4 / 5 of either set
        shared = np.bincount(place)[place] > 1
        held = np.bincount(owner[shared], minlength=len(sets))
        left = alive[OF * held[alive] >= SHARED * sizes[alive]]
        stay = np.isin(owner, left)
        if len(left) == len(alive):
            break
        alive, owner, place = left, owner[stay], place[stay]
    links = []
    rest = alive
    marked = np.zeros(place.max(initial=-1) + 1, dtype=bool)
    starts = np.searchsorted(owner, np.arange(len(sets) + 1))
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        within = np.isin(owner, rest)
        places, owners = place[within], owner[within]
        while queue and len(rest):
            x = queue.pop()
            own = place[starts[x] : starts[x + 1]]
            marked[own] = True
            common = np.bincount(owners[marked[places]], minlength=len(sets))[rest]
            marked[own] = False
            similar = OF * common >= SHARED * (sizes[x] + sizes[rest] - common)
            if sides is not None:
                similar &= sides[rest] != sides[x]
            if similar.any():
                near, rest = rest[similar], rest[~similar]
                links += [(x, int(y)) for y in near]
                queue += near.tolist()
                within = np.isin(owners, rest)
                places, owners = places[within], owners[within]
    return links


def one_key_per_group(keyed: DataFrame) -> DataFrame:
    """``keyed`` (print, key) without groups of one, and of keys that group the very same prints only the smallest:
    close copies agree in most of their hashes, and comparing them once is enough. Members are told by their
    number and two 64-bit sums of hashes of theirs."""
    members = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("print", F.lit(1))).alias("mixed"),
        F.bit_xor(F.xxhash64("print", F.lit(2))).alias("again"),
    )
    kept = members.filter("n > 1").groupBy("n", "mixed", "again").agg(F.min("key").alias("key"))
    return keyed.join(kept.select("key"), "key", "left_semi")


def similar_links(documents: DataFrame, distinct: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """(a, b) links between the ``print`` of sets, enough to connect all that are connected."""
    keyed = one_key_per_group(distinct.select("print", F.explode("keys").alias("key")))
    dealt = stored(in_slices(keyed, ["key"], "print", slice_rows, least=2), "near-copies-dealt")
    group = ["key", "slice_i", "slice_j"]
    needed = distinct.join(dealt.select("print").distinct(), "print", "left_semi")
    texts = documents.join(needed.select(F.col("first_doc").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = whole_sets(texts).groupBy("print").agg(F.first("shingles").alias("shingles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, groups in whole_groups(batches, group):
            prints = rows.column("print").to_numpy()
            slices = rows.column("slice").to_numpy()
            crossing = rows.column("slice_i").to_numpy() != rows.column("slice_j").to_numpy()
            shingles = rows.column("shingles")
            left, right = [], []
            for start, end in groups:
                if end - start < 2:
                    continue
                found = [np.frombuffer(shingles[i].as_py(), dtype=np.uint64) for i in range(start, end)]
                for x, y in group_links(found, slices[start:end] if crossing[start] else None):
                    left.append(prints[start + x])
                    right.append(prints[start + y])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return (
        dealt.join(sets, "print")
        .select("print", *group, "slice", "shingles")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(run, "a long, b long")
    )


def simhash_links(hashed: DataFrame, distance: int) -> DataFrame:
    """(a, b) links between the ``print`` of sets that a chain of SimHash links joins: each to the smallest one."""
    distinct = stored(hashed.select("fp").distinct(), "near-copies-fingerprints")
    classes = simhash.fingerprint_classes(distinct, distance)
    members = hashed.select("print", "fp").distinct().join(classes, "fp").select("print", "component").distinct()
    least = members.groupBy("component").agg(F.min("print").alias("b"))
    return members.join(least, "component").filter("print != b").select(F.col("print").alias("a"), "b")


def similar_documents(documents: DataFrame, distance: int = simhash.DISTANCE) -> DataFrame:
    """(doc_id, component_id) of every row with an id; classes are chains of pairs whose SimHashes are at most
    ``distance`` bits apart, or whose shingle sets have a Jaccard similarity of 0.8 or more."""
    named = documents.filter("doc_id is not null")
    hashed = stored(keyed_sets(named), "near-copies-keys")
    distinct = stored(
        hashed.groupBy("print").agg(F.min("doc_id").alias("first_doc"), F.first("keys").alias("keys")),
        "near-copies-distinct",
    )
    found = components(simhash_links(hashed, distance).unionByName(similar_links(named, distinct)))
    labelled = distinct.join(found, distinct["print"] == found["node"], "left").select(
        "print", "first_doc", F.coalesce("component_id", "print").alias("component")
    )
    first = labelled.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named_classes = stored(labelled.join(first, "component").select("print", "component_id"), "near-copies-classes")
    return hashed.select("doc_id", "print").join(named_classes, "print").select("doc_id", "component_id")
