"""Near-duplicate embeddings by lattice hashing: E8 cells of random projections, verified by cosine.

A vector's direction is projected by random Gaussian matrices to blocks of eight dimensions, each of
which is decoded to the nearest point of the E8 lattice. The points of a table's blocks are its cell.
In every table a vector lives in its home cell and also probes a neighbouring cell: the one reached
when the block that was decided most narrowly takes the runner-up of E8's two cosets. Vectors that
meet in a cell are compared by exact cosine in double precision.

The number of blocks grows with the logarithm of the number of vectors, so that cells stay small, and
the number of tables with it, so that recall stays.

No vector is sent to a cell. A cell gets 48 bytes for each vector: itself, the vector's group, and 256
signs of random projections. Two vectors that meet there with no more differing signs than a pair at
the threshold has (but with a chance of ``MISSED``) make a pair of their groups. Of every pair of groups,
found however often, all vectors are compared once. Groups are any division of the vectors; a good one
has the members of a dense cluster in one group, so that its pairs are never listed. It comes from a few
tables: a vector joins the neighbour of the smallest name there, which joins its own, and so on.

The tables are taken in passes of a bounded number of bytes, whose shuffle files go before the next pass.
A cell of over ``CROWD`` entries, and a group of over ``SLICE`` vectors, is cut into slices whose pairs
are compared by different tasks.

Edge cases: vectors that are null, zero, or hold null or non-finite components link with nothing;
vectors of different dimension neither; equal vectors are compared once and counted by multiplicity;
rows with a repeated vec_id are vectors of their own, and each is returned; rows with a null vec_id are
left out of links and come back alone; an empty table gives no rows; other columns are ignored.
Equal vectors are known by 128 bits of two hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.common import ship_package, stored
from costlake.llm.components import components
from costlake.llm.words import mix
from costlake.session import freed_shuffles, run_folder
from costlake.sources.sinks import materialise
from costlake.sources.storage import remove

COSINE = 0.95
SEED = 20240608
#: Lattice points are this far apart in units of the projected standard deviation (times sqrt 2).
SCALE = 2.5
#: Vectors that should share a cell; directions that one block tells apart, roughly.
CELL, CELLS_PER_BLOCK = 24, 24
#: Chance that a linked pair shares a cell in one table, for each block, and the recall to reach.
#: Measured for pairs at the threshold, with the probe; closer pairs meet more often.
BLOCK_CHANCE, RECALL = 0.62, 0.99
#: Chance that a pair at the threshold which meets in a cell has more differing signs than allowed,
#: among the first 64 or among all.
MISSED = 1e-6
SIGNS = 256
#: What a cell knows of a vector. The last bit of ``cell`` tells that the vector only probes it.
ENTRY = np.dtype([("cell", "<u8"), ("group", "<i8"), ("signs", "<u8", SIGNS // 64)])
#: Entries of a pass: so many bytes, or this multiple of the vectors' bytes if that is more.
PASS_BYTES, PASS_SHARE = 1 << 28, 1.5
#: Bytes of entries that a task gathers before it sends them, and that it receives, about.
SENT, SHARD = 1 << 24, 1 << 25
#: Vectors whose points are decoded at once: their steps stay in the processor's cache.
CACHED = 1024
#: Tables that make the groups.
LEADING = 3
#: Entries of a cell that are compared with one another by their distance in the sorted cell; rows and
#: columns of a grid compared at once; entries of a cell that one task compares; vectors of a group's slice.
SMALL, ROWS, COLUMNS = 64, 64, 1 << 14
CROWD = 1 << 15
SLICE = 8_000


def _cosets(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest points of E8's two cosets to points (..., 8, n) as doubled integers, and by how much the
    second is farther (squared). Coordinates come first, so that every step is over long rows."""

    def d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.rint(x)
        off = x - near
        size = np.abs(off)
        most, worst = size[..., 0, :], np.zeros(size[..., 0, :].shape, dtype=np.int8)
        for k in range(1, 8):
            worst = np.where(size[..., k, :] > most, np.int8(k), worst)
            most = np.maximum(most, size[..., k, :])
        near, step = near.astype(np.int64), np.where(off < 0, -1, 1)
        odd = np.bitwise_xor.reduce(near, axis=-2) & 1 == 1
        worst = np.where(odd, worst, np.int8(8))
        near += step * (worst[..., None, :] == np.arange(8, dtype=np.int8)[:, None])
        return near, (off * off).sum(axis=-2) + odd * (1 - 2 * most)

    (whole, to_whole), (half, to_half) = d8(points), d8(points - 0.5)
    whole *= 2
    half *= 2
    half += 1
    return whole, half, to_half - to_whole


def e8(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest E8 points of the rows (n, 8) as doubled integers, the runner-up of the other coset,
    and by how much farther that one is (squared)."""
    whole, half, farther = _cosets(np.ascontiguousarray(points.T))
    return np.where(farther < 0, half, whole).T, np.where(farther < 0, whole, half).T, np.abs(farther)


def shape_of_index(n: int) -> tuple[int, int]:
    """(tables, blocks per table) for ``n`` different vectors."""
    blocks = max(2, math.ceil(math.log(max(n / CELL, 2)) / math.log(CELLS_PER_BLOCK)))
    tables = max(4, math.ceil(math.log(1 - RECALL) / math.log(1 - BLOCK_CHANCE**blocks)))
    return tables, blocks


def cells(unit: np.ndarray, tables: range, blocks: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Home and probe cell of each row in each of ``tables``, as int64 of shape (n, tables)."""
    n, dims = unit.shape
    random = np.random.default_rng([seed, dims])
    home = np.zeros((n, len(tables)), dtype=np.uint64)
    probe = np.zeros((n, len(tables)), dtype=np.uint64)
    weights = mix(np.arange(1, 8 * blocks + 1, dtype=np.uint64)).reshape(blocks, 8) | np.uint64(1)
    random.standard_normal((tables.start, dims, 8 * blocks))  # of the tables before
    order = (2 * np.arange(1, blocks + 1, dtype=np.uint64) + 1)[:, None]
    for place, t in enumerate(tables):
        matrix = random.standard_normal((dims, 8 * blocks)).T / SCALE
        salt = mix(np.array([t * 1_000_003 + dims], dtype=np.uint64))[0]
        for start in range(0, n, CACHED):
            rows = slice(start, start + CACHED)
            whole, half, farther = _cosets((matrix @ unit[rows].T).reshape(blocks, 8, -1))
            of_whole, of_half = (
                order * mix((x.view(np.uint64) * weights[:, :, None]).sum(axis=1, dtype=np.uint64)) for x in (whole, half)
            )
            hashed, second = np.where(farther < 0, of_half, of_whole), np.where(farther < 0, of_whole, of_half)
            total = hashed.sum(axis=0, dtype=np.uint64)
            narrow = np.abs(farther).argmin(axis=0)[None]
            swap = np.take_along_axis(second, narrow, 0)[0] - np.take_along_axis(hashed, narrow, 0)[0]
            home[rows, place] = mix(total ^ salt)
            probe[rows, place] = mix((total + swap) ^ salt)
    return home.view(np.int64), probe.view(np.int64)


def most_differing(cosine: float, signs: int) -> int:
    """So many of ``signs`` random signs differ at most, but with a chance of ``MISSED``, at this cosine."""
    chance = math.acos(min(max(cosine, -1.0), 1.0)) / math.pi
    left = 1.0
    for differing in range(signs + 1):
        left -= math.comb(signs, differing) * chance**differing * (1 - chance) ** (signs - differing)
        if left <= MISSED:
            return differing
    return signs


def _units(vectors: pa.Array) -> np.ndarray:
    """Rows of one batch as unit vectors in double precision; all have the same dimension."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and unit vectors of the rows of each dimension."""
    lengths = pc.list_value_length(batch.column("embedding")).to_numpy()
    for dims in np.unique(lengths):
        places = np.flatnonzero(lengths == dims)
        vectors = batch.column("embedding")
        yield places, _units(vectors if len(places) == len(lengths) else vectors.take(pa.array(places)))


def _binaries(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data``; ``bounds`` in bytes."""
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    )


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the signs of random projections to the rows."""
    for batch in batches:
        packed = np.zeros((batch.num_rows, SIGNS // 8), dtype=np.uint8)
        for places, unit in _by_dimension(batch):
            matrix = np.random.default_rng([SEED, unit.shape[1], SIGNS]).standard_normal((unit.shape[1], SIGNS))
            packed[places] = np.packbits(unit @ matrix > 0, axis=1)
        signs = _binaries(packed, np.arange(batch.num_rows + 1) * (SIGNS // 8))
        yield pa.RecordBatch.from_arrays([*batch.columns, signs], names=[*batch.schema.names, "signs"])


def _enter(tables: range, blocks: int, shards: int):
    """Rows (shard, entries): all entries of a cell go to one shard."""

    def sent(entries: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(entries)
        shard = (mix(rows["cell"] >> np.uint64(1)) % np.uint64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        rows, shard = rows[order], shard[order]
        starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        bounds = np.append(starts, len(rows)) * ENTRY.itemsize
        return pa.RecordBatch.from_arrays(
            [pa.array(shard[starts]), _binaries(rows, bounds)], names=["shard", "entries"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            group = batch.column("group").to_numpy()
            signs = np.frombuffer(b"".join(batch.column("signs").to_pylist()), "<u8").reshape(len(group), -1)
            for places, unit in _by_dimension(batch):
                home, probe = cells(unit, tables, blocks)
                for lives, last in ((home, 0), (probe, 1)):
                    entries = np.empty(lives.shape, dtype=ENTRY)
                    entries["cell"] = lives.view(np.uint64) & ~np.uint64(1) | np.uint64(last)
                    entries["group"] = group[places][:, None]
                    entries["signs"] = signs[places][:, None, :]
                    held.append(entries.ravel())
            if sum(entries.nbytes for entries in held) >= SENT:
                yield sent(held)
                held = []
        if held:
            yield sent(held)

    return run


class _Meetings:
    """Entries of one or many cells, sorted by cell and group, and which of them are near by their signs."""

    def __init__(self, entries: np.ndarray, most: tuple[int, int]) -> None:
        key = entries["cell"] >> np.uint64(1)
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        shared = (np.append(False, same) | np.append(same, False))[: len(key)]
        entries = entries[order[shared]]  # a cell of one is left out
        entries = entries[np.lexsort((entries["group"], entries["cell"] >> np.uint64(1)))]
        key = entries["cell"] >> np.uint64(1)
        self.starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        self.ends = np.append(self.starts, len(key))[1:]
        self.entries, self.most = entries, most
        self.group, self.home = np.ascontiguousarray(entries["group"]), entries["cell"] & np.uint64(1) == 0
        self.signs = np.ascontiguousarray(entries["signs"])
        self.word = np.ascontiguousarray(self.signs[:, 0])

    def _whole(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.bitwise_count(self.signs[i] ^ self.signs[j]).sum(axis=1) <= self.most[1]
        return i[near], j[near]

    def small(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs in cells of at most ``SMALL`` entries, from entries 1, 2, ... places apart."""
        size = self.ends - self.starts
        end = np.repeat(np.where(size <= SMALL, self.ends, 0), size)
        at, step = np.arange(len(end)), 1
        while len(at):
            at = at[at + step < end[at]]
            other = at + step
            met = (self.group[at] != self.group[other]) & (self.home[at] | self.home[other])
            i, j = at[met], other[met]
            near = np.bitwise_count(self.word[i] ^ self.word[j]) <= self.most[0]
            yield self._whole(i[near], j[near])
            step += 1

    def grid(self, first: int, last: int, begin: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Groups of near pairs i < j of entries first <= i < last and begin <= j < end of a cell, each pair
        of groups once at least."""
        while first < last:
            run = first + int(np.searchsorted(self.group[first:last], self.group[first], "right"))
            stop, behind = min(first + ROWS, last), first + 1
            if run - first > ROWS:  # many of a group: none is compared with the others
                behind = first + int(np.searchsorted(self.group[first:end], self.group[first], "right"))
                stop = run
            rows = first + np.argsort(~self.home[first:stop], kind="stable")
            columns = np.arange(max(behind, begin), end)
            done, many = 0, 4 if run == stop else len(rows)
            while done < len(rows) and len(columns):
                for met, others in self._near(rows[done : done + many], columns):
                    yield met, others
                    if run == stop:  # a pair of groups that is found need not be found again
                        columns = columns[~np.isin(self.group[columns], others)]
                done, many = done + many, max(ROWS, ROWS * COLUMNS // max(len(columns), 1))
            first = stop

    def _near(self, rows: np.ndarray, columns: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Groups of near pairs of the entries ``rows`` with later ones of ``columns``."""
        for left in range(0, len(columns), COLUMNS):
            part = columns[left : left + COLUMNS]
            near = np.bitwise_count(self.word[rows, None] ^ self.word[part]) <= self.most[0]
            near &= self.group[rows, None] != self.group[part]
            near &= self.home[rows, None] | self.home[part]
            near &= rows[:, None] < part
            if 20 * np.count_nonzero(near) < near.size:
                i, j = np.nonzero(near)
                i, j = self._whole(rows[i], part[j])
            else:  # one of each group is enough
                differing = np.zeros(near.shape, dtype=np.uint16)
                for word in self.signs.T:
                    differing += np.bitwise_count(word[rows, None] ^ word[part])
                near &= differing <= self.most[1]
                starts = np.flatnonzero(np.append(True, self.group[part[1:]] != self.group[part[:-1]]))
                i, j = np.nonzero(np.logical_or.reduceat(near, starts, axis=1))
                i, j = rows[i], part[starts[j]]
            if len(i):
                yield self.group[i], self.group[j]

    def large(self) -> list[tuple[int, int]]:
        big = np.flatnonzero(self.ends - self.starts > SMALL)
        return list(zip(self.starts[big].tolist(), self.ends[big].tolist()))

    def leaders(self) -> tuple[np.ndarray, np.ndarray]:
        """(vector, smaller vector near it), of every cell one pair at least for each vector that has one.
        In a cell of over ``SMALL`` entries, a vector's leader is the first that is at home there and near
        it among those that have no leader; only those that lead most are kept beyond a number of entries."""
        smallest = self.group.copy()
        for i, j in self.small():
            np.minimum.at(smallest, j, self.group[i])
        for start, end in self.large():
            kept: list[int] = []
            followers: dict[int, int] = {}
            for begin in range(start, end, CROWD // 8):
                free = np.arange(begin, min(begin + CROWD // 8, end))
                known = iter(sorted(kept, key=followers.__getitem__, reverse=True)[:SMALL])
                kept = []
                while len(free):
                    leader = next(known, None)
                    if leader is None:
                        at_home = self.home[free]
                        if not at_home.any():
                            break
                        place = int(at_home.argmax())
                        leader, free = int(free[place]), np.delete(free, place)
                    near = np.bitwise_count(self.signs[free] ^ self.signs[leader]).sum(axis=1) <= self.most[1]
                    led, free = free[near], free[~near]
                    smallest[led] = np.minimum(smallest[led], self.group[leader])
                    smallest[leader] = min(smallest[leader], self.group[led].min(initial=smallest[leader]))
                    followers[leader] = followers.get(leader, 0) + len(led)
                    kept.append(leader)
        led = smallest < self.group
        return self.group[led], smallest[led]


class _Pairs:
    """Distinct pairs of groups."""

    def __init__(self) -> None:
        self.held, self.size = [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.held.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
            self.size += len(a)
            if self.size > 1 << 20:
                self.held = [self.distinct()]
                self.size = self.held[0].shape[1] // 2  # what stays counts less, so that it may grow

    def distinct(self) -> np.ndarray:
        pairs = np.concatenate([np.zeros((2, 0), dtype=np.int64), *self.held], axis=1)
        pairs = pairs[:, np.lexsort(pairs)]
        return pairs[:, np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))[: pairs.shape[1]]]


PAIRS = "a long, b long, upper binary, lower binary"


def _pair_rows(pairs: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(pairs.shape[1], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), none, none], names=["a", "b", "upper", "lower"])


def _received(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    held = [np.frombuffer(blob.as_buffer(), ENTRY) for batch in batches for blob in batch.column("entries")]
    return np.concatenate(held) if held else np.zeros(0, dtype=ENTRY)


def _lead(most: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector, leader = _Meetings(_received(batches), most).leaders()
        yield pa.RecordBatch.from_arrays([pa.array(vector), pa.array(leader)], names=["rep", "group"])

    return run


def _meet(most: tuple[int, int], crowd: int):
    """Pairs of groups that meet in a cell, and pairs of slices of cells of over ``crowd`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, pairs = _Meetings(_received(batches), most), _Pairs()
        for i, j in here.small():
            pairs.add(here.group[i], here.group[j])
        for start, end in here.large():
            if end - start <= crowd:
                for a, b in here.grid(start, end, start, end):
                    pairs.add(a, b)
                continue
            cuts = [*range(start, end, crowd), end]
            for x, (first, last) in enumerate(zip(cuts, cuts[1:])):
                for begin, stop in zip(cuts[x:], cuts[x + 1 :]):
                    if here.group[first] != here.group[stop - 1]:
                        upper = here.entries[first:last].tobytes()
                        lower = here.entries[begin:stop].tobytes() if begin > first else None
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([0]), pa.array([0]), pa.array([upper], pa.binary()), pa.array([lower], pa.binary())],
                            names=["a", "b", "upper", "lower"],
                        )
        yield _pair_rows(pairs.distinct())

    return run


def _meet_slices(most: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs()
        for batch in batches:
            for upper, lower in zip(batch.column("upper"), batch.column("lower")):
                parts = [np.frombuffer(x.as_buffer(), ENTRY) for x in (upper, lower) if x.is_valid]
                here = _Meetings(np.concatenate(parts), most)
                n, middle = len(here.group), len(parts[0])
                for a, b in here.grid(0, middle, middle if len(parts) > 1 else 0, n):
                    pairs.add(a, b)
        yield _pair_rows(pairs.distinct())

    return run


def _close(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` are linked. Near the threshold the sum's order decides, so it is fixed."""
    product = a @ b.T
    close = product >= cosine + 1e-9
    i, j = np.nonzero((product >= cosine - 1e-9) & ~close)
    if len(i):
        close[i, j] = (a[i] * b[j]).sum(axis=1) >= cosine
    return close


class _Block:
    """A slice of a group, compared within itself and with visiting vectors.

    Gives (rep, linked, other) of vectors that have links: their number, and a vector connected with it
    such that those of a block together connect all that its links connect."""

    def __init__(self, cosine: float) -> None:
        self.cosine, self.parts, self.rows = cosine, [], None

    def stay(self, rep: np.ndarray, copies: np.ndarray, unit: np.ndarray) -> None:
        self.parts.append((rep, copies, unit))

    def _settle(self) -> None:
        if self.rows is None:
            dims = self.parts[0][2].shape[1] if self.parts else 0
            parts = [p for p in self.parts if p[2].shape[1] == dims]  # else a collision of hashes
            self.rows = tuple(np.concatenate([p[k] for p in parts]) for k in range(3)) if parts else ((), (), np.zeros((0, 0)))
            n = len(self.rows[0])
            self.linked, self.root = np.zeros(n, dtype=np.int64), np.arange(n)
            for begin in range(0, n if n > 1 else 0, 512):
                part = np.arange(begin, min(begin + 512, n))
                close = _close(self.rows[2][part], self.rows[2], self.cosine)
                close[part - begin, part] = False
                if close.any():
                    self.linked[part] += close @ self.rows[1]
                    close[part - begin, part] = True
                    self._join(close)

    def _join(self, close: np.ndarray) -> np.ndarray:
        """Connect what each row of ``close`` links; the root of each row."""
        n = len(self.root)
        while True:
            least = np.where(close, self.root, n).min(axis=1)
            moved = np.minimum(np.where(close, least[:, None], n).min(axis=0), self.root)
            low = np.arange(n)
            np.minimum.at(low, self.root, moved)
            if (low[self.root] == self.root).all():
                return least
            self.root = low[self.root]

    def visit(self, rep: np.ndarray, copies: np.ndarray, unit: np.ndarray) -> Iterator[tuple]:
        self._settle()
        if len(self.root) and unit.shape[1] == self.rows[2].shape[1]:
            for begin in range(0, len(rep), 512):
                close = _close(unit[begin : begin + 512], self.rows[2], self.cosine)
                some = np.flatnonzero(close.any(axis=1))
                if len(some):
                    close = close[some]
                    self.linked += copies[begin + some] @ close
                    yield rep[begin + some], close @ self.rows[1], self.rows[0][self._join(close)]

    def result(self) -> Iterator[tuple]:
        self._settle()
        some = np.flatnonzero(self.linked)
        if len(some):
            yield self.rows[0][some], self.linked[some], self.rows[0][self.root[some]]


def _verify(cosine: float):
    """Links of sorted rows (a, slice, visits): those of a slice that stay, then those that visit it."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        block, at = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, part, visits, rep, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "slice", "visits", "rep", "copies"))
            units = list(_by_dimension(batch))
            change = (a[1:] != a[:-1]) | (part[1:] != part[:-1]) | (visits[1:] != visits[:-1])
            lengths = np.zeros(batch.num_rows, dtype=np.int64)
            place = np.zeros(batch.num_rows, dtype=np.int64)
            for k, (places, _) in enumerate(units):
                lengths[places], place[places] = k, np.arange(len(places))
            change |= lengths[1:] != lengths[:-1]
            bounds = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for start, end in zip(bounds, bounds[1:]):
                key = (a[start], part[start])
                if key != at:
                    if block:
                        yield from block.result()
                    block, at = _Block(cosine), key
                unit = units[lengths[start]][1][place[start] : place[start] + end - start]
                if visits[start]:
                    yield from block.visit(rep[start:end], copies[start:end], unit)
                else:
                    block.stay(rep[start:end], copies[start:end], unit)
        if block:
            yield from block.result()

    def rows(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*held)], names=["rep", "linked", "other"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in found(batches):
            held.append(part)
            size += len(part[0])
            if size > 50_000:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    return run


def _entries(vectors: DataFrame, tables: range, blocks: int, n: int) -> DataFrame:
    """Rows (shard, entries) of the tables, each shard in a partition of its own."""
    least = vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(least, -(-2 * n * len(tables) * ENTRY.itemsize // SHARD))
    sent = vectors.select("group", "signs", "embedding").mapInArrow(
        _enter(tables, blocks, shards), "shard int, entries binary"
    )
    return sent.repartitionById(shards, F.col("shard"))


def _grouped(vectors: DataFrame, tables: range, blocks: int, n: int, most: tuple[int, int]) -> DataFrame:
    """``vectors`` with their group: the vector of the smallest name that is reached by going from each
    to the smallest that it meets in ``tables``, four times."""
    met = _entries(vectors.withColumn("group", F.col("rep")), tables, blocks, n).mapInArrow(
        _lead(most), "rep long, group long"
    )
    leads = stored(met.groupBy("rep").agg(F.min("group").alias("group")), "lattice-leaders")
    for _ in range(2):
        further = leads.select(F.col("rep").alias("group"), F.col("group").alias("next"))
        leads = leads.join(further, "group", "left").select("rep", F.coalesce("next", "group").alias("group"))
    return stored(
        vectors.join(leads, "rep", "left").withColumn("group", F.coalesce("group", "rep")), "lattice-groups"
    )


def _paired(vectors: DataFrame, tables: range, blocks: int, n: int, most: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of groups with members that meet in ``tables``, more than once perhaps."""
    met = stored(
        _entries(vectors, tables, blocks, n).mapInArrow(_meet(most, CROWD), PAIRS), "lattice-pairs"
    )
    pairs, slices = met.filter("upper is null").select("a", "b"), met.filter("upper is not null")
    if many := slices.count():
        compared = slices.repartition(-(-many // 4)).mapInArrow(_meet_slices(most), PAIRS)
        pairs = pairs.unionByName(stored(compared.select("a", "b"), "lattice-pairs"))
    return pairs


def _blocks(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows (a, slice, visits, rep, copies, embedding): each slice of a group that has to be compared, and
    the vectors that are compared with it. Of a pair of groups the smaller one visits the larger."""
    size = F.ceil(F.col("size") / SLICE).cast("int")
    groups = stored(
        vectors.groupBy("group").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "lattice-sizes"
    )

    def sized(name: str) -> DataFrame:
        return groups.select(F.col("group").alias(name), F.col("size").alias(f"size_{name}"))

    a, b = (F.struct(F.coalesce(f"size_{x}", F.lit(1)).alias("size"), F.col(x).alias("a")) for x in "ab")
    visits = stored(
        pairs.distinct().join(sized("a"), "a", "left").join(sized("b"), "b", "left")
        .select(F.greatest(a, b).alias("to"), F.least(a, b).alias("of"))
        .select(F.col("of.a").alias("group"), "to.a", F.col("to.size").alias("size")),
        "lattice-visits",
    )
    same = groups.select("group", F.col("group").alias("a"), "size")
    staying = visits.select(F.col("a").alias("group"), "a", "size").unionByName(same).distinct()
    tasks = (
        staying.withColumn("kind", F.lit(0))
        .unionByName(visits.withColumn("kind", F.lit(1)))
        .unionByName(same.filter(F.col("size") > SLICE).withColumn("kind", F.lit(2)))
        .withColumn("slices", size)
    )
    own = F.pmod(F.xxhash64("rep", F.lit(7)), "slices").cast("int")
    nowhere = F.array().cast("array<int>")
    places = (
        F.when(F.col("kind") == 0, F.array("own"))
        .when(F.col("kind") == 1, F.sequence(F.lit(0), F.col("slices") - 1))
        .otherwise(F.when(F.col("own") > 0, F.sequence(F.lit(0), F.col("own") - 1)).otherwise(nowhere))
    )
    return (
        vectors.select("rep", "copies", "group", "embedding")
        .join(tasks, "group")
        .withColumn("own", own)
        .select("a", F.explode(places).alias("slice"), (F.col("kind") > 0).alias("visits"), "rep", "copies", "embedding")
    )


def _links(different: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """The different vectors, and (rep, linked, other): numbers of links, to be added up, and edges that
    connect what links connect."""
    spark = different.sparkSession
    schema = T.StructType([*different.schema.fields, T.StructField("signs", T.BinaryType())])
    path = run_folder(spark, "lattice-vectors")
    vectors = materialise(different.mapInArrow(_signed, schema), path)
    n, numbers = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("embedding")), F.lit(0))).first()
    each = 4 if vectors.schema["embedding"].dataType.elementType == T.FloatType() else 8
    tables, blocks = shape_of_index(n)
    most = most_differing(cosine, 64), most_differing(cosine, SIGNS)
    a_pass = int(max(PASS_BYTES, PASS_SHARE * each * numbers) // (2 * ENTRY.itemsize * max(n, 1)))
    a_pass = min(max(a_pass, 1), tables)
    vectors = _grouped(vectors, range(min(LEADING, a_pass)), blocks, n, most)
    remove(spark, path)
    pairs = None
    for first in range(0, tables, a_pass):
        found = _paired(vectors, range(first, min(first + a_pass, tables)), blocks, n, most)
        pairs = pairs.unionByName(found) if pairs else found
    order = ["a", "slice", "visits"]
    found = stored(
        _blocks(vectors, pairs)
        .repartition("a", "slice")
        .sortWithinPartitions(*order)
        .mapInArrow(_verify(cosine), "rep long, linked long, other long"),
        "lattice-links",
    )
    return vectors, found


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding)."""
    ship_package(embeddings.sparkSession)
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    double = F.transform("embedding", lambda x: x.cast("double"))
    largest = F.array_max(F.transform(double, F.abs))
    usable = (
        F.col("vec_id").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall(double, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & (largest > 0)
    )
    checked = vectors.withColumn("usable", F.coalesce(usable, F.lit(False)))
    names = {"rep": F.xxhash64("embedding"), "check": F.xxhash64(F.lit(1), "embedding")}
    different = (
        checked.filter("usable")
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumns(names)
    )
    with freed_shuffles(embeddings.sparkSession):
        distinct, found = _links(different, cosine)
        linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
        classes = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
        named = (
            distinct.join(linked, "rep", "left")
            .join(classes, F.col("rep") == F.col("node"), "left")
            .select(
                "rep", "check", "first", "copies",
                F.coalesce("linked", F.lit(0)).alias("linked"),
                F.coalesce("component_id", "rep").alias("component"),
            )
        )
        smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
        answer = stored(named.join(smallest, "component").drop("component"), "lattice-classes")
    rows = checked.filter("usable").select("vec_id", *[value.alias(name) for name, value in names.items()])
    joined = rows.join(answer, list(names)).select(
        "vec_id", (F.col("linked") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    alone = checked.filter("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
