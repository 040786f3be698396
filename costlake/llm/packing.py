"""Packing tokenised documents into fixed windows by bounded-space best fit.

Each partition is one pass over its documents with a fixed number of open windows. A document longer
than a window fills whole windows with its first pieces; the rest goes where it leaves the least
room. If it fits nowhere, the fullest open window is emitted and a new one is opened. The windows
still open at the end of the partitions are merged: their pieces are packed again, the longest
first, in ever fewer groups, until one group is left. A window with little room left is settled, and of the others
a group passes on only as many as a partition may keep open, those with the most room: so a group of any round holds
a fixed number of windows at most, however large the input.

Edge cases: a null or empty text is its end token alone; repeated rows are documents of their own;
an empty table gives no piece; columns other than doc_id and text are ignored; a document of any
length is cut into as many pieces as it takes, each of which lies in one window.
"""

from __future__ import annotations

import os
import re
import struct
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import ship_package, stored

WINDOW = 1024
OPEN_WINDOWS = 64
END_ID = 0
#: A window with no more than this share of it free is not filled further.
SETTLED = 0.05
#: Groups of this many partitions (or groups) are merged into one in each round.
FAN_IN = 32
#: Pieces of text whose ids are kept by a Python worker.
CACHE = 200_000
#: Documents, and bytes of their texts, that are encoded at a time; a longer text is encoded alone.
DOCUMENTS, TEXT_BYTES = 1000, 1 << 20

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "open boolean, origin long, ids binary"
)
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("open", pa.bool_()), ("origin", pa.int64()), ("ids", pa.binary()),
    ]
)


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    A byte-level BPE of this kind merges within pre-tokens only. A text of plain characters (ASCII and Latin
    letters) is cut into those in one regex pass. Any other text, or one that may hold a special token, is cut at
    single spaces between two other characters, where pre-tokens begin; where white space is adjacent to
    white space nothing is cut. Each distinct piece is encoded once per batch or taken from the cache.
    """

    def __init__(self, path: str, ranks: str | None = None):
        # A task has one core; the library's own threads would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.ranked = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )

    def ids_of(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece: from the ranks where they are given, but for strings of special tokens."""
        if self.ranked is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        encode, special = self.ranked.encode_ordinary, self.special
        return [
            self.tokenizer.encode(p, add_special_tokens=False).ids if any(s in p for s in special) else encode(p)
            for p in pieces
        ]

    @staticmethod
    def pieces(text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return _PRE_TOKEN.findall(text)
        if "\0" not in text and not _SPACE_BY_SPACE.search(text):
            return text.replace(" ", "\0 ").split("\0")
        parts = text.split(" ")
        out = [parts[0]]
        for part in parts[1:]:
            before = out[-1]
            if not part or not before or part[0].isspace() or before[-1].isspace():
                out[-1] = f"{before} {part}"
            else:
                out.append(" " + part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.pieces(t) for t in texts]
        known = self.known
        new = list(set().union(*cut) - known.keys())
        fresh = {}
        for start in range(0, len(new), 20_000):
            some = new[start : start + 20_000]
            for piece, got in zip(some, self.ids_of(some)):
                fresh[piece] = struct.pack(f"<{len(got)}I", *got)
        known.update(fresh)
        out = [b"".join(map(known.__getitem__, parts)) for parts in cut]
        full = len(known) > CACHE
        for piece in fresh:
            if full or len(piece) > 40:
                del known[piece]
        return out


#: ASCII and Latin letters up to 17F.
_PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*")
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
#: The pre-tokens of such a text.
_PRE_TOKEN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\t-\r {_LETTER}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
_SPACE_BY_SPACE = re.compile(r"\s | \s|^ | $")

_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, ranks: str | None) -> Encoder:
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = Encoder(path, ranks)
    return _encoders[path, ranks]


class Windows:
    """At most ``most`` open windows, ordered by the room that is left in them."""

    def __init__(self, size: int, most: int | None, first_id: int):
        self.size, self.most, self.next_id = size, most, first_id
        self.rooms: list[tuple[int, int]] = []  # (room, window id), sorted

    def place(self, length: int) -> tuple[int, int, int | None]:
        """(window, offset, window that was emitted for it or None) for a piece of that length."""
        at = bisect_left(self.rooms, (length, -1))
        emitted = None
        if at < len(self.rooms):
            room, window = self.rooms.pop(at)
        else:
            if self.most is not None and len(self.rooms) >= self.most:
                emitted = self.rooms.pop(0)[1]
            room, window = self.size, self.next_id
            self.next_id += 1
        if room > length:
            insort(self.rooms, (room - length, window))
        return window, self.size - room, emitted

    def open_ids(self, most: int) -> set[int]:
        """Up to ``most`` windows that are worth filling further, those with the most room."""
        return {window for room, window in self.rooms[-most:] if room > self.size * SETTLED}


def encoded_at_once(
    texts: pa.Array, documents: int = DOCUMENTS, text_bytes: int = TEXT_BYTES
) -> Iterator[tuple[int, int]]:
    """(begin, rows) of the slices of a batch that are encoded one after another."""
    begin, held = 0, 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for i, size in enumerate(sizes):
        if i > begin and (i - begin >= documents or held + size > text_bytes):
            yield begin, i - begin
            begin, held = i, 0
        held += size
    if sizes:
        yield begin, len(sizes) - begin


def _first_pass(path: str, ranks: str | None, window: int, most: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks).encode
        origin = TaskContext.get().partitionId()
        windows = Windows(window, most, origin << 32)
        waiting: dict[int, list[tuple]] = {}  # pieces of windows that are still open
        end = np.array([end_id], dtype="<u4").tobytes()

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in _SCHEMA]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA
            )

        for batch in batches:
            for begin, rows in encoded_at_once(batch.column(1)):
                part = batch.slice(begin, rows)
                done = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encode(texts)):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        length = min(window, total - start)
                        chosen, offset, emitted = windows.place(length)
                        piece = (
                            doc, start, length, total, chosen, offset, False, origin,
                            ids[4 * start : 4 * (start + length)],
                        )
                        if emitted is not None:
                            done += waiting.pop(emitted)
                        held = waiting.setdefault(chosen, [])
                        held.append(piece)
                        if offset + length == window:
                            done += waiting.pop(chosen)
                yield table(done)
        still = windows.open_ids(most)
        yield table([(*p[:6], p[4] in still, *p[7:]) for pieces in waiting.values() for p in pieces])

    return run


def _merge(window: int, most: int, level: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        group = int(pieces["group"].iloc[0])
        pieces = pieces.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True])
        windows = Windows(window, None, (level << 56) + (group << 32))
        placed = [windows.place(n)[:2] for n in pieces["length"].tolist()]
        target = np.array([p[0] for p in placed], dtype=np.int64)
        still = windows.open_ids(most)
        return pd.DataFrame(
            {
                "group": group,
                "sequence_id": pieces["sequence_id"], "offset": pieces["offset"], "length": pieces["length"],
                "new_sequence": target,
                "new_offset": np.array([p[1] for p in placed], dtype=np.int64),
                "open": np.fromiter((t in still for t in target.tolist()), dtype=bool, count=len(target)),
            }
        )

    return run


def merged_leftovers(leftovers: DataFrame, window: int, origins: int, fan_in: int, most: int) -> DataFrame:
    """(sequence_id, offset, new_sequence, new_offset) of the pieces in windows that stayed open.

    A group holds the open windows of ``fan_in`` partitions, or of as many groups of the round before: ``most``
    of each. There is one round for every power of ``fan_in`` in the number of partitions.
    """
    level, groups = 1, -(-origins // fan_in)
    current = leftovers.select(
        F.floor(F.col("origin") / fan_in).alias("group"), "sequence_id", "offset", "length",
        F.col("sequence_id").alias("first_sequence"), F.col("offset").alias("first_offset"),
    )
    settled = []
    keys = ["sequence_id", "offset"]
    schema = (
        "group long, sequence_id long, offset long, length long, new_sequence long, new_offset long, open boolean"
    )
    while True:
        plan = (
            current.select("group", *keys, "length")
            .groupBy("group")
            .applyInPandas(_merge(window, most, level), schema)
        )
        moved = stored(
            current.select(*keys, "first_sequence", "first_offset").join(plan, keys), "pack-leftovers"
        )
        last = groups <= 1
        closed = moved if last else moved.filter(~F.col("open"))
        settled.append(
            closed.select(
                F.col("first_sequence").alias("sequence_id"), F.col("first_offset").alias("offset"),
                "new_sequence", "new_offset",
            )
        )
        if last:
            break
        level, groups = level + 1, -(-groups // fan_in)
        current = moved.filter("open").select(
            F.floor(F.col("group") / fan_in).alias("group"),
            F.col("new_sequence").alias("sequence_id"), F.col("new_offset").alias("offset"), "length",
            "first_sequence", "first_offset",
        )
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def pack(
    documents: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = END_ID,
    fan_in: int = FAN_IN,
    ranks: str | None = None,
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) of every piece; ``ids`` are the
    tokens as little-endian unsigned 32-bit values. ``tokenizer`` is the path of a byte-level BPE file;
    ``ranks`` that of the same vocabulary as ranks, which gives the same ids in a quarter of the time.

    Pieces are written to the shared folder once: which window took a piece depends on the order in
    a partition, and a lost task must not make that choice again for half of the result.
    """
    ship_package(documents.sparkSession)
    placed = stored(
        documents.select("doc_id", "text").mapInArrow(
            _first_pass(tokenizer, ranks, window, open_windows, end_id), PIECES
        ),
        "pack-pieces",
    )
    leftovers = placed.filter("open")
    origins = (leftovers.agg(F.max("origin")).first()[0] or 0) + 1
    moves = merged_leftovers(leftovers, window, origins, fan_in, open_windows)
    columns = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    merged = leftovers.join(moves, ["sequence_id", "offset"]).select(
        "doc_id", "start", "length", "doc_tokens",
        F.col("new_sequence").alias("sequence_id"), F.col("new_offset").alias("offset"), "ids",
    )
    return placed.filter(~F.col("open")).select(*columns).unionByName(merged)
