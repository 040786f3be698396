"""Token ids in binary files: one wavelet matrix per shard, compressed block by block.

Documents are dealt by ranges of their id, encoded, and written in ascending order; a task writes as
many shards as its tokens need, each one file. A file holds the document table and, for every bit of
an id, a bit plane in blocks of 2**16 bits, with their places and the ones before them. So a reader
gets whole documents by undoing the planes, or single tokens, counts and occurrences by rank and
select, for which only the blocks it meets are read and decompressed.

File: MAGIC, then ``HEADER`` (tokens, documents, bits, bytes of the document table, blocks of a plane),
the document table (ids, whether an id is null, ends; compressed), the places of all blocks, the ones
before them, then the blocks. Whole numbers are little-endian. A block is stored as it is where
compression does not shorten it.

A file is written under a name of its own and then moved, and its bytes follow from the documents
alone (order: doc_id, hash of the text, text), so a task that runs twice leaves the same files.

Edge cases: a null or empty text is its end token alone; a null id comes before all others; repeated
rows are documents of their own, one after another; an empty table gives no file and no row; a document of
any length lies whole in one shard; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlake.llm.common import ship_package, stored
from costlake.llm.packing import encoded_at_once
from costlake.llm.wavelet import BitPlane, WaveletMatrix
from costlake.session import run_folder

END_ID = 2
#: A shard is closed once it holds so many tokens.
SHARD_TOKENS = 1 << 22
BLOCK_BITS = 1 << 16
#: Parts of texts whose ids are kept by a Python worker.
CACHE = 200_000
#: Documents that are decoded at a time.
DOCUMENTS = 500
#: Documents, and bytes of their texts, that are encoded at a time: a word that they repeat is looked up once.
ENCODED, TEXT_BYTES = 5000, 8 << 20

MAGIC = b"WMTOKENS1\0\0\0\0\0\0\0"
HEADER = struct.Struct("<QQIII")
MANIFEST = "file string, part int, shard int, documents long, tokens long"
DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"
OCCURRENCE = "token long, doc_id long, position long"

_WORD_BLOCK = BLOCK_BITS // 64
_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: ASCII and Latin letters up to 17F, but for the one whose lower case is two characters.
_PLAIN = re.compile("[\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
#: What the tokenizer cuts lower-cased text into.
_PART = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^\t-\r a-z0-9\u00df-\u00f6\u00f8-\u017f]+"
)
#: Lower-case letters of one or two bytes that the tokenizer leaves as they are and never cuts between.
_WORD = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: How a byte-level model writes those of two bytes; it renames the few bytes that are no visible characters.
_BYTES = {
    c: "\u00c3" + {0x9F: "\u0141", 0xA0: "\u0142", 0xAD: "\u0143"}.get(c - 0x40, chr(c - 0x40))
    for c in range(0xDF, 0x100)
}
#: Ids of a part as little-endian unsigned 32-bit values, by their number.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]


class WordEncoder:
    """Token ids of texts by a tokenizer that drops white space, lower-cases, and cuts what is left into runs
    of letters, single digits, runs of other characters, and the English endings after an apostrophe.

    A text of plain characters (ASCII and Latin letters, which the tokenizer's normal form leaves alone) is cut
    at white space, by Arrow; each distinct piece of a batch is then cut here as the tokenizer does, in one
    regex pass, unless it is in the cache. Any other text, or one that may hold a special token, is cut at white
    space only. Each distinct part is encoded once per batch or taken from the cache. A part of plain
    lower-case letters goes to the tokenizer's model at once, as the steps before it change nothing.
    """

    def __init__(self, path: str):
        # A task has one core; the library's own threads would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.largest = self.tokenizer.get_vocab_size(with_added_tokens=True) - 1
        self.known: dict[str, bytes] = {}
        self.model = self.tokenizer.model

    def ids_of(self, parts: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Each part, in any order, with its ids."""
        tokenize, is_word, other = self.model.tokenize, _WORD.fullmatch, []
        for part in parts:
            if is_word(part):
                yield part, [t.id for t in tokenize(part if part.isascii() else part.translate(_BYTES))]
            else:
                other.append(part)
        for start in range(0, len(other), 20_000):
            some = other[start : start + 20_000]
            for part, one in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                yield part, one.ids

    def fresh_ids(self, cut: list[list[str]]) -> dict[str, bytes]:
        """Ids of the parts that the cache does not hold; it takes them as far as it has room."""
        missing = list(set().union(*cut) - self.known.keys())
        fresh = {part: _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)
                 for part, ids in self.ids_of(missing)}
        room = max(0, CACHE - len(self.known))
        self.known.update(islice(((part, ids) for part, ids in fresh.items() if len(part) <= 40), room))
        return fresh

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of plain characters. Arrow cuts them at white space and puts their ids together; Python
        sees the distinct pieces only."""
        cut = pc.ascii_split_whitespace(pa.array([text.lower() for text in texts], pa.large_string()))
        coded = cut.values.dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known
        ids = list(map(known.get, pieces))
        new = [i for i, found in enumerate(ids) if found is None]
        parts_of = [_PART.findall(pieces[i]) for i in new]
        fresh = self.fresh_ids(parts_of)
        for i, parts in zip(new, parts_of):
            ids[i] = (
                fresh[parts[0]] if len(parts) == 1 else b"".join([fresh[p] if p in fresh else known[p] for p in parts])
            )
        joined = pa.array(ids, pa.large_binary()).take(coded.indices)
        raw = joined.buffers()[2]
        raw = memoryview(raw) if raw else b""
        places = np.concatenate(([0], np.cumsum(pc.binary_length(joined).to_numpy())))
        ends = places[cut.offsets.to_numpy()].tolist()
        return [bytes(raw[start:end]) for start, end in zip(ends, ends[1:])]

    def encode_other(self, texts: list[str]) -> list[bytes]:
        """Ids of any texts."""
        # Python alone takes the separators 1C to 1F for white space.
        cut = [text.split(" ") if _ODD_SPACE.search(text) else text.split() for text in texts]
        fresh, known = self.fresh_ids(cut), self.known
        return [b"".join([fresh[p] if p in fresh else known[p] for p in parts]) for parts in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit values."""
        plain = [bool(_PLAIN.fullmatch(text)) and "<|" not in text for text in texts]
        in_order = {
            kind: iter(run([text for text, own in zip(texts, plain) if own == kind]))
            for kind, run in ((True, self.encode_plain), (False, self.encode_other))
        }
        return [next(in_order[kind]) for kind in plain]


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder and the path in it, as a task reaches them."""
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


def shard_bytes(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """A shard's file."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1).compress
    table = squeeze(
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
        + np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes()
        + ends.astype("<i8").tobytes()
    )
    matrix = WaveletMatrix.of(ids, bits)
    blocks, before = [], []
    for plane in matrix.planes:
        raw = plane.words.astype("<u8", copy=False)
        for word in range(0, len(raw), _WORD_BLOCK):
            before.append(plane.before[word])
            whole = raw[word : word + _WORD_BLOCK].tobytes()
            small = squeeze(whole)
            blocks.append(small if len(small) < len(whole) else whole)
    places = np.cumsum([0, *map(len, blocks)], dtype="<i8")
    return b"".join(
        [
            MAGIC, HEADER.pack(len(ids), len(doc_ids), bits, len(table), len(blocks) // bits), table,
            places.tobytes(), np.array(before, dtype="<i8").tobytes(), *blocks,
        ]
    )


class _StoredPlane(BitPlane):
    """A plane of a file: a block is read when a query first needs it."""

    def __init__(self, shard: TokenShard, level: int):
        self.n, self.shard, self.level = shard.n, shard, level
        count = -(-self.n // 64)
        self.words = np.zeros(count, dtype=np.uint64)
        self.before = np.zeros(count + 1, dtype=np.int64)
        first = level * shard.blocks
        self.block_before = shard.ones_before[first : first + shard.blocks]
        self.loaded = np.zeros(shard.blocks, dtype=bool)

    def need(self, words: np.ndarray) -> None:
        wanted = np.unique(words // _WORD_BLOCK)
        for block in wanted[~self.loaded[wanted]].tolist():
            start = block * _WORD_BLOCK
            end = min(start + _WORD_BLOCK, len(self.words))
            self.words[start:end] = self.shard.block(self.level, block, 8 * (end - start))
            ones = np.cumsum(np.bitwise_count(self.words[start:end]).astype(np.int64))
            self.before[start] = self.block_before[block]
            self.before[start + 1 : end] = self.block_before[block] + ones[:-1]
            if end == len(self.words):
                self.before[end] = self.block_before[block] + ones[-1]
            self.loaded[block] = True

    @property
    def ones(self) -> int:
        if self.n:
            self.need(np.array([len(self.words) - 1]))
        return int(self.before[-1])

    def bits(self) -> np.ndarray:
        self.need(np.arange(0, len(self.words), _WORD_BLOCK))
        return super().bits()

    def select(self, k: np.ndarray, bit: bool) -> np.ndarray:
        """Which block holds a bit is told by the counts before the blocks."""
        starts = np.arange(len(self.block_before), dtype=np.int64) * BLOCK_BITS
        before = self.block_before if bit else starts - self.block_before
        block = np.searchsorted(before, k, side="right") - 1
        self.need(np.unique(block) * _WORD_BLOCK)
        out = np.empty(len(k), dtype=np.int64)
        for one in np.unique(block).tolist():
            mine = block == one
            part = BitPlane(self.words[one * _WORD_BLOCK : (one + 1) * _WORD_BLOCK], 0)
            out[mine] = one * BLOCK_BITS + part.select(k[mine] - before[one], bit)
        return out


class TokenShard:
    """One file, read where a query needs it. ``source`` is a seekable binary file."""

    def __init__(self, source):
        import zstandard

        self.source = source
        self.unpack = zstandard.ZstdDecompressor().decompress
        head = self._read(0, len(MAGIC) + HEADER.size)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self.n, documents, self.bits, table, self.blocks = HEADER.unpack_from(head, len(MAGIC))
        at = len(head)
        rows = self.unpack(self._read(at, table))
        self.null = np.frombuffer(rows, np.uint8, documents, 8 * documents).view(bool)
        self.doc_ids = np.frombuffer(rows, "<i8", documents)
        self.ends = np.frombuffer(rows, "<i8", documents, 9 * documents)
        at += table
        places = 8 * (self.bits * self.blocks + 1)
        self.places = np.frombuffer(self._read(at, places), "<i8")
        self.ones_before = np.frombuffer(self._read(at + places, places - 8), "<i8")
        self.first_block = at + 2 * places - 8
        self.matrix = WaveletMatrix([_StoredPlane(self, level) for level in range(self.bits)], self.n)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block(self, level: int, block: int, size: int) -> np.ndarray:
        i = level * self.blocks + block
        raw = self._read(self.first_block + int(self.places[i]), int(self.places[i + 1] - self.places[i]))
        return np.frombuffer(raw if len(raw) == size else self.unpack(raw, max_output_size=size), "<u8")

    def document_of(self, position: np.ndarray) -> np.ndarray:
        """Number, in the file, of the document that holds each position."""
        return np.searchsorted(self.ends, position, side="right")

    def occurrences(self, token: int) -> np.ndarray:
        """Positions of a token, ascending."""
        if not 0 <= token < 1 << self.bits:
            return np.zeros(0, dtype=np.int64)
        found = int(self.matrix.count(np.array([token]))[0])
        return self.matrix.select(np.full(found, token), np.arange(found))


def _write_shards(path: str, folder: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        bits = max(encoder.largest, end_id).bit_length()
        part = TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        store, root = file_system(folder)
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        waiting, shard = 0, 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, held, waiting, shard
            ends = np.cumsum([len(ids) // 4 for ids in held])
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            name = f"tokens-{part:06d}-{shard:05d}.wm"
            own = f"{root}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as out:
                out.write(shard_bytes(doc_ids, ends, ids, bits))
            store.move(own, f"{root}/{name}")
            row = [[name], [part], [shard], [len(doc_ids)], [len(ids)]]
            doc_ids, held, waiting, shard = [], [], 0, shard + 1
            types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types)], ["file", "part", "shard", "documents", "tokens"]
            )

        for batch in batches:
            for begin, rows in encoded_at_once(batch.column("text"), ENCODED, TEXT_BYTES):
                some = batch.slice(begin, rows)
                texts = [t or "" for t in some.column("text").to_pylist()]
                for doc, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(texts)):
                    doc_ids.append(doc)
                    held.append(ids + end)
                    waiting += len(ids) // 4 + 1
                    if waiting >= shard_tokens:
                        yield close()
        if held:
            yield close()

    return run


def _document_rows(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as source:
                    shard = TokenShard(source)
                    raw = shard.matrix.decode().astype("<u4").tobytes()
                begins = np.concatenate(([0], shard.ends[:-1]))
                for at in range(0, len(shard.ends), DOCUMENTS):
                    some = slice(at, at + DOCUMENTS)
                    begin, end = begins[some], shard.ends[some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[some], mask=shard.null[some]),
                            pa.array(row["first"] + begin), pa.array(end - begin),
                            pa.array([raw[4 * a : 4 * b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return run


def _occurrence_rows(folder: str, tokens: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as source:
                    shard = TokenShard(source)
                    begins = np.concatenate(([0], shard.ends[:-1]))
                    for token in tokens:
                        found = shard.occurrences(token)
                        document = shard.document_of(found)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(found), token, dtype=np.int64)),
                                pa.array(shard.doc_ids[document], mask=shard.null[document]),
                                pa.array(found - begins[document]),
                            ],
                            ["token", "doc_id", "position"],
                        )

    return run


class TokenFiles:
    """A folder of token files. ``manifest``: file, part, shard, documents, tokens, first (tokens before it)."""

    def __init__(self, folder: str, manifest: DataFrame):
        self.folder, self.manifest = folder, manifest

    def _per_file(self, run, schema: str) -> DataFrame:
        files = self.manifest.select("file", "first")
        # A row stands for a whole file, so files are dealt out by number and not by bytes of these rows.
        return files.repartition(max(1, files.count()), "file").mapInArrow(run, schema)

    def documents(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids) of every document: where it starts among all ids, and its ids with
        the end id as little-endian unsigned 32-bit values."""
        return self._per_file(_document_rows(self.folder), DOCUMENT)

    def occurrences(self, tokens: list[int]) -> DataFrame:
        """(token, doc_id, position in the document) of every occurrence of the given token ids."""
        return self._per_file(_occurrence_rows(self.folder, [int(t) for t in tokens]), OCCURRENCE)


def write_tokens(
    documents: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> TokenFiles:
    """Encode ``documents`` (doc_id, text) into token files below ``folder``, a new folder in the shared one
    unless given. ``tokenizer`` is the path of a tokenizer file that drops white space and never merges
    across it.
    """
    spark = documents.sparkSession
    ship_package(spark)
    folder = folder or run_folder(spark, "token-files")
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    # The hash of the text splits rows of one id, null ids among them, over several ranges.
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = documents.select("doc_id", "text").repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    written = stored(
        ordered.mapInArrow(_write_shards(tokenizer, folder, end_id, shard_tokens), MANIFEST), "token-manifest"
    )
    return TokenFiles(folder, with_first(spark, written))


def with_first(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Adds ``first``, the tokens of all earlier files. Two steps, so that no task sees all files: one sum
    per part comes to the driver (there are as many as shuffle partitions), files are summed within a part."""
    parts = sorted(manifest.groupBy("part").agg(F.sum("tokens").alias("tokens")).collect())
    starts, before = [], 0
    for row in parts:
        starts.append((row["part"], before))
        before += row["tokens"]
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spark.createDataFrame(starts, "part int, before long")
    return manifest.join(offsets, "part").withColumn(
        "first", F.col("before") + F.coalesce(F.sum("tokens").over(earlier), F.lit(0))
    ).drop("before")
