"""Token files against the tokenizer, and the wavelet matrix against plain arrays."""

import io
import os
from zlib import crc32

import numpy as np
import pytest
from conftest import SF_DIR
from test_edges import TEXTS, docs, none  # noqa: F401

from costlake.llm import token_files
from costlake.llm.queries import REGISTERED, word_tokenizer_path
from costlake.llm.token_files import TokenShard, shard_bytes
from costlake.llm.wavelet import WaveletMatrix


def encoded(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def crc(ids):
    return crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("folder", [SF_DIR, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    expected, at = [], 0
    for row, ids in zip(rows, encoded([r.text for r in rows])):
        expected.append((row.doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in REGISTERED["op12_token_files"](spark, folder).collect()) == expected


ODD = [
    "a\u001cb c\u0085d", "İstanbul ΣΑΣ ς", "é ́x ñ", "<|endoftext|> x<|startoftext|>y", "it's we'll 'S 12345",
    " x　y z", "ﬁ ß 😀😀 中文字", " \n ", "don't''s", "​zero‍width",
]


def test_odd_texts_are_cut_without_a_change(spark):
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    found = token_files.write_tokens(odd, word_tokenizer_path()).documents().collect()
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in found}
    assert [ids[i] for i in range(len(ODD))] == encoded(ODD)


def test_edges(spark, docs, none):  # noqa: F811
    written = token_files.write_tokens(docs, word_tokenizer_path(), shard_tokens=700)
    found = written.documents().orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((t[0] for t in TEXTS), key=lambda d: (d is not None, d))
    assert written.manifest.count() > 1
    at = 0
    for r in found:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    wanted = sorted(tuple(ids) for ids in encoded([t[1] for t in TEXTS]))
    assert sorted(tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in found) == wanted
    assert token_files.write_tokens(none, word_tokenizer_path()).documents().count() == 0
    assert not [f for f in os.listdir(written.folder.replace("file://", "")) if not f.endswith((".wm", ".crc"))]


def test_occurrences_are_looked_up_in_the_files(spark, docs):  # noqa: F811
    written = token_files.write_tokens(docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), word_tokenizer_path())
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in written.documents().collect()}
    token = max({t for one in ids.values() for t in one}, key=lambda t: sum(one.count(t) for one in ids.values()))
    found = written.occurrences([token, 2, 48_000, 70_000]).collect()
    expected = sorted((t, d, i) for d, one in ids.items() for i, t in enumerate(one) if t in (token, 2, 48_000))
    assert sorted(tuple(r) for r in found) == expected


def test_a_rerun_leaves_the_same_files(spark, docs, tmp_path):  # noqa: F811
    folders = [str(tmp_path / name) for name in "ab"]
    for folder in folders:
        token_files.write_tokens(docs.repartition(5 if folder.endswith("a") else 2), word_tokenizer_path(), folder)
    contents = [
        b"".join(open(os.path.join(f, name), "rb").read() for name in sorted(os.listdir(f)) if name.endswith(".wm"))
        for f in folders
    ]
    assert contents[0] == contents[1] and contents[0]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 200_000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 1000, n)
    stored = TokenShard(io.BytesIO(shard_bytes([None, 5], np.array([n // 2, n]), values.astype(np.uint32), 10)))
    for matrix in (WaveletMatrix.of(values, 10), stored.matrix):
        if n:
            at = rng.integers(0, n, 100)
            assert (matrix.access(at) == values[at]).all()
            value, end, k = values[rng.integers(0, n, 40)], rng.integers(0, n + 1, 40), rng.integers(0, 5, 40)
            assert matrix.rank(value, end).tolist() == [(values[:b] == a).sum() for a, b in zip(value, end)]
            places = [np.flatnonzero(values == a) for a in value]
            assert matrix.select(value, k).tolist() == [p[i] if i < len(p) else -1 for p, i in zip(places, k)]
            low = rng.integers(0, n, 40)
            high = np.maximum(low + 1, rng.integers(0, n + 1, 40))
            parts = [np.sort(values[a:b]) for a, b in zip(low, high)]
            bound = rng.integers(0, 1100, 40)
            less = [int(np.searchsorted(p, b)) for p, b in zip(parts, bound)]
            assert matrix.count_less(low, high, bound).tolist() == less
            assert matrix.successor(low, high, bound).tolist() == [p[i] if i < len(p) else -1 for p, i in zip(parts, less)]
            half = (high - low) // 2
            assert matrix.smallest(low, high, half).tolist() == [p[i] for p, i in zip(parts, half)]
        assert (matrix.decode() == values).all()
    assert (stored.occurrences(7) == np.flatnonzero(values == 7)).all()
    assert stored.occurrences(1 << 20).tolist() == []


def test_few_blocks_are_read_for_one_token():
    values = np.random.default_rng(1).integers(0, 4096, 1 << 20).astype(np.uint32)
    shard = TokenShard(io.BytesIO(shard_bytes([1], np.array([len(values)]), values, 12)))
    assert shard.matrix.access(np.array([777_777])).tolist() == [values[777_777]]
    assert sum(int(plane.loaded.sum()) for plane in shard.matrix.planes) <= 3 * 12  # of 16 blocks a plane


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        TokenShard(io.BytesIO(b"PAR1" * 20))


def test_parts_get_the_ids_of_the_whole_tokenizer():
    """Words of plain letters go to the model at once, every other part does not."""
    encoder = token_files.WordEncoder(word_tokenizer_path())
    letters = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
    rng = np.random.default_rng(4)
    parts = [*letters, *("".join(rng.choice(list(letters), rng.integers(1, 30))) for _ in range(3000))]
    parts += ["ab", "the", "x" * 300, "İi", "Ab", "ªº", "á", "日本", "1", "'s", "a'll", "¡a", "ſt", "ßẞ", "<|x|>", ""]
    calls = []

    class Whole:
        def encode_batch_fast(self, some, **options):
            calls.extend(some)
            return encoder_tokenizer.encode_batch_fast(some, **options)

    encoder_tokenizer, encoder.tokenizer = encoder.tokenizer, Whole()
    found = dict(encoder.ids_of(parts))
    assert found == {p: encoder_tokenizer.encode(p, add_special_tokens=False).ids for p in parts}
    assert set(calls) == {"İi", "Ab", "ªº", "á", "日本", "1", "'s", "a'll", "¡a", "ſt", "ßẞ", "<|x|>", ""}


def test_each_distinct_piece_is_cut_once(monkeypatch):
    """However often texts repeat a piece; ids are those of the tokenizer, whatever the cache holds by then."""
    cut = []

    class Parts:
        findall = staticmethod(lambda text, findall=token_files._PART.findall: (cut.append(text), findall(text))[1])

    monkeypatch.setattr(token_files, "_PART", Parts)
    encoder = token_files.WordEncoder(word_tokenizer_path())
    texts = ["The cat's 12 hats, the cat!", "", " \t", "ça-va THE", "x" * 60 + ", cat", "日本 the cat's"] * 300
    wanted = [np.array(ids[:-1], "<u4").tobytes() for ids in encoded(texts)]
    assert encoder.encode(texts) == wanted
    assert len(cut) == len(set(cut)) <= 9
    monkeypatch.setattr(token_files, "CACHE", len(encoder.known))
    assert encoder.encode(texts) == wanted and encoder.encode([]) == []
    assert encoder.encode(["neverseen, cat"] * 2) == [
        np.array(ids[:-1], "<u4").tobytes() for ids in encoded(["neverseen, cat"] * 2)
    ]
    assert "neverseen" not in encoder.known
