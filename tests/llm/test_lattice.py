import contextlib
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from costlake.llm import embeddings


def table(spark, rows):
    return spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<float>")


def shuffled_bytes(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [files.apply(i).getPath() for i in range(files.size())]
    return sum(os.path.getsize(p) for p in paths if "shuffle_" in p and os.path.exists(p))


def test_shuffles_are_bounded_by_the_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((3000, 512)).astype(np.float32)
    df = table(spark, enumerate(vectors))
    before, seen, over = shuffled_bytes(spark), [], threading.Event()

    def watch():
        while not over.wait(0.05):
            with contextlib.suppress(OSError):  # a file may go meanwhile
                seen.append(shuffled_bytes(spark) - before)

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        found = embeddings.near_duplicates(df)
    finally:
        over.set()
        watching.join()
    assert 0 < max(seen) < 4 * vectors.nbytes
    assert shuffled_bytes(spark) - before < vectors.nbytes
    assert found.count() == 3000


def test_a_cell_gets_48_bytes_of_a_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(512).tolist(), b"\0" * 32) for i in range(100)]
    df = spark.createDataFrame(rows, "group long, embedding array<double>, signs binary")
    sent = embeddings._entries(df, range(3), 2, 100)
    assert sent.agg(F.sum(F.length("entries"))).first()[0] == 100 * 3 * 2 * 48


@pytest.mark.parametrize("cut", [False, True])
def test_links_of_dense_clusters_are_counted_once(spark, monkeypatch, cut):
    if cut:  # one table in a pass, slices of groups and of cells
        for name, value in {"PASS_BYTES": 1, "PASS_SHARE": 0, "SLICE": 20, "CROWD": 30}.items():
            monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((3, 32))
    around = lambda centre, n, s: centre + s * rng.standard_normal((n, 32))
    chain = np.cumsum(np.vstack([centres[2], 0.13 * rng.standard_normal((30, 32))]), axis=0)
    parts = [around(centres[0], 120, 0.05), around(centres[1], 60, 0.2), chain, rng.standard_normal((100, 32))]
    vectors = np.vstack([*parts, parts[0][:5], 2 * parts[3][:4]]).astype(np.float32)
    vectors[-5, :8], vectors[-4, :8] = 0.0, -0.0
    vectors[-4, 8:] = vectors[-5, 8:]
    rows = [*enumerate(vectors), *((1000 + i, v) for i, v in enumerate(rng.standard_normal((5, 8)).astype(np.float32)))]
    expected = brute.cosine_classes([(i, v.tolist()) for i, v in rows], 0.95)
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(table(spark, rows)).collect()}
    assert {i: n for i, (n, _) in found.items() if n > expected[i][0]} == {}
    assert sum(n for n, _ in found.values()) >= 0.98 * sum(n for n, _ in expected.values())
    assert [found[i] for i in range(120)] == [expected[i] for i in range(120)]
    assert sum(found[i][1] == expected[i][1] for i in found) >= 0.98 * len(found)


def test_cut_cells_give_the_same_pairs():
    rng = np.random.default_rng(4)
    entries = np.zeros(400, dtype=embeddings.ENTRY)
    entries["cell"] = np.repeat([4, 10], [300, 100]) + rng.integers(0, 2, 400)
    entries["group"] = np.repeat(rng.permutation(130), rng.integers(1, 60, 130))[:400]
    signs = rng.integers(0, 1 << 63, (6, 4), dtype=np.uint64)[rng.integers(0, 6, 400)]
    entries["signs"] = signs ^ (np.uint64(1) << rng.integers(0, 63, (400, 4)).astype(np.uint64))
    most = (20, 51)
    home, cell = entries["cell"] % 2 == 0, entries["cell"] // 2
    near = np.bitwise_count(entries["signs"][:, None] ^ entries["signs"][None]).sum(axis=2) <= 51
    near &= (cell[:, None] == cell) & (home[:, None] | home) & (entries["group"][:, None] < entries["group"])
    group = entries["group"]
    expected = {(int(group[i]), int(group[j])) for i, j in zip(*np.nonzero(near))}
    blobs = lambda batches, *names: [[b.column(c)[k] for c in names] for b in batches for k in range(b.num_rows)]
    sent = embeddings.pa.RecordBatch.from_arrays([embeddings.pa.array([entries.tobytes()])], names=["entries"])
    for crowd in (20, 1000):
        met = list(embeddings._meet(most, crowd)([sent]))
        cut = [b for b in met if b.num_rows and b.column("upper")[0].is_valid]
        assert bool(cut) == (crowd < 400)
        met = [b for b in met if not (b.num_rows and b.column("upper")[0].is_valid)]
        met += list(embeddings._meet_slices(most)(cut))
        assert {(a.as_py(), b.as_py()) for a, b in blobs(met, "a", "b")} == expected
    vector, leader = embeddings._Meetings(entries, most).leaders()
    assert len(vector) and all((b, a) in expected for a, b in zip(vector.tolist(), leader.tolist()))
