"""Near copies of the pipeline against brute-force Jaccard similarity."""

import brute
import numpy as np
import pytest

import corpus_pipeline
from costlake.llm import near_copies, simhash


def shingles(text, n=5):
    words = brute.lower_ascii(text).split()
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def similar(rows):
    sets = [shingles(t) for _, t in rows]
    return [
        (i, j)
        for i in range(len(sets)) for j in range(i)
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    ]


def first_documents(rows):
    rows = sorted(rows)
    found = brute.classes(len(rows), similar(rows))
    return {rows[i][0] for i in range(len(rows)) if found[i] == i}


def copies(rng, n=40):
    """Texts with a few words changed, so that similarities lie on both sides of 0.8; and one passage in all."""
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for i in range(n):
        base = [f"w{rng.integers(1 << 30)}" for _ in range(200)]
        for changed in (0, 1, 3, 4, 5, 7):
            words = list(base)
            for at in rng.choice(200, changed, replace=False):
                words[at] = f"x{rng.integers(1 << 30)}"
            rows.append((len(rows), " ".join(words + passage)))
    return rows


@pytest.mark.parametrize("slice_rows", [1_000, 4])
def test_stage_keeps_one_of_all_that_share_four_fifths(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(near_copies.similar_links, "__defaults__", (slice_rows,))
    rows = copies(np.random.default_rng(5))
    assert any(a // 6 == b // 6 for a, b in similar(rows)) and len(first_documents(rows)) < len(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == first_documents(rows)


def test_driver_table(spark):
    """All classes of sf0.01, where 11 of 12 pairs below similarity 1 are over 3 bits of SimHash apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert len(kept) == len(set(kept)) and set(kept) == first_documents(rows)


def test_blank_and_short_texts(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "One  TWO"), (6, "one"), (None, "one"), (None, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept, key=str) == [1, 4, 6, None, None]
    assert corpus_pipeline.drop_near_copies(spark, docs.filter("false"), "").count() == 0


def test_groups_of_the_same_members_are_compared_once(spark):
    keyed = spark.createDataFrame(
        [(1, 10), (2, 10), (1, 11), (2, 11), (3, 12), (1, 13), (2, 13), (3, 13), (2, 14), (3, 14), (2, 15), (1, 15)],
        "print long, key long",
    )
    left = {(r.print, r.key) for r in near_copies.one_key_per_group(keyed).collect()}
    assert left == {(1, 10), (2, 10), (1, 13), (2, 13), (3, 13), (2, 14), (3, 14)}


def test_simhash_links_count_in_the_stage(spark):
    """Mostly one repeated line: repeats rule the SimHash, while the sets of shingles are far apart."""
    line = " ".join(f"r{k}" for k in range(9))
    tails = [" ".join(f"{name}{k}" for k in range(12)) for name in "ab"]
    rows = [(1, f"{line} " * 400 + tails[0]), (2, f"{line} " * 400 + tails[1]), (3, tails[0]), (4, tails[1])]
    assert not similar(rows)
    prints = [simhash.fingerprint(t.encode(), 5) for _, t in rows]
    assert (prints[0] ^ prints[1]).bit_count() <= simhash.DISTANCE
    # A third text that is like the second by its set alone: the chain goes over both kinds of links.
    rows.append((5, f"{line} {line} " + tails[1]))
    assert similar(rows) == [(4, 1)] and (simhash.fingerprint(rows[4][1].encode(), 5) ^ prints[1]).bit_count() > 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4}
    assert {tuple(r) for r in near_copies.similar_documents(docs).collect()} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 1)}


def test_repeated_ids_keep_their_rows(spark):
    rows = [(1, "a b c d e f g h"), (2, "k l m n o p q r"), (2, "a b c d e f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_copies.similar_documents(docs).collect()} == {(1, 1), (2, 2), (2, 1)}
