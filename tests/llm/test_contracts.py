"""The registered queries against brute force, over the smallest driver tables."""

import os
from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import SF_DIR

from costlake.llm import line_rules
from costlake.llm.queries import REGISTERED, tokenizer_path

FOLDER = os.environ.get("LLM_SF_DIR", SF_DIR)


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    return [(r.doc_id, r.text, r.source) for r in rows]


def test_mix(spark, docs):
    found = REGISTERED["op1_mix_sources"](spark, FOLDER).collect()
    again = REGISTERED["op1_mix_sources"](spark, FOLDER).collect()
    assert sorted(found) == sorted(again)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(brute.words(text))
    targets = brute.targets(sizes)
    source_of = {d: s for d, _, s in docs}
    size_of = {d: len(brute.words(t)) for d, t, _ in docs}
    assert len(found) == len(docs)
    for r in found:
        s = source_of[r.doc_id]
        assert r["size"] == size_of[r.doc_id] and r.source_size == sizes[s]
        assert r.target == pytest.approx(targets[s], rel=1e-9)
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 1


def test_ngram_lm(spark, docs):
    texts = [(d, t) for d, t, _ in docs]
    base, exact = brute.unigram_scores(texts), brute.pair_score(texts)
    for r in REGISTERED["op3_ngram_lm"](spark, FOLDER).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == base[r.doc_id][:3]
        assert r.base_score == pytest.approx(base[r.doc_id][3], rel=1e-9)
        assert r.held_out == (brute.fold(r.doc_id, 5) == 1)
        assert r.score == pytest.approx(exact[r.doc_id], rel=0.03, abs=0.2)
        assert r.score < 0


def test_pack(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t, _ in docs}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in REGISTERED["op4_pack"](spark, FOLDER).collect():
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes()
        assert r.ids_crc32 == brute.crc32(part) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for d, parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(ids[d])
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(windows) <= 1.03 * sum(map(len, ids.values())) / 1024 + 2


def test_pii(spark, docs):
    texts = {d: t for d, t, _ in docs}
    found = REGISTERED["op6_pii"](spark, FOLDER).collect()
    assert len(found) == len(docs)
    for r in found:
        counts, digest, joined = brute.base_report(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert r.base_sha256 == digest
        assert r.spans == joined or r.spans.startswith(f"{joined},context:" if joined else "context:")


def test_lattice(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    expected = brute.cosine_classes(rows, 0.95)
    found = REGISTERED["op8_lattice_dedup"](spark, FOLDER).collect()
    assert len(found) == len(rows)
    links = sum(n for n, _ in expected.values())
    assert all(r.n_links <= expected[r.vec_id][0] for r in found)
    assert sum(r.n_links for r in found) >= 0.95 * links
    same = sum(r.component_id == expected[r.vec_id][1] for r in found)
    assert same >= 0.98 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_simhash(spark, docs):
    expected = brute.simhash_classes([(d, t) for d, t, _ in docs], 4, 4)
    found = REGISTERED["op9_simhash"](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected


def test_line_rules(spark, docs):
    verdicts = brute.line_verdicts(
        docs, line_rules.LINE_SHARE, line_rules.LINE_DOCUMENTS, line_rules.LEAST_LEFT
    )
    expected = {
        d: (*brute.line_counts(t), kept, left) for (d, t, _), (_, left, kept) in zip(docs, verdicts)
    }
    found = REGISTERED["op10_line_rules"](spark, FOLDER).collect()
    assert {
        r.doc_id: (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.words_left,
        )
        for r in found
    } == expected


def held_out_rows(spark, name, label, limit, folder):
    """(truth, predicted, lang) of the held-out labelled rows."""
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    found = REGISTERED[name](spark, folder).collect()
    assert len(found) == len(langs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= limit) for r in found)
    assert all(r.held_out == (brute.fold(r.doc_id, 5) == 0) for r in found)
    return [
        (truth[r.doc_id], r.predicted, langs[r.doc_id])
        for r in found if r.held_out and truth.get(r.doc_id) is not None
    ]


def recall(rows, label):
    own = [p == label for t, p, _ in rows if t == label]
    return np.mean(own) if own else 1.0


def precision(rows, label):
    own = [t == label for t, p, _ in rows if p == label]
    return np.mean(own) if own else 0.0


def test_toxicity_on_held_out_rows_by_class_and_language(spark):
    rows = held_out_rows(spark, "op2_toxicity", "toxic", 0.5, "/root/testdata/sf0.1")
    assert recall(rows, 1) >= 0.9 and precision(rows, 1) >= 0.9 and recall(rows, 0) >= 0.99
    languages = {lang for _, _, lang in rows}
    for lang in languages:
        own = [r for r in rows if r[2] == lang]
        if sum(r[0] for r in own) >= 10:
            assert recall(own, 1) >= 0.8 and precision(own, 1) >= 0.9, lang
    assert len(languages) >= 4


def test_quality_on_held_out_rows_by_class(spark):
    rows = held_out_rows(spark, "op7_quality", "quality", 0.3, "/root/testdata/sf0.1")
    print({(c, l): (recall(o, c), precision(o, c), len(o)) for c in (0, 1) for l in {r[2] for r in rows} for o in [[r for r in rows if r[2] == l]]})
    assert recall(rows, 1) >= 0.9 and precision(rows, 1) >= 0.9
    assert recall(rows, 0) >= 0.5 and precision(rows, 0) >= 0.7


def test_language_on_held_out_rows(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = REGISTERED["op5_language"](spark, FOLDER).collect()
    assert len(found) == len(langs)
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (brute.fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in found)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.95
