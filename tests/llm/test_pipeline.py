"""The pipeline as a whole: the rows of every stage against brute force over what the stage before kept."""

from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from conftest import SF_DIR
from test_near_copies import first_documents

import corpus_pipeline
from costlake.llm import toxicity
from costlake.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of every stage of one run, by the name of the stage."""
    found, write = {}, corpus_pipeline.stored

    def keep(df, purpose):
        found[purpose.removeprefix("pipeline-")] = written = write(df, purpose)
        return written

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "stored", keep)
        found["packing"] = corpus_pipeline.run(spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == list(found)
    assert all(found[name].columns == documents.columns for name, _ in corpus_pipeline.STAGES[:-1])
    return {"documents": documents.collect(), **{name: df.collect() for name, df in found.items()}}


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.score(
        spark.read.parquet(f"{SF_DIR}/documents.parquet"), labels.selectExpr("doc_id", "toxic AS label")
    )
    low = {r.doc_id for r in scored.collect() if r.score < 0.5}
    assert sorted(r for r in stages["documents"] if r.doc_id in low) == sorted(stages["toxicity"])
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    known = [r.doc_id for r in stages["documents"] if r.doc_id in truth]
    assert np.mean([(d in low) == (truth[d] == 0) for d in known]) >= 0.95


def test_one_of_each_group_of_near_copies_stays(stages):
    first = first_documents(list(texts(stages["toxicity"]).items()))
    assert sorted(r for r in stages["toxicity"] if r.doc_id in first) == sorted(stages["simhash"])


def test_no_personal_data_of_fixed_formats_is_left(stages):
    before, after = texts(stages["simhash"]), texts(stages["pii"])
    assert len(stages["pii"]) == len(stages["simhash"]) and before.keys() == after.keys()
    assert not any(spans for text in after.values() for spans in brute.base_spans(text).values())
    for d, text in before.items():
        spans = brute.base_spans(text)
        for kind, own in spans.items():
            assert after[d].count(f"[{kind.upper()}]") <= (text or "").count(f"[{kind.upper()}]") + len(own)
        if not any(c.isdigit() or c == "@" for c in text or ""):
            assert after[d] == (text or "")
    assert any("[EMAIL]" in text for text in after.values())


def test_sources_meet_their_targets(stages):
    sizes, taken = defaultdict(int), defaultdict(int)
    for rows, total in ((stages["pii"], sizes), (stages["mixing"], taken)):
        for r in rows:
            total[r.source] += len(brute.words(r.text))
    by_source = defaultdict(list)
    for r in stages["pii"]:
        by_source[r.source].append(len(brute.words(r.text)))
    for source, target in brute.targets(sizes).items():
        least = brute.nearest_sum_gap(by_source[source], 3, round(target))
        assert abs(taken[source] - round(target)) == least
    copies = Counter(stages["mixing"])
    assert max(copies.values()) <= 3 and copies.keys() <= set(stages["pii"])


def test_windows_hold_every_token_of_the_mix(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    wanted = Counter()
    for r in stages["mixing"]:
        wanted.update((r.doc_id, i, t) for i, t in enumerate([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]))
    found, windows = Counter(), defaultdict(list)
    for r in stages["packing"]:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length > 0
        found.update((r.doc_id, r.start + i, t) for i, t in enumerate(ids))
        windows[r.sequence_id].append((r.offset, r.length))
    assert found == wanted
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
