"""Patterns are induced from values that other patterns discovered, and columns of any name pass through."""

import pytest

from costlake.llm import mixing, pii, simhash, toxicity

ADDRESSES = ["anna", "bert", "carl", "dora"]


def spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [texts[r.doc_id][a:b] for a, b in r.pii.context] for r in pii.find_pii(docs).collect()}


def test_a_value_found_by_one_pattern_induces_the_next(spark):
    keys = [f"{i:02x}ab{i:02x}cd{i:02x}ef{i:02x}99" for i in range(16, 28)]
    words = [f"tiger{i}moon" for i in range(12)]
    new = [f"river{i}stone" for i in range(3)]
    last = [f"cloud{i}nine" for i in range(2)]
    texts = [f"so password={k} ok" for k in keys]  # seeds by their format
    texts += [f"so password={w} ok" for w in words]
    texts += [f"my passphrase: {w} ok" for w in words + new]
    texts += [f"the pin-word = {w} ok" for w in new + last]
    found = spans(spark, texts)
    assert [found[12 + i] for i in range(12)] == [[w] for w in words]
    assert [found[24 + i] for i in range(15)] == [[w] for w in words + new]
    assert [found[39 + i] for i in range(5)] == [[w] for w in new + last]


def test_addresses_without_a_digit_are_seeds(spark):
    texts = [f"write contact: {a}@example.org now" for a in ADDRESSES] + ["write contact: skype77anna now"]
    assert spans(spark, texts)[len(ADDRESSES)] == ["skype77anna"]


def test_ordinary_words_before_values_induce_nothing(spark):
    texts = [f"in room{i}a we met" for i in range(20)] + [f"in 10.0.0.{i} we met" for i in range(3)] + ["in town"] * 30
    assert not any(spans(spark, texts).values())


CLASHES = ["pii", "__n", "place", "spans", "key", "formats", "row", "copy", "added", "importance", "word", "tokens", "low"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [
        (i, f"mail a{i}@b.de and more text here {i}", "s", *[f"{name}{i}" for name in CLASHES]) for i in range(4)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES))


def values(df):
    return sorted({tuple(r[c] for c in ["doc_id", *CLASHES]) for r in df.collect()})


@pytest.mark.parametrize(
    "stage",
    [
        pii.redact,
        simhash.first_of_each,
        mixing.mixed_documents,
        lambda docs: toxicity.reject_toxic(docs, docs.selectExpr("doc_id", "0 AS label")),
    ],
)
def test_columns_of_clashing_names_keep_their_values(clashing, stage):
    out = stage(clashing)
    assert out.columns == clashing.columns
    assert values(out) and set(values(out)) <= set(values(clashing))
