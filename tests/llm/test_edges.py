"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import brute
import numpy as np
import pytest

from costlake.llm import embeddings, language, line_rules, mixing, ngram_lm, packing, pii, quality, simhash, toxicity
from costlake.llm.components import components
from costlake.llm.elias_fano import EliasFano, Trie, mapped
from costlake.llm.queries import ranks_path, tokenizer_path
from costlake.llm.words import hash_words

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, part int, fp long, row long, "
    "line string, words long, chunk long, label int, value string, context string, start int, node long"
)
PROSE = "the quick brown fox jumps over the lazy dog and you are a stupid loser " * 3
LONG = " ".join(f"word{i % 977} {i}" for i in range(6_000))
TEXTS = [
    (1, PROSE, "en", "b"), (2, PROSE, "en", "b"), (2, PROSE, "en", "b"), (3, None, None, None), (None, "no id here", "en", "a"),
    (4, "", "en", "a"), (5, " \t\n ", None, ""), (6, LONG, "en", "a"), (7, "¡Übergröße 😀 42! naïve x", "de", "ö"),
    (8, "mail a.b@c.de, call +1 (212) 555-0100 or 10.0.0.300 10.0.0.30, 4111 1111 1111 1111", "en", "b"),
    (None, None, None, None), (9, "...!!!###", "xx", "b"), (10, "one\ntwo\none\n\n one", "en", "z"),
]


def frame(spark, rows):
    full = [(*r, len(r[1] or ""), 1, 2, 3, 4, "l", 5, 6, 0, "v", "c", 7, 8) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (6, 0), (7, 0), (99, 1), (8, None)], "doc_id long, label int")


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=lambda d: (d is None, d))


ALL = sorted((t[0] for t in TEXTS), key=lambda d: (d is None, d))


def test_mix(spark, docs, none):
    found = mixing.mix(docs)
    assert ids(found) == ALL
    taken = {}
    for r in found.collect():
        assert r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    sizes = {}
    for _, text, _, source in TEXTS:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    for source, target in brute.targets(sizes).items():
        lengths = [len(brute.words(t)) for _, t, _, src in TEXTS if src == source]
        least = brute.nearest_sum_gap(lengths, 3, round(target))
        assert abs(taken[source] - round(target)) == least
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_mixed_documents_keep_columns_and_targets(spark, docs):
    named = docs.withColumnsRenamed({"row": "Row", "part": "copy", "line": "__n"})
    assert mixing.mixed_documents(named).columns == named.columns
    sample = docs.filter("doc_id = 6")
    back = [r for r in mixing.mixed_documents(named).collect() if r.doc_id == 6]
    assert set(back) == set(sample.withColumnsRenamed({"row": "Row", "part": "copy", "line": "__n"}).collect())
    # Many rows that only a number of their own tells apart: as many words come out as were asked for.
    alike = spark.createDataFrame(
        [(None, "a b c d e", "s")] * 400 + [(i, "x y z", "t") for i in range(100)], "doc_id long, text string, source string"
    )
    sizes = {"s": 2000, "t": 300}
    taken = dict.fromkeys(sizes, 0)
    for r in mixing.mixed_documents(alike).collect():
        taken[r.source] += len(r.text.split())
    for source, target in brute.targets(sizes).items():
        assert abs(taken[source] - target) <= 3


def test_sources_are_levelled_like_one_by_one(spark):
    rng = np.random.default_rng(5)
    for n, share in ((1, 1.0), (7, 0.3), (300, 1.0), (300, 2.5), (300, 3.0), (300, 4.0)):
        sizes = {f"s{i}é": int(v) for i, v in enumerate(rng.pareto(0.7, n) * 50)} | {None: 3}
        frame_ = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.targets(frame_, share=share).collect()}
        total, expected = sum(sizes.values()) * share, None
        if share == 1.0:
            expected = brute.targets(sizes)
            assert all(found[s] == pytest.approx(t, rel=1e-9, abs=1e-9) for s, t in expected.items())
        assert all(found[s] <= 3 * v + 1e-9 for s, v in sizes.items())
        assert sum(found.values()) == pytest.approx(min(total, 3 * sum(sizes.values())), rel=1e-9)


def test_knapsack_is_best():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 6))
        lengths = np.unique(rng.integers(1, 30, n)).astype(np.int64)
        counts = rng.integers(1, 5, len(lengths)).astype(np.int64)
        budget = int(rng.integers(0, 160))
        took, gap = mixing.knapsack(lengths.tolist(), counts.tolist(), budget)
        each = np.repeat(lengths, counts).tolist()
        assert gap == brute.nearest_sum_gap(each, 1, budget)
        assert abs(sum(lengths[i] * k for i, k in took.items()) - budget) == gap
        assert all(k <= counts[i] for i, k in took.items())
        full = mixing.fit(lengths, counts, budget)
        assert (full <= counts).all() and (full >= 0).all()
        reach = min(budget, int((counts * lengths).sum()))
        assert abs(int((full * lengths).sum()) - reach) == brute.nearest_sum_gap(each, 1, reach)


def test_long_budgets_are_met_and_shares_stay_in_proportion():
    rng = np.random.default_rng(2)
    lengths = np.unique(rng.integers(1, 20_000, 800)).astype(np.int64)
    counts = rng.integers(1, 9, len(lengths)).astype(np.int64)
    whole = int((lengths * counts).sum())
    for share in (0.2, 1.0, 2.7):
        plan = mixing.fit(lengths, 3 * counts, int(whole * share))
        assert int((plan * lengths).sum()) == int(whole * share)
        assert (plan <= 3 * counts).all()
        long = lengths > 2_000
        assert (plan * lengths)[long].sum() == pytest.approx(share * (counts * lengths)[long].sum(), rel=0.01)


def test_toxicity(spark, docs, none, labels):
    assert ids(toxicity.score(docs, labels)) == ALL
    assert toxicity.score(none, labels).count() == 0
    assert toxicity.score(docs, labels.filter("false")).filter("score <> 0").count() == 0
    assert set(toxicity.reject_toxic(docs, labels).columns) == set(docs.columns)


def test_ngram_lm(spark, docs, none):
    found = ngram_lm.score(docs)
    assert ids(found) == ALL
    row = {r.doc_id: r for r in found.collect()}
    assert row[3].n_tokens == 1 and row[4].n_tokens == 1 and row[6].n_tokens == 12_001
    assert ngram_lm.score(none).count() == 0


def test_ngram_lm_splits_frequent_contexts(spark):
    texts = [(i, " ".join(f"the w{(i * k) % 37}" for k in range(60)), "en", "a") for i in range(40)]
    expected = brute.pair_score([(d, t) for d, t, _, _ in texts])
    learn = ~ngram_lm.held_out(ngram_lm.F.col("doc_id"))
    found = ngram_lm.score(frame(spark, texts).repartition(4), learn, slice_tokens=50)
    for r in found.collect():
        assert r.score == pytest.approx(expected[r.doc_id], rel=0.03)


def test_pack(spark, docs, none):
    found = packing.pack(docs, tokenizer_path(), window=64, open_windows=2, fan_in=2).collect()
    assert sorted({r.doc_id for r in found if r.doc_id}) == sorted({t[0] for t in TEXTS if t[0]})
    ends = [r for r in found if r.start + r.length == r.doc_tokens]
    assert len(ends) == len(TEXTS)
    fill = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset and len(r.ids) == 4 * r.length
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 64
    assert packing.pack(none, tokenizer_path()).count() == 0


RANDOM = ["".join(np.random.default_rng(i).choice(list("aZé1 .\n\t'*|\u0300ñ😀_-"), 80)) for i in range(300)]


@pytest.mark.parametrize("ranked", [False, True])
def test_pieces_encode_like_the_whole(ranked):
    encode = packing.Encoder(tokenizer_path(), ranks_path() if ranked else None)
    texts = ["don't we'll 'S", "a\u00a0 b\u2003c \u200bd", "\U0001f600 x\ud7ff", "12ab34 a_b (c)", *RANDOM, "", " ", "  two  spaces ", "a b\n c\td", "x<|endoftext|> y <|endoftext|>", "é ü  z 12 345", "a\x1c b"]
    for text, found in zip(texts, encode.encode(texts)):
        whole = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(found, "<u4").tolist() == whole


def test_language(spark, docs, none):
    found = {r.doc_id: r for r in language.identify(docs).collect() if r.doc_id}
    assert found[3].lang_pred == found[4].lang_pred == found[9].lang_pred == "und"
    assert found[1].lang_pred == "en" and found[6].lang_pred == "en"
    assert ids(language.identify(docs)) == ALL
    assert language.identify(none).count() == 0


def test_pii(spark, docs, none):
    found = pii.find_pii(docs)
    assert ids(found) == ALL
    row = next(r for r in found.collect() if r.doc_id == 8)
    assert [[tuple(s) for s in row.pii[k]] for k in pii.FORMATS] == list(brute.base_spans(row.text).values())
    assert pii.find_pii(none).count() == 0
    cleaned = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert cleaned[8].text == "mail [EMAIL], call [PHONE] or 10.0.0.300 [IP], [CARD]"
    assert cleaned[8].n_chars == len(cleaned[8].text) and cleaned[8].value == "v"
    assert cleaned[6].text == LONG


def test_pii_formats_match_like_the_plain_patterns(spark):
    rng = np.random.default_rng(3)
    alphabet = list("abZ019.@-+_ ()%é5\n")
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 60)))) for _ in range(1000)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "x@y z@w.v", "4111-1111-1111-1111", "0 0 0 0 0 0 0 0 0 0 0 0 0 0", "9" * 3_000, "1 " * 3_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for kind in pii.FORMATS:
        found = df.select("doc_id", pii.format_spans(pii.F.col("text"), kind).alias("s")).collect()
        for r in found:
            assert [tuple(x) for x in r.s] == brute.base_spans(texts[r.doc_id])[kind], (kind, texts[r.doc_id][:80])


def test_pii_learns_contexts(spark):
    rng = np.random.default_rng(5)
    key = lambda: "".join(rng.choice(list("abcdef0123456789"), 20))
    rows = [(i, f"some words then password={key()} and more text {i}") for i in range(12)]
    rows += [(20, "another password=Summer2024 in a text"), (21, "the 123456789 items and nothing else"), (22, "word 1234567 here")]
    found = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = rows[12][1]
    assert [tuple(s) for s in found[20].pii.context] == [(text.index("Summer"), text.index("Summer") + 10)]
    assert found[21].pii.context == [] and found[22].pii.context == []


def test_quality(spark, docs, none, labels):
    assert ids(quality.score(docs, labels)) == ALL
    assert quality.score(none, labels).count() == 0
    assert quality.score(docs, labels.filter("false")).filter("score <> 0.5").count() == 0


def test_lattice(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 24))
    near = base[:10] + 0.05 * rng.standard_normal((10, 24))
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *near, *base[:5], *(3 * base[5:8])])]
    rows += [(100, None), (101, [0.0] * 24), (102, [float("nan")] * 24), (103, [1.0, None]), (104, []), (105, base[0][:12].tolist()), (106, [float("inf")] * 24)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cell string, rep int")
    expected = brute.cosine_classes(rows, 0.95)
    assert {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()} == expected
    assert embeddings.near_duplicates(df.filter("false")).count() == 0


def test_lattice_splits_crowded_cells(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, (np.ones(16) + 0.05 * rng.standard_normal(16)).tolist()) for i in range(90)]
    monkeypatch.setattr(embeddings, "SLICE", 20)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute.cosine_classes(rows, 0.95)
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert found == expected


def test_e8_decodes_to_the_nearest_point():
    rng = np.random.default_rng(6)
    points = rng.standard_normal((300, 8)) * 1.5
    best, other, margin = embeddings.e8(points)
    for p, b, o in zip(points, best / 2, other / 2):
        assert b.sum() % 2 == 0 and (np.all(b % 1 == 0) or np.all(b % 1 == 0.5))
        moved = b + rng.integers(-1, 2, (200, 8))
        moved = moved[moved.sum(axis=1) % 2 == 0]
        assert ((p - b) ** 2).sum() <= ((p - moved) ** 2).sum(axis=1).min() + 1e-9
        assert ((p - b) ** 2).sum() <= ((p - o) ** 2).sum() + 1e-9


def test_simhash(spark, docs, none):
    named = [(d, t) for d, t, _, _ in TEXTS if d is not None]
    expected = brute.simhash_classes(sorted(set(named), key=lambda x: x[0]), 4, 4)
    found = simhash.near_duplicates(docs, shingle=4, distance=4)
    assert ids(found) == ALL
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found.collect() if r.doc_id} == expected
    assert simhash.near_duplicates(none).count() == 0
    kept = ids(simhash.first_of_each(docs))
    assert kept == [1, 3, 6, 7, 8, 9, 10, None, None]


@pytest.mark.parametrize("n", [10, 10_000_000, 10**12])
@pytest.mark.parametrize("distance", [3, 4])
def test_simhash_links_are_exact_for_every_scheme(spark, monkeypatch, n, distance):
    rng = np.random.default_rng(n % 97)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    values = [int(v) for v in base]
    for v in base:
        for _ in range(4):
            bits = rng.choice(64, int(rng.integers(1, 7)), replace=False)
            values.append(int(v) ^ sum(1 << int(b) for b in bits))
    values = np.array(sorted(set(values)), dtype=np.uint64)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    edges = simhash.links(df, distance, n, slice_rows=40).collect()
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    assert brute.classes(len(values), [(place[a], place[b]) for a, b in edges]) == brute.classes(
        len(values), zip(*np.nonzero(near))
    )


def test_line_rules(spark, docs, none):
    found = line_rules.check_lines(docs)
    assert ids(found) == ALL
    row = {r.doc_id: r for r in found.collect()}
    assert row[10].n_dup_lines == 1 and row[3].n_words == 0 and not row[3].kept
    for d, text, _, _ in TEXTS:
        r = row[d]
        if d is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.line_counts(text)
    assert line_rules.check_lines(none).count() == 0


def test_line_rules_remove_boilerplate(spark):
    prose = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, f"{prose(i)}\n Shared  FOOTER line", "en", "h") for i in range(40)]
    rows += [(100 + i, "shared footer LINE\n" + prose(7), "en", "h") for i in range(30)] + [(200, prose(7), "en", None)]
    found = {r.doc_id: r for r in line_rules.check_lines(frame(spark, rows), line_documents=20).collect()}
    verdicts = brute.line_verdicts([(d, t, s) for d, t, _, s in rows], line_rules.LINE_SHARE, 20, line_rules.LEAST_LEFT)
    assert {d: (r.words_left, r.kept) for d, r in found.items()} == {d: (left, kept) for d, left, kept in verdicts}
    assert found[0].kept and not found[100].kept and found[200].kept


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, 300), (300, 8), (9, 100)]
    found = {r.node: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 9 for i in range(100, 161)}, 9: 9, 7: 7, 8: 7, 300: 7}


def test_elias_fano_round_trip():
    rng = np.random.default_rng(8)
    for top in (1, 200, 1 << 40, (1 << 63) + 5):
        for n in (0, 1, 3, 1000):
            values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
            found = EliasFano(EliasFano.encode(values))
            assert (found.values(np.arange(n)) == values).all()
            wanted = np.concatenate([values, rng.integers(0, top, 50, dtype=np.uint64)])
            assert (found.successors(wanted) == np.searchsorted(values, wanted)).all()


def test_trie_is_memory_mapped():
    blob = Trie.build(np.array([5, 9], dtype=np.uint64), np.array([0, 0, 1]), np.array([3, 8, 3], dtype=np.uint64), np.array([0.5, 0.25, 0.1]))
    trie, view = mapped(blob)
    rank, codes = trie.look_up(np.array([9, 5, 6], dtype=np.uint64), np.array([3, 3, 8, 4, 3], dtype=np.uint32), np.array([1, 3, 1]))
    assert rank.tolist() == [1, 0, -1]
    assert trie.book[codes] == pytest.approx([0.1, 0.5, 0.25, 0.0, 0.0])
    assert trie.masses == pytest.approx([0.75, 0.1])


def test_hash_words_tell_words_apart():
    texts = ["The the THE tHe", "", " a  b\x0bc\n", "é É ẞ", "x" * 70_000 + " y"]
    counts, hashes = hash_words([t.encode() for t in texts])
    assert counts.tolist() == [4, 0, 3, 3, 2]
    assert len(set(hashes[:4].tolist())) == 1 and len(set(hashes.tolist())) == 9
