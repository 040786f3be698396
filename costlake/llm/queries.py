"""The registered queries of the training-data operators, one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm import (
    embeddings, importance, language, line_rules, mixing, ngram_lm, packing, periods, pii, quality, simhash,
    token_files, toxicity,
)
from costlake.llm.common import table

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(query):
    REGISTERED[query.__name__] = query
    return query


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    """The same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def word_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register
def op1_mix_sources(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register
def op2_toxicity(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(
        table(spark, sf_dir, "documents"), labels, ~toxicity.held_out(F.col("doc_id"))
    )
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@register
def op3_ngram_lm(spark, sf_dir):
    held_out = ngram_lm.held_out(F.col("doc_id"))
    scored = ngram_lm.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@register
def op4_pack(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), ranks=ranks_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@register
def op5_language(spark, sf_dir):
    held_out = language.held_out(F.col("doc_id"))
    found = language.identify(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@register
def op6_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    base = list(pii.FORMATS)
    return found.select(
        "doc_id",
        *[F.size(f"pii.{kind}").cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(pii.report(base), 256).alias("base_sha256"),
        pii.report([*base, pii.CONTEXT]).alias("spans"),
    )


@register
def op7_quality(spark, sf_dir):
    held_out = quality.held_out(F.col("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    scored = quality.score(table(spark, sf_dir, "documents"), labels, ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@register
def op8_lattice_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op9_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


@register
def op10_line_rules(spark, sf_dir):
    checked = line_rules.check_lines(table(spark, sf_dir, "documents"))
    return checked.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "words_left",
    )


@register
def op12_token_files(spark, sf_dir):
    written = token_files.write_tokens(table(spark, sf_dir, "documents"), word_tokenizer_path())
    return written.documents().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register
def op13_importance(spark, sf_dir):
    documents, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.ranks(documents, target).select("doc_id", "n_features", "weight", "score", "rank")


@register
def op11_periodic_runs(spark, sf_dir):
    documents = periods.with_repeated_tails(table(spark, sf_dir, "documents"))
    return periods.report(periods.find_runs(documents))
