"""Quality rules on lines and words: cross-document line frequency, in DataFrame operations only.

Lines are normalised and hashed, and the documents of each host that hold a line are counted. Lines
above the limit are boilerplate and are removed; a document that keeps too little is rejected. Base
counts of words, symbols, repeated lines and repeated three-word windows come along.

Edge cases: a null text has no words and no lines; lines without a word are neither counted nor
removed; a null host is a host of its own; repeated rows are documents of their own, so a line of
theirs counts for each; an empty table gives no rows; columns other than doc_id, text and source are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import WORD_BREAK, let, stored, words

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: A line is boilerplate on a host if more than this many of its documents hold it, however many the
#: host has; of one-word lines (headings, names, numbers), more than the second figure.
LINE_DOCUMENTS, ONE_WORD_DOCUMENTS = 5, 20
#: Only for callers that also ask for a share of the host's documents.
LINE_SHARE = 0.0
#: A document is depleted if less than this share of its words is left.
LEAST_LEFT = 0.5


def repeated_words(found: Column) -> Column:
    """Words of the array that lie in a three-word window which the array holds twice or more."""

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - 2),
            lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)),
        )

    def covered(hashes: Column) -> Column:
        # Windows sorted by hash: those equal to a neighbour are repeated. Then their positions in
        # order: each adds the words up to the next one, three at most.
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(
            placed,
            lambda p: F.filter(
                F.transform(
                    p,
                    lambda x, k: F.when(
                        (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        return let(
            F.sort_array(repeated),
            lambda at: F.aggregate(
                F.transform(at, lambda i, k: F.least(F.coalesce(F.get(at, k + 1) - i, F.lit(3)), F.lit(3))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    def counted(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(
            let(
                windows(w),
                lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
            )
        )

    return let(found, counted)


def base_counts(documents: DataFrame) -> DataFrame:
    """doc_id, source and, for each row, word_chars, n_symbols, n_words, n_dup_lines, n_repeat_words,
    and the hashes and words of its lines (``lines``)."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    normal = F.transform(
        lines,
        lambda line: F.struct(
            F.xxhash64(F.lower(F.trim(F.regexp_replace(line, WORD_BREAK, " ")))).alias("line"),
            F.size(words(line)).cast("long").alias("words"),
        ),
    )
    return documents.select(
        "doc_id",
        "source",
        F.length(F.regexp_replace(text, WORD_BREAK, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(
            words(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")
            ),
        ).alias("__words"),
        normal.alias("lines"),
    ).select(
        "doc_id", "source", "__words.n_words", "word_chars", "n_symbols", "n_dup_lines",
        "__words.n_repeat_words", "lines",
    )


def frequent_lines(counted: DataFrame, share: float, least_documents: int, one_word_documents: int) -> DataFrame:
    """(source, line) of lines above the limit. A line counts once per document, before the shuffle."""
    distinct = counted.select("source", F.explode(F.array_distinct("lines")).alias("l")).select("source", "l.*")
    per_line = distinct.groupBy("source", "line").agg(
        F.count(F.lit(1)).alias("documents"), F.min("words").alias("words")
    )
    limit = F.when(F.col("words") > 1, least_documents).otherwise(max(least_documents, one_word_documents))
    frequent = per_line.filter(F.col("documents") > limit)
    if share <= 0:
        return frequent.select("source", "line")
    hosts = counted.groupBy(F.col("source").alias("host")).agg(F.count(F.lit(1)).alias("of_host"))
    return (
        frequent.join(hosts, F.col("source").eqNullSafe(F.col("host")))
        .filter(F.col("documents") > share * F.col("of_host"))
        .select("source", "line")
    )


def check_lines(
    documents: DataFrame,
    line_share: float = LINE_SHARE,
    line_documents: int = LINE_DOCUMENTS,
    one_word_documents: int = ONE_WORD_DOCUMENTS,
    least_left: float = LEAST_LEFT,
    least_words: int = LEAST_WORDS,
    most_repeated_percent: int = MOST_REPEATED_PERCENT,
) -> DataFrame:
    """Base counts and verdict of every row: ``removed_lines`` (hashes of its boilerplate lines),
    ``words_left`` without them, ``base_failed``, ``depleted`` and ``kept``."""
    counted = stored(
        base_counts(documents).withColumn("row", F.monotonically_increasing_id()), "line-counts"
    )
    frequent = stored(frequent_lines(counted, line_share, line_documents, one_word_documents), "line-frequent")
    occurrences = counted.select("row", "source", F.explode("lines").alias("l")).select(
        "row", F.col("source").alias("host"), "l.line", "l.words"
    )
    removed = (
        occurrences.join(
            frequent.withColumnRenamed("line", "frequent"),
            (F.col("line") == F.col("frequent")) & F.col("host").eqNullSafe(F.col("source")),
        )
        .groupBy("row")
        .agg(F.sum("words").alias("lost"), F.collect_set("line").alias("removed_lines"))
    )
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > most_repeated_percent * F.col("n_words")
    )
    return (
        counted.join(removed, "row", "left")
        .withColumn("words_left", F.col("n_words") - F.coalesce("lost", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("depleted", F.col("words_left") < least_left * F.col("n_words"))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .drop("row", "lost", "lines")
    )
