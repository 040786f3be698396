"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are densities per word or character of the whole text: words of lexicons, the same after undoing
look-alike characters, insults near a second-person word, capitals, punctuation, and letters broken up
by symbols. One lexicon is a fixed list of insults. Two more are learnt: words that labelled toxic documents hold
far more often than clean ones, by the lower end of their log odds, in whatever language. Trees must not learn from
odds to which a document's own label contributed, so a labelled document gets the lexicons of the other folds; the
lexicons of all labelled documents serve for scoring. Features are built-in expressions; trees and calibration are
Spark ML models.

Edge cases: a null or empty text has zero in all features and is scored like any other; documents
without a label are scored but not learnt from; a label of a document that is absent is ignored; with
no label of one of the two classes, every score is the share of label 1 (0 without labels); repeated
rows are scored alike and each is returned; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import bounded_rows, fold, ship_package, stored

# Insults and slurs of abuse, plain lower case, by language.
INSULTS = [
    "arse", "asshole", "bastard", "bitch", "bozo", "clown", "creep", "cretin", "degenerate", "dimwit",
    "disgusting", "dumb", "dumbass", "filth", "fool", "freak", "fuck", "fucking", "garbage", "hate",
    "idiot", "idiotic", "imbecile", "jerk", "loser", "losers", "lunatic", "moron", "moronic", "nasty",
    "pathetic", "pig", "scum", "scumbag", "shit", "shut", "stupid", "sucker", "trash", "ugly", "vermin",
    "vile", "worthless", "arschloch", "abschaum", "dummkopf", "idioten", "trottel", "versager",
    "connard", "crétin", "imbécile", "merde", "ordure", "salaud", "basura", "cabrón", "escoria",
    "estúpido", "idiota", "imbécil", "mierda",
]
# Second-person words.
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "du", "dich", "dein", "ihr", "tu", "toi", "vous", "tú", "te", "usted"]
# Characters that stand in for letters, and those letters.
LOOKALIKES, LETTERS = "013457@$!|", "oieastasil"

#: Labelled rows that are learnt from at most, and the share of them kept for calibration.
MOST_LABELLED, CALIBRATION = 24_000, 0.35
TREES, DEPTH, STEP = 20, 3, 0.3
SEED = 20240609
FEATURES = [
    "insults", "learnt", "hints", "insults_undone", "second_person", "aimed", "capitals", "shouted", "exclaimed",
    "punctuation", "obfuscated", "masked", "log_insults", "log_learnt", "log_words",
]
TIE_BREAK = 1e-3
#: Learnt words: so many labelled documents hold them at least; the log odds, less one standard error, that make
#: a word one of the lexicon or a hint; and the most words of each (the highest).
LEAST_DOCUMENTS, LEXICON_ODDS, HINT_ODDS, MOST_LEARNT = 4, 2.0, 1.0, 400
FOLDS = 4


def tokens(low: Column) -> Column:
    """Runs of letters of a lower-case text."""
    return F.split(low, r"\P{L}+")


def features(documents: DataFrame, lexicon: tuple[list[str], list[str]] = ((), ())) -> DataFrame:
    """doc_id and the feature columns of every row. ``lexicon``: learnt words and hints."""
    learnt, hints = (sorted(set(words) - set(INSULTS) - set(SECOND_PERSON)) for words in lexicon)
    text = F.coalesce("text", F.lit(""))
    aimed = (
        rf"\b(?:{'|'.join(SECOND_PERSON)})\W{{1,3}}(?:\w{{1,20}}\W{{1,3}}){{0,3}}(?:{'|'.join(INSULTS)})\b"
    )
    count = lambda value, pattern: F.regexp_count(value, F.lit(pattern)).cast("double")
    among = lambda words, wanted: F.filter(words, lambda w: w.isin(list(wanted)))
    number = lambda words, wanted: F.size(among(words, wanted) if wanted else F.array()).cast("double")
    # One pass over the words finds all that any lexicon holds; the few that it finds are told apart after it.
    split = documents.select("doc_id", text.alias("text"), F.lower(text).alias("low")).withColumn(
        "tokens", tokens(F.col("low"))
    )
    found = split.select(
        "doc_id", "text", "low", F.size(F.filter("tokens", lambda w: w != "")).alias("size"),
        among(F.col("tokens"), [*INSULTS, *SECOND_PERSON, *learnt, *hints]).alias("held"),
        # No insult comes to light where no stand-in is next to a letter.
        F.when(
            F.col("text").rlike(r"[013457@$!|]\p{L}|\p{L}[013457@$!|]"),
            F.translate("low", LOOKALIKES, LETTERS),
        ).alias("undone"),
    ).withColumn("brought", among(tokens(F.col("undone")), [*INSULTS, *learnt]))
    hits = number(F.col("held"), INSULTS)
    person = number(F.col("held"), SECOND_PERSON)
    undone = F.when(F.col("undone").isNull(), 0.0).otherwise(F.size("brought").cast("double"))
    text = F.col("text")
    letters, upper = F.length(F.regexp_replace(text, r"\P{L}+", "")), F.length(F.regexp_replace(text, r"\P{Lu}+", ""))
    broken = text.rlike(r"\p{L}[0-9@$!|*_.-]+\p{L}")
    counted = found.select(
        "doc_id", "text", "low", "undone",
        F.greatest(F.col("size"), F.lit(1)).cast("double").alias("words"),
        F.greatest(F.length(text), F.lit(1)).cast("double").alias("chars"),
        hits.alias("hits"), person.alias("person"), undone.alias("brought"),
        number(F.col("held"), learnt).alias("learnt"), number(F.col("held"), hints).alias("hints"),
        letters.cast("double").alias("letters"),
        upper.cast("double").alias("upper"),
        count(text, r"\b\p{Lu}{3,}\b").alias("shouts"),
        count(text, r"[!?]").alias("exclaims"),
        count(text, r"\p{Punct}").alias("punct"),
        F.when(broken, count(text, r"\p{L}[013457@$!|*]+\p{L}")).otherwise(0.0).alias("broken"),
        count(text, r"\*{2,}").alias("stars"),
    ).withColumn(
        "at_you",
        F.greatest(
            F.when((F.col("hits") > 0) & (F.col("person") > 0), count(F.col("low"), aimed)).otherwise(0.0),
            F.when(F.col("brought") > F.col("hits") + F.col("learnt"), count(F.col("undone"), aimed)).otherwise(0.0),
        ),
    )
    per_word = lambda value: value / F.col("words")
    known = F.col("hits") + F.col("learnt")
    return counted.select(
        "doc_id",
        per_word(F.col("hits")).alias("insults"),
        per_word(F.col("learnt")).alias("learnt"),
        per_word(F.col("hints")).alias("hints"),
        per_word(F.greatest(F.col("brought") - known, F.lit(0.0))).alias("insults_undone"),
        per_word(F.col("person")).alias("second_person"),
        per_word(F.col("at_you")).alias("aimed"),
        (F.col("upper") / F.greatest("letters", F.lit(1.0))).alias("capitals"),
        per_word(F.col("shouts")).alias("shouted"),
        (F.col("exclaims") / F.col("chars")).alias("exclaimed"),
        (F.col("punct") / F.col("chars")).alias("punctuation"),
        per_word(F.col("broken")).alias("obfuscated"),
        per_word(F.col("stars")).alias("masked"),
        F.log1p(F.greatest(F.col("hits"), F.col("brought"))).alias("log_insults"),
        F.log1p("learnt").alias("log_learnt"),
        F.log("words").alias("log_words"),
    )


def learnt_words(labelled: DataFrame) -> list[tuple[list[str], list[str]]]:
    """(learnt words, hints) from the rows (text, label, fold) without each fold, and last from all rows.

    Documents are counted per word, class and fold in Spark; ``MOST_LEARNT`` words per list come to the driver."""
    held = labelled.select(
        "label", "fold", F.explode(F.array_distinct(tokens(F.lower(F.coalesce("text", F.lit("")))))).alias("word")
    ).filter(F.length("word").between(2, 40))
    counts = stored(
        held.groupBy("word", "fold").agg(
            F.sum("label").alias("toxic"), (F.count(F.lit(1)) - F.sum("label")).alias("clean")
        ),
        "toxicity-words",
    )
    lists = []
    for left_out in [*range(FOLDS), None]:
        mine = F.lit(True) if left_out is None else F.col("fold") != left_out
        toxic, rows = labelled.filter(mine).agg(F.sum("label"), F.count(F.lit(1))).first()
        in_toxic, in_clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
        clean = rows - (toxic or 0) + 1.0
        odds = F.log(in_toxic / F.lit((toxic or 0) + 1.0)) - F.log(in_clean / F.lit(clean))
        scored = (
            counts.filter(mine)
            .groupBy("word")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter(F.col("toxic") + F.col("clean") >= LEAST_DOCUMENTS)
            .select("word", (odds - F.sqrt(1 / in_toxic + 1 / in_clean)).alias("odds"))
        )
        best = lambda rule: [
            r["word"] for r in scored.filter(rule).orderBy(F.col("odds").desc(), "word").limit(MOST_LEARNT).collect()
        ]
        strong = F.col("odds") >= LEXICON_ODDS
        lists.append((best(strong), best((F.col("odds") >= HINT_ODDS) & ~strong)))
    return lists


def score(documents: DataFrame, labels: DataFrame, learn_from: Column | None = None) -> DataFrame:
    """(doc_id, score) of every row of ``documents``.

    ``labels`` is (doc_id, label 0/1); rows on which ``learn_from`` (over doc_id) is not true are never
    learnt from. About ``MOST_LABELLED`` labels are used at most, chosen by a hash of their id, so they are few
    enough to be broadcast and the texts are not shuffled.
    """
    ship_package(documents.sparkSession)
    wanted = labels.filter(learn_from if learn_from is not None else F.lit(True)).filter("label in (0, 1)")
    wanted = wanted.select("doc_id", F.col("label").cast("double").alias("label"))
    few = stored(bounded_rows(wanted, F.col("doc_id"), MOST_LABELLED, SEED), "toxicity-labels")
    fold_of = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 2)), F.lit(FOLDS)).cast("int")
    labelled = stored(
        documents.select("doc_id", "text").join(F.broadcast(few), "doc_id").withColumn("fold", fold_of),
        "toxicity-labelled",
    )
    *without_fold, lexicon = learnt_words(labelled)
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")

    def dense(rows: DataFrame, words: tuple[list[str], list[str]]) -> DataFrame:
        return assemble.transform(features(rows, words)).select("doc_id", "features")

    sample = None
    for fold_, words in enumerate(without_fold):
        rows = labelled.filter(F.col("fold") == fold_)
        part = dense(rows, words).join(rows.select("doc_id", "label").distinct(), "doc_id")
        sample = part if sample is None else sample.unionByName(part)
    sample = stored(sample, "toxicity-sample")
    scoring = stored(dense(documents, lexicon), "toxicity-features")
    for_calibration = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(1000)) < 1000 * CALIBRATION
    fitted, held = sample.filter(~for_calibration), sample.filter(for_calibration)
    shares = [part.agg(F.avg("label")).first()[0] for part in (sample, fitted, held)]
    if any(share in (None, 0.0, 1.0) for share in shares):
        return scoring.select("doc_id", F.lit(float(shares[0] or 0.0)).alias("score"))
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
        subsamplingRate=1.0, seed=SEED, checkpointInterval=-1,
    ).fit(fitted.coalesce(2))
    raw = lambda df: trees.transform(df).withColumn("raw", vector_to_array("probability")[1])
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(
        raw(held).select("raw", "label").coalesce(2)
    )
    # Equal steps of the calibration keep the order of the trees.
    blended = (1 - TIE_BREAK) * F.col("calibrated") + TIE_BREAK * F.col("raw")
    bounded = F.least(F.greatest(blended, F.lit(0.0)), F.lit(1.0))
    return steps.transform(raw(scoring)).select("doc_id", bounded.alias("score"))


def reject_toxic(documents: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """``documents`` without those that score ``limit`` or more. Labels teach the classifier only.

    Rows that share an id go if any of them is toxic."""
    toxic = score(documents, labels).filter(F.col("score") >= limit)
    return documents.join(toxic.select("doc_id").distinct(), "doc_id", "left_anti").select(*documents.columns)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 5) == 0
