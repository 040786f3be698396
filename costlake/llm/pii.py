"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Fixed formats (e-mail, IP, card and phone numbers) are found first. All their spans, and keys of well-known
formats, are the seed entities. These and every other identifier-like value (one with a digit) are linked to the
lexical pattern left of them: the word before and the separators between, such as ``password=``. In
waves, known values induce the patterns that introduce enough of them, and patterns and values score each other
over that graph in a few rounds: a pattern by the share of the corpus' uses of its word that introduce a
known entity, a value by the patterns that introduce it. Values above the limit are known in the next wave, so
one that a pattern found helps to induce another pattern, until none is new. Patterns above the limit
discover the values that no format knows.
Of an introducing word the last 40 characters count, of what lies before a value the last 56.

Edge cases: a null text is empty and has no spans; repeated rows each get the same spans; rows with
one id and different texts are told apart by a hash of the text; an empty table gives no rows; a value
that overlaps a span of a fixed format is never added; columns other than doc_id and text pass
through ``redact`` untouched and are ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import stored, unused

# The formats in the order of the report. Lookbehinds and possessive quantifiers only
# spare the engine useless attempts; \G lets a match begin where the last one ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9]++(?:[\x20-]?[0-9]++)++|[0-9]{2,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Seed formats of keys: an access key id, and hexadecimal strings of 16 and more.
KEY_FORMAT = r"^(?:AKIA[0-9A-Z]{16}|(?=.*[a-f])(?=.*[0-9])[0-9a-f]{16,})$"
# An identifier-like value, and the word and separators that may introduce it.
VALUE = (
    r"(?<![A-Za-z0-9._%+@/-])[A-Za-z._%+@/-]*+[0-9](?:[A-Za-z0-9._%+@/-]*[A-Za-z0-9])?"
)
SEPARATORS = r"[\s=\"':]+"
CUE = r"([^\s=\"':]{1,40})(" + SEPARATORS + r")$"
CONTEXT_CHARS = 56

#: Matches gathered in one array before the next is begun.
FEW = 16

LEAST_LENGTH = 6
LEAST_SEEDS = 3
LEAST_CONFIDENCE = 0.8
#: Rounds of scoring in a wave: more would let a pattern vouch for itself.
ROUNDS = 3
#: Waves at most; they end when one induces no new pattern. Each step of a chain of patterns takes one.
WAVES = 8

SPANS = "array<struct<start:int,end:int>>"
MATCHES = "array<struct<start:int,end:int,match:string,before:string>>"


def matches_of(text: Column, pattern: str, valid) -> Column:
    """[(start, end, match, before)] of the ``valid`` among the leftmost non-overlapping matches, in code
    points; ``before`` is the end of the text since the last match began.

    The pieces between the matches and the matches themselves alternate, so their lengths add up to
    the positions. Results are gathered in short arrays, as appending copies the whole array.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.split(text, pattern, -1), found, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match"))
    )
    start = F.struct(
        F.lit(0).alias("at"), F.lit("").alias("last"),
        F.array().cast(MATCHES).alias("few"), F.array().cast(f"array<{MATCHES}>").alias("full"),
    )

    def step(done: Column, x: Column) -> Column:
        begin = done["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        one = F.struct(
            begin.alias("start"), end.alias("end"), x["match"].alias("match"),
            F.substring(F.concat(done["last"], x["gap"]), -CONTEXT_CHARS, CONTEXT_CHARS).alias("before"),
        )
        ok, many = F.coalesce(valid(x["match"]), F.lit(False)), F.size(done["few"]) >= FEW
        few = F.when(ok & many, F.array(one)).when(ok, F.array_append(done["few"], one)).otherwise(done["few"])
        full = F.when(ok & many, F.array_append(done["full"], done["few"])).otherwise(done["full"])
        return F.struct(
            end.alias("at"), F.coalesce(x["match"], F.lit("")).alias("last"), few.alias("few"), full.alias("full")
        )

    return F.aggregate(pairs, start, step, lambda done: F.concat(F.flatten(done["full"]), done["few"]))


def spans_of(text: Column, pattern: str, valid) -> Column:
    """[(start, end)] of the matches that are ``valid``."""
    return F.transform(
        matches_of(text, pattern, valid), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))
    ).cast(SPANS)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


#: kind -> (what a text must hold for the pattern to be tried, pattern, test of a match).
FORMATS = {
    "email": ("@", EMAIL, lambda m: m.isNotNull()),
    "ip": ("[0-9]\\.[0-9]", IP, lambda m: m.rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
    "card": (
        "[0-9][\\x20-]?[0-9]", CARD,
        lambda m: F.length(digits(m)).between(13, 19) & F.call_function("luhn_check", digits(m)),
    ),
    "phone": ("\\+[0-9]", PHONE, lambda m: F.length(digits(m)).between(9, 15)),
}
CONTEXT = "context"


def format_spans(text: Column, kind: str) -> Column:
    needs, pattern, valid = FORMATS[kind]
    return F.when(text.rlike(needs), spans_of(text, pattern, valid)).otherwise(F.array().cast(SPANS))


def _keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.withColumn("text", text).withColumn("text_key", F.xxhash64(text))


def values_in_context(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, end, value, word, cue, entity, key): each span of a fixed format (``entity``), and
    each identifier-like value that none of them covers, with what introduces it and whether it has a seed format."""

    def found(matches: Column, known: bool) -> Column:
        return F.transform(
            matches,
            lambda m: F.struct(
                m["start"].alias("start"), m["end"].alias("end"), F.lit(known).alias("known"),
                m["match"].alias("value"), F.lower(m["before"]).alias("context"),
            ),
        )

    text = F.col("text")
    known = [
        F.when(text.rlike(needs), found(matches_of(text, pattern, valid), True)).otherwise(F.array())
        for needs, pattern, valid in FORMATS.values()
    ]
    values = found(matches_of(text, VALUE, lambda m: (F.length(m) >= LEAST_LENGTH) & m.isNotNull()), False)
    events = (
        _keyed(documents.select("doc_id", "text"))
        .withColumn("row", F.monotonically_increasing_id())
        .filter(F.col("text").rlike("[0-9@]"))
        .select("doc_id", "text_key", "row", F.explode(F.concat(*known, values)).alias("e"))
        .select("doc_id", "text_key", "row", "e.*")
    )
    # Known spans that began before a value and reach into it, or begin inside it.
    along = Window.partitionBy("row").orderBy("start")
    reach = F.max(F.when(F.col("known"), F.col("end"))).over(along.rowsBetween(Window.unboundedPreceding, 0))
    upcoming = F.min(F.when(F.col("known"), F.col("start"))).over(along.rowsBetween(0, Window.unboundedFollowing))
    covered = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(upcoming < F.col("end"), F.lit(False))
    return (
        events.withColumn("covered", covered)
        .filter(F.col("known") | ~F.col("covered"))
        .select(
            "doc_id", "text_key", "start", "end", "value", F.col("known").alias("entity"),
            F.col("value").rlike(KEY_FORMAT).alias("key"),
            F.regexp_extract("context", CUE, 1).alias("word"),
            F.concat(
                F.regexp_extract("context", CUE, 1),
                F.regexp_replace(F.regexp_extract("context", CUE, 2), r"\s+", " "),
            ).alias("cue"),
        )
    )


def strong_cues(documents: DataFrame, values: DataFrame, waves: int = WAVES) -> DataFrame:
    """(cue, confidence) of the patterns above the limits.

    A pattern that does not introduce enough different values can never be scored and goes first. The uses of
    the remaining patterns' words are then counted over all texts, once for all rounds.
    """
    seed = (F.col("entity") | F.col("key")).cast("double")
    pairs = stored(
        values.filter("word <> ''").groupBy("word", "cue", "value").agg(
            F.count(F.lit(1)).alias("n"), F.max(seed).alias("seed")
        ),
        "pii-pairs",
    )
    met = pairs.groupBy("word", "cue").agg(F.count(F.lit(1)).alias("values")).filter(F.col("values") >= LEAST_SEEDS)
    graph = stored(pairs.join(met.select("cue"), "cue"), "pii-graph")
    tokens = _keyed(documents.select("text")).select(
        F.explode(F.split(F.lower("text"), SEPARATORS)).alias("token")
    )
    wanted = graph.select(F.col("word").alias("token")).distinct()
    uses = stored(
        tokens.join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("uses")), "pii-uses"
    )
    seeds = stored(graph.groupBy("value").agg(F.max("seed").alias("known")), "pii-seeds")
    before = 0
    for _ in range(waves):
        induced = (
            graph.join(seeds.filter("known = 1"), "value")
            .groupBy("word", "cue").agg(F.count(F.lit(1)).alias("sure"))
            .filter(F.col("sure") >= LEAST_SEEDS)
        )
        open_graph = stored(graph.join(induced.select("cue"), "cue").join(seeds, "value"), "pii-induced")
        instances = seeds.select("value", F.col("known").alias("score"))
        for _ in range(ROUNDS):
            scored = (
                open_graph.join(instances, "value")
                .groupBy("word", "cue")
                .agg(F.sum(F.col("n") * F.col("score")).alias("hits"), F.sum("n").alias("seen"))
                .join(uses, F.col("word") == F.col("token"), "left")
                .select("cue", (F.col("hits") / F.greatest("seen", F.coalesce("uses", F.lit(0)))).alias("confidence"))
            )
            patterns = stored(scored, "pii-patterns")
            miss = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
            found = open_graph.join(patterns, "cue").groupBy("value").agg(
                F.greatest(F.max("known"), 1 - miss).alias("score")
            )
            instances = stored(found, "pii-instances")
        strong = patterns.filter(F.col("confidence") >= LEAST_CONFIDENCE)
        count = strong.count()
        if count <= before:
            break
        before = count
        sure = instances.filter(F.col("score") >= LEAST_CONFIDENCE).select("value", F.lit(1.0).alias("found"))
        seeds = stored(
            seeds.join(sure, "value", "left").select("value", F.greatest("known", F.coalesce("found", F.lit(0.0))).alias("known")),
            "pii-seeds",
        )
    return strong


def context_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, context): the spans that the method adds to a row's fixed formats."""
    values = stored(values_in_context(documents), "pii-values")
    cues = strong_cues(documents, values).select(F.col("cue").alias("__cue"))
    unseen = values.filter("not entity")
    found = unseen.join(cues, unseen["cue"] == cues["__cue"], "left").filter(
        F.col("key") | F.col("__cue").isNotNull()
    )
    return found.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias(CONTEXT)
    )


def find_pii(documents: DataFrame, keep_text: bool = True, name: str = "pii") -> DataFrame:
    """``documents`` (null texts empty) with a column ``name``: an array of (start, end) spans per kind.

    Only rows with a digit or an @ are matched; the spans that the method adds are joined by id and
    text hash. Without ``keep_text`` the texts take no part in that join.
    """
    added = stored(context_spans(documents), "pii-spans")
    text = F.coalesce("text", F.lit(""))
    spotted = documents.drop(name)
    key, formats, doc, hashed, spans = (unused(spotted, n) for n in ("key", "formats", "added_doc", "added_key", "added"))
    found = F.struct(*[format_spans(text, kind).alias(kind) for kind in FORMATS])
    spotted = spotted.withColumns({"text": text, key: F.xxhash64(text), formats: found})
    if not keep_text:
        spotted = spotted.drop("text")
    joined = added.select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(hashed), F.col(CONTEXT).alias(spans)
    )
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(key) == F.col(hashed))
    kinds = [F.col(f"{formats}.{kind}").alias(kind) for kind in FORMATS]
    context = F.coalesce(spans, F.array().cast(SPANS)).alias(CONTEXT)
    return (
        spotted.join(joined, same, "left")
        .withColumn(name, F.struct(*kinds, context))
        .drop(key, formats, doc, hashed, spans)
    )


def report(kinds: list[str]) -> Column:
    """kind:start:end of the spans in ``pii``, in the order of ``kinds``, joined by commas."""

    def texts(kind: str) -> Column:
        return F.transform(f"pii.{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.concat_ws(",", F.concat(*map(texts, kinds)))


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with every span replaced by its kind, as in ``[EMAIL]``. Of spans that overlap
    the one that begins first is named and the rest of both goes. ``n_chars``, if there, is updated."""
    kinds = [*FORMATS, CONTEXT]
    pii, spans = unused(documents, "pii"), unused(documents, "spans")
    found = find_pii(documents, name=pii)

    def tags(kind: str) -> Column:
        tag = F.lit(f"[{kind.upper()}]").alias("tag")
        return F.transform(
            f"{pii}.{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), tag)
        )

    tagged = F.array_sort(F.concat(*map(tags, kinds)))
    text = F.col("text")

    def step(done: Column, s: Column) -> Column:
        inside = s["start"] < done["at"]
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(inside, done["out"]).otherwise(F.concat(done["out"], gap, s["tag"])).alias("out"),
        )

    cleaned = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))),
    )
    out = found.withColumn(spans, tagged).withColumn("text", F.when(F.size(spans) == 0, text).otherwise(cleaned))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out.select(*documents.columns)
