"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays.

A word is a run of letters, lower-cased, with a mark at either end; its characters are predicted from
up to three before them. Counts of a bounded sample of labelled documents are summed in Spark, and
the models are worked out for all languages at once: for every n-gram known to any language, the
sorted array of hashes has one row of log probabilities, one column per language. A document's
language is the one with the lowest cross-entropy per character.

The score is a softmax over the cross-entropies whose sharpness is fitted on sampled documents kept
out of the counts. Documents whose best cross-entropy is above nearly all of those are ``rejected``;
the language is given all the same.

Edge cases: a null text or one without a letter is ``und`` with score 0; without labelled documents
every text is ``und``; ties go to the language that sorts first; repeated rows are judged alike and
each is returned; a document of any length is read whole; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import fold, ship_package, stored
from costlake.llm.words import mix

ORDER = 4
#: Names and counts of so many languages are sent to all tasks (a few MB); of more, they are joined by shuffle.
MOST_LANGUAGES_SENT = 50_000
#: Labelled documents learnt from per language at most, and the share of them kept for calibration.
MOST_PER_LANGUAGE, CALIBRATION = 1_500, 0.25
#: Share of the calibration documents that must not be rejected.
ACCEPTED = 0.995
#: Characters of words held back for one array operation, and words that a worker remembers.
BATCH_WORDS, CACHE = 50_000, 300_000
SEED = 20240611
UNKNOWN = "und"
START, STOP = "\x02", "\x03"

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_runs(text: str | None) -> list[str]:
    """Runs of letters of the lower-cased text. Signs that only count as numbers are no letters."""
    found = _LETTERS.findall((text or "").lower())
    return [w for w in found if w.isalpha() or any(c.isalpha() for c in w)]


def grams(word: str) -> Iterator[str]:
    """Each character after the first mark, with the up to three before it."""
    marked = START + word + STOP
    for end in range(2, len(marked) + 1):
        yield marked[max(0, end - ORDER) : end]


def hashed(codes: np.ndarray) -> np.ndarray:
    """Hashes of the rows (n, k) of code points."""
    out = np.full(len(codes), codes.shape[1], dtype=np.uint64)
    for column in codes.T:
        out = out * np.uint64(0x100000001B3) + column.astype(np.uint64) + np.uint64(1)
    return mix(out)


def hashed_texts(texts: list[str]) -> np.ndarray:
    codes = np.array([[ord(c) for c in t] for t in texts], dtype=np.uint64).reshape(len(texts), -1)
    return hashed(codes)


class Models:
    """Character models of all languages; ``counts`` is language -> n-gram of ``grams`` -> count."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.languages = sorted(counts)
        letters = {g[-1] for c in counts.values() for g in c}
        self.sharpness, self.limit = 1.0, np.inf
        levels = [self._levels(counts[name]) for name in self.languages]
        uniform = 1.0 / (len(letters) + 1)
        self.keys, self.logs, self.back_keys, self.backs = {}, {}, {}, {}
        lower: dict[str, np.ndarray] = {"": np.full(len(self.languages), uniform)}
        for k in range(1, ORDER + 1):
            known = sorted({g for own in levels for g in own[k]})
            share = []  # per language: n-gram -> discounted share, context -> what is left
            for own in levels:
                share.append(self._shares(own[k]))
            probabilities = {}
            for gram in known:
                base = self._of(lower, share_backs, gram[1:]) if k > 1 else lower[""]
                context = gram[:-1]
                probabilities[gram] = np.array(
                    [s[0].get(gram, 0.0) + s[1].get(context, 1.0) * b for s, b in zip(share, base)]
                )
            contexts = sorted({c for s in share for c in s[1]})
            backs = {c: np.array([s[1].get(c, 1.0) for s in share]) for c in contexts}
            self._store(k, probabilities, backs)
            lower = {**lower, **probabilities} if k > 1 else probabilities
            share_backs = backs if k == 1 else {**share_backs, **backs}
        unseen = self.backs[1][0] + np.log(uniform)
        self.unseen = unseen

    @staticmethod
    def _of(lower: dict, backs: dict, gram: str) -> np.ndarray:
        """Probability of a shorter n-gram: its own, or that of a shorter one yet times what is left."""
        factor = 1.0
        while gram not in lower:
            factor = factor * backs.get(gram[:-1], 1.0)
            gram = gram[1:]
        return factor * lower[gram]

    @staticmethod
    def _levels(counts: dict[str, int]) -> dict[int, dict[str, int]]:
        """Counts of the longest n-grams, and of those at the start of a word; for the others, the
        number of different characters before them."""
        levels: dict[int, Counter] = {k: Counter() for k in range(1, ORDER + 1)}
        for gram, n in counts.items():
            levels[len(gram)][gram] += n
        for k in range(ORDER, 1, -1):
            for gram in list(levels[k]):
                levels[k - 1][gram[1:]] += 1
        return levels

    @staticmethod
    def _shares(level: dict[str, int]) -> tuple[dict[str, float], dict[str, float]]:
        once = sum(1 for n in level.values() if n == 1)
        twice = sum(1 for n in level.values() if n == 2)
        discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
        total, kinds = defaultdict(int), defaultdict(int)
        for gram, n in level.items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        shares = {g: (n - discount) / total[g[:-1]] for g, n in level.items()}
        return shares, {c: discount * kinds[c] / total[c] for c in total}

    def _store(self, k: int, probabilities: dict, backs: dict) -> None:
        width = len(self.languages)
        for texts, keys, values in (
            (probabilities, self.keys, self.logs), (backs, self.back_keys, self.backs)
        ):
            names = list(texts)
            size = k if texts is probabilities else k - 1
            found = hashed_texts(names) if size else np.zeros(len(names), dtype=np.uint64)
            order = np.argsort(found)
            keys[k] = found[order]
            logs = np.log(np.array([texts[n] for n in names])).reshape(len(names), width)
            values[k] = logs[order].astype(np.float32)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(wanted), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, -1)

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """(words, languages): sums over the characters and the end of each word."""
        marked = [START + w + STOP for w in words]
        sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")
        starts = np.cumsum(sizes) - sizes
        inside = np.arange(len(codes)) - np.repeat(starts, sizes)
        at = np.flatnonzero(inside > 0)
        inside = inside[at]
        sums = np.zeros((len(at), len(self.languages)), dtype=np.float32)
        open_ = np.ones(len(at), dtype=bool)
        for k in range(ORDER, 0, -1):
            here = np.flatnonzero(open_ & (inside >= k - 1))
            window = codes[at[here][:, None] + np.arange(1 - k, 1)]
            place = self._find(self.keys[k], hashed(window))
            found = place >= 0
            sums[here[found]] += self.logs[k][place[found]]
            open_[here[found]] = False
            if k > 1:
                missed = here[~found]
                before = self._find(self.back_keys[k], hashed(window[~found][:, :-1]))
                known = before >= 0
                sums[missed[known]] += self.backs[k][before[known]]
        sums[open_] += self.unseen
        owner = np.repeat(np.arange(len(words)), sizes - 1)
        out = np.zeros((len(words), len(self.languages)))
        np.add.at(out, owner, sums) if len(words) < 64 else self._add(out, sums, sizes - 1)
        return out

    @staticmethod
    def _add(out: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> None:
        out += np.add.reduceat(sums.astype(np.float64), np.cumsum(sizes) - sizes, axis=0)


class Judge:
    """Scores texts; remembers the words it has met, up to a bound."""

    def __init__(self, models: Models):
        self.models = models
        self.known: dict[str, int] = {}
        self.values = np.zeros((1024, len(models.languages)))

    def _add(self, new: list[str]) -> None:
        need = len(self.known) + len(new)
        if need > len(self.values):
            grown = np.zeros((max(need, 2 * len(self.values)), self.values.shape[1]))
            grown[: len(self.values)] = self.values
            self.values = grown
        for start in range(0, len(new), BATCH_WORDS):
            some = new[start : start + BATCH_WORDS]
            at = len(self.known)
            self.values[at : at + len(some)] = self.models.log_probabilities(some)
            self.known.update(zip(some, range(at, at + len(some))))

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages): nats per character; NaN for a text without letters."""
        out = np.full((len(texts), len(self.models.languages)), np.nan)
        for i, text in enumerate(texts):
            found = letter_runs(text)
            if not found:
                continue
            if len(self.known) > CACHE:
                self.known.clear()
            new = [w for w in dict.fromkeys(found) if w not in self.known]
            if new:
                self._add(new)
            rows = np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))
            characters = sum(map(len, found)) + len(found)
            out[i] = -self.values[rows].sum(axis=0) / characters
        return out


def confidences(entropies: np.ndarray, sharpness: float) -> np.ndarray:
    """Softmax over the languages; sharper for lower cross-entropies."""
    lead = np.exp(-sharpness * (entropies - entropies.min(axis=1, keepdims=True)))
    return lead / lead.sum(axis=1, keepdims=True)


def calibrate(models: Models, entropies: np.ndarray, truth: np.ndarray) -> None:
    """Fit the sharpness by likelihood and the rejection limit by quantile."""
    good = ~np.isnan(entropies[:, 0])
    entropies, truth = entropies[good], truth[good]
    if not len(truth):
        return
    grid = np.geomspace(0.5, 500, 40)
    rows = np.arange(len(truth))
    fits = [np.log(np.clip(confidences(entropies, g)[rows, truth], 1e-12, 1)).mean() for g in grid]
    models.sharpness = float(grid[int(np.argmax(fits))])
    models.limit = float(np.quantile(entropies.min(axis=1), ACCEPTED))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, Counter] = defaultdict(Counter)
    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            for word, n in Counter(letter_runs(text)).items():
                for gram in grams(word):
                    found[lang][gram] += n
    rows = [(lang, gram, n) for lang, own in found.items() for gram, n in own.items()]
    columns = list(zip(*rows)) if rows else [[], [], []]
    kinds = [pa.string(), pa.string(), pa.int64()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "gram", "n"]
    )


def fit(documents: DataFrame, learn_from: Column | None = None, most: int = MOST_PER_LANGUAGE) -> Models | None:
    """Models of every language of the labelled ``documents`` (text, lang, doc_id), from about ``most``
    documents each at most, chosen by a hash of the id; None without any."""
    known = documents.filter("lang is not null and text is not null")
    if learn_from is not None:
        known = known.filter(learn_from)
    sizes = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("__n")), "language-sizes")
    if sizes.count() <= MOST_LANGUAGES_SENT:
        sizes = F.broadcast(sizes)  # so that no text is shuffled
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = stored(
        known.select("doc_id", "lang", "text")
        .join(sizes, "lang")
        .filter(draw * F.col("__n") < most)
        .select("lang", "text", (draw * F.greatest("__n", F.lit(most)) / most).alias("draw")),
        "language-sample",
    )
    counted = sample.filter(f"pmod(draw * 97.0, 1.0) >= {CALIBRATION}")
    table = (
        counted.select("lang", "text")
        .mapInArrow(_counts, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, gram, n in zip(*(table.column(c).to_pylist() for c in ("lang", "gram", "n"))):
        counts[lang][gram] = n
    if not counts:
        return None
    models = Models(counts)
    kept = sample.filter(f"pmod(draw * 97.0, 1.0) < {CALIBRATION}").filter(
        F.col("lang").isin(models.languages)
    )
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Judge(shared.value)
        for batch in batches:
            found = own.entropies(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(list(found), pa.list_(pa.float64()))], names=["lang", "nats"]
            )

    seen = kept.select("lang", "text").mapInArrow(judge, "lang string, nats array<double>").toArrow()
    if seen.num_rows:
        truth = np.array([models.languages.index(x) for x in seen.column("lang").to_pylist()])
        calibrate(models, np.array(seen.column("nats").to_pylist(), dtype=np.float64), truth)
    return models


def identify(documents: DataFrame, learn_from: Column | None = None, most: int = MOST_PER_LANGUAGE) -> DataFrame:
    """(doc_id, lang_pred, score, nats, rejected) of every row of ``documents``."""
    spark = documents.sparkSession
    ship_package(spark)
    models = fit(documents, learn_from, most)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if models is None:
        return texts.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("nats"), F.lit(True).alias("rejected"),
        )
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        own = judge.models
        names = np.array([*own.languages, UNKNOWN], dtype=object)
        for batch in batches:
            found = judge.entropies(batch.column(1).to_pylist())
            silent = np.isnan(found[:, 0])
            filled = np.where(silent[:, None], 0.0, found)
            best = filled.argmin(axis=1)
            rows = np.arange(len(best))
            score = np.where(silent, 0.0, confidences(filled, own.sharpness)[rows, best])
            nats = filled[rows, best]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names[np.where(silent, len(own.languages), best)], pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(nats, pa.float64(), mask=silent),
                    pa.array(silent | (nats > own.limit), pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "nats", "rejected"],
            )

    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double, nats double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 3) == 1
