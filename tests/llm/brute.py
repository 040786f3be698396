"""Plain-Python forms of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def fold(doc_id, n):
    return (0 if doc_id is None else crc32(str(doc_id).encode())) % n


def targets(sizes):
    """source -> target, for source -> words."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return {**capped, **share}
        capped.update({s: 3.0 * sizes[s] for s in above})


def nearest_sum_gap(lengths, copies, budget):
    """How far the best choice of up to so many copies of each item is from the budget."""
    sums = 1  # bit s: the sum s is reachable
    for length in lengths:
        for _ in range(copies):
            sums |= sums << length
    return next(gap for gap in range(budget + 1) if sums >> (budget - gap) & 1 or sums >> (budget + gap) & 1)


def unigram_scores(docs):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score); ids are distinct."""
    tokens = {d: [*words(lower_ascii(t)), None] for d, t in docs}
    counts = Counter()
    for d, found in tokens.items():
        if fold(d, 5) != 1:
            counts.update(found)
    n, v = sum(counts.values()), len(counts)
    return {
        d: (
            len(found), sum(counts[t] > 0 for t in found), n,
            sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in found),
        )
        for d, found in tokens.items()
    }


def pair_score(docs, discount=0.75, least=1):
    """doc_id -> log10 probability, without quantising."""
    tokens = {d: [*words(lower_ascii(t)), None] for d, t in docs}
    single, pairs, context = Counter(), Counter(), Counter()
    for d, found in tokens.items():
        if fold(d, 5) != 1:
            single.update(found)
            for pair in zip(["<s>", *found], found):
                pairs[pair] += 1
                context[pair[0]] += 1
    n, v = sum(single.values()), len(single)
    held = defaultdict(float)
    kept = {p: (c - discount) / context[p[0]] for p, c in pairs.items() if c >= least}
    for p, value in kept.items():
        held[p[0]] += value
    unigram = lambda t: (single[t] + 0.5) / (n + 0.5 * (v + 1))
    return {
        d: sum(
            math.log10(kept.get(p, 0.0) + (1 - held[p[0]]) * unigram(p[1])) for p in zip(["<s>", *found], found)
        )
        for d, found in tokens.items()
    }


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def base_spans(text):
    return {
        kind: [m.span() for m in re.finditer(pattern, text or "") if valid(kind, m.group())]
        for kind, pattern in FORMATS.items()
    }


def base_report(text):
    spans = base_spans(text)
    joined = ",".join(f"{k}:{a}:{b}" for k in FORMATS for a, b in spans[k])
    return [len(spans[k]) for k in FORMATS], hashlib.sha256(joined.encode()).hexdigest(), joined


def simhash(text, shingle):
    found = words(lower_ascii(text))
    if not found:
        return 0
    parts = [" ".join(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, linked):
    """Component of each of n items, given by its smallest member; ``linked`` yields index pairs."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash_classes(docs, shingle, distance):
    docs = sorted(docs)
    fps = np.array([simhash(t, shingle) for _, t in docs], dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    found = classes(len(docs), zip(*np.nonzero(near)))
    return {d: (f"{fps[i]:016x}", docs[found[i]][0]) for i, (d, _) in enumerate(docs)}


def cosine_classes(rows, cosine):
    """vec_id -> (n_links, component_id); rows are (vec_id, list or None) with distinct ids."""
    rows = sorted(rows, key=lambda r: r[0])
    good = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v in rows
    ]
    pairs = []
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if good[i] and good[j] and len(a) == len(b):
                x, y = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    pairs.append((i, j))
    links = Counter(k for pair in pairs for k in pair)
    found = classes(len(rows), pairs)
    return {r[0]: (links[i], rows[found[i]][0]) for i, r in enumerate(rows)}


def line_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    found = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = {
        i + k for i, w in enumerate(zip(found, found[1:], found[2:])) if windows[w] > 1 for k in range(3)
    }
    n = len(found)
    return (
        n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        len(covered), n < 50 or 100 * len(covered) > 50 * n,
    )


def normal_lines(text):
    out = []
    for line in (text or "").split("\n"):
        if words(line):
            out.append((" ".join(words(line)).lower(), len(words(line))))
    return out


def line_verdicts(docs, share, least_documents, least_left):
    """(doc_id, words_left, kept) of (doc_id, text, source), in order."""
    hosts = Counter(s for _, _, s in docs)
    held = Counter((s, line) for _, t, s in docs for line in {x for x, _ in normal_lines(t)})
    out = []
    for d, t, s in docs:
        counts = line_counts(t)
        gone = sum(
            n for line, n in normal_lines(t)
            if held[s, line] > least_documents and held[s, line] > share * hosts[s]
        )
        left = counts[0] - gone
        out.append((d, left, not counts[5] and left >= least_left * counts[0]))
    return out
