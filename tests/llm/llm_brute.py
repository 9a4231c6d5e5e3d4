"""The training-data operators once more in plain Python, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ANY_CASE = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def windows(benchmark, n=10):
    found = {}
    for item, text in benchmark:
        words = WORD.findall(ascii_lower(text))
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            found.setdefault(tuple(words[i : i + size]), set()).add(item)
    return found


def hits(text, found):
    """Covered positions and items of one text."""
    words = WORD.findall(ascii_lower(text))
    covered, items = set(), set()
    for size in {len(w) for w in found}:
        for i in range(len(words) - size + 1):
            owners = found.get(tuple(words[i : i + size]))
            if owners:
                covered.update(range(i, i + size))
                items |= owners - {None}
    return len(words), covered, items


def decontaminated(text, found, share=0.5):
    """The text without hit words, or None where the document goes."""
    n, covered, _ = hits(text, found)
    if len(covered) > share * n:
        return None
    if not covered:
        return text
    pieces = ANY_CASE.findall(text)
    tail = text[sum(map(len, pieces)) :]
    return "".join(p for i, p in enumerate(pieces) if i not in covered) + tail


def measures(text):
    text = text or ""
    words = SPACED.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    repeated = {p for i, g in enumerate(grams) if counts[g] > 1 for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_lines": len(lines),
        "n_distinct": len(set(words)),
    }


def good(text):
    m = measures(text)
    n = m["n_words"]
    return (
        n >= 50
        and 100 * m["n_repeat_words"] <= 50 * n
        and 10 * m["n_symbols"] <= n
        and 2 * m["n_dup_lines"] <= m["n_lines"]
        and 2 * n <= m["word_chars"] <= 25 * n
        and m["n_distinct"] ** 2 >= n
    )


def fingerprint(text):
    words = [w.encode() for w in SPACED.findall(ascii_lower(text))]
    grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    if words and not grams:
        grams = [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=2):
    """The smallest index of the component of each position."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def shingles(text, width=5):
    words = SPACED.findall(ascii_lower(text))
    return frozenset(zip(*[words[i:] for i in range(min(width, len(words)))]))


def near(a, b):
    """Two sets of shingles at a Jaccard similarity of 0.8 or more."""
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def near_groups(texts):
    """The smallest index of the component of near copies of each position, over all pairs."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * min(len(a), len(sets[j])) >= 4 * max(len(a), len(sets[j])) and near(a, sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


def quality_weight(text):
    text = text or ""
    lines = [x for x in text.split("\n") if x.rstrip(" \t\r").strip() or x.rstrip(" \t\r")]
    closed = sum(bool(re.search(r"[.!?][\"')]*[ \t\r]*$", x)) for x in lines)
    return min(1.0, max(0.1, closed / max(1, len(lines))))


def shares(sizes, weights=(5, 2, 1), cap=3):
    """Targets by handing out the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in target]
        left = total - sum(target.values())
        wsum = sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * left >= cap * sizes[s] * wsum]
        if not over:
            return {s: float(target[s]) if s in target else weight[s] * left / wsum for s in order}
        target |= {s: cap * sizes[s] for s in over}


def mixed(docs):
    """``copies`` of each ``(doc_id, text, source)``."""
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(SPACED.findall(text or ""))
    targets, copies = shares(dict(sizes)), []
    for source, size in sizes.items():
        epochs = math.floor(targets[source] / size) if size else 0
        rest, units = targets[source] - epochs * size, {}
        for i, (doc_id, text, own) in enumerate(docs):
            if own == source:
                digest = "" if text is None else hashlib.md5(text.encode()).hexdigest()
                name = f"mix:{'' if doc_id is None else doc_id}:{digest}"
                bits = int(hashlib.md5(name.encode()).hexdigest()[:13], 16)
                key = -math.log((bits + 0.5) / 2**52) / quality_weight(text)
                units.setdefault(key, []).append(i)
        upto = 0
        for key in sorted(units):
            before = upto
            upto += sum(len(SPACED.findall(docs[i][1] or "")) for i in units[key])
            taken = rest > 0 and (upto <= rest or before < rest and upto - rest < rest - before)
            copies += [(i, epochs + taken) for i in units[key]]
    return [n for _, n in sorted(copies)]


class KneserNey:
    """Two letter models with shared pairs, straight from the definitions, over lists of words."""

    def __init__(self, ordinary, toxic, corpus, order=6, discount=0.75):
        self.order, self.discount = order, discount
        self.pairs = Counter(
            pair for word in set(corpus) for marked in [f"^^{word}$"] for pair in map("".join, zip(marked[1:], marked[2:]))
        )
        self.last = Counter(pair[1] for pair in self.pairs)
        self.classes = []
        for words in (ordinary, toxic):
            tokens = Counter()
            for word in words:
                marked = f"^^{word}$"
                for end in range(3, len(marked) + 1):
                    tokens.update(marked[end - k : end] for k in range(3, order + 1) if k <= end)
            self.classes.append(
                {
                    g: n if len(g) == order or g.startswith("^^") else sum(x[1:] == g for x in tokens if len(x) == len(g) + 1)
                    for g, n in tokens.items()
                }
            )

    def interpolated(self, table, gram, p):
        same = {g: n for g, n in table.items() if len(g) == len(gram) and g[:-1] == gram[:-1]}
        if not same:
            return None
        seen = max(table.get(gram, 0) - self.discount, 0)
        return (seen + self.discount * len(same) * p) / sum(same.values())

    def probability(self, side, gram):
        p = (self.last[gram[-1]] + 0.5) / (len(self.pairs) + 0.5 * len(self.last) + 1)
        p = self.interpolated(self.pairs, gram[-2:], p) or p
        for k in range(3, len(gram) + 1):
            longer = self.interpolated(self.classes[side], gram[-k:], p)
            if longer is None:
                break
            p = longer
        return p

    def log_likelihood(self, word, side):
        marked = f"^^{word}$"
        ends = range(3, len(marked) + 1)
        return sum(math.log(self.probability(side, marked[max(0, e - self.order) : e])) for e in ends)

    def difference(self, words, share=0.02):
        """Of the log-likelihoods of a text under the mixture and under the ordinary model, by word."""
        total = 0.0
        for word in words:
            ordinary, toxic = (self.log_likelihood(word, side) for side in (0, 1))
            total += math.log((1 - share) * math.exp(ordinary) + share * math.exp(toxic)) - ordinary
        return total / len(words) if words else 0.0


def packed(docs, tokenizer, end=1):
    """``(doc_id, start, n_tokens, crc32)`` of ``(doc_id, text)`` in that order."""
    rows, start = [], 0
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        rows.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows
