"""The same answers in plain Python, for small inputs."""

import re
from collections import Counter, defaultdict

import regex

WORD = regex.compile(r"[\p{L}0-9](?:[\p{L}0-9'-]*[\p{L}0-9])?")


def lines(text):
    parts = re.split("\r\n|\r|\n", text)
    return parts[:-1] if parts[-1] == "" else parts


def words(line):
    return WORD.findall(line.lower())


def word_counts(all_lines):
    return Counter(w for line in all_lines for w in words(line))


def grams(all_lines, n):
    for line in all_lines:
        found = words(line)
        yield from zip(*(found[k:] for k in range(n)))


def gram_counts(all_lines, n):
    return Counter(",".join(gram) for gram in grams(all_lines, n))


def stripe_counts(all_lines, n):
    found = defaultdict(Counter)
    for head, *tail in grams(all_lines, n):
        found[head][",".join(tail)] += 1
    return found
