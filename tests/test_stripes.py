import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from wordloom.operators import counts, stripes


def parsed(rows):
    """Stripes by head, with a check that no tail stands in two parts."""
    found = {}
    for row in rows:
        entries = dict(e.rsplit(":", 1) for e in row.stripe.split(", "))
        whole = found.setdefault(row.head, {})
        assert not whole.keys() & entries.keys()
        whole.update({tail: int(n) for tail, n in entries.items()})
    return found


@pytest.fixture(scope="module")
def texts():
    """A third of all pairs start with one word, and its tails are all different."""
    rng = random.Random(3)
    hot = [f"hot t{i} w{rng.randrange(20)}" for i in range(1500)]
    return hot + [" ".join(rng.choices("abcdefg", k=6)) for _ in range(300)]


@pytest.mark.parametrize("n", [2, 3])
@pytest.mark.parametrize("part_bytes", [50, 2000, stripes.PART_BYTES])
def test_stripes_stay_whole_in_any_part_size(frame, texts, n, part_bytes):
    entries = counts.head_tail_counts(frame(texts), n)
    rows = stripes.stripe_texts(entries, part_bytes).collect()
    assert parsed(rows) == brute.stripe_counts(texts, n)
    assert len({(r.head, r.part) for r in rows}) == len(rows)
    for row in rows:
        tails = [e.rsplit(":", 1)[0] for e in row.stripe.split(", ")]
        assert tails == sorted(tails, key=lambda t: t.encode())


def test_hot_head_is_split_into_parts_of_bounded_size(frame, texts):
    entries = counts.head_tail_counts(frame(texts), 2)
    rows = stripes.stripe_texts(entries, 2000).collect()
    parts = Counter(r.head for r in rows)
    whole = sum(len(r.stripe) + 2 for r in rows if r.head == "hot")
    assert parts["hot"] >= whole // 2000
    assert max(len(r.stripe) for r in rows) < 2 * 2000
    assert parts["a"] == 1


def test_part_size_does_not_depend_on_the_number_of_large_heads(frame):
    """Every head is large here, and all of them are split to the same size."""
    rng = random.Random(5)
    texts = [f"h{i % 40} t{rng.randrange(10**6)}" for i in range(6000)]
    for part_bytes in (100, 400):
        rows = stripes.stripe_texts(
            counts.head_tail_counts(frame(texts), 2), part_bytes
        ).collect()
        assert parsed(rows) == brute.stripe_counts(texts, 2)
        sizes = [len(r.stripe.encode()) for r in rows]
        assert sum(sizes) / len(sizes) < part_bytes * 1.1
        assert max(sizes) < 3 * part_bytes
    rows = stripes.stripe_texts(counts.head_tail_counts(frame(texts), 2), 1).collect()
    assert parsed(rows) == brute.stripe_counts(texts, 2)


def test_map_view(frame, texts):
    entries = counts.head_tail_counts(frame(texts), 2)
    found = {}
    for row in stripes.stripe_maps(entries, 2000).collect():
        found.setdefault(row.head, {}).update(row.stripe)
    assert found == brute.stripe_counts(texts, 2)


@pytest.mark.parametrize("n", [2, 3, 5])
def test_line_stripes(frame, n):
    rng = random.Random(n)
    texts = [" ".join(rng.choices("abc", k=rng.randrange(40))) for _ in range(200)]
    texts += ["", None, "a", "a b", " ".join(rng.choices("abcdefgh", k=30_000))]
    rows = stripes.line_stripes(frame(texts), n, "id").collect()
    got = {}
    for row in rows:
        entries = dict(e.rsplit(":", 1) for e in row.stripe.split(", "))
        got[row.id, row.head] = {tail: int(n) for tail, n in entries.items()}
    expected = {
        (i, head): found
        for i, line in enumerate(texts)
        if line is not None
        for head, found in brute.stripe_counts([line], n).items()
    }
    assert got == expected
    assert len(rows) == len(got)


def test_line_stripes_of_a_long_line_with_words_that_begin_alike(frame):
    """Words sort around the comma; one head has more entries than a thread's stack has frames."""
    words = ["a", "a'b", "a-b", "ab", "a1", "é", "𐐨", "日本"]
    rng = random.Random(11)
    lines = [" ".join(rng.choices(words, k=300)) for _ in range(20)]
    lines += [" ".join(f"a t{i}" for i in range(40_000)), " ".join(["a"] * 50_000)]
    for n in (2, 4):
        got = {}
        for row in stripes.line_stripes(frame(lines), n, "id").collect():
            entries = [e.rsplit(":", 1) for e in row.stripe.split(", ")]
            assert [t for t, _ in entries] == sorted((t for t, _ in entries), key=str.encode)
            assert (row.id, row.head) not in got
            got[row.id, row.head] = {t: int(k) for t, k in entries}
        assert got == {
            (i, head): found
            for i, line in enumerate(lines)
            for head, found in brute.stripe_counts([line], n).items()
        }


def test_line_stripes_take_few_steps_a_word(frame):
    """One function of each n-gram and one of each entry: what runs outside generated code."""
    plan = stripes.line_stripes(frame(["a b"]), 2, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") == 2


def test_sums_and_sizes_match_the_pairs(frame, texts):
    lines = frame(texts)
    entries = counts.head_tail_counts(lines, 3)
    grams = counts.ngram_counts(lines, 3)
    assert entries.count() == grams.count()
    assert entries.agg(F.sum("n")).first() == grams.agg(F.sum("n")).first()


@pytest.mark.parametrize("value", [0, -1, 2.5])
def test_part_size_is_checked(frame, value):
    with pytest.raises(ValueError):
        stripes.stripe_texts(counts.head_tail_counts(frame(["a b"]), 2), value)
