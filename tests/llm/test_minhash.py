"""Classes of near duplicates against all pairs of full shingle sets."""

import random
import re

import numpy as np
import pytest

from convoy.llm import minhash
from convoy.llm.minhash import fast_sketch, near_duplicates

SCHEMA = "doc_id long, text string, rep long, band string, n_shingles long"


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def expected(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if (n := len(sets[a] & sets[b])) and 100 * n >= 85 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(s), label[i], label[i] == i) for i, s in sets.items()}


def got(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)
    return {r[0]: tuple(r[1:]) for r in near_duplicates(docs).collect()}


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"w{rng.random()}"
    return " ".join(words)


@pytest.mark.parametrize("rounds", [1, 2])
def test_groups_of_copies(spark, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", rounds)
    rng = random.Random(9)
    base = [[f"v{rng.randint(0, 10**6)}" for _ in range(n)] for n in (150, 40, 400)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "One two"), (4, "one TWO"), (5, "one two three four"),
            (6, "x " * 60_000), (7, "y " + "x " * 60_000), (8, "İ é É ß x"), (9, "İ é É ß X")]
    for k, words in enumerate(base):
        for j in range(60):
            rows.append((100 * (k + 1) + j, edited(rng, words, rng.randint(0, len(words) // 25))))
        rows += [(1000 + 10 * k + j, " ".join(words).upper()) for j in range(9)]
    chain = [f"c{j}" for j in range(200)]
    rows += [(2000 + j, " ".join(chain[2 * j : 2 * j + 100])) for j in range(40)]
    assert got(spark, rows) == expected(rows)


def test_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(spark, rows) == expected(rows)


def test_empty_and_repeated_rows(spark):
    assert got(spark, []) == {}
    docs = spark.createDataFrame(
        [(1, "a b c d e f", 1, "", 1), (1, "a b c d e f", 1, "", 1), (None, "a b c d e f", 1, "", 1)],
        SCHEMA,
    )
    assert [tuple(r) for r in near_duplicates(docs).collect()] == [(1, 2, 1, True)] * 2


def test_sketches_fill_and_estimate_the_similarity():
    rng = np.random.default_rng(0)
    size, rounds = 144, 40
    for n in (1, 3, 50, 2000):
        values = rng.integers(0, 2**63, n).astype(np.uint64)
        sketch = fast_sketch(values, np.zeros(n, np.int64), 1, size)
        assert (sketch != np.iinfo(np.uint64).max).all()
    shares = []
    for _ in range(rounds):
        union = rng.integers(0, 2**63, 300).astype(np.uint64)
        one, other = union[:270], union[30:]
        both = fast_sketch(
            np.concatenate((one, other)), np.repeat([0, 1], [len(one), len(other)]), 2, size
        )
        shares.append((both[0] == both[1]).mean())
    assert abs(np.mean(shares) - 240 / 300) < 0.02


@pytest.mark.parametrize("rounds", [1, 2])
def test_a_failed_pivot_does_not_hide_a_link(spark, monkeypatch, rounds):
    """Texts with one link and one neighbour that is not quite similar, both with smaller ids."""
    monkeypatch.setattr(minhash, "PIVOT_ROUNDS", rounds)
    rng = random.Random(21)
    rows = []
    for k in range(300):
        words = [f"v{rng.randint(0, 10**6)}" for _ in range(300)]
        rows += [(3 * k, edited(rng, words, 6)), (3 * k + 1, edited(rng, words, 4)), (3 * k + 2, " ".join(words))]
    found = got(spark, rows)
    sets = {i: shingles(t) for i, t in rows}
    similar = lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    alone = [i for i in range(2, 900, 3) if similar(i, i - 1) and not similar(i, i - 2)]
    assert len(alone) > 100 and all(found[i][1] == found[i - 1][1] for i in alone)
