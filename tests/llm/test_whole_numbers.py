"""Clusters and codes of whole-number vectors against full scans in plain Python integers."""

import hashlib

import numpy as np
import pytest

from convoy.llm import codes
from convoy.llm.clusters import clustered, evaluate
from convoy.llm.codes import Codebook, coded, with_label_error

# Further columns carry names that the operators use themselves.
SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, point string, `a.b` int"
BAD = [None, [], [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None] + [0.5] * 63]


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "c", "p", 1) for i, v, k in rows], SCHEMA)


def whole(v, scale):
    return [int(np.floor(scale * x)) for x in v]


def usable(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def lloyd(points, books, rounds):
    for t in range(rounds + 1):
        near = [min(range(len(books)), key=lambda j: (gap(p, books[j]), j)) for p in points]
        if t == rounds:
            return near, books
        new = []
        for j, old in enumerate(books):
            own = [p for p, c in zip(points, near, strict=True) if c == j]
            new.append([sum(x) // len(own) for x in zip(*own, strict=True)] if own else old)
        books = new


def plain_clusters(rows, k):
    good = [(i, whole(v, 256)) for i, v, _ in rows if usable(v) and len(v) == 64]
    named = [(hashlib.sha256(f"2:{i}".encode()).hexdigest(), p) for i, p in good if i is not None]
    books = [p for _, p in sorted(named)[:k]]
    if not books:
        return []
    near, books = lloyd([p for _, p in good], books, 5)
    far = [gap(p, books[c]) for (_, p), c in zip(good, near, strict=True)]
    text = [hashlib.sha256(",".join(map(str, b)).encode()).hexdigest() for b in books]
    return [
        (i, c, d, sum(e for e, x in zip(far, near, strict=True) if x == c), sum(far), text[c])
        for (i, _), c, d in zip(good, near, far, strict=True)
    ]


def plain_codes(rows, size, scale=1024):
    good = [(i, whole(v, scale), k) for i, v, k in rows if usable(v)]
    longest = max([len(p) for _, p, _ in good], default=0)
    width = max(1, -(-longest // 4))
    good = [(i, p + [0] * (4 * width - len(p)), k) for i, p, k in good]
    seeds = sorted((i, p) for i, p, _ in good if i is not None)[:size]
    if not seeds:
        return []
    found, books = [], []
    for n in range(4):
        cut = slice(n * width, (n + 1) * width)
        near, book = lloyd([p[cut] for _, p, _ in good], [p[cut] for _, p in seeds], 4)
        found.append([(c, gap(p[cut], book[c])) for (_, p, _), c in zip(good, near, strict=True)])
        books += [x for entry in book for x in entry]
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    codes_ = ["".join(f"{c:02x}" for c, _ in row) for row in zip(*found, strict=True)]
    errors = [sum(d for _, d in row) for row in zip(*found, strict=True)]
    return [
        (i, code, e, sum(x for x, (_, _, other) in zip(errors, good, strict=True) if other == k), digest)
        for (i, _, k), code, e in zip(good, codes_, errors, strict=True)
    ]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, x or 0) if not isinstance(x, str) else x for x in r])


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.2, (9, 64))
    out = [(i, (base[i % 9] + rng.normal(0, 0.1, 64)).tolist(), i % 3) for i in range(160)]
    # A hot group of equal vectors, ties on a coarse grid, repeated rows, and what is left out.
    out += [(500 + i, base[2].tolist(), None) for i in range(70)]
    out += [(700 + i, rng.integers(-1, 2, 64).astype(float).tolist(), 7) for i in range(20)]
    out += [out[3], out[3], (None, base[4].tolist(), None), (None, None, 1)]
    return out + [(900 + i, v, 1) for i, v in enumerate(BAD)]


@pytest.mark.parametrize("k", [1, 6, 40])
def test_clusters(spark, rows, k):
    got = clustered(table(spark, rows), centroids=k)
    assert in_order(got.collect()) == in_order(plain_clusters(rows, k))


def test_clusters_of_few_or_no_rows(spark):
    some = [(1, [0.5] * 64, 1), (2, [-0.3] * 64, 1), (3, [1.0] * 63, 1), (4, [1.0] * 65, 1)]
    for part in (some, some[:1], some[2:], [], [(None, [0.5] * 64, 1)]):
        assert in_order(clustered(table(spark, part)).collect()) == in_order(plain_clusters(part, 40))


def test_bounds_pass_over_centroids_and_stay_exact():
    """Far fewer evaluations than a full scan takes, and the same nearest centroids."""
    rng = np.random.default_rng(3)
    middles = rng.integers(-400, 400, (20, 16))
    x = np.concatenate([m + rng.integers(-40, 40, (100, 16)) for m in middles])
    history = x[rng.choice(len(x), 20, replace=False)][None]
    far = ((x[:, None] - history[0]) ** 2).sum(axis=2)
    cluster = far.argmin(axis=1)
    seen = np.nextafter(np.sqrt(far).astype(np.float32), np.float32(-1))
    since = np.zeros(far.shape, np.int8)
    taken = 0
    for _ in range(8):
        book = history[-1].copy()
        for j in range(20):
            if (cluster == j).any():
                book[j] = x[cluster == j].sum(axis=0) // (cluster == j).sum()
        history = np.concatenate((history, book[None]))
        cluster, distance, some = evaluate(x, history, cluster, seen, since)
        far = ((x[:, None] - book) ** 2).sum(axis=2)
        assert (cluster == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
        now = np.sqrt(far)
        moved = np.sqrt(((history[-1] - history) ** 2).sum(axis=2))[since, np.arange(20)]
        assert (seen - moved <= now + 1e-6).all()
        taken += some
    assert taken < 0.5 * 8 * far.size


@pytest.mark.parametrize("size", [1, 5, 256])
def test_codes(spark, rows, size):
    got = coded(table(spark, rows), entries=size)
    assert in_order(got.collect()) == in_order(plain_codes(rows, size))


def test_codes_of_other_lengths(spark):
    rng = np.random.default_rng(8)
    some = [(i, rng.normal(0, 1, n).tolist(), i % 2) for i, n in enumerate([7, 7, 6, 1, 0, 5, 7])]
    for part in (some, some[:1], [(4, [], 1)], [], [(None, [1.0], 1)], [(1, None, 1)]):
        assert in_order(coded(table(spark, part)).collect()) == in_order(plain_codes(part, 256))


def test_search_by_sums_finds_the_nearest_and_skips_entries():
    rng = np.random.default_rng(2)
    for spread in (3, 400):
        book = rng.integers(-spread, spread, (256, 16))
        book[100:140] += 10 * spread  # far sums
        book[200] = book[17]
        x = np.concatenate((rng.integers(-spread, spread, (700, 16)), book))
        far = ((x[:, None] - book) ** 2).sum(axis=2)
        for number in (np.int64, np.float64):
            entry, distance, taken = Codebook(book, number).nearest(x.astype(number))
            assert (entry == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
            assert taken < 0.95 * far.size


def test_heavy_and_light_labels(spark):
    data = [("a" if i % 3 else None, i) for i in range(300)] + [(f"x{i}", 1) for i in range(50)]
    df = spark.createDataFrame(data, "label string, error long")
    totals = {}
    for k, e in data:
        totals[k] = totals.get(k, 0) + e
    for heavy in (1, 5, 10**6):
        got = with_label_error(df, heavy).collect()
        assert len(got) == len(data) and all(r.label_error == totals[r.label] for r in got)


def test_components_beyond_exact_distances(spark):
    far = table(spark, [(1, [1e30] * 64, 1), (2, [0.0] * 64, 1)])
    for run in (clustered, coded):
        with pytest.raises(ValueError, match="too large"):
            run(far)
    with pytest.raises(ValueError, match="256"):
        coded(far, entries=257)


def test_blocks_of_many_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(codes, "STEP", 7)
    got = coded(table(spark, rows), entries=9).orderBy("vec_id")
    assert in_order(got.collect()) == in_order(plain_codes(rows, 9))
