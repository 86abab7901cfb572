"""Links and classes of embeddings against the full similarity matrix."""

import numpy as np
import pytest

from convoy.llm import vectors
from convoy.llm.vectors import near_vectors

SCHEMA = "vec_id long, embedding array<float>, rep long, cell string"


def expected(rows, cosine=0.9):
    good = {}
    for i, v in rows:
        if v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {i: (0, i, True) for i, _ in rows}
    for dims in {len(v) for v in good.values()}:
        out.update(of_one_length({i: v for i, v in good.items() if len(v) == dims}, cosine))
    return out


def of_one_length(good, cosine):
    ids = sorted(good)
    x = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    label = np.arange(len(ids))
    while True:
        new = np.array([min([label[k], *label[near[k]]]) for k in range(len(ids))])
        if (new == label).all():
            break
        label = new
    return {
        i: (int(near[k].sum()), ids[label[k]], ids[label[k]] == i) for k, i in enumerate(ids)
    }


def check(spark, rows):
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = {r[0]: tuple(r[1:]) for r in near_vectors(table).collect()}
    assert got == expected(rows)
    return got


@pytest.mark.parametrize("block", [2048, 40])
def test_groups(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((120, 64)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    hot = base[7] + 0.2 * rng.standard_normal((150, 64)).astype(np.float32)
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(hot)]
    rows += [(2000 + i, base[9].tolist()) for i in range(90)]
    rows += [(3000 + i, (base[11] * (i + 1)).tolist()) for i in range(3)]
    rows += [
        (4000, None), (4001, [0.0] * 64), (4002, [float("nan")] + [1.0] * 63),
        (4003, [float("inf")] + [1.0] * 63), (4004, [None] + [1.0] * 63), (4005, []), (4006, [1.0]),
    ]
    got = check(spark, rows)
    assert max(n for n, _, _ in got.values()) > 80


@pytest.mark.parametrize("block", [2048, 30])
def test_lengths_of_their_own(spark, monkeypatch, block):
    """With small blocks the two commonest of five lengths have an index, the others one cell."""
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "INDEXES", 2)
    rng = np.random.default_rng(4)
    rows = []
    for dims, n in ((64, 80), (32, 70), (8, 60), (3, 9), (1, 5)):
        base = rng.standard_normal((n, dims))
        near = base[: n // 2] + 0.02 * rng.standard_normal((n // 2, dims))
        some = np.concatenate((base, near, base[:2])).astype(np.float32)
        rows += [(len(rows) + i, v.tolist()) for i, v in enumerate(some)]
    rows += [(9000, [1.0, 0.0]), (9001, [1.0, 0.0]), (9002, [0.0] * 7), (9003, [])]
    got = check(spark, rows)
    assert got[9001] == (1, 9000, False) and got[9003] == (0, 9003, True)


def test_test_data(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check(spark, [(r.vec_id, r.embedding) for r in table.collect()])


def test_empty_and_repeated(spark):
    assert check(spark, []) == {}
    assert check(spark, [(1, None), (2, [0.0] * 64)])
    v = [1.0] * 64
    table = spark.createDataFrame([(1, v, 1, ""), (1, v, 1, ""), (None, v, 1, "")], SCHEMA)
    assert [tuple(r) for r in near_vectors(table).collect()] == [(1, 0, 1, True)]


def test_recall_at_the_threshold(spark):
    """Pairs exactly at the threshold, the hardest case, are met nearly always."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = 0.9005 * x + np.sqrt(1 - 0.9005**2) * noise
    rows = [(i, v.tolist(), 1, "") for i, v in enumerate(np.concatenate((x, y)))]
    table = spark.createDataFrame(rows, SCHEMA)
    found = sum(r.n_links > 0 for r in near_vectors(table).collect())
    assert found >= 0.99 * len(rows)
