"""Removed bytes against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from convoy.llm import suffixes
from convoy.llm.suffixes import GRAM, Suffixes, removal_digest, segments, without_repeats

SCHEMA = "doc_id long, text string, h long, start string"


def expected(rows: list[tuple[int, str | None]], length: int) -> dict[int, tuple]:
    seen: set[bytes] = set()
    out = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[doc_id] = (len(raw), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return out


def got(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    result = removal_digest(without_repeats(docs, **options)).collect()
    return {r[0]: tuple(r[1:]) for r in result}


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(["the ", "of ", "é", "an", "ou", "re", ". ", "th"]) for _ in range(n))


@pytest.mark.parametrize("group", [4096, 7, 1])
def test_shared_passages(spark, monkeypatch, group):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rng = random.Random(5)
    passages = [prose(rng, n) for n in (40, 60, 90, 300)]
    rows = [(0, None), (1, ""), (2, "short"), (3, "ab" * 400), (4, "a" * 700)]
    for i in range(5, 60):
        parts = [prose(rng, rng.randint(0, 60)) for _ in range(4)]
        parts.insert(rng.randint(0, 4), rng.choice(passages))
        parts.insert(rng.randint(0, 4), rng.choice(passages))
        rows.append((i, "".join(parts)))
    rows += [(70 + i, rows[20][1]) for i in range(6)] + [(-3, passages[3][30:]), (90, "b" * 99)]
    assert got(spark, rows) == expected(rows, 100)


def test_group_of_many_shards(spark):
    """One anchor with more segments than are sorted together."""
    rng = random.Random(6)
    shared = prose(rng, 60)
    rows = [(i, f"{i:05d} {shared} {i % 50:02d}{'z' * (i % 7)}") for i in range(3 * suffixes.GROUP)]
    assert got(spark, rows) == expected(rows, 100)


def test_shards_keep_each_window_once():
    rng = random.Random(7)
    shared = prose(rng, 60).encode()[:140]
    texts = [b"%03d" % (i % 90) + shared + b"%03d" % rng.randint(0, 40) for i in range(400)]
    shards = [i // 100 for i in range(400)]
    table = pa.table(
        {
            "h": pa.array([5] * 400),
            "shard": pa.array(shards, pa.int32()),
            "doc_id": pa.array(range(400)),
            "start": pa.array([10] * 400),
            "anchor": pa.array([50] * 400, pa.int32()),
            "segment": pa.array(texts, pa.binary()),
        }
    )
    cut = lambda t: [t[i : i + 100] for i in range(len(t) - 99)]
    kept = []
    for out in suffixes._sorted_groups(100, sharded=True)(iter(table.to_batches())):
        for doc_id, start, run in zip(*(c.to_pylist() for c in out.columns), strict=True):
            assert texts[doc_id][start - 10 :].startswith(run)
            kept += [(shards[doc_id], w) for w in cut(run)]
    reach = lambda t: [t[i : i + 100] for i in range(min(len(t) - 99, 51))]
    wanted = {(s, w) for s, t in zip(shards, texts, strict=True) for w in reach(t)}
    assert len(kept) == len(set(kept)) and set(kept) == wanted


def test_test_data(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = removal_digest(without_repeats(docs)).collect()
    assert {r[0]: tuple(r[1:]) for r in result} == expected(rows, 100)


def test_empty_table_and_repeated_rows(spark):
    assert got(spark, []) == {}
    text = prose(random.Random(1), 200)
    docs = spark.createDataFrame([(1, text, 0, ""), (1, text, 0, ""), (None, text, 0, "")], SCHEMA)
    result = removal_digest(without_repeats(docs)).collect()
    assert [r.n_removed for r in result] == [0, 0]


def test_text_keeps_whole_characters(spark):
    rows = [(1, "é" * 80), (2, "x" + "é" * 80)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    left = {r.doc_id: r.kept for r in without_repeats(docs, as_text=True).collect()}
    assert left[2] == "x"


def test_sort_falls_back_on_collisions():
    rng = random.Random(3)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    ends = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = np.frombuffer(b"".join(texts), np.uint8)
    group = np.sort(np.array([rng.randint(0, 5) for _ in texts]))
    strings = Suffixes(data, ends[:-1], np.diff(ends))
    order, shared = strings.sort(group)
    plain, plain_shared = strings._plain(group)
    assert [texts[i] for i in order] == [texts[i] for i in plain]
    assert (shared == plain_shared).all()
    strings.prefix = np.zeros_like(strings.prefix)
    order, shared = strings.sort(group)
    assert (order == plain).all() and (shared == plain_shared).all()


def compressible(rng, n):
    lines = [f"row {rng.randint(0, 999)} of a table | {'=' * rng.randint(5, 60)} |\n" for _ in range(60)]
    return lambda size: "".join(rng.choice(lines) for _ in range(size // 40))[:size] + f"end {n}"


def test_segments_do_not_depend_on_the_texts_around():
    rng = random.Random(8)
    text = compressible(rng, 0)
    texts = [text(n).encode() for n in (500_000, 20, 520_000, 500_000, 0, 2_200_000, 90_000, 700_000)]

    def found(some):
        ends = np.concatenate(([0], np.cumsum([len(t) for t in some])))
        h, first, count, anchor = segments(np.frombuffer(b"".join(some), np.uint8), ends, 100, GRAM)
        owner = np.searchsorted(ends, first, side="right") - 1
        return list(zip(owner.tolist(), (first - ends[owner]).tolist(), count.tolist(), h.tolist(), strict=True))

    alone = [(k, *row[1:]) for k, t in enumerate(texts) for row in found([t])]
    assert len(alone) > 1000 and found(texts) == alone


def test_compressible_texts_over_partitionings(spark):
    rng = random.Random(9)
    text = compressible(rng, 1)
    rows = [(i, text(300_000)) for i in range(6)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)
    wanted = expected(rows, 100)
    for n in (1, 5):
        result = removal_digest(without_repeats(docs.repartition(n, "doc_id"))).collect()
        assert {r[0]: tuple(r[1:]) for r in result} == wanted


def test_slices_and_neighbours_are_bounded(monkeypatch):
    """Steps hold a part of a batch, and what neighbours share is compared in parts."""
    rng = random.Random(11)
    texts = [prose(rng, 4000) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(texts)], names=["doc_id", "text"])
    sizes = []
    whole = suffixes.segments

    def seen(data, *rest):
        sizes.append(len(data))
        return whole(data, *rest)

    monkeypatch.setattr(suffixes, "segments", seen)
    list(suffixes._anchors(100, GRAM)(iter([batch])))
    assert sum(sizes) == sum(len(t.encode()) for t in texts) and max(sizes) <= 1 << 18
    strings = sorted(rng.choice(["ab", "abc"]) * 30 + str(i) for i in range(500))
    data = np.frombuffer("".join(strings).encode(), np.uint8)
    size = np.array([len(x) for x in strings])
    start = np.cumsum(size) - size
    monkeypatch.setattr(suffixes, "VERIFIED", 64)
    some = Suffixes(data, start, size)
    order, shared = some.sort(np.zeros(500, np.int64))
    assert [strings[k] for k in order] == strings
    assert some._verified(order, shared, np.ones(499, bool))
    for k in (1, 250, 499):
        wrong = shared.copy()
        wrong[k] = min(size[order[k - 1]], size[order[k]])
        assert (wrong[k] == shared[k]) == some._verified(order, wrong, np.ones(499, bool))
