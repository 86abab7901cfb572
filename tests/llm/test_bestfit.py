"""Best-fit packing: pieces against direct encoding, bins against bounds and optima."""

import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from convoy.llm.bestfit import best_fit, best_fit_packed, certificate, cuts, least_bins
from convoy.llm.tokens import public_path

SCHEMA = "doc_id long, text string, `bin` int, length string, `a.b` int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)


def test_cuts():
    for n in range(1, 9000, 7):
        pieces = cuts(n)
        assert sum(pieces) == n and all(x == 2048 for x in pieces[1:])
        assert 0 < pieces[0] <= 2048 and (n > 2048 or len(pieces) == 1)


def plain_best_fit(lengths, capacity):
    rooms, bins = [], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fitting = [(r, b) for b, r in enumerate(rooms) if r >= lengths[i]]
        if not fitting:
            rooms.append(capacity)
            fitting = [(capacity, len(rooms) - 1)]
        bins[i] = min(fitting)[1]
        rooms[bins[i]] -= lengths[i]
    return len(rooms)


def optimum(lengths, capacity):
    """The fewest bins, by trying every way to deal the pieces."""
    for count in range(len(lengths) + 1):
        for dealt in product(range(count), repeat=len(lengths)):
            used = Counter()
            for b, x in zip(dealt, lengths, strict=True):
                used[b] += x
            if all(u <= capacity for u in used.values()):
                return count


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=60))
def test_bins_of_best_fit(lengths):
    bins, offsets = best_fit(np.array(lengths, np.int64), 60)
    placed = defaultdict(list)
    for b, o, x in zip(bins, offsets, lengths, strict=True):
        placed[b].append((o, x))
    for places in placed.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 60
    assert len(placed) == plain_best_fit(lengths, 60)
    assert least_bins(np.bincount(lengths, minlength=61), 60) <= len(placed)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=6))
def test_bounds_are_never_above_the_optimum(lengths):
    least = least_bins(np.bincount(lengths, minlength=25), 24)
    best = optimum(lengths, 24)
    assert -(-sum(lengths) // 24) <= least <= best


def test_bounds_see_more_than_the_sum():
    # Eleven pieces of over a half, and pieces of over a third two to a bin.
    assert least_bins(np.bincount([1030] * 11, minlength=2049)) == 11
    assert least_bins(np.bincount([700] * 10, minlength=2049)) == 5
    assert least_bins(np.bincount([1400] * 6 + [700] * 5, minlength=2049)) == 9


def check(spark, rows, **options):
    plain = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    packed = best_fit_packed(table(spark, rows), with_ids=True, **options)
    wanted, pieces = Counter(), Counter()
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        wanted.update((i, j, x) for j, x in enumerate(ids))
        start = 0
        for piece, length in enumerate(cuts(len(ids))):
            pieces[i, piece, start, length] += 1
            start += length
    got, by_sequence = Counter(), defaultdict(list)
    found = packed.collect()
    for p in found:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(p.ids) == p.ids_crc32
        got.update((p.doc_id, p.start + j, int(x)) for j, x in enumerate(ids))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    assert got == wanted
    assert Counter((p.doc_id, p.piece, p.start, p.length) for p in found) == pieces
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    return len(by_sequence), certificate(packed)


def test_packing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    rows += [(None, None), (None, ""), (7, "x y"), (7, "x y"), (8, "word " * 20000)]
    rows += [(9000 + i, "same text") for i in range(150)]
    bins, (counted, least) = check(spark, rows)
    assert least <= bins == counted <= least + 1
    # Several partitions, which exchange what is left open.
    spread, (counted, least) = check(spark, rows, shard=40)
    alone, _ = check(spark, rows, shard=40, rounds=0)
    assert least <= spread == counted <= alone
    assert spread <= least + 0.01 * least + 1


def test_empty_tables(spark):
    assert best_fit_packed(table(spark, [])).collect() == []
    assert certificate(best_fit_packed(table(spark, []))) == (0, 0)
    assert check(spark, [(1, None), (2, "")]) == (1, (1, 1))
