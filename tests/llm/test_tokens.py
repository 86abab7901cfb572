"""Token counts and packing against direct encoding."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from convoy.llm.packing import CAPACITY, cuts, pack
from convoy.llm.token_counts import length_histogram, limit_table, quantiles, totals_within
from convoy.llm.tokens import Encoder, default_path, public_path

SCHEMA = "doc_id long, text string, k int, n long"
ODD = [
    "", " ", "a", "Word, WORD. word.. don't I'll ÉTÉ été é Ⅷ ½ 12345", "x" * 5000, "a\x1cb\x1f c",
    "tab\tnew\nline\x0b\x0c\r nbsp em sep　", "<|endoftext|> <|ENDOFTEXT|>x<|startoftext|>",
    "word.,!? #word. (word) a.b, 中文，测试。 ß ẞ İ ǅ ΑΣ ΣΑΣ 😀👍🏽 ‍﻿", "1,000.5; a1. 1a. ... ,",
    "Wort*** ÉTÉ*'_ İx! don't' l'été' '' a's 'S we'LL  x   \n\n  y \x85z \u3000 ", "\u0958 \u1e9b\u0323 ﬁ. e\u0301!! \ud7a3",
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(default_path())


def documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    return rows + [(1000 + i, t) for i, t in enumerate(ODD)] + [(5, None), (None, "x"), (7, "x"), (7, "x")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], SCHEMA)


def test_chunks_give_the_ids_of_whole_texts(spark, plain):
    texts = [t or "" for _, t in documents(spark)]
    tool = Encoder(default_path(), known=50)
    got = [np.frombuffer(ids, "<u4").tolist() for x in (texts, texts) for ids in tool.encode(x)]
    assert got == 2 * [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_give_the_ids_of_whole_texts(spark):
    path = public_path("byte_bpe_50k.json")
    texts = [t or "" for _, t in documents(spark)]
    tool, direct = Encoder(path, known=50), Tokenizer.from_file(path)
    assert tool.byte_level
    got = [np.frombuffer(ids, "<u4").tolist() for ids in tool.encode(texts)]
    assert got == [direct.encode(t, add_special_tokens=False).ids for t in texts]


def test_characters_of_all_kinds_give_the_ids_of_whole_texts():
    letters = [chr(c) for c in range(0x80, 0x30000, 37) if not 0xD800 <= c < 0xE000]
    texts = [f"{a}{b} 1{a} {b}.{a}  {b}" for a, b in zip(letters, letters[1:], strict=False)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tool, direct = Encoder(public_path(name)), Tokenizer.from_file(public_path(name))
        got = [np.frombuffer(ids, "<u4").tolist() for ids in tool.encode(texts)]
        assert got == [direct.encode(t, add_special_tokens=False).ids for t in texts]


def test_limits(spark, plain):
    rows = documents(spark)
    lengths = [len(plain.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    result = limit_table(length_histogram(table(spark, rows))).cache()
    got = {r.length: r for r in result.collect()}
    assert {k: r.n_docs for k, r in got.items()} == Counter(lengths)
    for limit, r in got.items():
        assert r.tokens_within == sum(min(x, limit) for x in lengths)
        assert r.docs_cut == sum(x > limit for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= limit)
        assert r.share_within == pytest.approx(sum(x <= limit for x in lengths) / len(lengths))
    for r in totals_within(result, [0, 17, 500, 10**6]).collect():
        assert r.tokens_within == sum(min(x, r.context_limit) for x in lengths)
        assert r.docs_cut == sum(x > r.context_limit for x in lengths)
    half = {r.share: r.length for r in quantiles(result, [0.5, 1.0]).collect()}
    assert half == {0.5: sorted(lengths)[(len(lengths) + 1) // 2 - 1], 1.0: max(lengths)}


def test_cuts():
    for n in range(1, 5000):
        pieces = cuts(n)
        assert sum(x for x, _ in pieces) == n
        assert all(CAPACITY // (k + 1) < x <= CAPACITY // k for x, k in pieces)


def test_packing(spark, plain):
    rows = documents(spark)
    pieces = pack(table(spark, rows), with_ids=True).collect()
    wanted = Counter()
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [1]
        wanted.update((i, j, x) for j, x in enumerate(ids))
    got = Counter()
    by_sequence = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(p.ids) == p.ids_crc32
        got.update((p.doc_id, p.start + j, int(x)) for j, x in enumerate(ids))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    assert got == wanted
    padding = 0
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= CAPACITY
        padding += CAPACITY - end
    assert padding < 0.05 * sum(wanted.values())


def test_empty_tables(spark):
    assert pack(table(spark, [])).collect() == []
    assert limit_table(length_histogram(table(spark, []))).collect() == []
