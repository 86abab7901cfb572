"""Planted benchmark passages are found, and clean documents left alone."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from convoy.llm import decontamination
from convoy.llm.decontamination import Passages, aligned, contaminated, without_benchmark
from convoy.llm.hashing import MARKS, word_hashes
from convoy.llm.tables import flat

DATA = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, item_id long, cosine string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())


def holds(text, item):
    a, b = " ".join(words(text)), " ".join(words(item))
    return bool(b) and f" {b} " in f" {a} "


def test_verbatim_items(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    wanted = {
        (d, r.item_id) for r in items.collect() for d, t in texts.items() if holds(t, r.text)
    }
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert wanted and got == wanted
    left = without_benchmark(docs, items)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(texts) - {d for d, _ in wanted}


def test_paraphrases(spark):
    rng = random.Random(4)
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [r.text for r in docs.orderBy("doc_id").limit(200).collect()]
    rows, wanted = [], set()
    chosen = items.orderBy("item_id").collect()
    for i, text in enumerate(texts):
        rows.append((i, text, 0, ""))
    for k, item in enumerate(chosen):
        own = item.text.split()
        for j in rng.sample(range(len(own)), len(own) // 6):
            own[j] = "changed" + str(j)
        around = texts[k].split()
        at = rng.randint(0, len(around))
        rows.append((1000 + k, " ".join([*around[:at], *own, *around[at:]]), 0, ""))
        wanted.add((1000 + k, item.item_id))
    table = spark.createDataFrame(rows, DOCS)
    got = {(r.doc_id, r.item_id) for r in contaminated(table, items).collect()}
    assert len(wanted & got) >= 0.95 * len(wanted)


def test_odd_rows(spark):
    rows = [(1, None, 1, ""), (2, "", 1, ""), (None, "one two three four five six", 1, ""),
            (3, "x " * 100_000 + "one two three four five six", 1, ""), (4, "!", 1, "")]
    docs = spark.createDataFrame(rows, DOCS)
    items = spark.createDataFrame(
        [(1, "One two, three four five SIX"), (2, None), (3, ""), (None, "x"), (1, "One two, three four five SIX")],
        "item_id long, text string",
    )
    got = contaminated(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(3, 1)}
    assert contaminated(docs, items.limit(0)).collect() == []
    assert contaminated(docs.limit(0), items).collect() == []
    assert without_benchmark(docs, items.limit(0)).count() == len(rows)


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 90)), rng.integers(0, 6, rng.integers(0, 60))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = (
                    table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
                )
        assert round(aligned(a, b)[0] * len(a)) == table[-1, -1]


def accepted(item, text):
    """Whether one of the stretches of ``text`` passes the rule, by aligning all of them."""
    step = max(len(item), 4)
    for at in range(0, len(text), step):
        share, answer = aligned(item, text[at : at + 3 * step])
        if share >= 0.6 or (share >= 0.5 and answer):
            return True
    return False


def hashed(texts):
    kinds = {}
    return [np.array([kinds.setdefault(w, len(kinds)) for w in words(t)], np.int64) for t in texts]


@pytest.mark.parametrize("inserted", [0, 2])
def test_paraphrases_that_the_rule_accepts(spark, inserted):
    """Items of 200 planted in longer texts with 50 to 70 % of their words, against all stretches.

    ``inserted`` further words stand between every three of an item.
    """
    rng = random.Random(5 + inserted)
    folder = "/root/testdata/sf0.1"
    items = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").limit(400)
    around = [r.text.split() for r in docs.collect() if 150 < len(r.text.split()) < 300]
    rows = []
    for k, item in enumerate(items):
        own, text = item.text.split(), around[k % len(around)]
        for j in rng.sample(range(len(own)), round(len(own) * rng.uniform(0.3, 0.5))):
            own[j] = "changed" + str(j) if rng.random() < 0.5 else rng.choice(text)
        for j in range(len(own) - 3, 0, -3):
            own[j:j] = rng.sample(text, inserted)
        at = rng.randint(0, len(text))
        rows.append((k, " ".join([*text[:at], *own, *text[at:]]), 0, ""))
    table = spark.createDataFrame(rows, DOCS)
    benchmark = spark.createDataFrame([(r.item_id, r.text) for r in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(table, benchmark).collect()}
    split = hashed([r[1] for r in rows] + [r.text for r in items])
    texts, own = split[: len(rows)], split[len(rows) :]
    wanted = {(k, r.item_id) for k, r in enumerate(items) if accepted(own[k], texts[k])}
    assert len(wanted) > 60 and len(wanted & got) >= 0.98 * len(wanted)
    some = range(0, len(rows), 20)
    both = {(k, r.item_id) for k in some for j, r in enumerate(items) if accepted(own[j], texts[k])}
    assert both >= {pair for pair in got if pair[0] in some}


def test_items_of_several_latent_spaces(spark):
    rng = random.Random(6)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").orderBy("doc_id").limit(600)
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    longer = [d for d in texts if len(texts[d]) > 80]
    rows, wanted = [], set()
    for k in range(700):
        text, n = texts[doc := rng.choice(longer)], rng.randint(8, 60)
        at = rng.randint(0, len(text) - n)
        own = " ".join(text[at : at + n])
        if words(own):
            rows.append((k, own))
            wanted.add((doc, k))
    items = spark.createDataFrame(rows, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()}
    assert len(wanted) > 650 and wanted <= got


def test_blocks_are_bounded_by_the_bytes_of_their_items(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 4000)
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    several = decontamination.searchers(docs.limit(20), items)
    size = sum(len(r.text.encode()) for r in items.collect())
    assert len(several) == -(-size // 4000) > 1
    assert sum(len(s.ids) for s in several) == items.count()
    for one in several:
        # Every item keeps nearly all of itself in its space.
        latent = one.latent / one.weight[:, None]
        for own in one.words:
            row = np.zeros(len(one.vocabulary))
            np.add.at(row, np.searchsorted(one.vocabulary, own), 1)
            row *= one.weight
            assert ((row @ latent) ** 2).sum() >= 0.94 * (row**2).sum()


def test_directions_are_those_of_a_full_decomposition(spark):
    """The subspace of the randomised products against a singular value decomposition."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    table = pa.array([r.text for r in items.collect()])
    found, ends = word_hashes(*flat(table), MARKS)
    vocabulary, idf = np.unique(found), np.ones(decontamination.BUCKETS, np.float32)
    own = Passages(found, ends, vocabulary, idf, None)
    basis = decontamination._subspace(docs.select("text").coalesce(1), own, vocabulary, idf, 120)
    text, cuts = word_hashes(*flat(pa.array([r.text for r in docs.collect()])), MARKS)
    rows = Passages(text, cuts, vocabulary, idf, decontamination.PASSAGE)
    dense = np.eye(len(vocabulary), dtype=np.float32)
    weight = decontamination.WEIGHT * rows.n / own.n
    gram = rows.gram_times(dense) + weight * own.gram_times(dense)
    best = np.sort(np.linalg.eigvalsh(gram.astype(np.float64)))[::-1][:120].sum()
    assert np.trace(basis.T @ gram @ basis) >= 0.97 * best
    assert np.allclose(basis.T @ basis, np.eye(120), atol=1e-3)


def test_directions_are_fitted_on_the_passages_of_all_documents(spark, monkeypatch):
    """The Gram matrix that is summed in tiles, bands and tasks, against one over all rows."""
    rng = random.Random(8)
    kinds = [f"word{k}" for k in range(500)]
    texts = [" ".join(rng.choices(kinds, k=rng.randint(0, 120))) for _ in range(2500)] + [None, "", "!"]
    own = pa.array([" ".join(rng.sample(kinds, 150)) for _ in range(3)])
    found, ends = word_hashes(*flat(own), MARKS)
    vocabulary = np.unique(found)
    idf = np.linspace(1, 3, decontamination.BUCKETS).astype(np.float32)
    monkeypatch.setattr(decontamination, "BAND_BYTES", 1 << 17)
    docs = spark.createDataFrame([(t,) for t in texts * 2], "text string").repartition(5)
    known = np.unique(word_hashes(*flat(pa.array([" ".join(kinds)])), MARKS)[0])
    monkeypatch.setattr(decontamination, "COMMON", 40)
    gram = decontamination.gram_matrix(decontamination.hashed(docs, known), known, vocabulary, idf)
    rows = Passages(*word_hashes(*flat(pa.array(texts * 2)), MARKS), vocabulary, idf, decontamination.PASSAGE)
    assert gram.n == rows.n > 5000
    assert len(vocabulary) > 2 * decontamination.TILE
    dense = np.eye(len(vocabulary), dtype=np.float32)
    assert np.allclose(gram.times(dense), rows.gram_times(dense), rtol=1e-3, atol=1e-3)


def test_directions_of_a_benchmark_see_every_document(spark, monkeypatch):
    """More documents than any sample would hold: all of their passages are counted."""
    counted = []
    monkeypatch.setattr(
        decontamination, "_leading",
        lambda gram, items, vocabulary, rank: counted.append(gram.n) or np.eye(len(vocabulary), dtype=np.float32),
    )
    docs = spark.range(5000).selectExpr("id as doc_id", "concat('some words of text ', id) as text")
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert len(decontamination.searchers(docs, items)) == 1
    assert counted == [5000]


def searcher(items, kinds):
    """A searcher of ``items``, lists of words below ``kinds``."""
    rng = np.random.default_rng(6)
    latent = rng.standard_normal((kinds, 9)).astype(np.float32)
    own = [np.array(item, np.uint64) for item in items]
    vocabulary = np.arange(kinds, dtype=np.uint64)
    return decontamination.Searcher(np.arange(len(own)), own, vocabulary, np.ones(kinds), latent)


def test_few_stretches_are_counted_word_by_word_and_none_is_lost():
    rng = np.random.default_rng(7)
    items = [rng.integers(0, 3000, n) for n in (1, 5, 20, 30, 40, 63, 64, 65, 100)]
    items.append([3] * 64)
    one = searcher(items, 3000)
    named = rng.integers(0, 3001, 4000).astype(np.int32)
    for k, item in enumerate(items):
        # Half of the item's words, in any order.
        at, some = 5 + 390 * k, rng.permutation(item)[: -(-len(item) // 2)]
        named[at : at + len(some)] = some
    named[-400:] = 3000
    begins = np.tile(np.arange(0, 3600, 5), len(items))
    item = np.repeat(np.arange(len(items)), 720)
    stops = np.minimum(begins + 3 * one.step[item], 3600)
    enough = set(np.flatnonzero(one._enough(item, named, begins, stops)).tolist())
    likely = one._likely(item, named, begins).tolist()
    assert enough >= {k * 720 + 1 + 78 * k for k in range(len(items))} and enough <= set(likely)
    short = [k for k in likely if 4 < one.step[item[k]] <= 64]
    assert len(short) < 0.2 * (item < 7).sum()


def test_running_sums_at_edges_are_those_of_all_words():
    rng = np.random.default_rng(8)
    one = searcher([[1, 2, 3, 4, 5]], 50)
    words = rng.integers(0, 50, 20_000)
    whole = np.concatenate([np.zeros((1, 9)), np.cumsum(one.latent[words].astype(float), axis=0)])
    for edges in ([0], [0, 32], [7, 9, 10, 500], np.unique(rng.integers(0, 20_001, 5000))):
        sums = one._sums(words, np.array(edges))[: len(edges)]
        assert np.allclose(sums, whole[edges] - whole[edges[0]], atol=1e-2)


def test_partitions_share_the_strips_of_a_gram_matrix(spark):
    folder = "/root/testdata/sf0.01"
    items = spark.read.parquet(f"{folder}/benchmark.parquet").toArrow()
    vocabulary = np.unique(word_hashes(*flat(items.column("text")), MARKS)[0])
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("text").repartition(200)
    rows = decontamination.hashed(texts, vocabulary)
    idf = np.ones(decontamination.BUCKETS, np.float32)
    gram = decontamination.gram_matrix(rows, vocabulary, vocabulary, idf)
    whole = decontamination.gram_matrix(rows.coalesce(1), vocabulary, vocabulary, idf)
    basis = np.random.default_rng(9).standard_normal((len(vocabulary), 3)).astype(np.float32)
    assert gram.n == whole.n
    expected = whole.times(basis)
    assert np.abs(gram.times(basis) - expected).max() <= 1e-4 * np.abs(expected).max()
    assert decontamination.shared(rows).rdd.getNumPartitions() <= 50


def test_texts_move_once_with_their_rows(spark):
    """``without_benchmark`` sends a row's text to Python in the row alone."""
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "g h"), (3, None)], "doc_id long, Text string")
    items = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    left = without_benchmark(docs, items)
    assert sorted(left.collect()) == [(2, "g h"), (3, None)] and left.columns == ["doc_id", "Text"]
    plan = left._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "[text" not in plan.lower()
