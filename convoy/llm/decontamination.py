"""Benchmark passages in documents: latent semantic retrieval, then alignment.

A text holds an item if the longest common subsequence of words of the item and a stretch
of the text covers enough of the item, or somewhat less of it while the item's closing
words, its answer, stand there too. Stretches have three times the item's words and begin
at every multiple of its words, so two item lengths of text lie within one of them whole.

Which stretches are aligned is found in a latent space. TF-IDF over the words of a block of
items is projected on the leading right singular directions of all passages of the corpus and
the items, by a randomised SVD: a Gaussian sketch, two power rounds and a small eigenproblem. Its
products go through the Gram matrix of the passages' words, which Spark sums in tiles over all
documents. There are about as many directions as items, and more
if an item keeps too little of itself in them. Items are grouped by length; for each length, windows
that hold four of it begin at every multiple, so each stretch lies within one whole. A
window's vector is a difference of running sums, and items whose cosine with it
in latent space reaches ``COSINE`` are aligned with the window's stretches.

Documents and items without words never match; rows without a doc_id are left out of the
pairs, and repeated rows give the same pairs once each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.hashing import MARKS, word_hashes
from convoy.llm.tables import flat, removed, slices, whole_row, written

_U = np.uint64

BUCKETS = 1 << 13
# Items, and bytes of their texts, that share a latent space, and spaces that one pass searches.
ITEMS = 256
ITEM_BYTES = 1 << 18
BLOCKS = 16
# Words of a passage; the directions are fitted on the passages of all documents.
PASSAGE = 48
# The Gram matrix of a space's words lies in strips of so many words by so many, products with it
# come from so many tasks, and a task that sums it holds so many bytes of its rows at a time.
STRIP = 8
TILE = 128
PARTS = 4
BAND_BYTES = 1 << 26
# The commonest words of a space, whose products are taken as dense columns.
COMMON = 256
# Partitions of texts that a task sums, while there are more tasks than cores.
SHARED = 4
# Passages that are added at once.
GATHERED = 1 << 13
# Directions beyond the number of items, products with the passages, and the share of every
# item's energy that the directions have to keep.
SPARE = 16
PRODUCTS = 3
KEPT = 0.95
# Share of every item's energy that the words which windows are weighed by have to hold.
WEIGHED = 0.9
# How much more all items weigh than all passages.
WEIGHT = 16
# Cosine in latent space from which an item is aligned with a window.
COSINE = 0.2
# Items of a group are at most so much longer than others, and a window holds so many of them.
LONGER = 1.25
WINDOW = 4
# Bytes of text whose running sums a task holds at once.
SEARCHED = 1 << 19
# Words between two edges of windows at most, and edges up to which sums are added at once.
BETWEEN = 32
SUMMED = 1 << 10
# Rows of running sums in a block.
ADDED = 32
# Words of stretches that a task holds at once.
HITS = 1 << 20
# Words of an item that have a bit each.
BITS = 64
ALIGNED = 0.6
ALIGNED_WITH_ANSWER = 0.5
ANSWER = 5
# Words of a stretch, in steps: the words of the item, or so many if it has fewer.
STRETCH = 3
SHORTEST = 4


def _buckets(words: np.ndarray) -> np.ndarray:
    return ((words >> _U(20)) % _U(BUCKETS)).astype(np.int64)


def _places(vocabulary: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``words`` are in the sorted ``vocabulary``, and where there."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Most words are sorted out by a few of their bits.
    bits = np.zeros(1 << 18, bool)
    bits[vocabulary >> _U(46)] = True
    own = np.flatnonzero(bits[words >> _U(46)])
    at = np.minimum(np.searchsorted(vocabulary, words[own]), len(vocabulary) - 1)
    same = vocabulary[at] == words[own]
    return own[same], at[same]


_HASHED = "passages long, counts binary, buckets binary, known binary, places binary"


def hashed(texts: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """The words of all texts, a slice of texts in a row.

    ``counts`` holds the words of each text, ``buckets`` that of every word, ``known`` a bit for
    each, set for words of ``vocabulary``, and ``places`` where those are in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, ends = word_hashes(*flat(part.column("text")), MARKS)
                counts = np.diff(ends)
                own, places = _places(vocabulary, words)
                known = np.zeros(len(words), bool)
                known[own] = True
                parts = (
                    counts.astype(np.int32),
                    _buckets(words).astype(np.uint16),
                    np.packbits(known),
                    places.astype(np.int32),
                )
                n = int((-(-counts // PASSAGE)).sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n]), *[pa.array([x.tobytes()], pa.binary()) for x in parts]],
                    names=["passages", "counts", "buckets", "known", "places"],
                )

    return texts.mapInArrow(run, _HASHED)


def _read_hashed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """The counts, buckets, known words' numbers and places of each row of ``hashed``."""
    columns = [batch.column(k) for k in ("counts", "buckets", "known", "places")]
    for row in zip(*columns, strict=True):
        kinds = (np.int32, np.uint16, np.uint8, np.int32)
        counts, buckets, known, places = (
            np.frombuffer(x.as_buffer(), kind) for x, kind in zip(row, kinds, strict=True)
        )
        known = np.flatnonzero(np.unpackbits(known, count=len(buckets)))
        yield counts.astype(np.int64), buckets.astype(np.int64), known, places


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n): documents of a partition that hold each bucket; -1 counts documents."""
    total, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for counts, buckets, _, _ in _read_hashed(batch):
            owner = np.repeat(np.arange(len(counts)), counts)
            held = np.zeros(len(counts) * BUCKETS, bool)
            held[owner * BUCKETS + buckets] = True
            total += held.reshape(-1, BUCKETS).sum(axis=0)
            docs += len(counts)
    key = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(key, -1)), pa.array(np.append(total[key], docs))], names=["key", "n"]
    )


def _passage_of(counts: np.ndarray, size: int) -> np.ndarray:
    """The passage, of ``size`` words of a text, that each word belongs to."""
    owner = np.repeat(np.arange(len(counts)), counts)
    per_text = -(-counts // size)
    passages, words = np.cumsum(per_text) - per_text, np.cumsum(counts) - counts
    return passages[owner] + (np.arange(len(owner)) - words[owner]) // size


class Passages:
    """Unit TF-IDF rows of passages, as far as their words are in a vocabulary."""

    def __init__(self, words, ends, vocabulary: np.ndarray, idf: np.ndarray, size: int | None):
        counts = np.diff(ends)
        row = _passage_of(counts, size) if size else np.repeat(np.arange(len(counts)), counts)
        self.n = int(row.max(initial=-1)) + 1
        place, self.at = _places(vocabulary, words)
        self.row = row[place]
        norm = np.sqrt(np.bincount(row, idf[_buckets(words)] ** 2, self.n))
        self.value = (idf[_buckets(words[place])] / np.maximum(norm[self.row], 1e-9)).astype(np.float32)

    def times(self, basis: np.ndarray) -> np.ndarray:
        """The rows times ``basis``."""
        out = np.zeros((self.n, basis.shape[1]), np.float32)
        _add_sorted(out, self.row, basis[self.at] * self.value[:, None])
        return out

    def gram_times(self, basis: np.ndarray) -> np.ndarray:
        """Their transpose times themselves times ``basis``."""
        product = self.times(basis)
        order = np.argsort(self.at, kind="stable")
        out = np.zeros(basis.shape, np.float32)
        _add_sorted(out, self.at[order], product[self.row[order]] * self.value[order, None])
        return out


def _lengths(steps: np.ndarray) -> list[int]:
    """The longest step of each group, from the longest of all downwards."""
    out, left = [], np.unique(steps)
    while len(left):
        out.append(int(left[-1]))
        left = left[left * LONGER <= left[-1]]
    return out


def _add_sorted(out: np.ndarray, row: np.ndarray, values: np.ndarray) -> None:
    """Add ``values`` to the rows of ``out`` that the ascending ``row`` names."""
    if len(row):
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        out[row[first]] += np.add.reduceat(values, first, axis=0)


def _add_pairs(total: np.ndarray, low: int, row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
    """Add the products of all pairs within a row whose smaller place is in the band of ``total``.

    Half of a square counts, as does a pair in one order only: the sum plus its transpose is whole.
    """
    flat_total, width = total.reshape(-1), total.shape[1]
    some = at >= low
    row, at, value = row[some], at[some] - low, value[some]
    for step in range(len(at)):
        pair = np.flatnonzero(row[step:] == row[: len(row) - step])
        if not len(pair):
            break
        one, other = at[pair], at[pair + step]
        first = np.minimum(one, other)
        key = first * width + np.maximum(one, other) + low
        products = value[pair] * value[pair + step] * (1.0 if step else 0.5)
        here = first < len(total)
        np.add.at(flat_total, key[here], products[here])


def _add_common(
    common: np.ndarray, beside: np.ndarray, n: int, row: np.ndarray, at: np.ndarray, value: np.ndarray
) -> None:
    """Add the products of the first words with each other, and with all words after them."""
    width = common.shape[1]
    first = at < width
    dense = np.zeros((n, width), np.float32)
    np.add.at(dense.reshape(-1), row[first] * width + at[first], value[first].astype(np.float32))
    common += 0.5 * (dense.T @ dense)
    row, at, value = row[~first], at[~first] - width, value[~first].astype(np.float32)
    order = np.argsort(at, kind="stable")
    row, at, value = row[order], at[order], value[order]
    edges = np.flatnonzero(np.diff(at, prepend=-1, append=-1)).tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        beside[at[a]] += value[a:b] @ dense[row[a:b]]


def _gathered(batches, place: np.ndarray, weight: np.ndarray, idf: np.ndarray) -> Iterator[tuple]:
    """(n, row, at, value) of about ``GATHERED`` passages at a time, over the words of a space."""
    held, n = [], 0
    square = (idf**2).astype(np.float64)
    for batch in batches:
        for counts, buckets, known, places in _read_hashed(batch):
            passage = _passage_of(counts, PASSAGE)
            more = int((-(-counts // PASSAGE)).sum())
            norm = np.sqrt(np.bincount(passage, square[buckets], more))
            at = place[places]
            own = np.flatnonzero(at >= 0)
            at, row = at[own], passage[known[own]]
            held.append((row + n, at, weight[at] / np.maximum(norm[row], 1e-9)))
            n += more
            if n >= GATHERED:
                yield n, *(np.concatenate(x) for x in zip(*held, strict=True))
                held, n = [], 0
    if n:
        yield n, *(np.concatenate(x) for x in zip(*held, strict=True))


def _strips(low: int, high: int, size: int, place: np.ndarray, weight: np.ndarray, idf: np.ndarray):
    """(strip, sums): strips of the rows ``low`` to ``high`` over the passages of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((high - low, size))
        width = min(COMMON, size)
        common, beside = np.zeros((width, width)), np.zeros((size - width, width))
        for n, row, at, value in _gathered(batches, place, weight, idf):
            if low < width:
                _add_common(common, beside, n, row, at, value)
            after = at >= width
            _add_pairs(total, low, row[after], at[after], value[after])
        if low < width:
            # Bands begin and end at tiles, so the common words may lie in several of them.
            total[: width - low, :width] += common[low:high]
            total[: width - low, width:] += beside.T[low:high]
        for i in range(0, high - low, STRIP):
            rows = total[i : i + STRIP].astype(np.float32)
            cut = [(j, rows[:, j : j + TILE]) for j in range((low + i) // TILE * TILE, size, TILE)]
            held = [(j // TILE, part) for j, part in cut if part.any()]
            number = (low + i) // STRIP * (size // TILE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number + j for j, _ in held], pa.int64()),
                    pa.array([part.tobytes() for _, part in held], pa.binary()),
                ],
                names=["strip", "sums"],
            )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all rows of a strip, which arrive one after the other."""
    last, total = -1, np.zeros(0)
    for batch in batches:
        strips, sums = [], []
        for strip, row in zip(batch.column("strip").to_pylist(), batch.column("sums"), strict=True):
            values = np.frombuffer(row.as_buffer(), np.float32)
            if strip == last:
                total += values
                continue
            if last >= 0:
                strips.append(last)
                sums.append(total.astype(np.float32).tobytes())
            last, total = strip, values.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(strips, pa.int64()), pa.array(sums, pa.binary())], names=["strip", "sums"]
        )
    if last >= 0:
        sums = pa.array([total.astype(np.float32).tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([last]), sums], names=["strip", "sums"])


@dataclass
class Gram:
    """The Gram matrix of all passages over the words of a space, as strips of a table.

    What lies in the strips plus its transpose is the matrix; ``n`` passages are summed. Words
    stand in the ``order`` of how common they are.
    """

    strips: DataFrame
    path: str
    n: int
    order: np.ndarray

    def times(self, basis: np.ndarray) -> np.ndarray:
        """The matrix times ``basis``; one product for each of ``PARTS`` tasks reaches the driver."""
        total = np.zeros(basis.shape, np.float64)
        run = _product(basis[self.order])
        for row in self.strips.mapInArrow(run, "part binary").toLocalIterator():
            total[self.order] += np.frombuffer(row["part"], np.float32).reshape(basis.shape)
        return total.astype(np.float32)


def gram_matrix(
    rows: DataFrame, known: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray
) -> Gram:
    """The Gram matrix over ``vocabulary`` of the texts whose ``hashed`` words are places in ``known``."""
    weight = idf[_buckets(vocabulary)].astype(np.float64)
    order = np.argsort(weight, kind="stable")
    place = np.full(len(known), -1)
    place[np.searchsorted(known, vocabulary[order])] = np.arange(len(vocabulary))
    size = -(-len(vocabulary) // TILE) * TILE
    step = max(BAND_BYTES // (8 * size) // TILE, 1) * TILE
    some = shared(rows)
    bands = [
        some.mapInArrow(
            _strips(low, min(low + step, size), size, place, weight[order], idf),
            "strip long, sums binary",
        )
        for low in range(0, size, step)
    ]
    parts = reduce(DataFrame.unionByName, bands).repartition("strip").sortWithinPartitions("strip")
    strips, path = written(parts.mapInArrow(_added, "strip long, sums binary"), "gram")
    n = rows.agg(F.sum("passages")).first()[0] or 0
    return Gram(strips.coalesce(PARTS), path, n, order)


def shared(rows: DataFrame) -> DataFrame:
    """``rows`` in fewer partitions: a task's strips are as many however many texts it sums."""
    parts = rows.rdd.getNumPartitions()
    least = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return rows.coalesce(max(ceil(parts / SHARED), min(least, parts), 1))


def _product(basis: np.ndarray):
    """The partition's part of the matrix times ``basis``, as one row of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        across = -(-len(basis) // TILE)
        padded = np.zeros((across * TILE, basis.shape[1]), np.float32)
        padded[: len(basis)] = basis
        total = np.zeros(padded.shape, np.float32)
        for batch in batches:
            for strip, row in zip(batch.column("strip").to_pylist(), batch.column("sums"), strict=True):
                sums = np.frombuffer(row.as_buffer(), np.float32).reshape(STRIP, TILE)
                i, j = divmod(strip, across)
                i, j = slice(i * STRIP, (i + 1) * STRIP), slice(j * TILE, (j + 1) * TILE)
                total[i] += sums @ padded[j]
                total[j] += sums.T @ padded[i]
        part = total[: len(basis)].tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], names=["part"])

    return run


def latent_directions(
    rows: DataFrame, known: np.ndarray, items: Passages, vocabulary: np.ndarray, idf: np.ndarray
) -> np.ndarray:
    """(words, directions): leading right singular vectors of the passages of all ``hashed``
    texts and the items.

    The items together weigh ``WEIGHT`` times as much as the passages. Directions are doubled
    until every item keeps ``KEPT`` of its energy.
    """
    rank = items.n + SPARE
    if rank >= len(vocabulary):
        return np.eye(len(vocabulary), dtype=np.float32)
    whole = np.bincount(items.row, items.value.astype(np.float64) ** 2, items.n)
    gram = gram_matrix(rows, known, vocabulary, idf)
    basis = np.eye(len(vocabulary), dtype=np.float32)
    while rank < len(vocabulary):
        found = _leading(gram, items, vocabulary, rank)
        kept = (items.times(found).astype(np.float64) ** 2).sum(axis=1)
        # Repeated words add up within a row, so its energy is that of the sums.
        if (kept >= KEPT * _energy(items, len(vocabulary), whole)).all():
            basis = found
            break
        rank *= 2
    removed(rows.sparkSession, gram.path)
    return basis


def _energy(items: Passages, words: int, least: np.ndarray) -> np.ndarray:
    """The squared norm of every item's row, repeated words summed first."""
    key, inverse = np.unique(items.row * words + items.at, return_inverse=True)
    summed = np.bincount(inverse, items.value)
    return np.maximum(np.bincount(key // words, summed**2, items.n), least)


def _subspace(texts, items: Passages, vocabulary, idf, rank: int) -> np.ndarray:
    """The leading directions over all passages of ``texts`` and the items."""
    gram = gram_matrix(hashed(texts, vocabulary), vocabulary, vocabulary, idf)
    return _leading(gram, items, vocabulary, rank)


def _leading(gram: Gram, items: Passages, vocabulary: np.ndarray, rank: int) -> np.ndarray:
    rng = np.random.default_rng(3)
    basis = rng.standard_normal((len(vocabulary), rank)).astype(np.float32)
    for step in range(PRODUCTS):
        basis = np.linalg.qr(basis)[0].astype(np.float32)
        total = gram.times(basis)
        total += WEIGHT * max(gram.n, 1) / max(items.n, 1) * items.gram_times(basis)
        if step < PRODUCTS - 1:
            basis = total
    small = basis.T @ total
    _, vectors = np.linalg.eigh((small + small.T) / 2)
    return (basis @ vectors).astype(np.float32)


@dataclass
class Searcher:
    """Items as words and, by length, as unit vectors of a latent space.

    ``weight`` holds the weight of each word of ``vocabulary``, ``latent`` its row of the
    directions times that.
    """

    ids: np.ndarray
    words: list[np.ndarray]
    vocabulary: np.ndarray
    weight: np.ndarray
    latent: np.ndarray

    def __post_init__(self):
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.step = np.maximum(sizes, SHORTEST)
        self.heavy = self._heavy()
        vectors = np.zeros((len(sizes), self.latent.shape[1]), np.float32)
        for k, words in enumerate(self.words):
            place = np.searchsorted(self.vocabulary, words)
            vectors[k] = self.latent[place[self.heavy[place]]].sum(axis=0)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        self.groups = []
        for longest in _lengths(self.step):
            own = np.flatnonzero((self.step <= longest) & (self.step * LONGER > longest))
            least = ceil(ALIGNED_WITH_ANSWER * sizes[own].min())
            self.groups.append((longest, own, vectors[own], least))

        self._index()

    def _heavy(self) -> np.ndarray:
        """The words that windows are weighed by: all but the commonest ones, as far as every
        item keeps ``WEIGHED`` of its energy without them."""
        places = [np.searchsorted(self.vocabulary, w) for w in self.words]
        energy = [self.weight[p].astype(np.float64) ** 2 for p in places]
        out = np.ones(len(self.vocabulary), bool)
        for cut in np.quantile(self.weight, np.linspace(0.002, 0.2, 40)):
            some = self.weight > cut
            if any(e[some[p]].sum() < WEIGHED * e.sum() for p, e in zip(places, energy, strict=True)):
                break
            out = some
        return out

    def _index(self) -> None:
        """Which of its own distinct words each word of the vocabulary is to an item."""
        distinct = [
            np.unique(np.searchsorted(self.vocabulary, w), return_counts=True) for w in self.words
        ]
        self.most = max(len(kinds) for kinds, _ in distinct)
        # One more column for words that are no item's.
        self.kinds = np.full((len(distinct), len(self.vocabulary) + 1), self.most, np.int32)
        self.times = np.zeros((len(distinct), self.most), np.int64)
        for k, (kinds, times) in enumerate(distinct):
            self.kinds[k, kinds] = np.arange(len(kinds))
            self.times[k, : len(kinds)] = times
        self.needed = ALIGNED_WITH_ANSWER * np.array([len(w) for w in self.words])
        # A bit for each word of a short item, repeated ones too, at its word of the vocabulary.
        self.short = np.array([len(w) <= BITS for w in self.words])
        self.bits = np.zeros((int(self.short.sum()), len(self.vocabulary) + 1), _U)
        for row, k in enumerate(np.flatnonzero(self.short)):
            kinds, times = distinct[k]
            first = np.cumsum(times) - times
            ones = (_U(1) << (times - 1).astype(_U)) * _U(2) - _U(1)
            self.bits[row, kinds] = ones << first.astype(_U)

    def matches(self, words: np.ndarray, ends: np.ndarray) -> list[tuple]:
        """(text, item, cosine, aligned, answer) of the best place of every item in every text."""
        # As many further words follow as a stretch may have, so each can be taken in full width.
        width = STRETCH * int(self.step.max(initial=0))
        named = np.full(len(words) + width, len(self.vocabulary), np.int32)
        here, which = _places(self.vocabulary, words)
        named[here] = which
        best: dict[tuple[int, int], tuple] = {}
        for item, begins, cosines in self._stretches(here, which, ends):
            likely = self._likely(item, named, begins)
            item, begins, cosines = item[likely], begins[likely], cosines[likely]
            texts = np.searchsorted(ends, begins, side="right") - 1
            stops = np.minimum(begins + STRETCH * self.step[item], ends[texts + 1])
            enough = self._enough(item, named, begins, stops)
            listed = [x[enough].tolist() for x in (item, texts, begins, stops, cosines)]
            for k, text, begin, stop, cosine in zip(*listed, strict=True):
                known = best.get((text, k), (0.0, False, 0.0))
                if known[:2] == (1.0, True):
                    continue
                found = (*aligned(self.words[k], words[begin:stop]), cosine)
                if found > known:
                    best[text, k] = found
        return [
            (text, k, cosine, share, answer)
            for (text, k), (share, answer, cosine) in sorted(best.items())
            if share >= ALIGNED or (share >= ALIGNED_WITH_ANSWER and answer)
        ]

    def _stretches(
        self, here: np.ndarray, which: np.ndarray, ends: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Items with the first words of stretches in windows near to them, and the cosines."""
        n_words = np.diff(ends)
        heavy = self.heavy[which]
        # Known and weighed words before each word.
        n_known, n_weighed = np.zeros((2, ends[-1] + 1), np.int64)
        n_known[here + 1], n_weighed[here[heavy] + 1] = 1, 1
        n_known, n_weighed = np.cumsum(n_known), np.cumsum(n_weighed)
        windows = []
        edge = np.zeros(n_weighed[-1] + 1, bool)
        for longest, _, _, least in self.groups:
            per_text = -(-n_words // longest)
            owner = np.repeat(np.arange(len(n_words)), per_text)
            before = np.cumsum(per_text) - per_text
            begin = (np.arange(len(owner)) - before[owner]) * longest
            stop = np.minimum(begin + WINDOW * longest, n_words[owner])
            begins, stops = ends[owner] + begin, ends[owner] + stop
            # A stretch that can be accepted has half of the item's words at least.
            full = np.flatnonzero(n_known[stops] - n_known[begins] >= least)
            low, high = n_weighed[begins[full]], n_weighed[stops[full]]
            edge[low] = edge[high] = True
            windows.append((owner[full], begin[full], low, high))
        # Further edges keep the words between two of them few.
        edge[::BETWEEN] = True
        sums = self._sums(which[heavy], np.flatnonzero(edge))
        # The row of the running sums at each edge.
        place = np.cumsum(edge) - 1
        for (longest, own, vectors, _), (owner, begin, low, high) in zip(
            self.groups, windows, strict=True
        ):
            low, high = place[low], place[high]
            found = []
            for at in range(0, len(owner), 4096):
                some = slice(at, at + 4096)
                vector = sums[high[some]] - sums[low[some]]
                norm = np.maximum(np.sqrt(np.einsum("ij,ij->i", vector, vector)), 1e-6)
                cosine = (vector @ vectors.T) / norm[:, None]
                w, k = np.nonzero(cosine >= COSINE)
                found.append((at + w, own[k], np.minimum(cosine[w, k], 1.0)))
            if not found:
                continue
            window, item, cosine = (np.concatenate(x) for x in zip(*found, strict=True))
            step = self.step[item]
            start = -(-begin[window] // step) * step
            limit = np.minimum(begin[window] + longest, n_words[owner[window]])
            while len(start):
                inside = start < limit
                start, limit, step = start[inside], limit[inside], step[inside]
                window, item, cosine = window[inside], item[inside], cosine[inside]
                yield item, ends[owner[window]] + start, cosine
                start = start + step

    def _sums(self, words: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Running sums of the words' vectors from the first of ``edges`` to each."""
        blocks = max(ceil(len(edges) / ADDED), 1)
        out = np.zeros((blocks * ADDED, self.latent.shape[1]), np.float32)
        for at in range(0, len(edges) - 1, SUMMED):
            some = edges[at : at + SUMMED + 1]
            first, sizes = some[:-1], np.diff(some)
            # The longest first, so that those with a next word are the first ones.
            order = np.argsort(-sizes, kind="stable")
            first, sizes = first[order], sizes[order]
            total = self.latent[words[first]]
            for step in range(1, int(sizes[0])):
                more = int(np.searchsorted(-sizes, -step))
                total[:more] += self.latent[words[first[:more] + step]]
            out[at + 1 + order] = total
        # Within all blocks of rows at once, and then from block to block.
        parts = out.reshape(blocks, ADDED, -1)
        for row in range(1, ADDED):
            parts[:, row] += parts[:, row - 1]
        before = np.cumsum(parts[:-1, -1], axis=0, dtype=np.float64)
        parts[1:] += before.astype(np.float32)[:, None]
        return out

    def _likely(self, item: np.ndarray, named: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Which stretches, in ascending order of items, may hold enough words of their item.

        Every word of an item counts once one like it stands in the stretch, or somewhat after it.
        """
        order = np.argsort(item, kind="stable")
        out = ~self.short[item]
        short = order[~out[order]]
        base = (np.cumsum(self.short) - 1) * self.bits.shape[1]
        width = STRETCH * int(self.step[item[short]].max(initial=1))
        stretches = np.lib.stride_tricks.sliding_window_view(named, width)
        rows = max(HITS // 8 // width, 1)
        for at in range(0, len(short), rows):
            some = short[at : at + rows]
            words = stretches[begins[some]] + base[item[some], None]
            held = np.bitwise_or.reduce(self.bits.ravel().take(words), axis=1)
            out[some] = np.bitwise_count(held) >= self.needed[item[some]]
        return order[out[order]]

    def _enough(
        self, item: np.ndarray, named: np.ndarray, begins: np.ndarray, stops: np.ndarray
    ) -> np.ndarray:
        """Which stretches hold enough words of their item, in any order."""
        out = np.zeros(len(item), bool)
        if not len(item):
            return out
        width = STRETCH * int(self.step[item].max())
        rows = max(HITS // width, 1)
        for at in range(0, len(item), rows):
            some = slice(at, at + rows)
            where = begins[some, None] + np.arange(width)
            kind = self.kinds[item[some, None], named[np.minimum(where, len(named) - 1)]]
            kind[where >= stops[some, None]] = self.most
            kind += (np.arange(len(kind)) * (self.most + 1))[:, None]
            held = np.bincount(kind.ravel(), minlength=len(kind) * (self.most + 1))
            held = held.reshape(len(kind), -1)[:, :-1]
            out[some] = np.minimum(held, self.times[item[some]]).sum(axis=1) >= self.needed[item[some]]
        return out


def aligned(item: np.ndarray, region: np.ndarray) -> tuple[float, bool]:
    """The share of the item's words in its longest common subsequence with ``region``,
    and whether the item's last words stand there one after the other.

    The subsequence is counted with one row of bits per word of the region.
    """
    where: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        where[word] = where.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    listed = region.tolist()
    for word in listed:
        here = where.get(word)
        if here:
            hit = row & here
            row = ((row + hit) | (row - hit)) & full
    share = (len(item) - row.bit_count()) / len(item)
    tail = item[-ANSWER:].tolist()
    answer = any(
        listed[k : k + len(tail)] == tail for k in range(len(listed) - len(tail) + 1)
    )
    return share, answer


def _matched(parts: list[Searcher], part: pa.RecordBatch) -> list[tuple]:
    """(text, item's id, cosine, aligned, answer) over all latent spaces."""
    words, ends = word_hashes(*flat(part.column("text")), MARKS)
    if not len(words):
        return []
    return [
        (row[0], int(one.ids[row[1]]), *row[2:]) for one in parts for row in one.matches(words, ends)
    ]


def _found(searched):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SEARCHED):
                rows = _matched(searched.value, part)
                ids = part.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[r[0]] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([float(r[2]) for r in rows], pa.float64()),
                        pa.array([r[3] for r in rows], pa.float64()),
                        pa.array([r[4] for r in rows], pa.bool_()),
                    ],
                    names=["doc_id", "item_id", "cosine", "aligned", "answer"],
                )

    return run


def _clean(searched, text: int):
    """The rows, structs with a text in place ``text``, that hold no item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The texts are looked at in their rows, so that they arrive and leave once.
            texts = batch.column("row").field(text)
            for part in slices(batch.append_column("text", texts), "text", SEARCHED):
                keep = np.ones(part.num_rows, bool)
                keep[[r[0] for r in _matched(searched.value, part)]] = False
                yield part.select(["row"]).filter(pa.array(keep))

    return run


def searchers(docs: DataFrame, benchmark: DataFrame) -> list[Searcher]:
    """One searcher for each block of items, of about ``ITEMS`` or ``ITEM_BYTES`` at most."""
    texts = docs.select("text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(ceil(size[0] / ITEMS), ceil((size[1] or 0) / ITEM_BYTES))
    if not blocks:
        return []
    blocked = []
    for block in range(blocks):
        some = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        table = some.orderBy("item_id").toArrow()
        words, ends = word_hashes(*flat(table.column("text")), MARKS)
        if len(words):
            blocked.append((table.column("item_id").to_numpy(), words, ends, np.unique(words)))
    if not blocked:
        return []
    # The words of all documents are hashed once, for the words of all spaces.
    known = np.unique(np.concatenate([vocabulary for *_, vocabulary in blocked]))
    rows, path = written(hashed(texts, known), "words")
    sums = rows.mapInArrow(_frequencies, "key long, n long")
    counts = {r[0]: r[1] for r in sums.groupBy("key").sum("n").collect()}
    held = np.array([counts.get(b, 0) for b in range(BUCKETS)])
    idf = np.log((1 + counts.get(-1, 0)) / (1 + held)).astype(np.float32) + np.float32(0.01)
    out = []
    for numbers, words, ends, vocabulary in blocked:
        own = Passages(words, ends, vocabulary, idf, None)
        latent = latent_directions(rows, known, own, vocabulary, idf)
        weight = idf[_buckets(vocabulary)]
        each = [words[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        filled = [k for k, w in enumerate(each) if len(w)]
        own = [each[k] for k in filled]
        out.append(Searcher(numbers[filled], own, vocabulary, weight, latent * weight[:, None]))
    removed(docs.sparkSession, path)
    return out


def _passes(docs: DataFrame, benchmark: DataFrame) -> list:
    """The searchers, as many as one pass over the documents takes, sent to each executor once."""
    found = searchers(docs, benchmark)
    context = docs.sparkSession.sparkContext
    return [context.broadcast(found[at : at + BLOCKS]) for at in range(0, len(found), BLOCKS)]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, aligned, answer) of every document that holds an item."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.filter(F.col("doc_id").isNotNull())
    schema = "doc_id long, item_id long, cosine double, aligned double, answer boolean"
    out = docs.sparkSession.createDataFrame([], schema)
    for searched in _passes(docs, benchmark):
        out = out.unionByName(texts.mapInArrow(_found(searched), schema))
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item, with all of their columns."""
    rows = docs.select(whole_row(docs))
    text = [c.lower() for c in docs.columns].index("text")
    for searched in _passes(docs, benchmark):
        rows = rows.mapInArrow(_clean(searched, text), rows.schema)
    return rows.select("row.*")
