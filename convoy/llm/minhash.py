"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

Rows without a doc_id are left out. Null and empty texts, and texts of white
space only, have no shingles and are linked with nothing. A repeated row gets
the same answer again. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convoy.llm.graph import components
from convoy.llm.hashing import mix, shingle_sets
from convoy.llm.tables import flat, landed, lists, slices

_U = np.uint64
_EMPTY = np.iinfo(_U).max

# 24 bands of 6 coordinates miss a pair at similarity 0.85 with probability 1.2e-5.
BANDS, ROWS = 24, 6
# Of 128 one-bit coordinates a pair at 0.85 differs in 9.6 +- 3; one in 32 is never that similar.
BITS, MAX_DIFFERENT = 128, 32
PIVOT_ROUNDS = 2


def fast_sketch(elements: np.ndarray, owner: np.ndarray, n_sets: int, size: int) -> np.ndarray:
    """Fast similarity sketches, (n_sets, size), of sets given as elements with their owner.

    In each of the first ``size`` rounds every element of a set falls into one
    random bin; in round ``size`` + j all of them fall into bin j. A bin keeps its
    smallest (round, value), so every bin fills, and a set stops as soon as
    all of its bins are filled. An empty set keeps the largest value everywhere.
    """
    sketch = np.full((n_sets, size), _EMPTY, _U)
    open_sets = np.zeros(n_sets, bool)
    open_sets[owner] = True
    for step in range(2 * size):
        drawn = mix(elements + _U((step + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1))
        if step < size:
            bins = ((drawn >> _U(40)) % _U(size)).astype(np.int64)
        else:
            bins = np.full(len(drawn), step - size)
        values = (drawn & _U((1 << 40) - 1)) | _U(step << 40)
        np.minimum.at(sketch.reshape(-1), owner * size + bins, values)
        open_sets[open_sets] = (sketch[open_sets] == _EMPTY).any(axis=1)
        keep = open_sets[owner]
        elements, owner = elements[keep], owner[keep]
        if not len(owner):
            break
    return sketch


def _sketches(bands: int, rows: int, shingle: int):
    size = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*flat(part.column("text")), shingle)
                counts = np.array([len(s) for s in sets])
                elements = np.concatenate(sets)
                owner = np.repeat(np.arange(len(sets)), counts)
                sketch = fast_sketch(elements, owner, len(sets), size)
                # One sum per set and scrambling: equal sets have equal keys in any order.
                keys = []
                for salt in (0x51, 0xA7):
                    total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(elements ^ _U(salt)))))
                    ends = np.concatenate(([0], np.cumsum(counts)))
                    keys.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
                coordinates = mix(sketch).reshape(len(sets), bands, rows)
                folded = np.zeros((len(sets), bands), _U)
                for r in range(rows):
                    folded = mix(folded + coordinates[:, :, r])
                folded = mix(folded + np.arange(bands, dtype=_U)).view(np.int64)
                one = (mix(sketch[:, :BITS]) & _U(1)).astype(np.uint8)
                bits = np.packbits(np.pad(one, ((0, 0), (0, BITS - one.shape[1]))), axis=1)
                bits = np.ascontiguousarray(bits).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(counts.astype(np.int64)),
                        pa.array(keys[0]),
                        pa.array(keys[1]),
                        lists(folded.reshape(-1), np.full(len(sets), bands)),
                        pa.array(bits[:, 0]),
                        pa.array(bits[:, 1]),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands", "s1", "s2"],
                )

    return run


def _confirm(percent: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                one = shingle_sets(*flat(part.column("text_a")), shingle)
                other = shingle_sets(*flat(part.column("text_b")), shingle)
                keep = []
                for x, y in zip(one, other, strict=True):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    union = len(x) + len(y) - shared
                    keep.append(union > 0 and 100 * shared >= percent * union)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(percent, shingle), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, percent: int = 85, shingle: int = 5, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): classes of documents joined by similar sets.

    Documents with equal sets are one from the start. In each round every document is
    compared with the nearest pivot, by sketch, of its buckets that is in another class and
    that it has not met: as many pairs as documents. Of buckets that still hold several
    classes, those of two documents give their pair, and the documents of
    the others meet in an exact prefix join.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.filter(F.col("doc_id").isNotNull())
    sketches = landed(
        texts.mapInArrow(
            _sketches(bands, rows, shingle),
            "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, s1 long, s2 long",
        ),
        "sketches",
    )
    same = ["n_shingles", "k1", "k2"]
    filled = sketches.filter("n_shingles > 0")
    reps = filled.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    banded = landed(
        filled.join(reps, same)
        .filter(F.col("doc_id") == F.col("rep"))
        .dropDuplicates(["rep"])
        .select("rep", "n_shingles", "s1", "s2", F.explode("bands").alias("band")),
        "bands",
    )
    pivot = F.min(F.struct("rep", "n_shingles", "s1", "s2")).alias("pivot")
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members"), pivot)
    shared = landed(banded.join(buckets.filter("members > 1"), "band"), "buckets")
    near = landed(_pivot_pairs(shared, percent), "pivots")
    tried, links, classes = None, None, None
    for _ in range(PIVOT_ROUNDS):
        nearest = landed(_nearest_pivots(near, tried, classes), "pairs")
        found = confirmed(nearest, texts, percent, shingle)
        tried = nearest if tried is None else tried.unionByName(nearest)
        links = landed(found if links is None else links.unionByName(found), "links")
        classes = landed(components(links), "classes")

    placed = _placed(shared.filter("members > 2"), classes)
    spread = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = placed.join(spread.filter("low < high").select("band"), "band", "left_semi")
    open_ = landed(mixed.select("rep", "component").distinct(), "members")
    rest = _similar_pairs(open_, texts, percent, shingle)
    rest = rest.unionByName(_apart(near.filter("two"), classes).select("a", "b")).distinct()
    rest = landed(rest.join(tried, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        links = landed(links.unionByName(confirmed(rest, texts, percent, shingle)), "links")
        classes = landed(components(links), "classes")

    named = sketches.select("doc_id", *same).join(reps, same, "left")
    found = named.join(classes, named["rep"] == classes["node"], "left")
    component = F.coalesce("component", "rep", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (component == F.col("doc_id")).alias("kept"),
    )


def _placed(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Bucket members with the class that the links so far put them in."""
    known = classes.select(F.col("node").alias("rep"), "component")
    both = shared.join(known, "rep", "left")
    return both.withColumn("component", F.coalesce("component", "rep"))


def _pivot_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b, differ, two): members with the pivots of their buckets that can be similar.

    ``a`` is the pivot, which has the smallest id of its bucket, and ``two`` tells that some
    bucket holds nothing else.
    """
    differ = F.bit_count(F.col("s1").bitwiseXOR(F.col("pivot.s1"))) + F.bit_count(
        F.col("s2").bitwiseXOR(F.col("pivot.s2"))
    )
    n, m = F.col("n_shingles"), F.col("pivot.n_shingles")
    possible = (100 * n >= percent * m) & (100 * m >= percent * n) & (differ <= MAX_DIFFERENT)
    met = shared.filter((F.col("pivot.rep") != F.col("rep")) & possible)
    pairs = met.groupBy(F.col("pivot.rep").alias("a"), F.col("rep").alias("b"))
    return pairs.agg(F.min(differ).alias("differ"), F.max(F.col("members") == 2).alias("two"))


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose documents are not in one class by the links so far."""
    out = pairs
    for x in ("a", "b"):
        known = classes.select(F.col("node").alias(x), F.col("component").alias(f"class_{x}"))
        out = out.join(known, x, "left").withColumn(f"class_{x}", F.coalesce(f"class_{x}", x))
    return out.filter("class_a <> class_b").select(*pairs.columns)


def _nearest_pivots(
    near: DataFrame, tried: DataFrame | None, classes: DataFrame | None
) -> DataFrame:
    """One pair for each member: the pivot of another class, not tried, with the nearest sketch."""
    if tried is not None:
        near = _apart(near.join(tried, ["a", "b"], "left_anti"), classes)
    best = near.groupBy("b").agg(F.min_by("a", F.struct("differ", "a")).alias("a"))
    return best.select("a", "b").distinct()


def _shingles(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 18):
                sets = shingle_sets(*flat(part.column("text")), shingle)
                counts = np.array([len(s) for s in sets])
                row = np.repeat(np.arange(len(sets)), counts)
                tokens = np.concatenate(sets).view(np.int64)
                own = [pa.array(part.column(c).to_numpy()[row]) for c in ("rep", "component")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(counts[row]), pa.array(tokens)],
                    names=["rep", "component", "n", "token"],
                )

    return run


def _similar_pairs(open_: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Candidate pairs of different classes among ``open_``, by an exact prefix join.

    Shingles are ordered from rare to frequent among these documents. Similar sets share
    one of their first n - ceil(percent * n) + 1 shingles, at places that leave room for
    the overlap that the similarity needs; no pair is lost, and texts that differ from the others in
    more places than that meet nothing.
    """
    own = open_.join(texts, open_["rep"] == texts["doc_id"]).select("rep", "component", "text")
    rows = landed(
        own.mapInArrow(_shingles(shingle), "rep long, component long, n long, token long")
        .dropDuplicates(["rep", "token"]),
        "shingles",
    )
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    ranked = rows.join(often, "token", "left")
    order = Window.partitionBy("rep").orderBy(F.coalesce("often", F.lit(1)), "token")
    ranked = ranked.withColumn("at", F.row_number().over(order) - 1)
    prefix = ranked.filter(
        (F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100)) & (F.col("often") > 1)
    )
    prefix = landed(prefix.select("rep", "component", "n", "token", "at"), "prefixes")
    x, y = prefix.alias("x"), prefix.alias("y")
    size = F.col("x.n") + F.col("y.n")
    room = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    met = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.rep") < F.col("y.rep"))
        & (F.col("x.component") != F.col("y.component"))
        & (100 * F.col("x.n") >= percent * F.col("y.n"))
        & (100 * F.col("y.n") >= percent * F.col("x.n"))
        & (room * (100 + percent) >= percent * size),
    )
    return met.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
