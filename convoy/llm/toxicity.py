"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; each logistic model sees the text's features
and the probabilities of the categories before it. In training those probabilities
are out-of-fold, so that a later model learns from what an earlier one really knows. The
last category is the given label; earlier ones are marked among labelled rows by seed words
and their models carry them over to texts without those words.

Features are the presence of whole words and of word beginnings, hashed; those most
associated with the label are kept. Null texts are empty; one row comes out per input row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.folds import labelled
from convoy.llm.hashing import MARKS, mix, word_hashes
from convoy.llm.tables import flat, lists, slices, whole_row

# Words that mark a labelled row for a category of its own.
SEEDS = {
    "insult": ("idiot", "moron", "loser", "clown", "scum"),
    "contempt": ("stupid", "pathetic", "worthless", "disgusting", "trash"),
}
LAST = "toxic"
# At most so many labelled rows of each kind are learned from, those with the smallest hashes.
POSITIVES, NEGATIVES = 6_000, 12_000
FEATURES = 2048
# A feature has to stand in so many learned rows.
SUPPORT = 4
# Word beginnings of so many bytes are features beside the words.
HEADS = (3, 4, 6, 8)
FOLDS = 3
REJECT = 0.5
_U = np.uint64


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text, feature) of words and of the first bytes of longer words."""
    owners, values = [], []
    for head in (None, *HEADS):
        hashes, ends = word_hashes(data, offsets, MARKS, head)
        owners.append(np.repeat(np.arange(len(offsets) - 1), np.diff(ends)))
        values.append(mix(hashes + _U(0x5BD1E995 * (head or 0))).view(np.int64))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def _seed(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    hashes, _ = word_hashes(data, np.array([0, len(data)]), MARKS)
    return int(mix(hashes).view(np.int64)[0])


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, positive, negative): rows that hold each feature, by label."""
    for batch in batches:
        for part in slices(batch, "text"):
            owner, value = features(*flat(part.column("text")))
            y = part.column("y").to_numpy()[owner]
            found, place = np.unique(value, return_inverse=True)
            positive = np.bincount(place, weights=y, minlength=len(found)).astype(np.int64)
            total = np.bincount(place, minlength=len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(positive), pa.array(total - positive)],
                names=["feature", "positive", "negative"],
            )


def _located(owner: np.ndarray, value: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, column) of the features among ``kept``, which is sorted."""
    at = np.searchsorted(kept, value)
    at[at == len(kept)] = 0
    there = kept[at] == value if len(kept) else np.zeros(len(value), bool)
    return owner[there], at[there]


def _columns(kept: np.ndarray, seeds: list[np.ndarray]):
    """(doc_id, y, columns, seeded) of learned rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                owner, value = features(*flat(part.column("text")))
                row, column = _located(owner, value, kept)
                n = part.num_rows
                seeded = np.zeros(n, np.int64)
                for bit, words in enumerate(seeds):
                    seeded[owner[np.isin(value, words)]] |= 1 << bit
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("y"),
                        lists(column.astype(np.int32), np.bincount(row, minlength=n)),
                        pa.array(seeded),
                    ],
                    names=["doc_id", "y", "columns", "seeded"],
                )

    return run


def fit_logistic(
    row: np.ndarray, column: np.ndarray, dense: np.ndarray, y: np.ndarray, weight: np.ndarray,
    width: int, ridge: float = 0.1, rounds: int = 200,
) -> np.ndarray:
    """Weights of a ridge-penalised logistic model on sparse 0/1 columns, dense ones, and a constant.

    Accelerated gradient steps, scaled by each column's largest possible curvature.
    """
    dense = np.column_stack((dense, np.ones(len(y))))
    w = np.zeros(width + dense.shape[1])
    per_row = np.bincount(row, minlength=len(y)) + (np.abs(dense)).sum(axis=1)
    curve = np.concatenate(
        (
            np.bincount(column, weights=(weight * per_row)[row], minlength=width),
            (weight * per_row) @ np.abs(dense),
        )
    )
    step = 1 / (curve / 4 + ridge)
    free = np.ones(len(w))
    free[-1] = 0  # the constant is not penalised
    ahead, before = w.copy(), w.copy()
    for t in range(rounds):
        margin = np.bincount(row, weights=ahead[column], minlength=len(y)) + dense @ ahead[width:]
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        slope = np.concatenate(
            (np.bincount(column, weights=error[row], minlength=width), error @ dense)
        )
        w = ahead - step * (slope + ridge * free * ahead)
        ahead = w + t / (t + 3) * (w - before)
        before = w
    return w


def _probability(row, column, dense, n: int, w: np.ndarray, width: int) -> np.ndarray:
    margin = np.bincount(row, weights=w[column], minlength=n)
    margin = margin + dense @ w[width:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


@dataclass
class Chain:
    """The models of the categories in order, over ``kept`` features."""

    names: list[str]
    kept: np.ndarray
    weights: list[np.ndarray]

    @classmethod
    def fit(
        cls, names: list[str], kept: np.ndarray, row: np.ndarray, column: np.ndarray,
        labels: np.ndarray, weight: np.ndarray, fold: np.ndarray,
    ) -> Chain:
        """``labels`` has a column per name; ``fold`` tells which rows are predicted together."""
        n, width = len(labels), len(kept)
        earlier = np.zeros((n, 0))
        weights = []
        for k in range(len(names)):
            y = labels[:, k].astype(float)
            unseen = np.zeros(n)
            for f in range(FOLDS):
                learn, test = fold != f, fold == f
                use = learn[row]
                w = fit_logistic(row[use], column[use], earlier, y, weight * learn, width)
                unseen[test] = _probability(row, column, earlier, n, w, width)[test]
            weights.append(fit_logistic(row, column, earlier, y, weight, width))
            earlier = np.column_stack((earlier, unseen))
        return cls(names, kept, weights)

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, categories)."""
        n = len(offsets) - 1
        out = np.zeros((n, 0))
        row, column = _located(*features(data, offsets), self.kept)
        for w in self.weights:
            out = np.column_stack((out, _probability(row, column, out, n, w, len(self.kept))))
        return out


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    seeds: dict[str, tuple[str, ...]] = SEEDS,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> Chain | None:
    """The chain learned from labelled documents, or None without labels of both kinds.

    Learned rows are weighted to stand for all labelled rows.
    """
    known = labelled(labels, "toxic")
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return None
    draw = F.xxhash64("doc_id")
    some = [
        known.filter(F.col("y") == y).orderBy(draw, "doc_id").limit(n)
        for y, n in ((1, positives), (0, negatives))
    ]
    # Bounded by the two limits above.
    picked = F.broadcast(some[0].unionByName(some[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(picked, "doc_id")
    tally = texts.mapInArrow(_tallied, "feature long, positive long, negative long")
    tally = tally.groupBy("feature").agg(
        F.sum("positive").alias("p"), F.sum("negative").alias("n")
    )
    most = {y: min(counts[y], n) for y, n in ((1, positives), (0, negatives))}
    rest_p, rest_n = F.lit(most[1]) - F.col("p"), F.lit(most[0]) - F.col("n")
    odds = F.log((F.col("p") + 0.5) / (F.greatest(rest_p, F.lit(0)) + 0.5)) - F.log(
        (F.col("n") + 0.5) / (F.greatest(rest_n, F.lit(0)) + 0.5)
    )
    strength = F.abs(odds) / F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("n") + 0.5))
    best = tally.filter(F.col("p") + F.col("n") >= SUPPORT).select("feature", strength.alias("s"))
    chosen = best.orderBy(F.desc("s"), "feature").limit(FEATURES).collect()
    kept = np.sort(np.array([r["feature"] for r in chosen], np.int64))

    words = [np.array([_seed(w) for w in ws], np.int64) for ws in seeds.values()]
    rows = texts.mapInArrow(
        _columns(kept, words), "doc_id long, y int, columns array<int>, seeded long"
    )
    rows = rows.toArrow().sort_by("doc_id")
    if not rows.num_rows:
        return None
    y, seeded = rows.column("y").to_numpy(), rows.column("seeded").to_numpy()
    listed = rows.column("columns").combine_chunks()
    sizes = np.diff(listed.offsets.to_numpy())
    row = np.repeat(np.arange(len(y)), sizes)
    column = listed.flatten().to_numpy().astype(np.int64)
    marked = [y * (seeded >> bit & 1) for bit in range(len(seeds))]
    weight = np.where(y == 1, counts[1] / max((y == 1).sum(), 1), counts[0] / max((y == 0).sum(), 1))
    ids = rows.column("doc_id").to_numpy().astype(np.int64).view(_U)
    fold = (mix(ids) % _U(FOLDS)).astype(np.int64)
    table = np.column_stack([*marked, y])
    return Chain.fit([*seeds, LAST], kept, row, column, table, weight, fold)


def _scored(chain: Chain | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                shares = np.zeros((part.num_rows, len(names)))
                if chain is not None:
                    shares = chain.probabilities(*flat(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(s) for s in shares.T.copy()]],
                    names=["doc_id", *names],
                )

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """(doc_id, p_<category>..., score, predicted, kept); all 0 without labels of both kinds."""
    names = [f"p_{name}" for name in (*SEEDS, LAST)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = texts.mapInArrow(
        _scored(fit_chain(docs, labels), names),
        "doc_id long, " + ", ".join(f"{n} double" for n in names),
    )
    scored = scored.withColumn("score", F.col(names[-1]))
    return scored.withColumns(
        {"predicted": (F.col("score") >= reject).cast("int"), "kept": F.col("score") < reject}
    )


def _accepted(chain: Chain, reject: float, text: int):
    """The rows, structs with a text in place ``text``, that are not rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The texts are looked at in their rows, so that they arrive and leave once.
            texts = batch.column("row").field(text)
            for part in slices(batch.append_column("text", texts), "text"):
                score = chain.probabilities(*flat(part.column("text")))[:, -1]
                yield part.select(["row"]).filter(pa.array(score < reject))

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The documents that are not predicted toxic, with all of their columns."""
    chain = fit_chain(docs, labels)
    if chain is None:
        return docs
    rows = docs.select(whole_row(docs))
    text = [c.lower() for c in docs.columns].index("text")
    return rows.mapInArrow(_accepted(chain, reject, text), rows.schema).select("row.*")
