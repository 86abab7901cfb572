"""Language identification with hyperdimensional letter profiles.

Every letter has a random vector of signs. A trigram is the product (binding) of its letters'
vectors, each permuted by its place; a text is the sum (bundle) of its trigrams, with a
blank between words, and so is a language over the texts that it was learned from. A text is
compared with the languages by cosine. Null texts and texts without letters are undetermined;
one row comes out per input row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.folds import held_out
from convoy.llm.tables import slices

SIZE = 1024
# Letters beyond the ASCII ones share so many vectors by their code; 0 is the blank.
SYMBOLS = 64
UNDETERMINED = "und"
# The cosine of a text with a language is sharpened by this before shares are formed.
SHARPNESS = 20.0
_PLANE = 0x110000


def _symbols() -> np.ndarray:
    """Symbol of every code point: letters a-z are 1 to 26, others 27 to 63, the rest blank."""
    table = np.zeros(_PLANE, np.uint8)
    codes = np.arange(_PLANE)
    # str.isalpha decides, block by block, what a letter is.
    for code in range(0x80, 0x3_2000):
        if chr(code).isalpha():
            table[code] = 27 + code % (SYMBOLS - 27)
    table[(codes >= 97) & (codes <= 122)] = codes[97:123] - 96
    table[(codes >= 65) & (codes <= 90)] = codes[65:91] - 64
    return table


_cache: dict = {}


def symbol_table() -> np.ndarray:
    if "symbols" not in _cache:
        _cache["symbols"] = _symbols()
    return _cache["symbols"]


def gram_vectors(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Products of the first two letters' permuted vectors, and the vectors of last letters."""
    key = f"{size}/{seed}"
    if key not in _cache:
        rng = np.random.default_rng(seed)
        letters = rng.choice(np.array([-1, 1], np.int8), (SYMBOLS, size))
        first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        pairs = (first[:, None] * second[None]).reshape(-1, size)
        _cache[key] = (pairs, letters)
    return _cache[key]


def _grams(codes: np.ndarray, size: int, seed: int) -> np.ndarray:
    pairs, letters = gram_vectors(size, seed)
    return pairs[codes // SYMBOLS] * letters[codes % SYMBOLS]


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, trigram, count), sorted, over all runs of letters and the blanks around them."""
    table = symbol_table()
    owners, grams, counts = [], [], []
    for i, text in enumerate(texts):
        seen: dict[int, int] = {}
        for at in range(0, len(text), 1 << 18):
            # Three characters of overlap, so no trigram is cut; blanks collapse first.
            part = text[max(at - 2, 0) : at + (1 << 18)]
            codes = table[np.frombuffer(part.lower().encode("utf-32-le", "replace"), "<u4")]
            codes = np.concatenate(([0], codes, [0])) if at == 0 else np.append(codes, 0)
            if at + (1 << 18) < len(text):
                codes = codes[:-1]
            codes = codes[(codes != 0) | (np.append(1, codes[:-1]) != 0)].astype(np.int32)
            if len(codes) < 3:
                continue
            runs = (codes[:-2] * SYMBOLS + codes[1:-1]) * SYMBOLS + codes[2:]
            runs = runs[codes[1:-1] != 0]
            found, often = np.unique(runs, return_counts=True)
            if at == 0 and len(text) <= 1 << 18:
                owners.append(np.full(len(found), i))
                grams.append(found)
                counts.append(often)
                break
            for g, c in zip(found.tolist(), often.tolist(), strict=True):
                seen[g] = seen.get(g, 0) + c
        if seen:
            owners.append(np.full(len(seen), i))
            grams.append(np.array(list(seen), np.int64))
            counts.append(np.array(list(seen.values()), np.int64))
    if not owners:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    return np.concatenate(owners), np.concatenate(grams), np.concatenate(counts)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) summed over each slice of learned texts."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 22):
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            which = np.array([names.index(x) for x in langs])
            owner, gram, count = trigram_counts([t or "" for t in part.column("text").to_pylist()])
            width = SYMBOLS**3
            key, place = np.unique(which[owner] * width + gram, return_inverse=True)
            total = np.bincount(place, weights=count, minlength=len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[k] for k in (key // width).tolist()], pa.string()),
                    pa.array((key % width).astype(np.int32)),
                    pa.array(total),
                ],
                names=["lang", "gram", "n"],
            )


@dataclass
class Profiles:
    """One prototype of unit length per language."""

    langs: list[str]
    prototypes: np.ndarray
    seed: int

    @classmethod
    def bundle(cls, rows: list[tuple[str, int, int]], size: int, seed: int) -> Profiles:
        langs = sorted({r[0] for r in rows})
        prototypes = np.zeros((len(langs), size))
        for k, lang in enumerate(langs):
            grams = np.array([r[1] for r in rows if r[0] == lang])
            counts = np.array([r[2] for r in rows if r[0] == lang], np.float64)
            for at in range(0, len(grams), 4096):
                vectors = _grams(grams[at : at + 4096], size, seed)
                prototypes[k] += counts[at : at + 4096] @ vectors
        prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)
        return cls(langs, prototypes.astype(np.float32), seed)

    def cosines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) cosines, and which texts have any letter."""
        out = np.zeros((len(texts), len(self.langs)))
        lettered = np.zeros(len(texts), bool)
        owner, gram, count = trigram_counts(texts)
        if len(owner):
            size = self.prototypes.shape[1]
            used, column = np.unique(gram, return_inverse=True)
            bundles = np.zeros((len(texts), size), np.float32)
            # A text's counts times the vectors of its trigrams, in blocks of trigrams.
            for at in range(0, len(used), 2048):
                here = (column >= at) & (column < at + 2048)
                dense = np.zeros((len(texts), min(2048, len(used) - at)), np.float32)
                dense[owner[here], column[here] - at] = count[here]
                bundles += dense @ _grams(used[at : at + 2048], size, self.seed).astype(np.float32)
            lettered[owner] = True
            norm = np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-12)
            out = (bundles / norm) @ self.prototypes.T
        return out.astype(np.float64), lettered


def _identified(profiles: Profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for at in range(0, part.num_rows, 512):
                    some = part.slice(at, 512)
                    texts = [t or "" for t in some.column("text").to_pylist()]
                    cosines, lettered = profiles.cosines(texts)
                    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                    if profiles.langs:
                        best = cosines.argmax(axis=1)
                        top = cosines.max(axis=1, keepdims=True)
                        share = 1 / np.exp(SHARPNESS * (cosines - top)).sum(axis=1)
                        langs = [
                            profiles.langs[b] if ok else UNDETERMINED
                            for b, ok in zip(best, lettered, strict=True)
                        ]
                        scores = np.where(lettered, share, 0.0)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)],
                        names=["doc_id", "lang_pred", "score"],
                    )

    return run


def identify(docs: DataFrame, size: int = SIZE, seed: int = 11) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from ``lang`` of documents not held out.

    All of those texts are counted; as many sums reach the driver as languages have
    trigrams, at most SYMBOLS**3 each. ``score`` is the share of the best
    language in the sharpened cosines. Without any learned language all are undetermined.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    known = texts.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = known.select("text", "lang").mapInArrow(_counted, "lang string, gram int, n long")
    sums = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = sorted((r["lang"], r["gram"], r["n"]) for r in sums.collect())
    profiles = Profiles.bundle(rows, size, seed)
    found = texts.select("doc_id", "text").mapInArrow(
        _identified(profiles), "doc_id long, lang_pred string, score double"
    )
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
