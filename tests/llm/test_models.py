"""The learned operators against plain versions of their formulas."""

import random
import re
import zlib

import numpy as np

from convoy.llm import language
from convoy.llm.language import identify
from convoy.llm.quality import _KINDS, SHRINK, Discriminant, statistics
from convoy.llm.toxicity import FOLDS, Chain, features

SCHEMA = "doc_id long, text string, lang string"


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_statistics_of_each_text():
    texts = ["", "One two, two\nthree 45!\n\nOne two, two", "été | (x) a/b 'q'", "\t \n", "a" * 5000]
    for text, got in zip(texts, statistics(*joined(texts)), strict=True):
        raw = text.encode()
        words, lines = re.findall(rb"[^\x20\x09-\x0D]+", raw), re.findall(rb"[^\n]+", raw)
        shares = [sum(b in set(kind) for b in raw) for kind in _KINDS.values()]
        shares.append(len(raw) - sum(shares))
        letters = len(raw) - sum(b in b" \t\n" for b in raw)
        distinct = lambda found: len(set(found)) / len(found) if found else 1
        wanted = [
            *np.sqrt(np.array(shares) / max(len(raw), 1)),
            np.log1p(len(words)),
            np.log1p(letters / max(len(words), 1)),
            distinct(words),
            np.log1p(len(raw) / max(len(lines), 1)),
            distinct(lines),
        ]
        assert np.allclose(got, wanted)


def test_discriminant_is_the_difference_of_plain_densities():
    rng = np.random.default_rng(1)
    y = (rng.random(400) < 0.4).astype(int)
    x = rng.standard_normal((400, 6)) @ rng.standard_normal((6, 6)) + 0.8 * y[:, None]
    model = Discriminant.fit(x, y)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    density = []
    for label in (0, 1):
        own = z[y == label]
        spread = np.cov(own, rowvar=False)
        level = np.trace(spread) / 6
        spread = (1 - SHRINK) * spread + SHRINK * level * np.eye(6)
        away = z - own.mean(axis=0)
        distance = (away * np.linalg.solve(spread, away.T).T).sum(axis=1)
        density.append(-(np.linalg.slogdet(spread)[1] + distance) / 2)
    difference = (density[1] - density[0]) / 6
    assert np.allclose(model.difference(x), difference)
    p = 1 / (1 + np.exp(-(model.slope * difference + model.offset)))
    assert np.allclose(model.scores(x), p)
    # The calibration is where the penalised likelihood is flat.
    flat = [((p - y) * difference).sum() + 1e-2 * (model.slope - 1), (p - y).sum() + 1e-2 * model.offset]
    assert np.abs(flat).max() < 1e-5


def plain_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's method on dense columns and a constant without penalty."""
    x = np.column_stack((x, np.ones(len(x))))
    penalty = np.diag([*[ridge] * (x.shape[1] - 1), 0])
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        w -= np.linalg.solve(curve, x.T @ (weight * (p - y)) + penalty @ w)
    return w


def plain_probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(np.column_stack((x, np.ones(len(x)))) @ w)))


def test_chain_of_models_with_unseen_inputs():
    rng = random.Random(2)
    stock = ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op"]
    texts = [" ".join(rng.choices(stock, k=rng.randint(1, 5))) for _ in range(240)]
    texts[5], texts[6] = "", stock[0]
    first = np.array([("ab" in t) ^ (rng.random() < 0.2) for t in texts])
    last = np.array([f & ("cd" in t or rng.random() < 0.5) for f, t in zip(first, texts, strict=True)])
    labels = np.column_stack((first, last)).astype(int)
    weight = np.where(last, 2.0, 1.0)
    fold = np.arange(len(texts)) % FOLDS
    data, offsets = joined(texts)
    owner, value = features(data, offsets)
    kept, column = np.unique(value, return_inverse=True)
    chain = Chain.fit(["first", "last"], kept, owner, column, labels, weight, fold)

    x = np.zeros((len(texts), len(kept)))
    x[owner, column] = 1
    earlier, now = np.zeros((len(texts), 0)), np.zeros((len(texts), 0))
    for k in range(2):
        unseen = np.zeros(len(texts))
        for f in range(FOLDS):
            learn, seen = fold != f, np.column_stack((x, earlier))
            w = plain_logistic(seen[learn], labels[learn, k], weight[learn])
            unseen[~learn] = plain_probability(seen[~learn], w)
        w = plain_logistic(np.column_stack((x, earlier)), labels[:, k], weight)
        now = np.column_stack((now, plain_probability(np.column_stack((x, now)), w)))
        earlier = np.column_stack((earlier, unseen))
    assert np.abs(chain.probabilities(data, offsets) - now).max() < 0.02


def bundle(text: str, letters: np.ndarray) -> np.ndarray:
    """The sum of the vectors of all runs of three letters or blanks around a letter."""
    codes = [0]
    for c in text.lower():
        code = ord(c) - 96 if "a" <= c <= "z" else 0
        if not code and c.isalpha():
            code = 27 + ord(c) % (language.SYMBOLS - 27)
        if code or codes[-1]:
            codes.append(code)
    codes += [0] if codes[-1] else []
    total = np.zeros(letters.shape[1])
    for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
        if b:
            total += np.roll(letters[a], 2).astype(int) * np.roll(letters[b], 1) * letters[c]
    return total


def test_language_by_plain_bundles(spark):
    rng = random.Random(3)
    stock = {
        "aa": ["the", "of", "and", "house", "is"],
        "bb": ["der", "und", "häuser", "ist", "große"],
        "cc": ["это", "дом", "который", "и", "не"],
    }
    rows = []
    for i in range(90):
        lang = rng.choice(list(stock))
        mixed = stock[lang] * 4 + rng.choice(list(stock.values()))
        text = rng.choice([" ", "  ", ", ", "\n-"]).join(rng.choices(mixed, k=rng.randint(1, 12)))
        rows.append((i, text, None if i % 11 == 0 else lang))
    rows.append((100, "und  der " * 30_000, None))
    rows += [(101, "12 -- 34", "aa"), (102, None, "bb"), (103, "", None)]
    letters = np.random.default_rng(11).choice(
        np.array([-1, 1], np.int8), (language.SYMBOLS, language.SIZE)
    )
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    bundles = {i: bundle(t or "", letters) for i, t, _ in rows}
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    prototypes = np.array(
        [unit(sum(bundles[i] for i, _, name in rows if name == lang and not held[i])) for lang in stock]
    )
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for i, _, _ in rows:
        assert got[i].held_out == held[i]
        if not bundles[i].any():
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        cosines = prototypes @ unit(bundles[i])
        share = 1 / np.exp(language.SHARPNESS * (cosines - cosines.max())).sum()
        assert got[i].lang_pred == list(stock)[int(cosines.argmax())]
        assert abs(got[i].score - share) < 1e-3
