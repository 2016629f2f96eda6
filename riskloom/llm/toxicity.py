"""Toxicity by a subsequence string kernel, Nystroem landmarks and a linear support vector machine.

The kernel of two strings sums, over all subsequences of four letters, the product of their
weights; a subsequence that spans ``s`` letters weighs ``decay ** s``. So an insult with a letter
put in or left apart still shares most of its weight. Sentences are seen as windows of letters.
Landmark windows L span the feature space ``k(x, L) K_LL^(-1/2)``, in which the machine is
trained. Its decision is a sum over the subsequences of a window, so scoring a text takes one
table lookup per letter and gap pattern, however many landmarks there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.llm.common import some_texts

#: A letter that stands alone and is followed by another one: spelt-out words close up.
_SPELT = re.compile(r"(?<![^\W_])([^\W_])[\W_]{1,3}(?=[^\W_](?![^\W_]))")
_LENGTH, _LETTERS = 4, 32
_SIZE = _LETTERS**_LENGTH


@dataclass(frozen=True)
class ToxicityModel:
    """Decision weight of every subsequence of four letters, and the scale to probabilities."""

    weights: np.ndarray = field(repr=False)
    slope: float
    offset: float
    decay: float = 0.7
    reach: int = 6
    window: int = 14


def letters(text: str) -> np.ndarray:
    """Letter codes 1..31 of a text (a to z, five classes of other letters), 0 for everything else; runs of other characters count once."""
    lowered = _SPELT.sub(r"\1", text.lower())
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), np.uint32)
    codes = np.where((points >= 97) & (points <= 122), points - 96, 0)
    wide = points >= 0xC0
    codes[wide] = 27 + points[wide] % 5
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    return codes[keep].astype(np.int64)


def patterns(reach: int) -> list[tuple[int, int, int]]:
    """Places of the second to fourth letter after the first, within ``reach`` letters."""
    return list(combinations(range(1, reach), _LENGTH - 1))


def subsequences(codes: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per gap pattern its span and the subsequence at each letter, as a number of four digits.

    A digit is 0 where there is no letter, as at the edge of a word; see ``counted``.
    """
    n = len(codes)
    padded = np.zeros(n + reach, np.int32)
    padded[:n] = codes
    pairs = {p: padded[:n] * _LETTERS + padded[p : p + n] for p in range(1, reach - 2)}
    scaled = {p: pair * _LETTERS for p, pair in pairs.items()}
    thirds = {(p, q): (scaled[p] + padded[q : q + n]) * _LETTERS for p in pairs for q in range(p + 1, reach - 1)}
    for p, q, r in patterns(reach):
        yield r + 1, thirds[p, q] + padded[r : r + n]


def counted() -> np.ndarray:
    """For each subsequence, whether it has three letters at least (a word's edge may be one sign)."""
    number = np.arange(_SIZE)
    return sum((number // _LETTERS**k % _LETTERS > 0).astype(int) for k in range(_LENGTH)) >= _LENGTH - 1


def contributions(codes: np.ndarray, weights: np.ndarray, decay: float, reach: int) -> np.ndarray:
    """Decision value that starts at each letter."""
    total = np.zeros(len(codes), np.float32)
    for span, index in subsequences(codes, reach):
        total += np.float32(decay**span) * weights[index]
    return total


def window_sums(values: np.ndarray, window: int) -> np.ndarray:
    """Sums over every window of letters (the last windows are shorter)."""
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[np.minimum(np.arange(len(values)) + window, len(values))] - sums[:-1]


def best_window(codes: np.ndarray, model: ToxicityModel) -> float:
    if not len(codes):
        return 0.0
    return float(window_sums(contributions(codes, model.weights, model.decay, model.reach), model.window).max())


def _features(windows: list[np.ndarray], decay: float, reach: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Different subsequences of each window with their weights, scaled to length 1."""
    out, valid = [], counted()
    for w in windows:
        pieces = [(i := index[valid[index]], np.full(len(i), decay**span)) for span, index in subsequences(w, reach)]
        index, weight = (np.concatenate(p) for p in zip(*pieces))
        keys, place = np.unique(index, return_inverse=True)
        sums = np.bincount(place, weight, len(keys)) if len(keys) else np.zeros(0)
        out.append((keys, sums / max(np.sqrt((sums**2).sum()), 1e-9)))
    return out


def _kernel(rows: list, landmarks: list) -> np.ndarray:
    """Kernel of feature rows and landmarks."""
    out = np.zeros((len(rows), len(landmarks)))
    keys = np.concatenate([k for k, _ in rows] or [np.zeros(0, np.int64)])
    values = np.concatenate([v for _, v in rows] or [np.zeros(0)])
    row = np.repeat(np.arange(len(rows)), [len(k) for k, _ in rows])
    table = np.zeros(_SIZE)
    for j, (k, v) in enumerate(landmarks):
        table[k] = v
        out[:, j] = np.bincount(row, table[keys] * values, len(rows))
        table[k] = 0.0
    return out


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the offset."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        active = y * (x @ w) < 1
        a = x[active] * weight[active, None]
        new = np.linalg.solve(ridge + c * x[active].T @ a, c * a.T @ y[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _cut(codes: np.ndarray, starts: np.ndarray, window: int) -> list[np.ndarray]:
    return [codes[s : s + window + 2] for s in starts]


def _stretched(codes: np.ndarray, rng: np.random.RandomState) -> np.ndarray:
    """A window with one foreign or doubled letter put in."""
    at = rng.randint(len(codes))
    letter = codes[at] if rng.rand() < 0.5 else rng.randint(1, 27)
    return np.insert(codes, at, letter)


def train(
    texts: list[str], labels: list[int], *, landmarks: int = 256, rounds: int = 3, decay: float = 0.7, reach: int = 6,
    window: int = 14, seed: int = 5,
) -> ToxicityModel:
    """Train on labelled texts in memory; which sentence of a toxic text is toxic is learned too.

    Start: log-odds of subsequences between toxic and other texts. Each round takes the highest
    windows of every text (of toxic ones as positive, of others as hard negative examples) and
    random windows of the others, adds copies with a letter put in, draws landmarks from them and fits the machine. Without both
    labels the model scores every text with the share of label 1.
    """
    y = np.array(labels, float)
    share = float(y.mean()) if len(y) else 0.0
    neutral = ToxicityModel(np.zeros(_SIZE, np.float32), 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))), decay, reach, window)
    if not 0.0 < share < 1.0:
        return neutral
    rng = np.random.RandomState(seed)
    codes = [letters(t) for t in texts]
    held = [np.zeros(_SIZE), np.zeros(_SIZE)]
    for c, label in zip(codes, labels):
        seen = np.zeros(_SIZE, bool)
        for _, index in subsequences(c, 5):
            seen[index] = True
        held[int(label)] += seen
    n1, n0 = y.sum(), (1 - y).sum()
    odds = np.log((held[1] + 0.5) / (n1 + 1)) - np.log((held[0] + 0.5) / (n0 + 1))
    # Few holders tell little: shrink by the square root of the number of toxic texts.
    weights = np.where(held[1] >= 3, odds * np.sqrt(held[1] / n1), 0.0) + np.where(held[1] < 3, np.minimum(odds, 0.0) * 0.1, 0.0)
    weights[~counted()] = 0.0
    model = ToxicityModel(weights.astype(np.float32), 1.0, 0.0, decay, reach, window)
    for _ in range(rounds):
        rows, sign = [], []
        for c, label in zip(codes, labels):
            if len(c) < _LENGTH:
                continue
            sums = window_sums(contributions(c, model.weights, decay, reach), window)
            top = int(sums.argmax())
            rows += _cut(c, np.array([top]), window)
            rows += [_stretched(rows[-1], rng) for _ in range(2 if label else 1)]
            sign += [1.0] * 3 if label else [-1.0] * 2
            if not label:
                more = rng.randint(0, len(c), size=2)
                rows += _cut(c, more, window)
                sign += [-1.0] * 2
        vectors, t = _features(rows, decay, reach), np.array(sign)
        if not (t > 0).any() or not (t < 0).any():
            return neutral
        chosen = np.concatenate([rng.permutation(np.flatnonzero(t > 0))[: landmarks * 2 // 3], rng.permutation(np.flatnonzero(t < 0))[: landmarks // 3]])
        marks = [vectors[i] for i in chosen]
        values, basis = np.linalg.eigh(_kernel(marks, marks) + 1e-3 * np.eye(len(marks)))
        root = basis / np.sqrt(np.maximum(values, 1e-6)) @ basis.T
        balance = np.where(t > 0, 1.0 / (t > 0).sum(), 1.0 / (t < 0).sum()) * len(t) / 2
        w = _machine(_kernel(vectors, marks) @ root, t, balance)
        beta = root @ w[:-1]
        table = np.zeros(_SIZE)
        for b, (k, v) in zip(beta, marks):
            table[k] += b * v
        model = ToxicityModel(table.astype(np.float32), 1.0, 0.0, decay, reach, window)
    z = np.array([best_window(c, model) for c in codes])
    slope, offset = _scale(z, y)
    return ToxicityModel(model.weights, slope, offset, decay, reach, window)


def _scale(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic scale of decision values, by Newton steps on smoothed labels."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    spread = max(float(z.std()), 1e-9)
    x = np.stack([z / spread, np.ones(len(z))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0] / spread), float(w[1])


def probability(value: float, model: ToxicityModel) -> float:
    return float(1 / (1 + np.exp(-np.clip(model.slope * value + model.offset, -30, 30))))


def fit(
    labelled: DataFrame, docs: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", *,
    texts_per_label: int = 800, max_chars: int = 20_000, **settings,
) -> ToxicityModel:
    """Train on a bounded sample of labelled documents.

    Per label the ``texts_per_label`` ids with the smallest hashes whose whole text has at most
    ``max_chars`` characters; only these texts reach the driver. Null labels and texts teach
    nothing.
    """
    ids = labelled.where(F.col(label).isin(0, 1)).select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    short = docs.where(F.length(text) <= max_chars).select(F.col(doc_id).alias("doc_id"))
    chosen = ids.join(short, "doc_id", "left_semi")
    # Of each bucket first, then of each label: a task's input doesn't grow with the number of tasks.
    for keys in (["label", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["label"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id"))
        chosen = chosen.withColumn("place", place).where(F.col("place") <= texts_per_label).select("doc_id", "label")
    found = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.length("text") <= max_chars)
    rows = found.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("doc_id", "label").collect()
    return train([r["text"] for r in rows], [r["label"] for r in rows], **settings)


def scored(model: ToxicityModel, text: str | Column = "text") -> Column:
    """Probability of label 1 of a text column (an extra column of the result's name is replaced by ``score``). Null, empty and letterless texts get the lowest."""
    sent = SparkSession.active().sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ready = sent.value
        for column in batches:
            found = [probability(best_window(letters(t or ""), ready), ready) for texts in some_texts(column) for t in texts]
            yield pa.array(found, pa.float64())

    return run(F.col(text) if isinstance(text, str) else text)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "toxicity") -> DataFrame:
    """All rows and columns with the score as ``out``."""
    return docs.withColumn(out, scored(model, text))
