"""Toxicity by a recurrent network over all overlapping windows of a text.

A text is its lower-cased runs of letters; windows of `WINDOW` words start
every `STRIDE` words, the last one ends with the text, so every word is in a
window and neighbours overlap.  A text's raw score is that of its highest
window, mapped to a probability by a logistic fit on the training rows.

The network is trained on the driver from a bounded sample (`MOST_TOXIC` and
`MOST_CLEAN` labelled rows of the training folds); a toxic text teaches by
its highest windows, a clean one by its highest and some others.  The trained
parameters, under 2 MB whatever the input, go to the tasks.

Defined results
---------------
* A null or empty text, or one without letters, has no window; its score is
  that of the training rows' lowest windows.
* Repeated rows get the same score; a null id is scored and not held out.
* Without labelled rows of both kinds nothing can be learned: every score is
  0 and nothing is rejected.
* Other columns are not read; `drop_toxic` returns them unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gru import Adam, Network, Words
from .labelled import held_out, training_rows
from .shared import free_name

WINDOW, STRIDE = 48, 32
#: Bounds of the training sample, in labelled rows.
MOST_TOXIC, MOST_CLEAN = 1000, 1500
THRESHOLD = 0.7
#: Bytes of text that a task takes out of an Arrow batch at once, if more than one.
MOST_AT_ONCE = 4 << 20

words_of = re.compile(r"[^\W\d_]+").findall


class WordTable:
    """Numbers words as they come and keeps their gate inputs; emptied
    between batches when it holds over `most` words.  Rows of `gates` beyond
    the words held are unused memory that was never touched."""

    def __init__(self, network: Network, most: int = 150_000):
        self.network, self.most = network, most
        self.number: dict[str, int] = {}
        self.gates = np.empty((most, 6 * network.states), np.float32)

    def rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Row numbers of each text's words in `gates`."""
        if len(self.number) > self.most:
            self.number.clear()
        number = self.number
        fresh = list(dict.fromkeys(w for words in texts for w in words if w not in number))
        if fresh:
            first, end = len(number), len(number) + len(fresh)
            number.update(zip(fresh, range(first, end)))
            if end > len(self.gates):
                self.gates = np.concatenate([self.gates[:first], np.empty((end - first, self.gates.shape[1]), np.float32)])
            self.gates[first:end] = self.network.projected(Words(fresh))
        return [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in texts]


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows of a text of n words."""
    if n <= WINDOW:
        return np.zeros(1 if n else 0, np.int64)
    starts = np.arange(0, n - WINDOW, STRIDE)
    return np.append(starts, n - WINDOW)


def windows(rows: np.ndarray) -> np.ndarray:
    """(windows, WINDOW) row numbers, padded with -1."""
    n = len(rows)
    if n <= WINDOW:
        out = np.full((1 if n else 0, WINDOW), -1, np.int64)
        if n:
            out[0, :n] = rows
        return out
    return rows[window_starts(n)[:, None] + np.arange(WINDOW)]


def window_logits(network: Network, gates: np.ndarray, index: np.ndarray, block: int = 1024) -> np.ndarray:
    """Logits in blocks of windows of like length, so padding is not read."""
    lengths = (index >= 0).sum(1)
    order = np.argsort(lengths, kind="stable")
    out = np.empty(len(index), np.float32)
    for at in range(0, len(order), block):
        part = order[at : at + block]
        out[part] = network.logits(gates, index[part, : lengths[part[-1]]])
    return out


class Model:
    """Network, logistic map of the highest window's logit, and the logit of
    a text without windows."""

    def __init__(self, network: Network, slope: float, offset: float, none: float):
        self.network, self.slope, self.offset, self.none = network, slope, offset, none
        self.table: WordTable | None = None

    def highest(self, texts: list[str | None]) -> np.ndarray:
        """Logit of each text's highest window."""
        self.table = self.table or WordTable(self.network)
        rows = self.table.rows([words_of((t or "").lower()) for t in texts])
        per = [windows(r) for r in rows]
        counts = np.array([len(p) for p in per])
        out = np.full(len(texts), self.none)
        if counts.sum():
            logits = window_logits(self.network, self.table.gates, np.concatenate(per))
            some = counts > 0
            starts = np.concatenate(([0], np.cumsum(counts[some])))[:-1]
            out[some] = np.maximum.reduceat(logits, starts)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.clip(self.slope * self.highest(texts) + self.offset, -30, 30)
        return 1 / (1 + np.exp(-x))

    def __getstate__(self):
        return {**self.__dict__, "table": None}


def train(toxic: list[str], clean: list[str], share: float | None = None, rounds: int = 6, batch: int = 128,
          least_steps: int = 250, seed: int = 11) -> Model | None:
    """Fit network and map; None when a kind has no text with words.

    `share` is the part of all labelled rows that is toxic (by default that
    of the sample).  Every fifth text is kept from the network and calibrates
    its scores, weighted to that share; with under 20 toxic ones among them
    all texts do.
    """
    rnd = np.random.default_rng(seed)
    texts = [words_of(t.lower()) for t in (*toxic, *clean)]
    label = np.array([1] * len(toxic) + [0] * len(clean))
    some = np.array([bool(w) for w in texts])
    texts, label = [w for w in texts if w], label[some] if len(label) else label
    if not len(label) or label.min() == label.max():
        return None
    network = Network()
    adam = Adam(network)
    vocabulary = sorted({w for words in texts for w in words})
    number = dict(zip(vocabulary, range(len(vocabulary))))
    rows = [np.array([number[w] for w in words]) for words in texts]
    per = [windows(r) for r in rows]
    owner = np.repeat(np.arange(len(per)), [len(p) for p in per])
    index = np.concatenate(per)
    first = np.concatenate(([0], np.cumsum([len(p) for p in per])))
    features = Words(vocabulary)
    logits = np.zeros(len(index), np.float32)
    apart = np.concatenate([np.arange(n) % 5 == 4 for n in np.bincount(label)[::-1]])
    if (apart & (label == 1)).sum() < 20:
        apart[:] = False
    spread = np.where(label == 1, len(label) / (2 * (label == 1).sum()), len(label) / (2 * (label == 0).sum()))
    # Words that no toxic text has, for windows of one repeated word, of runs
    # of words, and of a few words: none of them is toxic.
    only_clean = np.setdiff1d(np.arange(len(vocabulary)), np.concatenate([rows[k] for k in np.flatnonzero((label == 1) | apart)]))
    turn, steps = 0, 0
    while turn < rounds or steps < least_steps:
        chosen = []
        for k in np.flatnonzero(~apart):
            span = np.arange(first[k], first[k + 1])
            if turn == 0:
                chosen.append(rnd.choice(span, min(2, len(span)), replace=False))
            else:
                top = span[np.argsort(-logits[span], kind="stable")]
                chosen.append(top[:2] if label[k] else np.concatenate([top[:1], rnd.choice(span, 1)]))
        chosen = rnd.permutation(np.unique(np.concatenate(chosen)))
        size = int(np.clip(len(chosen) // 16, 16, batch))
        left = max(rounds - 1 - turn, (least_steps - steps) * size // len(chosen))
        adam.rate = 0.02 if left > 1 else 0.006
        for at in range(0, len(chosen), size):
            part = chosen[at : at + size]
            target, weight, window = label[owner[part]], spread[owner[part]], index[part]
            if len(only_clean):
                runs = np.repeat(rnd.choice(only_clean, (size // 4, WINDOW // 8)), 8, axis=1)
                runs[::4] = runs[::4, :1]
                few = runs[1::2]
                few[:] = rnd.choice(only_clean, few.shape)
                few[np.arange(WINDOW) >= rnd.integers(1, 9, (len(few), 1))] = -1
                window = np.concatenate([window, runs])
                target = np.concatenate([target, np.zeros(len(runs), int)])
                weight = np.concatenate([weight, np.ones(len(runs))])
            used, local = np.unique(window, return_inverse=True)
            local = local.reshape(window.shape) - (used[0] == -1)
            adam.step(network.gradients(features.part(used[used >= 0]), local, target, weight))
            steps += 1
        turn += 1
        logits = window_logits(network, network.projected(features), index)
    best = np.maximum.reduceat(logits, first[:-1])
    use = apart if apart.any() else ~apart
    share = label.mean() if share is None else share
    weight = np.where(label == 1, share / label[use].mean(), (1 - share) / (1 - label[use].mean()))
    slope, offset = logistic(best[use], label[use], weight[use])
    return Model(network, slope, offset, float(np.quantile(logits, 0.01)))


def logistic(x: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit: Newton steps with a small
    ridge, halved until the loss falls."""
    a = np.stack([x.astype(float), np.ones(len(x))], 1)
    prior = np.array([1.0, 0.0])

    def loss(w):
        return (weight * np.logaddexp(0, np.where(label == 1, -1, 1) * (a @ w))).sum() + 0.05 * ((w - prior) ** 2).sum()

    w = prior
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, a.T @ (weight * (label - p)) - 0.1 * (w - prior))
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Model | None:
    """A model from the training folds of `labels (doc_id, toxic)`."""
    folds = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = folds.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    return train(training_rows(docs, labels, "toxic", 1, most_toxic),
                 training_rows(docs, labels, "toxic", 0, most_clean), share)


def scored(docs: DataFrame, model: Model | None, column: str = "__score") -> DataFrame:
    """`docs` with its columns and `column`, the toxicity from 0 to 1."""
    if model is None:
        return docs.withColumn(column, F.lit(0.0))

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out, at = np.empty(len(part)), 0
            while at < len(part):
                few = part.slice(at, 128)
                if few.nbytes > MOST_AT_ONCE:
                    few = few.slice(0, max(1, len(few) * MOST_AT_ONCE // few.nbytes))
                out[at : at + len(few)] = model.scores(few.to_pylist())
                at += len(few)
            yield pa.array(out)

    return docs.withColumn(column, score("text"))


def drop_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score under the threshold, columns unchanged."""
    column = free_name(docs, "__score")
    return scored(docs, model, column).where(F.col(column) < threshold).drop(column)
