"""Quality by positive-unlabelled learning.

Trusted positives (labelled good rows of the training folds) and unlabelled
texts of the corpus are told apart by a small network that minimises the
non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

where R_p and R_u are mean sigmoid losses over positives and unlabelled
texts.  When the second term turns negative the step goes uphill on it
alone, which stops the network from fitting single unlabelled texts.  No bad
label is used.

The class prior is estimated first: a logistic classifier of positives
against unlabelled texts is fitted on one half, and on the other half the
share of unlabelled texts above a score, divided by that of the positives, is
an upper bound of the prior at every score; the least bound, with a
confidence margin, is taken.

Features cover the whole text: frequencies of adjacent character classes and
statistics of words and lines.  Both samples are bounded by documented
parameters; the parameters of the network are a few kilobytes.

Defined results
---------------
* A null or empty text has the features of no text and is scored like any
  other.
* Repeated rows get the same score; a null id is scored and not held out.
* Without trusted positives or unlabelled texts nothing can be learned: every
  score is 0.5.
* Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import corpus_sample, training_rows

#: Bounds of the two samples, in rows.
MOST_TRUSTED, MOST_UNLABELLED = 4000, 8000
THRESHOLD = 0.5

CLASSES = 16


def _class_of_byte() -> np.ndarray:
    out = np.full(256, 15, np.int64)
    groups = [b" ", b"\t\r\x0b\x0c", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
              b".", b",;:", b"!?", b"'\"()-", b"#$%&*+=@^~", b"|/\\_<>[]{}`", bytes(range(128, 192)), bytes(range(192, 256)),
              b"\x00"]
    for k, group in enumerate(groups):
        out[list(group)] = k
    return out


CLASS_OF = _class_of_byte()


def features(text: str | None) -> np.ndarray:
    """The feature vector of one text."""
    data = (text or "").encode("utf-8")
    kinds = CLASS_OF[np.frombuffer(data, np.uint8)]
    pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES) if len(kinds) > 1 else np.zeros(CLASSES ** 2)
    words = data.split()
    n = max(1, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    top = max(counts.values(), default=0)
    again = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(1 for w in words if not (w[-1:].isalpha() or w[-1] >= 128))
    upper = sum(map(bytes.isupper, words))
    title = sum(map(bytes.istitle, words))
    return np.concatenate([np.sqrt(pairs / max(1, len(data))), [
        np.log1p(len(words)) / 8, np.log1p(len(data)) / 10, len(counts) / n, top / n, again / n, ends / n, upper / n, title / n,
        lengths.mean() / 10 if len(words) else 0, lengths.std() / 10 if len(words) else 0, len(set(lines)) / m,
        np.log1p(n / m) / 6, float(not words)]]).astype(np.float32)


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if texts else np.empty((0, CLASSES ** 2 + 13), np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Net:
    """One hidden layer; inputs are standardised by the unlabelled texts."""

    def __init__(self, sample: np.ndarray, hidden: int = 24, seed: int = 5):
        rnd = np.random.default_rng(seed)
        self.mean, self.scale = sample.mean(0), 1 / (sample.std(0) + 0.02)
        d = sample.shape[1]
        self.p = [rnd.standard_normal((d, hidden)) * d ** -0.5, np.zeros(hidden), rnd.standard_normal(hidden) * hidden ** -0.5, np.zeros(1)]
        self.m, self.v, self.t = [np.zeros_like(x) for x in self.p], [np.zeros_like(x) for x in self.p], 0

    def output(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -6, 6)
        h = np.tanh(z @ self.p[0] + self.p[1])
        if keep is not None:
            keep += [z, h]
        return h @ self.p[2] + self.p[3][0]

    def step(self, x: np.ndarray, slope_of, rate: float, decay: float = 1e-4) -> None:
        """One Adam step; `slope_of` maps outputs to the risk's derivative."""
        kept: list = []
        d = slope_of(self.output(x, kept))
        z, h = kept
        back = d[:, None] * self.p[2] * (1 - h * h)
        grads = [z.T @ back, back.sum(0), h.T @ d, np.array([d.sum()])]
        self.t += 1
        for k, g in enumerate(grads):
            g = g + decay * self.p[k]
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.p[k] = self.p[k] - rate * (self.m[k] / (1 - 0.9 ** self.t)) / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)


def _batches(rnd, n: int, size: int):
    order = rnd.permutation(n)
    return [order[at : at + size] for at in range(0, n, size)]


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, turns: int = 30, margin: float = 0.5, seed: int = 3) -> float:
    """Share of good texts among the unlabelled ones (an upper bound that is
    tight when some score range holds good texts alone)."""
    rnd = np.random.default_rng(seed)
    net = Net(unlabelled)
    half_p, half_u = len(positive) // 2, len(unlabelled) // 2
    fit = np.concatenate([positive[:half_p], unlabelled[:half_u]])
    label = np.concatenate([np.ones(half_p), np.zeros(half_u)])
    weight = np.where(label == 1, 0.5 / max(1, half_p), 0.5 / max(1, half_u))
    for _ in range(turns):
        for part in _batches(rnd, len(fit), 256):
            w = weight[part] * len(fit) / len(part)
            net.step(fit[part], lambda g, y=label[part], w=w: w * (_sigmoid(g) - y), 0.005)
    p, u = net.output(positive[half_p:]), net.output(unlabelled[half_u:])
    bounds = []
    for cut in np.quantile(p, np.linspace(0.0, 0.8, 33)):
        a, b = (p >= cut).mean(), (u >= cut).mean()
        slack = margin * (np.sqrt(b / len(u)) + np.sqrt(a / len(p)))
        bounds.append(((b + slack) / a, b / a))  # the bound with its margin picks the score
    return float(np.clip(min(bounds)[1], 0.02, 0.98))


def train(trusted: list[str], unlabelled: list[str], turns: int = 40, seed: int = 9) -> "Model | None":
    """Non-negative risk minimisation; None without both kinds of texts."""
    if len(trusted) < 4 or len(unlabelled) < 4:
        return None
    p, u = matrix(trusted), matrix(unlabelled)
    prior = estimate_prior(p, u)
    net, rnd = Net(u), np.random.default_rng(seed)
    sizes = max(1, -(-len(u) // 512))
    for turn in range(turns):
        rate = 0.01 if turn < turns * 0.6 else 0.002
        for part_p, part_u in zip(np.array_split(rnd.permutation(len(p)), sizes), np.array_split(rnd.permutation(len(u)), sizes)):
            if not len(part_p) or not len(part_u):
                continue
            n = len(part_p)

            def slope(g, n=n):
                s = _sigmoid(g)
                negative = s[n:].mean() - prior * s[:n].mean()  # sigmoid losses against "bad"
                d = s * (1 - s)
                down = np.concatenate([-prior * d[:n] / n, d[n:] / (len(g) - n)])
                if negative < 0:
                    return -down
                down[:n] -= prior * d[:n] / n
                return down

            net.step(np.concatenate([p[part_p], u[part_u]]), slope, rate)
    return Model(net, prior)


class Model:
    def __init__(self, net: Net, prior: float):
        self.net, self.prior = net, prior

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(self.net.output(matrix(texts)).astype(float))


def fit(docs: DataFrame, labels: DataFrame, most_trusted: int = MOST_TRUSTED, most_unlabelled: int = MOST_UNLABELLED) -> Model | None:
    """A model from the good rows of the training folds and the corpus."""
    return train(training_rows(docs, labels, "quality", 1, most_trusted), corpus_sample(docs, most_unlabelled))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` with its columns and `__score`, the quality from 0 to 1."""
    if model is None:
        return docs.withColumn("__score", F.lit(0.5))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = np.empty(len(part))
            for at in range(0, len(part), 256):
                out[at : at + 256] = model.scores(part.iloc[at : at + 256].tolist())
            yield pd.Series(out)

    return docs.withColumn("__score", score("text"))
