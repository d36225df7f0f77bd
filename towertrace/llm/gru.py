"""A bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of a hashed word vector and the mean of hashed
vectors of its character 3- and 4-grams.  Two gated recurrent units read a
window in either direction, a learned attention weighs their states, and a
logistic unit scores the pooled state.  Training is backpropagation through
time with Adam.
"""

from __future__ import annotations

import zlib

import numpy as np

WORD_ROWS, CHAR_ROWS = 1 << 16, 1 << 13


def word_rows(words: list[str]) -> np.ndarray:
    return np.array([1 + zlib.crc32(w.encode("utf-8")) % (WORD_ROWS - 1) for w in words], np.int64)


def char_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-grams of `<word>`, and where each word's begin."""
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in marked])
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(codes))
    padded = np.concatenate([codes, np.zeros(3, np.uint64)])
    three = (padded[:-3] * np.uint64(0x9E3779B97F4A7C15) ^ padded[1:-2] * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ padded[2:-1] * np.uint64(0x165667B19E3779F9))
    four = three * np.uint64(31) ^ padded[3:] * np.uint64(0x27D4EB2F165667C5)
    grams = np.stack([three, four], 1)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    rows = (grams >> np.uint64(64 - 13)).astype(np.int64)
    fits = np.stack([at + 3 <= ends, at + 4 <= ends], 1)
    count = np.add.reduceat(fits.sum(1), np.concatenate(([0], np.cumsum(lengths)[:-1]))) if len(words) else np.empty(0, int)
    return rows[fits], np.concatenate(([0], np.cumsum(count)))[:-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def add_rows(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """out[rows] += values, with repeated rows."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    out[rows[starts]] += np.add.reduceat(values[order], starts, axis=0)


class Words:
    """Hashed rows of distinct words, computed once."""

    def __init__(self, words: list[str]):
        self.word = word_rows(words)
        self.char, self.starts = char_rows(words)
        self.counts = np.diff(np.concatenate((self.starts, [len(self.char)])))

    def __len__(self) -> int:
        return len(self.word)

    def part(self, which: np.ndarray) -> "Words":
        out = object.__new__(Words)
        out.word, out.counts = self.word[which], self.counts[which]
        ends = np.cumsum(out.counts)
        out.starts = ends - out.counts
        out.char = self.char[np.repeat(self.starts[which] - out.starts, out.counts) + np.arange(ends[-1])]
        return out


class Network:
    """Parameters by name in `p`; D inputs, H states per direction."""

    def __init__(self, size: int = 12, states: int = 8, seed: int = 7):
        rnd = np.random.default_rng(seed)
        d, h = size, states
        self.size, self.states = d, h
        draw = lambda *shape, scale: (rnd.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": draw(WORD_ROWS, d, scale=0.02), "char": draw(CHAR_ROWS, d, scale=0.3),
                  "attend": draw(2 * h, scale=0.3), "out": draw(2 * h, scale=0.3), "bias": np.zeros(1, np.float32)}
        for way in "fb":
            self.p |= {f"in_{way}": draw(d, 3 * h, scale=d ** -0.5), f"b_{way}": np.zeros(3 * h, np.float32),
                       f"gate_{way}": draw(h, 2 * h, scale=h ** -0.5), f"new_{way}": draw(h, h, scale=h ** -0.5)}

    def inputs(self, words: Words, block: int = 16384) -> np.ndarray:
        """Input vector of each distinct word, a block of words at a time."""
        out = np.empty((len(words), self.size), self.p["word"].dtype)
        ends = words.starts + words.counts
        for a in range(0, len(words), block):
            b = min(a + block, len(words))
            first = words.starts[a]
            sums = np.add.reduceat(self.p["char"][words.char[first : ends[b - 1]]], words.starts[a:b] - first, axis=0)
            out[a:b] = self.p["word"][words.word[a:b]] + sums / words.counts[a:b, None].astype(np.float32)
        return out

    def projected(self, words: Words) -> np.ndarray:
        """Gate inputs of each distinct word, forward then backward."""
        x = self.inputs(words)
        return np.concatenate([x @ self.p[f"in_{w}"] + self.p[f"b_{w}"] for w in "fb"], 1)

    def _read(self, gates_in: np.ndarray, mask: np.ndarray, way: str, keep: list | None):
        """States of one direction; gates_in is (T, n, 3H), mask (T, n, 1)."""
        t_all, n, _ = gates_in.shape
        h_n = self.states
        gate, new = self.p[f"gate_{way}"], self.p[f"new_{way}"]
        state, out = np.zeros((n, h_n), np.float32), np.empty((t_all, n, h_n), np.float32)
        for t in range(t_all) if way == "f" else range(t_all - 1, -1, -1):
            zr = sigmoid(gates_in[t, :, : 2 * h_n] + state @ gate)
            z, r = zr[:, :h_n], zr[:, h_n:]
            cand = np.tanh(gates_in[t, :, 2 * h_n :] + (r * state) @ new)
            step = mask[t] * z
            if keep is not None:
                keep.append((t, state, z, r, cand, step))
            state = state + step * (cand - state)
            out[t] = state
        return out

    def logits(self, gates: np.ndarray, index: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; `index` (n, T) names rows of `gates`, -1 pads."""
        mask = (index >= 0).T[:, :, None].astype(np.float32)
        x = gates[np.maximum(index, 0).T]
        width = 3 * self.states
        kept = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        both = np.concatenate([self._read(x[:, :, k * width : (k + 1) * width], mask, w, kept[w])
                               for k, w in enumerate("fb")], 2)
        weight = both @ self.p["attend"]
        weight = np.where(mask[:, :, 0] > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight *= mask[:, :, 0]
        weight /= weight.sum(0) + 1e-9
        pooled = np.einsum("tn,tnh->nh", weight, both)
        if keep is not None:
            keep |= {"mask": mask, "x": x, "kept": kept, "both": both, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["bias"][0]

    def gradients(self, words: Words, index: np.ndarray, target: np.ndarray, importance: np.ndarray) -> dict:
        """Gradients of the weighted mean log loss over one set of windows."""
        x = self.inputs(words)
        gates = np.concatenate([x @ self.p[f"in_{w}"] + self.p[f"b_{w}"] for w in "fb"], 1)
        k: dict = {}
        score = sigmoid(self.logits(gates, index, k))
        h = self.states
        g = {}
        d_logit = ((score - target) * importance / importance.sum()).astype(np.float32)
        g["out"], g["bias"] = k["pooled"].T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * self.p["out"]
        d_both = k["weight"][:, :, None] * d_pooled
        d_weight = np.einsum("tnh,nh->tn", k["both"], d_pooled)
        d_attend = k["weight"] * (d_weight - (k["weight"] * d_weight).sum(0))
        g["attend"] = np.einsum("tn,tnh->h", d_attend, k["both"])
        d_both += d_attend[:, :, None] * self.p["attend"]
        d_gates = np.zeros_like(gates)
        flat = np.maximum(index, 0).T
        for number, way in enumerate("fb"):
            gate, new = self.p[f"gate_{way}"], self.p[f"new_{way}"]
            g_gate, g_new = np.zeros_like(gate), np.zeros_like(new)
            d_in = np.empty((*flat.shape, 3 * h), np.float32)
            d_state = np.zeros((index.shape[0], h), np.float32)
            for t, before, z, r, cand, step in reversed(k["kept"][way]):
                d_state = d_state + d_both[t, :, number * h : (number + 1) * h]
                d_cand = d_state * step * (1 - cand * cand)
                d_z = d_state * (cand - before) * k["mask"][t] * z * (1 - z)
                d_rs = d_cand @ new.T
                d_r = d_rs * before * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], 1)
                g_gate += before.T @ d_zr
                g_new += (r * before).T @ d_cand
                d_in[t] = np.concatenate([d_zr, d_cand], 1)
                d_state = d_state * (1 - step) + d_zr @ gate.T + d_rs * r
            g[f"gate_{way}"], g[f"new_{way}"] = g_gate, g_new
            add_rows(d_gates[:, number * 3 * h : (number + 1) * 3 * h], flat.ravel(), d_in.reshape(-1, 3 * h))
            own = d_gates[:, number * 3 * h : (number + 1) * 3 * h]
            g[f"in_{way}"], g[f"b_{way}"] = x.T @ own, own.sum(0)
        d_x = d_gates[:, : 3 * h] @ self.p["in_f"].T + d_gates[:, 3 * h :] @ self.p["in_b"].T
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        add_rows(g["word"], words.word, d_x)
        add_rows(g["char"], words.char, np.repeat(d_x / words.counts[:, None].astype(np.float32), words.counts, axis=0))
        return g


class Adam:
    def __init__(self, network: Network, rate: float = 0.02):
        self.net, self.rate, self.t = network, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in network.p.items()}

    def step(self, g: dict) -> None:
        self.t += 1
        norm = float(np.sqrt(sum((x * x).sum() for x in g.values())))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        for k, x in g.items():
            m, v = self.m[k], self.v[k]
            m += 0.1 * (scale * x - m)
            v += 0.01 * ((scale * x) ** 2 - v)
            fix = self.rate * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t)
            self.net.p[k] -= (fix * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
