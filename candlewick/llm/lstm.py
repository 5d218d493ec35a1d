"""A small bidirectional LSTM block labeller in numpy: training by back-propagation, batched prediction."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Bag:
    """Bags of hashed feature ids, one per item: mean embeddings and their gradient."""

    def __init__(self, ids: np.ndarray, off: np.ndarray):
        self.ids, self.off = ids, off
        self.size = np.maximum(np.diff(off), 1)

    def mean(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.off) - 1, table.shape[1]), table.dtype)
        has = np.flatnonzero(np.diff(self.off) > 0)
        if len(has):
            out[has] = np.add.reduceat(table[self.ids], self.off[:-1][has], axis=0) / self.size[has, None]
        return out

    def gradient(self, grad: np.ndarray, rows: int) -> np.ndarray:
        each = np.repeat(grad / self.size[:, None], np.diff(self.off), axis=0)
        out = np.zeros((rows, grad.shape[1]), grad.dtype)
        np.add.at(out, self.ids, each)
        return out


class BiLSTM:
    """Labels every item of a sequence: path and word embeddings -> two LSTMs -> logistic output that also
    sees the item's own vector."""

    def __init__(self, paths: int, words: int, path_dim: int = 16, word_dim: int = 6, hidden: int = 12, seed: int = 7,
                 dtype: type = np.float32):
        rng = np.random.default_rng(seed)
        d, h = path_dim + word_dim, hidden
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(dtype)
        self.hidden = h
        self.p = {"path": draw(paths, path_dim, scale=0.3), "word": draw(words, word_dim, scale=0.1),
                  "wo": draw(2 * h + d, scale=0.1), "bo": np.zeros(1, dtype)}
        for way in "fb":
            self.p[f"wx{way}"] = draw(d, 4 * h, scale=d ** -0.5)
            self.p[f"wh{way}"] = draw(h, 4 * h, scale=h ** -0.5)
            bias = np.zeros(4 * h, dtype)
            bias[h:2 * h] = 1.0
            self.p[f"b{way}"] = bias

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str):
        """x (T, B, D), mask (T, B, 1) -> hidden states and what the gradient needs."""
        h, wh = self.hidden, self.p[f"wh{way}"]
        zx = x @ self.p[f"wx{way}"] + self.p[f"b{way}"]
        hs = np.zeros((len(x) + 1, x.shape[1], h), x.dtype)
        cs = np.zeros_like(hs)
        gates = np.empty((len(x), x.shape[1], 4 * h), x.dtype)
        for t in range(len(x)):
            z = zx[t] + hs[t] @ wh
            g = gates[t]
            g[:, :3 * h] = _sigmoid(z[:, :3 * h])            # input, forget, output
            g[:, 3 * h:] = np.tanh(z[:, 3 * h:])
            cs[t + 1] = (g[:, h:2 * h] * cs[t] + g[:, :h] * g[:, 3 * h:]) * mask[t]
            hs[t + 1] = g[:, 2 * h:3 * h] * np.tanh(cs[t + 1]) * mask[t]
        return hs, cs, gates

    def _back(self, x, mask, way, state, dh_out):
        h, wh = self.hidden, self.p[f"wh{way}"]
        hs, cs, gates = state
        dz = np.empty_like(gates)
        dh = np.zeros_like(hs[0])
        dc = np.zeros_like(hs[0])
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g = (gates[t][:, k * h:(k + 1) * h] for k in range(4))
            dh = (dh + dh_out[t]) * mask[t]
            tc = np.tanh(cs[t + 1])
            dc = (dc * mask[t]) + dh * o * (1 - tc * tc)
            z = dz[t]
            z[:, :h] = dc * g * i * (1 - i)
            z[:, h:2 * h] = dc * cs[t] * f * (1 - f)
            z[:, 2 * h:3 * h] = dh * tc * o * (1 - o)
            z[:, 3 * h:] = dc * i * (1 - g * g)
            z *= mask[t]
            dh, dc = z @ wh.T, dc * f
        flat = dz.reshape(-1, 4 * h)
        grads = {f"wx{way}": x.reshape(len(flat), -1).T @ flat, f"wh{way}": hs[:-1].reshape(len(flat), h).T @ flat, f"b{way}": flat.sum(0)}
        return grads, dz @ self.p[f"wx{way}"].T

    @staticmethod
    def _grid(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item at (t, sequence) or 0, mask (T, B, 1))."""
        size = np.diff(off)
        t = np.arange(size.max(initial=0))[:, None]
        mask = t < size[None, :]
        return np.where(mask, off[:-1][None, :] + t, 0), mask[:, :, None]

    def _forward(self, x_items: np.ndarray, off: np.ndarray):
        at, mask = self._grid(off)
        mask = mask.astype(x_items.dtype)
        x = x_items[at] * mask
        f = self._run(x, mask, "f")
        b = self._run(x[::-1], mask[::-1], "b")
        joint = np.concatenate([f[0][1:], b[0][1:][::-1], x], 2)
        return at, mask, x, f, b, joint, joint @ self.p["wo"] + self.p["bo"][0]

    def predict(self, x_items: np.ndarray, off: np.ndarray, cells: int = 1 << 16) -> np.ndarray:
        """Probability of label 1 per item; ``off`` cuts the items into sequences. Sequences of like length
        run together, at most about ``cells`` padded items at a time."""
        out = np.zeros(len(x_items), x_items.dtype)
        size = np.diff(off)
        order = np.argsort(size, kind="stable")
        order = order[size[order] > 0]
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * size[order[hi]] <= cells:
                hi += 1
            rows = order[lo:hi]
            n = size[rows]
            items = np.repeat(off[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            part = np.concatenate([[0], np.cumsum(n)])
            at, mask, *_, z = self._forward(x_items[items], part)
            keep = mask[:, :, 0] > 0
            out[items[at[keep]]] = _sigmoid(z[keep])
            lo = hi
        return out

    def gradients(self, path: Bag, word: Bag, off: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log-loss over items and its gradient."""
        xi = np.concatenate([path.mean(self.p["path"]), word.mean(self.p["word"])], 1)
        at, mask, x, f, b, joint, z = self._forward(xi, off)
        keep = mask[:, :, 0]
        target = y[at] * keep
        prob = _sigmoid(z)
        n = keep.sum()
        loss = float(-(keep * (target * np.log(prob + 1e-9) + (1 - target) * np.log(1 - prob + 1e-9))).sum() / n)
        dz = (prob - target) * keep / n
        h = self.hidden
        grads = {"wo": np.tensordot(dz, joint, 2), "bo": np.array([dz.sum()], xi.dtype)}
        dj = dz[:, :, None] * self.p["wo"]
        gf, dxf = self._back(x, mask, "f", f, dj[:, :, :h])
        gb, dxb = self._back(x[::-1], mask[::-1], "b", b, dj[::-1, :, h:2 * h])
        grads |= gf | gb
        dx = (dxf + dxb[::-1] + dj[:, :, 2 * h:]) * mask
        item = np.zeros_like(xi)
        sel = keep > 0
        item[at[sel]] = dx[sel]
        k = self.p["path"].shape[1]
        grads["path"] = path.gradient(item[:, :k], len(self.p["path"]))
        grads["word"] = word.gradient(item[:, k:], len(self.p["word"]))
        return loss, grads


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01):
        self.p, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        size = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.p[k] -= (size * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.p[k].dtype)
