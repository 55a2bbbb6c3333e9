"""A small bidirectional LSTM that labels sequences, in numpy."""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLSTM:
    """Input (batch, time, features), mask (batch, time); one logit a step.

    Both directions read the whole sequence; a linear skip adds the step's own
    features.  Masked steps leave the state as it is."""

    def __init__(self, n_in: int, hidden: int, seed: int = 1):
        r = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = r.normal(0, 1 / np.sqrt(n_in), (n_in, 4 * hidden))
            self.p[f"h{d}"] = r.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            self.p[f"b{d}"] = np.zeros(4 * hidden)
            self.p[f"b{d}"][hidden:2 * hidden] = 1.0  # forget gates start open
        self.p["o"] = r.normal(0, 1 / np.sqrt(2 * hidden), 2 * hidden)
        self.p["s"] = np.zeros(n_in)
        self.p["c"] = np.zeros(1)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, x, mask, d, keep):
        n, t, _ = x.shape
        h, k = self.h, self.p
        z = (x.reshape(n * t, -1) @ k[f"x{d}"]).reshape(n, t, 4 * h) + k[f"b{d}"]
        state, cell = np.zeros((n, h), z.dtype), np.zeros((n, h), z.dtype)
        out = np.zeros((n, t, h), z.dtype)
        cache = []
        for j in range(t) if d == "f" else range(t - 1, -1, -1):
            a = z[:, j] + state @ k[f"h{d}"]
            i, f, o = _sigmoid(a[:, :h]), _sigmoid(a[:, h:2 * h]), _sigmoid(a[:, 2 * h:3 * h])
            g = np.tanh(a[:, 3 * h:])
            new = f * cell + i * g
            th = np.tanh(new)
            m = mask[:, j:j + 1]
            if keep:
                cache.append((j, state, cell, i, f, o, g, th, m))
            cell = np.where(m, new, cell)
            state = np.where(m, o * th, state)
            out[:, j] = state
        return out, cache

    def forward(self, x, mask, keep=False):
        hf, cf = self._run(x, mask, "f", keep)
        hb, cb = self._run(x, mask, "b", keep)
        both = np.concatenate([hf, hb], 2)
        return both @ self.p["o"] + x @ self.p["s"] + self.p["c"][0], (both, cf, cb)

    def gradient(self, x, mask, y):
        logit, (both, cf, cb) = self.forward(x, mask, True)
        n, t, _ = x.shape
        h = self.h
        d = ((_sigmoid(logit) - y) * mask / max(1, mask.sum())).astype(x.dtype)
        g = {"o": np.einsum("nt,nth->h", d, both), "s": np.einsum("nt,ntf->f", d, x), "c": np.array([d.sum()])}
        for name, cache, part in (("f", cf, self.p["o"][:h]), ("b", cb, self.p["o"][h:])):
            out = d[:, :, None] * part
            da = np.zeros((n, t, 4 * h), x.dtype)
            dh, dc = np.zeros((n, h), x.dtype), np.zeros((n, h), x.dtype)
            gh = np.zeros_like(self.p[f"h{name}"])
            for j, state, cell, i, f, o, c, th, m in reversed(cache):
                dh = dh + out[:, j]
                live, dead = np.where(m, dh, 0), np.where(m, 0, dh)
                dcn = np.where(m, dc, 0) + live * o * (1 - th * th)
                a = np.concatenate([dcn * c * i * (1 - i), dcn * cell * f * (1 - f), live * th * o * (1 - o),
                                    dcn * i * (1 - c * c)], 1)
                da[:, j] = a
                gh += state.T @ a
                dh = a @ self.p[f"h{name}"].T + dead
                dc = dcn * f + np.where(m, 0, dc)
            flat = da.reshape(n * t, -1)
            g |= {f"x{name}": x.reshape(n * t, -1).T @ flat, f"h{name}": gh, f"b{name}": flat.sum(0)}
        return logit, g

    def fit(self, sequences, labels, epochs=10, batch=32, rate=0.01, seed=2):
        r = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(sequences))
            # batches of like length, from a shuffled order, in a shuffled order
            batches = [part[i:i + batch] for at in range(0, len(order), batch * 8)
                       for part in [sorted(order[at:at + batch * 8], key=lambda i: len(sequences[i]))]
                       for i in range(0, len(part), batch)]
            for k in r.permutation(len(batches)):
                ids = batches[k]
                x, mask = pad([sequences[i] for i in ids])
                y = np.zeros(mask.shape, np.float32)
                for k, i in enumerate(ids):
                    y[k, :len(labels[i])] = labels[i]
                _, g = self.gradient(x, mask, y)
                step += 1
                for k in self.p:
                    m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                    m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                    self.p[k] -= rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def predict(self, sequences, cells=200_000):
        """Probabilities for each sequence, run together with those of like length."""
        out: list = [np.zeros(0)] * len(sequences)
        order = sorted((i for i in range(len(sequences)) if len(sequences[i])), key=lambda i: len(sequences[i]))
        at = 0
        while at < len(order):
            end, longest = at, 0
            while end < len(order) and (end == at or max(longest, len(sequences[order[end]])) * (end - at + 1) * 64 <= cells * 16) \
                    and end - at < 256:
                longest = max(longest, len(sequences[order[end]]))
                end += 1
            ids = order[at:end]
            x, mask = pad([sequences[i] for i in ids])
            p = _sigmoid(self.forward(x, mask)[0])
            for k, i in enumerate(ids):
                out[i] = p[k, :len(sequences[i])]
            at = end
        return out


def pad(sequences):
    t = max(len(s) for s in sequences)
    x = np.zeros((len(sequences), t, sequences[0].shape[1]), sequences[0].dtype)
    mask = np.zeros((len(sequences), t), bool)
    for i, s in enumerate(sequences):
        x[i, :len(s)] = s
        mask[i, :len(s)] = True
    return x, mask
