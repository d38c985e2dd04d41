"""Character tagger: a bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

TAGS_PER_KIND = 2  # begin, inside; tag 0 is outside


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def encode(text: str) -> list[int]:
    """Symbols: ASCII as it is, other letters 128, other characters 129."""
    return [ord(c) if c < "\x80" else 128 if c.isalpha() else 129 for c in text]


SYMBOLS, PAD = 131, 130


class CharTagger:
    """Tags 0 (outside), 1 + 2k (first character of kind k), 2 + 2k (further ones)."""

    def __init__(self, kinds: int, size: int = 16, hidden: int = 24, seed: int = 3):
        random = np.random.default_rng(seed)
        self.kinds, self.hidden = kinds, hidden
        tags = 1 + TAGS_PER_KIND * kinds
        scale = lambda *shape: (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"embed": scale(SYMBOLS, size) * np.float32(np.sqrt(SYMBOLS) * 0.3), "out": scale(2 * hidden, tags), "bias": np.zeros(tags, np.float32), "move": np.zeros((tags, tags), np.float32)}
        for way in "fb":
            self.p[f"w{way}"], self.p[f"u{way}"] = scale(size, 4 * hidden), scale(hidden, 4 * hidden)
            self.p[f"c{way}"] = np.r_[np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)].astype(np.float32)
        # a further character follows a character of its own kind only
        self.barred = np.zeros((tags, tags), np.float32)
        for k in range(kinds):
            inside = 2 + 2 * k
            self.barred[[t for t in range(tags) if t not in (inside - 1, inside)], inside] = -1e4
        self.first = np.array([-1e4 if t and t % 2 == 0 else 0.0 for t in range(tags)], np.float32)

    # -------------------------------------------------------------- network

    def _run(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        n, steps, _ = x.shape
        inputs = x @ self.p["w" + way] + self.p["c" + way]
        h, c = np.zeros((2, n, self.hidden), np.float32)
        out, saved = np.empty((n, steps, self.hidden), np.float32), []
        m = self.hidden
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = inputs[:, t] + h @ self.p["u" + way]
            gates, g = _sigmoid(z[:, : 3 * m]), np.tanh(z[:, 3 * m :])
            before, c_before = h, c
            c = gates[:, m : 2 * m] * c + gates[:, :m] * g
            tc = np.tanh(c)
            h = gates[:, 2 * m :] * tc
            out[:, t] = h
            if keep:
                saved.append((t, gates, g, tc, before, c_before))
        return out, saved

    def emissions(self, symbols: np.ndarray, keep: bool = False):
        x = self.p["embed"][symbols]
        forward, fs = self._run(x, "f", keep)
        backward, bs = self._run(x, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        scores = both @ self.p["out"] + self.p["bias"]
        return (scores, (x, both, fs, bs)) if keep else scores

    def _back(self, way: str, x: np.ndarray, saved: list, d_out: np.ndarray, grad: dict) -> np.ndarray:
        m, u = self.hidden, self.p["u" + way]
        dx, dh, dc = np.zeros_like(x), 0.0, 0.0
        for t, gates, g, tc, h, c in reversed(saved):
            i, f, o = gates[:, :m], gates[:, m : 2 * m], gates[:, 2 * m :]
            dh = d_out[:, t] + dh
            dc = dc + dh * o * (1 - tc**2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            grad["w" + way] += x[:, t].T @ dz
            grad["u" + way] += h.T @ dz
            grad["c" + way] += dz.sum(axis=0)
            dx[:, t] = dz @ self.p["w" + way].T
            dh, dc = dz @ u.T, dc * f
        return dx

    # ------------------------------------------------------------------ CRF

    def _alpha_beta(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        move = self.p["move"] + self.barred
        steps = e.shape[1]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + self.first
        for t in range(1, steps):
            alpha[:, t] = e[:, t] + _logsumexp(alpha[:, t - 1, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _logsumexp(move + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        return alpha, beta

    def marginals(self, symbols: np.ndarray) -> np.ndarray:
        """Posterior probability of each tag at each place of each window."""
        alpha, beta = self._alpha_beta(self.emissions(symbols))
        both = alpha + beta
        return np.exp(both - _logsumexp(both, 2)[:, :, None])

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The best allowed tags of one sequence with the given log scores."""
        best, back = scores[0] + self.first, []
        for row in scores[1:]:
            total = best[:, None] + self.barred
            back.append(total.argmax(axis=0))
            best = total.max(axis=0) + row
        tags = [int(best.argmax())]
        for step in reversed(back):
            tags.append(int(step[tags[-1]]))
        return np.array(tags[::-1])

    def _loss(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        e, (x, both, fs, bs) = self.emissions(symbols, keep=True)
        alpha, beta = self._alpha_beta(e)
        total = _logsumexp(alpha[:, -1], 1)
        n, steps, kinds = e.shape
        rows, cols = np.arange(n)[:, None], np.arange(steps)[None]
        move = self.p["move"] + self.barred
        gold = e[rows, cols, tags].sum(axis=1) + move[tags[:, :-1], tags[:, 1:]].sum(axis=1)
        d_e = np.exp(alpha + beta - total[:, None, None])
        d_e[rows, cols, tags] -= 1
        pair = alpha[:, :-1, :, None] + move + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["move"] += np.exp(pair).sum(axis=(0, 1)) / n
        np.add.at(grad["move"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), np.float32(-1 / n))
        d_e /= n
        grad["out"] += both.reshape(-1, both.shape[2]).T @ d_e.reshape(-1, kinds)
        grad["bias"] += d_e.sum(axis=(0, 1))
        d_both = d_e @ self.p["out"].T
        dx = self._back("f", x, fs, d_both[:, :, : self.hidden], grad) + self._back("b", x, bs, d_both[:, :, self.hidden :], grad)
        np.add.at(grad["embed"], symbols.ravel(), dx.reshape(-1, dx.shape[2]))
        return float((total - gold).mean()), grad

    def train(self, symbols: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 1) -> list[float]:
        """Adam on the CRF's negative log-likelihood; the mean loss of each epoch."""
        random = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, step = [], 0
        for epoch in range(epochs):
            order, total = random.permutation(len(symbols)), 0.0
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                loss, grad = self._loss(symbols[own], tags[own])
                total += loss * len(own)
                step += 1
                norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
                pace = rate * (1 - epoch / epochs)
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.999 * square[k] + 0.001 * g**2
                    self.p[k] -= (pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(total / len(order))
        return losses
