"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

VOCAB = 100
PAD = 0


def encode(codes: np.ndarray) -> np.ndarray:
    """Printable ASCII keeps its identity; line ends, other letters and other signs are one each."""
    codes = codes.astype(np.int64)
    out = np.where((codes >= 32) & (codes < 127), codes - 30, 99)
    out[(codes == 9) | (codes == 10) | (codes == 13)] = 1
    out[(codes >= 0xC0) & (codes < 0x2000)] = 98
    out[codes == 0] = PAD
    return out.astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


class Tagger:
    """Emissions of both directions' states, labels tied by a transition matrix.

    ``allowed[a, b]`` says whether label b may follow label a; other transitions never happen.
    """

    def __init__(self, labels: int, allowed: np.ndarray, size: int = 16, hidden: int = 24, seed: int = 0):
        rng = np.random.default_rng(seed)
        unit = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.hidden, self.allowed = hidden, allowed
        self.w = {"embed": rng.normal(0, 0.5, (VOCAB, size)), "trans": np.zeros((labels, labels))}
        for way in "fb":
            self.w[f"x{way}"] = unit(size, 4 * hidden)
            self.w[f"h{way}"] = unit(hidden, 4 * hidden)
            bias = np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.w[f"c{way}"] = bias
        self.w["out"] = unit(2 * hidden, labels)
        self.w["bias"] = np.zeros(labels)

    def transitions(self) -> np.ndarray:
        return np.where(self.allowed, self.w["trans"], -1e4)

    def _lstm(self, inputs: np.ndarray, way: str, keep: bool):
        """States of one direction; inputs (time, batch, 4 * hidden) are already multiplied."""
        steps, batch, _ = inputs.shape
        n = self.hidden
        h, c = np.zeros((batch, n), inputs.dtype), np.zeros((batch, n), inputs.dtype)
        states, held = np.empty((steps, batch, n), inputs.dtype), []
        recurrent = self.w[f"h{way}"].astype(inputs.dtype)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = inputs[t] + h @ recurrent
            s = _sigmoid(z[:, : 3 * n])
            g = np.tanh(z[:, 3 * n :])
            before, last = c, h
            c = s[:, n : 2 * n] * c + s[:, :n] * g
            wide = np.tanh(c)
            h = s[:, 2 * n :] * wide
            states[t] = h
            if keep:
                held.append((t, s, g, before, last, wide))
        return states, held

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        """(batch, time, labels) of encoded windows, in single precision."""
        states = []
        for way in "fb":
            table = (self.w["embed"] @ self.w[f"x{way}"] + self.w[f"c{way}"]).astype(np.float32)
            states.append(self._lstm(table[chars.T], way, False)[0])
        out = np.concatenate(states, axis=2) @ self.w["out"].astype(np.float32) + self.w["bias"].astype(np.float32)
        return out.transpose(1, 0, 2)

    def _gradients(self, chars: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        x, y = chars.T, gold.T
        steps, batch = x.shape
        embedded = self.w["embed"][x]
        parts, held = [], {}
        for way in "fb":
            states, held[way] = self._lstm(embedded @ self.w[f"x{way}"] + self.w[f"c{way}"], way, True)
            parts.append(states)
        both = np.concatenate(parts, axis=2)
        emit = both @ self.w["out"] + self.w["bias"]
        trans = self.transitions()
        # Forward and backward sums of the CRF.
        ahead, behind = np.empty_like(emit), np.zeros_like(emit)
        ahead[0] = emit[0]
        for t in range(1, steps):
            ahead[t] = emit[t] + _log_sum(ahead[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            behind[t] = _log_sum(trans + (emit[t + 1] + behind[t + 1])[:, None, :], 2)
        total = _log_sum(ahead[-1], 1)
        d_emit = np.exp(ahead + behind - total[:, None])
        pairs = np.exp(
            ahead[:-1, :, :, None] + trans + (emit[1:] + behind[1:])[:, :, None, :] - total[:, None, None]
        ).sum(axis=(0, 1))
        at = np.arange(batch)
        score = np.take_along_axis(emit, y[:, :, None], 2).sum(axis=0)[:, 0]
        score = score + trans[y[:-1], y[1:]].sum(axis=0)
        for t in range(steps):
            d_emit[t, at, y[t]] -= 1
        np.add.at(pairs, (y[:-1].ravel(), y[1:].ravel()), -1)
        g = {"trans": np.where(self.allowed, pairs, 0) / batch}
        d_emit /= batch
        g["out"] = both.reshape(-1, both.shape[2]).T @ d_emit.reshape(-1, d_emit.shape[2])
        g["bias"] = d_emit.sum(axis=(0, 1))
        d_both = d_emit @ self.w["out"].T
        d_embed = np.zeros_like(embedded)
        n = self.hidden
        for k, way in enumerate("fb"):
            d_states = d_both[:, :, k * n : (k + 1) * n]
            dz_all = np.empty((steps, batch, 4 * n))
            d_h, d_c = np.zeros((batch, n)), np.zeros((batch, n))
            grad_h = np.zeros_like(self.w[f"h{way}"])
            for t, s, gate, before, last, wide in reversed(held[way]):
                i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
                d_h = d_h + d_states[t]
                d_c = d_c + d_h * o * (1 - wide**2)
                dz = dz_all[t]
                dz[:, :n] = d_c * gate * i * (1 - i)
                dz[:, n : 2 * n] = d_c * before * f * (1 - f)
                dz[:, 2 * n : 3 * n] = d_h * wide * o * (1 - o)
                dz[:, 3 * n :] = d_c * i * (1 - gate**2)
                grad_h += last.T @ dz
                d_h = dz @ self.w[f"h{way}"].T
                d_c = d_c * f
            flat = dz_all.reshape(-1, 4 * n)
            g[f"h{way}"] = grad_h
            g[f"x{way}"] = embedded.reshape(-1, embedded.shape[2]).T @ flat
            g[f"c{way}"] = flat.sum(axis=0)
            d_embed += dz_all @ self.w[f"x{way}"].T
        g["embed"] = np.zeros_like(self.w["embed"])
        np.add.at(g["embed"], x.ravel(), d_embed.reshape(-1, d_embed.shape[2]))
        return float((total - score).mean()), g

    def train(self, chars: np.ndarray, gold: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 0) -> list[float]:
        """Mean loss of each epoch; Adam with gradients cut at length 5."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        losses, step = [], 0
        for epoch in range(epochs):
            order, lost = rng.permutation(len(chars)), []
            for a in range(0, len(order), batch):
                at = order[a : a + batch]
                loss, g = self._gradients(chars[at], gold[at])
                lost.append(loss)
                norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
                scale, step = min(1.0, 5 / (norm + 1e-9)), step + 1
                now = rate * (1 - 0.8 * epoch / max(1, epochs))
                for k, v in g.items():
                    v = v * scale
                    first[k] += 0.1 * (v - first[k])
                    second[k] += 0.001 * (v * v - second[k])
                    self.w[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            losses.append(float(np.mean(lost)) if lost else 0.0)
        return losses

    def decode(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of every sequence, all sequences step by step together."""
        trans = self.transitions().astype(np.float32)
        order = sorted(range(len(emissions)), key=lambda k: -len(emissions[k]))
        sizes = np.array([len(emissions[k]) for k in order])
        found = [np.zeros(0, np.int64)] * len(emissions)
        if not len(order) or not sizes[0]:
            return found
        labels = trans.shape[0]
        value = np.full((len(order), labels), -1e9, np.float32)
        for row, k in enumerate(order):
            if sizes[row]:
                value[row] = emissions[k][0]
        back = []
        for t in range(1, sizes[0]):
            n = int(np.searchsorted(-sizes, -t, "left"))
            step = value[:n, :, None] + trans
            came = step.argmax(axis=1)
            value[:n] = step.max(axis=1) + np.stack([emissions[k][t] for k in order[:n]])
            back.append(came.astype(np.int8))
        for row, k in enumerate(order):
            path = np.zeros(sizes[row], np.int64)
            if sizes[row]:
                path[-1] = int(value[row].argmax())
                for t in range(sizes[row] - 1, 0, -1):
                    path[t - 1] = back[t - 1][row, path[t]]
            found[k] = path
        return found
