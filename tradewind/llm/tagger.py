"""Character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tradewind.llm.common import ship

EMBED, HIDDEN = 12, 16
SYMBOLS = 99

ship(__name__)


def encode(text: str) -> np.ndarray:
    """Printable ASCII characters as themselves; 95 letters, 96 line ends, 97 others; 98 is padding."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where((codes >= 32) & (codes < 127), codes - 32, np.where(codes == 10, 96, np.where(codes > 191, 95, 97)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Tagger:
    params: dict[str, np.ndarray]
    tags: int

    @staticmethod
    def fresh(tags: int, seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {"E": rng.normal(0, 0.3, (SYMBOLS, EMBED))}
        for d in "fb":
            p["W" + d] = rng.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN))
            p["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        p["O"], p["o"] = rng.normal(0, 0.25, (2 * HIDDEN, tags)), np.zeros(tags)
        p["T"] = np.zeros((tags, tags))
        return Tagger({k: v.astype(np.float32) for k, v in p.items()}, tags)

    def _lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states of (batch, time, EMBED) read forward ('f') or backward ('b'), and what backprop needs."""
        n, steps, _ = x.shape
        w, c = self.params["W" + d], self.params["c" + d]
        before = x @ w[:EMBED] + c
        h, s = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, kept = np.empty((n, steps, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = before[:, t] + h @ w[EMBED:]
            gates, g = _sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN: 2 * HIDDEN], gates[:, 2 * HIDDEN:]
            new = f * s + i * g
            squashed = np.tanh(new)
            kept.append((t, h, s, i, f, o, g, squashed))
            h, s = o * squashed, new
            out[:, t] = h
        return out, kept

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Tag scores of (batch, time) codes."""
        x = self.params["E"][codes]
        both = np.concatenate([self._lstm(x, "f")[0], self._lstm(x, "b")[0]], 2)
        return both @ self.params["O"] + self.params["o"]

    def loss_and_gradients(self, codes: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log-likelihood of the gold tags under the CRF, per character, and its gradients."""
        p = self.params
        x = p["E"][codes]
        (hf, kf), (hb, kb) = self._lstm(x, "f"), self._lstm(x, "b")
        both = np.concatenate([hf, hb], 2)
        scores = both @ p["O"] + p["o"]
        n, steps, k = scores.shape
        by_time = np.ascontiguousarray(scores.transpose(1, 0, 2))
        lead, tail = np.empty_like(by_time), np.zeros_like(by_time)
        lead[0] = by_time[0]
        for t in range(1, steps):
            lead[t] = by_time[t] + _logsum(lead[t - 1][:, :, None] + p["T"], 1)
        for t in range(steps - 2, -1, -1):
            tail[t] = _logsum(p["T"] + (by_time[t + 1] + tail[t + 1])[:, None, :], 2)
        total = _logsum(lead[-1], 1)
        scale = 1.0 / (n * steps)
        d_scores = np.exp((lead + tail).transpose(1, 0, 2) - total[:, None, None])
        rows, times = np.arange(n)[:, None], np.arange(steps)[None]
        d_scores[rows, times, gold] -= 1
        d_t = np.exp(lead[:-1, :, :, None] + p["T"] + (by_time + tail)[1:, :, None, :] - total[:, None, None]).sum((0, 1))
        np.add.at(d_t, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), -1)
        path = scores[rows, times, gold].sum() + p["T"][gold[:, :-1], gold[:, 1:]].sum()
        d_scores *= scale
        flat = d_scores.reshape(-1, k)
        grads = {"O": both.reshape(-1, 2 * HIDDEN).T @ flat, "o": flat.sum(0), "T": d_t * scale}
        d_both = (flat @ p["O"].T).reshape(n, steps, -1)
        d_x = np.zeros_like(x)
        for d, kept, part in (("f", kf, d_both[..., :HIDDEN]), ("b", kb, d_both[..., HIDDEN:])):
            w = p["W" + d]
            d_h, d_s = np.zeros((2, n, HIDDEN), x.dtype)
            z = np.empty((steps, n, 4 * HIDDEN), x.dtype)
            inputs = np.empty((steps, n, HIDDEN), x.dtype)
            for t, h, s, i, f, o, g, squashed in reversed(kept):
                d_h = d_h + part[:, t]
                d_s = d_s + d_h * o * (1 - squashed**2)
                z[t, :, :HIDDEN] = d_s * g * i * (1 - i)
                z[t, :, HIDDEN: 2 * HIDDEN] = d_s * s * f * (1 - f)
                z[t, :, 2 * HIDDEN: 3 * HIDDEN] = d_h * squashed * o * (1 - o)
                z[t, :, 3 * HIDDEN:] = d_s * i * (1 - g**2)
                inputs[t] = h
                d_h, d_s = z[t] @ w[EMBED:].T, d_s * f
            flat_z = z.reshape(-1, 4 * HIDDEN)
            d_w = np.concatenate([
                x.transpose(1, 0, 2).reshape(-1, EMBED).T @ flat_z, inputs.reshape(-1, HIDDEN).T @ flat_z])
            d_c = flat_z.sum(0)
            d_x += (z @ w[:EMBED].T).transpose(1, 0, 2)
            grads["W" + d], grads["c" + d] = d_w, d_c
        grads["E"] = np.zeros_like(p["E"])
        np.add.at(grads["E"], codes.ravel(), d_x.reshape(-1, EMBED))
        return float((total.sum() - path) * scale), grads

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best tags of (time, tags) scores under the transitions."""
        back = np.zeros(scores.shape, np.int64)
        best = scores[0]
        for t in range(1, len(scores)):
            step = best[:, None] + self.params["T"]
            back[t] = step.argmax(0)
            best = step.max(0) + scores[t]
        out = [int(best.argmax())]
        for t in range(len(scores) - 1, 0, -1):
            out.append(int(back[t][out[-1]]))
        return np.array(out[::-1])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def train(
    codes: np.ndarray, gold: np.ndarray, tags: int, *, steps: int = 300, batch: int = 96, rate: float = 0.03, seed: int = 7
) -> Tagger:
    """So many Adam steps over shuffled windows (n, time), whatever their number."""
    model, rng = Tagger.fresh(tags, seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.params.items()}
    second = {k: np.zeros_like(v) for k, v in model.params.items()}
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(codes)):
            order = rng.permutation(len(codes))
        take, order = order[:batch], order[batch:]
        _, grads = model.loss_and_gradients(codes[take], gold[take])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[k] += (0.1 * (g - first[k])).astype(np.float32)
            second[k] += (0.001 * (g * g - second[k])).astype(np.float32)
            model.params[k] -= (speed * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model
