"""A character tagger in numpy: bidirectional LSTM emissions under a linear-chain CRF.

Everything works on whole batches of windows of one length. Both directions run as one stack, so
a time step is a handful of array operations whatever the batch size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PUNCTUATION = "@.-_+() \n,:;/%[]<>|#*$&!?'\""
PAD = 0
DIGIT = 1
OTHER = 2
OTHER_LETTER = 3
FIRST_LETTER = 4
CLASSES = FIRST_LETTER + 26 + len(PUNCTUATION)
_ASCII = np.full(128, OTHER, np.int64)
_ASCII[48:58] = DIGIT
_ASCII[65:91] = _ASCII[97:123] = np.arange(FIRST_LETTER, FIRST_LETTER + 26)
for _i, _c in enumerate(PUNCTUATION):
    _ASCII[ord(_c)] = FIRST_LETTER + 26 + _i
FORBIDDEN = -1e4


def classes_of(text: str) -> np.ndarray:
    """Class of every code point."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(code < 128, _ASCII[np.minimum(code, 127)], np.where(code < 0x250, OTHER_LETTER, OTHER))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Tagger:
    """Tag 0 is outside; tags 2k+1 and 2k+2 begin and continue kind k."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, kinds: int, hidden: int, seed: int) -> Tagger:
        random = np.random.default_rng(seed)
        tags = 2 * kinds + 1
        bias = np.zeros((2, CLASSES, 4 * hidden))
        bias[:, :, hidden : 2 * hidden] = 1.0  # remember at first
        w = {
            "input": random.normal(0, 0.3, (2, CLASSES, 4 * hidden)) + bias,
            "recur": random.normal(0, hidden**-0.5, (2, hidden, 4 * hidden)),
            "out": random.normal(0, (2 * hidden) ** -0.5, (2 * hidden, tags)),
            "bias": np.zeros(tags),
            "move": np.zeros((tags, tags)),
        }
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def transitions(self) -> np.ndarray:
        """Scores of tag pairs; a kind continues only what it has begun."""
        move = self.weights["move"].copy()
        for inside in range(2, len(move), 2):
            allowed = np.zeros(len(move), bool)
            allowed[[inside - 1, inside]] = True
            move[~allowed, inside] = FORBIDDEN
        return move

    def _run(self, x: np.ndarray, keep: bool):
        """Emissions (B, T, tags) of classes (B, T), and what the way back needs."""
        w = self.weights
        batch, time = x.shape
        hidden = w["recur"].shape[1]
        both = np.stack([x, x[:, ::-1]])
        h = np.zeros((2, batch, hidden), np.float32)
        c = np.zeros_like(h)
        states = np.empty((time, 2, batch, hidden), np.float32)
        saved = []
        side = np.arange(2)[:, None]
        for t in range(time):
            z = w["input"][side, both[:, :, t]] + h @ w["recur"]
            gates = _sigmoid(z[:, :, : 3 * hidden])
            i, f, o = np.split(gates, 3, axis=2)
            g = np.tanh(z[:, :, 3 * hidden :])
            before = c
            c = f * before + i * g
            squashed = np.tanh(c)
            if keep:
                saved.append((h, before, i, f, o, g, squashed))
            h = o * squashed
            states[t] = h
        joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)  # (T, B, 2H)
        emissions = joined @ w["out"] + w["bias"]
        emissions[(x == PAD).T] = np.where(np.arange(emissions.shape[2]) == 0, 0, FORBIDDEN)
        return emissions, joined, saved

    def _marginals(self, emissions: np.ndarray):
        """Tag marginals (T, B, tags), pair marginals summed over time, and log partition."""
        move = np.exp(np.maximum(self.transitions(), -60)) * (self.transitions() > FORBIDDEN / 2)
        begin = np.ones(move.shape[0], np.float64)
        begin[2::2] = 0
        top = emissions.max(axis=2, keepdims=True)
        local = np.exp((emissions - top).astype(np.float64))
        time = len(local)
        ahead = np.empty_like(local)
        scale = np.empty(local.shape[:2])
        for t in range(time):
            a = local[t] * (begin if t == 0 else ahead[t - 1] @ move)
            scale[t] = a.sum(axis=1) + 1e-300
            ahead[t] = a / scale[t][:, None]
        back = np.ones_like(local)
        pairs = np.zeros_like(move)
        for t in range(time - 2, -1, -1):
            following = local[t + 1] * back[t + 1] / scale[t + 1][:, None]
            back[t] = following @ move.T
            pairs += (ahead[t].T @ following) * move
        both = ahead * back
        return both / (both.sum(axis=2, keepdims=True) + 1e-300), pairs, (np.log(scale) + top[:, :, 0]).sum(axis=0)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (B, T) and their marginal probabilities."""
        emissions, _, _ = self._run(x, keep=False)
        move = self.transitions()
        time, batch, tags = emissions.shape
        score = emissions[0] + np.where((np.arange(tags) > 0) & (np.arange(tags) % 2 == 0), FORBIDDEN, 0)
        came = np.empty((time, batch, tags), np.int8)
        for t in range(1, time):
            steps = score[:, :, None] + move
            came[t] = steps.argmax(axis=1)
            score = steps.max(axis=1) + emissions[t]
        path = np.empty((time, batch), np.int64)
        path[-1] = score.argmax(axis=1)
        for t in range(time - 1, 0, -1):
            path[t - 1] = came[t, np.arange(batch), path[t]]
        sure, _, _ = self._marginals(emissions)
        return path.T, np.take_along_axis(sure, path[:, :, None], axis=2)[:, :, 0].T

    def gradients(self, x: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the gold tags, and its gradient."""
        w = self.weights
        batch, time = x.shape
        hidden = w["recur"].shape[1]
        emissions, joined, saved = self._run(x, keep=True)
        sure, pairs, partition = self._marginals(emissions)
        tags = emissions.shape[2]
        y = gold.T
        hot = np.eye(tags, dtype=np.float32)[y]
        gold_pairs = np.zeros((tags, tags))
        np.add.at(gold_pairs, (y[:-1], y[1:]), 1)
        score = (emissions * hot).sum() + (self.transitions() * gold_pairs).sum()
        loss = (partition.sum() - score) / batch
        d_emit = ((sure - hot) / batch).astype(np.float32)
        d_emit[(x == PAD).T] = 0
        grads = {
            "out": np.einsum("tbh,tbk->hk", joined, d_emit),
            "bias": d_emit.sum(axis=(0, 1)),
            "move": ((pairs - gold_pairs) / batch * (self.transitions() > FORBIDDEN / 2)).astype(np.float32),
            "recur": np.zeros_like(w["recur"]),
        }
        d_joined = d_emit @ w["out"].T
        d_states = np.stack([d_joined[:, :, :hidden], d_joined[::-1, :, hidden:]], axis=1)
        both = np.stack([x, x[:, ::-1]])
        d_h = np.zeros((2, batch, hidden), np.float32)
        d_c = np.zeros_like(d_h)
        back = w["recur"].transpose(0, 2, 1)
        d_gates = np.empty((2, time, batch, 4 * hidden), np.float32)
        for t in range(time - 1, -1, -1):
            h, before, i, f, o, g, squashed = saved[t]
            d_h = d_h + d_states[t]
            d_c = d_c + d_h * o * (1 - squashed**2)
            dz = np.concatenate(
                [d_c * g * i * (1 - i), d_c * before * f * (1 - f), d_h * squashed * o * (1 - o), d_c * i * (1 - g**2)],
                axis=2,
            )
            grads["recur"] += h.transpose(0, 2, 1) @ dz
            d_gates[:, t] = dz
            d_h = dz @ back
            d_c = d_c * f
        one_hot = np.eye(CLASSES, dtype=np.float32)[both.transpose(0, 2, 1).reshape(2, -1)]
        grads["input"] = one_hot.transpose(0, 2, 1) @ d_gates.reshape(2, time * batch, -1)
        return loss, grads


def train(
    x: np.ndarray, gold: np.ndarray, kinds: int, hidden: int, steps: int, batch: int, seed: int
) -> Tagger:
    """So many steps of Adam on shuffled batches, the same for the same data."""
    tagger = Tagger.fresh(kinds, hidden, seed)
    random = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.weights.items()}
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if not len(order):
            order = random.permutation(len(x))
        chosen, order = order[:batch], order[batch:]
        rate = 0.02 * (0.5 + 0.5 * np.cos(np.pi * step / steps)) + 0.001
        _, grads = tagger.gradients(x[chosen], gold[chosen])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            fixed = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
            tagger.weights[k] -= (rate * fixed[0] / (np.sqrt(fixed[1]) + 1e-8)).astype(np.float32)
    return tagger
