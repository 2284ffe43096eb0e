"""Language identification: a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time. It labels every byte of a text; the probabilities
of all positions are averaged into those of the document. Gates and candidates are clipped linear
functions, which keeps a step to a gather, a small matrix product and a few element-wise operations.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logpulse.llm.common import add_columns
from logpulse.llm.sampling import labelled_sample

HIDDEN = 8
#: Bytes of a sequence; longer texts are cut into sequences that are all read.
STEPS = 128
#: Sequences that run side by side.
LANES = 4096
#: Labelled texts of each language that the network is fitted on, and the pieces of each.
PER_LANGUAGE, PIECES = 400, 3
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
F32 = np.float32


@dataclass
class Direction:
    """Weights of one direction: `table` (3, 256, H) byte inputs with biases, `inner` (3, H, H)."""

    table: np.ndarray
    inner: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator, hidden: int) -> Direction:
        table = rng.normal(0, 0.15, (3, 256, hidden)).astype(F32)
        table[:2] += 0.5
        return cls(table, rng.normal(0, 0.6 / np.sqrt(hidden), (3, hidden, hidden)).astype(F32))

    def run(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (T, B, H) after each of the bytes x (T, B)."""
        steps, lanes = x.shape
        h = np.zeros((lanes, self.inner.shape[1]), self.table.dtype)
        out = np.empty((steps, *h.shape), h.dtype)
        given, own = np.empty((3, *h.shape), h.dtype), np.empty((3, *h.shape), h.dtype)
        for t in range(steps):
            np.take(self.table, x[t], axis=1, out=given, mode="clip")
            np.matmul(h, self.inner, out=own)
            gates = given[:2]
            gates += own[:2]
            np.clip(gates, 0, 1, out=gates)
            new = given[2]
            if trace is not None:
                trace.append((h, gates.copy(), own[2].copy()))
            own[2] *= gates[1]
            new += own[2]
            np.clip(new, -1, 1, out=new)
            if trace is not None:
                trace[-1] += (new.copy(),)
            h = h - new
            h *= gates[0]
            h += new
            out[t] = h
        return out

    def back(self, x: np.ndarray, trace: list, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and inner, from those of the states."""
        steps, lanes = x.shape
        hidden = self.inner.shape[1]
        carry = np.zeros((lanes, hidden), given.dtype)
        inputs, d_inner = np.empty((steps, lanes, 3 * hidden), given.dtype), np.zeros_like(self.inner)
        for t in reversed(range(steps)):
            before, (z, r), own, new = trace[t]
            dh = given[t] + carry
            d_new = dh * (1 - z) * (np.abs(new) < 1)
            dz = dh * (before - new) * ((z > 0) & (z < 1))
            dr = d_new * own * ((r > 0) & (r < 1))
            d_own = d_new * r
            carry = dh * z + dz @ self.inner[0].T + dr @ self.inner[1].T + d_own @ self.inner[2].T
            for k, d in enumerate((dz, dr, d_own)):
                d_inner[k] += before.T @ d
            inputs[t] = np.concatenate([dz, dr, d_new], axis=1)
        hot = np.zeros((x.size, 256), given.dtype)
        hot[np.arange(x.size), x.ravel()] = 1
        d_table = (hot.T @ inputs.reshape(x.size, -1)).reshape(256, 3, hidden).transpose(1, 0, 2)
        return d_table, d_inner


class Network:
    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.forth, self.back = Direction.fresh(rng, hidden), Direction.fresh(rng, hidden)
        self.out = rng.normal(0, 0.1, (2 * hidden + 1, len(classes))).astype(F32)

    def parameters(self) -> list[np.ndarray]:
        return [self.forth.table, self.forth.inner, self.back.table, self.back.inner, self.out]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(T, B, classes) of the bytes x (T, B)."""
        a, b = self.forth.run(x), self.back.run(x[::-1])[::-1]
        hidden = a.shape[2]
        scores = a.reshape(-1, hidden) @ self.out[:hidden] + b.reshape(-1, hidden) @ self.out[hidden:-1] + self.out[-1]
        np.clip(scores, -30, 30, out=scores)
        np.exp(scores, out=scores)
        scores /= scores @ np.ones((scores.shape[1], 1), scores.dtype)
        return scores.reshape(*x.shape, -1)

    def gradients(self, x: np.ndarray, label: np.ndarray, real: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the real positions, and its gradients in the order of parameters()."""
        traces: tuple[list, list] = ([], [])
        a, b = self.forth.run(x, traces[0]), self.back.run(x[::-1], traces[1])[::-1]
        hidden, n = a.shape[2], max(1, real.sum())
        states = np.concatenate([a, b, np.ones((*x.shape, 1), a.dtype)], axis=2).reshape(x.size, -1)
        scores = states @ self.out
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=1, keepdims=True)
        y = np.broadcast_to(label, x.shape).ravel()
        loss = -(np.log(p[np.arange(x.size), y] + 1e-12) * real.ravel()).sum() / n
        p[np.arange(x.size), y] -= 1
        p *= (real.ravel() / n)[:, None].astype(p.dtype)
        d_states = (p @ self.out.T)[:, :-1].reshape(*x.shape, 2 * hidden)
        ft, fi = self.forth.back(x, traces[0], d_states[..., :hidden])
        bt, bi = self.back.back(x[::-1], traces[1], d_states[::-1, :, hidden:])
        return float(loss), [ft, fi, bt, bi, states.T @ p]

    def fit(self, x: np.ndarray, label: np.ndarray, real: np.ndarray, *, rounds: int = 6, batch: int = 192, rate: float = 0.02, seed: int = 5) -> Network:
        """Adam over shuffled batches of sequences (T, N)."""
        rng, params = np.random.default_rng(seed), self.parameters()
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        total = rounds * max(1, -(-x.shape[1] // batch))
        for _ in range(rounds):
            order = rng.permutation(x.shape[1])
            for s in range(0, len(order), batch):
                at = order[s : s + batch]
                _, grads = self.gradients(x[:, at], label[at], real[:, at])
                step += 1
                pace = rate * (1 - 0.9 * step / total)
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(p.dtype)
        return self


def sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into sequences (STEPS, N) filled up with zeros, the real bytes of each, its text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    rows = -(-lengths // STEPS)
    width = np.zeros(int(rows.sum()) * STEPS, np.uint8)
    ends = np.cumsum(rows)
    for t, n, e in zip(texts, rows.tolist(), ends.tolist()):
        if n:
            start = (e - n) * STEPS
            width[start : start + len(t)] = np.frombuffer(t, np.uint8)
    owner = np.repeat(np.arange(len(texts)), rows)
    within = np.arange(len(owner)) - np.repeat(ends - rows, rows)
    real = np.minimum(STEPS, lengths[owner] - within * STEPS)
    return np.ascontiguousarray(width.reshape(-1, STEPS).T), real, owner


def train(df: DataFrame, *, label: str = "lang", text: str = "text", per_language: int = PER_LANGUAGE, key: str = "doc_id") -> Network | None:
    """A network fitted on a bounded sample of the rows with a label; None if there are none."""
    sample = labelled_sample(df, label, text, per_language, salt=2, chars=STEPS * PIECES, key=key).texts
    sample = {k: [t for t in v if _LETTER.search(t)][:per_language] for k, v in sample.items()}
    classes = sorted(k for k, v in sample.items() if v)
    if not classes:
        return None
    texts = [(t.encode("utf-8", "replace"), n) for n, c in enumerate(classes) for t in sample[c]]
    x, real, owner = sequences([t for t, _ in texts])
    labels = np.array([n for _, n in texts])[owner]
    return Network(classes).fit(x, labels, (np.arange(STEPS)[:, None] < real).astype(F32))


def classify(network: Network, texts: list[str], spans: bool = False):
    """Mean probabilities (texts, classes); with `spans` also each text's runs of equal labels."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    x, real, owner = sequences(raw)
    total = np.zeros((len(texts), len(network.classes)))
    labels = np.zeros(x.shape, np.int16) if spans else None
    for s in range(0, x.shape[1], LANES):
        e = min(s + LANES, x.shape[1])
        p = network.probabilities(x[:, s:e])
        if labels is not None:
            labels[:, s:e] = p.argmax(axis=2)
        full = real[s:e] == STEPS
        sums = np.empty((e - s, p.shape[2]), F32)
        sums[full] = p[:, full].sum(axis=0)
        for i in np.flatnonzero(~full):
            sums[i] = p[: real[s + i], i].sum(axis=0)
        for c in range(p.shape[2]):
            total[:, c] += np.bincount(owner[s:e], sums[:, c], len(texts))
    total /= np.maximum(1, [len(t) for t in raw])[:, None]
    if labels is None:
        return total, None
    runs, flat, at = [], labels.T.reshape(-1), 0
    for t in raw:
        own = flat[at : at + len(t)]
        cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(t)] if len(t) else []
        runs.append([(a, b, network.classes[own[a]]) for a, b in zip(cuts, cuts[1:])])
        at += -(-len(t) // STEPS) * STEPS
    return total, runs


def identify(df: DataFrame, network: Network | None, *, text: str = "text", keep: list[str] | None = None, spans: bool = False) -> DataFrame:
    """Adds `lang_pred`, `score` (the document probability of lang_pred) and, if asked for, `lang_spans`.

    A null text, or one without a letter, is `und` with score 0; so is every text if nothing could be
    learned. Ties go to the first language by name. `lang_spans` are (start, stop, lang) in bytes.
    """

    def make():
        def work(texts: list[str]) -> list:
            found: list = [[], [], []]
            total, runs = classify(network, texts, spans) if network else (None, None)
            for i, t in enumerate(texts):
                known = network is not None and _LETTER.search(t) is not None
                best = int(total[i].argmax()) if known else -1
                found[0].append(network.classes[best] if known else UNKNOWN)
                found[1].append(min(1.0, max(0.0, float(total[i][best]))) if known else 0.0)
                found[2].append([dict(zip(("start", "stop", "lang"), r)) for r in runs[i]] if runs else [])
            return [pa.array(found[0]), pa.array(found[1], pa.float64()), *([found[2]] if spans else [])]

        return work

    return add_columns(df, make, "lang_pred string, score double" + ", lang_spans array<struct<start:int,stop:int,lang:string>>" * spans, text=text, keep=keep)
