"""Main text of HTML pages: a bidirectional LSTM labels the blocks of a page in context.

Each block is read as vectors of its tag path and of its hashed words, both learned, with a few
measures. The network is trained in numpy on a bounded sample of pages whose markup says where the
article is; in part of them the path is hidden, so that words, measures and neighbours count too.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.llm.common import add_columns
from logpulse.llm.html_blocks import Leaf, leaves

HIDDEN, PATH, WORD = 12, 12, 8
BUCKETS = 1024
#: Ancestors that the path vector covers, from the block outwards.
ANCESTORS = 24
#: Pages that the network is fitted on, and the longest page among them in characters.
PAGES, LONGEST = 300, 200_000
MEASURES = 7
#: Pages that are read side by side, and their blocks with padding; a longer page is read by itself.
LANES, CELLS = 256, 1 << 17

# Words in tags, classes and ids that set a part of a page apart from its article.
ASIDE = frozenset("nav aside footer form dialog menu ad ads adv advert advertisement advertising banner promo sponsor sponsored cookie cookies consent notice notices alert newsletter subscribe sidebar breadcrumb breadcrumbs comment comments respond reply replies share social related recommended pagination skip toolbar login signup search button select option".split())


def teacher(path: tuple[tuple[str, ...], ...]) -> bool:
    """Whether markup says that a block is of the article: inside article or main, and not set apart there."""
    inside = next((k for k, names in enumerate(path) if names[0] in ("article", "main") or "main" in names[1:]), None)
    return inside is not None and not any(w in ASIDE for names in path for w in names)


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS


class Pages:
    """Blocks of pages as features: path and word buckets (flat, with starts), measures, page ends."""

    def __init__(self, pages: list[list[Leaf]], hide: np.ndarray | None = None):
        names: dict[str, int] = {}
        words: dict[str, int] = {}
        seen: dict[tuple, list[int]] = {}
        path, path_n, word, word_n, measures = [], [], [], [], []
        for k, page in enumerate(pages):
            for n, leaf in enumerate(page):
                own = leaf.path[-ANCESTORS:]
                if own not in seen:
                    flat = [w for element in own for w in (element[0], *("." + x for x in element[1:]))]
                    flat += [f"{a[0]}>{b[0]}" for a, b in zip(own[-3:], own[-2:])]
                    seen[own] = [names.setdefault(x, _bucket(x)) for x in flat] or [0]
                ids = [0] if hide is not None and hide[k] else seen[own]
                path += ids
                path_n.append(len(ids))
                found = leaf.text.split(" ")
                word += [words[w] if w in words else words.setdefault(w, _bucket(w)) for w in found]
                word_n.append(len(found))
                size = len(leaf.text)
                measures.append((np.log1p(size) / 5, np.log1p(len(found)) / 4, min(1.0, leaf.linked / size), leaf.text[-1] in ".!?…", n / len(page), 1 / (1 + n), 1 / (len(page) - n)))
        self.path, self.path_at = np.array(path, np.int64), np.concatenate([[0], np.cumsum(path_n)]).astype(np.int64)
        self.word, self.word_at = np.array(word, np.int64), np.concatenate([[0], np.cumsum(word_n)]).astype(np.int64)
        self.measures = np.array(measures, np.float32).reshape(-1, MEASURES)
        self.sizes = np.array([len(p) for p in pages], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes


def _means(table: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean vector of each run of ids; every run has at least one."""
    out, n = np.empty((len(at) - 1, table.shape[1]), table.dtype), np.diff(at)[:, None]
    for s in range(0, len(at) - 1, 4096):
        e = min(s + 4096, len(at) - 1)
        out[s:e] = np.add.reduceat(table[ids[at[s] : at[e]]], at[s:e] - at[s], axis=0)
    return out / n


class Lstm:
    """One direction: gates in, forget, out and candidate, from the input, the last state and a bias."""

    def __init__(self, rng: np.random.Generator, inputs: int, hidden: int):
        self.w = rng.normal(0, 0.3 / np.sqrt(inputs + hidden), (inputs + hidden + 1, 4 * hidden))
        self.w[-1, hidden : 2 * hidden] = 1.0
        self.hidden = hidden

    def run(self, x: np.ndarray, real: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States (T, B, H); a lane keeps its state where it has no block."""
        h = c = np.zeros((x.shape[1], self.hidden))
        out = np.empty((*x.shape[:2], self.hidden))
        given = x @ self.w[: x.shape[2]] + self.w[-1]
        inner = self.w[x.shape[2] : -1]
        n = self.hidden
        for t in range(len(x)):
            a = given[t] + h @ inner
            gates = 1 / (1 + np.exp(-a[:, : 3 * n]))
            new = np.tanh(a[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            c2 = f * c + i * new
            s = np.tanh(c2)
            m = real[t][:, None]
            h2 = m * (o * s) + (1 - m) * h
            c2 = m * c2 + (1 - m) * c
            if trace is not None:
                trace.append((h, c, gates, new, s, m))
            h, c = h2, c2
            out[t] = h
        return out

    def back(self, x: np.ndarray, trace: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the weights and of the inputs."""
        n, k = self.hidden, x.shape[2]
        inner, d_inner = self.w[k:-1], np.zeros((n, 4 * n))
        dh, dc = np.zeros((x.shape[1], n)), np.zeros((x.shape[1], n))
        d_gates = np.empty((*x.shape[:2], 4 * n))
        for t in reversed(range(len(x))):
            h, c, gates, new, s, m = trace[t]
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            dh = dh + d_out[t]
            own, d_c = dh * m, dc * m + dh * m * o * (1 - s * s)
            da = np.concatenate([d_c * new * i * (1 - i), d_c * c * f * (1 - f), own * s * o * (1 - o), d_c * i * (1 - new * new)], axis=1)
            d_gates[t] = da
            d_inner += h.T @ da
            dh, dc = dh * (1 - m) + da @ inner.T, dc * (1 - m) + d_c * f
        flat = d_gates.reshape(-1, 4 * n)
        return np.concatenate([x.reshape(-1, k).T @ flat, d_inner, flat.sum(axis=0, keepdims=True)]), d_gates @ self.w[:k].T


def lane_groups(sizes: np.ndarray, order: np.ndarray) -> list[np.ndarray]:
    """Pages, given by rising size, in groups of at most LANES pages and CELLS blocks, padded to the longest."""
    groups, start = [], 0
    for k in range(1, len(order) + 1):
        if k == len(order) or k - start == LANES or (k + 1 - start) * int(sizes[order[k]]) > CELLS:
            groups.append(order[start:k])
            start = k
    return groups


class Labeller:
    def __init__(self, seed: int = 10):
        rng = np.random.default_rng(seed)
        self.path, self.word = rng.normal(0, 0.3, (BUCKETS, PATH)), rng.normal(0, 0.1, (BUCKETS, WORD))
        self.forth, self.back = (Lstm(rng, PATH + WORD + MEASURES, HIDDEN) for _ in range(2))
        self.out = rng.normal(0, 0.2, 2 * HIDDEN + 1)

    def parameters(self) -> list[np.ndarray]:
        return [self.path, self.word, self.forth.w, self.back.w, self.out]

    def _inputs(self, pages: Pages) -> np.ndarray:
        return np.concatenate([_means(self.path, pages.path, pages.path_at), _means(self.word, pages.word, pages.word_at), pages.measures], axis=1)

    @staticmethod
    def _lanes(pages: Pages, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block numbers (T, B) of these pages, and which of them are real."""
        steps = np.arange(pages.sizes[which].max(initial=0))[:, None]
        real = steps < pages.sizes[which]
        return np.where(real, pages.starts[which] + steps, 0), real.astype(float)

    def probabilities(self, pages: Pages) -> np.ndarray:
        """Of every block: whether it is main text."""
        inputs, out = self._inputs(pages), np.zeros(int(pages.sizes.sum()))
        order = np.argsort(pages.sizes, kind="stable")
        order = order[pages.sizes[order] > 0]
        for which in lane_groups(pages.sizes, order):
            at, real = self._lanes(pages, which)
            x = inputs[at]
            a, b = self.forth.run(x, real), self.back.run(x[::-1], real[::-1])[::-1]
            score = np.concatenate([a, b], axis=2) @ self.out[:-1] + self.out[-1]
            out[at[real > 0]] = 1 / (1 + np.exp(-np.clip(score[real > 0], -30, 30)))
        return out

    def gradients(self, pages: Pages, which: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        at, real = self._lanes(pages, which)
        x = self._inputs(pages)[at]
        traces: tuple[list, list] = ([], [])
        a, b = self.forth.run(x, real, traces[0]), self.back.run(x[::-1], real[::-1], traces[1])[::-1]
        states, n = np.concatenate([a, b, np.ones((*real.shape, 1))], axis=2), real.sum()
        p, y = 1 / (1 + np.exp(-np.clip(states @ self.out, -30, 30))), labels[at]
        loss = -(real * (y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12))).sum() / n
        d = real * (p - y) / n
        d_states = d[..., None] * self.out[:-1]
        wf, xf = self.forth.back(x, traces[0], d_states[..., :HIDDEN])
        wb, xb = self.back.back(x[::-1], traces[1], d_states[::-1, :, HIDDEN:])
        dx = np.zeros((len(pages.path_at) - 1, x.shape[2]))
        np.add.at(dx, at[real > 0], (xf + xb[::-1])[real > 0])
        grads = []
        for table, ids, ends, part in ((self.path, pages.path, pages.path_at, dx[:, :PATH]), (self.word, pages.word, pages.word_at, dx[:, PATH : PATH + WORD])):
            n_ids = np.diff(ends)
            g = np.zeros_like(table)
            for c in range(table.shape[1]):
                g[:, c] = np.bincount(ids, np.repeat(part[:, c] / n_ids, n_ids), BUCKETS)
            grads.append(g)
        return float(loss), [*grads, wf, wb, np.tensordot(d, states, axes=([0, 1], [0, 1]))]

    def fit(self, examples: list[list[Leaf]], *, rounds: int = 12, batch: int = 24, rate: float = 0.02, hidden_paths: float = 0.25, seed: int = 9) -> Labeller:
        rng, params = np.random.default_rng(seed), self.parameters()
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(rounds):
            order = rng.permutation(len(examples))
            for s in range(0, len(order), batch):
                own = [examples[i] for i in order[s : s + batch]]
                labels = np.array([teacher(leaf.path) for page in own for leaf in page], float)
                pages = Pages(own, rng.random(len(own)) < hidden_paths)
                _, grads = self.gradients(pages, np.arange(len(own)), labels)
                step += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self


def train(df: DataFrame, *, markup: str = "html", pages: int = PAGES) -> Labeller | None:
    """A labeller fitted on at most `pages` pages with an article or main element; None if there are none."""
    fit = df.select(F.col(markup).cast("string").alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]") & (F.length("html") <= LONGEST))
    n = fit.count()
    if not n:
        return None
    scale = 1 << 20
    drawn = fit.where(F.pmod(F.xxhash64("html"), F.lit(scale)) < -(-2 * scale * pages // n)).limit(pages).collect()
    examples = [x for x in (leaves(h) for h in sorted(r["html"] for r in drawn)) if x]
    return Labeller().fit(examples) if examples else None


def main_text(df: DataFrame, labeller: Labeller | None, *, markup: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Adds `text`: the blocks of the main text in page order, joined by an empty line; empty if none.

    A null or empty page, or one without text, has an empty text. Without a labeller the markup alone
    decides, and on pages without article or main elements all that is not set apart is main text.
    """

    def make():
        def work(texts: list[str]) -> list:
            blocks = [leaves(t) for t in texts]
            if labeller is None:
                told = [[teacher(x.path) for x in page] for page in blocks]
                chosen = [t if any(t) else [not any(w in ASIDE for names in x.path for w in names) for x in page] for t, page in zip(told, blocks)]
            else:
                pages = Pages(blocks)
                main = labeller.probabilities(pages) >= 0.5
                chosen = [main[s : s + n] for s, n in zip(pages.starts, pages.sizes)]
            return [["\n\n".join(x.text for x, use in zip(page, own) if use) for page, own in zip(blocks, chosen)]]

        return work

    return add_columns(df, make, "text string", text=markup, keep=keep)
