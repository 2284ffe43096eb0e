"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate; the L1 term keeps most weights at exactly zero, so the
model that tasks receive is a short list of (bucket, weight), at most 2**BITS of them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.llm.common import add_columns
from logpulse.llm.sampling import labelled_sample

BITS = 20
#: Labelled texts of each label that the model is fitted on, and the characters read of each.
PER_LABEL, CHARS = 2_500, 20_000
#: Buckets that fewer training texts have, or a greater share of them, are not learned from: the
#: former identify texts, the latter are in most.
MOST_SHARE = 0.2
LEAST_TEXTS = 4
THRESHOLD = 0.3
_WORD = re.compile(r"\w+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket), once each, of words, word stems (4 and 5 letters), pairs and pairs with a gap.

    Rows are in order of text. The words of two texts never form a pair. Buckets that are not
    `wanted` (those without a weight) are left out.
    """
    known: dict[str, int] = {}
    words, sizes = [], []
    for t in texts:
        own = _WORD.findall(t.lower())
        sizes.append(len(own))
        words.extend([known.setdefault(w, len(known)) for w in own])
    digest = xxhash.xxh64_intdigest
    forms = np.array([(digest(w), digest("4" + w[:4]), digest("5" + w[:5])) for w in known], np.uint64).reshape(-1, 3)
    at, owner = np.array(words, np.int64), np.repeat(np.arange(len(texts)), sizes)
    shift = np.uint64(64 - BITS)
    forms *= _ODD[:3]
    names, owners = [], []

    def add(name: np.ndarray, of: np.ndarray) -> None:
        name = (name >> shift).astype(np.int64)
        if wanted is not None:
            use = wanted[name]
            name, of = name[use], of[use]
        names.append(name)
        owners.append(of)

    for k in range(3):
        add(forms[at, k], owner)
    h = forms[at, 0]
    for gap, (a, b) in ((1, _ODD[:2]), (2, _ODD[3:])):
        same = owner[gap:] == owner[:-gap]
        add((h[:-gap] * a + h[gap:] * b)[same], owner[gap:][same])
    both = np.unique(np.concatenate(owners) << BITS | np.concatenate(names))
    return both >> BITS, both & ((1 << BITS) - 1)


class Ftrl:
    """Weights of buckets, and a bias without L1."""

    def __init__(self, *, rate: float = 0.6, beta: float = 1.0, l1: float = 3.0, l2: float = 0.5):
        self.rate, self.beta, self.l1, self.l2 = rate, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == len(self.z) - 1, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.rate + self.l2))

    def update(self, buckets: np.ndarray, label: int, weight: float) -> None:
        at = np.append(buckets, len(self.z) - 1)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label) * weight
        moved = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.rate
        self.z[at] += g - moved * w
        self.n[at] += g * g

    def fit(self, texts: list[str], labels: list[int], importance: dict[int, float], *, rounds: int = 7, seed: int = 3) -> Ftrl:
        own, having = [], np.zeros(1 << BITS, np.int32)
        for start in range(0, len(texts), 64):  # few texts at a time: their pairs take much more room than they do
            part = texts[start : start + 64]
            owner, bucket = features(part)
            having += np.bincount(bucket, minlength=1 << BITS).astype(np.int32)
            own += np.split(bucket.astype(np.int32), np.searchsorted(owner, np.arange(1, len(part))))
        use = (having >= LEAST_TEXTS) & (having <= MOST_SHARE * len(texts))
        own = [x[use[x]] for x in own]
        rng = np.random.default_rng(seed)
        for _ in range(rounds):
            for i in rng.permutation(len(texts)).tolist():
                self.update(own[i], labels[i], importance[labels[i]])
        return self

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets with a weight other than zero, and the weights; the last bucket is the bias."""
        w = self.weights(np.arange(len(self.z)))
        at = np.flatnonzero(w)
        return at.astype(np.int32), w[at].astype(np.float32)


def train(df: DataFrame, labels: DataFrame, *, label: str = "toxic", key: str = "doc_id", text: str = "text", per_label: int = PER_LABEL) -> tuple[np.ndarray, np.ndarray]:
    """Compact weights from a bounded sample of the documents with a label (0 or 1; of several, the greatest).

    Ids are drawn first, at most 4 x `per_label` of each label, so that only their texts are read: the
    broadcast side of the join is that bounded list. Without any labelled text all scores are one half.
    """
    own = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("__label"))
    counts = {r["__label"]: r["count"] for r in own.groupBy("__label").count().collect()}
    scale = 1 << 20
    share = F.coalesce(*(F.when(F.col("__label") == x, F.lit(min(scale, -(-2 * scale * per_label // n)))) for x, n in counts.items()), F.lit(0))
    drawn = own.where(F.pmod(F.xxhash64(key), F.lit(scale)) < share).limit(4 * per_label * max(1, len(counts))).withColumnRenamed(key, "__key")
    rows = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(drawn), "__key")
    sample = labelled_sample(rows, "__label", "__text", per_label, salt=3, chars=CHARS, key="__key")
    texts = [(t, n) for n, own_texts in sorted(sample.texts.items()) for t in own_texts[:per_label]]
    total = sum(counts.values())
    importance = {n: counts[n] / total * len(texts) / len(own_texts[:per_label]) for n, own_texts in sample.texts.items()}
    return Ftrl().fit([t for t, _ in texts], [n for _, n in texts], importance).compact()


def toxicity(df: DataFrame, model: tuple[np.ndarray, np.ndarray], *, threshold: float = THRESHOLD, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `score` (probability that the label is 1) and `predicted` (1 if it is at least `threshold`).

    Null and empty texts have the score of the bias alone.
    """

    def make():
        weights = np.zeros((1 << BITS) + 1, np.float32)
        weights[model[0]] = model[1]

        def work(texts: list[str]) -> list:
            owner, bucket = features(texts, weights != 0)
            total = np.bincount(owner, weights[bucket], len(texts)) + weights[-1]
            score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            return [pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))]

        return work

    return add_columns(df, make, "score double, predicted int", text=text, keep=keep)
