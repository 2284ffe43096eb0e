"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact verification.

Words are runs of word characters in lower case. An item's shingles are its runs of five words (the
whole item if it is shorter), and so are those of a window with as many words. A text with fewer words
than the item is one window as a whole, with runs as long as the item's; it is compared with every item
that shares enough of them, without fingerprints. Similarity is the weighted Jaccard index: the sum over
shingles of the lesser count by that of the greater.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import chain, repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.llm.common import add_columns

SHINGLE = 5
SIMILARITY = 0.8

#: Fingerprints have BITS bits. Of windows of similarity 0.8, which share eight ninths of their shingles,
#: 39 bits differ on average, with a standard deviation of 6; of unlike ones about half.
BITS = 256
RADIUS = 63

#: Within RADIUS bits one of the 16-bit blocks differs in at most RADIUS // (BITS // 16) bits, which are
#: dealt to both sides: values near an item's block are stored, values near a window's are looked up.
STORED_NEAR = 1

#: Text of benchmark items that one pass over the documents looks for; more items take more passes.
PASS_BYTES = 16 << 20

WORDS = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
LEAK = "array<struct<item_id:bigint,similarity:double,start:int,stop:int>>"


def _words(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def _word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))


def _runs_at(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit name of the run of `size` codes from each start."""
    out = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = (out ^ codes[starts + k]) * _MIX
            out ^= out >> np.uint64(29)
    return out


def _runs(codes: np.ndarray, size: int) -> np.ndarray:
    return _runs_at(codes, np.arange(max(0, len(codes) - size + 1)), size)


def _needed(shingles: int, others: int, similarity: float) -> int:
    """Least number of shared shingles of two runs with so many each and that similarity."""
    return math.ceil(similarity * (shingles + others) / (1 + similarity) - 1e-9)


def _fingerprints(names: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of `size` shingles from each start, in words of 64 bits, from running sums of their bits."""
    out = np.empty((len(starts), BITS // 64), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(BITS // 64):
            names = (names ^ (names >> np.uint64(31))) * _MIX  # the next 64 bits of every name
            bits = np.unpackbits(names.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)
            sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
            ones = sums[starts + size] - sums[starts]
            out[:, k] = np.packbits(2 * ones > size, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _near(bits: int) -> np.ndarray:
    """The 16-bit masks with at most so many bits."""
    masks = np.arange(1 << 16, dtype=np.uint16)
    return masks[np.bitwise_count(masks) <= bits]


class BlockIndex:
    """Multi-index of fingerprints: all within the radius of a given one share a block nearly with it.

    Each block has a sorted table of the values within STORED_NEAR bits of an item's; a window looks up
    the values within the remaining bits of its own. Distances are computed for pairs that meet there.
    """

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        self.blocks = prints.shape[1] * 4
        near = radius // self.blocks
        self.stored, self.sought = _near(min(STORED_NEAR, near)), _near(max(0, near - STORED_NEAR))
        halves = prints.view(np.uint16)
        self.tables = []
        for b in range(self.blocks):
            keys = (halves[:, b, None] ^ self.stored).ravel()
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], (order // len(self.stored)).astype(np.int32)))
        self.distances = 0  # how many were computed

    def met(self, prints: np.ndarray) -> np.ndarray:
        """Pairs (window, item) that share a block nearly, as window * items + item."""
        halves, found = prints.view(np.uint16), []
        for b, (keys, items) in enumerate(self.tables):
            wanted = (halves[:, b, None] ^ self.sought).ravel()
            low, high = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, side="right")
            each = high - low
            at = np.flatnonzero(each)
            each = each[at]
            place = np.repeat(low[at], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            window = np.repeat(at // len(self.sought), each)
            found.append(np.unique(window * len(self.prints) + items[place]))
        return np.unique(np.concatenate(found))

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) positions whose fingerprints are within the radius."""
        out = [], []
        step = max(1, (1 << 21) // (len(self.prints) + len(self.sought)))
        for at in range(0, len(prints), step):
            window, item = np.divmod(self.met(prints[at : at + step]), len(self.prints))
            self.distances += len(window)
            apart = np.bitwise_count(prints[at + window] ^ self.prints[item]).sum(axis=1, dtype=np.int64)
            near = apart <= self.radius
            out[0].append(at + window[near])
            out[1].append(item[near])
        return tuple(np.concatenate(x) for x in out)


class Benchmark:
    """Items by number of words, with their shingle counts, fingerprints and block index."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, radius: int = RADIUS):
        self.similarity, self.radius = similarity, radius
        self.hash: dict[str, int] = {}
        self.classes: dict[tuple[int, int], list] = {}
        for item, text in items:
            words = _words(text or "")
            if not words:
                continue
            size = min(SHINGLE, len(words))
            codes = np.array([self.hash.setdefault(w, _word_hash(w)) for w in words], np.uint64)
            self.classes.setdefault((len(words), size), []).append((item, _runs(codes, size)))
        self.sizes = sorted({s for _, s in self.classes})
        self.index = {}
        self.owners: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}  # shingles and the members that have them
        for (n, size), members in self.classes.items():
            count = n - size + 1
            prints = np.concatenate([_fingerprints(r, np.array([0]), count) for _, r in members])
            self.index[n, size] = (count, np.unique(np.concatenate([r for _, r in members])), BlockIndex(prints, radius), [(i, Counter(r.tolist())) for i, r in members])
            names, owners = np.concatenate([r for _, r in members]), np.repeat(np.arange(len(members), dtype=np.int32), count)
            order = np.lexsort((owners, names))
            names, owners = names[order], owners[order]
            first = np.r_[True, (names[1:] != names[:-1]) | (owners[1:] != owners[:-1])]
            self.owners[n, size] = names[first], owners[first]
        self.place = {w: k for k, w in enumerate(self.hash, 1)}
        self.codes = np.array([0, *self.hash.values()], np.uint64)
        self.known = {s: np.unique(np.concatenate([r for (_, z), m in self.classes.items() if z == s for _, r in m])) for s in self.sizes}

    def search_all(self, texts: list[str]) -> list[list[tuple[int, float, int, int]]]:
        """search() of each text, for the texts that share a shingle with an item; others cannot resemble any."""
        get, out = self.place.get, [[] for _ in texts]
        words = [_words(t) for t in texts]
        ends = np.cumsum([len(w) + 1 for w in words])
        at = np.fromiter(chain.from_iterable(chain(map(get, w, repeat(0)), (0,)) for w in words), np.int32, int(ends[-1]) if len(ends) else 0)
        unknown = np.concatenate([[0], np.cumsum(at == 0)])
        found = set()
        for size in self.sizes:
            whole = np.flatnonzero(unknown[size:] == unknown[:-size])
            names = _runs_at(self.codes[at], whole, size)
            known = self.known[size]
            hit = known[np.minimum(np.searchsorted(known, names), len(known) - 1)] == names
            found.update(np.unique(np.searchsorted(ends, whole[hit], side="right")).tolist())
        for k in found:
            out[k] = self.search(texts[k])
        return out

    def whole(self, names: np.ndarray, n: int, size: int) -> list[tuple[int, float]]:
        """(item, similarity) of items of n words that a text of fewer words, with these shingles, resembles."""
        count, _, _, members = self.index[n, size]
        least, (known, owners) = _needed(count, len(names), self.similarity), self.owners[n, size]
        start, stop = np.searchsorted(known, names), np.searchsorted(known, names, side="right")
        most = np.zeros(len(members), np.int64)  # shared shingles are at most the text's that the item has
        for a, b in zip(start.tolist(), stop.tolist()):
            most[owners[a:b]] += 1
        own, out = Counter(names.tolist()), []
        for j in np.flatnonzero(most >= least).tolist():
            item, weights = members[j]
            shared = sum((own & weights).values())
            like = shared / (count + len(names) - shared)
            if like >= self.similarity:
                out.append((item, like))
        return out

    def search(self, text: str) -> list[tuple[int, float, int, int]]:
        """(item, similarity, start, stop) of the best window of each item found, in characters."""
        words = _words(text)
        get = self.hash.get
        codes = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        best: dict[int, tuple[float, int, int]] = {}
        full = None
        for size in self.sizes:
            if len(words) < size:
                continue
            zero = np.concatenate([[0], np.cumsum(codes == 0)])
            whole = np.flatnonzero(zero[size:] == zero[:-size])  # runs of benchmark words only
            names = _runs(codes, size)
            hits = whole[np.isin(names[whole], self.known[size])]
            if not len(hits):
                continue
            for (n, z), (count, own, near, members) in self.index.items():
                least = _needed(count, min(count, len(names)), self.similarity)
                if z != size or len(hits) < least:
                    continue
                mine = hits[np.isin(names[hits], own)]
                if len(mine) < least:
                    continue
                if len(words) < n:
                    for item, like in self.whole(names, n, size):
                        if item not in best or (like, 0) > (best[item][0], -best[item][1]):
                            best[item] = (like, 0, len(words))
                    continue
                # Windows with enough shared shingles: exact, as fewer cannot reach the similarity.
                here = np.unique((mine[:, None] - np.arange(count)).ravel()) if count < 4096 else np.arange(mine[0] - count + 1, mine[-1] + 1)
                here = here[(here >= 0) & (here + n <= len(words))]
                here = here[np.searchsorted(mine, here + count) - np.searchsorted(mine, here) >= least]
                if not len(here):
                    continue
                if full is None:
                    full = np.fromiter((c or _word_hash(w) for w, c in zip(words, codes.tolist())), np.uint64, len(words))
                spread = _runs(full[here[0] : here[-1] + n], size)
                for block in range(0, len(here), 4096):
                    part = here[block : block + 4096]
                    low = part[0] - here[0]
                    local = spread[low : part[-1] - here[0] + count]
                    w, m = near.within(_fingerprints(local, part - part[0], count))
                    for i, j in zip(w.tolist(), m.tolist()):
                        item, weights = members[j]
                        at = int(part[i])
                        shared = sum((Counter(local[at - part[0] : at - part[0] + count].tolist()) & weights).values())
                        like = shared / (2 * count - shared)
                        if like >= self.similarity and (item not in best or (like, -at) > (best[item][0], -best[item][1])):
                            best[item] = (like, at, at + n)
        if not best:
            return []
        spans = [m.span() for m in WORDS.finditer(text.lower())]
        if len(text.lower()) != len(text):  # lowering has moved characters: count them up
            ends = np.cumsum([len(c.lower()) for c in text]).tolist()
            spans = [(bisect_right(ends, a), bisect_right(ends, b - 1) + 1) for a, b in spans]
        return sorted((item, like, spans[a][0], spans[b - 1][1]) for item, (like, a, b) in best.items())


def with_leaks(df: DataFrame, benchmark: DataFrame, *, item: str = "item_id", item_text: str = "text", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `leaks`: for each benchmark item that a window of the text resembles, its best window.

    Each is (item_id, similarity, start, stop) with code point positions, by item. Null and empty texts
    and texts without words have none, nor do such items; items with a null id are found as null.
    The items are a query set: they are read in passes of at most PASS_BYTES of text each, and each
    pass goes over all documents.
    """
    items = benchmark.select(F.col(item).cast("long").alias("id"), F.col(item_text).cast("string").alias("item"))
    passes = max(1, math.ceil((items.agg(F.sum(F.octet_length("item"))).first()[0] or 0) / PASS_BYTES))
    out, parts = df, []
    for k in range(passes):
        found = [(r["id"], r["item"]) for r in items.where(F.pmod(F.xxhash64("id", "item"), F.lit(passes)) == k).collect()]
        column = "leaks" if passes == 1 else f"__leaks{k}"
        parts.append(column)

        def make(found=found):
            search = Benchmark(found).search_all

            def work(texts: list[str]) -> list:
                return [[[dict(zip(("item_id", "similarity", "start", "stop"), x)) for x in leaks] for leaks in search(texts)]]

            return work

        kept = [*keep, *parts] if keep is not None and k == passes - 1 else None
        out = add_columns(out, make, f"{column} {LEAK}", text=text, keep=kept)
    if passes > 1:
        out = out.withColumn("leaks", F.array_sort(F.concat(*parts))).drop(*parts)
    return out
