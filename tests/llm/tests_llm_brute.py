"""Brute-force versions that several tests of the text operators compare with."""

import re
from collections import Counter

import xxhash

from logpulse.llm.common import ascii_lower


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, linked=lambda a, b: (a ^ b).bit_count() <= 4):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if linked(prints[i], prints[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def five_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def similar_groups(texts, similarity=0.8):
    """The least id reachable over texts whose sets of five-word shingles are this similar."""
    sets = {i: five_words(t) or {""} for i, t in texts.items()}
    return brute_components(sets, lambda a, b: len(a & b) >= similarity * len(a | b))


def brute_wide(text):
    """512 bits: the majority of eight SplitMix64 streams over the hashes of distinct five-word shingles."""
    full, out = 2**64 - 1, 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in five_words(text)]
    for stream in range(8):
        ones = [0] * 64
        for x in hashes:
            x = (x + (stream + 1) * 0x9E3779B97F4A7C15) & full
            x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & full
            x = ((x ^ x >> 27) * 0x94D049BB133111EB) & full
            for bit, one in enumerate(f"{x ^ x >> 31:064b}"):
                ones[63 - bit] += one == "1"
        out |= sum(1 << (stream * 64 + b) for b in range(64) if 2 * ones[b] > len(hashes))
    return out


def wide_groups(texts, radius=90):
    return brute_components({i: brute_wide(t) for i, t in texts.items()}, lambda a, b: (a ^ b).bit_count() <= radius)


WORDS = re.compile(r"\w+")


def bag(words):
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_leaks(text, items):
    """Best similarity of each item over all windows of as many words."""
    words = WORDS.findall((text or "").lower())
    best = {}
    for item, own in items:
        own = WORDS.findall((own or "").lower())
        if not own or len(own) > len(words):
            continue
        want = bag(own)
        known = set(want)
        near = [any(tuple(words[i : i + min(5, len(own))]) == k for k in known) for i in range(len(words))]
        for s in range(len(words) - len(own) + 1):
            if any(near[s : s + len(own)]):
                got = bag(words[s : s + len(own)])
                like = sum((got & want).values()) / sum((got | want).values())
                if like >= 0.8:
                    best[item] = max(best.get(item, 0), like)
    return best
