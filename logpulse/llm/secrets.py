"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds to them.

The field tags tokens as begin, inside or outside of a secret, from the token's shape, the shapes of
the tokens around it and the words among them (hashed), and features of the whole text, decoded by Viterbi. It is trained in numpy on a bounded
sample whose tags come from the fixed patterns; in part of the training windows the neighbours are
hidden, so that it also learns what a secret looks like by itself.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logpulse.llm.common import Memo, add_columns, quoted, stored
from logpulse.llm.sampling import labelled_sample

# The patterns of the base kinds and the least lengths, in the order of the kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "model")

_ASSIGN, _ACCESS = re.compile(ASSIGN, re.ASCII), re.compile(ACCESS)
_HEX = re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"])  # runs are maximal, so a bound below is a filter
TOKEN = re.compile(r"\w[\w+/.\-]*|[^\w\s]")
SPAN = "array<struct<kind:string,start:int,stop:int>>"
#: Texts with and without a base span that the field is fitted on, and the characters read of each.
PER_LABEL, CHARS = 1_500, 20_000
#: Texts, about, among which those without a base span are drawn; those with one are sought in all rows.
POOL = 30_000
MASK = "[SECRET]"
B, I, O = 0, 1, 2  # noqa: E741


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, stop, start of the secret itself), leftmost and not overlapping within a kind."""
    out = [("assign", m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [("access", m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    return out + [("hex", m.start(), m.end(), m.start()) for m in _HEX.finditer(text)]


# Groups of tokens; a token's class is its group with buckets of length and entropy.
NONE, EQUALS, COLON, QUOTE, PUNCTUATION, LOWER, TITLE, NUMBER, MIXED, LONG, HEXADECIMAL, CAPITALS, SYMBOLS, FIGURES = range(14)
GROUPS, BUCKETS = 14, 48
CLASSES = GROUPS * BUCKETS
#: Buckets of words; bucket 0 is no word.
WORDS = 4096
_PUNCTUATION = {"=": EQUALS, ":": COLON, '"': QUOTE, "'": QUOTE}


def token_group(token: str) -> int:
    if token.isalpha():
        return LOWER if token.islower() else TITLE
    if not (token[0].isalnum() or token[0] == "_"):
        return _PUNCTUATION.get(token, PUNCTUATION)
    if token.isdigit():
        return NUMBER if len(token) < LEAST["hex"] else HEXADECIMAL
    n = len(token)
    if n >= LEAST["hex"] and re.fullmatch(r"[0-9a-f]+", token):
        return HEXADECIMAL
    digits = sum(c.isdigit() for c in token)
    if digits and not any(c.isalpha() for c in token):
        return FIGURES
    if n >= 16 and digits and token.isalnum() and token.isupper():
        return CAPITALS
    if n >= 12 and digits:
        return LONG if token.isalnum() else SYMBOLS
    return MIXED


def token_class(token: str) -> int:
    """Words shorter than 12 letters and punctuation have no bucket of entropy."""
    n, group = len(token), token_group(token)
    if n < 12 and group < NUMBER:
        return group * BUCKETS + min(7, n.bit_length()) * 6
    counts = Counter(token).values()
    entropy = -sum(c / n * math.log2(c / n) for c in counts) if n < 200 else 5.0
    return group * BUCKETS + min(7, n.bit_length()) * 6 + min(5, int(entropy))


def token_code(token: str) -> int:
    """The token's class, and its bucket as a word if it has two letters and no digit: word * CLASSES + class."""
    word = 0
    if 1 < len(token) <= 32 and not any(c.isdigit() for c in token) and (token[0].isalpha() or token[0] == "_"):
        word = 1 + zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % (WORDS - 1)
    return word * CLASSES + token_class(token)


# Families of features: the token's class; groups of the four tokens before and of the one after; pair of
# groups; group with features of the text; words among the four tokens before; the word after.
_SIZES = (CLASSES, GROUPS, GROUPS, GROUPS, GROUPS, GROUPS, GROUPS * GROUPS, 16 * GROUPS, WORDS, WORDS)
_STARTS = np.cumsum([0, *_SIZES])
FEATURES = int(_STARTS[-1])
AROUND = (1, 2, 3, 4, -1)
#: The family of each column of feature ids: the words before share one.
_COLUMNS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 8, 8, 8, 9)


def text_bucket(groups: np.ndarray) -> int:
    """Shares of tokens with digits and of assignment signs in a text, in four steps each."""
    n, counts = max(1, len(groups)), np.bincount(groups, minlength=GROUPS)
    digits, signs = counts[[NUMBER, MIXED, LONG, HEXADECIMAL, CAPITALS, SYMBOLS, FIGURES]].sum() / n, counts[[EQUALS, COLON, QUOTE]].sum() / n
    return int(np.searchsorted([0.0, 0.02, 0.1], digits)) * 4 + int(np.searchsorted([0.0, 0.02, 0.1], signs))


def feature_ids(codes: np.ndarray, at: np.ndarray, bucket: int) -> np.ndarray:
    """Feature ids (positions, columns) of the tokens `at` of a text with these codes."""
    padded = np.concatenate([np.zeros(4, np.int64), codes, np.zeros(1, np.int64)])
    near = {k: padded[at + 4 - k] for k in (0, *AROUND)}
    groups = {k: x % CLASSES // BUCKETS for k, x in near.items()}
    words = [near[k] // CLASSES for k in AROUND]
    columns = [near[0] % CLASSES, *(groups[k] for k in AROUND), groups[0] * GROUPS + groups[1], groups[0] * 16 + bucket, *words]
    return np.stack([c + _STARTS[f] for c, f in zip(columns, _COLUMNS)], axis=1)


@dataclass
class Field:
    """Emission weights (features, tags) and transitions (tag, next tag)."""

    weights: np.ndarray
    moves: np.ndarray

    def __post_init__(self):
        self.moves[O, I] = -1e4  # a secret starts with its begin tag
        allowed = self.moves > -1e3
        self.gain = max(0.0, float((self.moves - self.moves[O, O])[allowed].max()))
        self.least = -(2 * self.gain + 1)
        # The most that each feature adds to a tag other than outside, by family; a hair more for rounding.
        lead = (self.weights[:, :2] - self.weights[:, O : O + 1]).max(axis=1)
        self.leads = [x.astype(np.float32) for x in np.split(lead, _STARTS[1:-1])]
        self.slack = 1e-5 * float(sum(np.abs(self.leads[f]).max() for f in _COLUMNS)) + 1e-6
        swing = [np.abs(p).max() for p in np.split(self.weights[:, I] - self.weights[:, B], _STARTS[1:-1])]
        self.apart = int(math.ceil((sum(swing[f] for f in _COLUMNS) + 4 * self.gain + np.abs(self.moves[allowed]).max() * 4) / (self.gain + 1))) + 1

    def bound(self, codes: np.ndarray, groups: np.ndarray, bucket: int) -> np.ndarray:
        """The most that each token's features can add to a tag other than outside."""
        n = len(codes)
        out = self.leads[0][codes % CLASSES] + self.leads[7][groups * 16 + bucket]
        before = np.zeros(n, np.int64)
        before[1:] = groups[:-1]
        out += self.leads[6][groups * GROUPS + before]
        words = codes // CLASSES
        earlier, later = self.leads[8][words], self.leads[9][words]
        for k in range(1, 5):
            out[k:] += self.leads[k][groups[:-k]] + earlier[:-k]
            out[:k] += self.leads[k][NONE] + self.leads[8][0]
        out[:-1] += self.leads[5][groups[1:]] + later[1:]
        out[-1:] += self.leads[5][NONE] + self.leads[9][0]
        return out

    def decode(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Token runs (first, last) of secrets on the best path.

        Only tokens that can carry another tag than outside are looked at. Tokens that lose more than
        two transitions can gain are outside unless bridged, and no path bridges `apart` of them: so
        the groups of the others are decoded one by one, each between outside tokens, exactly.
        """
        if not len(codes):
            return []
        groups = codes % CLASSES // BUCKETS
        bucket = text_bucket(groups)
        maybe = np.flatnonzero(self.bound(codes, groups, bucket) >= self.least - self.slack)
        out = []
        for group in np.split(maybe, np.flatnonzero(np.diff(maybe) > self.apart) + 1):
            if len(group):
                at = np.arange(group[0], group[-1] + 1)
                tags = viterbi(self.weights[feature_ids(codes, at, bucket)].sum(axis=1), self.moves)
                start = None
                for k, tag in enumerate([*tags, O]):
                    if tag != I and start is not None:
                        out.append((int(at[start]), int(at[k - 1])))
                        start = None
                    if tag == B:
                        start = k
        return out


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """Best tags between an outside token before and one after; ties go to the first tag."""
    state, back = moves[O] + scores[0], []
    for row in scores[1:]:
        paths = state[:, None] + moves
        back.append(paths.argmax(axis=0))
        state = paths.max(axis=0) + row
    tags = [int((state + moves[:, O]).argmax())]
    for step in reversed(back):
        tags.append(int(step[tags[-1]]))
    return tags[::-1]


def fit(features: np.ndarray, tags: np.ndarray, *, steps: int = 60, rate: float = 0.2, penalty: float = 2e-4) -> Field:
    """Maximum likelihood over windows (N, T, families), tags (N, T), by Adam on exact gradients."""
    n, length, families = features.shape
    w, m = np.zeros((FEATURES, 3)), np.zeros((3, 3))
    m[O, I] = -1e4
    flat = features.reshape(-1, families)
    gold = np.eye(3)[tags]
    moments = [[np.zeros_like(w), np.zeros_like(w)], [np.zeros_like(m), np.zeros_like(m)]]
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
    for step in range(1, steps + 1):
        e = w[flat].sum(axis=1).reshape(n, length, 3)
        a, b = np.empty((n, length, 3)), np.zeros((n, length, 3))
        a[:, 0] = e[:, 0] + m[O]
        for t in range(1, length):
            a[:, t] = np.logaddexp.reduce(a[:, t - 1, :, None] + m, axis=1) + e[:, t]
        for t in range(length - 2, -1, -1):
            b[:, t] = np.logaddexp.reduce(m + (e[:, t + 1] + b[:, t + 1])[:, None, :], axis=2)
        z = np.logaddexp.reduce(a[:, -1], axis=1)
        node = np.exp(a + b - z[:, None, None])
        moved = np.zeros((3, 3))
        for t in range(1, length):
            moved += np.exp(a[:, t - 1, :, None] + m + (e[:, t] + b[:, t])[:, None, :] - z[:, None, None]).sum(axis=0)
        d = ((node - gold) / n).reshape(-1, 3)
        gw = np.stack([sum(np.bincount(flat[:, f], d[:, y], FEATURES) for f in range(families)) for y in range(3)], axis=1) + penalty * w
        gm = (moved - gold_moves) / n + penalty * m
        gm[O, I] = 0
        for p, g, (first, second) in ((w, gw, moments[0]), (m, gm, moments[1])):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            p -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Field(w, m)


WINDOW = 24
#: Windows of each text around tokens that look like a secret and are none.
ALIKE = 1
#: Times that a text with base spans is varied, and the windows that the field is fitted on at most.
VARIANTS, WINDOWS = 3, 6_000


_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


# How an assignment may be written: the names of the fixed pattern, signs, and quotes.
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
_SIGNS = (" = ", "=", ": ", ":", " is ")
_QUOTES = ('"', "'", "")


def varied(text: str, rng: np.random.Generator, share: float) -> tuple[str, list[tuple[int, int]]]:
    """The text with a share of its base secrets replaced by random strings of other alphabets; their places.

    Half of the replaced ones are assignments then, with a random name, sign and quote and a secret
    of 8 to 24 characters, so that the words before a secret count where its shape says little.
    """
    out, places, at, length = [], [], 0, 0
    for _, first, stop, start in sorted(base_spans(text), key=lambda s: (s[1], -s[2])):
        if first < at:
            continue
        lead, secret = text[first:start], text[start:stop]
        if rng.random() < share:
            letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
            anew = rng.random() < 0.5
            secret = "x" + "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(6, 23) if anew else rng.integers(16, 44))) + "7"
            if anew:
                name, sign, quote = (x[rng.integers(len(x))] for x in (_NAMES, _SIGNS, _QUOTES))
                lead = name + sign + quote
                if sign != " is " and rng.random() < 0.3:  # letters alone
                    secret = "".join(_ALPHABETS[1][k] for k in rng.integers(0, 26, len(secret))).lower()
        out += [text[at:first], lead, secret]
        length += first - at + len(lead)
        places.append((length, length + len(secret)))
        length += len(secret)
        at = stop
    return "".join([*out, text[at:]]), places


def training_windows(texts: list[str], *, hidden: float = 0.3, share: float = 0.6, seed: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Windows of WINDOW tokens around base secrets, around tokens like them and at a random place of each text, with their tags."""
    rng = np.random.default_rng(seed)
    features, tags, memo = [], [], Memo(token_code)
    for original in (t for t in texts for _ in range(VARIANTS if base_spans(t) else 1)):
        text, secret_places = varied(original, rng, share)
        found = [m.span() for m in TOKEN.finditer(text)]
        if len(found) < WINDOW:
            continue
        starts, stops = np.array(found).T
        codes = np.array([memo[text[a:b]] for a, b in found])
        tag = np.full(len(found), O)
        for start, stop in secret_places:
            own = np.flatnonzero((starts < stop) & (stops > start))
            tag[own[:1]], tag[own[1:]] = B, I
        places = [int(p) - int(rng.integers(0, WINDOW - 4)) for p in np.flatnonzero(tag == B)[:4]]
        places.append(int(rng.integers(0, len(found) - WINDOW + 1)))
        groups = codes % CLASSES // BUCKETS
        # Other tokens with digits or signs inside, or of many letters: addresses, versions, names.
        alike = np.flatnonzero((tag == O) & ((groups > NUMBER) | (codes % BUCKETS // 6 >= 4)))
        places += [int(p) - int(rng.integers(0, WINDOW - 4)) for p in rng.permutation(alike)[:ALIKE]]
        bucket = text_bucket(groups)
        for p in places:
            at = np.arange(WINDOW) + min(max(0, p), len(found) - WINDOW)
            ids = feature_ids(codes, at, bucket)
            if rng.random() < hidden:  # neighbours unknown
                plain = np.where(np.isin(groups, (EQUALS, COLON)), PUNCTUATION * BUCKETS + 6, codes % CLASSES)
                ids = feature_ids(plain, at, bucket)
                ids[:, 0] = codes[at] % CLASSES
            features.append(ids)
            tags.append(tag[at])
    if not features:
        return np.zeros((0, WINDOW, len(_COLUMNS)), np.int64), np.zeros((0, WINDOW), np.int64)
    chosen = rng.permutation(len(features))[:WINDOWS]
    return np.stack([features[k] for k in chosen]), np.stack([tags[k] for k in chosen])


def has_base(text: Column) -> Column:
    """Whether a text has a base span; plain searches for what an assignment or access key must contain come first."""
    # An array of one, so that the text is lowered once for all five searches.
    key = F.exists(F.array(F.lower(text)), lambda low: low.contains("passw") | low.contains("secret") | low.contains("token") | (low.contains("api") & low.contains("key")))
    return (text.contains("AKIA") & text.rlike(ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4))) | text.rlike(HEX[:-1] + "{%d}" % LEAST["hex"]) | (key & text.rlike(ASSIGN[:-2] + "{%d,})" % LEAST["assign"]))


def positives(rows: DataFrame, most: int) -> list[str]:
    """Pieces, around a base span, of `most` of all texts that have one, or of all if there are fewer.

    One pass over all rows stores a hash of each such text; the texts of the smallest hashes are fetched.
    """
    place = F.xxhash64("text", F.lit(4))
    found = stored(rows.where(has_base(F.col("text"))).select(place.alias("place")).distinct(), "secrets-places")
    least = [r["place"] for r in found.orderBy("place").limit(most).collect()]
    if not least:
        return []
    first = F.least(*(F.coalesce(F.nullif(F.regexp_instr("text", F.lit(p)), F.lit(0)), F.length("text") + 1) for p in (ASSIGN[:-2] + "{%d,})" % LEAST["assign"], ACCESS[:-1] + "{%d,}" % (LEAST["access"] - 4), HEX[:-1] + "{%d}" % LEAST["hex"])))
    start = F.greatest(F.lit(1), F.least(first - CHARS // 2, F.length("text") - CHARS + 1))
    pieces = rows.where(place.isin(least)).select(place.alias("place"), F.substring("text", start, F.lit(CHARS)).alias("piece")).groupBy("place").agg(F.min("piece").alias("piece"))
    return [r["piece"] for r in sorted(pieces.collect(), key=lambda r: r["place"])]


def train(df: DataFrame, *, text: str = "text", key: str = "doc_id", per_label: int = PER_LABEL) -> Field | None:
    """A field fitted on a bounded sample of texts with and without base spans; None if no text is long enough."""
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 20)) < -(-POOL * (1 << 20) // max(1, df.count()))
    without = labelled_sample(rows.where(drawn & ~has_base(F.col("text"))).withColumn("label", F.lit(False)), "label", "text", per_label, salt=4, chars=CHARS, key="doc_id").texts
    sample = [*without.get(False, [])[:per_label], *positives(rows, per_label)]
    features, tags = training_windows(sample)
    return fit(features, tags) if len(features) else None


def find_spans(texts: list[str], field: Field | None, memo: Memo) -> list[list[tuple[str, int, int]]]:
    """Spans of each text; `memo` remembers codes of tokens."""
    out = []
    for text in texts:
        spans = [(k, a, b) for k, a, b, _ in base_spans(text)]
        if field is not None:
            tokens = TOKEN.findall(text)
            runs = field.decode(np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens)))
            if runs:
                places = [m.span() for m in TOKEN.finditer(text)]
                base = list(spans)
                for a, b in runs:
                    start, stop = places[a][0], places[b][1]
                    if not any(x <= start and stop <= y for _, x, y in base):
                        spans.append(("model", start, stop))
        out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def with_secrets(df: DataFrame, field: Field | None, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds `secrets`: (kind, start, stop) in code points, by start and then by kind as in KINDS.

    Spans of different kinds may overlap; a span of the model is left out if it lies inside one of the
    fixed patterns. Null and empty texts have none. Without a field only the fixed patterns speak.
    """

    def make():
        memo = Memo(token_code)

        def work(texts: list[str]) -> list:
            return [[[dict(zip(("kind", "start", "stop"), s)) for s in spans] for spans in find_spans(texts, field, memo)]]

        return work

    return add_columns(df, make, f"secrets {SPAN}", text=text, keep=keep)


def masked(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with each union of overlapping spans replaced by MASK."""
    out, at, open_until = [], 0, 0
    for start, stop in sorted(spans):
        if start >= open_until:
            out += [text[at:start], MASK]
        open_until = at = max(open_until, stop)
    return "".join([*out, text[at:]])


def mask_secrets(df: DataFrame, field: Field | None, *, text: str = "text") -> DataFrame:
    """The same rows and columns with the secrets in the text masked; null texts stay null."""

    def make():
        memo = Memo(token_code)

        def work(texts: list[str]) -> list:
            return [[masked(t, [(a, b) for _, a, b in spans]) for t, spans in zip(texts, find_spans(texts, field, memo))]]

        return work

    others = [c for c in df.columns if c.lower() != text.lower()]
    row = F.struct(*map(F.col, map(quoted, others))) if others else F.lit(None).cast("string")
    given = df.select(row.alias("row"), F.col(quoted(text)).isNull().alias("absent"), F.col(quoted(text)).alias("text"))
    out = add_columns(given, make, "text string", keep=["row", "absent"])
    whole = F.when(~F.col("absent"), F.col("text")).alias(text)
    return out.select(*(F.col(f"row.{quoted(c)}") if c in others else whole for c in df.columns))
