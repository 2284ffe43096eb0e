"""A byte-level BPE vocabulary read from the text of a tokenizer.json file."""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass, field
from pathlib import Path

import regex

#: Fixed value: how the byte-level pre-tokenizer splits text when its file gives no pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space as the Unicode property has it; the regex module's \s differs within sets.
_SPACE = r"\p{White_Space}"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def lower_each(text: str) -> str:
    """Lower case of each character by itself: a final sigma is lowered like any other."""
    return "σ".join(x.lower() for x in text.split("Σ"))


@dataclass
class Vocabulary:
    """Merge rules as id pairs, and the splitting that precedes them."""

    ids: dict[str, int]
    rules: dict[tuple[int, int], tuple[int, int]]  # pair -> rank, merged id
    special: dict[str, int]
    pattern: regex.Pattern
    spaced: bool  # normalise: NFC, one space for white space, lower case
    suffix: str
    joiner: str | None  # between decoded symbols; None: they spell bytes
    letters: list[str] = field(default_factory=byte_letters)

    def __post_init__(self):
        self.names = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    @classmethod
    def parse(cls, text: str) -> Vocabulary:
        j = json.loads(text)
        model, before = j["model"], j["pre_tokenizer"]
        ids = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            rules[ids[a], ids[b]] = (rank, ids[a + b])
        splits = [x["pattern"]["Regex"] for x in before.get("pretokenizers", []) if x["type"] == "Split"]
        pattern = (splits or [BYTE_LEVEL])[0].replace(r"\S", rf"[^{_SPACE}]").replace(r"\s", _SPACE)
        return cls(ids, rules, {x["content"]: x["id"] for x in j["added_tokens"]}, regex.compile(pattern), bool(j["normalizer"]), suffix, None if j["decoder"] else " ")

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        return cls.parse(Path(path).read_text(encoding="utf-8"))

    def pieces(self, text: str) -> list[tuple[int | None, str]]:
        """The text cut at special strings: (id, string) for these, (None, text) between them."""
        if not self.special_pattern or not any(s in text for s in self.special):
            return [(None, text)]
        return [(self.special.get(x), x) for x in self.special_pattern.split(text) if x]

    def words(self, text: str) -> list[str]:
        if self.spaced:
            text = lower_each(regex.sub(f"{_SPACE}+", " ", unicodedata.normalize("NFC", text)))
        return self.pattern.findall(text)

    def symbols(self, word: str) -> list[int]:
        """Ids of a word's bytes; the last carries the end-of-word mark. Unknown ones are dropped."""
        names = [self.letters[b] for b in word.encode("utf-8", "replace")]
        if self.suffix and names:
            names[-1] += self.suffix
        return [self.ids[x] for x in names if x in self.ids]

    def decode(self, ids: list[int]) -> str:
        strings = [self.names[i] for i in ids if i in self.names]
        if self.joiner is not None:
            return self.joiner.join(strings)
        back = {c: b for b, c in enumerate(self.letters)}
        out = b"".join(s.encode() if s in self.special else bytes(back[c] for c in s) for s in strings)
        return out.decode("utf-8", "replace")
