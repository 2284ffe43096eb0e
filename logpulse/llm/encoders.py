"""Library encoders of whole texts, with the bytes that every id stands for."""

from __future__ import annotations

import tiktoken
from sentencepiece import SentencePieceProcessor

from logpulse.llm.vocabulary import BYTE_LEVEL, Vocabulary


class ByteLevelEncoder:
    """Ids of a byte-level BPE tokenizer file whose ids follow its merge ranks.

    Its vocabulary is handed to the rank-based library, which gives the same ids several times as fast.
    """

    def __init__(self, tokenizer_json: str):
        self.v = Vocabulary.parse(tokenizer_json)
        back = {c: b for b, c in enumerate(self.v.letters)}
        ranks = {bytes(back[c] for c in s): i for s, i in self.v.ids.items() if s not in self.v.special}
        merged = [i for _, i in sorted(self.v.rules.values())]
        if self.v.spaced or self.v.suffix or any(a >= b for a, b in zip(merged, merged[1:])) or (merged and merged[0] < len(self.v.letters)):
            raise ValueError("not a byte-level vocabulary with ids in the order of its merges")
        self.encoding = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(self.v.names) + 1)
        for name, i in ranks.items():
            self.bytes_of[i] = name

    def plain(self, text: str) -> list[int]:
        """Ids of a text, special strings being text like any other."""
        return self.encoding.encode_ordinary(text)

    def ids(self, text: str) -> list[int]:
        """Ids of a text as the tokenizer file's library gives them by default: special strings are special."""
        out: list[int] = []
        for special, piece in self.v.pieces(text):
            if special is None:
                out += self.encoding.encode_ordinary(piece)
            else:
                out.append(special)
        return out


class PieceEncoder:
    """Ids of a SentencePiece model with byte fallback."""

    def __init__(self, model: bytes):
        self.model = SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(s[3:5], 16)]) if self.model.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)]

    def plain(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)
