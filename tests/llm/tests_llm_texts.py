"""Texts that tokenizers disagree about."""

import random


def hard_texts() -> list[str]:
    rng = random.Random(7)
    letters = "abcdefgh  ABC'sll\n\tàéßΣςσİﬁ中文字あ🙂👍🏽  ​́\x1c\x85123٣½_=-/<|>"
    random_texts = ["".join(rng.choices(letters, k=rng.randint(1, 80))) for _ in range(400)]
    return [
        "", " ", "a", "\n\n  x", "=" * 3000, "ab" * 2000, "a" * 2001, "I'll we've THEY'RE 'S",
        "x<|endoftext|>y", "<|startoftext|><|endoftext|>", "<|endoftext|", "ΑΣ ΟΔΟΣ", "é É", *random_texts,
    ]
