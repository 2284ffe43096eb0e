"""HTML pages as sequences of leaf blocks: the text between block-level tags, with its path of tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

# Fixed values of the HTML standard.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style template textarea iframe".split())
FOREIGN = ("svg", "math")
#: A start tag closes an open element of the same group, if it is the innermost of its container.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_INLINE_OPEN = 16

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+'|["'])*+)>""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)


@dataclass
class Leaf:
    text: str
    path: tuple[tuple[str, ...], ...]  # (tag, class and id words...) from the outermost
    linked: int  # characters inside links, about


def leaves(page: str) -> list[Leaf]:
    """Blocks with text, in page order; character references decoded, white space turned into one space."""
    out: list[Leaf] = []
    stack: list[tuple[str, ...]] = []
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            out.append(Leaf(text, tuple(stack), linked))
        pieces.clear()
        linked = 0

    def close(names: set[str] | frozenset[str], depth: int) -> None:
        """Close the innermost open element of these names, if it is among the last `depth`."""
        if not any(opened[n] for n in names):
            return
        for k in range(len(stack) - 1, max(-1, len(stack) - 1 - depth), -1):
            if stack[k][0] in names:
                opened.subtract(s[0] for s in stack[k:])
                del stack[k:]
                return

    while m := _TAG.search(page, at):
        if m.start() > at:
            pieces.append(page[at : m.start()])
            linked += (m.start() - at) * (opened["a"] > 0)
        at = m.end()
        if not m[2]:
            continue
        name, ends = m[2].lower(), bool(m[1])
        if name in RAW and not ends:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
        elif name == "br":
            pieces.append(" ")
        if ends:
            close({name}, len(stack) if name in BLOCK else _INLINE_OPEN)
        elif name not in VOID and not (m[3].endswith("/") and (name in FOREIGN or any(opened[f] for f in FOREIGN))):
            if name in CLOSES:
                container = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in BLOCK), -1)
                if container >= 0 and stack[container][0] in CLOSES[name]:
                    close(CLOSES[name], len(stack))
            words = [w.lower() for n in _NAMES.finditer(m[3]) for w in re.split(r"[\s_-]+", n[1] or n[2] or n[3] or "") if w]
            stack.append((name, *words))
            opened[name] += 1
    pieces.append(page[at:])
    flush()
    return out
