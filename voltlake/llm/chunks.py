"""Cutting a text where byte-level BPE never merges, and remembering what a chunk became.

The pre-tokenizer of the byte-level vocabularies never joins characters across the border between
a non-space character and following white space, nor inside white space other than by its own
rule. Cutting there first gives chunks that can be encoded one by one, and most chunks of a text
have been seen before.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# White_Space of Unicode, which is what \s means to the tokenizers' regular expressions.
SPACE = "\t\n\x0b\x0c\r \x85\xa0" + "".join(
    map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
_CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Texts with single blanks and single line ends only need no regular expression.
_UNUSUAL = re.compile("[\0" + SPACE.replace(" ", "").replace("\n", "") + "]|[ \n][ \n]")


def chunks(text: str) -> list[str]:
    """The text, cut; joined again the chunks are the text."""
    if _UNUSUAL.search(text):
        return _CHUNK.findall(text)
    if not text:
        return []
    cut = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
    return [c for c in cut if c] if "" in cut else cut


class Memo(dict):
    """What a function gave for a key, for about ``limit`` keys.

    Between batches, ``age`` forgets all but what the last batch used once there are more, so that
    whatever is frequent stays.
    """

    def __init__(self, function: Callable, limit: int):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        value = self[key] = self.function(key)
        return value

    def new(self, keys: Iterable) -> list:
        """Those of the keys that are not remembered."""
        return [k for k in keys if k not in self]

    def age(self, used: Iterable = ()) -> None:
        if len(self) > self.limit:
            kept = {k: self[k] for k in used if k in self}
            self.clear()
            self.update(kept)
